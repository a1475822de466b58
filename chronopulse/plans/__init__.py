"""Dataset jobs: chains of operators that a user calls by name."""
