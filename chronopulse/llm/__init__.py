"""Operators that prepare text corpora for language-model training.

Nothing outside this subpackage imports it; it imports nothing from the rest of the library.
"""
