"""Readers, writers and inventories."""
