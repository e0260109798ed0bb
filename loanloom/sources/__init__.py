"""Readers, writers and the role views over star-schema tables."""
