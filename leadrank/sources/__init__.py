"""Readers, writers and stored side tables."""
