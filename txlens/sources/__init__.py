"""Readers, writers, catalog helpers and adapters from the test tables."""
