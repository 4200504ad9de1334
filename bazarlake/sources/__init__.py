"""Readers, writers and the adapter from the supplied test tables."""
