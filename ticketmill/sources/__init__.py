"""Readers, writers and the ticket derivation used with the test tables."""
