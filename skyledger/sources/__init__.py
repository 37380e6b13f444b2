"""Readers, writers and the readings table."""
