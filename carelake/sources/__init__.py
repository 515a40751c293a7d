"""Readers and writers: raw drops, lake, bronze and silver tables."""
