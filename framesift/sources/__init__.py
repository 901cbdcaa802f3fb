"""Readers and writers for meta tables, listings, sidecars and feature bins."""
