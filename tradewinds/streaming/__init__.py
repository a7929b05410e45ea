"""Incremental synchronisation of keyed tables."""
