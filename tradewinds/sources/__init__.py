"""Readers, payload parsers and keyed snapshot tables."""
