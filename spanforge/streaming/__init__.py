"""Incremental variants."""
