"""Incremental runs over a landing folder."""
