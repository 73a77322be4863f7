"""Readers and writers of document files."""
