"""Readers, writers and file metadata."""
