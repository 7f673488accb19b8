"""Schemas, readers, writers and layout changes."""
