"""Scenes arriving as tiles, with Structured Streaming."""
