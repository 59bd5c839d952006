"""Readers of lake tables, change topics and source files."""
