"""Readers: JSON-lines files and directories of text files."""
