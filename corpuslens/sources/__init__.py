"""Readers for export files and writers for the unified article table."""
