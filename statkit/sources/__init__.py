"""Scans of landed files."""
