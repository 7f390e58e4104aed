"""Scans of landed files and payload columns."""
