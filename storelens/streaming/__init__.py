"""Incremental pulls as streams."""
