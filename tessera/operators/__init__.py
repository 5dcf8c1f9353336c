"""Operators on document tables."""
