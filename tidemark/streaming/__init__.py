"""Operators over streams."""
