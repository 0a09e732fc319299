"""Operators over source and target rows."""
