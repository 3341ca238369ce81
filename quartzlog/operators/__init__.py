"""Operators over the log."""
