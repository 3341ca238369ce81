"""Registered queries."""

from . import catalog, rules

__all__ = ["catalog", "rules"]
