"""Scalar language of predicates."""
