"""Operators for preparing training text and vectors, with their queries and SQL."""
