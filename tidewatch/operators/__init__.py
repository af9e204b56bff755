"""Relational operators of the library."""
