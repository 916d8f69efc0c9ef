"""Relational operators on change rows."""
