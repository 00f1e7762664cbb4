"""Relational operators the library adds on top of the DataFrame API."""
