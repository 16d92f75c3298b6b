"""Relational operators built from DataFrame plans."""
