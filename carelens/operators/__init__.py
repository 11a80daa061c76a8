"""Relational operators of the staffing pipeline."""
