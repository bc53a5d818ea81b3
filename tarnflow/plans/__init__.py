"""Queries over the standard tables, and composite plans."""
