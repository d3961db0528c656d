"""Relational operators over papers and edges."""
