"""Relational operators: data-quality split, derivations, star enrichment."""
