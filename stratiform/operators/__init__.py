"""Relational operators: flattening, deduplication, upserts, guards, tallies."""
