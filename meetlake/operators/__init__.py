"""Relational operators: tallies, keyed writes, look-ups, paged reads, run log."""
