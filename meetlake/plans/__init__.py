"""Whole jobs: from captures of one kind to merged entity tables."""
