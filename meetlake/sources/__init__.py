"""Captured responses, the payloads and pages in them, and stored entity tables."""
