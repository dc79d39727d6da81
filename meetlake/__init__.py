"""Spark jobs that turn captured competition pages and payloads into entity tables."""

from meetlake.site import Site

__all__ = ["Site"]
