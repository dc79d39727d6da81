"""All queries and their SQL."""

from __future__ import annotations

from meetlake.checks import keyed, pages, payloads, reads, streams, tallies, texts

_MODULES = (reads, tallies, keyed, texts, payloads, pages, streams)

QUERIES = {name: q for m in _MODULES for name, q in m.QUERIES.items()}
SQL = {name: q for m in _MODULES for name, q in m.SQL.items()}
