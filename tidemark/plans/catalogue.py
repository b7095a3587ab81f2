"""Registered queries over the driver's tables and their SQL twins."""

from __future__ import annotations

from . import filings, records, rules, streams, texts

_PARTS = (filings, records, texts, rules, streams)
QUERIES: dict = {k: v for m in _PARTS for k, v in m.QUERIES.items()}
ORACLE: dict = {k: v for m in _PARTS for k, v in m.ORACLE.items()}
