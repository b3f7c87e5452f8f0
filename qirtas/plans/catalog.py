"""Queries by name, and the SQL that gives the same rows."""

from __future__ import annotations

from . import casefiles, collections, corpus, listings, measures, sheets, streams

QUERIES: dict = {}
ORACLES: dict[str, str] = {}
for module in (measures, corpus, casefiles, collections, sheets, streams, listings):
    QUERIES |= module.QUERIES
    ORACLES |= module.ORACLES
