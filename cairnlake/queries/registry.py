"""All core queries and their SQL."""

from __future__ import annotations

from cairnlake.queries import feeds, governance, identity, problems, quality, records, search, store, views

MODULES = [problems, store, search, views, identity, quality, records, feeds, governance]


def queries() -> dict:
    return {k: f for m in MODULES for k, f in m.QUERIES.items()}


def oracles() -> dict:
    return {k: q for m in MODULES for k, q in m.ORACLES.items()}
