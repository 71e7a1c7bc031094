"""Loads every catalog module, so that their queries are registered."""

from __future__ import annotations

import functools
import importlib

from lamina.catalog.base import ORACLES, QUERIES, Query
from lamina.session import configure

MODULES = ["cleaning", "ruling", "summaries", "certificates", "contracts", "ledgers", "storage"]


def load() -> tuple[dict[str, Query], dict[str, str]]:
    """Registered queries, each run in a configured session, and their SQL counterparts."""
    for module in MODULES:
        importlib.import_module(f"lamina.catalog.{module}")
    return {name: _configured(fn) for name, fn in QUERIES.items()}, dict(ORACLES)


def _configured(fn: Query) -> Query:
    @functools.wraps(fn)
    def run(spark, sf_dir):
        return fn(configure(spark), sf_dir)

    return run
