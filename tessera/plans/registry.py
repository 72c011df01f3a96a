"""Registry of named queries and their DuckDB oracle SQL.

A query is ``fn(spark, sf_dir) -> DataFrame`` over the driver tables; its
oracle is an ANSI SQL string over the same tables (views named like the
tables).  Queries without an SQL form register no oracle.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

QUERIES: dict[str, Callable] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")

        @functools.wraps(fn)
        def run(spark, sf_dir):
            # executors' Python workers need the package (UDFs, mapInPandas)
            from tessera.session import ship_package
            ship_package(spark)
            return fn(spark, sf_dir)
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def load_all() -> None:
    """Import every plan module so their queries register."""
    from tessera.plans import (  # noqa: F401
        q_scalars, q_relational, q_io, q_quality, q_text, q_models, q_marts)
