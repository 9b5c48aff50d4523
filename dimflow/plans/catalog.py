"""

Each query reads the TESTDATA tables (or fixtures Spark derives from them),
runs a ``dimflow`` operator over the whole input and returns a DataFrame.
``ORACLES[name]`` is the same computation as DuckDB SQL over the same tables,
used by the correctness gate.  Column names match between the two.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    """Decorator: add a query (and its DuckDB oracle, if SQL can express it)."""
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return deco


def _load_all() -> None:
    # Importing the modules registers their queries.
    from dimflow.plans import (q_files, q_jobs, q_load, q_projection, q_quality,  # noqa: F401
                               q_registry, q_runlog, q_scan, q_state, q_scale)


_load_all()
