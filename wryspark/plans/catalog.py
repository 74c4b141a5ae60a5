"""Registry of named queries: Spark builder + optional DuckDB oracle SQL.

Every query reads the driver tables under ``sf_dir`` whole. Queries whose
result comes from a fitted model or a sampled process register no SQL
(rows-only check) and are unit-tested against a brute-force fixture.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass
class Query:
    name: str
    ids: str  # operator ids of the blueprint this query covers
    build: Callable[[SparkSession, str], DataFrame]
    sql: str | None = None


REGISTRY: dict[str, Query] = {}


def register(name: str, ids: str, sql: str | None = None):
    def deco(fn):
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = Query(name, ids, fn, sql)
        return fn
    return deco


def load_all() -> dict[str, Query]:
    # Importing the plan modules fills the registry.
    from . import (articles_q, eda_q, encode_q, features_q, io_q,  # noqa: F401
                   lexicon_q, models_q, reconcile_q, splits_q)
    return REGISTRY
