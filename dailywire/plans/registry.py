"""Registry of named queries: a Spark builder and (when SQL can state it) a DuckDB twin."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

DEFAULT_DIGITS = 6


@dataclass(frozen=True)
class Query:
    name: str
    build: Callable[[SparkSession, str], DataFrame]
    sql: str | None


REGISTRY: dict[str, Query] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir) -> DataFrame`` under ``name`` with an optional oracle SQL."""

    def deco(fn):
        if name in REGISTRY:
            raise KeyError(f"duplicate query {name}")
        REGISTRY[name] = Query(name, fn, sql)
        return fn

    return deco


def rounded(df: DataFrame, digits: int = DEFAULT_DIGITS) -> DataFrame:
    """Round every double column so results compare across engines."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            cols.append(F.round(F.col(f"`{f.name}`"), digits).alias(f.name))
        else:
            cols.append(F.col(f"`{f.name}`"))
    return df.select(*cols)


def load_all() -> dict[str, Query]:
    """Import every plan module (each registers its queries) and return the registry."""
    from dailywire.plans import (  # noqa: F401
        clean_plans,
        corpus_plans,
        daily_plans,
        extract_plans,
        forecast_plans,
        series_plans,
        source_plans,
        stream_plans,
        text_plans,
    )

    return REGISTRY
