"""Projection, filters and typing."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def drop_nulls(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """Drop rows with any NULL."""
    return df.na.drop(how="any", subset=list(subset) if subset else None)


def to_timestamp(col: Column | str, fmt: str | None = None, utc: bool = False) -> Column:
    """Text -> timestamp; unparsable -> NULL. ``utc=True`` honours offsets and returns UTC wall time;
    text without an offset is taken as UTC."""
    c = F.col(col) if isinstance(col, str) else col
    parsed = F.try_to_timestamp(c, F.lit(fmt)) if fmt else F.try_to_timestamp(c)
    if utc:
        # instant -> UTC wall clock, independent of the session time zone
        instant = F.convert_timezone(F.current_timezone(), F.lit("UTC"), parsed.cast("timestamp_ntz"))
        offset = c.rlike(r"(?i)(z|utc|gmt|[+-]\d{1,2}(:?\d{2}){0,2})\s*$") & c.contains(":") | c.rlike(r"\[?[A-Za-z]+/[A-Za-z_]+\]?\s*$")
        return F.when(offset, instant).otherwise(parsed.cast("timestamp_ntz"))
    return parsed.cast("timestamp_ntz")


def calendar_parts(df: DataFrame, ts_col: str) -> DataFrame:
    """Year, weekday (Monday = 0), month, date."""
    ts = F.col(ts_col)
    return df.withColumns(
        {"year": F.year(ts), "weekday": F.weekday(ts), "month": F.month(ts), "date": F.to_date(ts)}
    )


def select_rename_drop(df: DataFrame, rename: dict[str, str] | None = None, drop: Sequence[str] = (),
                       select: Sequence[str] | None = None) -> DataFrame:
    """Rename, drop and project columns."""
    out = df.withColumnsRenamed(rename or {})
    if drop:
        out = out.drop(*drop)
    return out.select(*select) if select else out


def date_range_filter(df: DataFrame, ts_col: str, start: str, end: str | None = None) -> DataFrame:
    """Keep rows on/after ``start`` (and before ``end``); written on the raw column so it pushes down."""
    c = F.col(ts_col)
    cond = c >= F.lit(start).cast("timestamp_ntz")
    if end:
        cond = cond & (c < F.lit(end).cast("timestamp_ntz"))
    return df.where(cond)


def first_n(df: DataFrame, n: int, order: Sequence[str]) -> DataFrame:
    """The first ``n`` rows under an explicit order (TakeOrderedAndProject, no global sort)."""
    return df.orderBy(*order).limit(n)


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    """Distinct values of a column, NULL included."""
    return df.select(col).distinct()


def drop_duplicates_first(df: DataFrame, keys: Sequence[str], order: Sequence[str | tuple[str, bool]]) -> DataFrame:
    """Keep the first row per key under an explicit order (deterministic, unlike dropDuplicates).

    ``order`` items are column names (ascending) or ``(name, ascending)``; a descending key must be
    numeric. Written as ``min_by`` over a struct, so a hot key is partially aggregated in every map
    task instead of being sorted in one task as a window would.
    """
    sort_key = []
    for item in order:
        name, asc = (item, True) if isinstance(item, str) else item
        sort_key.append(F.col(name) if asc else -F.col(name))
    rest = [c for c in df.columns if c not in set(keys)]
    best = df.groupBy(*keys).agg(F.min_by(F.struct(*[F.col(c) for c in rest]), F.struct(*sort_key)).alias("_first"))
    return best.select(*keys, *[F.col(f"_first.{c}").alias(c) for c in rest])


def any_flag_filter(df: DataFrame, flags: Sequence[str]) -> DataFrame:
    """C11: cast flags to boolean, keep rows where any is true."""
    typed = df.withColumns({c: F.col(c).cast("boolean") for c in flags})
    return typed.where(reduce(lambda a, b: a | b, [F.coalesce(F.col(c), F.lit(False)) for c in flags]))


def table_profile(df: DataFrame) -> DataFrame:
    """(column_name, type, non_null) for every column, from one aggregation pass."""
    fields = df.schema.fields
    counts = df.agg(*[F.count(F.col(f"`{f.name}`")).alias(f"c{i}") for i, f in enumerate(fields)])
    stack = "stack({}, {}) AS (column_name, type, non_null)".format(
        len(fields),
        ", ".join(f"'{f.name}', '{f.dataType.simpleString()}', c{i}" for i, f in enumerate(fields)),
    )
    return counts.selectExpr(stack)
