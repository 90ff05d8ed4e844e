"""Daily aggregation and merge.

Each aggregate is a partial + final hash aggregation keyed by day, so the shuffle
carries one row per (map task, day) whatever the input size.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def daily_article_counts(
    news: DataFrame,
    date_col: str = "date",
    url_col: str = "url",
    flag_cols: Sequence[tuple[str, str]] = (
        ("covid_flag", "total_articles_about_covid"),
        ("negative_flag", "total_negative_articles"),
    ),
) -> DataFrame:
    """A1: per day the number of articles and of non-null flags."""
    aggs = [F.count(url_col).alias("total_number_of_articles")]
    aggs += [F.count(src).alias(dst) for src, dst in flag_cols]
    return news.groupBy(F.col(date_col).alias("datetime")).agg(*aggs)


def daily_ratios(
    counts: DataFrame,
    pairs: Sequence[tuple[str, str]] = (
        ("total_articles_about_covid", "ratio_articles_about_covid"),
        ("total_negative_articles", "ratio_negative_articles"),
    ),
    total_col: str = "total_number_of_articles",
) -> DataFrame:
    """A2: flag count / article count."""
    return counts.withColumns({dst: F.try_divide(F.col(src).cast("double"), F.col(total_col)) for src, dst in pairs})


def day_of(ts: Column | str, source_tz: str | None = None, target_tz: str | None = None) -> Column:
    """Calendar day of a wall-clock timestamp, optionally moved from ``source_tz`` to ``target_tz``
    first (e.g. UTC news against local-time readings). Without zones: the day as recorded."""
    c = F.col(ts) if isinstance(ts, str) else ts
    if source_tz and target_tz:
        c = F.convert_timezone(F.lit(source_tz), F.lit(target_tz), c.cast("timestamp_ntz"))
    return F.to_date(c)


def daily_mean(readings: DataFrame, ts_col: str, value_cols: Sequence[str], drop: Sequence[str] = (),
               source_tz: str | None = None, target_tz: str | None = None) -> DataFrame:
    """A3 / A4: mean of each value column per calendar day (NULLs skipped, repeats kept)."""
    keep = [c for c in value_cols if c not in set(drop)]
    day = day_of(ts_col, source_tz, target_tz)
    return readings.groupBy(day.alias("datetime")).agg(*[F.avg(c).alias(c) for c in keep])


def daily_index_mean(index: DataFrame, ts_col: str = "datetime", value_col: str = "index_value",
                     source_tz: str | None = None, target_tz: str | None = None) -> DataFrame:
    """A3."""
    return daily_mean(index, ts_col, [value_col], source_tz=source_tz, target_tz=target_tz)


def daily_weather_mean(
    weather: DataFrame,
    ts_col: str = "datetime",
    drop: Sequence[str] = ("humidity_pct", "visibility_km", "uv_index"),
    source_tz: str | None = None,
    target_tz: str | None = None,
) -> DataFrame:
    """A4: mean of every numeric column, then drop the columns that barely change."""
    numeric = [f.name for f in weather.schema.fields if f.name != ts_col and f.dataType.typeName() in ("double", "float", "integer", "long", "short", "decimal")]
    return daily_mean(weather, ts_col, numeric, drop, source_tz=source_tz, target_tz=target_tz)


def merge_daily_sources(*daily: DataFrame, key: str = "datetime") -> DataFrame:
    """A5: full outer merge on the day, ordered by day (three small day-keyed tables)."""
    out = daily[0]
    for d in daily[1:]:
        out = out.join(d, on=key, how="full")
    return out.orderBy(key)


def rescale_to_range(df: DataFrame, col: str, target: str, out: str = "scaled") -> DataFrame:
    """Min-max rescale ``col`` into [min, max] of ``target``; a constant column maps to the midpoint.

    The four extremes are one global aggregate (a single row), joined back by broadcast.
    """
    stats = df.agg(
        F.min(col).alias("_cmin"), F.max(col).alias("_cmax"), F.min(target).alias("_tmin"), F.max(target).alias("_tmax")
    )
    j = df.crossJoin(F.broadcast(stats))
    span = F.col("_cmax") - F.col("_cmin")
    scaled = F.when(
        span == 0, (F.col("_tmin") + F.col("_tmax")) / 2
    ).otherwise((F.col(col) - F.col("_cmin")) / span * (F.col("_tmax") - F.col("_tmin")) + F.col("_tmin"))
    return j.withColumn(out, scaled).drop("_cmin", "_cmax", "_tmin", "_tmax")


def select_variable_series(df: DataFrame, key: str, value_cols: Sequence[str], variable: str | None = None) -> DataFrame:
    """Long (key, variable, value) series for any column chosen by name."""
    typed = df.select(F.col(key), *[F.col(c).cast("double").alias(c) for c in value_cols])
    long = typed.unpivot([key], list(value_cols), "variable", "value")
    return long.where(F.col("variable") == variable) if variable else long
