"""Series helpers over a long table (series_id, ds, y, ...): A6-A10, A13-A16, F4.

Every window is partitioned by ``series_id``; the series are day-level aggregates, so a
partition holds at most one row per day of the series.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

SERIES = "series_id"


def _w(series: str = SERIES, order: str = "ds") -> Window:
    return Window.partitionBy(series).orderBy(order)


def join_actual_forecast(actual: DataFrame, forecast: DataFrame, keys: Sequence[str] = (SERIES, "ds")) -> DataFrame:
    """Inner equi-join of actual rows and forecast rows."""
    return actual.join(forecast, on=list(keys), how="inner")


def join_regressors(future: DataFrame, regressors: DataFrame, keys: Sequence[str] = (SERIES, "ds")) -> DataFrame:
    """Outer join of the future frame and known regressor values."""
    return future.join(regressors, on=list(keys), how="full")


def forward_fill(df: DataFrame, cols: Sequence[str], series: str = SERIES, order: str = "ds") -> DataFrame:
    """Each NULL takes the last non-NULL value before it in the series."""
    w = _w(series, order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumns({c: F.last(c, ignorenulls=True).over(w) for c in cols})


def ordered_split(df: DataFrame, p: float = 0.75, overlap: int = 1, series: str = SERIES, order: str = "ds") -> DataFrame:
    """train = first round(n*p) rows, test = from row round(n*p) - overlap + 1 on (round half to even).

    Adds ``set`` in {train, test}; with ``overlap=1`` the boundary row appears in both.
    """
    n = F.count(F.lit(1)).over(Window.partitionBy(series))
    rn = F.row_number().over(_w(series, order))
    d = df.withColumn("_n", n).withColumn("_rn", rn).withColumn("_cut", F.bround(F.col("_n") * F.lit(p), 0).cast("long"))
    sets = F.filter(
        F.array(
            F.when(F.col("_rn") <= F.col("_cut"), F.lit("train")),
            F.when(F.col("_rn") >= F.col("_cut") - F.lit(overlap) + 1, F.lit("test")),
        ),
        lambda s: s.isNotNull(),
    )
    return d.withColumn("set", F.explode(sets)).drop("_n", "_rn", "_cut")


def date_spine(df: DataFrame, periods: int, series: str = SERIES, ds: str = "ds", include_history: bool = True) -> DataFrame:
    """A10: the history dates of each series plus ``periods`` consecutive days after its last date."""
    last = df.groupBy(series).agg(F.max(ds).alias("_last"))
    future = last.select(
        series, F.explode(F.sequence(F.date_add("_last", 1), F.date_add("_last", periods), F.expr("INTERVAL 1 DAY"))).alias(ds)
    )
    return df.select(series, ds).unionByName(future) if include_history else future


def param_grid(spark: SparkSession, **ranges: Sequence[int]) -> DataFrame:
    """Cartesian product of small integer ranges (a few dozen rows, built by cross joins).

    Each dimension is a one-partition frame: a cartesian product multiplies partition counts.
    """
    frames = [spark.createDataFrame([(v,) for v in vals], f"{name} int").coalesce(1) for name, vals in ranges.items()]
    return reduce(lambda a, b: a.crossJoin(b), frames)


def best_by_score(df: DataFrame, score: str, params: Sequence[str], series: str = SERIES) -> DataFrame:
    """Per series the row with the lowest score; ties go to the smallest parameters."""
    best = df.groupBy(series).agg(
        F.min_by(F.struct(*[F.col(p) for p in params], F.col(score)), F.struct(F.col(score), *[F.col(p) for p in params])).alias("_b")
    )
    return best.select(series, *[F.col(f"_b.{p}").alias(p) for p in params], F.col(f"_b.{score}").alias(score))


def mae(df: DataFrame, y: str = "y", yhat: str = "yhat", series: str = SERIES) -> DataFrame:
    """Mean absolute error per series."""
    return df.groupBy(series).agg(F.avg(F.abs(F.col(y) - F.col(yhat))).alias("mae"))


def rmse(df: DataFrame, y: str = "y", yhat: str = "yhat", series: str = SERIES) -> DataFrame:
    """Root mean square error per series (rows already aligned by step number)."""
    return df.groupBy(series).agg(F.sqrt(F.avg(F.pow(F.col(y) - F.col(yhat), 2))).alias("rmse"))


def difference_series(df: DataFrame, d: int = 1, seasonal_d: int = 1, s: int = 7, y: str = "y",
                      series: str = SERIES, order: str = "ds") -> DataFrame:
    """``d`` lag-1 differences then ``seasonal_d`` lag-``s`` differences, by row position."""
    w = _w(series, order)
    out, cur = df, y
    for i in range(d):
        nxt = f"d{i + 1}"
        out, cur = out.withColumn(nxt, F.col(cur) - F.lag(cur, 1).over(w)), nxt
    for i in range(seasonal_d):
        nxt = f"sd{i + 1}"
        out, cur = out.withColumn(nxt, F.col(cur) - F.lag(cur, s).over(w)), nxt
    return out


def seasonal_naive(df: DataFrame, lag: int = 7, y: str = "y", series: str = SERIES, order: str = "ds") -> DataFrame:
    """yhat = the value ``lag`` rows earlier in the series (a baseline forecast)."""
    return df.withColumn("yhat", F.lag(y, lag).over(_w(series, order)))
