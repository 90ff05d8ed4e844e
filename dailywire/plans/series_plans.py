"""Series helper queries over the daily order series."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dailywire.operators import series as X
from dailywire.plans.registry import query, rounded
from dailywire.sources.readers import table
from dailywire.sources.views import daily_order_series

_SERIES_SQL = """s AS (SELECT o_orderpriority AS series_id, CAST(o_orderdate AS DATE) AS ds, sum(o_totalprice) AS y FROM orders GROUP BY 1, 2)"""
_SPLIT_SQL = _SERIES_SQL + """,
    r AS (SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY ds) AS rn, count(*) OVER (PARTITION BY series_id) AS n FROM s),
    c AS (SELECT *, CAST(round_even(n * 0.75, 0) AS BIGINT) AS cut FROM r),
    sp AS (SELECT series_id, ds, y, 'train' AS set FROM c WHERE rn <= cut UNION ALL SELECT series_id, ds, y, 'test' AS set FROM c WHERE rn >= cut)"""
_NAIVE_SQL = """nv AS (SELECT series_id, ds, lag(y, 7) OVER (PARTITION BY series_id ORDER BY ds) AS yhat FROM s),
    ev AS (SELECT sp.series_id, sp.ds, sp.y, nv.yhat FROM sp JOIN nv USING (series_id, ds) WHERE sp.set = 'test')"""


def series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return daily_order_series(table(spark, sf_dir, "orders"))


def _evaluation(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = series(spark, sf_dir)
    test = X.ordered_split(s, 0.75).where(F.col("set") == "test").select("series_id", "ds", "y")
    fc = X.seasonal_naive(s, 7).select("series_id", "ds", "yhat")
    return X.join_actual_forecast(test, fc)


@query("A9_ordered_split", f"WITH {_SPLIT_SQL} SELECT series_id, ds, round(y, 6) AS y, set FROM sp")
def a9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(X.ordered_split(series(spark, sf_dir), 0.75))


@query(
    "A6_join_actual_forecast",
    f"WITH {_SPLIT_SQL}, {_NAIVE_SQL} SELECT series_id, ds, round(y, 6) AS y, round(yhat, 6) AS yhat FROM ev",
)
def a6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(_evaluation(spark, sf_dir))


@query("A15_mae", f"WITH {_SPLIT_SQL}, {_NAIVE_SQL} SELECT series_id, round(avg(abs(y - yhat)), 6) AS mae FROM ev GROUP BY series_id")
def a15(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(X.mae(_evaluation(spark, sf_dir)))


@query(
    "A16_rmse",
    f"""WITH {_SPLIT_SQL},
    te AS (SELECT series_id, ds, y, row_number() OVER (PARTITION BY series_id ORDER BY ds) AS step FROM sp WHERE set = 'test'),
    lt AS (SELECT series_id, arg_max(y, ds) AS last_y FROM sp WHERE set = 'train' GROUP BY series_id),
    mm AS (SELECT series_id, count(*) AS m FROM te GROUP BY 1),
    fc AS (SELECT series_id, unnest(range(1, m + 3)) AS step, last_y AS yhat FROM lt JOIN mm USING (series_id))
    SELECT series_id, round(sqrt(avg(power(y - yhat, 2))), 6) AS rmse FROM te JOIN fc USING (series_id, step) GROUP BY series_id""",
)
def a16(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Naive forecast (last training value) for test size + 2 steps, scored by step number."""
    sp = X.ordered_split(series(spark, sf_dir), 0.75)
    test = sp.where(F.col("set") == "test").withColumn(
        "step", F.row_number().over(X._w()))
    train = sp.where(F.col("set") == "train")
    last = train.groupBy("series_id").agg(F.max_by("y", "ds").alias("yhat"))
    m = test.groupBy("series_id").agg(F.count(F.lit(1)).alias("m"))
    fc = last.join(m, "series_id").select("series_id", "yhat", F.explode(F.sequence(F.lit(1), F.col("m") + 2)).alias("step"))
    return rounded(X.rmse(test.join(fc, ["series_id", "step"])))


@query(
    "A10_date_spine",
    f"""WITH {_SERIES_SQL}, l AS (SELECT series_id, max(ds) AS last FROM s GROUP BY 1)
    SELECT series_id, ds FROM s UNION ALL SELECT series_id, CAST(last + CAST(i AS INTEGER) AS DATE) AS ds FROM l, range(1, 17) r(i)""",
)
def a10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return X.date_spine(series(spark, sf_dir), 16)


_REGS_SQL = """g AS (SELECT o_orderpriority AS series_id, CAST(l_shipdate AS DATE) AS ds, sum(l_quantity) AS x
          FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2)"""


def _regressors(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_shipdate", "l_quantity")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    j = li.join(o, li.l_orderkey == o.o_orderkey)
    return j.groupBy(F.col("o_orderpriority").alias("series_id"), F.to_date("l_shipdate").alias("ds")).agg(F.sum("l_quantity").alias("x"))


_JOINED_SQL = f"""{_SERIES_SQL}, l AS (SELECT series_id, max(ds) AS last FROM s GROUP BY 1),
    sp AS (SELECT series_id, ds FROM s UNION ALL SELECT series_id, CAST(last + CAST(i AS INTEGER) AS DATE) AS ds FROM l, range(1, 17) r(i)),
    {_REGS_SQL},
    j AS (SELECT coalesce(sp.series_id, g.series_id) AS series_id, coalesce(sp.ds, g.ds) AS ds, g.x FROM sp FULL OUTER JOIN g ON sp.series_id = g.series_id AND sp.ds = g.ds)"""


@query("A7_join_regressors", f"WITH {_JOINED_SQL} SELECT series_id, ds, round(x, 6) AS x FROM j")
def a7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(X.join_regressors(X.date_spine(series(spark, sf_dir), 16), _regressors(spark, sf_dir)))


@query(
    "A8_forward_fill",
    f"""WITH {_JOINED_SQL} SELECT series_id, ds, round(last_value(x IGNORE NULLS) OVER (PARTITION BY series_id ORDER BY ds
        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 6) AS x FROM j""",
)
def a8(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = X.join_regressors(X.date_spine(series(spark, sf_dir), 16), _regressors(spark, sf_dir))
    return rounded(X.forward_fill(joined, ["x"]))


# (p, d, q) x (seasonal p, d, q, period); Spark names are case-insensitive, so the seasonal
# orders are called sp, sd, sq rather than P, D, Q.
_GRID = dict(p=range(3), d=[1], q=range(3), sp=range(3), sd=[1], sq=range(3), s=[7])


@query(
    "A13_param_grid",
    """SELECT series_id, p, d, q, sp, sd, sq, s FROM (SELECT DISTINCT o_orderpriority AS series_id FROM orders),
       range(3) a(p), (VALUES (1::BIGINT)) b(d), range(3) c(q), range(3) e(sp), (VALUES (1::BIGINT)) f(sd), range(3) g(sq), (VALUES (7::BIGINT)) h(s)""",
)
def a13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 81 seasonal orders for every series (the grid is a fixed 81-row table, broadcast)."""
    grid = X.param_grid(spark, **{k: list(v) for k, v in _GRID.items()})
    ids = table(spark, sf_dir, "orders").select(F.col("o_orderpriority").alias("series_id")).distinct()
    out = ids.crossJoin(F.broadcast(grid))
    return out.select("series_id", *[F.col(c).cast("bigint").alias(c) for c in _GRID])


@query(
    "A14_best_by_score",
    f"""WITH {_SERIES_SQL}, r AS (SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY ds) AS rn FROM s),
    ak AS (SELECT r.*, k, rn - k AS prn FROM r, range(1, 15) t(k)),
    sc AS (SELECT a.series_id, k, avg(abs(a.y - b.y)) AS score FROM ak a JOIN r b ON a.series_id = b.series_id AND b.rn = a.prn
           GROUP BY a.series_id, k),
    best AS (SELECT series_id, arg_min(k, (score, k)) AS k, min(score) AS score FROM sc GROUP BY series_id)
    SELECT series_id, k, round(score, 6) AS score FROM best""",
)
def a14(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lag-k naive forecasts for k in 1..14 scored by MAE; the best k per series."""
    s = series(spark, sf_dir)
    w = X._w()
    lagged = s.select("series_id", "y", *[F.lag("y", k).over(w).alias(f"l{k}") for k in range(1, 15)])
    long = lagged.select("series_id", "y", F.explode(F.array(*[F.struct(F.lit(k).alias("k"), F.col(f"l{k}").alias("yhat")) for k in range(1, 15)])).alias("c"))
    scores = long.where(F.col("c.yhat").isNotNull()).groupBy("series_id", F.col("c.k").alias("k")).agg(
        F.avg(F.abs(F.col("y") - F.col("c.yhat"))).alias("score"))
    return rounded(X.best_by_score(scores, "score", ["k"]).select("series_id", F.col("k").cast("bigint").alias("k"), "score"))


@query(
    "F4_difference_series",
    f"""WITH {_SERIES_SQL}, d AS (SELECT *, y - lag(y, 1) OVER (PARTITION BY series_id ORDER BY ds) AS d1 FROM s)
    SELECT series_id, ds, round(y, 6) AS y, round(d1, 6) AS d1, round(d1 - lag(d1, 7) OVER (PARTITION BY series_id ORDER BY ds), 6) AS sd1 FROM d""",
)
def f4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(X.difference_series(series(spark, sf_dir), 1, 1, 7))
