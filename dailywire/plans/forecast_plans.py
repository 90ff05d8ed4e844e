"""Forecast queries over the daily order series (F1-F3, F5-F9). Iterative fits have rows-only checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from dailywire.operators import forecast as FC
from dailywire.operators import series as X
from dailywire.plans.registry import query, rounded
from dailywire.plans.series_plans import _SERIES_SQL, _regressors, series


def _split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return X.ordered_split(series(spark, sf_dir), 0.75)


@query("F1_forecast_trend_seasonal")
def f1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(FC.forecast_trend_seasonal(_split(spark, sf_dir), periods=16))


@query("F2_forecast_with_regressors")
def f2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Regressor: daily shipped quantity per priority, known into the future, forward filled."""
    return rounded(FC.forecast_trend_seasonal(_split(spark, sf_dir), periods=16, regressors=_regressors(spark, sf_dir), regressor_cols=["x"]))


@query("F3_forecast_components")
def f3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(FC.forecast_trend_seasonal(_split(spark, sf_dir), periods=16, components=True))


@query("F5_adf_statistic")
def f5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(FC.adf_statistic(series(spark, sf_dir)))


def _order_sql(dates: str) -> str:
    """The order by closed normal equations, for lags 0 and 1 and orders 0 to 2."""
    a0, a1, a2, a3 = FC.ADF_SURFACE_5PCT
    moments = ", ".join(f"covar_pop({a}, {b}) * count(*) AS s{a}{b}" for a, b in ("aa", "bb", "ab", "at", "bt", "tt"))
    return f"""WITH {_SERIES_SQL}, {dates}
    v1 AS (SELECT series_id, ds, y / max(abs(y)) OVER (PARTITION BY series_id) AS v0 FROM x),
    v2 AS (SELECT *, v0 - lag(v0) OVER (PARTITION BY series_id ORDER BY ds) AS v1 FROM v1),
    v3 AS (SELECT *, v1 - lag(v1) OVER (PARTITION BY series_id ORDER BY ds) AS v2 FROM v2),
    r AS (SELECT series_id, 0 AS ord, v1 AS t, lag(v0) OVER w AS a, lag(v1) OVER w AS b FROM v3 WINDOW w AS (PARTITION BY series_id ORDER BY ds)
      UNION ALL SELECT series_id, 1, v2, lag(v1) OVER w, lag(v2) OVER w FROM v3 WINDOW w AS (PARTITION BY series_id ORDER BY ds)),
    m AS (SELECT series_id, ord, count(*) AS n, {moments} FROM r WHERE t IS NOT NULL AND a IS NOT NULL AND b IS NOT NULL GROUP BY 1, 2),
    e AS (SELECT *, saa * sbb - sab * sab AS det, stt - sat * sat / saa AS r0 FROM m),
    g AS (SELECT *, (sat * sbb - sbt * sab) / det AS ca, (sbt * saa - sat * sab) / det AS cb FROM e),
    h AS (SELECT *, stt - ca * sat - cb * sbt AS r1 FROM g),
    c AS (SELECT *, n * ln(r0 / n) + 4 <= n * ln(r1 / n) + 6 AS short FROM h),
    q AS (SELECT series_id, ord, n, CASE WHEN short THEN 0 ELSE 1 END AS lags,
      CASE WHEN short THEN sat / saa / sqrt(r0 / (n - 2) / saa) ELSE ca / sqrt(r1 / (n - 3) * sbb / det) END AS adf,
      {a0} + {a1} / n + {a2} / n ** 2 + {a3} / n ** 3 AS bound FROM c),
    z AS (SELECT *, CASE WHEN adf < bound THEN ord WHEN ord = 1 THEN 2 END AS d FROM q),
    k AS (SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY ord) AS rn FROM z WHERE d IS NOT NULL)
    SELECT series_id, d, round(adf, 4) AS adf, round(bound, 4) AS bound, lags, n, 'ok' AS status FROM k WHERE rn = 1"""


_SUMS = """o AS (SELECT series_id, ds, sum(y - 100000) OVER w AS y FROM s WINDOW w AS (PARTITION BY series_id ORDER BY ds)),
    x AS (SELECT series_id, ds, sum(y) OVER w AS y FROM o WINDOW w AS (PARTITION BY series_id ORDER BY ds)),"""


@query("F5_unit_root_order", _order_sql("x AS (SELECT * FROM s),"))
def f5_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(FC.unit_root_order(series(spark, sf_dir), max_lag=1), 4)


@query("F5_unit_root_order_of_sums", _order_sql(_SUMS))
def f5_order_of_sums(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The series summed up twice, so that it has to be differenced."""
    w = Window.partitionBy("series_id").orderBy("ds").rowsBetween(Window.unboundedPreceding, 0)
    once = series(spark, sf_dir).withColumn("y", F.sum(F.col("y") - 100000).over(w))
    return rounded(FC.unit_root_order(once.withColumn("y", F.sum("y").over(w)), max_lag=1), 4)


@query("F6_arima_order_search")
def f6(spark: SparkSession, sf_dir: str) -> DataFrame:
    train = _split(spark, sf_dir).where(F.col("set") == "train").select("series_id", "ds", "y")
    return rounded(FC.arma_order_search(train))


@query("F7_arima_forecast")
def f7(spark: SparkSession, sf_dir: str) -> DataFrame:
    fc = FC.arima_forecast(_split(spark, sf_dir), steps_extra=2)
    return rounded(fc.select("series_id", "step", "yhat", "p", "d", "q", "status"))


@query("F8_sarimax_grid_search")
def f8(spark: SparkSession, sf_dir: str) -> DataFrame:
    split = _split(spark, sf_dir)
    train = split.where(F.col("set") == "train").join(_regressors(spark, sf_dir), ["series_id", "ds"], "left").fillna(0.0, ["x"])
    return rounded(FC.sarimax_grid_search(train, exog=["x"]).select("series_id", "order", "aic", "status"))


@query("F9_sarimax_forecast")
def f9(spark: SparkSession, sf_dir: str) -> DataFrame:
    split = _split(spark, sf_dir).join(_regressors(spark, sf_dir), ["series_id", "ds"], "left").fillna(0.0, ["x"])
    return rounded(FC.sarimax_forecast(split, exog=["x"]))


@query("F1_forecast_mae")
def f1_mae(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The printed score of the trend/seasonal forecast: test rows joined to the forecast on the day
    (A6), mean absolute error per series (A15)."""
    split = _split(spark, sf_dir)
    fc = FC.forecast_trend_seasonal(split, periods=16).select("series_id", "ds", "yhat")
    test = split.where(F.col("set") == "test").select("series_id", "ds", "y")
    return rounded(X.mae(X.join_actual_forecast(test, fc)))


@query("F7_arima_rmse")
def f7_rmse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The printed score of the ARIMA forecast: RMSE against the test rows on their days."""
    split = _split(spark, sf_dir)
    fc = FC.arima_forecast(split, steps_extra=2).select("series_id", "step", "yhat")
    test = FC.after_training(split).select("series_id", "step", "y")
    return rounded(X.rmse(test.join(fc, ["series_id", "step"])))
