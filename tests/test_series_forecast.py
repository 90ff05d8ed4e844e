import datetime as dt
import math

import numpy as np
from pyspark.sql import functions as F

from dailywire.operators import forecast as FC
from dailywire.operators import series as X

D0 = dt.date(2022, 1, 3)


def _series(spark, rows):
    return spark.createDataFrame(rows, "series_id string, ds date, y double")


def _days(n):
    return [D0 + dt.timedelta(days=i) for i in range(n)]


def test_ordered_split_shares_one_row(spark):
    s = _series(spark, [("a", d, float(i)) for i, d in enumerate(_days(15))] + [("b", d, 1.0) for d in _days(6)])
    out = X.ordered_split(s, 0.75).collect()
    a_train = sorted(r.y for r in out if r.series_id == "a" and r.set == "train")
    a_test = sorted(r.y for r in out if r.series_id == "a" and r.set == "test")
    assert a_train == [float(i) for i in range(11)] and a_test == [10.0, 11.0, 12.0, 13.0, 14.0]
    # 6 * 0.75 = 4.5 rounds half to even -> 4
    assert sum(1 for r in out if r.series_id == "b" and r.set == "train") == 4


def test_spine_regressors_ffill(spark):
    s = _series(spark, [("a", d, 1.0) for d in _days(3)])
    spine = X.date_spine(s, 2)
    assert sorted(r.ds for r in spine.collect()) == _days(5)
    regs = spark.createDataFrame([("a", _days(5)[0], 5.0), ("a", _days(5)[2], 7.0)], "series_id string, ds date, x double")
    out = sorted((r.ds, r.x) for r in X.forward_fill(X.join_regressors(spine, regs), ["x"]).collect())
    assert [x for _, x in out] == [5.0, 5.0, 7.0, 7.0, 7.0]


def test_grid_best_score_and_errors(spark):
    grid = X.param_grid(spark, p=range(3), d=[1], q=range(3), sp=range(3), sd=[1], sq=range(3), s=[7])
    assert grid.count() == 81 and grid.rdd.getNumPartitions() == 1
    scores = spark.createDataFrame([("a", 2, 1.0), ("a", 1, 1.0), ("a", 3, 0.5), ("b", 5, 2.0), ("b", 4, 2.0)],
                                   "series_id string, k int, score double")
    best = {r.series_id: r.k for r in X.best_by_score(scores, "score", ["k"]).collect()}
    assert best == {"a": 3, "b": 4}
    ev = spark.createDataFrame([("a", 1.0, 2.0), ("a", 3.0, 1.0)], "series_id string, y double, yhat double")
    assert X.mae(ev).first().mae == 1.5
    assert abs(X.rmse(ev).first().rmse - math.sqrt(2.5)) < 1e-12


def test_difference_series(spark):
    ys = [float(i * i) for i in range(12)]
    s = _series(spark, [("a", d, y) for d, y in zip(_days(12), ys)])
    out = sorted(X.difference_series(s, 1, 1, 7).collect(), key=lambda r: r.ds)
    d1 = [None] + [ys[i] - ys[i - 1] for i in range(1, 12)]
    assert [r.d1 for r in out] == d1
    assert out[8].sd1 == d1[8] - d1[1] and out[7].sd1 is None


def _trend_weekly(n, slope=2.0, amp=10.0):
    return [100.0 + slope * i + amp * math.sin(2 * math.pi * (d.toordinal() % 7) / 7) for i, d in enumerate(_days(n))]


def test_trend_seasonal_recovers_signal_and_parts_sum(spark):
    ys = _trend_weekly(140)
    s = _series(spark, [("a", d, y) for d, y in zip(_days(140), ys)])
    split = X.ordered_split(s, 0.75)
    fc = FC.forecast_trend_seasonal(split, periods=16, components=True, changepoint_penalty=10.0)
    rows = {r.ds: r for r in fc.collect()}
    assert len(rows) == 105 + 16
    truth = dict(zip(_days(140), ys))
    err = [abs(rows[d].yhat - truth[d]) for d in rows if d in truth]
    assert np.mean(err) < 1.0  # noise-free signal is recovered closely
    for r in rows.values():
        assert abs(r.trend + r.weekly + r.yearly - r.yhat) < 1e-6
        assert r.yhat_lower <= r.yhat <= r.yhat_upper


def test_regressor_enters_the_fit(spark):
    n = 120
    xs = [float((i * 7919) % 13) for i in range(n)]
    ys = [50.0 + 3.0 * x for x in xs]
    s = _series(spark, [("a", d, y) for d, y in zip(_days(n), ys)])
    regs = spark.createDataFrame([("a", d, x) for d, x in zip(_days(n + 10), xs + [1.0] * 10)], "series_id string, ds date, x double")
    fc = FC.forecast_trend_seasonal(X.ordered_split(s, 0.75), periods=10, regressors=regs, regressor_cols=["x"], changepoint_penalty=10.0)
    got = {r.ds: r.yhat for r in fc.collect()}
    truth = dict(zip(_days(n), ys))
    assert np.mean([abs(got[d] - truth[d]) for d in got if d in truth]) < 1.0


def _ar1(n, phi, c, seed):
    rng = np.random.default_rng(seed)
    y = [c / (1 - phi)]
    for _ in range(n - 1):
        y.append(c + phi * y[-1] + rng.normal())
    return y


def test_adf_separates_stationary_and_random_walk(spark):
    rng = np.random.default_rng(3)
    walk = np.cumsum(rng.normal(size=400)).tolist()
    stat = _ar1(400, 0.3, 5.0, 4)
    s = _series(spark, [("walk", d, y) for d, y in zip(_days(400), walk)] + [("stat", d, y) for d, y in zip(_days(400), stat)])
    out = {r.series_id: r for r in FC.adf_statistic(s).collect()}
    assert out["stat"].d == 0 and out["stat"].adf < -2.86
    assert out["walk"].d == 1


def test_arima_search_and_forecast_recursion(spark):
    ys = _ar1(600, 0.6, 4.0, 7)
    s = _series(spark, [("a", d, y) for d, y in zip(_days(600), ys)])
    orders = spark.createDataFrame([("a", 1, 0, 0)], "series_id string, p int, d int, q int")
    split = X.ordered_split(s, 0.75)
    fc = sorted(FC.arima_forecast(split, steps_extra=2, orders=orders).collect(), key=lambda r: r.step)
    assert len(fc) == 151 + 2
    c, phi = fc[0].coef[0], fc[0].coef[1]
    assert abs(phi - 0.6) < 0.1
    last = sorted((r for r in split.collect() if r.set == "train"), key=lambda r: r.ds)[-1].y
    assert abs(fc[0].yhat - (c + phi * last)) < 1e-9
    assert abs(fc[1].yhat - (c + phi * fc[0].yhat)) < 1e-9
    searched = FC.arma_order_search(split.where("set = 'train'").select("series_id", "ds", "y")).first()
    assert searched.p + searched.q >= 1 and math.isfinite(searched.aic)


def test_sarimax_grid_and_forecast(spark):
    n = 200
    ys = [v + 5 * math.sin(2 * math.pi * (i % 7) / 7) for i, v in enumerate(_ar1(n, 0.5, 2.0, 11))]
    xs = [float(i % 5) for i in range(n)]
    df = spark.createDataFrame([("a", d, y, x) for d, y, x in zip(_days(n), ys, xs)], "series_id string, ds date, y double, x double")
    split = X.ordered_split(df, 0.75)
    best = FC.sarimax_grid_search(split.where("set = 'train'"), exog=["x"]).first()
    assert best.order.count(",") == 6 and math.isfinite(best.aic)
    fc = FC.sarimax_forecast(split, exog=["x"])
    # the first test row repeats the last training row: by date it is no forecast day
    assert fc.count() == split.where("set = 'test'").count() - 1
    assert FC.sarimax_forecast(split, exog=["x"], align="position").count() == fc.count() + 1
    assert fc.where(F.col("yhat").isNull() | F.isnan("yhat")).count() == 0


def test_day_boundaries_follow_a_time_zone(spark):
    from dailywire.operators import daily as D

    rows = spark.createDataFrame([(dt.datetime(2022, 11, 2, 20, 0), 1.0), (dt.datetime(2022, 11, 2, 10, 0), 3.0)], "ts timestamp_ntz, v double")
    plain = {r.datetime: r.v for r in D.daily_mean(rows, "ts", ["v"]).collect()}
    assert plain == {dt.date(2022, 11, 2): 2.0}
    shifted = {r.datetime: r.v for r in D.daily_mean(rows, "ts", ["v"], source_tz="UTC", target_tz="Asia/Hong_Kong").collect()}
    assert shifted == {dt.date(2022, 11, 3): 1.0, dt.date(2022, 11, 2): 3.0}


def test_rescale_and_variable_series(spark):
    from dailywire.operators import daily as D

    df = spark.createDataFrame([(1, 0.0, 10.0), (2, 5.0, 30.0), (3, 10.0, 20.0)], "d int, x double, y double")
    out = {r.d: r.scaled for r in D.rescale_to_range(df, "x", "y").collect()}
    assert out == {1: 10.0, 2: 20.0, 3: 30.0}
    flat = spark.createDataFrame([(1, 4.0, 10.0), (2, 4.0, 30.0)], "d int, x double, y double")
    assert {r.scaled for r in D.rescale_to_range(flat, "x", "y").collect()} == {20.0}  # constant -> midpoint
    long = D.select_variable_series(df, "d", ["x", "y"], variable="y").collect()
    assert sorted((r.d, r.value) for r in long) == [(1, 10.0), (2, 30.0), (3, 20.0)]


def test_sarimax_short_series_gets_status_row(spark):
    rows = [("long", d, float(v)) for d, v in zip(_days(120), _ar1(120, 0.5, 2.0, 5))] + [("short", d, 1.0 + i) for i, d in enumerate(_days(5))]
    s = _series(spark, rows)
    out = {r.series_id: r for r in FC.sarimax_grid_search(s).collect()}
    assert out["long"].status == "ok" and out["long"].order is not None
    assert out["short"].order is None and out["short"].status.startswith("no fit")


def test_forecast_days_follow_the_training_days(spark):
    """A series that rises 10 a day (with a weekly wave) is forecast on its days, not one day late."""
    ys = [100 + 10.0 * i + 3 * math.sin(2 * math.pi * i / 7) + 0.3 * math.sin(i * i) for i in range(160)]
    df = spark.createDataFrame([("a", d, y, 0.0) for d, y in zip(_days(160), ys)], "series_id string, ds date, y double, x double")
    rows = FC.sarimax_forecast(X.ordered_split(df, 0.75)).orderBy("ds").collect()
    assert all(abs(r.y - r.yhat) < 6 for r in rows[:5])


def test_series_without_a_fit_keep_a_row(spark):
    rows = [("long", d, float(i % 9 + i), 0.0) for i, d in enumerate(_days(120))] + [("short", d, 1.0, 0.0) for d in _days(3)]
    split = X.ordered_split(spark.createDataFrame(rows, "series_id string, ds date, y double, x double"), 0.75)
    train = split.where("set = 'train'")
    for out in (FC.arma_order_search(train.select("series_id", "ds", "y")), FC.arima_forecast(split), FC.adf_statistic(train)):
        status = {r.series_id: r.status for r in out.collect()}
        assert status["long"] == "ok" and status["short"] == FC.NO_FIT
    assert {r.status for r in FC.forecast_trend_seasonal(split).where("series_id = 'long'").collect()} == {"ok"}
    assert {r.series_id for r in FC.forecast_trend_seasonal(split).collect()} == {"long", "short"}


def test_unit_root_order(spark):
    import datetime as dt

    import numpy as np

    from dailywire.operators import forecast as FC

    rng = np.random.default_rng(6)  # with seed 4 the walk itself is rejected (-2.899), one of the five in a hundred
    shocks = rng.normal(size=(3, 400))
    noise = np.zeros(400)
    for i in range(1, 400):
        noise[i] = 0.5 * noise[i - 1] + shocks[0, i]
    series = {"still": 50 + noise, "walk": shocks[1].cumsum(), "sums": shocks[2].cumsum().cumsum(), "flat": np.ones(40), "short": np.arange(3.0)}
    day = dt.date(2020, 1, 1)
    rows = [(k, day + dt.timedelta(i), float(v)) for k, y in series.items() for i, v in enumerate(y)]
    got = {r.series_id: r for r in FC.unit_root_order(spark.createDataFrame(rows, "series_id string, ds date, y double")).collect()}
    assert {k: r.d for k, r in got.items()} == {"still": 0, "walk": 1, "sums": 2, "flat": None, "short": None}
    assert got["short"].status != "ok" and got["walk"].status == "ok"
    # the statistic of the chosen lags by plain least squares
    y, lags = series["still"], got["still"].lags
    d = np.diff(y)
    x = np.column_stack([np.ones(396), y[3:-1], *[d[3 - j : 399 - j] for j in range(1, lags + 1)]])
    b, rss, *_ = np.linalg.lstsq(x, d[3:], rcond=None)
    se = np.sqrt(rss[0] / (396 - x.shape[1]) * np.linalg.inv(x.T @ x)[1, 1])
    assert abs(got["still"].adf - b[1] / se) < 1e-6 and got["still"].n == 396
    bound = -2.86154 - 2.8903 / 396 - 4.234 / 396**2 - 40.04 / 396**3
    assert abs(got["still"].bound - bound) < 1e-12
