"""Forecasts, evaluation, transforms, dashboard tables, retrieval."""

import datetime as dt
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidegrid.config import EvalConfig, ForecastConfig, Settings
from tidegrid.functions import kernels
from tidegrid.operators import artifacts, diagnostics, evaluate, forecast, retrieval, transform
from tests.test_panel import D, series


def test_split(spark):
    df = series(spark, [float(i) for i in range(10)])
    train, test = forecast.split_by_time(df.unionByName(df.limit(1).withColumn("ds", F.lit(None).cast("date"))), "ds", 3)
    assert (train.count(), test.count()) == (7, 3)
    with pytest.raises(ValueError):
        forecast.split_by_time(df, "ds", 0)


@pytest.mark.parametrize("anchor, days", [("panel", [15, 22, 29]), ("sunday", [21, 28, 35])])
def test_anchor(spark, anchor, days):
    cfg = ForecastConfig(horizon=3, target="y", group="g", week_anchor=anchor)
    out = forecast.naive(series(spark, [1.0, 2.0]), cfg).orderBy("ds").collect()
    assert [(r.ds - D(2024, 1, 1)).days + 1 for r in out] == days and {r.y_hat for r in out} == {2.0}


def test_seasonal_naive(spark):
    cfg = ForecastConfig(horizon=5, target="y", group="g")
    assert [r.y_hat for r in forecast.seasonal_naive(series(spark, [7.0, 8.0, 9.0]), cfg).orderBy("ds").collect()] == [7, 8, 9, 7, 8]


def test_long_forecast_recovers_season_and_line(spark):
    y = [50 + 0.5 * i + 8 * math.sin(2 * math.pi * i / 12) for i in range(96)]
    cfg = ForecastConfig(horizon=12, seasonal_period=12, min_history=24, target="y", group="g")
    both = series(spark, y).unionByName(series(spark, [3.0] * 96).withColumn("g", F.lit("flat"))).unionByName(series(spark, [1.0, 2.0]).withColumn("g", F.lit("short")))
    out = forecast.long_forecast(both, cfg).orderBy("g", "ds").toPandas()
    a = out[out.g == "a"]
    want = [50 + 0.5 * i + 8 * math.sin(2 * math.pi * i / 12) for i in range(96, 108)]
    assert np.abs(a.y_hat.to_numpy() - want).max() < 1.0 and (a.y_hat_lower <= a.y_hat).all()
    assert set(out[out.g == "flat"].fallback_reason) == {"constant"} and set(out[out.g == "flat"].y_hat) == {3.0}
    assert set(out[out.g == "short"].method) == {"naive"}


def test_strategies(spark):
    df = series(spark, [1.0, 4.0]).withColumn("is_short_series", F.lit(True))
    for s, method in (("naive", "naive"), ("comp_based", "naive"), ("seasonal_naive", "seasonal_naive")):
        got = forecast.panel_forecast(df, ForecastConfig(horizon=2, target="y", group="g", short_strategy=s)).collect()
        assert {r.method for r in got} == {method} and len(got) == 2


def test_boxcox(spark):
    rng = np.random.default_rng(1)
    assert abs(kernels.boxcox_lambda(np.exp(rng.normal(1, 0.4, 4000)))) < 0.05
    frames = {"pos": list(np.exp(rng.normal(1, 0.4, 200))), "zero": [0.0, 1.0, 2.0], "const": [5.0, 5.0, None], "none": [None]}
    df = spark.createDataFrame([(g, i, None if v is None else float(v)) for g, vs in frames.items() for i, v in enumerate(vs)], "g string, i int, y double")
    out = transform.boxcox_transform(df, "g", "y").toPandas()
    assert out[out.g == "zero"].y_transformed.tolist() == [0, 1, 2] and out[out.g == "zero"].series_lambda.isna().all()
    c = out[out.g == "const"].sort_values("i")
    assert c.is_constant.tolist() == [True, True, False] and c.y_transformed.isna().tolist() == [False, False, True]
    back = transform.inverse_boxcox(spark.createDataFrame(out[out.g == "pos"]), ["y_transformed"]).toPandas()
    assert np.allclose(back.y_transformed, back.y)
    with pytest.raises(ValueError):
        transform.inverse_boxcox(df, [])


def _aligned(spark, pairs):
    return spark.createDataFrame([("a", i, None if y is None else float(y), None if f is None else float(f)) for i, (y, f) in enumerate(pairs)], "time_series_id string, ds int, y double, y_hat double")


def test_metrics(spark):
    m = evaluate.as_dict(evaluate.panel_metrics(_aligned(spark, [(0, 1), (10, 8)])))
    assert (m["wape"], m["mae"], m["mape"], m["n_rows"]) == pytest.approx((0.3, 1.5, 0.2, 2))
    m = evaluate.as_dict(evaluate.panel_metrics(_aligned(spark, [(10, 9), (10, None)])))
    assert (m["wape"], m["mae"]) == pytest.approx((0.05, 1.0))
    assert math.isnan(evaluate.as_dict(evaluate.panel_metrics(_aligned(spark, [(0, 1)])))["wape"])
    with pytest.raises(ValueError):
        evaluate.require_overlap(_aligned(spark, [(1, 1)]).limit(0))


def test_coverage_and_flag(spark):
    df = spark.createDataFrame([("a", 1.0, 1.0, 2.0, True), ("a", 2.0, 1.0, 2.0, False), ("a", 3.0, 1.0, 2.0, None), ("a", None, 1.0, 2.0, None)], "time_series_id string, y double, y_hat_lower double, y_hat_upper double, is_short_series boolean").withColumn("y_hat", F.lit(1.5))
    c = evaluate.coverage(df, EvalConfig()).first()
    assert (c.inside, c.below, c.above) == pytest.approx((2 / 3, 0, 1 / 3)) and c.n_rows == 3
    assert evaluate.series_metrics(df.limit(2)).first().is_short_series is False


@pytest.mark.parametrize("pct, level", [(2.99, "low"), (3.0, "moderate"), (5.0, "high"), (10.0, "very_high")])
def test_levels(spark, pct, level):
    assert spark.range(1).select(diagnostics.warn_level(F.lit(pct)).alias("l")).first().l == level


def test_no_short_series(spark):
    r = diagnostics.short_report_of(series(spark, [1.0]).withColumn("is_short_series", F.lit(False)), group="g", value="y")
    assert (r.short_series, r.total_volume_window, r.warning_level) == (0, 0.0, "none")


@pytest.mark.parametrize("values", [[1.0, 2.0, 2.5, 9.0, 10.0], [4.0, 4.0]])
def test_histogram(spark, values):
    got = diagnostics.histogram(series(spark, [*values, None, float("nan"), float("inf")]), "y", 20).orderBy("bin").collect()
    assert [r.n for r in got] == np.histogram(values, 20)[0].tolist()


def test_artifacts(spark):
    df = spark.createDataFrame([("a", 1, "x", 10.0, 8.0), ("b", 1, "y", 0.0, 1.0), ("c", 2, "x", 5.0, 5.0)], "time_series_id string, ds int, dim string, y double, y_hat double")
    c = artifacts.error_contribution(df, "ds", "dim").toPandas()
    assert c[c.ds == 1].error_share.sum() == pytest.approx(1) and c[c.ds == 2].error_share.isna().all()
    out = artifacts.top_traces(df, "time_series_id", "y", 1, "Other").toPandas()
    assert sorted(out.time_series_id) == ["Other", "Other", "a"] and out.is_limited.all()
    assert artifacts.metrics_by_slice(df, ["dim"]).where("dim = 'y'").first().n_excluded == 1


def test_retrieval(spark):
    files = spark.createDataFrame([("f", "import x\ndef a(z):\n  1\nclass B:\n  2"), ("g", "no start"), ("h", " \n "), ("i", None)], "file_path string, text string")
    got = {r.id: (r.object_name, r.text) for r in retrieval.structural_chunks(files).collect()}
    assert got == {"f:2-3": ("a", "def a(z):\n  1"), "f:4-5": ("B", "class B:\n  2"), "g:1-1": (None, "no start")}
    long = spark.createDataFrame([("k", "x" * 3700), ("s", "y")], "id string, text string")
    assert {r.id: len(r.text) for r in retrieval.overlapping_parts(long).collect()} == {"k#part1": 2000, "k#part2": 1900, "k#part3": 100, "s": 1}
    assert retrieval.embed(files).where("text is null").first().embedding is None
    assert retrieval.chat_messages("s", [("q", "a")], "c", "?", 0)[-1]["content"].endswith("?")


def test_settings(tmp_path):
    (tmp_path / ".env").write_text("APP_LOG_LEVEL=DEBUG\n# x\n")
    assert Settings.load(env_file=str(tmp_path / ".env"), environ={"APP_ENVIRONMENT": "prod"}) == Settings("prod", "DEBUG")


def test_stl_parts_add_up():
    y = np.sin(np.arange(60)) + np.arange(60)
    assert np.allclose(sum(kernels.stl(y, 12)), y)
    with pytest.raises(ValueError):
        kernels.stl(y[:20], 12)


def test_linear_matches_pandas(spark):
    from tidegrid.operators.impute import interpolate

    rng = np.random.default_rng(3)
    y = [None if rng.random() < 0.4 else float(v) for v in rng.normal(size=80)]
    got = [r.y_int for r in interpolate(series(spark, y), ["y"], "ds", "g").orderBy("ds").collect()]
    want = pd.Series(y, dtype=float).interpolate().ffill().bfill()
    assert got == pytest.approx(want.tolist())


def test_a_series_that_fails_gets_the_naive_forecast(monkeypatch):
    cfg = ForecastConfig(horizon=3, granularity="month", seasonal_period=4, min_history=8)
    y = 10 + np.sin(np.arange(24) * np.pi / 2) + np.arange(24) * 0.1
    hat, half, reason = forecast.one_series(y, y, cfg)
    assert reason is None and len(hat) == 3 and half > 0

    def broken(*_):
        raise ZeroDivisionError("poisoned")

    monkeypatch.setattr(forecast, "stl", broken)
    hat, half, reason = forecast.one_series(y, y, cfg)
    assert reason == "ZeroDivisionError: poisoned" and hat.tolist() == [y[-1]] * 3 and half == 0


def test_a_poisoned_series_does_not_stop_the_others(spark):
    cfg = ForecastConfig(horizon=2, granularity="month", seasonal_period=4, min_history=8, target="y")
    days = pd.date_range("2020-01-01", periods=24, freq="MS").date
    rows = [("good", d, float(10 + i % 4 + i * 0.1)) for i, d in enumerate(days)] + [("bad", d, (-1.0) ** i * 1.7e308) for i, d in enumerate(days)]
    got = forecast.long_forecast(spark.createDataFrame(rows, "time_series_id string, ds date, y double"), cfg).toPandas()
    assert got.groupby("time_series_id").method.first().to_dict() == {"good": "stl_holt", "bad": "naive"} and got[got.time_series_id == "bad"].fallback_reason.notna().all()


def test_unique_keys(spark):
    df = spark.createDataFrame([("a", "2024-01-01", 1.0), ("a", "2024-01-01", 2.0)], "time_series_id string, ds string, y double")
    assert evaluate.require_unique(df.limit(1)) is not None
    with pytest.raises(ValueError, match="2 rows"):
        evaluate.require_unique(df)
