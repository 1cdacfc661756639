"""Panel operators on the hand-made edge cases."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidegrid.config import PanelConfig
from tidegrid.operators import flags, impute, panel

D = dt.date


def rows(df, *by):
    return [tuple(r) for r in df.orderBy(*by).collect()]


def series(spark, values, start=D(2024, 1, 1), step=7, kind="double"):
    values = [float(v) if isinstance(v, int) and kind == "double" else v for v in values]
    return spark.createDataFrame([("a", start + dt.timedelta(days=step * i), v) for i, v in enumerate(values)], f"g string, ds date, y {kind}")


def test_period_and_key(spark):
    df = spark.createDataFrame([("2024-01-31", "a", None), ("no date", "b", "c"), (None, None, None)], "date string, k1 string, k2 string")
    out = panel.composite_key(panel.add_period(df, "date", "month"), ["k1", "k2"], "g")
    assert sorted([(r.ds, r.g) for r in out.collect()], key=str) == [(None, ""), (None, "b|c"), (D(2024, 1, 1), "a")]
    assert panel.add_period(df, "date", "week").where("ds is not null").first().ds == D(2024, 1, 29)
    with pytest.raises(ValueError):
        panel.add_period(df, "nothing")


def test_clean_and_periods(spark):
    df = spark.createDataFrame([("a", 1.0, 0.0, "x"), ("a", 1.0, 0.0, "x"), ("b", 2.0, 3.0, None), ("b", 4.0, 1.0, "z")], "g string, p double, v double, dim string").withColumn("date", F.lit("2024-01-02"))
    cfg = PanelConfig(raw_value="v", group="g")
    out = panel.add_period(panel.clean(df, cfg), "date")
    got = rows(panel.to_periods(out, "g", "ds", "y", "p", ["dim"]).select("g", "y", "product_wavg_unit_price", "dim"), "g")
    assert got == [("a", 0.0, None, "x"), ("b", 4.0, 2.5, "z")]
    with pytest.raises(ValueError):
        panel.clean(df.withColumn("y", F.lit(1)), cfg)


def test_fill_gaps(spark):
    df = spark.createDataFrame([("a", D(2024, 1, 1), 1), ("a", D(2024, 1, 22), 2), ("a", D(2024, 1, 9), 9), ("b", D(2024, 2, 5), None), (None, D(2024, 1, 1), 3), ("c", None, 4)], "g string, ds date, y int")
    out = panel.fill_gaps(df, "g", "ds", "week")
    assert rows(out, "g", "ds") == [("a", D(2024, 1, 1), 1), ("a", D(2024, 1, 8), None), ("a", D(2024, 1, 15), None), ("a", D(2024, 1, 22), 2), ("b", D(2024, 2, 5), None)]
    assert rows(panel.fill_gaps(out, "g", "ds", "week"), "g", "ds") == rows(out, "g", "ds")
    m = spark.createDataFrame([("a", D(2023, 11, 1), 1), ("a", D(2024, 2, 1), 2)], "g string, ds date, y int")
    assert [r[1].month for r in rows(panel.fill_gaps(m, "g", "ds", "month"), "ds")] == [11, 12, 1, 2]
    assert panel.fill_gaps(m.limit(0), "g", "ds").count() == 0
    with pytest.raises(ValueError):
        panel.fill_gaps(m, "g", "ds", "day")


@pytest.mark.parametrize("values, was, upto", [([1, 0, 0, 0], True, 3), ([1, None, 0, None, 5], True, 3), ([1, 0, 0, 1, 0], False, None)])
def test_inactivity(spark, values, was, upto):
    out = flags.inactivity(series(spark, values), "y", "ds", "g", 3).orderBy("ds").collect()
    assert {r.iswas_inactive for r in out} == {was} and {r.never_inactive for r in out} == {not was}
    assert [i for i, r in enumerate(out) if r.precedes_inactive_period] == ([] if upto is None else list(range(upto + 1)))
    assert [r.is_inactive for r in out] == [int(not v) for v in values]


def test_obsolete_and_drop(spark):
    both = series(spark, [1, 1]).unionByName(series(spark, [1] * 8).withColumn("g", F.lit("b")))
    out = flags.inactivity(both, "y", "ds", "g", 3)
    assert {r.g: r.is_obsolete for r in out.collect()} == {"a": True, "b": False}
    assert {r.g for r in flags.inactivity(both, "y", "ds", "g", 3, drop=True).collect()} == {"b"}
    with pytest.raises(ValueError):
        flags.inactivity(both, "y", "ds", "g", 0)


def test_dims(spark):
    df = series(spark, [None, "x", None, "y", None], kind="string")
    assert [r.y for r in flags.fill_dims(df, ["y"], "ds", "g").orderBy("ds").collect()] == ["y", "x", "x", "y", "y"]
    assert [r.y for r in flags.fill_dims(df, ["y"], "ds", "g", "nearest").orderBy("ds").collect()] == ["x", "x", "x", "y", "y"]


def test_outliers(spark):
    one = flags.outliers(series(spark, [5.0]), ["y"], "g").first()
    assert (one.y_is_outlier, one.y_clean) == (False, 5.0)
    assert flags.outliers(series(spark, [2e5]), ["y"], "g").first().y_clean is None
    out = flags.outliers(series(spark, [1.0, 2.0] * 10 + [100.0, None]), ["y"], "g").orderBy("ds").collect()
    assert [r.y_is_outlier for r in out] == [False] * 20 + [True, False]


def test_lengths(spark):
    df = series(spark, [None, None]).unionByName(series(spark, [1.0, None]).withColumn("g", F.lit("b")))
    assert {r.g for r in flags.enough_data(df, "y", "g", 1).collect()} == {"b"}
    out = flags.short_flag(df, "ds", "g", 3).first()
    assert (out.series_length, out.is_short_series) == (2, True)


@pytest.mark.parametrize("method", ["linear", "polynomial", "spline"])
def test_interpolation(spark, method):
    out = impute.interpolate(series(spark, [None, 10.0, None, 40.0, None]), ["y"], "ds", "g", method).orderBy("ds").collect()
    assert [r.y_int for r in out] == [10, 10, 25, 40, 40]
    cubic = [float(i**3) for i in range(12)]
    out = impute.interpolate(series(spark, [v if i not in (4, 5) else None for i, v in enumerate(cubic)]), ["y"], "ds", "g", method).orderBy("ds").collect()
    if method != "linear":
        assert [r.y_int for r in out] == pytest.approx(cubic)
    assert [r.y_int for r in impute.interpolate(series(spark, [None, None]), ["y"], "ds", "g", method).collect()] == [None, None]


def test_config():
    for bad in ({"granularity": "day"}, {"interpolation": "none"}, {"short_threshold": 0}):
        with pytest.raises(ValueError):
            PanelConfig(**bad)
