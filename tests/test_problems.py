"""The general data problems against brute force, and on nulls, ties, copies, empty tables and clashing names."""

import datetime as dt
import decimal
import math

import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidegrid.functions.forest import isolation_scores
from tidegrid.functions.kprototypes import kprototypes
from tidegrid.operators import fill, grid, profile, rolling, spikes

D0 = dt.date(2023, 1, 1)
NAN = float("nan")


# 1: rolling totals

@given(st.lists(st.tuples(st.integers(0, 63), st.integers(0, 63)), min_size=1, max_size=30))
@settings(deadline=None, max_examples=30)
def test_tree_ranges(spans):
    x = np.arange(64.0) ** 2
    tree = rolling.build(x[None])
    lo, hi = (np.array(c) for c in zip(*spans))
    assert rolling.query(tree, np.zeros(len(lo), int), lo, hi).tolist() == [x[a : b + 1].sum() for a, b in spans]


def _messy(spark, seed=0):
    rng = np.random.default_rng(seed)
    rows, key = [], 0
    for g in ("a", "b", "c"):
        for day in np.sort(rng.choice(400 if g != "b" else 900, 90, replace=False)):
            key += 1
            v = rng.choice([None, NAN, 0.0, 1.5, float(rng.integers(100))])
            rows += [(key, g, D0 + dt.timedelta(days=int(day)), v)] * int(rng.choice([1, 1, 1, 2]))
    rows += [(1000, None, D0, 1.0), (1001, "a", None, 1.0), (1002, "n", D0, None), (1003, "n", D0, 2.0)]
    return spark.createDataFrame(rows, "row_id long, entity string, ds date, y double").withColumns({"day": F.lit("x"), "s": F.lit(1), "shard": F.lit(None).cast("string")})


def test_rolling_against_brute_force(spark):
    df = _messy(spark)
    got = rolling.rolling_totals(df, "entity", "ds", "y", (7, 30), ["row_id"]).toPandas()
    p = df.select("row_id", "entity", "ds", "y").dropDuplicates().dropna(subset=["entity", "ds"]).toPandas()
    n = 0
    for g, d in p.groupby("entity"):
        mine = got[got.entity == g].set_index("ds")
        days = pd.date_range(d.ds.min(), d.ds.max()).date
        assert sorted(mine.index) == list(days)
        for day in days:
            for k in (7, 30):
                v = d[(d.ds <= day) & (d.ds > day - dt.timedelta(days=k))].y.dropna()
                assert mine.loc[day, f"count_{k}"] == len(v) and mine.loc[day, f"total_{k}"] == pytest.approx(v.sum())
                assert math.isnan(mine.loc[day, f"avg_{k}"]) if not len(v) else mine.loc[day, f"avg_{k}"] == pytest.approx(v.mean())
                n += 1
    assert n > 1000 and set(got.entity) == {"a", "b", "c", "n"}


def test_rolling_empty_and_bad(spark):
    df = _messy(spark)
    assert rolling.rolling_totals(df.limit(0), "entity", "ds", "y").count() == 0
    for periods in ((), (0,), (7, -1)):
        with pytest.raises(ValueError):
            rolling.rolling_totals(df, "entity", "ds", "y", periods)


def test_late_corrections(spark):
    daily = rolling.daily_totals(_messy(spark), "entity", "ds", "y", ["row_id"])
    late = spark.createDataFrame([("a", 19400, 5.0, 1), ("a", 19400, 2.0, 1), ("z", 3, 1.0, 1), (None, 3, 1.0, 1)], "entity string, day int, s double, c int")
    trees = rolling.correct_trees(rolling.build_trees(daily), late)
    want = rolling.build_trees(daily.unionByName(late.dropna()).groupBy("entity", "day").agg(F.sum("s").alias("s"), F.sum("c").cast("int").alias("c")))
    key = lambda df: sorted((r.entity, r.shard, [round(x, 6) for x in r.sums], r.counts) for r in df.collect())
    assert key(trees) == key(want)
    assert rolling.tree_days(trees).where("entity = 'z'").first().s == 1.0


# 2: profiles

def _loads(spark):
    rows = []
    for load in range(1, 7):
        for i in range(20):
            gone = load == 3 and i < 12
            rows.append((load, None if gone and i % 2 else NAN if gone else float(i) + (0.25 if load != 5 else 0.0), "Jan" if i or load != 2 else "jan", load == 6))
    return spark.createDataFrame(rows, "load_id int, num double, month string, flag boolean").withColumns({"text": F.lit("clash"), "n": F.lit(1)})


def test_profile(spark):
    rules = (profile.Rule("num", None, profile.DECIMALS), profile.Rule("month", "Jan|Feb", profile.texts("Jan", "Feb")), profile.Rule("flag", None, profile.TRUE))
    df = _loads(spark)
    got = {(r.column_name, r.load_id, r.kind) for r in profile.departures(profile.load_profile(profile.value_counts(df, "load_id", ["num", "month", "flag"]), rules)).collect()}
    assert got == {("num", 3, "missing"), ("num", 5, "shift"), ("month", 2, "domain"), ("flag", 6, "shift")}
    full = profile.quality_profile(df, "load_id", ["num", "month", "flag", "text"], rules).toPandas().set_index(["column_name", "load_id"])
    r = full.loc[("num", 3)]
    assert (r.n_rows, r.n_missing, r.n_distinct, r.min_value, r.max_value, r.departs) == (20, 12, 8, "12.25", "19.25", "missing")
    assert full.loc[("flag", 6)].psi > 5 * full.loc[("flag", 1)].psi > 0 and full.loc[("text", 1)].psi == pytest.approx(0, abs=1e-3)
    assert profile.quality_profile(df.limit(0), "load_id", ["num"], rules).count() == 0


def test_profile_of_nothing_but_nulls(spark):
    df = spark.createDataFrame([(None, None), (1, None)], "load_id int, num double")
    out = profile.load_profile(profile.value_counts(df, "load_id", ["num"])).collect()
    assert {(r.load_id, r.n_rows, r.n_missing, r.n_distinct) for r in out} == {(None, 1, 1, 0), (1, 1, 1, 0)}
    assert profile.departures(profile.load_profile(profile.value_counts(df, "load_id", ["num"]), (profile.Rule("num", None, profile.DECIMALS),))).count() == 0


def test_profile_of_whole_and_decimal_numbers(spark):
    rows = [(load, i * (10 if load == 3 else 1), (1 << 53) + i % 2, decimal.Decimal(i - 50) / 4) for load in range(1, 6) for i in range(1, 121)] + [(1, -18816, None, None)]
    df = spark.createDataFrame(rows, "load_id int, y int, big long, price decimal(38,2)").withColumn("wide", F.expr("cast(price as decimal(38,30))"))
    full = profile.quality_profile(df, "load_id", ["y", "big", "price", "wide"], (profile.Rule("y", "[0-9]{1,2}"),)).toPandas().set_index(["column_name", "load_id"])
    span = lambda c, load: (full.loc[(c, load)].min_value, full.loc[(c, load)].max_value)
    assert span("y", 1) == ("-18816", "120") and span("y", 2) == ("1", "120") and span("y", 3) == ("10", "1200")
    assert span("big", 2) == ("9007199254740992", "9007199254740993") and full.loc[("big", 2)].n_distinct == 2
    assert span("price", 2) == ("-12.25", "17.50") and [decimal.Decimal(v) for v in span("wide", 2)] == [decimal.Decimal("-12.25"), decimal.Decimal("17.5")]
    assert full.loc[("y", 3)].psi > 5 and full.loc[("y", 3)].psi > 5 * full.loc[("y", 2)].psi
    assert full.loc[("y", 1)].n_ill_formed == 22 and full.loc[("y", 3)].n_ill_formed == 111


def _departing(df, columns):
    return {(r.column_name, r.load_id, r.departs) for r in profile.quality_profile(df, "load_id", columns).where("departs <> ''").collect()}


def test_distributions_depart_in_every_column(spark):
    rng = np.random.default_rng(6)
    rows = []
    for load in range(1, 13):
        for i in range(300):
            kind = rng.choice(["city", "mall"]) if load != 2 else "depot"
            y = int(rng.integers(1, 1000)) * (10 if load == 3 else 1)
            price = None if load == 4 and i < 45 else float(rng.integers(1, 50)) * (100 if load == 5 else 1)
            rows.append((load if load < 12 else None, str(kind), y, price, f"id{rng.integers(5000)}", bool(rng.random() < (1.0 if load in (6, 7, 8) else 0.4))))
    df = spark.createDataFrame(rows, "load_id int, kind string, y int, price double, id string, flag boolean")
    one = {("kind", 2, "distribution"), ("y", 3, "distribution"), ("price", 4, "distribution"), ("price", 5, "distribution"), *(("flag", n, "distribution") for n in (6, 7, 8))}
    assert _departing(df, ["kind", "y", "price", "id", "flag"]) == one
    assert _departing(df.where("load_id in (1, 2)"), ["kind", "y"]) == {("kind", 1, "distribution"), ("kind", 2, "distribution")}
    assert _departing(df.where("load_id = 2"), ["kind", "y"]) == set()
    few = df.withColumn("load_id", F.monotonically_increasing_id() % 200).where("kind <> 'depot'")  # loads of 16 rows that differ by chance
    assert len(_departing(few, ["kind", "id"])) <= 2


# 4: regular grid

def test_grid(spark):
    at = lambda d, h=12: dt.datetime(2024, 1, 1, h) + dt.timedelta(days=d)
    rows = [("s", at(0), 1), ("s", at(0, 20), 2), ("s", at(0, 20), 2), ("s", at(2), 5), ("s", at(3), None), ("s", at(4), 6), ("s", at(20), 7), ("s", None, 9), ("one", at(5), 4), (None, at(1), 1), ("never", at(1), None)]
    df = spark.createDataFrame(rows, "source string, ds timestamp_ntz, y int").withColumns({"day": F.lit(0), "t": F.lit(0), "v": F.lit(0), "own": F.lit(0)})
    got = grid.regular_days(df, "source", "ds", "y", 7).toPandas().sort_values(["source", "day"])
    s = got[got.source == "s"].reset_index(drop=True)
    assert len(s) == 21 and s.status.tolist()[:5] == ["observed", "filled", "observed", "filled", "observed"] and set(s.status[5:20]) == {"gap"}
    assert s.y[0] == 3 and s.n_readings[0] == 2 and 3 < s.y[1] < 5 < s.y[3] < 6 and s.y[5:20].isna().all()
    assert got[got.source == "one"].status.tolist() == ["observed"] and set(got.source) == {"s", "one"}
    assert grid.regular_days(df.limit(0), "source", "ds", "y").count() == 0


def test_grid_stays_within_neighbours(spark):
    rng = np.random.default_rng(2)
    days = np.sort(rng.choice(400, 120, replace=False))
    df = spark.createDataFrame([("a", dt.datetime(2024, 1, 1) + dt.timedelta(days=int(d)), float(v)) for d, v in zip(days, rng.normal(size=120))], "g string, ds timestamp_ntz, y double")
    out = grid.regular_days(df, "g", "ds", "y", 400).toPandas().sort_values("day")
    lo = np.fmin(out.y.where(out.status == "observed").ffill(), out.y.where(out.status == "observed").bfill())
    hi = np.fmax(out.y.where(out.status == "observed").ffill(), out.y.where(out.status == "observed").bfill())
    assert ((out.y >= lo - 1e-9) & (out.y <= hi + 1e-9)).all() and len(out) == days[-1] - days[0] + 1


# 5: spikes

def _readings(spark):
    rng = np.random.default_rng(4)
    rows, key = [], 0
    for g, level in (("a", 100.0), ("b", 5.0)):
        for i in range(700):
            key += 1
            rows.append([key, g, D0 + dt.timedelta(days=i), float(round(level * math.exp(rng.normal(0, 0.1)), 3))])
    rows[50][3], rows[300][3], rows[800][3], rows[900][3] = 500.0, 10.0, -1.0, 0.0
    for i in range(508, 516):  # a stuck stretch over the border of two shards
        rows[i][3] = 101.0
    rows += [[5000, "a", rows[50][2], 500.0], [50, "a", rows[50][2], 500.0], [6000, None, D0, 1.0], [6001, "a", None, 1.0], [6002, "a", D0, None], [6003, "a", D0, NAN]]
    rows += [[7000 + i, "same", D0 + dt.timedelta(days=i), 3.0] for i in range(30)]
    return spark.createDataFrame([tuple(r) for r in rows], "id long, g string, ds date, y double").withColumns({"t": F.lit(1), "v": F.lit("x"), "source": F.lit(2), "kind": F.lit("")})


def test_spikes(spark):
    df = _readings(spark)
    got = {r.row_key: r.kind for r in spikes.implausible_rows(df, "g", "ds", "y", "id").collect()}
    want = {51: "spike", 5000: "spike", 50: "spike", 301: "spike", 801: "impossible", **{i + 1: "frozen" for i in range(508, 516)}}
    assert got == want
    strict = {r.row_key for r in spikes.implausible_rows(df, "g", "ds", "y", "id", zero_ok=False).collect()}
    assert strict == {*want, 901}
    assert spikes.implausible_rows(df.limit(0), "g", "ds", "y", "id").count() == 0
    scored = spikes.score_readings(df, "g", "ds", "y").toPandas()
    assert len(scored) == 1430 and scored.score.between(0, 1).all()
    assert scored[scored.kind == "spike"].score.min() > scored[scored.kind == ""].score.quantile(0.9)


def test_levels_pass_quiet_days_at_a_border(spark):
    rng = np.random.default_rng(8)
    border = 19456  # of two shards
    quiet = [("week", d, 0.0 if border - 9 <= d < border or border + 5 <= d < border + 15 else float(rng.integers(1, 500))) for d in range(border - 40, border + 40)]
    empty = [("shard", d, float(rng.integers(1, 500))) for d in [*range(18900, 18944), *range(border, border + 20)]] + [("shard", d, -1.0 * (d % 20 > 0)) for d in range(18950, border, 10)]
    rows = quiet + empty
    df = spark.createDataFrame([(g, dt.date(1970, 1, 1) + dt.timedelta(days=d), v) for g, d, v in rows], "g string, ds date, y double")
    got = {(r.source, (r.t - dt.date(1970, 1, 1)).days): r.level for r in spikes.score_readings(df, "g", "ds", "y").collect()}
    assert len(got) == len(rows)
    for g in ("week", "shard"):
        p = sorted((d, v) for x, d, v in rows if x == g and v > 0)
        for i, (d, _) in enumerate(p):
            assert got[(g, d)] == np.median([v for _, v in p[max(i - 7, 0) : i] + p[i + 1 : i + 8]]), (g, d)


def test_forest_finds_the_far_point():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(300, 3))
    x[17] = 9
    s = isolation_scores(np.vstack([x, x[:40]]), np.repeat([0, 2], [300, 40]), 3)
    assert s[:300].argmax() == 17 and s[300:].argmax() == 17 and len(isolation_scores(x[:0], np.zeros(0, int), 1)) == 0
    assert np.allclose(isolation_scores(np.ones((5, 2)), np.zeros(5, int), 1), isolation_scores(np.ones((5, 2)), np.zeros(5, int), 1)[0])


# 7: filling

def test_fill_numbers(spark):
    rows = []
    for g in range(6):
        for i in range(120):
            day = D0 + dt.timedelta(days=i)
            rows.append((g * 1000 + i, f"s{g}", day, None if i % 10 == 3 else 10.0 * (g + 1) * (2 if day.weekday() > 4 else 1), "k"))
    rows += [rows[0], (9001, "empty", D0, None, None), (9002, None, D0, NAN, None), (9003, "s1", None, None, "k")]
    df = spark.createDataFrame(rows, "id long, g string, ds date, y double, dim string").withColumns({"v": F.lit(1), "cluster": F.lit(1), "level": F.lit("x")})
    got = fill.fill_numbers(df, "id", "g", "ds", "y", ["dim"]).toPandas()
    assert len(got) == 723 and got.row_key.is_unique and got[~got.is_filled].method.eq("observed").all()
    f = got[got.is_filled & got.source.fillna("").str.match("s\\d") & got.day.notna()]
    true = [10.0 * (int(s[1]) + 1) * (2 if d.weekday() > 4 else 1) for s, d in zip(f.source, f.day)]
    assert np.abs(f.v / true - 1).max() < 1e-9 and set(f.method) == {"entity month x cluster weekday"}
    assert got[got.row_key == 9001].v.notna().all() and got[got.row_key == 9002].method.tolist() == ["all"]
    nothing = fill.fill_numbers(df.where("id = 9001"), "id", "g", "ds", "y").toPandas()
    assert nothing.method.tolist() == ["none"] and nothing.v.isna().all()
    assert fill.fill_numbers(df.limit(0), "id", "g", "ds", "y").count() == 0


def test_fill_texts(spark):
    rows = [(1, "a", "City ", 1.0), (2, "a", "n/a", 1.0), (3, "a", None, 1.0), (4, "b", "mall", 9.0), (5, "b", "\tMALL\n", 9.0), (6, "c", "?", 9.0), (7, None, "", 1.0), (1, "a", "City ", 1.0)]
    df = spark.createDataFrame(rows, "id long, g string, kind string, y double").withColumns({"source": F.lit(0), "column_name": F.lit("x")})
    got = {r.row_key: (r.value, r.is_filled, r.method) for r in fill.fill_texts(df, "id", "g", {"kind": ("city", "mall")}, ["y"]).collect()}
    assert got[1] == ("city", False, "observed") and got[2] == got[3] == ("city", True, "entity") and got[5] == ("mall", False, "observed")
    assert got[6][:2] == ("mall", True) and got[6][2] == "cluster" and got[7][1] and len(got) == 7
    assert {r.value for r in fill.fill_texts(df.where("id = 6"), "id", "g", {"kind": ("city",)}).collect()} == {None}
    assert fill.fill_texts(df.limit(0), "id", "g", {"kind": ("city",)}).count() == 0


def test_kprototypes_separates(spark):
    df = spark.createDataFrame([(f"e{i}", float(i % 2) * 10 + 0.01 * i if i % 5 else None, "xy"[i % 2] if i % 7 else None) for i in range(60)], "source string, n double, c string")
    out = kprototypes(df, ["n"], ["c"], 2).toPandas()
    known = out[out.n.notna()]
    assert known.groupby(known.source.str[1:].astype(int) % 2).cluster.nunique().tolist() == [1, 1] and out.cluster.nunique() == 2


def test_long_periods_and_corrected_trees_against_brute_force(spark):
    """Periods over many shards, spans with empty shards between, answers from trees that were stored and corrected."""
    df = _messy(spark, 4)
    p = df.select("row_id", "entity", "ds", "y").dropDuplicates().dropna(subset=["entity", "ds"]).toPandas()
    periods = (1, 64, 65, 128, 200, 365)
    direct = rolling.rolling_totals(df, "entity", "ds", "y", periods, ["row_id"]).toPandas()
    daily = rolling.daily_totals(df, "entity", "ds", "y", ["row_id"])
    late = F.pmod(F.xxhash64("entity", "day"), F.lit(3)) == 0
    stored = rolling.correct_trees(rolling.build_trees(daily.where(~late)), daily.where(late))
    stored = rolling.rolling_from_trees(stored, periods, "entity", "ds").toPandas()
    for got in (direct, stored):
        got = got.set_index(["entity", "ds"])
        assert len(got) == sum((d.ds.max() - d.ds.min()).days + 1 for _, d in p.groupby("entity"))
        for (g, day), r in got.sample(200, random_state=1).iterrows():
            d = p[p.entity == g]
            for k in periods:
                v = d[(d.ds <= day) & (d.ds > day - dt.timedelta(days=k))].y.dropna()
                assert r[f"count_{k}"] == len(v) and r[f"total_{k}"] == pytest.approx(v.sum())
    with pytest.raises(ValueError):
        rolling.rolling_totals(df, "entity", "ds", "y", (0,))


def test_the_forest_proposes(monkeypatch):
    """No reading that the forest passes over is a spike, and it passes over most."""
    rng = np.random.default_rng(3)
    v = rng.integers(90, 110, 400).astype(float)
    v[[50, 200, 333]] = 900, 20, 5000
    day, piece = np.arange(400), np.zeros(400, np.int64)
    judge = lambda t=spikes.THRESHOLD: spikes.judge(v, day, piece, np.array([True]), np.ones(400, bool), True, t)
    got = judge()
    assert np.flatnonzero(got["kind"] == "spike").tolist() == [50, 200, 333] and (got["score"] >= spikes.THRESHOLD).mean() < 0.4
    monkeypatch.setattr(spikes, "isolation_scores", lambda x, source, n: np.zeros(len(x)))
    assert not (judge()["kind"] == "spike").any() and (judge(0.0)["kind"] == "spike").sum() == 3
