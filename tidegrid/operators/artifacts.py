"""The tables a forecast dashboard reads, precomputed: results, metrics by slice, contributions, scatter points and rankings."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegrid.functions.common import col, require
from tidegrid.operators.evaluate import errors


def forecast_results(actual: DataFrame, forecast: DataFrame, baseline: DataFrame | None, group: str, date: str, value: str, run_id: str = "run", dims: Sequence[str] = ()) -> DataFrame:
    """One row per series and period of the forecast: forecast, bounds if there are any, actual and baseline."""
    bounds = [c for c in ("y_hat_lower", "y_hat_upper") if c in forecast.columns]
    out = forecast.select(col(group), col(date), F.col("y_hat"), *map(col, bounds)).join(actual.select(col(group), col(date), col(value).alias("y"), *map(col, dims)), [group, date], "left")
    if baseline is not None:
        out = out.join(baseline.select(col(group), col(date), "baseline"), [group, date], "left")
    return out.withColumn("run_id", F.lit(run_id))


def filtered(df: DataFrame, chosen: Mapping[str, Sequence], date: str | None = None, first: object = None, last: object = None) -> DataFrame:
    """Multi-select filters and a date range, both ends included; an empty choice filters nothing."""
    for c, values in chosen.items():
        if values:
            df = df.where(col(c).isin(list(values)))
    if date and first is not None:
        df = df.where(col(date) >= F.lit(first))
    return df.where(col(date) <= F.lit(last)) if date and last is not None else df


def metrics_by_slice(results: DataFrame, dims: Sequence[str], levels: Sequence[Sequence[str]] | None = None) -> DataFrame:
    """Error metrics by slice; with ``levels`` several groupings in one pass (grouping sets). n_excluded: rows that MAPE leaves out."""
    y, f = col("y"), col("y_hat")
    aggs = [*errors(y, f), (F.sum(f - y) / F.nullif(F.sum(F.abs(y)), F.lit(0.0))).alias("bias"), F.count("*").alias("n_rows"), F.count_if(y == 0).alias("n_excluded")]
    if levels is None:
        return results.groupBy(*map(col, dims)).agg(*aggs)
    return results.groupingSets([[col(c) for c in s] for s in levels], *map(col, dims)).agg(*aggs)


def error_contribution(results: DataFrame, date: str, dim: str) -> DataFrame:
    """Absolute error by period and dimension value, its share of the period's total and its rank there."""
    got = results.groupBy(col(date), col(dim)).agg(F.sum(F.abs(col("y") - col("y_hat"))).alias("abs_error"))
    w = Window.partitionBy(col(date))
    share = F.col("abs_error") / F.nullif(F.sum("abs_error").over(w), F.lit(0.0))
    return got.select(col(date), col(dim), "abs_error", share.alias("error_share"), F.row_number().over(w.orderBy(F.desc_nulls_last("abs_error"), col(dim))).alias("contribution_rank"))


def scatter_points(results: DataFrame, by: str) -> DataFrame:
    """Volume and WAPE by entity, with the medians of both as guides (one broadcast row)."""
    points = results.groupBy(col(by)).agg(F.sum(F.abs(col("y"))).alias("volume"), errors(col("y"), col("y_hat"))[0])
    guides = points.agg(F.percentile_approx("volume", 0.5).alias("median_volume"), F.percentile_approx("wape", 0.5).alias("median_wape"))
    return points.crossJoin(F.broadcast(guides))


def error_box(results: DataFrame, dim: str) -> DataFrame:
    """Five numbers of the relative error's distribution by dimension value."""
    e = F.when(col("y") != 0, F.abs(col("y") - col("y_hat")) / F.nullif(F.abs(col("y")), F.lit(0.0)))
    got = results.select(col(dim), e.alias("_e")).where("_e is not null").groupBy(col(dim)).agg(F.count("*").alias("n"), F.percentile_approx("_e", [0.0, 0.25, 0.5, 0.75, 1.0]).alias("_q"))
    return got.select(col(dim), "n", *[F.get("_q", i).alias(n) for i, n in enumerate(("lowest", "q1", "median", "q3", "highest"))])


def worst(results: DataFrame, by: str, top: int = 10) -> DataFrame:
    got = results.groupBy(col(by)).agg(F.sum(F.abs(col("y") - col("y_hat"))).alias("abs_error"), errors(col("y"), col("y_hat"))[0])
    return got.orderBy(F.desc_nulls_last("abs_error"), col(by)).limit(top)


def month_rollup(results: DataFrame, date: str, keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    return results.groupBy(*map(col, keys), F.trunc(col(date), "month").alias(date)).agg(*[F.sum(col(v)).alias(v) for v in values])


def heatmap(results: DataFrame, rows: str, columns: str) -> DataFrame:
    return results.groupBy(col(rows), col(columns)).agg(errors(col("y"), col("y_hat"))[0], F.sum(F.abs(col("y"))).alias("volume"))


def macro(results: DataFrame, date: str) -> DataFrame:
    """What no filter touches: totals by run and period."""
    return results.groupBy("run_id", col(date)).agg(F.sum("y").alias("y"), F.sum("y_hat").alias("y_hat"))


def top_traces(df: DataFrame, by: str, value: str, top: int = 20, other: str | None = None) -> DataFrame:
    """Rows of the ``top`` groups by volume, with is_limited where there are more; with ``other`` the rest stays under that name. Ranks come from one small row a group."""
    require(df, by, value)
    ranks = df.groupBy(col(by)).agg(F.sum(F.abs(col(value))).alias("_v"))
    first = ranks.orderBy(F.desc_nulls_last("_v"), col(by)).limit(top).select(col(by).alias("_k"))
    many = ranks.agg((F.count("*") > top).alias("is_limited"))
    out = df.join(F.broadcast(first), col(by).eqNullSafe(F.col("_k")), "left_semi" if other is None else "left").crossJoin(F.broadcast(many))
    if other is None:
        return out
    rest: Column = F.when(F.col("_k").isNull(), F.lit(other)).otherwise(col(by))
    return out.withColumn(by, rest).drop("_k")
