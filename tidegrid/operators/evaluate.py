"""Actuals against forecasts. What has no answer is null; the views for Python turn it into NaN."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegrid.config import EvalConfig
from tidegrid.functions.common import col, require


def finite(c: Column) -> Column:
    c = c.cast("double")
    return c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))


def align(actual: DataFrame, forecast: DataFrame, cfg: EvalConfig = EvalConfig()) -> DataFrame:
    """Inner join by series and period; the short flag of the actuals, else of the forecasts. Keys must be unique, or rows multiply: ``require_unique`` asserts it."""
    require(actual, cfg.group, cfg.date, cfg.target)
    require(forecast, cfg.group, cfg.date, cfg.forecast)
    more = [c for c in (cfg.baseline, cfg.lower, cfg.upper) if c and c in forecast.columns]
    flag_there = cfg.short_flag in actual.columns
    if not flag_there and cfg.short_flag in forecast.columns:
        more.append(cfg.short_flag)
    left = actual.select(col(cfg.group), col(cfg.date).cast("date").alias(cfg.date), col(cfg.target), *([col(cfg.short_flag)] if flag_there else []))
    return left.join(forecast.select(col(cfg.group), col(cfg.date).cast("date").alias(cfg.date), col(cfg.forecast), *map(col, more)), [cfg.group, cfg.date])


def require_unique(df: DataFrame, cfg: EvalConfig = EvalConfig()) -> DataFrame:
    """ValueError when a series and period occur more than once, which would multiply rows in ``align``; needs an action."""
    twice = df.groupBy(col(cfg.group), col(cfg.date).cast("date").alias("_d")).count().where("count > 1").limit(1).collect()
    if twice:
        raise ValueError(f"series {twice[0][0]} has {twice[0]['count']} rows of {twice[0]['_d']}")
    return df


def require_overlap(aligned: DataFrame) -> DataFrame:
    """The one check that needs an action: ValueError when nothing met."""
    if aligned.isEmpty():
        raise ValueError("actuals and forecasts have no series and period in common")
    return aligned


def errors(y: Column, f: Column, where: Column | None = None, prefix: str = "") -> list[Column]:
    """wape, mae, rmse, mape as aggregates. WAPE's denominator keeps rows without a forecast."""
    on = (lambda c: F.when(where, c)) if where is not None else (lambda c: c)
    y, f = y.cast("double"), f.cast("double")
    e = F.abs(y - f)
    return [
        (F.sum(on(e)) / F.nullif(F.sum(on(F.abs(y))), F.lit(0.0))).alias(f"{prefix}wape"), F.avg(on(e)).alias(f"{prefix}mae"), F.sqrt(F.avg(on(e * e))).alias(f"{prefix}rmse"),
        F.avg(on(F.when(y != 0, e / F.nullif(F.abs(y), F.lit(0.0))))).alias(f"{prefix}mape"),
    ]


def panel_metrics(aligned: DataFrame, cfg: EvalConfig = EvalConfig(), forecast: str | None = None) -> DataFrame:
    return aligned.agg(*errors(col(cfg.target), col(forecast or cfg.forecast)), F.count("*").alias("n_rows"), F.count_distinct(col(cfg.group)).alias("n_series"))


def series_metrics(aligned: DataFrame, cfg: EvalConfig = EvalConfig()) -> DataFrame:
    flag = [F.mode(col(cfg.short_flag), deterministic=True).alias(cfg.short_flag)] if cfg.short_flag in aligned.columns else []
    return aligned.groupBy(col(cfg.group)).agg(F.count("*").alias("n_obs"), F.sum(F.abs(col(cfg.target).cast("double"))).alias("series_volume"), *errors(col(cfg.target), col(cfg.forecast)), *flag)


def dual_metrics(aligned: DataFrame, cfg: EvalConfig = EvalConfig(), modeled: Column | None = None) -> DataFrame:
    """One row: metrics of all rows and of the modeled ones (a mask, else not short, else all), and the modeled share of the volume."""
    mask = modeled if modeled is not None else ~col(cfg.short_flag) if cfg.short_flag in aligned.columns else F.lit(True)
    mask = F.coalesce(mask, F.lit(False))
    y, f = col(cfg.target), col(cfg.forecast)
    volume = F.abs(y.cast("double"))
    return aligned.agg(
        *errors(y, f, None, "panel_"), F.count("*").alias("panel_n_rows"), F.count_distinct(col(cfg.group)).alias("panel_n_series"),
        *errors(y, f, mask, "modeled_"), F.count_if(mask).alias("modeled_n_rows"), F.count_distinct(F.when(mask, col(cfg.group))).alias("modeled_n_series"),
        (F.coalesce(F.sum(F.when(mask, volume)), F.lit(0.0)) / F.nullif(F.sum(volume), F.lit(0.0))).alias("modeled_volume_pct"),
    )


def coverage(aligned: DataFrame, cfg: EvalConfig = EvalConfig()) -> DataFrame:
    """Shares of the rows inside, below and above the interval, its ends included, over rows with three finite numbers."""
    y, lo, hi = (col(c).cast("double") for c in (cfg.target, cfg.lower, cfg.upper))
    rows = aligned.where(finite(y) & finite(lo) & finite(hi))
    share = lambda c: F.avg(c.cast("double"))
    return rows.agg(share((y >= lo) & (y <= hi)).alias("inside"), share(y < lo).alias("below"), share(y > hi).alias("above"), F.count("*").alias("n_rows"))


def high_error_share(series: DataFrame, metric: str = "wape", volume: str = "series_volume", over: float = 1.0) -> DataFrame:
    v = F.abs(col(volume))
    return series.where(finite(col(metric))).agg(F.coalesce(F.sum(F.when(col(metric) > over, v)), F.lit(0.0)).alias("high_error_volume"), F.sum(v).alias("total_volume"), (F.coalesce(F.sum(F.when(col(metric) > over, v)), F.lit(0.0)) / F.nullif(F.sum(v), F.lit(0.0))).alias("high_error_share"))


def actual_and_forecast(actual: DataFrame, forecast: DataFrame, series: str, cfg: EvalConfig = EvalConfig()) -> DataFrame:
    """History and future of one series, all dates of either."""
    a = actual.where(col(cfg.group) == series).select(col(cfg.date).cast("date").alias(cfg.date), col(cfg.target))
    keep = [c for c in (cfg.forecast, cfg.lower, cfg.upper) if c in forecast.columns]
    f = forecast.where(col(cfg.group) == series).select(col(cfg.date).cast("date").alias(cfg.date), *map(col, keep))
    return a.join(f, cfg.date, "full")


def as_dict(one_row: DataFrame) -> dict[str, float]:
    """All values as floats, NaN where there is no answer."""
    return {k: float("nan") if v is None else float(v) for k, v in one_row.first().asDict().items()}
