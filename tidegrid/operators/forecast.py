"""Point forecasts with intervals for every series of a panel, and the splits and baselines around them."""

from __future__ import annotations

from statistics import NormalDist

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegrid.config import ForecastConfig
from tidegrid.functions.common import col, require
from tidegrid.functions.kernels import holt, stl
from tidegrid.operators.panel import split_short
from tidegrid.operators.transform import inverse_boxcox

NARROW = 1e-8


def split_by_time(df: DataFrame, date: str, length: int, granularity: str = "week") -> tuple[DataFrame, DataFrame]:
    """(train, test): test holds the last ``length`` periods of the panel's calendar. Null dates are in neither. Both stay lazy; a panel without any date has two empty parts."""
    require(df, date)
    if length <= 0:
        raise ValueError("length must be greater than 0")
    last = F.max(col(date)).cast("date")
    cut = df.agg((F.date_sub(last, 7 * length) if granularity == "week" else F.add_months(last, -length)).alias("_cut"))
    both = df.crossJoin(F.broadcast(cut))
    return both.where(col(date) <= F.col("_cut")).drop("_cut"), both.where(col(date) > F.col("_cut")).drop("_cut")


def step_date(last: Column, i: Column, granularity: str, anchor: str = "panel") -> Column:
    """The date of step i (from 1) after the last one. Weekly: ``panel`` keeps the weekday, ``sunday`` takes the Sundays from a week after the last date on. Monthly: first days."""
    if granularity == "month":
        return F.add_months(F.trunc(F.add_months(last, 1), "month"), i - 1)
    if anchor == "panel":
        return F.date_add(last, 7 * i)
    first = F.date_add(last, 7)
    return F.date_add(first, (7 - F.dayofweek(first) + 1) % 7 + 7 * (i - 1))


def _steps(df: DataFrame, cfg: ForecastConfig, last: Column) -> DataFrame:
    out = df.withColumn("_i", F.explode(F.sequence(F.lit(1), F.lit(cfg.horizon))))
    return out.withColumn("_ds", step_date(last, F.col("_i"), cfg.granularity, cfg.week_anchor))


def _flat(df: DataFrame, cfg: ForecastConfig, y: Column, *more: Column) -> DataFrame:
    y = y.cast("double")
    return df.select(col(cfg.group), F.col("_ds").alias(cfg.date), y.alias("y_hat"), y.alias("y_hat_lower"), y.alias("y_hat_upper"), *more)


def naive(df: DataFrame, cfg: ForecastConfig) -> DataFrame:
    """The last row's value, for all steps, with no width. One map-side aggregate."""
    require(df, cfg.group, cfg.date, cfg.target)
    last = df.where(col(cfg.date).isNotNull()).groupBy(col(cfg.group)).agg(F.max(col(cfg.date)).cast("date").alias("_last"), F.max_by(F.struct(col(cfg.target).alias("y")), col(cfg.date))["y"].alias("_y"))
    return _flat(_steps(last, cfg, F.col("_last")), cfg, F.col("_y"))


def seasonal_naive(df: DataFrame, cfg: ForecastConfig) -> DataFrame:
    """The last min(n, seasonal_period) rows, repeated. Only these rows of a series leave the window: it is limited by rank before the exchange."""
    require(df, cfg.group, cfg.date, cfg.target)
    w = Window.partitionBy(col(cfg.group)).orderBy(col(cfg.date).desc())
    tail = df.where(col(cfg.date).isNotNull()).select(col(cfg.group), col(cfg.date).cast("date").alias("_d"), col(cfg.target).alias("_y"), F.row_number().over(w).alias("_r")).where(F.col("_r") <= cfg.seasonal_period)
    lists = tail.groupBy(col(cfg.group)).agg(F.max("_d").alias("_last"), F.transform(F.sort_array(F.collect_list(F.struct((-F.col("_r")).alias("k"), F.col("_y").alias("y")))), lambda x: x["y"]).alias("_ys"))
    out = _steps(lists, cfg, F.col("_last"))
    return _flat(out, cfg, F.get("_ys", (F.col("_i") - 1) % F.size("_ys")))


def one_series(t: np.ndarray, y: np.ndarray, cfg: ForecastConfig) -> tuple[np.ndarray, float, str | None]:
    """(forecast, half width of the interval, reason of a fallback or null) of one series: ``t`` the values to model, ``y`` the values themselves, whose last one is the naive
    forecast. Whatever fails in the model ends here, as the reason."""
    fine, reason = t[np.isfinite(t)], None
    if len(t) < cfg.min_history:
        reason = f"{len(t)} periods, {cfg.min_history} needed"
    elif not len(fine):
        reason = "no finite value"
    elif fine.max() - fine.min() < NARROW:
        reason = "constant"
    elif len(fine) < 2 * cfg.seasonal_period:
        reason = "fewer than two seasons"
    if reason is None:
        try:
            season, trend, rest = stl(fine, cfg.seasonal_period)
            tail = season[-cfg.seasonal_period :]
            hat = holt(trend + rest, cfg.horizon, cfg.smoothing_alpha) + tail[np.arange(cfg.horizon) % len(tail)]
            half = NormalDist().inv_cdf(1 - cfg.alpha / 2) * rest.std(ddof=1)
            if np.isfinite(hat).all() and np.isfinite(half):
                return hat, float(half), None
            reason = "the model gives no finite forecast"
        except Exception as e:  # noqa: BLE001
            reason = f"{type(e).__name__}: {e}"
    return np.full(cfg.horizon, y[-1], float), 0.0, reason


def long_forecast(df: DataFrame, cfg: ForecastConfig) -> DataFrame:
    """Seasonal-trend decomposition, Holt on what is not seasonal, the last cycle repeated on top; the interval's half width is z times the decomposition's remainder. A series that is too
    short, too flat or not finite, or that fails in the model, gets the naive forecast, with the reason; the others are not touched by it. One series at a time on the executors; only four columns go there."""
    target = cfg.transformed or cfg.target
    require(df, cfg.group, cfg.date, target, cfg.target)
    names = [cfg.group, "_step", "y_hat", "y_hat_lower", "y_hat_upper", "_last", "method", "fallback_reason"]
    kind = df.schema[cfg.group].dataType
    schema = T.StructType([T.StructField(cfg.group, kind), T.StructField("_step", T.IntegerType()), *[T.StructField(c, T.DoubleType()) for c in names[2:5]], T.StructField("_last", T.DateType()), T.StructField("method", T.StringType()), T.StructField("fallback_reason", T.StringType())])

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_d", kind="stable")
        hat, half, reason = one_series(pdf["_t"].to_numpy(float), pdf["_y"].to_numpy(float), cfg)
        steps = np.arange(1, cfg.horizon + 1)
        return pd.DataFrame({cfg.group: pdf[cfg.group].iloc[0], "_step": steps, "y_hat": hat, "y_hat_lower": hat - half, "y_hat_upper": hat + half, "_last": pdf["_d"].iloc[-1], "method": "naive" if reason else "stl_holt", "fallback_reason": reason})[names]

    rows = df.where(col(cfg.date).isNotNull()).select(col(cfg.group), col(cfg.date).cast("date").alias("_d"), col(target).cast("double").alias("_t"), col(cfg.target).cast("double").alias("_y"))
    out = rows.groupBy(col(cfg.group)).applyInPandas(one, schema)
    out = out.withColumn(cfg.date, step_date(F.col("_last"), F.col("_step"), cfg.granularity, cfg.week_anchor))
    if cfg.transformed:  # back to the scale of the values; fallbacks are on it already
        lam = df.groupBy(col(cfg.group)).agg(F.max(col(cfg.lambda_column)).alias("_lam"))
        out = out.join(lam, cfg.group, "left").withColumn("_lam", F.when(F.col("method") == "stl_holt", F.col("_lam")))
        out = inverse_boxcox(out, ["y_hat", "y_hat_lower", "y_hat_upper"], "_lam", None)
    return out.select(cfg.group, cfg.date, "y_hat", "y_hat_lower", "y_hat_upper", "method", "fallback_reason")


def short_forecast(df: DataFrame, cfg: ForecastConfig) -> DataFrame:
    """By strategy: seasonal_naive or naive; comp_based is not available and, like an unknown one, answered by naive with the reason."""
    if cfg.short_strategy == "seasonal_naive":
        return seasonal_naive(df, cfg).withColumns({"method": F.lit("seasonal_naive"), "fallback_reason": F.lit(None).cast("string")})
    reason = None if cfg.short_strategy == "naive" else f"strategy {cfg.short_strategy} is not available"
    return naive(df, cfg).withColumns({"method": F.lit("naive"), "fallback_reason": F.lit(reason).cast("string")})


def panel_forecast(df: DataFrame, cfg: ForecastConfig) -> DataFrame:
    long, short = split_short(df, cfg.short_flag)
    return long_forecast(long, cfg).unionByName(short_forecast(short, cfg))


def last_year(df: DataFrame, group: str, date: str, value: str, granularity: str = "week") -> DataFrame:
    """(group, date, baseline): the value of the same period a year before, by date, for the dates of the panel that have one."""
    shift = F.date_add(col(date), 364) if granularity == "week" else F.add_months(col(date), 12)
    old = df.select(col(group), shift.alias(date), col(value).alias("baseline"))
    return df.select(col(group), col(date)).join(old, [group, date])
