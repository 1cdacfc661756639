"""Flags, fills and outliers of a panel, all as windows over one distribution by series."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tidegrid.functions.common import col, require

START, END = Window.unboundedPreceding, Window.unboundedFollowing


def _series(group: str) -> WindowSpec:
    return Window.partitionBy(col(group))


def inactivity(df: DataFrame, value: str, date: str, group: str, threshold: int = 4, drop: bool = False, until: DataFrame | None = None) -> DataFrame:
    """Seven columns on periods of no activity (null or zero). ``threshold`` N: a series was inactive if N periods in a row were; it is obsolete if it ends more than N weeks
    before the whole panel. ``drop`` keeps what follows the last such stretch of series that are not obsolete. The panel's last date joins as one row, unseen by the driver; ``until``: a cheaper frame of the same last date."""
    require(df, value, date, group)
    if threshold is None or threshold <= 0:
        raise ValueError("threshold must be greater than 0")
    w = _series(group)
    d = col(date)
    out = df.crossJoin(F.broadcast((df if until is None else until).agg(F.max(d).alias("_end"))))
    idle = F.when(col(value).isNull() | (col(value) == 0), 1).otherwise(0)
    out = out.withColumns({"is_inactive": idle, "series_min_date": F.min(d).over(w), "series_max_date": F.max(d).over(w)})
    out = out.withColumn("_run", F.sum("is_inactive").over(w.orderBy(d).rowsBetween(1 - threshold, 0)))
    out = out.withColumn("_most", F.max("_run").over(w))
    out = out.withColumn("_last", F.max(F.when(F.col("_run") == F.col("_most"), d)).over(w))
    was = F.col("_most") >= threshold
    out = out.withColumns({
        "is_obsolete": F.col("series_max_date") < F.date_sub("_end", 7 * threshold),
        "iswas_inactive": was, "never_inactive": ~was, "precedes_inactive_period": was & (d <= F.col("_last")),
    })
    if drop:
        out = out.where(~F.col("is_obsolete") & ~F.col("precedes_inactive_period"))
    return out.drop("_end", "_run", "_most", "_last")


def enough_data(df: DataFrame, value: str, group: str, least: int) -> DataFrame:
    """Rows of the series with at least so many values; nulls do not count."""
    require(df, value, group)
    if least is None or least <= 0:
        raise ValueError("least must be greater than 0")
    return df.withColumn("_n", F.count(col(value)).over(_series(group))).where(F.col("_n") >= least).drop("_n")


def short_flag(df: DataFrame, date: str, group: str, threshold: int) -> DataFrame:
    """series_length: the periods of the filled calendar; is_short_series: fewer than the threshold."""
    out = df.withColumn("series_length", F.count(col(date)).over(_series(group)))
    return out.withColumn("is_short_series", F.col("series_length") < threshold)


def series_median(df: DataFrame, value: str, group: str, name: str = "series_median") -> DataFrame:
    return df.withColumn(name, F.percentile_approx(col(value), 0.5).over(_series(group)))


def fill_dims(df: DataFrame, dims: Sequence[str], date: str, group: str, fill: str = "latest") -> DataFrame:
    """Missing dimension values take the one before; at the start of a series, where there is none, the series' latest (``latest``, the customary way) or the next one (``nearest``)."""
    require(df, date, group, *dims)
    if fill not in ("latest", "nearest"):
        raise ValueError(f"fill must be latest or nearest, is {fill!r}")
    w = _series(group).orderBy(col(date))

    def one(c: str) -> Column:
        after = F.last(col(c), True).over(w.rowsBetween(START, END)) if fill == "latest" else F.last(col(c), True).over(_series(group).orderBy(col(date).desc()).rowsBetween(START, 0))
        return F.coalesce(F.last(col(c), True).over(w.rowsBetween(START, 0)), after)

    return df.withColumns({c: one(c) for c in dims})


def outliers(df: DataFrame, columns: Sequence[str], group: str, threshold: float = 3.0, absolute: float = 1e5) -> DataFrame:
    """By column: <c>_is_outlier, far from the series' mean in sample standard deviations or beyond an absolute bound, and <c>_clean, null there."""
    require(df, group, *columns)
    w = _series(group)
    out = df
    for c in columns:
        sd = F.stddev_samp(col(c)).over(w)
        z = F.when(sd > 1e-5, (col(c) - F.avg(col(c)).over(w)) / sd).otherwise(F.when(col(c).isNotNull(), 0.0))
        far = F.coalesce((F.abs(z) > threshold) | (F.abs(col(c)) > absolute), F.lit(False))
        out = out.withColumn(f"{c}_is_outlier", far).withColumn(f"{c}_clean", F.when(~F.col(f"{c}_is_outlier"), col(c)))
    return out
