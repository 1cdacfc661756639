"""Reports on a panel; every report is one aggregate, and the driver sees results only."""

from __future__ import annotations

from dataclasses import asdict, dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegrid.functions.common import col, require


def ratio(part: Column, whole: Column) -> Column:
    """0.0 where there is nothing to divide by."""
    return F.when(whole > 0, part / F.when(whole > 0, whole)).otherwise(F.lit(0.0))


def warn_level(pct: Column, levels: tuple[float, float, float] = (3.0, 5.0, 10.0)) -> Column:
    a, b, c = levels
    return F.when(pct < a, "low").when(pct < b, "moderate").when(pct < c, "high").otherwise("very_high")


def warn_message(pct: Column, level: Column) -> Column:
    return F.format_string("Short series hold %.2f%% of the volume: %s.", pct, F.replace(level, F.lit("_"), F.lit(" ")))


@dataclass(frozen=True)
class ShortSeriesReport:
    total_series: int
    short_series: int
    short_ratio: float
    short_volume: float
    total_volume_window: float
    short_volume_pct: float
    min_short_date: str | None
    warning_level: str
    warning_message: str

    def to_dict(self) -> dict:
        return asdict(self)


def short_report(df: DataFrame, group: str = "time_series_id", date: str = "ds", value: str = "y_clean", flag: str = "is_short_series", levels: tuple[float, float, float] = (3.0, 5.0, 10.0)) -> DataFrame:
    """One row: counts, volumes from the first date of any short series on, their share in percent and how grave it is. Without short series everything is 0 and the level none."""
    require(df, group, date, value, flag)
    first = df.agg(F.min(F.when(col(flag), col(date))).alias("_from"))
    rows = df.crossJoin(F.broadcast(first))
    inside = col(date) >= F.col("_from")
    got = rows.agg(
        F.count_distinct(col(group)).alias("total_series"), F.count_distinct(F.when(col(flag), col(group))).alias("short_series"),
        F.coalesce(F.sum(F.when(inside & col(flag), col(value))), F.lit(0.0)).cast("double").alias("short_volume"),
        F.coalesce(F.sum(F.when(inside, col(value))), F.lit(0.0)).cast("double").alias("total_volume_window"), F.min("_from").cast("string").alias("min_short_date"),
    )
    pct = 100 * ratio(F.col("short_volume"), F.col("total_volume_window"))
    level = F.when(F.col("short_series") == 0, "none").otherwise(warn_level(pct, levels))
    return got.select("total_series", "short_series", ratio(F.col("short_series"), F.col("total_series")).alias("short_ratio"), "short_volume", "total_volume_window", pct.alias("short_volume_pct"), "min_short_date", level.alias("warning_level"), F.when(F.col("short_series") == 0, "There are no short series.").otherwise(warn_message(pct, level)).alias("warning_message"))


def short_report_of(df: DataFrame, **names: str) -> ShortSeriesReport:
    return ShortSeriesReport(**short_report(df, **names).first().asDict())


def length_distribution(df: DataFrame, group: str, date: str = "ds", flag: str = "is_short_series", length: str = "series_length") -> DataFrame:
    """(group, series_length, is_short_series), from the panel's own columns where it has them."""
    n = F.max(col(length)) if length in df.columns else F.count(col(date))
    return df.groupBy(col(group)).agg(n.alias("series_length"), *([F.max(col(flag)).alias("is_short_series")] if flag in df.columns else []))


def volume_distribution(df: DataFrame, group: str, value: str) -> DataFrame:
    return df.groupBy(col(group)).agg(F.sum(col(value)).alias("total_volume")).orderBy(F.desc("total_volume"), col(group))


def series_summary(df: DataFrame, group: str, value: str, flag: str = "is_short_series") -> DataFrame:
    v = col(value)
    return df.groupBy(col(group)).agg(
        F.count(v).alias("n_obs"), F.sum(v).alias("total_volume"), F.avg(v).alias("mean_value"), F.stddev_samp(v).alias("std_value"),
        F.percentile_approx(v, 0.5).alias("median_value"), *([F.max(col(flag)).alias("is_short_series")] if flag in df.columns else []),
    )


def null_profile(df: DataFrame) -> DataFrame:
    """(column_name, null_count, null_pct): nulls, not NaN, with the share of rows; one pass."""
    one = df.agg(F.count("*").alias("_n"), *[F.count_if(col(c).isNull()).alias(c) for c in df.columns])
    long = one.unpivot(["_n"], list(df.columns), "column_name", "null_count")
    return long.select("column_name", "null_count", ratio(F.col("null_count"), F.col("_n")).alias("null_pct")).orderBy(F.desc("null_count"), "column_name")


def histogram(df: DataFrame, value: str, bins: int, closed: tuple[float, float] | None = None) -> DataFrame:
    """(bin from 1, low, high, n) of equal width, the last bin closed, empty bins included. Non-finite values are left out; the range is found in the same plan unless given."""
    v = col(value).cast("double")
    rows = df.where(v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))).select(v.alias("_v"))
    if closed:
        span = rows.sparkSession.range(1).select(F.lit(float(closed[0])).alias("_a"), F.lit(float(closed[1])).alias("_b"))
        rows = rows.where(F.col("_v").between(*closed))
    else:
        span = rows.agg(F.min("_v").alias("_a"), F.max("_v").alias("_b"))
    same = F.col("_a") == F.col("_b")
    span = span.select(F.when(same, F.col("_a") - 0.5).otherwise(F.col("_a")).alias("_a"), F.when(same, F.col("_b") + 0.5).otherwise(F.col("_b")).alias("_b"))
    at = F.least(F.lit(bins), F.floor((F.col("_v") - F.col("_a")) / (F.col("_b") - F.col("_a")) * bins).cast("int") + 1)
    counts = rows.crossJoin(F.broadcast(span)).groupBy(at.alias("bin")).agg(F.count("*").alias("n"))
    width = (F.col("_b") - F.col("_a")) / bins
    grid = span.where("_a is not null").select("_a", width.alias("_w"), F.explode(F.sequence(F.lit(1), F.lit(bins))).alias("bin"))
    return grid.join(counts, "bin", "left").select("bin", (F.col("_a") + (F.col("bin") - 1) * F.col("_w")).alias("low"), (F.col("_a") + F.col("bin") * F.col("_w")).alias("high"), F.coalesce("n", F.lit(0)).alias("n"))


def volume_and_length(df: DataFrame, group: str, date: str, value: str, flag: str = "is_short_series") -> DataFrame:
    return df.groupBy(col(group)).agg(F.count(col(date)).alias("series_length"), F.sum(col(value)).alias("total_volume"), *([F.max(col(flag)).alias("is_short_series")] if flag in df.columns else []))


def short_by_dimension(df: DataFrame, dim: str, group: str, value: str, flag: str = "is_short_series") -> DataFrame:
    """Counts and volumes of series by dimension value; a series with several values counts in each, with its whole volume."""
    series = df.groupBy(col(group)).agg(F.max(col(flag)).alias("_short"), F.sum(col(value)).alias("_v"))
    pairs = series.join(df.select(col(group), col(dim)).distinct(), group, "left")
    got = pairs.groupBy(col(dim)).agg(F.count_distinct(col(group)).alias("n_series"), F.count_distinct(F.when(F.col("_short"), col(group))).alias("n_short_series"), F.coalesce(F.sum("_v"), F.lit(0.0)).alias("total_volume"), F.coalesce(F.sum(F.when(F.col("_short"), F.col("_v"))), F.lit(0.0)).alias("short_volume"))
    return got.withColumns({"short_series_ratio": ratio(F.col("n_short_series"), F.col("n_series")), "short_volume_ratio": ratio(F.col("short_volume"), F.col("total_volume"))})


def trailing(df: DataFrame, date: str, weeks: int) -> DataFrame:
    """From so many weeks before the last date on, both ends included."""
    last = df.agg(F.date_sub(F.max(col(date)), 7 * weeks).alias("_from"))
    return df.crossJoin(F.broadcast(last)).where(col(date) >= F.col("_from")).drop("_from")


def volume_by_dimension(df: DataFrame, dim: str, value: str, top: int | None = None, date: str | None = None, weeks: int | None = None) -> DataFrame:
    rows = trailing(df, date, weeks) if date and weeks else df
    got = rows.groupBy(col(dim)).agg(F.sum(col(value)).alias("total_volume")).orderBy(F.desc("total_volume"), col(dim))
    return got.limit(top) if top else got


def year_day_profile(df: DataFrame, dim: str, date: str, value: str) -> DataFrame:
    return df.groupBy(col(dim), F.year(col(date)).alias("year"), F.dayofyear(col(date)).alias("day_of_year")).agg(F.sum(col(value)).alias("sum_value"))


def year_day_pivot(profile: DataFrame, dim: str, dim_value: object, years: list[int]) -> DataFrame:
    """Rows by day of the year, a column a year, missing days filled forward; at most 366 rows, so one ordered task is right."""
    wide = profile.where(col(dim) == dim_value).groupBy("day_of_year").pivot("year", years).agg(F.sum("sum_value"))
    w = Window.partitionBy(F.lit(1)).orderBy("day_of_year").rowsBetween(Window.unboundedPreceding, 0)
    return wide.select("day_of_year", *[F.last(col(str(y)), True).over(w).alias(f"y{y}") for y in years])
