"""An extension: period totals of a stream of observations, with late data bounded by a watermark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegrid.functions.common import col, require


def weekly_totals(stream: DataFrame, group: str, time: str, value: str, late: str = "14 days") -> DataFrame:
    """(group, ds, y, n) for weeks from Monday on. Weeks are windows of seven days shifted by four, as day 0 of the epoch is a Thursday; a week is complete once the
    watermark has passed it, and its state is dropped then."""
    require(stream, group, time, value)
    week = F.window(col(time), "7 days", "7 days", "4 days")
    got = stream.withWatermark(time, late).groupBy(col(group), week).agg(F.sum(col(value)).alias("y"), F.count("*").alias("n"))
    return got.select(col(group), F.to_date("window.start").alias("ds"), "y", "n")
