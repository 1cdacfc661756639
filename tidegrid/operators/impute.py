"""Gaps in the values of a series: linear in Catalyst, splines by an Arrow kernel of one series."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegrid.config import INTERPOLATIONS
from tidegrid.functions.common import col, present, require
from tidegrid.functions.kernels import interpolating_spline, smoothing_spline


def interpolate(df: DataFrame, columns: Sequence[str], date: str, group: str, method: str = "linear", order: int = 3) -> DataFrame:
    """Adds <c>_int (double): gaps filled by position in time order, the edges held constant. A series without values stays null.

    ``linear`` needs one exchange and no Python. ``polynomial`` is the interpolating spline of the order, ``spline`` the smoothing one, which also extrapolates forward;
    both fall back to linear with fewer than order + 1 values."""
    require(df, date, group, *columns)
    if method not in INTERPOLATIONS:
        raise ValueError(f"method must be one of {INTERPOLATIONS}, is {method!r}")
    if method == "linear":
        return _linear(df, columns, date, group)
    schema = T.StructType([*df.schema.fields, *[T.StructField(f"{c}_int", T.DoubleType()) for c in columns]])

    def fill(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(date, kind="stable").reset_index(drop=True)
        for c in columns:
            pdf[f"{c}_int"] = _curve(pd.to_numeric(pdf[c], errors="coerce").to_numpy(float, na_value=np.nan), method, order)
        return pdf

    return df.groupBy(col(group)).applyInPandas(fill, schema)


def _curve(y: np.ndarray, method: str, order: int) -> np.ndarray:
    out, at = y.copy(), np.arange(len(y), dtype=float)
    known = np.isfinite(y)
    if known.all() or not known.any():
        return out
    gone = ~known
    if known.sum() <= order:
        out[gone] = np.interp(at[gone], at[known], y[known])
        return out
    x, v = at[known], y[known]
    if method == "polynomial":
        inside = gone & (at > x[0]) & (at < x[-1])
        out[inside] = interpolating_spline(x, v, order)(at[inside])
    else:
        inside = gone & (at > x[0])
        out[inside] = smoothing_spline(x, v, order)(at[inside])
    return pd.Series(out).ffill().bfill().to_numpy()


def _linear(df: DataFrame, columns: Sequence[str], date: str, group: str) -> DataFrame:
    w = Window.partitionBy(col(group)).orderBy(col(date))
    out = df.withColumn("_rn", F.row_number().over(w))
    back = Window.partitionBy(col(group)).orderBy(F.col("_rn").desc())  # a frame that grows: one that shrinks is evaluated anew for every row
    for c in columns:
        point = F.when(present(df, c), F.struct(F.col("_rn").alias("i"), col(c).cast("double").alias("v")))
        p, n = F.last(point, True).over(w.rowsBetween(Window.unboundedPreceding, 0)), F.last(point, True).over(back.rowsBetween(Window.unboundedPreceding, 0))
        out = out.withColumns({"_p": p, "_n": n})
        between = F.col("_p.v") + (F.col("_n.v") - F.col("_p.v")) * (F.col("_rn") - F.col("_p.i")) / F.nullif(F.col("_n.i") - F.col("_p.i"), F.lit(0))
        value = F.when(F.col("_p").isNull(), F.col("_n.v")).when(F.col("_n").isNull(), F.col("_p.v")).otherwise(F.coalesce(between, F.col("_p.v")))
        out = out.withColumn(f"{c}_int", value).drop("_p", "_n")
    return out.drop("_rn")
