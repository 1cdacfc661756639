"""Box-Cox per series: the exponent by an Arrow kernel that sees one number per row, applying and undoing it in Catalyst."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegrid.functions.common import col, present, require
from tidegrid.functions.kernels import boxcox_lambda


def lambdas(df: DataFrame, group: str, value: str, low: float = 0.9, high: float = 1.1) -> DataFrame:
    """(group, series_lambda, is_constant): null lambda where the values stay as they are: none, not all positive, constant, or an exponent strictly between low and high.

    What needs no likelihood is decided by a map-side aggregate; only series that do need it reach Python, as (series, value)."""
    require(df, group, value)
    rows = df.where(present(df, value)).select(col(group), col(value).cast("double").alias("_v"))
    stats = rows.groupBy(col(group)).agg(F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
    fit = stats.where((F.col("_lo") > 0) & (F.col("_hi") > F.col("_lo"))).select(col(group))

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        lam = boxcox_lambda(np.sort(pdf["_v"].to_numpy(float)))  # in a fixed order, so that sums do not depend on the partitioning
        return pd.DataFrame({group: pdf[group].iloc[:1], "series_lambda": [None if low < lam < high else lam]})

    got = rows.join(fit, group, "left_semi").groupBy(col(group)).applyInPandas(one, f"`{group}` {df.schema[group].dataType.simpleString()}, series_lambda double")
    return stats.join(got, group, "left").select(col(group), "series_lambda", ((F.col("_lo") > 0) & (F.col("_lo") == F.col("_hi"))).alias("is_constant"))


def transformed(x: Column, lam: Column) -> Column:
    """The value itself where lambda is null."""
    return F.when(lam.isNull(), x).when(F.abs(lam) < 1e-12, F.log(x)).otherwise(F.expm1(lam * F.log(x)) / F.nullif(lam, F.lit(0.0)))


def boxcox_transform(df: DataFrame, group: str, value: str = "y_clean_int", low: float = 0.9, high: float = 1.1) -> DataFrame:
    """Adds <value>_transformed, series_lambda, is_constant. Null values stay null, with lambda null and the flag false."""
    out = df.join(lambdas(df, group, value, low, high), group, "left")
    here = present(df, value)
    lam = F.when(here, F.col("series_lambda"))
    return out.withColumns({f"{value}_transformed": F.when(here, transformed(col(value).cast("double"), lam)), "series_lambda": lam, "is_constant": here & F.coalesce("is_constant", F.lit(False))}).select(*df.columns, f"{value}_transformed", "series_lambda", "is_constant")


def apply_lambda(df: DataFrame, value: str, lam: float, name: str | None = None) -> DataFrame:
    return df.withColumn(name or f"{value}_transformed", F.when(col(value) > 0, transformed(col(value).cast("double"), F.lit(float(lam)))))


def inverse_boxcox(df: DataFrame, columns: Sequence[str], lambda_column: str = "series_lambda", constant_flag: str | None = "is_constant") -> DataFrame:
    """In place: back to the scale of the values where a lambda is known and the series is not constant; null where no value has this transform."""
    if not columns:
        raise ValueError("columns must not be empty")
    require(df, lambda_column, *columns, *([constant_flag] if constant_flag else []))
    lam = col(lambda_column)
    live = lam.isNotNull() & ~(F.coalesce(col(constant_flag), F.lit(False)) if constant_flag else F.lit(False))

    def back(x: Column) -> Column:
        inside = 1 + lam * x
        return F.when(F.abs(lam) < 1e-12, F.exp(x)).when(inside > 0, F.exp(F.log(inside) / F.nullif(lam, F.lit(0.0))))

    return df.withColumns({c: F.when(live & col(c).isNotNull(), back(col(c))).otherwise(col(c)) for c in columns})
