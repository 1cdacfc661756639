"""Small helpers that every operator shares: presence tests, lineage cuts, size-checked broadcasts."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def col(name: str) -> Column:
    """A column by its exact name, dots and blanks included."""
    return F.col("`" + name.replace("`", "``") + "`")


def require(df: DataFrame, *names: str) -> None:
    """ValueError when a named column is missing, found at analysis time, without an action."""
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}; there are: {df.columns}")


def is_float(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType))


def present(df: DataFrame, name: str) -> Column:
    """Neither null nor NaN. Zero is present."""
    c = col(name)
    return c.isNotNull() & ~F.isnan(c) if is_float(df, name) else c.isNotNull()


def day_number(c: Column) -> Column:
    """Days since 1970-01-01, as int; the calendar date of a timestamp counts."""
    return F.datediff(c.cast("date"), F.lit("1970-01-01").cast("date"))


def from_day(c: Column) -> Column:
    return F.date_add(F.lit("1970-01-01").cast("date"), c.cast("int"))


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder of spark.checkpoint.dir. Only on one machine (master local) a local one is made where none is set; on a cluster that is an error, for executors
    would each write to a folder of their own."""
    sc = spark.sparkContext
    there = sc._jsc.sc().getCheckpointDir()
    if there.isDefined():
        return there.get()
    at = sc.getConf().get("spark.checkpoint.dir", None)
    if not at:
        if not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        at = tempfile.mkdtemp(prefix="tidegrid-")
        atexit.register(shutil.rmtree, at, ignore_errors=True)
    sc.setCheckpointDir(at)
    return sc._jsc.sc().getCheckpointDir().get()


def cut(df: DataFrame) -> DataFrame:
    """Materialise a result that is used several times, in the shared folder: it survives the loss of executors. The folder is removed by ``sweep`` or when Python ends."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/cut-{uuid.uuid4().hex}"
    if not _CUTS:
        atexit.register(sweep)
    _CUTS.append((spark, path))
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


_CUTS: list[tuple[SparkSession, str]] = []


def sweep() -> None:
    """Removes what ``cut`` has written so far. For use between jobs: results that are not read to their end yet need their folders."""
    while _CUTS:
        spark, path = _CUTS.pop()
        try:
            at = spark._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
        except Exception:  # noqa: BLE001 - the session has ended; its folder is its owner's to remove
            pass


def bounded_rows(df: DataFrame, limit: int, what: str) -> list:
    """Rows of a table of proven small size. Raises instead of collecting more than ``limit`` rows."""
    rows = df.limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"{what} has more than {limit} rows; raise the documented bound")
    return rows
