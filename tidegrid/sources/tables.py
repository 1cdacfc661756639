"""Reading and writing: tables, parquet, CSV, texts of a file tree, the retrieval index."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from zoneinfo import ZoneInfo

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The columns of the public retail files.
TRAIN_SCHEMA = "Store int, DayOfWeek int, Date string, Sales int, Customers int, Open int, Promo int, StateHoliday string, SchoolHoliday int"
STORE_SCHEMA = "Store int, StoreType string, Assortment string, CompetitionDistance double, CompetitionOpenSinceMonth int, CompetitionOpenSinceYear int, Promo2 int, Promo2SinceWeek int, Promo2SinceYear int, PromoInterval string"


def quoted(name: str) -> str:
    """A table name of up to three parts, each part quoted, so that no name can be more than a name."""
    return ".".join("`" + p.strip("`").replace("`", "``") + "`" for p in name.split("."))


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(quoted(name))


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_csv(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame:
    """With a header and a given schema: nothing is inferred, no column mixes types."""
    return spark.read.schema(schema).option("enforceSchema", False).csv(path, header=True)


def as_view(df: DataFrame, name: str, everywhere: bool = False) -> None:
    (df.createOrReplaceGlobalTempView if everywhere else df.createOrReplaceTempView)(name)


def create_database(spark: SparkSession, name: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {quoted(name)}")


def stamped(df: DataFrame, zone: str = "America/Chicago", now: dt.datetime | None = None) -> DataFrame:
    """With the time of the update in a zone, as text."""
    at = (now or dt.datetime.now(dt.timezone.utc)).astimezone(ZoneInfo(zone))
    return df.withColumn("table_update_datetime", F.lit(at.strftime("%Y-%m-%d %H:%M:%S")))


def write_table(df: DataFrame, name: str, zone: str = "America/Chicago", view: str | None = None, partition_by: tuple[str, ...] = ()) -> DataFrame:
    out = stamped(df, zone)
    if view:
        as_view(out, view, everywhere=True)
    writer = out.write.mode("overwrite")
    (writer.partitionBy(*partition_by) if partition_by else writer).saveAsTable(quoted(name))
    return out


def write_parquet(df: DataFrame, path: str, partition_by: tuple[str, ...] = ()) -> None:
    writer = df.write.mode("overwrite")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def read_texts(spark: SparkSession, root: str, glob: str | tuple[str, ...] = "*.py") -> DataFrame:
    """(file_path, text): one row a file of the tree whose name meets one of the globs."""
    globs = (glob,) if isinstance(glob, str) else tuple(glob)
    one = globs[0] if len(globs) == 1 else "{" + ",".join(globs) + "}"
    rows = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", one).text(root, wholetext=True)
    return rows.select(F.col("_metadata.file_path").alias("file_path"), F.col("value").alias("text")).dropDuplicates(["file_path"])


def exists(spark: SparkSession, path: str) -> bool:
    """On whatever file system the path names."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def load_index(spark: SparkSession, path: str) -> DataFrame:
    if not exists(spark, path):
        raise FileNotFoundError(path)
    return spark.read.parquet(path)


def saved_index(spark: SparkSession, path: str, build: Callable[[], DataFrame], anew: bool = False) -> DataFrame:
    """The index at ``path``; where there is none, or ``anew``, it is built and written there first."""
    if anew or not exists(spark, path):
        write_parquet(build(), path)
    return load_index(spark, path)


def preview(df: DataFrame, rows: int = 20) -> pd.DataFrame:
    """The first rows, for the eye."""
    return df.limit(rows).toPandas()


def to_pandas(df: DataFrame, limit: int | None = None) -> pd.DataFrame:
    return (df if limit is None else df.limit(limit)).toPandas()
