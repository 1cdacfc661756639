"""From raw observations to a regular panel: one row per series and period."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegrid.config import PanelConfig
from tidegrid.functions.common import col, require


def composite_key(df: DataFrame, keys: Sequence[str], name: str = "time_series_id", separator: str = "|") -> DataFrame:
    """Null parts are left out, as concat_ws does: (a, null) and (a) give the same key."""
    require(df, *keys)
    return df.withColumn(name, F.concat_ws(separator, *[col(k).cast("string") for k in keys]))


def period_of(c: Column, granularity: str) -> Column:
    """The first day of the ISO week or month."""
    return F.to_date(F.date_trunc(granularity, c))


def add_period(df: DataFrame, raw: str, granularity: str = "week", name: str = "ds") -> DataFrame:
    """Texts that are no dates give null instead of an error."""
    require(df, raw)
    c = col(raw)
    return df.withColumn(name, period_of(F.expr(f"try_to_timestamp(`{raw}`)") if isinstance(df.schema[raw].dataType, T.StringType) else c.cast("timestamp"), granularity))


def clean(df: DataFrame, cfg: PanelConfig) -> DataFrame:
    """Whole-row duplicates go, the value gets its name, series their key."""
    require(df, cfg.raw_date, cfg.raw_value, *(cfg.key_columns or (cfg.group,)))
    if cfg.raw_value != cfg.value and cfg.value in df.columns:
        raise ValueError(f"{cfg.value} exists beside {cfg.raw_value}")
    out = df.dropDuplicates().withColumnRenamed(cfg.raw_value, cfg.value)
    return composite_key(out, cfg.key_columns, cfg.group, cfg.separator) if cfg.key_columns else out


def to_periods(df: DataFrame, group: str, date: str, value: str, price: str | None = None, dims: Sequence[str] = ()) -> DataFrame:
    """Sums by series and period; the volume-weighted price where there is one (null without volume); of a dimension the smallest value, which unlike any first one
    does not depend on the order of rows."""
    require(df, group, date, value, *dims)
    aggs = [F.sum(col(value)).alias(value)]
    if price and price in df.columns:
        aggs.append(F.try_divide(F.sum(col(price) * col(value)), F.sum(col(value))).alias("product_wavg_unit_price"))
    return df.groupBy(col(date), col(group)).agg(*aggs, *[F.min(col(c)).alias(c) for c in dims])


def _steps(a: Column, b: Column, granularity: str) -> Column:
    return F.datediff(b, a) / 7 if granularity == "week" else F.months_between(b, a)


def fill_gaps(df: DataFrame, group: str, date: str, granularity: str = "week") -> DataFrame:
    """Every period from a series' first to its last; new rows hold nulls. Rows off the grid that starts at the first date are dropped.

    Each row writes the empty periods up to the next row: one exchange by series, no join with a calendar. Rows with a null date or series are dropped."""
    require(df, group, date)
    if granularity not in ("week", "month"):
        raise ValueError(f"granularity must be week or month, is {granularity!r}")
    g, d = col(group), col(date)
    w = Window.partitionBy(g)
    rows = df.where(g.isNotNull() & d.isNotNull()).withColumn(date, d.cast("date")).withColumn("_lo", F.min(d.cast("date")).over(w))
    off = F.pmod(F.datediff(d, F.col("_lo")), F.lit(7)) if granularity == "week" else F.datediff(d, F.add_months("_lo", F.floor(F.months_between(d, F.col("_lo"))).cast("int")))
    rows = rows.where(off == 0).withColumn("_next", F.lead(d).over(w.orderBy(d)))
    step = F.expr("interval 7 days" if granularity == "week" else "interval 1 month")
    grid = F.when(F.col("_next") > d, F.sequence(d, F.date_sub("_next", 1), step)).otherwise(F.array(d))
    rows = rows.withColumn("_at", F.explode(grid)).withColumn("_own", F.col("_at") == d)
    keep = {c: F.col("_at") if c == date else g if c == group else F.when(F.col("_own"), col(c)) for c in df.columns}
    return rows.select(*[c.alias(k) for k, c in keep.items()])


def enrich(facts: DataFrame, store: DataFrame, on: str) -> DataFrame:
    """Facts with the attributes of their store; a dimension small enough is broadcast by its size, not by a hint."""
    require(facts, on)
    require(store, on)
    return facts.join(store, on, "left")


def open_and_positive(df: DataFrame, value: str, open_: str | None = None) -> DataFrame:
    keep = col(value) > 0
    return df.where(keep & (col(open_) == 1) if open_ else keep)


def normalized(df: DataFrame, texts: Sequence[str]) -> DataFrame:
    return df.withColumns({c: col(c).cast("string") for c in texts if c in df.columns})


def retail_panel(train: DataFrame, store: DataFrame) -> DataFrame:
    """The public retail files as a panel: open days with sales, pipeline names, text columns as text, a placeholder flag."""
    rows = open_and_positive(enrich(train, store, "Store"), "Sales", "Open")
    rows = rows.withColumn("Date", F.to_date(F.expr("try_to_timestamp(Date)"))).withColumnsRenamed({"Store": "time_series_id", "Date": "ds", "Sales": "y"})
    if "is_short_series" not in rows.columns:
        rows = rows.withColumn("is_short_series", F.lit(False))
    return normalized(rows, ("time_series_id", "StateHoliday", "StoreType", "Assortment", "PromoInterval"))


def split_short(df: DataFrame, flag: str = "is_short_series") -> tuple[DataFrame, DataFrame]:
    """(long, short); a null flag is in neither."""
    return df.where(~col(flag)), df.where(col(flag))
