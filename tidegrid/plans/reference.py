"""One query per operator of the panel toolkit, over whole tables, with SQL that says the same.

Panel W: supplier by week of shipping, quantity. Panel M: customer by month of order, total price. Panel E: user by week, value."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidegrid.config import EvalConfig, ForecastConfig, PanelConfig
from tidegrid.operators import artifacts as art
from tidegrid.operators import diagnostics as diag
from tidegrid.operators import evaluate as ev
from tidegrid.operators import flags, impute, panel, retrieval, transform
from tidegrid.operators import forecast as fc
from tidegrid.functions.common import checkpoint_dir
from tidegrid.plans import pipeline
from tidegrid.sources import tables

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}
G, D = "time_series_id", "ds"


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def sql() -> dict[str, str]:
    return dict(SQL)


def r6(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in columns})


# the panels

def lineitem(spark: SparkSession, d: str) -> DataFrame:
    return spark.read.parquet(f"{d}/lineitem.parquet")


def orders(spark: SparkSession, d: str) -> DataFrame:
    return spark.read.parquet(f"{d}/orders.parquet")


def panel_w(spark: SparkSession, d: str) -> DataFrame:
    rows = panel.add_period(lineitem(spark, d).withColumn(G, F.col("l_suppkey").cast("string")), "l_shipdate", "week")
    return panel.to_periods(rows, G, D, "l_quantity").withColumnRenamed("l_quantity", "y")


def panel_m(spark: SparkSession, d: str) -> DataFrame:
    rows = panel.add_period(orders(spark, d).withColumn(G, F.col("o_custkey").cast("string")), "o_orderdate", "month")
    return panel.to_periods(rows, G, D, "o_totalprice").withColumnRenamed("o_totalprice", "y")


def filled_w(spark: SparkSession, d: str) -> DataFrame:
    return panel.fill_gaps(panel_w(spark, d), G, D, "week")


def filled_m(spark: SparkSession, d: str) -> DataFrame:
    return panel.fill_gaps(panel_m(spark, d), G, D, "month")


def flagged_m(spark: SparkSession, d: str) -> DataFrame:
    """Monthly panel with a short flag (fewer than 48 months) and market segment."""
    m = flags.short_flag(filled_m(spark, d), D, G, 48)
    c = spark.read.parquet(f"{d}/customer.parquet").select(F.col("c_custkey").cast("string").alias(G), "c_mktsegment", "c_nationkey")
    return panel.enrich(m, c, G)


W = "w as (select cast(l_suppkey as varchar) time_series_id, cast(date_trunc('week', l_shipdate) as date) ds, sum(l_quantity) y from lineitem group by 1, 2)"
M = "m as (select cast(o_custkey as varchar) time_series_id, cast(date_trunc('month', o_orderdate) as date) ds, sum(o_totalprice) y from orders group by 1, 2)"


def _grid(t: str, step: str) -> str:
    return f"""{t}g as (select time_series_id, cast(unnest(generate_series(min(ds), max(ds), interval {step})) as date) ds from {t} group by 1),
{t}f as (select {t}g.time_series_id, {t}g.ds, {t}.y from {t}g left join {t} on {t}g.time_series_id = {t}.time_series_id and {t}g.ds = {t}.ds)"""


WF, MF = f"{W}, {_grid('w', '7 day')}", f"{M}, {_grid('m', '1 month')}"
MS = f"""{MF}, ms as (select mf.*, count(*) over (partition by time_series_id) series_length, count(*) over (partition by time_series_id) < 48 is_short_series, c_mktsegment, c_nationkey
from mf left join customer on time_series_id = cast(c_custkey as varchar))"""


# scans, cleaning, keys, periods

def _folder(spark: SparkSession, name: str) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


@query("select n_nationkey, n_name, n_regionkey from nation")
def view_scan(spark, d):
    tables.as_view(tables.read_parquet(spark, f"{d}/nation.parquet"), "nation_view")
    return tables.read_table(spark, "nation_view")


@query("select s_suppkey, s_name, s_nationkey, s_acctbal from supplier")
def csv_roundtrip(spark, d):
    path = _folder(spark, "csv")
    rows = tables.read_parquet(spark, f"{d}/supplier.parquet")
    rows.write.csv(path, header=True)
    return tables.read_csv(spark, path, rows.schema)


@query("select o_orderkey, o_custkey, year(o_orderdate) y from orders")
def parquet_roundtrip(spark, d):
    path = _folder(spark, "parquet")
    tables.write_parquet(orders(spark, d).withColumn("y", F.year("o_orderdate")), path, ("y",))
    return tables.read_parquet(spark, path).select("o_orderkey", "o_custkey", "y")


@query("select row_id, ds, y from ts_preprocessed where soldto_id = (select max(soldto_id) from ts_preprocessed)")
def dimension_filter(spark, d):
    rows = spark.read.parquet(f"{d}/ts_preprocessed.parquet")
    return rows.join(F.broadcast(rows.agg(F.max("soldto_id").alias("soldto_id"))), "soldto_id").select("row_id", "ds", "y")


@query("select 'long' part, count(*) n from ts_preprocessed where not is_short_series union all select 'short', count(*) from ts_preprocessed where is_short_series")
def short_split(spark, d):
    long, short = panel.split_short(spark.read.parquet(f"{d}/ts_preprocessed.parquet"))
    return long.agg(F.lit("long").alias("part"), F.count("*").alias("n")).unionByName(short.agg(F.lit("short").alias("part"), F.count("*").alias("n")))


@query("select l_returnflag, count(*) n, round(sum(l_quantity), 6) q from (select distinct * from lineitem) group by 1")
def scan_dedup(spark, d):
    rows = lineitem(spark, d)
    return r6(rows.unionByName(rows).dropDuplicates().groupBy("l_returnflag").agg(F.count("*").alias("n"), F.sum("l_quantity").alias("q")), "q")


@query("select concat_ws('|', cast(l_suppkey as varchar), l_returnflag) time_series_id, count(*) n from lineitem group by 1")
def composite_key(spark, d):
    return panel.composite_key(lineitem(spark, d), ["l_suppkey", "l_returnflag"]).groupBy(G).agg(F.count("*").alias("n"))


@query("select cast(date_trunc('week', l_shipdate) as date) ds, count(*) n from lineitem group by 1")
def period_week(spark, d):
    return panel.add_period(lineitem(spark, d), "l_shipdate", "week").groupBy(D).agg(F.count("*").alias("n"))


@query("select cast(date_trunc('month', o_orderdate) as date) ds, count(*) n from orders group by 1")
def period_month(spark, d):
    return panel.add_period(orders(spark, d), "o_orderdate", "month").groupBy(D).agg(F.count("*").alias("n"))


@query("select s_nationkey, count(*) n, round(sum(l_quantity), 6) q from lineitem left join supplier on l_suppkey = s_suppkey group by 1")
def star_enrich(spark, d):
    s = spark.read.parquet(f"{d}/supplier.parquet").withColumnRenamed("s_suppkey", "l_suppkey")
    return r6(panel.enrich(lineitem(spark, d), s, "l_suppkey").groupBy("s_nationkey").agg(F.count("*").alias("n"), F.sum("l_quantity").alias("q")), "q")


@query("select reading_id, time_series_id, y from rossmann_panel where y > 0 and Promo = 1")
def positive_filter(spark, d):
    return panel.open_and_positive(spark.read.parquet(f"{d}/rossmann_panel.parquet"), "y", "Promo").select("reading_id", G, "y")


@query("select s.Store, p.y, s.CompetitionDistance from rossmann_panel p left join (select distinct * from rossmann_store) s on try_cast(p.time_series_id as bigint) = s.Store where p.y > 0")
def retail_enrich(spark, d):
    p = spark.read.parquet(f"{d}/rossmann_panel.parquet").withColumn("Store", F.expr("try_cast(time_series_id as bigint)")).select("Store", "y")
    s = spark.read.parquet(f"{d}/rossmann_store.parquet").dropDuplicates()
    return panel.open_and_positive(panel.enrich(p, s.select("Store", "CompetitionDistance", F.lit(1).alias("_s")), "Store"), "y").select(F.when(F.col("_s").isNotNull(), F.col("Store")).alias("Store"), "y", "CompetitionDistance")


@query("select ds, y from (select cast(try_cast(substr(table_update_datetime, 1, 10) as date) as date) ds, round(sum(y), 4) y from ts_preprocessed group by 1)")
def date_parse(spark, d):
    rows = panel.add_period(spark.read.parquet(f"{d}/ts_preprocessed.parquet").select(F.substring("table_update_datetime", 1, 10).alias("raw"), "y"), "raw", "day")
    return rows.groupBy(D).agg(F.round(F.sum("y"), 4).alias("y"))


@query(f"with {W} select time_series_id, ds, round(y, 6) y from w")
def period_agg(spark, d):
    return r6(panel_w(spark, d), "y")


@query("""select cast(l_suppkey as varchar) time_series_id, cast(date_trunc('week', l_shipdate) as date) ds, round(sum(l_quantity), 6) l_quantity,
round(sum(l_extendedprice / l_quantity * l_quantity) / nullif(sum(l_quantity), 0), 4) product_wavg_unit_price, min(l_linestatus) l_linestatus from lineitem group by 1, 2""")
def weighted_price(spark, d):
    rows = lineitem(spark, d).withColumns({G: F.col("l_suppkey").cast("string"), "price": F.col("l_extendedprice") / F.col("l_quantity")})
    out = panel.to_periods(panel.add_period(rows, "l_shipdate", "week"), G, D, "l_quantity", "price", ["l_linestatus"])
    return r6(out, "l_quantity").withColumn("product_wavg_unit_price", F.round("product_wavg_unit_price", 4))


# calendar, flags, fills, outliers

@query(f"with {WF} select time_series_id, ds, round(y, 6) y from wf")
def gapfill_week(spark, d):
    return r6(filled_w(spark, d), "y")


@query(f"with {MF} select time_series_id, ds, round(y, 4) y from mf")
def gapfill_month(spark, d):
    return filled_m(spark, d).withColumn("y", F.round("y", 4))


_IDLE = f"""{WF}, a as (select *, case when y is null or y = 0 then 1 else 0 end is_inactive, min(ds) over g series_min_date, max(ds) over g series_max_date, max(ds) over () last from wf window g as (partition by time_series_id)),
b as (select *, sum(is_inactive) over (partition by time_series_id order by ds rows 2 preceding) run from a), c as (select *, max(run) over (partition by time_series_id) most from b),
e as (select *, max(case when run = most then ds end) over (partition by time_series_id) upto from c),
f as (select time_series_id, ds, y, is_inactive, series_min_date, series_max_date, series_max_date < last - interval 21 day is_obsolete, most >= 3 iswas_inactive, most < 3 never_inactive, most >= 3 and ds <= upto precedes_inactive_period from e)"""


@query(f"with {_IDLE} select time_series_id, ds, is_inactive, series_min_date, series_max_date, is_obsolete, iswas_inactive, never_inactive, precedes_inactive_period from f")
def inactivity_flags(spark, d):
    return flags.inactivity(filled_w(spark, d), "y", D, G, 3).drop("y")


@query(f"with {_IDLE} select time_series_id, ds from f where not is_obsolete and not precedes_inactive_period")
def inactivity_drop(spark, d):
    return flags.inactivity(filled_w(spark, d), "y", D, G, 3, drop=True).select(G, D)


@query(f"with {MF} select time_series_id, ds from mf qualify count(y) over (partition by time_series_id) >= 10")
def insufficient_filter(spark, d):
    return flags.enough_data(filled_m(spark, d), "y", G, 10).select(G, D)


def _holed(spark, d):
    return filled_m(spark, d).withColumn("dim", F.when(F.col("y").isNotNull() & (F.month(D) % 3 != 0), F.concat(F.lit("q"), F.quarter(D))))


_HOLED = f"{MF}, h as (select time_series_id, ds, case when y is not null and month(ds) % 3 <> 0 then 'q' || quarter(ds) end dim from mf)"


@query(f"""with {_HOLED} select time_series_id, ds, coalesce(last_value(dim ignore nulls) over (partition by time_series_id order by ds rows unbounded preceding),
last_value(dim ignore nulls) over (partition by time_series_id order by ds rows between unbounded preceding and unbounded following)) dim from h""")
def dim_fill_compat(spark, d):
    return flags.fill_dims(_holed(spark, d), ["dim"], D, G).select(G, D, "dim")


@query(f"""with {_HOLED} select time_series_id, ds, coalesce(last_value(dim ignore nulls) over (partition by time_series_id order by ds rows unbounded preceding),
first_value(dim ignore nulls) over (partition by time_series_id order by ds rows between current row and unbounded following)) dim from h""")
def dim_fill_nearest(spark, d):
    return flags.fill_dims(_holed(spark, d), ["dim"], D, G, "nearest").select(G, D, "dim")


def _outlier_sql(cte: str, t: str, k: float, most: float, places: int) -> str:
    return f"""with {cte}, s as (select *, avg(y) over g m, stddev_samp(y) over g sd from {t} window g as (partition by time_series_id)),
o as (select time_series_id, ds, y, coalesce(abs(case when sd > 1e-5 then (y - m) / sd else 0 end) > {k} and y is not null or abs(y) > {most}, false) y_is_outlier from s)
select time_series_id, ds, y_is_outlier, round(case when not y_is_outlier then y end, {places}) y_clean from o"""


@query(_outlier_sql(WF, "wf", 3, 1e5, 6))
def outlier_zscore(spark, d):
    return r6(flags.outliers(filled_w(spark, d), ["y"], G), "y_clean").drop("y")


@query(_outlier_sql(MF, "mf", 3, 1e5, 4))
def outlier_absolute(spark, d):
    return flags.outliers(filled_m(spark, d), ["y"], G).withColumn("y_clean", F.round("y_clean", 4)).drop("y")


# interpolation, length, median, Box-Cox

@query(f"""with {WF}, r as (select *, row_number() over (partition by time_series_id order by ds) rn from wf),
p as (select *, last_value(case when y is not null then rn end ignore nulls) over a pi, last_value(y ignore nulls) over a py, first_value(case when y is not null then rn end ignore nulls) over b ni, first_value(y ignore nulls) over b ny from r
window a as (partition by time_series_id order by ds rows unbounded preceding), b as (partition by time_series_id order by ds rows between current row and unbounded following))
select time_series_id, ds, round(case when pi is null then ny when ni is null or ni = pi then py else py + (ny - py) * (rn - pi) / (ni - pi) end, 6) y_int from p""")
def interp_linear(spark, d):
    return r6(impute.interpolate(filled_w(spark, d), ["y"], D, G), "y_int").drop("y")


@query()
def interp_poly(spark, d):
    return r6(impute.interpolate(filled_w(spark, d), ["y"], D, G, "polynomial", 3), "y_int")


@query()
def interp_spline(spark, d):
    return r6(impute.interpolate(filled_w(spark, d), ["y"], D, G, "spline", 3), "y_int")


@query(f"with {MS} select time_series_id, ds, series_length, is_short_series from ms")
def short_flag(spark, d):
    return flags.short_flag(filled_m(spark, d), D, G, 48).drop("y")


@query(f"with {WF} select distinct time_series_id, quantile_disc(y, 0.5) over (partition by time_series_id) series_median from wf")
def series_median(spark, d):
    return flags.series_median(filled_w(spark, d), "y", G).select(G, "series_median").distinct()


@query()
def boxcox_fit(spark, d):
    return r6(transform.lambdas(panel_w(spark, d), G, "y"), "series_lambda")


@query()
def boxcox_series(spark, d):
    return r6(transform.boxcox_transform(panel_w(spark, d), G, "y"), "y_transformed", "series_lambda")


@query(f"with {W} select time_series_id, ds, round((pow(y, 0.5) - 1) / 0.5, 6) y_transformed from w where y > 0")
def boxcox_fixed(spark, d):
    return r6(transform.apply_lambda(panel_w(spark, d), "y", 0.5), "y_transformed").drop("y")


@query(f"with {W} select time_series_id, ds, round(y, 6) y_transformed from w where y > 0")
def boxcox_inverse(spark, d):
    there = transform.apply_lambda(panel_w(spark, d), "y", 0.5).withColumns({"series_lambda": F.lit(0.5), "is_constant": F.lit(False)})
    return r6(transform.inverse_boxcox(there, ["y_transformed"]), "y_transformed").select(G, D, "y_transformed")


# diagnostics

@query(f"""with {MS}, b as (select min(ds) filter (where is_short_series) f from ms), a as (select count(distinct time_series_id) total_series, count(distinct case when is_short_series then time_series_id end) short_series,
coalesce(sum(y) filter (where is_short_series and ds >= f), 0) short_volume, coalesce(sum(y) filter (where ds >= f), 0) total_volume_window, cast(min(f) as varchar) min_short_date from ms, b)
select total_series, short_series, round(short_series / total_series, 6) short_ratio, round(short_volume, 2) short_volume, round(total_volume_window, 2) total_volume_window,
round(100 * short_volume / total_volume_window, 6) short_volume_pct, min_short_date, case when 100 * short_volume / total_volume_window < 3 then 'low' when 100 * short_volume / total_volume_window < 5 then 'moderate' when 100 * short_volume / total_volume_window < 10 then 'high' else 'very_high' end warning_level from a""")
def short_stats(spark, d):
    out = diag.short_report(flagged_m(spark, d), G, D, "y")
    return r6(out, "short_ratio", "short_volume_pct").withColumns({c: F.round(c, 2) for c in ("short_volume", "total_volume_window")}).drop("warning_message")


@query(f"with {MS} select time_series_id, max(series_length) series_length, bool_or(is_short_series) is_short_series from ms group by 1")
def length_dist(spark, d):
    return diag.length_distribution(flagged_m(spark, d), G)


@query(f"with {MS} select time_series_id, round(sum(y), 2) total_volume from ms group by 1")
def volume_dist(spark, d):
    return diag.volume_distribution(flagged_m(spark, d), G, "y").withColumn("total_volume", F.round("total_volume", 2))


@query(f"""with {MS} select time_series_id, count(y) n_obs, round(sum(y), 2) total_volume, round(avg(y), 4) mean_value, round(stddev_samp(y), 4) std_value, quantile_disc(y, 0.5) median_value, bool_or(is_short_series) is_short_series from ms group by 1""")
def series_summary(spark, d):
    out = diag.series_summary(flagged_m(spark, d), G, "y")
    return out.withColumns({"total_volume": F.round("total_volume", 2), "mean_value": F.round("mean_value", 4), "std_value": F.round("std_value", 4)})


_TS = ("row_id", "time_series_id", "soldto_id", "item_id", "ds", "y", "product_wavg_unit_price", "y_is_outlier", "y_clean", "is_inactive", "is_obsolete", "is_short_series", "load_id")


@query(" union all ".join(f"select '{c}' column_name, count(*) - count({c}) null_count, round((count(*) - count({c})) / count(*), 6) null_pct from ts_preprocessed" for c in _TS))
def null_profile(spark, d):
    return r6(diag.null_profile(spark.read.parquet(f"{d}/ts_preprocessed.parquet").select(*_TS)), "null_pct")


def _hist_sql(cte: str, source: str, n: int) -> str:
    return f"""with {cte}, v as ({source}), s as (select min(x) a, max(x) b from v), c as (select least({n}, cast(floor((x - a) / (b - a) * {n}) as bigint) + 1) bin, count(*) n from v, s group by 1)
select cast(i as bigint) bin, round(a + (i - 1) * (b - a) / {n}, 4) low, coalesce(n, 0) n from range(1, {n + 1}) t(i) cross join s left join c on c.bin = i"""


@query(_hist_sql(MS, "select max(series_length) x from ms group by time_series_id", 20))
def length_hist(spark, d):
    return diag.histogram(diag.length_distribution(flagged_m(spark, d), G), "series_length", 20).select("bin", F.round("low", 4).alias("low"), "n")


@query(_hist_sql(MS, "select max(series_length) x from ms where is_short_series group by time_series_id", 20))
def length_hist_short(spark, d):
    return diag.histogram(diag.length_distribution(flagged_m(spark, d), G).where("is_short_series"), "series_length", 20).select("bin", F.round("low", 4).alias("low"), "n")


@query(_hist_sql(MS, "select round(sum(y), 2) x from ms group by time_series_id", 20))
def volume_hist(spark, d):
    v = diag.volume_distribution(flagged_m(spark, d), G, "y").withColumn("total_volume", F.round("total_volume", 2))
    return diag.histogram(v, "total_volume", 20).select("bin", F.round("low", 4).alias("low"), "n")


@query(f"with {MS} select time_series_id, count(ds) series_length, round(sum(y), 2) total_volume, bool_or(is_short_series) is_short_series from ms group by 1")
def volume_vs_length(spark, d):
    return diag.volume_and_length(flagged_m(spark, d), G, D, "y").withColumn("total_volume", F.round("total_volume", 2))


@query(f"""with {MS}, s as (select time_series_id, bool_or(is_short_series) sh, sum(y) v from ms group by 1), k as (select distinct time_series_id, c_mktsegment from ms),
a as (select c_mktsegment, count(distinct time_series_id) n_series, count(distinct case when sh then time_series_id end) n_short_series, sum(v) tv, coalesce(sum(v) filter (where sh), 0) sv from s left join k using (time_series_id) group by 1)
select c_mktsegment, n_series, n_short_series, round(tv, 2) total_volume, round(sv, 2) short_volume, round(n_short_series / n_series, 6) short_series_ratio, round(sv / tv, 6) short_volume_ratio from a""")
def dim_short_summary(spark, d):
    out = diag.short_by_dimension(flagged_m(spark, d), "c_mktsegment", G, "y")
    return r6(out, "short_series_ratio", "short_volume_ratio").withColumns({c: F.round(c, 2) for c in ("total_volume", "short_volume")})


_BY = "s as (select time_series_id, bool_or(is_short_series) sh, sum(y) v from ms group by 1)"


@query(f"with {MS}, {_BY}, k as (select distinct time_series_id, 'c_mktsegment' dim, c_mktsegment val from ms union select distinct time_series_id, 'c_nationkey', cast(c_nationkey as varchar) from ms) "
       "select dim, val, count(distinct time_series_id) n_series, count(distinct case when sh then time_series_id end) n_short_series, round(sum(v), 2) total_volume from s join k using (time_series_id) group by 1, 2")  # fmt: skip
def dims_short_summary(spark, d):
    m, out = flagged_m(spark, d), None
    for dim in ("c_mktsegment", "c_nationkey"):
        one = diag.short_by_dimension(m, dim, G, "y").select(F.lit(dim).alias("dim"), F.col(dim).cast("string").alias("val"), "n_series", "n_short_series", F.round("total_volume", 2).alias("total_volume"))
        out = one if out is None else out.unionByName(one)
    return out


@query(f"with {MS} select c_nationkey, round(sum(y), 2) total_volume from ms where ds >= (select max(ds) from ms) - interval 364 day group by 1 order by 2 desc, 1 limit 15")
def dim_volume_topn(spark, d):
    return diag.volume_by_dimension(flagged_m(spark, d), "c_nationkey", "y", 15, D, 52).withColumn("total_volume", F.round("total_volume", 2))


@query(f"with {MS} select c_mktsegment, round(sum(y), 2) total_volume from ms group by 1 order by 2 desc limit 1")
def dim_leader(spark, d):
    return diag.volume_by_dimension(flagged_m(spark, d), "c_mktsegment", "y", 1).withColumn("total_volume", F.round("total_volume", 2))


_YD = "y as (select n_name, year(l_shipdate) yr, dayofyear(l_shipdate) doy, sum(l_quantity) v from lineitem join supplier on l_suppkey = s_suppkey join nation on s_nationkey = n_nationkey group by 1, 2, 3)"


def _by_nation(spark, d):
    s = spark.read.parquet(f"{d}/supplier.parquet").join(F.broadcast(spark.read.parquet(f"{d}/nation.parquet")), F.col("s_nationkey") == F.col("n_nationkey"))
    return diag.year_day_profile(lineitem(spark, d).join(s, F.col("l_suppkey") == F.col("s_suppkey")), "n_name", "l_shipdate", "l_quantity")


@query(f"with {_YD} select n_name, yr as year, doy day_of_year, round(v, 6) sum_value from y")
def year_day_profile(spark, d):
    return r6(_by_nation(spark, d), "sum_value")


_YEARS = [1992, 1993, 1994, 1995, 1996, 1997, 1998]


@query(f"with {_YD}, one as (select * from y where n_name = (select min(n_name) from y)), p as (select doy, {', '.join(f'sum(v) filter (where yr = {y}) c{y}' for y in _YEARS)} from one group by 1) "
       f"select doy day_of_year, {', '.join(f'round(last_value(c{y} ignore nulls) over (order by doy rows unbounded preceding), 6) y{y}' for y in _YEARS)} from p")  # fmt: skip
def year_day_pivot(spark, d):
    rows = _by_nation(spark, d)
    first = rows.agg(F.min("n_name")).first()[0]
    return r6(diag.year_day_pivot(rows, "n_name", first, _YEARS), *[f"y{y}" for y in _YEARS])


# forecasts

FC = ForecastConfig(horizon=26, target="y", short_flag="is_short_series")


def _split(spark, d):
    return fc.split_by_time(filled_w(spark, d), D, 26)


SPLIT = f"{WF}, cut as (select max(ds) - interval 182 day c from wf), tr as (select wf.* from wf, cut where ds <= c), te as (select wf.* from wf, cut where ds > c)"


@query(f"with {SPLIT} select time_series_id, ds, round(y, 6) y from tr")
def train_split(spark, d):
    return r6(_split(spark, d)[0], "y")


@query(f"with {SPLIT} select time_series_id, ds, round(y, 6) y from te")
def test_split(spark, d):
    return r6(_split(spark, d)[1], "y")


@query(f"with {MF}, cut as (select max(ds) - interval 6 month c from mf) select time_series_id, ds, round(y, 4) y from mf, cut where ds > c")
def test_split_month(spark, d):
    return fc.split_by_time(filled_m(spark, d), D, 6, "month")[1].withColumn("y", F.round("y", 4))


_LAST = f"{SPLIT}, l as (select time_series_id, max(ds) last, arg_max(y, ds) filter (where true) ly from (select time_series_id, ds, coalesce(y, -1) y from tr) group by 1)"
_NAIVE = "round(case when ly <> -1 then ly end, 6)"


@query(f"with {_LAST} select time_series_id, cast(last + to_days(cast(7 * i as integer)) as date) ds, {_NAIVE} y_hat, {_NAIVE} y_hat_lower, {_NAIVE} y_hat_upper from l, range(1, 27) t(i)")
def naive_fc(spark, d):
    return r6(fc.naive(_split(spark, d)[0], FC), "y_hat", "y_hat_lower", "y_hat_upper")


@query(f"with {_LAST} select time_series_id, cast(last + to_days(cast(7 + (7 - dayofweek(last)) % 7 + 7 * (i - 1) as integer)) as date) ds, {_NAIVE} y_hat from l, range(1, 27) t(i)")
def naive_fc_sunday(spark, d):
    cfg = ForecastConfig(horizon=26, target="y", week_anchor="sunday")
    return r6(fc.naive(_split(spark, d)[0], cfg), "y_hat").select(G, D, "y_hat")


_SN = f"""{SPLIT}, tl as (select *, row_number() over (partition by time_series_id order by ds desc) r, max(ds) over (partition by time_series_id) last from tr),
ps as (select time_series_id, last, y, row_number() over (partition by time_series_id order by ds) - 1 pos, count(*) over (partition by time_series_id) l from tl where r <= 52),
sn as (select time_series_id, cast(last + to_days(cast(7 * i as integer)) as date) ds, y y_hat from ps, range(1, 27) t(i) where (i - 1) % l = pos)"""


@query(f"with {_SN} select time_series_id, ds, round(y_hat, 6) y_hat from sn")
def seasonal_naive_fc(spark, d):
    return r6(fc.seasonal_naive(_split(spark, d)[0], FC), "y_hat").select(G, D, "y_hat")


def _ready(spark, d):
    train = flags.short_flag(impute.interpolate(_split(spark, d)[0], ["y"], D, G), D, G, 104)
    return train.drop("y").withColumnRenamed("y_int", "y")


@query()
def long_fc(spark, d):
    return r6(fc.long_forecast(_ready(spark, d), FC), "y_hat", "y_hat_lower", "y_hat_upper")


@query()
def panel_fc(spark, d):
    m = flags.short_flag(impute.interpolate(filled_m(spark, d), ["y"], D, G), D, G, 48).drop("y").withColumnRenamed("y_int", "y")
    cfg = ForecastConfig(horizon=6, granularity="month", seasonal_period=12, min_history=48, target="y")
    return fc.panel_forecast(m, cfg).withColumns({c: F.round(c, 4) for c in ("y_hat", "y_hat_lower", "y_hat_upper")})


@query(f"with {WF}, ly as (select time_series_id, cast(ds + interval 364 day as date) ds, y from wf) select a.time_series_id, a.ds, round(b.y, 6) baseline from wf a join ly b on a.time_series_id = b.time_series_id and a.ds = b.ds")
def baseline_last_year(spark, d):
    return r6(fc.last_year(filled_w(spark, d), G, D, "y"), "baseline")


# evaluation: the last 26 weeks against the seasonal naive forecast, with a band of 20

EV = EvalConfig()


def _aligned(spark, d):
    train, test = _split(spark, d)
    test = test.withColumn("is_short_series", F.col(G).cast("int") % 4 == 0)
    f = fc.seasonal_naive(train, FC).withColumns({"y_hat_lower": F.col("y_hat") - 20, "y_hat_upper": F.col("y_hat") + 20})
    return ev.align(test, f, EV)


AL = f"{_SN}, al as (select te.time_series_id, te.ds, te.y, y_hat, y_hat - 20 lo, y_hat + 20 hi, cast(te.time_series_id as int) % 4 = 0 sh from te join sn on te.time_series_id = sn.time_series_id and te.ds = sn.ds)"
_E = "round(sum(abs(y - y_hat)) {f} / nullif(sum(abs(y)) {f}, 0), 6) {p}wape, round(avg(abs(y - y_hat)) {f}, 6) {p}mae, round(sqrt(avg(pow(y - y_hat, 2)) {f}), 6) {p}rmse, round(avg(case when y <> 0 then abs(y - y_hat) / abs(y) end) {f}, 6) {p}mape"
_NAMES = ("wape", "mae", "rmse", "mape")


@query(f"with {AL} select time_series_id, ds, round(y, 6) y, round(y_hat, 6) y_hat, round(lo, 6) y_hat_lower, round(hi, 6) y_hat_upper, sh is_short_series from al")
def aligned_panel(spark, d):
    return r6(_aligned(spark, d), "y", "y_hat", "y_hat_lower", "y_hat_upper")


@query(f"with {AL} select {_E.format(f='', p='')}, count(*) n_rows, count(distinct time_series_id) n_series from al")
def panel_metrics(spark, d):
    return r6(ev.panel_metrics(_aligned(spark, d), EV), *_NAMES)


@query(f"with {AL} select time_series_id, count(*) n_obs, round(sum(abs(y)), 6) series_volume, {_E.format(f='', p='')}, bool_or(sh) is_short_series from al group by 1")
def series_metrics(spark, d):
    return r6(ev.series_metrics(_aligned(spark, d), EV), *_NAMES, "series_volume")


@query(f"""with {AL} select {_E.format(f='', p='panel_')}, count(*) panel_n_rows, count(distinct time_series_id) panel_n_series, {_E.format(f='filter (where not sh)', p='modeled_')}, count(*) filter (where not sh) modeled_n_rows,
count(distinct time_series_id) filter (where not sh) modeled_n_series, round(sum(abs(y)) filter (where not sh) / sum(abs(y)), 6) modeled_volume_pct from al""")
def dual_metrics(spark, d):
    return r6(ev.dual_metrics(_aligned(spark, d), EV), *[f"{p}_{n}" for p in ("panel", "modeled") for n in _NAMES], "modeled_volume_pct")


@query(f"with {AL} select round(avg(cast(y between lo and hi as int)), 6) inside, round(avg(cast(y < lo as int)), 6) below, round(avg(cast(y > hi as int)), 6) above, count(*) n_rows from al where y is not null and y_hat is not null")
def ci_coverage(spark, d):
    return r6(ev.coverage(_aligned(spark, d), EV), "inside", "below", "above")


@query(f"with {AL}, s as (select sum(abs(y)) v, sum(abs(y - y_hat)) / nullif(sum(abs(y)), 0) e from al group by time_series_id) select round(coalesce(sum(v) filter (where e > 0.7), 0), 6) high_error_volume, round(sum(v), 6) total_volume, round(coalesce(sum(v) filter (where e > 0.7), 0) / sum(v), 6) high_error_share from s where e is not null")
def high_error_share(spark, d):
    return r6(ev.high_error_share(ev.series_metrics(_aligned(spark, d), EV), over=0.7), "high_error_volume", "total_volume", "high_error_share")


@query(_hist_sql(AL, "select sum(abs(y - y_hat)) / nullif(sum(abs(y)), 0) x from al group by time_series_id having sum(abs(y)) > 0 and sum(abs(y - y_hat)) is not null", 30))
def metric_hist(spark, d):
    return diag.histogram(ev.series_metrics(_aligned(spark, d), EV), "wape", 30).select("bin", F.round("low", 4).alias("low"), "n")


@query(f"with {_SN} select ds, round(a.y, 6) y, round(b.y_hat, 6) y_hat from (select ds, y from wf where time_series_id = '1') a full join (select ds, y_hat from sn where time_series_id = '1') b using (ds)")
def actual_vs_fc_series(spark, d):
    f = fc.seasonal_naive(_split(spark, d)[0], FC).drop("y_hat_lower", "y_hat_upper")
    return r6(ev.actual_and_forecast(filled_w(spark, d), f, "1", EV), "y", "y_hat")


# dashboard tables

def _results(spark, d):
    train, test = _split(spark, d)
    s = spark.read.parquet(f"{d}/supplier.parquet").select(F.col("s_suppkey").cast("string").alias(G), "s_nationkey")
    test = panel.enrich(test, s, G)
    base = fc.last_year(filled_w(spark, d), G, D, "y")
    out = art.forecast_results(test, fc.seasonal_naive(train, FC), base, G, D, "y", dims=["s_nationkey"])
    return out.where(F.col("s_nationkey").isNotNull())


RES = f"""{_SN}, ly as (select time_series_id, cast(ds + interval 364 day as date) ds, y baseline from wf),
res as (select sn.time_series_id, sn.ds, y_hat, te.y, s_nationkey, baseline, 'run' run_id from sn join te on sn.time_series_id = te.time_series_id and sn.ds = te.ds join supplier on cast(s_suppkey as varchar) = sn.time_series_id
left join ly on ly.time_series_id = sn.time_series_id and ly.ds = sn.ds)"""


@query(f"with {RES} select time_series_id, ds, s_nationkey, round(y_hat, 6) y_hat, round(y, 6) y, round(baseline, 6) baseline, run_id from res")
def forecast_results(spark, d):
    return r6(_results(spark, d), "y_hat", "y", "baseline").drop("y_hat_lower", "y_hat_upper")


@query(f"with {RES} select s_nationkey, {_E.format(f='', p='')}, round(sum(y_hat - y) / nullif(sum(abs(y)), 0), 6) bias, count(*) n_rows, count(*) filter (where y = 0) n_excluded from res group by 1")
def metrics_by_slice(spark, d):
    return r6(art.metrics_by_slice(_results(spark, d), ["s_nationkey"]), *_NAMES, "bias")


@query(f"with {RES} select coalesce(s_nationkey, -1) s_nationkey, ds, round(sum(abs(y - y_hat)) / nullif(sum(abs(y)), 0), 6) wape, count(*) n_rows from res group by grouping sets ((s_nationkey), (ds), ())")
def metrics_levels(spark, d):
    return r6(art.metrics_by_slice(_results(spark, d), ["s_nationkey", D], [["s_nationkey"], [D], []]), "wape").select(F.coalesce("s_nationkey", F.lit(-1)).alias("s_nationkey"), D, "wape", "n_rows")


@query(f"with {RES}, a as (select ds, s_nationkey, sum(abs(y - y_hat)) e from res group by 1, 2) select ds, s_nationkey, round(e, 6) abs_error, round(e / nullif(sum(e) over (partition by ds), 0), 6) error_share, row_number() over (partition by ds order by e desc nulls last, s_nationkey) contribution_rank from a")
def error_contrib(spark, d):
    return r6(art.error_contribution(_results(spark, d), D, "s_nationkey"), "abs_error", "error_share")


@query(f"with {RES}, a as (select time_series_id, sum(abs(y)) volume, sum(abs(y - y_hat)) / nullif(sum(abs(y)), 0) wape from res group by 1) select time_series_id, round(volume, 6) volume, round(wape, 6) wape, round(quantile_disc(volume, 0.5) over (), 6) median_volume, round(quantile_disc(wape, 0.5) over (), 6) median_wape from a")
def scatter_points(spark, d):
    return r6(art.scatter_points(_results(spark, d), G), "volume", "wape", "median_volume", "median_wape")


@query(f"with {RES} select time_series_id, round(sum(abs(y - y_hat)), 6) abs_error, round(sum(abs(y - y_hat)) / nullif(sum(abs(y)), 0), 6) wape from res group by 1 order by sum(abs(y - y_hat)) desc nulls last, 1 limit 10")
def worst_offenders(spark, d):
    return r6(art.worst(_results(spark, d), G), "abs_error", "wape")


@query(f"with {RES}, e as (select s_nationkey, abs(y - y_hat) / abs(y) e from res where y <> 0 and y_hat is not null) select s_nationkey, count(*) n, {', '.join(f'round(quantile_disc(e, {q}), 6) {n}' for q, n in ((0, 'lowest'), (0.25, 'q1'), (0.5, 'median'), (0.75, 'q3'), (1, 'highest')))} from e group by 1")
def error_box(spark, d):
    return r6(art.error_box(_results(spark, d), "s_nationkey"), "lowest", "q1", "median", "q3", "highest")


@query(f"with {RES} select s_nationkey, cast(date_trunc('month', ds) as date) ds, round(sum(y), 6) y, round(sum(y_hat), 6) y_hat from res group by 1, 2")
def month_rollup(spark, d):
    return r6(art.month_rollup(_results(spark, d), D, ["s_nationkey"], ["y", "y_hat"]), "y", "y_hat")


@query(f"with {RES} select s_nationkey, month(ds) m, round(sum(abs(y - y_hat)) / nullif(sum(abs(y)), 0), 6) wape, round(sum(abs(y)), 6) volume from res group by 1, 2")
def heatmap(spark, d):
    return r6(art.heatmap(_results(spark, d).withColumn("m", F.month(D)), "s_nationkey", "m"), "wape", "volume")


@query(f"with {RES} select run_id, ds, round(sum(y), 6) y, round(sum(y_hat), 6) y_hat from res group by 1, 2")
def macro_agg(spark, d):
    return r6(art.macro(_results(spark, d), D), "y", "y_hat")


@query(f"with {RES} select time_series_id, ds, round(y, 6) y from res where s_nationkey in (1, 2, 3) and ds >= (select min(ds) from res)")
def dashboard_filter(spark, d):
    return r6(art.filtered(_results(spark, d), {"s_nationkey": [1, 2, 3]}), "y").select(G, D, "y")


@query(f"""with {RES}, k as (select time_series_id from res group by 1 order by sum(abs(y)) desc nulls last, time_series_id limit 20)
select case when k.time_series_id is null then 'Other' else r.time_series_id end time_series_id, round(sum(y), 6) y, (select count(distinct time_series_id) > 20 from res) is_limited from res r left join k on r.time_series_id = k.time_series_id group by 1""")
def top_traces(spark, d):
    out = art.top_traces(_results(spark, d), G, "y", 20, "Other")
    return r6(out.groupBy(G).agg(F.sum("y").alias("y"), F.first("is_limited").alias("is_limited")), "y")


# retrieval

def _files(spark, d):
    return spark.read.parquet(f"{d}/code_chunk.parquet").select(F.col("id").alias("file_path"), "text")


_CUT = r"""l as (select id, unnest(string_split(text, chr(10))) line, generate_subscripts(string_split(text, chr(10)), 1) i from code_chunk where regexp_matches(text, '\S')),
o as (select *, regexp_matches(line, '^\s*(def|class) ') b, max(cast(regexp_matches(line, '^\s*(def|class) ') as int)) over (partition by id) any_ from l),
c as (select *, case when any_ = 0 then 1 else sum(cast(b as int)) over (partition by id order by i rows unbounded preceding) end k from o)"""


@query(f"with {_CUT} select id || ':' || min(i) || '-' || max(i) id, id file_path, min(i) start_line, max(i) end_line, md5(string_agg(line, chr(10) order by i)) body from c where k > 0 group by file_path, k".replace("group by file_path, k", "group by c.id, k"))
def chunk_lines(spark, d):
    return retrieval.structural_chunks(_files(spark, d)).select("id", "file_path", "start_line", "end_line", F.md5("text").alias("body"))


@query("""select case when n > 2000 then id || '#part' || cast(o / 1800 + 1 as bigint) else id end id, md5(case when n > 2000 then substr(text, o + 1, 2000) else text end) body
from (select id, text, length(text) n, unnest(case when length(text) > 2000 then range(0, length(text), 1800) else [0] end) o from code_chunk)""")
def chunk_overlap(spark, d):
    chunks = spark.read.parquet(f"{d}/code_chunk.parquet").select("id", "text")
    return retrieval.overlapping_parts(chunks).select("id", F.md5("text").alias("body"))


@query(r"select doc_id from documents where regexp_matches(text, '\S')")
def nonblank(spark, d):
    return retrieval.not_blank(spark.read.parquet(f"{d}/documents.parquet")).select("doc_id")


@query("""select vec_id, round(list_dot_product(embedding::double[], q) / (sqrt(list_dot_product(embedding::double[], embedding::double[])) * sqrt(list_dot_product(q, q)) + 1e-8), 6) score
from embeddings, (select embedding::double[] q from embeddings where vec_id = 0) order by 2 desc, 1 limit 8""")
def cosine_topk(spark, d):
    e = spark.read.parquet(f"{d}/embeddings.parquet")
    q = e.where("vec_id = 0").select("embedding").first()[0]
    return r6(retrieval.search(e, list(q)), "score").select("vec_id", "score")


@query("""with p as (select q.vec_id query_id, e.vec_id, list_dot_product(e.embedding::double[], q.embedding::double[]) / (sqrt(list_dot_product(e.embedding::double[], e.embedding::double[])) * sqrt(list_dot_product(q.embedding::double[], q.embedding::double[])) + 1e-8) s
from embeddings e, embeddings q where q.vec_id % 50 = 0) select query_id, vec_id, round(s, 6) score, r as rank from (select *, row_number() over (partition by query_id order by s desc, vec_id) r from p) where r <= 8""")
def cosine_topk_batch(spark, d):
    e = spark.read.parquet(f"{d}/embeddings.parquet").select("vec_id", "embedding")
    q = e.where("vec_id % 50 = 0").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("query"))
    return r6(retrieval.search_many(e, q), "score").select("query_id", "vec_id", "score", "rank")


_TURNS = "t as (select user_id conv_id, event_id turn, event_type || ' ' || event_id text from events)"


def _turns(spark, d):
    return spark.read.parquet(f"{d}/events.parquet").select(F.col("user_id").alias("conv_id"), F.col("event_id").alias("turn"), F.concat_ws(" ", "event_type", "event_id").alias("text"))


@query(f"with {_TURNS}, h as (select *, string_agg(text, chr(10) || chr(10)) over (partition by conv_id order by turn rows between 6 preceding and 1 preceding) b from t) select conv_id, turn, md5(case when b is null then text else b || chr(10) || chr(10) || 'Follow-up question: ' || text end) q from h")
def retrieval_query(spark, d):
    return retrieval.retrieval_queries(_turns(spark, d), "conv_id", "turn", "text").select("conv_id", "turn", F.md5("query").alias("q"))


@query(f"with {_TURNS} select conv_id, turn from t qualify row_number() over (partition by conv_id order by turn desc) <= 6")
def last_turns(spark, d):
    return retrieval.last_turns(_turns(spark, d), "conv_id", "turn", 6).select("conv_id", "turn")


@query("""with r as (select *, row_number() over (partition by file_path order by start_line, id) rank from code_chunk)
select file_path, md5(string_agg('[' || rank || '] ' || file_path || ' :: ' || coalesce(object_name, '-') || ' (lines ' || start_line || '-' || end_line || ')' || chr(10) || text || chr(10) || repeat('-', 40), chr(10) order by rank)) context from r where rank <= 8 group by 1""")
def context_block(spark, d):
    w = Window.partitionBy("file_path").orderBy("start_line", "id")
    ranked = spark.read.parquet(f"{d}/code_chunk.parquet").withColumn("rank", F.row_number().over(w))
    return retrieval.context_block(ranked.where("rank <= 8"), "rank", "file_path").select("file_path", F.md5("context").alias("context"))


@query()
def hash_embed(spark, d):
    return retrieval.embed(spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "text")).select("doc_id", "embedding")


@query()
def rag_index(spark, d):
    return retrieval.build_index(_files(spark, d)).select("id", "file_path", "object_name", "start_line", "end_line", "embedding")


@query("select distinct file_path from code_chunk")
def indexed_files(spark, d):
    return spark.read.parquet(f"{d}/code_chunk.parquet").select("file_path").distinct()


# whole pipelines

@query(f"with {_IDLE}, s as (select time_series_id, bool_or(iswas_inactive) iswas_inactive, count(*) < 104 is_short_series, sum(y) y from f group by 1) select iswas_inactive, is_short_series, count(*) n_series, round(sum(y), 6) y from s group by 1, 2")
def weekly_panel_gapfill(spark, d):
    out = flags.short_flag(flags.inactivity(filled_w(spark, d), "y", D, G, 3), D, G, 104)
    return r6(out.groupBy("iswas_inactive", "is_short_series").agg(F.count_distinct(G).alias("n_series"), F.sum("y").alias("y")), "y")


@query()
def preprocess_pipeline(spark, d):
    s = spark.read.parquet(f"{d}/supplier.parquet").select(F.col("s_suppkey").alias("l_suppkey"), "s_nationkey")
    raw = panel.enrich(lineitem(spark, d), s, "l_suppkey").select(F.col("l_suppkey"), F.col("l_shipdate").alias("date"), F.col("l_quantity").alias("y"), (F.col("l_extendedprice") / F.col("l_quantity")).alias("price"), "s_nationkey", "l_orderkey", "l_linenumber")
    cfg = PanelConfig(key_columns=("l_suppkey",), price="price", customer_dims=("s_nationkey",))
    return pipeline.preprocess(raw, cfg, boxcox=True)


# what SQL can say of the numerical operators

_KNOWN = f"with {WF} select time_series_id, ds, round(y, 6) y_int, (select count(*) from wf) n_filled from wf where y is not null"


def _known(df: DataFrame) -> DataFrame:
    """Observed values stay as they are, and no period of a series that has any value stays empty."""
    filled = df.agg(F.count("y_int").alias("n_filled"))
    return r6(df.where("y is not null").select(G, D, "y_int"), "y_int").crossJoin(F.broadcast(filled))


@query(_KNOWN)
def interp_poly_known(spark, d):
    return _known(impute.interpolate(filled_w(spark, d), ["y"], D, G, "polynomial", 3))


@query(_KNOWN)
def interp_spline_known(spark, d):
    return _known(impute.interpolate(filled_w(spark, d), ["y"], D, G, "spline", 3))


@query(f"with {W}, k as (select *, max(y) over g - min(y) over g < 1e-12 flat, min(y) over g <= 0 low from w window g as (partition by time_series_id)) select time_series_id, ds, round(y, 4) y, flat or low is_constant from k")
def boxcox_round_trip(spark, d):
    """Transformed with the fitted lambda of the series and back."""
    there = transform.boxcox_transform(panel_w(spark, d), G, "y")
    back = transform.inverse_boxcox(there.withColumnRenamed("y", "_y"), ["y_transformed"])
    return back.select(G, D, F.round("y_transformed", 4).alias("y"), "is_constant")


_LONG = f"""with {SPLIT}, f as (select tr.*, count(*) over (partition by time_series_id) n, max(y) over (partition by time_series_id) - min(y) over (partition by time_series_id) spread from tr),
last as (select time_series_id, max(ds) ds, max(n) n, max(spread) spread from f group by 1), st as (select unnest(range(1, 27)) i)"""


@query(f"""{_LONG} select time_series_id, cast(last.ds + i * interval 7 day as date) ds, case when n < 104 or spread < 1e-12 then 'naive' else 'stl_holt' end "method",
 case when n < 104 then n || ' periods, 104 needed' when spread < 1e-12 then 'constant' end fallback_reason, true ordered from last, st""")
def long_fc_methods(spark, d):
    """Dates, methods, reasons, and bounds on the right sides of the forecast."""
    ordered = F.expr("y_hat_lower <= y_hat and y_hat <= y_hat_upper and abs(y_hat) < 1e12")
    return fc.long_forecast(_ready(spark, d), FC).select(G, D, "method", "fallback_reason", ordered.alias("ordered"))


@query(f"""with {MF}, t as (select time_series_id, max(ds) last, count(*) n, max(y) - min(y) spread from mf group by 1), st as (select unnest(range(1, 7)) i)
 select time_series_id, cast(last + i * interval 1 month as date) ds, case when n < 48 then 'seasonal_naive' when spread < 1e-12 then 'naive' else 'stl_holt' end "method" from t, st""")
def panel_fc_methods(spark, d):
    return panel_fc(spark, d).select(G, D, "method")


@query(r"select doc_id, case when text is not null then 64 end dims, case when not regexp_matches(text, '\S') then 0.0 when text is not null then 1.0 end norm from documents")
def hash_embed_norms(spark, d):
    got = hash_embed(spark, d)
    return got.select("doc_id", F.when(F.col("embedding").isNotNull(), F.size("embedding")).alias("dims"), F.round(F.sqrt(F.aggregate("embedding", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))), 3).alias("norm"))


@query(rf"""with {_CUT}, t as (select id || ':' || min(i) || '-' || max(i) id, id file_path, min(i) start_line, max(i) end_line, string_agg(line, chr(10) order by i) body from c where k > 0 group by c.id, k),
 p as (select *, unnest(case when length(body) > 2000 then range(0, length(body), 1800) else [0] end) o from t)
 select case when length(body) > 2000 then id || '#part' || cast(o / 1800 + 1 as bigint) else id end id, file_path, start_line, end_line from p where regexp_matches(substr(body, o + 1, 2000), '\S')""")
def rag_index_parts(spark, d):
    return rag_index(spark, d).select("id", "file_path", "start_line", "end_line")


@query(f"with {WF} select time_series_id, ds, round(y, 6) y, count(*) over (partition by time_series_id) series_length, min(ds) over (partition by time_series_id) series_min_date, coalesce(y, 0) = 0 is_inactive from wf")
def preprocess_panel(spark, d):
    return r6(preprocess_pipeline(spark, d), "y").select(G, D, "y", "series_length", "series_min_date", (F.col("is_inactive") == 1).alias("is_inactive"))


@query("""select p.time_series_id, cast(p.ds as date) ds, p.y, p.StateHoliday, s.StoreType, s.Assortment, s.PromoInterval, p.is_short_series from rossmann_panel p left join (select distinct * from rossmann_store) s
 on try_cast(p.time_series_id as bigint) = s.Store where p.y > 0 and try_cast(p.time_series_id as bigint) is not null""")
def retail_panel(spark, d):
    """The read-outs as the public retail files have them, joined to their stores and named as a panel."""
    p = spark.read.parquet(f"{d}/rossmann_panel.parquet")
    train = p.select(F.expr("try_cast(time_series_id as bigint)").alias("Store"), F.date_format("ds", "yyyy-MM-dd").alias("Date"), F.col("y").alias("Sales"), F.lit(1).alias("Open"), "StateHoliday", "is_short_series").where("Store is not null")
    store = spark.read.parquet(f"{d}/rossmann_store.parquet").dropDuplicates().select("Store", "StoreType", "Assortment", "PromoInterval")
    return panel.retail_panel(train, store).select(G, D, "y", "StateHoliday", "StoreType", "Assortment", "PromoInterval", "is_short_series")
