"""The layers put together: raw rows to a preprocessed panel, diagnostics and forecasts, as lazy plans."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegrid.config import ForecastConfig, PanelConfig
from tidegrid.functions.common import present
from tidegrid.operators import diagnostics, flags, forecast, impute, panel, transform
from tidegrid.sources.tables import read_table, write_table


def preprocess(raw: DataFrame, cfg: PanelConfig, boxcox: bool = False) -> DataFrame:
    """Clean, key, truncate, aggregate, fill gaps, flag, clean outliers, interpolate, measure: one exchange by (series, period), one by series that all windows share."""
    g, d, y = cfg.group, cfg.date, cfg.value
    df = panel.add_period(panel.clean(raw, cfg), cfg.raw_date, cfg.granularity, d)
    dims = [c for c in cfg.dims if c in df.columns]
    dated = df.where(F.col(d).isNotNull())
    df = panel.to_periods(dated, g, d, y, cfg.price, dims)
    df = panel.fill_gaps(df, g, d, cfg.granularity)
    df = flags.inactivity(df, y, d, g, cfg.inactive_threshold, until=dated)
    df = flags.enough_data(df, y, g, cfg.insufficient_threshold)
    df = flags.fill_dims(df, dims, d, g)
    df = flags.outliers(df, cfg.outlier_columns or (y,), g, cfg.outlier_threshold, cfg.absolute_threshold)
    wanted = cfg.numeric or (y, f"{y}_clean", "product_wavg_unit_price")
    if cfg.numeric and (gone := [c for c in cfg.numeric if c not in df.columns]):
        raise ValueError(f"missing columns: {gone}")
    df = impute.interpolate(df, [c for c in wanted if c in df.columns], d, g, cfg.interpolation, cfg.interpolation_order)
    df = flags.short_flag(df, d, g, cfg.short_threshold)
    df = flags.series_median(df, f"{y}_clean_int", g)
    return transform.boxcox_transform(df, g, f"{y}_clean_int") if boxcox else df


def run(spark: SparkSession, cfg: PanelConfig, boxcox: bool = False) -> DataFrame:
    """From the source table to the output table; diagnostics then read what was written instead of computing it again."""
    out = preprocess(read_table(spark, cfg.source_table), cfg, boxcox)
    if not cfg.output_table:
        return out
    write_table(out, cfg.output_table, cfg.time_zone)
    return read_table(spark, cfg.output_table)


def diagnose(df: DataFrame, cfg: PanelConfig) -> dict[str, DataFrame]:
    g, d, y = cfg.group, cfg.date, f"{cfg.value}_clean"
    return {
        "short_report": diagnostics.short_report(df, g, d, y, levels=cfg.warn_levels), "length": diagnostics.length_distribution(df, g, d), "volume": diagnostics.volume_distribution(df, g, y),
        "summary": diagnostics.series_summary(df, g, y), "nulls": diagnostics.null_profile(df),
        **{f"short_by_{c}": diagnostics.short_by_dimension(df, c, g, y) for c in cfg.dims if c in df.columns},
    }


def forecast_panel(df: DataFrame, cfg: ForecastConfig) -> DataFrame:
    return forecast.panel_forecast(df.where(present(df, cfg.target)), cfg)
