"""Settings of the layers, checked when they are made. Names of columns are parameters everywhere."""

from __future__ import annotations

import os
from collections.abc import Sequence
from dataclasses import dataclass, fields
from zoneinfo import ZoneInfo

GRAINS = ("week", "month")
INTERPOLATIONS = ("linear", "polynomial", "spline")


def _positive(owner: object, *names: str) -> None:
    for n in names:
        if not getattr(owner, n) > 0:
            raise ValueError(f"{n} must be greater than 0, is {getattr(owner, n)}")


def _one_of(what: str, value: str, allowed: Sequence[str]) -> None:
    if value not in allowed:
        raise ValueError(f"{what} must be one of {tuple(allowed)}, is {value!r}")


@dataclass(frozen=True)
class PanelConfig:
    """Preprocessing: from raw observations to a regular, cleaned panel."""

    source_table: str | None = None
    output_table: str | None = None
    raw_date: str = "date"
    raw_value: str = "y"
    group: str = "time_series_id"
    date: str = "ds"
    value: str = "y"
    key_columns: tuple[str, ...] = ()
    separator: str = "|"
    granularity: str = "week"
    price: str | None = None
    #: Dimensions carried along, by role; prefixes of names mean nothing.
    facility_dims: tuple[str, ...] = ()
    customer_dims: tuple[str, ...] = ()
    product_dims: tuple[str, ...] = ()
    numeric: tuple[str, ...] | None = None
    outlier_columns: tuple[str, ...] | None = None
    interpolation: str = "linear"
    interpolation_order: int = 3
    seasonal_period: int = 52
    short_threshold: int = 104
    inactive_threshold: int = 3
    insufficient_threshold: int = 1
    outlier_threshold: float = 3.0
    absolute_threshold: float = 1e5
    warn_levels: tuple[float, float, float] = (3.0, 5.0, 10.0)
    time_zone: str = "America/Chicago"

    def __post_init__(self) -> None:
        _positive(self, "short_threshold", "inactive_threshold", "insufficient_threshold", "outlier_threshold", "absolute_threshold", "interpolation_order")
        _one_of("granularity", self.granularity, GRAINS)
        _one_of("interpolation", self.interpolation, INTERPOLATIONS)
        if not self.warn_levels[0] <= self.warn_levels[1] <= self.warn_levels[2]:
            raise ValueError("warn_levels must ascend")
        ZoneInfo(self.time_zone)

    @property
    def dims(self) -> tuple[str, ...]:
        return (*self.facility_dims, *self.customer_dims, *self.product_dims)


@dataclass(frozen=True)
class ForecastConfig:
    horizon: int = 26
    granularity: str = "week"
    seasonal_period: int = 52
    min_history: int = 104
    test_length: int = 26
    test_end_anchor: str | None = None
    alpha: float = 0.05
    smoothing_alpha: float | None = None
    target: str = "y_clean_int"
    transformed: str | None = None
    lambda_column: str = "series_lambda"
    group: str = "time_series_id"
    date: str = "ds"
    short_flag: str = "is_short_series"
    short_strategy: str = "seasonal_naive"
    week_anchor: str = "panel"
    # accepted, without effect
    holiday_columns: tuple[str, ...] = ()
    exogenous_columns: tuple[str, ...] = ()
    baseline_method: str | None = None

    def __post_init__(self) -> None:
        _positive(self, "horizon", "seasonal_period", "min_history", "test_length")
        _one_of("granularity", self.granularity, GRAINS)
        _one_of("week_anchor", self.week_anchor, ("panel", "sunday"))
        if not 0 < self.alpha < 1:
            raise ValueError("alpha must lie between 0 and 1")


@dataclass(frozen=True)
class EvalConfig:
    group: str = "time_series_id"
    date: str = "ds"
    target: str = "y"
    forecast: str = "y_hat"
    baseline: str | None = None
    lower: str = "y_hat_lower"
    upper: str = "y_hat_upper"
    short_flag: str = "is_short_series"


@dataclass(frozen=True)
class PlotConfig:
    figure_size: tuple[float, float] = (12, 6)
    max_categories: int = 20
    year_day_step: int = 30


@dataclass(frozen=True)
class RetrievalConfig:
    root: str = "."
    glob: str = "*.py"
    index_path: str = "index"
    chunk_chars: int = 2000
    chunk_overlap: int = 200
    top_k: int = 8
    max_history_turns: int = 6
    temperature: float = 0.1

    def __post_init__(self) -> None:
        if not 0 <= self.chunk_overlap < self.chunk_chars:
            raise ValueError("needs 0 <= chunk_overlap < chunk_chars")


@dataclass(frozen=True)
class Settings:
    """From ``<prefix>NAME`` of the environment, else a ``.env`` file, else the defaults."""

    environment: str = "local"
    log_level: str = "INFO"
    db_url: str = ""
    api_key: str = ""

    @classmethod
    def load(cls, prefix: str = "APP_", env_file: str = ".env", environ: dict[str, str] | None = None) -> Settings:
        found: dict[str, str] = {}
        if os.path.exists(env_file):
            with open(env_file, encoding="utf-8") as f:
                for line in f:
                    name, sep, value = line.strip().partition("=")
                    if sep and not name.startswith("#"):
                        found[name.strip().upper()] = value.strip().strip("\"'")
        found |= {k.upper(): v for k, v in (os.environ if environ is None else environ).items()}
        return cls(**{f.name: found[(prefix + f.name).upper()] for f in fields(cls) if (prefix + f.name).upper() in found})
