"""Window transforms on long dense panels.

All windows are partitioned by the series key and ordered by date, so the
work spreads over keys and never lands in one task.  Consecutive steps use
the same partition key, so Spark plans them over a single Exchange + Sort.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelcast.functions.columns import full_frame_mean, running_chain, safe_ln

SERIES_KEYS = ("entity", "indicator")
TARGET_KEYS = ("entity", "target")


def series_window(keys: Sequence[str] = SERIES_KEYS, order: str = "date"):
    return Window.partitionBy(*keys).orderBy(order)


def positivity_profile(panel: DataFrame, until=None) -> DataFrame:
    """A1: per indicator, rows with value <= 0; none => log transform allowed.

    ``until`` restricts the profile to data up to that date (the reference
    profiles the whole sample, test period included).  One row per
    indicator, so the result is bounded by the indicator catalogue.
    """
    src = panel if until is None else panel.filter(F.col("date") <= F.lit(until).cast("date"))
    return src.groupBy("indicator").agg(F.count_if(F.col("value") <= 0).alias("n_nonpos")).select(
        "indicator", "n_nonpos",
        F.when(F.col("n_nonpos") == 0, F.lit("log")).otherwise(F.lit("level")).alias("transform"))


def chain_index(index_panel: DataFrame, keys: Sequence[str] = SERIES_KEYS) -> DataFrame:
    """Chained index (base = previous period = 100) -> level."""
    w = series_window(keys)
    return index_panel.withColumn("level", running_chain("value", w))


def yoy_diff(dense: DataFrame, profile: DataFrame, lag: int = 12, keys: Sequence[str] = SERIES_KEYS) -> DataFrame:
    """Year-on-year log difference for positive series, level difference otherwise.

    The profile has one row per indicator; AQE broadcasts it if it is small.
    """
    w = series_window(keys)
    j = dense.join(profile.select("indicator", "transform"), "indicator")
    is_log = F.col("transform") == "log"
    x = F.when(is_log, safe_ln("value")).otherwise(F.col("value"))
    return j.withColumn("d12", x - F.lag(x, lag).over(w)).withColumn(
        "feature", F.concat(F.col("indicator"), F.when(is_log, F.lit("_log_d12")).otherwise(F.lit("_d12"))))


def rolling_means(df: DataFrame, value_col: str, windows: Sequence[int], keys: Sequence[str] = SERIES_KEYS) -> DataFrame:
    """Full-frame trailing means of ``value_col`` for every window width."""
    w = series_window(keys)
    return df.select("*", *(full_frame_mean(value_col, w, k).alias(f"roll_{k}") for k in windows))


def log_diff(dense: DataFrame, value_col: str, lag: int, keys: Sequence[str] = TARGET_KEYS) -> DataFrame:
    """ln(x) - ln(x lagged) on a dense series (non-positive -> NULL)."""
    w = series_window(keys)
    lx = safe_ln(value_col)
    return dense.withColumn("y", lx - F.lag(lx, lag).over(w))


def add_lags(df: DataFrame, value_col: str, lags: Sequence[int], keys: Sequence[str], prefix: str = "lag") -> DataFrame:
    """Positional lags (the series must be dense)."""
    w = series_window(keys)
    return df.select("*", *(F.lag(value_col, k).over(w).alias(f"{prefix}{k}") for k in lags))


def naive_forecasts(targets: DataFrame, horizons: Sequence[int], keys: Sequence[str] = TARGET_KEYS) -> DataFrame:
    """Random-walk forecast y_{t-h} for every horizon, long by horizon."""
    lagged = add_lags(targets, "y", horizons, keys, prefix="p")
    return lagged.unpivot([*keys, "date", "y"], [f"p{h}" for h in horizons], "h_name", "pred").select(
        *keys, "date", F.substring("h_name", 2, 3).cast("int").alias("horizon"), "y", "pred")
