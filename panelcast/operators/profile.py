"""Null and scale profiles of long panels.

Profiles are keyed aggregates (partial + final aggregation); their results
have one row per series or per feature, so joining them back is a small
broadcast only when that count is bounded by the feature catalogue.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def null_counts(panel: DataFrame, keys: Sequence[str], value_col: str = "value", max_nulls: int = 12) -> DataFrame:
    """NULL count per series and whether it stays under the threshold."""
    return panel.groupBy(*keys).agg(
        F.count_if(F.col(value_col).isNull()).alias("n_null"), F.count("*").alias("n_rows")).withColumn(
        "keep", F.col("n_null") <= max_nulls)


def keep_series(panel: DataFrame, counts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Series passing the threshold (semi-join on the series key)."""
    return panel.join(counts.filter("keep").select(*keys), list(keys), "left_semi")


def complete_cases(panel: DataFrame, row_keys: Sequence[str], value_col: str = "value") -> DataFrame:
    """Rows of the (virtual) wide table with no NULL in any column."""
    return panel.groupBy(*row_keys).agg(
        F.count(value_col).alias("n_values"), F.count("*").alias("n_cols")).filter(
        F.col("n_values") == F.col("n_cols"))


def null_free(design: DataFrame, fit_rows: str = "split IN ('train', 'valid')", column: str = "column") -> DataFrame:
    """Per design column, NULLs over the fitting rows; null-free columns may be used."""
    rows = design.filter(fit_rows)
    return rows.groupBy(column).agg(
        F.count_if(F.col("value").isNull()).alias("n_null"), F.count("*").alias("n_rows")).withColumn(
        "null_free", F.col("n_null") == 0)


def scale_stats(design: DataFrame, fit_rows: str = "split = 'train'", column: str = "column") -> DataFrame:
    """Mean and population std per column on the fitting rows (sigma 0 -> 1)."""
    s = design.filter(fit_rows).groupBy(column).agg(
        F.avg("value").alias("mu"), F.stddev_pop("value").alias("sd"))
    return s.withColumn("sigma", F.when((F.col("sd") > 0), F.col("sd")).otherwise(F.lit(1.0))).drop("sd")


def standardise(design: DataFrame, stats: DataFrame, column: str = "column") -> DataFrame:
    """(x - mu) / sigma with statistics from the fitting rows only (no leakage)."""
    j = design.join(F.broadcast(stats.select(column, "mu", "sigma")), column, "left")
    return j.withColumn("z", (F.col("value") - F.col("mu")) / F.col("sigma"))
