"""Scoring: RMSE, naive benchmark, relative RMSE, leaderboard.

All models are scored by ONE join of the uniform ``forecasts`` table with
the actuals and ONE keyed aggregate; the reference loops over targets and
models and concatenates small frames.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelcast.functions.columns import crps_gaussian, full_frame_mean, round_fixed, to_date
from panelcast.operators.series import TARGET_KEYS, naive_forecasts

# Uniform forecast record (one schema for every model family).
FORECASTS_SCHEMA = T.StructType([
    T.StructField("run_id", T.StringType()),
    T.StructField("model", T.StringType()),
    T.StructField("entity", T.StringType()),
    T.StructField("target", T.StringType()),
    T.StructField("features_type", T.StringType()),
    T.StructField("availability", T.IntegerType()),
    T.StructField("horizon", T.IntegerType()),
    T.StructField("origin", T.DateType()),
    T.StructField("date", T.DateType()),
    T.StructField("pred", T.DoubleType()),
    T.StructField("lo", T.DoubleType()),
    T.StructField("hi", T.DoubleType()),
])

# Metrics record, fixed column order of the reference's metrics table.
METRICS_COLUMNS = ("horizon", "availability", "features_type", "rmse", "target", "model", "rmse_naive", "rel_rmse_naive")

CELL_KEYS = ("model", "target", "features_type", "availability", "horizon")

# Fixed value: standard normal quantile of 0.84, half-width of a 68% central band.
Z68 = 0.994457883209753


def squared_error(pred: str = "pred", y: str = "y"):
    return F.pow(F.col(pred) - F.col(y), 2)


def rmse(scored: DataFrame, keys: Sequence[str] = CELL_KEYS) -> DataFrame:
    """A3: sqrt(mean squared error) per key; NULL errors are skipped as in the reference."""
    return scored.groupBy(*keys).agg(F.sqrt(F.avg(squared_error())).alias("rmse"),
                                     F.count(squared_error()).alias("n_obs"))


def join_actuals(forecasts: DataFrame, actuals: DataFrame) -> DataFrame:
    """Every model's forecasts against the actuals in one equi-join."""
    return forecasts.join(actuals.select("entity", "target", "date", "y"), ["entity", "target", "date"])


def naive_rmse(actuals: DataFrame, horizons: Sequence[int], test_lo: dt.date, test_hi: dt.date) -> DataFrame:
    """A4/M6: random-walk RMSE per (target, horizon) over the test window."""
    nf = naive_forecasts(actuals, horizons).filter(F.col("date").between(to_date(test_lo), to_date(test_hi)))
    return nf.groupBy("target", "horizon").agg(F.sqrt(F.avg(squared_error())).alias("rmse_naive"),
                                               F.count(squared_error()).alias("n_obs"))


def relative(metrics: DataFrame, naive: DataFrame, how: str = "left") -> DataFrame:
    """Attach the naive RMSE and divide.

    ``naive`` has one row per (target, horizon); AQE broadcasts it if it is small.
    """
    n = naive.select("target", "horizon", "rmse_naive")
    return metrics.join(n, ["target", "horizon"], how).withColumn(
        "rel_rmse_naive", F.try_divide(F.col("rmse"), F.col("rmse_naive")))


def sort_by_cell(metrics: DataFrame) -> DataFrame:
    """O2: final output order of grouped metrics, by their keys."""
    return metrics.orderBy("model", "target", "features_type", "availability", "horizon")


def sort_metrics(metrics: DataFrame) -> DataFrame:
    """O3: target, horizon, availability descending; the other keys make the order total."""
    return metrics.orderBy("target", "horizon", F.desc("availability"), "model", "features_type")


def leaderboard(metrics: DataFrame, keys: Sequence[str] = ("target", "horizon", "availability")) -> DataFrame:
    """Best relative RMSE per key and the (model, features_type) reaching it, sorted by key.

    NULL scores never win.  Scores are ranked at 12 decimals, below which they are summation noise;
    ties go to the smallest (model, features_type).
    """
    ok = metrics.filter(F.col("rel_rmse_naive").isNotNull() & ~F.isnan("rel_rmse_naive"))
    best = F.min(F.struct(round_fixed("rel_rmse_naive", 12).alias("rank"), "model", "features_type", "rel_rmse_naive")).alias("b")
    return ok.groupBy(*keys).agg(best).select(
        *keys, F.col("b.rel_rmse_naive").alias("best_rel_rmse_naive"),
        F.col("b.model").alias("best_model"), F.col("b.features_type").alias("best_features_type")).orderBy(*keys)


def pseudo_forecasts(actuals: DataFrame, horizons: Sequence[int], availabilities: Sequence[int],
                     features_types: Sequence[str], test_lo: dt.date, test_hi: dt.date) -> DataFrame:
    """Deterministic benchmark forecasts in the uniform record.

    ``naive`` = y(t-h); ``snaive`` = y(t-4*ceil(h/4)); ``mean4`` = full mean of
    y(t-h-3..t-h) with a band of +-1 population std of the same four values.
    They are tagged over the (availability, features_type) grid so scoring
    and the leaderboard run over a complete grid.
    """
    w = Window.partitionBy(*TARGET_KEYS).orderBy("date")
    four = w.rowsBetween(-3, Window.currentRow)
    base = actuals.withColumn("m4", full_frame_mean("y", w, 4)).withColumn(
        "s4", F.when(F.count("y").over(four) == 4, F.stddev_pop("y").over(four)))
    none = F.lit(None).cast("double")
    lags = []
    cols = []
    for h in horizons:
        s = 4 * ((h + 3) // 4)
        lags += [F.lag("y", h).over(w).alias(f"n{h}"), F.lag("y", s).over(w).alias(f"s{h}"),
                 F.lag("m4", h).over(w).alias(f"m{h}"), F.lag("s4", h).over(w).alias(f"d{h}")]
        m4, s4 = F.col(f"m{h}"), F.col(f"d{h}")
        cols += [F.struct(F.lit("naive").alias("model"), F.lit(h).alias("horizon"), F.col(f"n{h}").alias("pred"),
                          none.alias("lo"), none.alias("hi")),
                 F.struct(F.lit("snaive").alias("model"), F.lit(h).alias("horizon"), F.col(f"s{h}").alias("pred"),
                          none.alias("lo"), none.alias("hi")),
                 F.struct(F.lit("mean4").alias("model"), F.lit(h).alias("horizon"), m4.alias("pred"),
                          (m4 - Z68 * s4).alias("lo"), (m4 + Z68 * s4).alias("hi"))]
    base = base.select(*TARGET_KEYS, "date", *lags)
    grid = [F.struct(F.lit(a).alias("availability"), F.lit(ft).alias("features_type"))
            for a in availabilities for ft in features_types]
    f = base.select(*TARGET_KEYS, "date", F.explode(F.array(*cols)).alias("f"))
    f = f.filter(F.col("date").between(to_date(test_lo), to_date(test_hi)))
    return f.select(
        F.lit("bench").alias("run_id"), "f.model", "entity", "target",
        F.explode(F.array(*grid)).alias("g"), "f.horizon", "date", "f.pred", "f.lo", "f.hi",
    ).select("run_id", "model", "entity", "target", "g.features_type", "g.availability", "horizon",
             F.expr("add_months(date, -3 * horizon)").alias("origin"), "date", "pred", "lo", "hi")


def shift_forecast_dates(records: DataFrame, months: int = -2) -> DataFrame:
    """Quarter-end dated forecast records (fcst_date, median, variable) -> uniform, date moved by ``months``."""
    return records.select(
        F.add_months(F.col("fcst_date"), months).alias("date"), F.col("median").alias("pred"),
        F.col("variable").alias("target"), *(c for c in records.columns if c not in ("fcst_date", "median", "variable", "p")))


def metrics_table(forecasts: DataFrame, actuals: DataFrame, horizons: Sequence[int],
                  test_lo: dt.date, test_hi: dt.date) -> DataFrame:
    """Every model scored in one join + one aggregate, then made relative."""
    scored = join_actuals(forecasts.filter(F.col("date").between(to_date(test_lo), to_date(test_hi))), actuals)
    m = rmse(scored)
    naive = naive_rmse(actuals, horizons, test_lo, test_hi)
    return relative(m, naive).select(*METRICS_COLUMNS)


def crps_table(forecasts: DataFrame, actuals: DataFrame, keys: Sequence[str] = CELL_KEYS) -> DataFrame:
    """Mean Gaussian CRPS per cell for forecasts carrying a band (sigma from lo/hi)."""
    s = join_actuals(forecasts, actuals).withColumn("sigma", (F.col("hi") - F.col("lo")) / (2 * Z68))
    s = s.filter(F.col("sigma") > 0)
    return s.groupBy(*keys).agg(F.avg(crps_gaussian("y", "pred", "sigma")).alias("crps"), F.count("*").alias("n_obs"))
