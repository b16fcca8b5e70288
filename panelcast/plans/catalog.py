"""Named query plans: (spark, sf_dir) -> DataFrame, one per operator family.

Every plan reads the supplied tables (nothing synthetic), runs over whole
tables, and ends with a projection whose column names equal those of its
SQL twin in ``panelcast.plans.oracle``.  Doubles are rounded at the output
(6 decimals) so that two engines summing in different orders agree.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelcast.functions.columns import round_fixed
from panelcast.operators.features import PanelBuild
from panelcast.operators.score import naive_rmse
from panelcast.params import TEST_PARAMS, Params

QueryFn = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, QueryFn] = {}


def query(fn: QueryFn) -> QueryFn:
    REGISTRY[fn.__name__] = fn
    return fn


def r6(c: str, name: str | None = None):
    return round_fixed(c, 6).alias(name or c)


def build(spark: SparkSession, sf_dir: str, params: Params = TEST_PARAMS) -> PanelBuild:
    return PanelBuild(spark, sf_dir, params)


# Step 1: minimum slice -----------------------------------------------------

@query
def naive_rmse_by_target_horizon(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Random-walk back-test RMSE per target and horizon."""
    b = build(spark, sf_dir)
    lo, hi = b.test_bounds()
    nr = naive_rmse(b.actuals(), range(1, b.params.horizon + 1), lo, hi)
    return nr.select("target", "horizon", r6("rmse_naive"), "n_obs")


# Step 2: monthly panel and transforms -------------------------------------

@query
def monthly_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order indicators as a long monthly panel (entity, indicator, date, value)."""
    return build(spark, sf_dir).panel_m().select("entity", "indicator", "date", r6("value"))


@query
def monthly_spine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order panel on a dense monthly spine between global bounds."""
    return build(spark, sf_dir).spine_m().select("entity", "indicator", "date", r6("value"))


@query
def join_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order and shipment sources together, restricted to the order spine dates."""
    return build(spark, sf_dir).dense_m().select("entity", "indicator", "date", r6("value"))


@query
def positivity_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1, U4: non-positive counts per indicator and the transform they imply."""
    return build(spark, sf_dir).profile()


@query
def chain_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Month-on-month revenue index rebuilt into a level by chaining."""
    from panelcast.operators.series import chain_index as chain
    from panelcast.sources.adapters import index_m

    c = chain(index_m(build(spark, sf_dir).spine_m()))
    return c.select("entity", "indicator", "date", r6("value"), round_fixed("level", 4).alias("level"))


def _d12(spark: SparkSession, sf_dir: str, transform: str) -> DataFrame:
    mf = build(spark, sf_dir).monthly_features()
    suffix = "_log_d12" if transform == "log" else "_d12"
    keep = (F.col("features_type") == "d12") & F.col("feature").endswith(suffix)
    if transform != "log":
        keep = keep & ~F.col("feature").endswith("_log_d12")
    return mf.filter(keep).select("entity", "indicator", "feature", "date", r6("value"))


@query
def yoy_log_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ln(x) - ln(x 12 months earlier) for indicators that are never <= 0."""
    return _d12(spark, sf_dir, "log")


@query
def yoy_level_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X - x 12 months earlier for the other indicators."""
    return _d12(spark, sf_dir, "level")


@query
def rolling_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Full-frame 3/6/12-month means of every d12 series."""
    mf = build(spark, sf_dir).monthly_features().filter(F.col("features_type") == "rolling")
    return mf.select("entity", "feature", "width", "date", r6("value"))


# Step 3: quarterly features ----------------------------------------------

@query
def month_of_quarter_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Month 1/2/3 values of each feature side by side per quarter."""
    from panelcast.operators.features import quarter_pivot

    b = build(spark, sf_dir)
    qp = quarter_pivot(b.monthly_features(), b.first_quarter, b.anchor)
    return qp.select("entity", "feature", "features_type", "date", r6("m1"), r6("m2"), r6("m3"))


@query
def quarterly_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quarterly targets joined to the quarters that have monthly features."""
    b = build(spark, sf_dir)
    fq = b.feat_q().filter(F.col("features_type") == "d12")
    counts = fq.groupBy("entity", "date").agg(
        *(F.count(F.when(F.col("availability") == a, F.col("value"))).alias(f"n_m{a}") for a in (1, 2, 3)))
    j = b.targets().join(counts, ["entity", "date"])
    return j.select("entity", "target", "date", r6("y"), "n_m1", "n_m2", "n_m3")


@query
def feature_lags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every quarterly feature lagged 0..H-1 quarters (start filter after the lags)."""
    from panelcast.operators.features import feature_lags as lags

    b = build(spark, sf_dir)
    fl = lags(b.feat_q(), range(b.params.horizon))
    fl = fl.filter(F.col("date") >= F.lit(b.params.start_date))
    return fl.select("entity", "feature", "features_type", "availability", "date", "lag", r6("value"))


@query
def target_lags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each target lagged 1..H quarters on the aligned quarters."""
    from panelcast.operators.features import target_lags as lags

    b = build(spark, sf_dir)
    h = b.params.horizon
    tl = lags(b.aligned_targets(), range(1, h + 1)).filter(F.col("date") >= F.lit(b.params.start_date))
    return tl.select("entity", "target", "date", r6("y"), *(r6(f"y_lag{k}") for k in range(1, h + 1)))


# One representative cell of the grid for the design plans.
CELL = dict(features_type="d12", availability=2, target="gmv_log_d4", horizon=2)


@query
def cell_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Design rows of one cell (month-2 d12 features lagged h-1, target lag h, label)."""
    d = build(spark, sf_dir).cell(**CELL)
    return d.select("entity", "date", "column", r6("value"))


@query
def cumulative_availability(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Strategy 'all' - months 1..a of the quarter enter the design together."""
    d = build(spark, sf_dir).cell(**{**CELL, "horizon": 1}, strategy="all")
    return d.select("entity", "date", "column", r6("value"))


# Step 4: report grid -----------------------------------------------------

def _grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    from panelcast.sources.report_grid import report_grid

    return report_grid(build(spark, sf_dir).order_months)


@query
def grid_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Section-header rows of the report grid and their trimmed titles."""
    from panelcast.operators.grid import headers

    return headers(_grid(spark, sf_dir))


@query
def grid_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Block rows melted to (sheet, indicator, row_no, year, month, raw), digit years only."""
    from panelcast.operators.grid import YEAR_DIGITS, block_cells

    c = block_cells(_grid(spark, sf_dir)).filter(F.col("year_text").rlike(YEAR_DIGITS) & (F.length("year_text") <= 4))
    return c.select("sheet", "indicator", "row_no", F.col("year_text").cast("int").alias("year"), "month", "raw")


@query
def grid_clean_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaned numbers (footnote-aware and reference-strict) at month-start dates."""
    from panelcast.operators.grid import clean_long

    c = clean_long(_grid(spark, sf_dir))
    return c.select("sheet", "indicator", "row_no", "date", r6("value"), r6("value_strict"))


@query
def grid_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One column per block title (all that G1 finds), one row per (sheet, month)."""
    from panelcast.operators.grid import block_titles, clean_long, pivot_wide

    g = _grid(spark, sf_dir)
    titles = block_titles(g)
    names = [s.lower() for s in titles]
    p = pivot_wide(clean_long(g), titles, names)
    return p.select("sheet", "date", *(r6(n) for n in names))


@query
def grid_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells the normaliser refused, with the reason."""
    from panelcast.operators.grid import rejects

    return rejects(_grid(spark, sf_dir))


# Step 5: splits, vintages, profiles ---------------------------------------

@query
def chrono_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Start filter, then train/valid/test as a column."""
    from panelcast.operators.split import chrono_split as split

    b = build(spark, sf_dir)
    s = split(b.aligned_targets(), b.split_bounds(), b.params.start_date)
    return s.select("entity", "target", "date", r6("y"), "split")


@query
def rolling_origins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T+H-1 forecast windows over the distinct back-test dates, horizon numbered."""
    from panelcast.operators.split import rolling_origins as origins

    b = build(spark, sf_dir)
    dates = b.actuals().select("date").distinct()
    return origins(dates, b.anchor, b.params.test_len, b.params.horizon).select(
        "origin_id", "origin", "window_end", "date", "horizon")


def _monthly_for_var(b) -> DataFrame:
    """Joined monthly sources from the start year, trimmed to the last target quarter."""
    from panelcast.operators.split import trim_to_quarter_end

    m = b.dense_m().filter(F.col("date") >= F.lit(b.params.start_date))
    return trim_to_quarter_end(m, b.anchor)


@query
def vintage_cut(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per vintage, the data still visible (targets drop tp+1 quarters, indicators 3*tp months)."""
    from panelcast.operators.calendar import add_months
    from panelcast.operators.split import vintages

    b = build(spark, sf_dir)
    n = b.params.test_len + b.params.horizon + 1
    m_last = add_months(b.anchor, 2)
    mv, qv = vintages(_monthly_for_var(b), b.actuals(), b.anchor, m_last, n)
    ms = mv.groupBy("vintage", "entity").agg(F.count("value").alias("n_m"))
    qs = qv.groupBy("vintage", "entity").agg(F.count("y").alias("n_q"))
    out = ms.join(qs, ["vintage", "entity"])
    return out.select(
        "vintage", "entity",
        F.expr(f"add_months(DATE'{m_last.isoformat()}', -3 * vintage)").alias("m_end"),
        F.expr(f"add_months(DATE'{b.anchor.isoformat()}', -3 * (vintage + 1))").alias("q_end"),
        "n_m", "n_q")


@query
def ragged_edge_mask(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Availability a < 3 hides the last 3-a months of the latest vintage."""
    from panelcast.operators.calendar import add_months
    from panelcast.operators.split import ragged_edge

    b = build(spark, sf_dir)
    m_end = add_months(b.anchor, 2)
    m = _monthly_for_var(b).withColumn("availability", F.explode(F.array(*(F.lit(a) for a in (1, 2, 3)))))
    masked = ragged_edge(m, m_end, F.col("availability"))
    return masked.groupBy("availability", "entity", "indicator").agg(
        F.count("value").alias("n_values"), F.max(F.when(F.col("value").isNotNull(), F.col("date"))).alias("last_date"))


@query
def null_threshold_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """NULL count per monthly (<=12) and quarterly (<=4) series; which series are kept."""
    from panelcast.operators.profile import null_counts

    b = build(spark, sf_dir)
    m = null_counts(_monthly_for_var(b), ["entity", "indicator"], "value", b.params.max_nulls_m)
    q = null_counts(b.actuals(), ["entity", "target"], "y", b.params.max_nulls_q)
    m = m.select(F.lit("m").alias("kind"), "entity", F.col("indicator").alias("series"), "n_null", "n_rows", "keep")
    q = q.select(F.lit("q").alias("kind"), "entity", F.col("target").alias("series"), "n_null", "n_rows", "keep")
    return m.unionByName(q)


@query
def complete_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Months where every kept indicator of the entity has a value."""
    from panelcast.operators.profile import complete_cases as cc
    from panelcast.operators.profile import keep_series, null_counts

    b = build(spark, sf_dir)
    m = _monthly_for_var(b)
    kept = keep_series(m, null_counts(m, ["entity", "indicator"], "value", b.params.max_nulls_m), ["entity", "indicator"])
    return cc(kept, ["entity", "date"]).select("entity", "date", "n_values")


def _split_design(b, **cell) -> DataFrame:
    from panelcast.operators.split import split_column

    return b.cell(**cell).withColumn("split", split_column(b.split_bounds()))


PROFILE_CELL = dict(features_type="d12", availability=1, target="gmv_log_d4", horizon=1)


@query
def null_free_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Design columns without NULLs over train and valid rows."""
    from panelcast.operators.profile import null_free

    return null_free(_split_design(build(spark, sf_dir), **PROFILE_CELL)).select("column", "n_null", "n_rows", "null_free")


@query
def standardise(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Z-scores with mean / population std from the training rows only."""
    from panelcast.operators.profile import scale_stats
    from panelcast.operators.profile import standardise as z

    d = _split_design(build(spark, sf_dir), **PROFILE_CELL).filter(F.col("column") != "y")
    out = z(d, scale_stats(d))
    return out.select("entity", "date", "column", "split", r6("z"))


# Step 6: scoring ------------------------------------------------------------

AVAILABILITIES = (1, 2, 3)
FEATURE_TYPES = ("d12", "rolling")


def _bench(b) -> DataFrame:
    """Benchmark forecasts (naive, seasonal naive, 4-quarter mean) over the cell grid."""
    from panelcast.operators.score import pseudo_forecasts

    lo, hi = b.test_bounds()
    return pseudo_forecasts(b.actuals(), range(1, b.params.horizon + 1), AVAILABILITIES, FEATURE_TYPES, lo, hi)


def _quarter_end_records(b) -> DataFrame:
    """Forecast records dated at quarter end for horizons 1..H+1 (the extra horizon has no naive twin)."""
    from pyspark.sql import Window

    from panelcast.functions.columns import full_frame_mean

    lo, hi = b.test_bounds()
    w = Window.partitionBy("entity", "target").orderBy("date")
    base = b.actuals().withColumn("m4", full_frame_mean("y", w, 4))
    hs = range(1, b.params.horizon + 2)
    base = base.select("entity", "target", "date", *(F.lag("m4", h).over(w).alias(f"m{h}") for h in hs))
    steps = [F.struct(F.lit(h).alias("horizon"), F.col(f"m{h}").alias("median")) for h in hs]
    r = base.select("entity", "target", "date", F.explode(F.array(*steps)).alias("s"))
    r = r.filter(F.col("date").between(F.lit(lo), F.lit(hi)) & F.col("s.median").isNotNull())
    return r.select("entity", F.add_months("date", 2).alias("fcst_date"), F.col("s.median").alias("median"),
                    F.col("target").alias("variable"), F.col("s.horizon").alias("horizon"),
                    F.lit(1).alias("p"),
                    F.explode(F.array(*(F.lit(a) for a in AVAILABILITIES))).alias("availability"))


def _metrics(b) -> DataFrame:
    """Benchmark models (left join to naive) plus quarter-end records (inner join: drops horizon H+1).

    The quarter-end records are four-quarter means in the record layout of the VAR; their label says so.
    """
    from panelcast.operators.score import (METRICS_COLUMNS, join_actuals, metrics_table, naive_rmse, relative, rmse,
                                           shift_forecast_dates)

    lo, hi = b.test_bounds()
    hs = range(1, b.params.horizon + 1)
    ml = metrics_table(_bench(b), b.actuals(), hs, lo, hi)
    test_dates = b.actuals().filter(F.col("date").between(F.lit(lo), F.lit(hi))).select("date").distinct()
    shifted = shift_forecast_dates(_quarter_end_records(b)).join(test_dates, "date", "left_semi")
    scored = join_actuals(shifted.withColumn("model", F.lit("mean4_quarter_end")).withColumn("features_type", F.lit("d12")), b.actuals())
    var = relative(rmse(scored), naive_rmse(b.actuals(), hs, lo, hi), how="inner").select(*METRICS_COLUMNS)
    return ml.unionByName(var)


@query
def rmse_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """RMSE of every benchmark model and cell in one join and one aggregate, sorted by its keys."""
    from panelcast.operators.score import join_actuals, rmse, sort_by_cell

    b = build(spark, sf_dir)
    m = sort_by_cell(rmse(join_actuals(_bench(b), b.actuals())))
    return m.select("model", "target", "features_type", "availability", "horizon", r6("rmse"), "n_obs")


@query
def rel_rmse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """RMSE relative to the random walk of the same target and horizon."""
    from panelcast.operators.score import join_actuals, naive_rmse, relative, rmse

    b = build(spark, sf_dir)
    lo, hi = b.test_bounds()
    m = relative(rmse(join_actuals(_bench(b), b.actuals())), naive_rmse(b.actuals(), range(1, b.params.horizon + 1), lo, hi))
    return m.select("model", "target", "features_type", "availability", "horizon", r6("rmse"), r6("rmse_naive"),
                    r6("rel_rmse_naive"))


@query
def metrics_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 8-column metrics record for all model families, in report order."""
    from panelcast.operators.score import sort_metrics

    m = sort_metrics(_metrics(build(spark, sf_dir)))
    return m.select("horizon", "availability", "features_type", r6("rmse"), "target", "model", r6("rmse_naive"),
                    r6("rel_rmse_naive"))


@query
def leaderboard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Best model and feature type per (target, horizon, availability); NULL never wins."""
    from panelcast.operators.score import leaderboard as board

    best = board(_metrics(build(spark, sf_dir)))
    return best.select("target", "horizon", "availability", r6("best_rel_rmse_naive"), "best_model", "best_features_type")


@query
def stored_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forecasts of two runs stored, one run and config read back, scored,
    and the metrics stored under the run id and read back."""
    import uuid

    from panelcast.operators.score import metrics_table as score
    from panelcast.operators.score import shift_forecast_dates
    from panelcast.session import scratch_path
    from panelcast.sources import sinks

    b = build(spark, sf_dir)
    lo, hi = b.test_bounds()
    path = scratch_path(spark, f"stored-scores-{uuid.uuid4().hex}")
    none = F.lit(None).cast("double")
    other = (shift_forecast_dates(_quarter_end_records(b)).where(F.col("horizon") <= b.params.horizon)
             .select(F.lit("other").alias("run_id"), F.lit("mean4_quarter_end").alias("model"), "entity", "target",
                     F.lit("d12").alias("features_type"), "availability", "horizon",
                     F.expr("add_months(date, -3 * horizon)").alias("origin"), "date", "pred", none.alias("lo"), none.alias("hi")))
    sinks.write_forecasts(_bench(b).unionByName(other), f"{path}/forecasts")
    stored = sinks.read_forecasts(spark, f"{path}/forecasts", run_id="bench", config={"features_type": "d12"})
    metrics = score(stored, b.actuals(), range(1, b.params.horizon + 1), lo, hi)
    sinks.write_metrics(metrics, f"{path}/metrics", "bench")
    m = sinks.read_metrics(spark, f"{path}/metrics", "bench")
    return m.select("run_id", "horizon", "availability", "features_type", r6("rmse"), "target", "model", r6("rmse_naive"),
                    r6("rel_rmse_naive"))


@query
def crps_gaussian(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scoring rule: mean closed-form Gaussian CRPS of the banded 4-quarter-mean forecast."""
    from panelcast.operators.score import crps_table

    b = build(spark, sf_dir)
    f = _bench(b).filter((F.col("model") == "mean4") & (F.col("availability") == 1) & (F.col("features_type") == "d12"))
    return crps_table(f, b.actuals(), ["target", "horizon"]).select("target", "horizon", r6("crps"), "n_obs")


@query
def forecast_date_shift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quarter-end dated records moved to quarter start, kept on test dates only."""
    from panelcast.operators.score import shift_forecast_dates

    b = build(spark, sf_dir)
    lo, hi = b.test_bounds()
    test_dates = b.actuals().filter(F.col("date").between(F.lit(lo), F.lit(hi))).select("date").distinct()
    s = shift_forecast_dates(_quarter_end_records(b)).join(test_dates, "date", "left_semi")
    return s.select("entity", "target", "availability", "horizon", "date", r6("pred"))


@query
def top_h_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From a longer forecast path per origin keep the first H steps (row number by date)."""
    from panelcast.operators.split import first_steps

    b = build(spark, sf_dir)
    lo, hi = b.test_bounds()
    h = b.params.horizon
    o = b.actuals().filter(F.col("date").between(F.lit(lo), F.lit(hi)) & F.col("y").isNotNull())
    path = o.select("entity", "target", F.col("date").alias("origin"), F.col("y").alias("pred"),
                    F.explode(F.sequence(F.lit(1), F.lit(h + 3))).alias("k"))
    path = path.withColumn("date", F.expr("add_months(origin, 3 * k)"))
    return first_steps(path, h).select("entity", "target", "origin", "date", "horizon", r6("pred"))


@query
def unpivot_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wide per-target table (explicit pivot values) back to (entity, date, target, y)."""
    b = build(spark, sf_dir)
    targets = [f"{t}_log_d4" for t in ("gmv", "net_sales", "qty")]
    wide = b.actuals().groupBy("entity", "date").pivot("target", targets).agg(F.max("y"))
    long = wide.unpivot(["entity", "date"], targets, "target", "y").filter(F.col("y").isNotNull())
    return long.select("entity", "date", "target", r6("y"))


@query
def raw_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prepared raw levels (monthly joined sources, quarterly targets) without transforms."""
    from panelcast.operators.calendar import densify
    from panelcast.operators.series import TARGET_KEYS

    b = build(spark, sf_dir)
    m = b.dense_m().select(F.lit("m").alias("freq"), "entity", F.col("indicator").alias("series"), "date", "value")
    lo, hi = b.quarter_bounds
    q = densify(b.panel_q(), TARGET_KEYS, ["level"], lo, hi, 3).select(
        F.lit("q").alias("freq"), "entity", F.col("target").alias("series"), "date", F.col("level").alias("value"))
    return m.unionByName(q).select("freq", "entity", "series", "date", r6("value"))


# Step 7: model jobs (rows-only checks: no SQL twin) ------------------------

def _targets() -> list[str]:
    from panelcast.sources.adapters import QUARTERLY_TARGETS

    return [f"{t}_log_d4" for t in QUARTERLY_TARGETS]


def _model_grid(b) -> list:
    """The whole grid: both feature types, every target, horizon and availability."""
    from panelcast.models.runner import grid

    return grid(FEATURE_TYPES, AVAILABILITIES, _targets(), range(1, b.params.horizon + 1))


def _model_query(spark: SparkSession, sf_dir: str, fit, run_id: str, *extra: str) -> DataFrame:
    from panelcast.params import MODEL_TEST_PARAMS

    b = build(spark, sf_dir, MODEL_TEST_PARAMS)
    f = fit(b, _model_grid(b), run_id)
    return f.select("model", "entity", "target", "features_type", "availability", "horizon", "origin", "date",
                    r6("pred"), r6("lo"), r6("hi"), *extra)


@query
def forecast_boosted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Boosted trees of all cells in the same jobs, patience on valid, refit on train+valid with the best number."""
    from panelcast.models.boosted import fit_boosted

    return _model_query(spark, sf_dir, fit_boosted, "boosted", "n_trees")


@query
def forecast_gaussian(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M2, M7: mean and log-spread boosted under the Gaussian CRPS, iterations chosen by CRPS on valid with patience."""
    from panelcast.models.gaussian import fit_gaussian

    return _model_query(spark, sf_dir, fit_gaussian, "gaussian", "n_trees")


@query
def forecast_sparse_linear(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Elastic net on null-free standardised columns, all cells and penalties from one pass of cross-products."""
    from panelcast.models.sparse_linear import fit_sparse_linear

    return _model_query(spark, sf_dir, fit_sparse_linear, "sparse_linear", r6("penalty"))


FACTOR_STRATEGIES = ("avail_only", "all")


def _factor_configs() -> list[tuple[str, int, str]]:
    """Every features_type, availability and strategy ('all' widens the months of d12 features only)."""
    return [(ft, a, s) for ft in FEATURE_TYPES for a in AVAILABILITIES for s in FACTOR_STRATEGIES if ft == "d12" or s == "avail_only"]


@query
def forecast_factor(spark: SparkSession, sf_dir: str) -> DataFrame:
    """EM factors per rolling origin, direct regressions and factor VARs, every configuration in the same jobs."""
    from panelcast.models.factor import fit_factors
    from panelcast.params import MODEL_TEST_PARAMS

    f = fit_factors(build(spark, sf_dir, MODEL_TEST_PARAMS), _factor_configs(), "factor")
    return f.select("model", "entity", "target", "features_type", "availability", "horizon", "origin", "date",
                    r6("pred"), r6("lo"), r6("hi"), "features_strategy", "k_factors", "factor_order")


@query
def forecast_mfvar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stacked mixed-frequency Minnesota VAR, every vintage from prefix sums, posterior draws, ragged-edge nowcast, 68% band."""
    from panelcast.models.mfvar import fit_mfvars
    from panelcast.params import MODEL_TEST_PARAMS

    f = fit_mfvars(build(spark, sf_dir, MODEL_TEST_PARAMS), AVAILABILITIES, _targets(), "mfvar")
    return f.select("model", "entity", "target", "features_type", "availability", "horizon", "origin", "date",
                    r6("pred"), r6("lo"), r6("hi"), "status", "n_draws")


@query
def model_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All five model families over the grid stored, read back, scored in one pass."""
    from panelcast.models.backtest import backtest
    from panelcast.models.boosted import fit_boosted
    from panelcast.models.factor import fit_factors
    from panelcast.models.gaussian import fit_gaussian
    from panelcast.models.mfvar import fit_mfvars
    from panelcast.models.sparse_linear import fit_sparse_linear
    from panelcast.params import MODEL_TEST_PARAMS

    b = build(spark, sf_dir, MODEL_TEST_PARAMS)
    cells = _model_grid(b)
    fams = {
        "boosted": lambda: fit_boosted(b, cells, "scores"),
        "gaussian": lambda: fit_gaussian(b, cells, "scores"),
        "sparse_linear": lambda: fit_sparse_linear(b, cells, "scores"),
        "factor": lambda: fit_factors(b, _factor_configs(), "scores"),
        "mfvar": lambda: fit_mfvars(b, AVAILABILITIES, _targets(), "scores"),
    }
    m = backtest(b, fams)
    return m.select("horizon", "availability", "features_type", r6("rmse"), "target", "model", r6("rmse_naive"),
                    r6("rel_rmse_naive"))
