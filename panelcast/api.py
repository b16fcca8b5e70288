"""Public entry points: feature build, splits, model fits and scoring.  All return lazy DataFrames."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from panelcast.models.design import Cell
from panelcast.models.factor import fit_factor
from panelcast.models.mfvar import fit_mfvar
from panelcast.operators import features as _features
from panelcast.operators import score as _score
from panelcast.operators import split as _split
from panelcast.operators.features import PanelBuild
from panelcast.params import Params

__all__ = ["Cell", "build_features", "to_quarterly", "add_lags", "chrono_split", "fit_cell", "fit_cells", "fit_factor",
           "fit_mfvar", "score", "leaderboard"]


def build_features(spark: SparkSession, sf_dir: str, params: Params) -> PanelBuild:
    """The feature build over the tables in ``sf_dir``; each piece is built once and reused."""
    return PanelBuild(spark, sf_dir, params)


def to_quarterly(build: PanelBuild) -> DataFrame:
    """Monthly d12 / rolling features as quarterly month-a features (long)."""
    return build.feat_q()


def add_lags(build: PanelBuild, lags: Sequence[int] | None = None) -> DataFrame:
    """Every quarterly feature lagged 0..H-1 quarters (long by lag)."""
    return _features.feature_lags(build.feat_q(), list(lags if lags is not None else range(build.params.horizon)))


def chrono_split(build: PanelBuild, df: DataFrame) -> DataFrame:
    """B3 + P9: start-year filter, then a ``split`` column (train / valid / test)."""
    return _split.chrono_split(df, build.split_bounds(), build.params.start_date)


def fit_cells(kind: str, build: PanelBuild, cells: Sequence[Cell], run_id: str = "run") -> DataFrame:
    """M1-M3, M7 for all ``cells`` in the same jobs: 'boosted', 'gaussian' or 'sparse_linear' -> uniform forecast records."""
    if kind == "boosted":
        from panelcast.models.boosted import fit_boosted as fit
    elif kind == "gaussian":
        from panelcast.models.gaussian import fit_gaussian as fit
    elif kind == "sparse_linear":
        from panelcast.models.sparse_linear import fit_sparse_linear as fit
    else:
        raise ValueError(f"unknown model kind {kind!r}")
    return fit(build.freeze(), cells, run_id)


def fit_cell(kind: str, build: PanelBuild, cell: Cell, run_id: str = "run") -> DataFrame:
    """:func:`fit_cells` for one cell."""
    return fit_cells(kind, build, [cell], run_id)


def score(build: PanelBuild, forecasts: DataFrame) -> DataFrame:
    """The 8-column metrics table of any forecasts against the naive random walk."""
    lo, hi = build.test_bounds()
    return _score.metrics_table(forecasts, build.actuals(), range(1, build.params.horizon + 1), lo, hi)


def leaderboard(metrics: DataFrame) -> DataFrame:
    """Best (model, features_type) per (target, horizon, availability)."""
    return _score.leaderboard(metrics)
