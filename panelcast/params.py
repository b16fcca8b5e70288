"""Run parameters, passed explicitly (never mutated, never global state)."""

from __future__ import annotations

import dataclasses
import datetime as dt


@dataclasses.dataclass(frozen=True)
class Params:
    # Fixed values of the reference configuration (library defaults).
    horizon: int = 6
    valid_len: int = 12
    test_len: int = 12
    max_availability: int = 3
    windows: tuple[int, ...] = (3, 6, 12)
    start_year: int = 2001
    seed: int = 228
    boost_iterations: int = 1000
    boost_depth: int = 6
    boost_rate: float = 0.1
    gauss_iterations: int = 500
    gauss_learning_rate: float = 0.01
    gauss_depth: int = 2
    factor_k_grid: tuple[int, ...] = (1, 2)
    factor_order_grid: tuple[int, ...] = (1,)
    # Ours: EM steps of the factors at most (one job each, all configurations together), and the relative gain that ends them.
    factor_em_iterations: int = 50
    factor_em_tolerance: float = 1e-3
    var_ar1_prior: float = 0.7
    var_lambda1: float = 0.1
    var_lambda2: float = 0.5
    var_lambda4: float = 100.0
    var_draws: int = 500
    # Ours: columns of a block of the VAR's cross-products.
    var_block: int = 512
    # Rounds without a gain on the valid rows after which boosting stops.
    boost_patience: int = 50
    gauss_patience: int = 25
    # Ours: bins of a feature, what is added to a leaf's row count, and the rows of a block (a task's unit of work).
    boost_bins: int = 32
    boost_l2: float = 3.0
    boost_block_rows: int = 65_536
    # Ours: elastic-net mixing and penalty grid of the sparse linear model (M3).
    linear_mix: float = 0.5
    linear_penalties: tuple[float, ...] = (0.001, 0.01, 0.1, 1.0)
    # Ours: model cells that a per-cell fit (runner.run_grid) works on at the same time.
    cell_parallelism: int = 4
    # Ours: last date of the sample that decides on logs (None = the whole sample, as the reference).
    profile_until: dt.date | None = None
    # Ours: thresholds of the null-count column filter (quarterly, monthly).
    max_nulls_q: int = 4
    max_nulls_m: int = 12

    def replace(self, **kw) -> "Params":
        return dataclasses.replace(self, **kw)

    @property
    def start_date(self) -> dt.date:
        return dt.date(self.start_year, 1, 1)


# Test parameters for the supplied tables, which span under seven years: shorter
# test and valid windows and an earlier start than the defaults.  No date is typed
# in: the last complete quarter is derived from the data (PanelBuild.anchor).
TEST_PARAMS = Params(valid_len=4, test_len=4, start_year=1996, max_nulls_q=0, max_nulls_m=0)

# The model queries keep the library's boosting budgets and patience.
MODEL_TEST_PARAMS = TEST_PARAMS.replace(max_nulls_q=4, max_nulls_m=12, cell_parallelism=8)
