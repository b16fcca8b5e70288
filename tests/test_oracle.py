"""Spark plans against their DuckDB twins on the smoke tables.

A representative sample runs by default; ``PANELCAST_ORACLE_ALL=1`` checks
every plan that has a twin (the full gate is ``python -m tests.oracle_harness``).
"""

import os

import pytest

from tests.conftest import SMOKE
from tests.oracle_harness import compare, duck

SAMPLE = ["naive_rmse_by_target_horizon", "chain_index", "rolling_means", "cell_features", "grid_pivot",
          "grid_rejects", "rolling_origins", "standardise", "metrics_table", "leaderboard"]


def names():
    if os.environ.get("PANELCAST_ORACLE_ALL"):
        from panelcast.plans.oracle import ORACLE

        return sorted(ORACLE)
    return SAMPLE


@pytest.fixture(scope="module")
def con():
    return duck(SMOKE)


@pytest.mark.parametrize("name", names())
def test_plan_matches_oracle(spark, con, name):
    ok, msg = compare(spark, name, SMOKE, con)
    assert ok, msg


def test_every_plan_is_registered_with_the_driver():
    import __spark_entry__ as e
    from panelcast.plans.oracle import ORACLE

    q = e.queries()
    assert set(ORACLE) <= set(q)
    assert {"forecast_boosted", "forecast_gaussian", "forecast_sparse_linear", "forecast_factor",
            "forecast_mfvar", "model_scores"} <= set(q) - set(ORACLE)
