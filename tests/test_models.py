"""Model jobs: rows-only checks plus sanity (finite, complete, banded, no look-ahead)."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from tests.conftest import SMOKE


def collect(spark, name):
    from panelcast.plans.catalog import REGISTRY

    return REGISTRY[name](spark, SMOKE).collect()


@pytest.mark.parametrize("name", ["forecast_boosted", "forecast_gaussian", "forecast_sparse_linear"])
def test_cell_models_predict_every_test_row_of_the_grid(spark, name):
    rows = collect(spark, name)
    assert rows and all(r["pred"] is not None for r in rows)
    assert all(r["origin"] < r["date"] for r in rows)
    per_cell = Counter((r["target"], r["features_type"], r["availability"], r["horizon"]) for r in rows)
    assert len(per_cell) == 108 and len(set(per_cell.values())) == 1
    if name != "forecast_sparse_linear":
        kept = {(r["target"], r["features_type"], r["availability"], r["horizon"]): r["n_trees"] for r in rows}
        assert len(set(kept.values())) > 10 and max(kept.values()) > 30
    if name == "forecast_gaussian":
        assert all(r["lo"] < r["pred"] < r["hi"] for r in rows)


def test_factor_each_date_and_horizon_once_per_config(spark):
    rows = collect(spark, "forecast_factor")
    keys = Counter((r["model"], r["features_type"], r["availability"], r["entity"], r["target"], r["date"], r["horizon"]) for r in rows)
    assert rows and set(keys.values()) == {1}
    assert {(r["features_strategy"], r["k_factors"], r["factor_order"]) for r in rows} == {(s, k, o) for s in ("all", "avail_only") for k in (1, 2) for o in (0, 1)}
    assert all((r["lo"] is None) == (r["factor_order"] == 0) for r in rows)
    assert all(r["date"] >= r["origin"] for r in rows)


def test_mfvar_band_contains_the_median(spark):
    rows = collect(spark, "forecast_mfvar")
    ok = [r for r in rows if r["status"] == "ok"]
    assert ok and all(r["lo"] <= r["pred"] <= r["hi"] and r["n_draws"] > 0 for r in ok)
    assert all(r["origin"] <= r["date"] for r in rows)
    keys = Counter((r["entity"], r["target"], r["availability"], r["origin"], r["date"]) for r in rows)
    assert set(keys.values()) == {1} and {r["availability"] for r in rows} == {1, 2, 3}


def test_grid_runner_unions_cells(spark):
    from panelcast.models.design import Cell
    from panelcast.models.runner import run_grid
    from panelcast.operators.score import FORECASTS_SCHEMA
    from panelcast.plans.catalog import build

    b = build(spark, SMOKE)
    seen = []

    def fake(build_, cell, run_id):
        seen.append(cell)
        return spark.createDataFrame([], FORECASTS_SCHEMA).withColumn("run_id", F.lit(run_id))

    out = run_grid(b, [Cell("d12", 3, "gmv_log_d4", h) for h in (1, 2)], fake, "x")
    assert len(seen) == 2 and out.count() == 0
