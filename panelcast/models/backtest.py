"""M7 + E1 end to end: fit model families, store their forecasts, score them in one pass.

The forecasts are written to a table and read back before scoring: the table is
the contract between fitting and scoring, as the forecast files are in the
reference, and it cuts the long fitting lineage so a lost executor never re-runs a
model.  Forecasts and actuals are stored in the same buckets of the join's keys, so
they are scored where they lie, without a shuffle below the aggregate.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.operators.score import metrics_table
from panelcast.session import scratch_path
from panelcast.sources.sinks import FORECAST_COLUMNS, bucketed, read_metrics, write_metrics


def backtest(build, families: dict[str, Callable[[], DataFrame]], path: str | None = None,
             run_id: str = "scores") -> DataFrame:
    """Run each family (a thunk returning uniform forecast records), store, score against the naive walk.

    ``path`` is the run folder (S13): forecasts go to ``path``, metrics to ``path-metrics``, both under ``run_id``.
    Only rows a model vouches for are scored: a ``status`` column (the VAR's) must say ok (S10).
    """
    parts = [_good(fn()).select(*FORECAST_COLUMNS) for fn in families.values()]
    path = path or scratch_path(build.spark, f"forecasts-{uuid.uuid4().hex}")
    lo, hi = build.test_bounds()
    with bucketed(reduce(DataFrame.unionByName, parts), path) as stored, \
            bucketed(build.actuals().select("entity", "target", "date", "y"), path + "-actuals") as actuals:
        metrics = metrics_table(stored, actuals, range(1, build.params.horizon + 1), lo, hi)
        write_metrics(metrics, path + "-metrics", run_id)
    return read_metrics(build.spark, path + "-metrics", run_id)


def _good(forecasts: DataFrame) -> DataFrame:
    return forecasts.filter(F.col("status") == "ok") if "status" in forecasts.columns else forecasts
