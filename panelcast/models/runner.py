"""M7: the model grid as a list of cells.

The built-in families (boosted, gaussian, sparse linear) take the whole list and fit all cells in the same jobs;
``run_grid`` is for a fit of one's own that takes one cell: it submits cells from a small driver thread pool, so
the cluster stays busy, and the data never passes through the driver.  The feature table is
materialised once before either (``PanelBuild.freeze``).
"""

from __future__ import annotations

import itertools
from collections.abc import Callable, Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame

from panelcast.models.design import Cell
from panelcast.operators.score import FORECASTS_SCHEMA


def grid(features_types: Sequence[str], availabilities: Sequence[int], targets: Sequence[str],
         horizons: Iterable[int], strategy: str = "avail_only") -> list[Cell]:
    """The config grid product, in the reference's loop order."""
    return [Cell(ft, a, t, h, strategy)
            for ft, t, h, a in itertools.product(features_types, targets, list(horizons), availabilities)]


def run_grid(build, cells: Sequence[Cell], fit_cell: Callable[..., DataFrame], run_id: str,
             parallelism: int | None = None) -> DataFrame:
    """Fit every cell (``fit_cell(build, cell, run_id) -> forecasts``) and union the records."""
    build.freeze()
    n = max(1, min(parallelism or build.params.cell_parallelism, len(cells)))
    with ThreadPoolExecutor(max_workers=n) as pool:
        parts = list(pool.map(lambda c: fit_cell(build, c, run_id), cells))
    if not parts:
        return build.spark.createDataFrame([], FORECASTS_SCHEMA)
    return reduce(DataFrame.unionByName, parts)
