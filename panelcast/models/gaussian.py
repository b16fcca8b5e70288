"""M2: probabilistic boosting: mean and log standard deviation under the Gaussian CRPS.

Every iteration adds a shallow tree to both, along the natural gradient of the closed-form CRPS, for every cell of a grid in
the same jobs.  The number of iterations is the one with the least mean CRPS on the valid quarters, found with
patience; both parameters are then those of the fit on train + valid.  The record carries the mean and a 68% band.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.models import grid_design, histboost
from panelcast.models.boosted import TEST, predict
from panelcast.models.design import Cell, cell_record
from panelcast.operators.score import Z68


def gauss_params(p) -> histboost.BoostParams:
    return histboost.BoostParams(kind="crps", trees=p.gauss_iterations, depth=p.gauss_depth, rate=p.gauss_learning_rate,
                                 patience=p.gauss_patience, l2=0.0, bins=p.boost_bins, block_rows=p.boost_block_rows)


def fit_gaussian(build, cells: Sequence[Cell] | Cell, run_id: str) -> DataFrame:
    """Forecast records of all ``cells`` with a band, and the number of iterations kept per cell."""
    cells = [cells] if isinstance(cells, Cell) else list(cells)
    bp = gauss_params(build.params)
    samples = grid_design.binned(build.freeze(), cells, bp.bins)
    fitted = histboost.fit(samples.select("grp", "part", "y", "x"), bp)
    out = predict(samples.where(F.col("part") == TEST), fitted, 2).where(F.col("n_trees") > 0)
    half = Z68 * F.exp("s1")
    return cell_record(out.withColumn("prediction", F.col("s0")), "gaussian", cells, run_id,
                       lo=F.col("s0") - half, hi=F.col("s0") + half, extra=["n_trees"])
