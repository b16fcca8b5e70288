"""M1: gradient-boosted trees for every cell of a grid in the same jobs.

Symmetric trees on binned features, stopped after ``boost_patience`` trees without gain on the valid quarters,
and refitted on train + valid with the best number (:mod:`panelcast.models.histboost`).  A missing value is a bin of its own,
so nothing is imputed.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.models import grid_design, histboost
from panelcast.models.design import Cell, cell_record

TEST = 3


def predict(samples: DataFrame, fitted: histboost.Fitted, heads: int) -> DataFrame:
    """``samples`` of the fitted groups with their scores, ``s0`` and so on, and the number of trees kept."""
    shared = samples.sparkSession.sparkContext.broadcast(fitted)  # trees: bounded by cells, trees and leaves, all parameters
    names = [f"s{k}" for k in range(heads)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for b in batches:
            grp = b.column("grp").to_numpy()
            x = b.column("x").to_pylist()
            score, trees = np.full((heads, len(grp)), np.nan), np.zeros(len(grp), dtype=np.int32)
            for g in np.unique(grp).tolist():
                if g in model.trees:
                    at = np.flatnonzero(grp == g)
                    rows = np.frombuffer(b"".join(x[i] for i in at), dtype=np.uint8).reshape(len(at), -1)
                    score[:, at], trees[at] = model.score(g, rows), len(model.trees[g])
            out = [pa.array(s, pa.float64(), from_pandas=True) for s in score]
            yield pa.RecordBatch.from_arrays([b.column(c) for c in ("grp", "entity", "date", "y", "part")] + out + [pa.array(trees)],
                                             names=["grp", "entity", "date", "y", "part", *names, "n_trees"])

    schema = "grp int, entity string, date date, y double, part int, " + ", ".join(f"{n} double" for n in names) + ", n_trees int"
    return samples.mapInArrow(run, schema)


def boost_params(p) -> histboost.BoostParams:
    return histboost.BoostParams(kind="squared", trees=p.boost_iterations, depth=p.boost_depth, rate=p.boost_rate,
                                 patience=p.boost_patience, l2=p.boost_l2, bins=p.boost_bins, block_rows=p.boost_block_rows)


def fit_boosted(build, cells: Sequence[Cell] | Cell, run_id: str) -> DataFrame:
    """Forecast records of all ``cells``, with the number of trees kept per cell."""
    cells = [cells] if isinstance(cells, Cell) else list(cells)
    bp = boost_params(build.params)
    samples = grid_design.binned(build.freeze(), cells, bp.bins)
    fitted = histboost.fit(samples.select("grp", "part", "y", "x"), bp)
    out = predict(samples.where(F.col("part") == TEST), fitted, 1).where(F.col("n_trees") > 0)
    return cell_record(out.withColumn("prediction", F.col("s0")), "boosted", cells, run_id, extra=["n_trees"])
