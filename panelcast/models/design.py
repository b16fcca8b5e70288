"""Model cells and the uniform forecast record of their predictions (M8)."""

from __future__ import annotations

import dataclasses
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclasses.dataclass(frozen=True)
class Cell:
    features_type: str
    availability: int
    target: str
    horizon: int
    strategy: str = "avail_only"


def safe_name(c: str) -> str:
    return c.replace(".", "_")


def cell_record(pred: DataFrame, model: str, cells: Sequence[Cell], run_id: str, lo: Column | None = None,
                hi: Column | None = None, extra: Sequence[str] = ()) -> DataFrame:
    """M8: ``pred(grp, entity, date, prediction)`` of the cells ``grp`` numbers, in the uniform forecasts schema."""
    none = F.lit(None).cast("double")
    grid = pred.sparkSession.createDataFrame(
        [(k, c.target, c.features_type, c.availability, c.horizon) for k, c in enumerate(cells)],
        "grp int, target string, features_type string, availability int, horizon int")
    return pred.join(F.broadcast(grid), "grp").select(  # one row a cell
        F.lit(run_id).alias("run_id"), F.lit(model).alias("model"), "entity", "target", "features_type", "availability", "horizon",
        F.expr("cast(add_months(date, -3 * horizon) as date)").alias("origin"), "date", F.col("prediction").cast("double").alias("pred"),
        (none if lo is None else lo).alias("lo"), (none if hi is None else hi).alias("hi"), *extra)
