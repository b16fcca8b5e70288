"""Design rows of all model cells of a grid in one DataFrame (B1, B2, B2c, B8 for M1-M3).

A cell is (features_type, availability, target, horizon, strategy).  Cells with the same features share one
feature set; a row of features is an array in the order of the feature names, its length found by an aggregate, so the
plan is as wide for a thousand indicators as for six.  A cell's row at date t takes the features of t - (h - 1) quarters,
the target lagged h, and the label; dates and lags are those of :func:`panelcast.operators.features.cell_design`.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelcast.functions.columns import to_date
from panelcast.models.design import Cell
from panelcast.operators.series import TARGET_KEYS
from panelcast.operators.split import split_column
from panelcast.session import cut_lineage

MAX_CELLS = 4_096     # a grid is a list of parameters; its cells and feature sets are broadcast


def feature_sets(cells: Sequence[Cell]) -> list[tuple[str, int, str]]:
    """The distinct (features_type, availability, strategy) of a grid, in order."""
    if len(cells) > MAX_CELLS:
        raise ValueError(f"a grid of {len(cells)} cells is over {MAX_CELLS}; run it in parts")
    return sorted({(c.features_type, c.availability, c.strategy) for c in cells})


def _member(features_type: str, availability: int, strategy: str):
    month = (F.col("availability") <= availability) if strategy == "all" and features_type == "d12" else (F.col("availability") == availability)
    return (F.col("features_type") == features_type) & month


def long_features(feat_q: DataFrame, sets: Sequence[tuple[str, int, str]]) -> DataFrame:
    """``(fs, feature, pos, entity, date, value)``: ``pos`` is the feature's place in the sorted names of its set."""
    which = F.filter(F.array(*(F.when(_member(*s), F.lit(k)) for k, s in enumerate(sets))), lambda x: x.isNotNull())
    rows = feat_q.withColumn("fs", F.explode(which)).select("fs", "feature", "entity", "date", "value")
    names = rows.select("fs", "feature").distinct() \
        .withColumn("pos", F.row_number().over(Window.partitionBy("fs").orderBy("feature")) - 1)
    return rows.join(names, ["fs", "feature"])


def wide(long: DataFrame, value: str, out: str) -> DataFrame:
    """``(fs, entity, date, out)``: one array a row, null where a feature has no row."""
    width = long.groupBy("fs").agg((F.max("pos") + 1).alias("width"))
    rows = long.groupBy("fs", "entity", "date").agg(F.map_from_entries(F.collect_list(F.struct("pos", value))).alias("at"))
    return rows.join(width, "fs").select(
        "fs", "entity", "date", F.expr(f"transform(sequence(0, width - 1), i -> try_element_at(at, i))").alias(out))


def design(build, cells: Sequence[Cell], features: DataFrame, sets: Sequence[tuple[str, int, str]], out: str) -> DataFrame:
    """``(grp, entity, date, split, y, y_lag, out)``: every cell's rows, ``grp`` its place in ``cells``."""
    spark, start = build.spark, build.params.start_date
    grid = spark.createDataFrame([(k, sets.index((c.features_type, c.availability, c.strategy)), c.target, c.horizon)
                                  for k, c in enumerate(cells)], "grp int, fs int, target string, horizon int")
    far = max(c.horizon for c in cells)
    w = Window.partitionBy(*TARGET_KEYS).orderBy("date")
    t = build.aligned_targets().select(*TARGET_KEYS, "date", "y", F.array(*(F.lag("y", h).over(w) for h in range(1, far + 1))).alias("lags"))
    t = t.where(F.col("date") >= to_date(start))
    rows = t.join(F.broadcast(grid), "target") \
        .withColumn("y_lag", F.element_at("lags", F.col("horizon"))) \
        .withColumn("at", F.expr("cast(add_months(date, -3 * (horizon - 1)) as date)"))
    here = features.select("fs", "entity", "date")
    now = features.select("fs", "entity", F.col("date").alias("at"), out)
    none = features.groupBy("fs").agg(F.max(F.size(out)).alias("width"))
    rows = rows.join(here, ["fs", "entity", "date"], "left_semi").join(now, ["fs", "entity", "at"], "left").join(none, "fs")
    kind = features.schema[out].dataType
    empty = F.expr("transform(sequence(1, width), i -> null)").cast(kind)
    return rows.select("grp", "entity", "date", split_column(build.split_bounds()).alias("split"), "y", "y_lag",
                       F.coalesce(out, empty).alias(out)).where(F.col("split").isNotNull())


def values(build, cells: Sequence[Cell]) -> DataFrame:
    """The design with the features and, last, the lagged target as an array of doubles ``v``; checkpointed."""
    sets = feature_sets(cells)
    rows = design(build, cells, wide(long_features(build.feat_q(), sets), "value", "v"), sets, "v")
    return cut_lineage(rows.withColumn("v", F.concat("v", F.array("y_lag"))).drop("y_lag"))


def _bin(value, borders):
    """0 for a missing value, else 1 + the number of borders below it."""
    return F.when(value.isNull() | borders.isNull(), F.lit(0)).otherwise(1 + F.size(F.filter(borders, lambda b: b < value)))


def _borders(value: str, bins: int):
    return F.array_distinct(F.percentile_approx(F.col(value), [k / bins for k in range(1, bins)], 10_000)).alias("borders")


def binned(build, cells: Sequence[Cell], bins: int) -> DataFrame:
    """The design with every feature and, last, the lagged target as a number of bin, one byte each, in ``x``; checkpointed.

    Borders are quantiles of the training quarters, per feature of a set and per target; valid and test rows have no part in them.
    A feature without a value in the training quarters is missing throughout.
    """
    if not 2 <= bins <= 255:
        raise ValueError("bins must be 2 to 255")
    sets = feature_sets(cells)
    before = to_date(build.split_bounds().valid[0])
    train = F.col("date").between(to_date(build.params.start_date), F.date_sub(before, 1))
    long = long_features(build.feat_q(), sets)
    borders = long.where(train).groupBy("fs", "pos").agg(_borders("value", bins))
    long = long.join(borders, ["fs", "pos"], "left").withColumn("bin", _bin(F.col("value"), F.col("borders")))
    rows = design(build, cells, wide(long, "bin", "x"), sets, "x")
    lag = build.aligned_targets().where(train).groupBy("target").agg(_borders("y", bins))
    of = build.spark.createDataFrame([(k, c.target) for k, c in enumerate(cells)], "grp int, target string")
    rows = rows.join(F.broadcast(of.join(lag, "target", "left").select("grp", "borders")), "grp")   # one row a cell
    x = F.concat(F.transform("x", lambda b: F.coalesce(b, F.lit(0))), F.array(_bin(F.col("y_lag"), F.col("borders"))))
    part = F.when(F.col("split") == "train", 1).when(F.col("split") == "valid", 2).otherwise(3)
    byte = F.unhex(F.array_join(F.transform(x, lambda b: F.lpad(F.hex(b), 2, "0")), ""))
    return cut_lineage(rows.select("grp", "entity", "date", part.alias("part"), "y", byte.alias("x")))


