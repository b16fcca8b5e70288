"""Scoring rules: RMSE, relative RMSE, leaderboard tie and NULL handling, Gaussian CRPS."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from panelcast.functions.columns import crps_gaussian, normal_cdf
from panelcast.operators.score import leaderboard, naive_rmse, relative, rmse


def test_normal_cdf_accuracy(spark):
    zs = [-3.0, -1.0, -0.2, 0.0, 0.5, 2.0]
    df = spark.createDataFrame([(z,) for z in zs], "z double")
    got = [r[0] for r in df.select(normal_cdf("z")).collect()]
    for z, g in zip(zs, got):
        assert g == pytest.approx(0.5 * (1 + math.erf(z / math.sqrt(2))), abs=1e-7)


def test_crps_matches_numeric_integral(spark):
    y, mu, s = 0.3, -0.1, 0.7
    df = spark.createDataFrame([(y, mu, s)], "y double, mu double, s double")
    got = df.select(crps_gaussian("y", "mu", "s")).first()[0]
    # integral of (F(x) - 1{x >= y})^2 over a fine grid
    n, lo, hi = 200000, -10.0, 10.0
    step = (hi - lo) / n
    acc = 0.0
    for i in range(n):
        x = lo + (i + 0.5) * step
        cdf = 0.5 * (1 + math.erf((x - mu) / (s * math.sqrt(2))))
        acc += (cdf - (1.0 if x >= y else 0.0)) ** 2 * step
    assert got == pytest.approx(acc, rel=1e-4)


def targets(spark):
    qs = [dt.date(2000 + i // 4, 3 * (i % 4) + 1, 1) for i in range(12)]
    ys = [0.1, 0.2, 0.15, 0.3, 0.25, 0.2, 0.35, 0.3, 0.4, 0.2, 0.1, 0.3]
    return spark.createDataFrame([("e", "t", d, y) for d, y in zip(qs, ys)],
                                 "entity string, target string, date date, y double"), qs


def test_naive_scored_against_itself_is_one(spark):
    act, qs = targets(spark)
    nr = naive_rmse(act, [1, 2], qs[8], qs[11])
    fc = act.select("entity", "target", "date", F.lit(1).alias("horizon"), F.lit("naive").alias("model"),
                    F.lit("d12").alias("features_type"), F.lit(1).alias("availability"),
                    F.lag("y", 1).over(__import__("pyspark.sql").sql.Window.partitionBy("entity").orderBy("date")).alias("pred"))
    fc = fc.filter(F.col("date").between(F.lit(qs[8]), F.lit(qs[11])))
    scored = fc.join(act.select("entity", "target", "date", "y"), ["entity", "target", "date"])
    rel = relative(rmse(scored), nr).collect()
    assert len(rel) == 1 and rel[0]["rel_rmse_naive"] == pytest.approx(1.0)
    want = math.sqrt(sum((a - b) ** 2 for a, b in [(0.4, 0.3), (0.2, 0.4), (0.1, 0.2), (0.3, 0.1)]) / 4)
    assert rel[0]["rmse"] == pytest.approx(want)


def test_leaderboard_ignores_null_and_breaks_ties_by_name(spark):
    rows = [("t", 1, 1, "b", "d12", 0.5), ("t", 1, 1, "a", "d12", 0.5), ("t", 1, 1, "c", "d12", None),
            ("t", 1, 2, "c", "d12", None), ("t", 1, 2, "b", "rolling", 0.9)]
    m = spark.createDataFrame(rows, "target string, horizon int, availability int, model string, "
                                    "features_type string, rel_rmse_naive double")
    got = {r["availability"]: (r["best_model"], r["best_rel_rmse_naive"]) for r in leaderboard(m).collect()}
    assert got == {1: ("a", 0.5), 2: ("b", 0.9)}
