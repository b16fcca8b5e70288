"""The grid's design rows against single cells, and the linear model against Spark's."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelcast.models import grid_design, sparse_linear
from panelcast.models.design import Cell
from panelcast.params import MODEL_TEST_PARAMS
from panelcast.plans.catalog import build
from tests.conftest import SMOKE

CELLS = [Cell("d12", 2, "gmv_log_d4", 3), Cell("rolling", 1, "qty_log_d4", 1), Cell("d12", 3, "net_sales_log_d4", 6, "all"),
         Cell("d12", 2, "qty_log_d4", 1)]


@pytest.fixture(scope="module")
def b(spark):
    return build(spark, SMOKE, MODEL_TEST_PARAMS).freeze()


def test_design_rows_are_those_of_the_single_cells(spark, b):
    rows = grid_design.values(b, CELLS).collect()
    for k, c in enumerate(CELLS):
        wide = {}
        for r in b.cell(c.features_type, c.availability, c.target, c.horizon, c.strategy).where(F.col("date") <= b.anchor).collect():
            wide.setdefault((r["entity"], r["date"]), {})[r["column"]] = r["value"]
        lag = f"{c.target}_lag{c.horizon}"
        feats = sorted({x for v in wide.values() for x in v} - {"y", lag})
        want = {key: (v.get("y"), [v.get(f) for f in feats] + [v.get(lag)]) for key, v in wide.items()}
        got = {(r["entity"], r["date"]): (r["y"], r["v"]) for r in rows if r["grp"] == k}
        assert got == want and feats


def test_bins_follow_the_training_quantiles(spark, b):
    got = {(r["grp"], r["entity"], r["date"]): r["x"] for r in grid_design.binned(b, CELLS, 8).collect()}
    rows = {(r["grp"], r["entity"], r["date"]): (r["split"], r["v"]) for r in grid_design.values(b, CELLS).collect()}
    assert set(got) == set(rows)
    seen = {(key[0], j) for key, (split, v) in rows.items() for j, x in enumerate(v) if split == "train" and x is not None}
    by_feature = {}
    for key, x in got.items():
        v = rows[key][1]
        assert len(x) == len(v)
        for j, (a, value) in enumerate(zip(x, v)):
            # at horizons over 1 the quantiles' quarters begin before the rows' do
            assert a <= 8 and (a == 0 if value is None else a > 0 or (key[0], j) not in seen)
            by_feature.setdefault((key[0], j), []).append((value, a))
    for pairs in by_feature.values():
        bins = [a for _, a in sorted((v, a) for v, a in pairs if v is not None)]
        assert bins == sorted(bins)


def _samples(spark, n=160, width=5, groups=2, holes=False):
    rng = np.random.default_rng(2)
    rows = []
    for g in range(groups):
        x = rng.normal(size=(n, width)) * np.array([1, 10, 0.1, 1000, 2]) + np.array([0, 5, 0, 1e6, -3])
        y = x[:, 0] - 0.2 * x[:, 1] + 3 * x[:, 2] + 0.001 * x[:, 3] + rng.normal(size=n) * (0.1 + g)
        for i in range(n):
            v = [float(a) for a in x[i]]
            if holes and i % 11 == 0:
                v[4] = None
            rows.append((g, 1 if i < 100 else 2 if i < 130 else 3, float(y[i]), v))
    return spark.createDataFrame(rows, "grp int, part int, y double, v array<double>").repartition(6), rows


def test_every_penalty_equals_sparks_linear_regression(spark):
    from pyspark.ml.functions import array_to_vector
    from pyspark.ml.regression import LinearRegression

    df, rows = _samples(spark, groups=1)
    x = np.array([r[3] for r in rows if r[1] == 1])
    y = np.array([r[2] for r in rows if r[1] == 1])
    m, z = sparse_linear.Moments.of(np.column_stack([x, y])), (x - x.mean(axis=0)) / x.std(axis=0)
    zdf = spark.createDataFrame([(float(b), [float(v) for v in a]) for a, b in zip(z, y)], "label double, v array<double>") \
        .withColumn("features", array_to_vector("v"))
    penalties = [0.001, 0.01, 0.1, 1.0]
    for lam, (intercept, coef) in zip(penalties, sparse_linear.path(m, np.arange(5), penalties, 0.5)):
        ref = LinearRegression(regParam=lam, elasticNetParam=0.5, standardization=False, maxIter=2000, tol=1e-13).fit(zdf)
        assert np.allclose(coef * x.std(axis=0), ref.coefficients.toArray(), atol=1e-5, rtol=1e-6)
        assert intercept + coef @ x.mean(axis=0) == pytest.approx(ref.intercept, rel=1e-6)


def test_one_pass_equals_the_rows_and_leaves_out_columns_with_nulls(spark):
    penalties = (0.001, 0.1, 1.0)
    df, rows = _samples(spark, holes=True)
    for r in sparse_linear.coefficients(df, penalties, 0.5).collect():
        of = lambda part: np.array([[np.nan if a is None else a for a in x[3]] + [x[2]] for x in rows if x[0] == r["grp"] and x[1] in part])
        train, valid, both = of((1,)), of((2,)), of((1, 2))
        cols = np.arange(4)
        errors = []
        for b0, b in sparse_linear.path(sparse_linear.Moments.of(train), cols, penalties, 0.5):
            errors.append(((valid[:, 5] - b0 - valid[:, :4] @ b) ** 2).mean())
        best = penalties[int(np.argmin(errors))]
        b0, b = sparse_linear.path(sparse_linear.Moments.of(both), cols, [best], 0.5)[0]
        assert r["penalty"] == best and r["coef"][4] == 0.0
        assert np.allclose(r["coef"][:4], b, rtol=1e-6) and r["intercept"] == pytest.approx(b0, rel=1e-6, abs=1e-6)


def test_parts_of_moments_merge_to_the_whole():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(50, 3)) + 1e6
    a = sparse_linear.Moments.of(x[:7]) + sparse_linear.Moments.of(x[7:30]) + sparse_linear.Moments.of(x[30:])
    b = sparse_linear.Moments.of(x)
    assert a.n == b.n and np.allclose(a.mean, b.mean) and np.allclose(a.cross, b.cross, rtol=1e-6)
