"""Golden micro-fixtures for the window transforms."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from panelcast.functions.columns import full_frame_mean
from panelcast.operators.series import (add_lags, chain_index, log_diff, naive_forecasts, positivity_profile,
                                        series_window, yoy_diff)


def months(n, start=dt.date(2000, 1, 1)):
    out, y, m = [], start.year, start.month
    for _ in range(n):
        out.append(dt.date(y, m, 1))
        y, m = (y + 1, 1) if m == 12 else (y, m + 1)
    return out


def frame(spark, values, indicator="x", entity="e"):
    rows = [(entity, indicator, d, v) for d, v in zip(months(len(values)), values)]
    return spark.createDataFrame(rows, "entity string, indicator string, date date, value double")


def column(df, c):
    return [r[c] for r in df.orderBy("date").select(c).collect()]


def test_chain_keeps_base_and_skips_nulls(spark):
    out = column(chain_index(frame(spark, [101.0, None, 99.0, 102.0])), "level")
    assert out[1] is None
    assert out[0] == pytest.approx(101.0)
    assert out[2] == pytest.approx(101.0 * 0.99)
    assert out[3] == pytest.approx(101.0 * 0.99 * 1.02)


def test_chain_of_month_on_month_ratios_is_proportional_to_level(spark):
    level = [50.0, 55.0, 44.0, 48.4, 60.5]
    idx = [100.0] + [100 * b / a for a, b in zip(level, level[1:])]
    out = column(chain_index(frame(spark, idx)), "level")
    for got, want in zip(out, level):
        assert got == pytest.approx(want * 100 / level[0])


def test_rolling_mean_needs_a_full_frame(spark):
    df = frame(spark, [1.0, 2.0, None, 4.0, 5.0, 6.0])
    out = column(df.withColumn("r", full_frame_mean("value", series_window(), 3)), "r")
    assert out == [None, None, None, None, None, pytest.approx(5.0)]


def test_yoy_uses_log_only_for_positive_series(spark):
    vals_pos = [float(i + 1) for i in range(14)]
    vals_neg = [float(i - 5) for i in range(14)]
    df = frame(spark, vals_pos, "pos").unionByName(frame(spark, vals_neg, "neg"))
    prof = positivity_profile(df)
    assert {r["indicator"]: r["transform"] for r in prof.collect()} == {"pos": "log", "neg": "level"}
    out = yoy_diff(df, prof).filter(F.col("date") == dt.date(2001, 1, 1))
    got = {r["feature"]: r["d12"] for r in out.collect()}
    assert got["pos_log_d12"] == pytest.approx(math.log(13) - math.log(1))
    assert got["neg_d12"] == pytest.approx(12.0)


def test_quarterly_log_difference_is_null_for_non_positive(spark):
    rows = [("e", "t", dt.date(2000 + i // 4, 3 * (i % 4) + 1, 1), v)
            for i, v in enumerate([1.0, 2.0, 3.0, 4.0, 2.0, -1.0])]
    df = spark.createDataFrame(rows, "entity string, target string, date date, level double")
    out = column(log_diff(df, "level", 4), "y")
    assert out[:4] == [None] * 4
    assert out[4] == pytest.approx(math.log(2.0))
    assert out[5] is None


def test_lags_and_naive_are_positional(spark):
    rows = [("e", "t", d, float(i)) for i, d in enumerate(months(6))]
    df = spark.createDataFrame(rows, "entity string, target string, date date, y double")
    lagged = add_lags(df, "y", [1, 2], ("entity", "target"))
    assert column(lagged, "lag2") == [None, None, 0.0, 1.0, 2.0, 3.0]
    nf = naive_forecasts(df, [1, 2]).filter("horizon = 2")
    assert column(nf, "pred") == [None, None, 0.0, 1.0, 2.0, 3.0]
