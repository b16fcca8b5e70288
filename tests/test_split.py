"""Invariants of splits, rolling origins and vintages."""

import datetime as dt
from collections import Counter

from pyspark.sql import functions as F

from panelcast.models.factor import origin_dates
from panelcast.operators.split import SplitBounds, chrono_split, ragged_edge, rolling_origins, vintages
from panelcast.params import Params


def quarters(n, start=dt.date(1990, 1, 1)):
    out, y, m = [], start.year, start.month
    for _ in range(n):
        out.append(dt.date(y, m, 1))
        y, m = (y + 1, m - 9) if m == 10 else (y, m + 3)
    return out


def test_splits_are_disjoint_and_contiguous(spark):
    qs = quarters(40)
    df = spark.createDataFrame([(d,) for d in qs], "date date")
    b = SplitBounds.of(qs[-1], Params())
    got = {r["date"]: r["split"] for r in chrono_split(df, b).collect()}
    order = [got[d] for d in qs]
    assert order == ["train"] * 16 + ["valid"] * 12 + ["test"] * 12


def test_rolling_origins_cover_each_test_date_and_horizon_once(spark):
    qs = quarters(60)
    anchor, T, H = qs[-1], 12, 6
    df = spark.createDataFrame([(d,) for d in qs], "date date")
    ro = rolling_origins(df, anchor, T, H).collect()
    assert len(ro) == 87
    assert len({r["origin_id"] for r in ro}) == T + H - 1
    test_dates = set(qs[-T:])
    in_test = Counter((r["date"], r["horizon"]) for r in ro if r["date"] in test_dates)
    assert len(in_test) == T * H and set(in_test.values()) == {1}
    # training data of a window is everything before its start: no horizon-1 date precedes its origin
    assert all(r["date"] >= r["origin"] for r in ro)
    assert sorted({r["origin"] for r in ro}) == origin_dates(anchor, T, H)


def test_vintages_drop_the_latest_quarters(spark):
    qs = quarters(8)
    ms = [dt.date(d.year, d.month + k, 1) for d in qs for k in range(3)]
    q = spark.createDataFrame([(d,) for d in qs], "date date")
    m = spark.createDataFrame([(d,) for d in ms], "date date")
    mv, qv = vintages(m, q, qs[-1], ms[-1], 3)
    # vintage 0 holds out the current quarter; vintage tp drops tp+1 quarters
    for tp in range(3):
        assert qv.filter(F.col("vintage") == tp).count() == len(qs) - tp - 1
        assert mv.filter(F.col("vintage") == tp).count() == len(ms) - 3 * tp


def test_ragged_edge_blanks_unpublished_months(spark):
    ms = [dt.date(2000, k, 1) for k in range(1, 7)]
    df = spark.createDataFrame([(d, 1.0) for d in ms], "date date, value double")
    out = ragged_edge(df, ms[-1], 1).orderBy("date").collect()
    assert [r["value"] for r in out] == [1.0, 1.0, 1.0, 1.0, None, None]
