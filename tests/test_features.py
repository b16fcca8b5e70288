"""Direct-horizon cell addressing (B1, B2, B2c) and month-of-quarter features (P8, J3) on a tiny panel."""

import datetime as dt

import pytest

from panelcast.operators.features import cell_design, quarter_pivot

Q = [dt.date(2000 + i // 4, 3 * (i % 4) + 1, 1) for i in range(6)]


@pytest.fixture()
def feat_q(spark):
    rows = []
    for i, d in enumerate(Q):
        rows += [("e", "x_d12_m1", "d12", 1, d, 100.0 + i), ("e", "x_d12_m2", "d12", 2, d, 10.0 + i),
                 ("e", "x_d12_roll_mean_3_m2", "rolling", 2, d, 50.0 + i)]
    return spark.createDataFrame(rows, "entity string, feature string, features_type string, availability int, "
                                       "date date, value double")


@pytest.fixture()
def targets(spark):
    return spark.createDataFrame([("e", "t", d, 0.1 * i) for i, d in enumerate(Q)],
                                 "entity string, target string, date date, y double")


def design(df):
    return {(r["date"], r["column"]): r["value"] for r in df.collect()}


def test_horizon_two_uses_features_lagged_one_and_target_lagged_two(feat_q, targets):
    got = design(cell_design(feat_q, targets, "d12", 2, "t", 2, start=Q[2]))
    assert {c for _, c in got} == {"x_d12_m2_lag1", "t_lag2", "y"}
    assert min(d for d, _ in got) == Q[2]  # the start filter runs after the lags
    assert got[(Q[2], "x_d12_m2_lag1")] == 11.0
    assert got[(Q[2], "t_lag2")] == pytest.approx(0.0)
    assert got[(Q[5], "y")] == pytest.approx(0.5)


def test_nowcast_is_unlagged_and_availability_is_not_cumulative(feat_q, targets):
    got = design(cell_design(feat_q, targets, "d12", 2, "t", 1))
    assert {c for _, c in got} == {"x_d12_m2", "t_lag1", "y"}
    assert got[(Q[0], "x_d12_m2")] == 10.0


def test_strategy_all_takes_months_up_to_availability_but_not_for_rolling(feat_q, targets):
    cols = {c for _, c in design(cell_design(feat_q, targets, "d12", 2, "t", 1, strategy="all"))}
    assert {"x_d12_m1", "x_d12_m2"} <= cols
    cols = {c for _, c in design(cell_design(feat_q, targets, "rolling", 2, "t", 1, strategy="all"))}
    assert cols == {"x_d12_roll_mean_3_m2", "t_lag1", "y"}


def test_horizon_below_one_is_rejected(feat_q, targets):
    with pytest.raises(ValueError):
        cell_design(feat_q, targets, "d12", 2, "t", 0)


def test_month_of_quarter_pivot(spark):
    months = [dt.date(2000, m, 1) for m in range(1, 7)]
    df = spark.createDataFrame([("e", "f", "d12", d, float(d.month)) for d in months],
                               "entity string, feature string, features_type string, date date, value double")
    got = {r["date"]: (r["m1"], r["m2"], r["m3"]) for r in quarter_pivot(df, months[0], months[3]).collect()}
    assert got == {dt.date(2000, 1, 1): (1.0, 2.0, 3.0), dt.date(2000, 4, 1): (4.0, 5.0, 6.0)}
