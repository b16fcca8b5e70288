"""Forecast table round trip (S9, S5, S11, S14) and scoring of stored forecasts."""

import os

from pyspark.sql import functions as F

from tests.conftest import SMOKE


def test_forecasts_round_trip_and_prune(spark, tmp_path):
    from panelcast.operators.score import METRICS_COLUMNS, metrics_table
    from panelcast.plans.catalog import _bench, build
    from panelcast.sources.sinks import read_forecasts, read_metrics, write_forecasts, write_metrics

    b = build(spark, SMOKE)
    f = _bench(b)
    path = str(tmp_path / "forecasts")
    write_forecasts(f, path)
    assert [d for d in os.listdir(path) if d.startswith("run_id=")] == ["run_id=bench"]
    assert {d for d in os.listdir(f"{path}/run_id=bench") if "=" in d} == {"model=mean4", "model=naive", "model=snaive"}
    back = read_forecasts(spark, path, ["naive"])
    assert back.count() == f.filter(F.col("model") == "naive").count()
    assert "PartitionFilters: [isnotnull(model" in back._jdf.queryExecution().executedPlan().toString()
    lo, hi = b.test_bounds()
    m = metrics_table(back, b.actuals(), range(1, b.params.horizon + 1), lo, hi)
    mpath = str(tmp_path / "metrics")
    write_metrics(m, mpath, "first")
    write_metrics(m.limit(1), mpath, "second")  # leaves the first run alone
    got = read_metrics(spark, mpath, "first")
    assert got.columns == [*METRICS_COLUMNS, "run_id"]
    assert got.count() == m.count() and read_metrics(spark, mpath).count() == m.count() + 1
    rel = [r["rel_rmse_naive"] for r in got.collect() if r["rel_rmse_naive"] is not None]
    assert rel and all(abs(x - 1.0) < 1e-9 for x in rel)


def test_public_api_end_to_end(spark):
    from panelcast import api
    from panelcast.params import MODEL_TEST_PARAMS

    b = api.build_features(spark, SMOKE, MODEL_TEST_PARAMS)
    lags = api.add_lags(b, [0, 1])
    assert set(r["lag"] for r in lags.select("lag").distinct().collect()) == {0, 1}
    split = api.chrono_split(b, b.actuals())
    assert {r["split"] for r in split.select("split").distinct().collect()} == {"train", "valid", "test"}
    f = api.fit_cell("sparse_linear", b, api.Cell("d12", 3, "gmv_log_d4", 1))
    board = api.leaderboard(api.score(b, f))
    rows = board.collect()
    assert rows and all(r["best_model"] == "sparse_linear" for r in rows)


def test_output_orders(spark):
    """The sinks' row order, which a multiset check cannot see."""
    from panelcast.plans.catalog import REGISTRY

    rows = [(r["target"], r["horizon"], -r["availability"], r["model"], r["features_type"]) for r in REGISTRY["metrics_table"](spark, SMOKE).collect()]
    assert rows == sorted(rows) and len({r[2] for r in rows}) == 3
    rows = [(r["model"], r["target"], r["features_type"], r["availability"], r["horizon"]) for r in REGISTRY["rmse_long"](spark, SMOKE).collect()]
    assert rows == sorted(rows)
    rows = [(r["target"], r["horizon"], r["availability"]) for r in REGISTRY["leaderboard"](spark, SMOKE).collect()]
    assert rows == sorted(set(rows))


def test_anchor_is_the_last_complete_quarter(spark):
    import datetime as dt

    from panelcast.operators.features import last_full_quarter
    from panelcast.plans.catalog import build

    day = dt.date
    assert [last_full_quarter(d) for d in (day(2001, 9, 30), day(2001, 9, 29), day(2002, 1, 1))] == [day(2001, 7, 1), day(2001, 4, 1), day(2001, 10, 1)]
    b = build(spark, SMOKE)
    assert b.month_bounds[1] > b.anchor  # later months are read, and trimmed by the anchor only
    assert b.panel_q().filter(F.col("date") > F.lit(b.anchor)).count() > 0


def test_bucketed_forecasts_and_actuals_are_scored_without_a_shuffle(spark, tmp_path):
    import datetime as dt

    from panelcast.operators.score import FORECASTS_SCHEMA, join_actuals, rmse
    from panelcast.sources.sinks import bucketed

    days = [dt.date(2000, 1 + 3 * q, 1) for q in range(4)]
    rows = [("r", m, f"e{e}", t, "d12", 1, 1, days[0], d, float(e + k), None, None)
            for m in ("a", "b") for e in range(6) for t in ("x", "y") for k, d in enumerate(days)]
    actual = [(f"e{e}", t, d, float(e)) for e in range(6) for t in ("x", "y") for d in days]
    fdf = spark.createDataFrame(rows, FORECASTS_SCHEMA).repartition(3)
    adf = spark.createDataFrame(actual, "entity string, target string, date date, y double")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        with bucketed(fdf, str(tmp_path / "f"), 5) as f, bucketed(adf, str(tmp_path / "a"), 5) as a:
            joined = join_actuals(f.where(f.date >= days[1]), a)
            assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
            plan = rmse(joined)._jdf.queryExecution().executedPlan().toString()
            assert plan.count("Exchange") == 1 and plan.index("Exchange") < plan.index("SortMergeJoin")
            got = sorted(map(tuple, rmse(joined).collect()))
            name = f._jdf.queryExecution().analyzed().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert got == sorted(map(tuple, rmse(join_actuals(fdf.where(fdf.date >= days[1]), adf)).collect()))
    assert "scored_" in name and not [t for t in spark.catalog.listTables() if t.name.startswith("scored_")]
    assert spark.read.parquet(str(tmp_path / "f")).count() == len(rows)
