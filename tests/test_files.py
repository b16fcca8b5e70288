"""The user's own files through the readers and the whole feature build."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from panelcast.params import Params


def _months(n, start=dt.date(2000, 1, 1)):
    return [dt.date(start.year + (start.month - 1 + i) // 12, (start.month - 1 + i) % 12 + 1, 1) for i in range(n)]


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    d = tmp_path_factory.mktemp("user")
    rows = ["date,sales,price_index"]
    for i, m in enumerate(_months(49)):  # one month beyond the last full quarter
        rows.append(f"{m.isoformat()},{100 + i},{'' if i == 5 else 101.0}")
    (d / "monthly.csv").write_text("\n".join(rows) + "\n")
    rows = ["date,gdp"] + [f"{m.isoformat()},{1000 + 10 * i}" for i, m in enumerate(_months(48)[::3])]
    (d / "quarterly.csv").write_text("\n".join(rows) + "\n")
    return d


def test_round_trip_from_csv_through_the_feature_build(spark, folder):
    from panelcast.sources.files import SourcePanels, read_monthly, read_quarterly

    m = read_monthly(spark, str(folder / "monthly.csv"), ["sales", "price_index"])
    q = read_quarterly(spark, str(folder / "quarterly.csv"), ["gdp"])
    b = SourcePanels(spark, Params(start_year=2001, test_len=2, valid_len=2, horizon=2), m, q, chained=["price_index"])
    assert b.anchor == dt.date(2003, 10, 1) and b.first_quarter == dt.date(2000, 1, 1)
    level = {r["date"]: r["value"] for r in b.panel_m().filter("indicator = 'price_index'").collect()}
    assert level[dt.date(2000, 1, 1)] == pytest.approx(101.0) and level[dt.date(2000, 6, 1)] is None
    assert level[dt.date(2000, 7, 1)] == pytest.approx(100 * 1.01 ** 6)  # the gap does not reset the chain
    d12 = {(r["feature"], r["date"]): r["value"] for r in b.monthly_features().filter("features_type = 'd12'").collect()}
    assert d12["sales_log_d12", dt.date(2001, 1, 1)] == pytest.approx(math.log(112 / 100))
    assert d12["price_index_log_d12", dt.date(2002, 1, 1)] == pytest.approx(12 * math.log(1.01))
    y = {r["date"]: r["y"] for r in b.actuals().collect()}
    assert y[dt.date(2001, 1, 1)] == pytest.approx(math.log(1040 / 1000))
    assert b.cell("d12", 1, "gdp_log_d4", 1).count() > 0


def test_parquet_nan_and_entities(spark, tmp_path):
    from panelcast.sources.files import read_monthly

    rows = [("a", dt.date(2000, 1, 31), 1.0), ("b", dt.date(2000, 1, 1), float("nan"))]
    spark.createDataFrame(rows, "who string, day date, x double").write.parquet(str(tmp_path / "p"))
    got = read_monthly(spark, str(tmp_path / "p"), ["x"], date="day", entity="who", fmt="parquet").collect()
    assert sorted((r["entity"], r["date"], r["value"]) for r in got) == [("a", dt.date(2000, 1, 1), 1.0), ("b", dt.date(2000, 1, 1), None)]
    with pytest.raises(ValueError, match="csv or parquet"):
        read_monthly(spark, "x", ["x"], fmt="xlsx")


def test_grid_from_csv(spark, tmp_path):
    from panelcast.operators.grid import block_titles, clean_long
    from panelcast.sources.files import read_grid

    head = "sheet,row_no," + ",".join(f"c{i}" for i in range(13))
    (tmp_path / "g.csv").write_text("\n".join([head, "s,1,Output" + "," * 12, 's,2,1999,"1 234,5",2,' + "," * 9]) + "\n")
    g = read_grid(spark, str(tmp_path / "g.csv"))
    assert block_titles(g) == ["Output"]
    got = {r["date"]: r["value"] for r in clean_long(g).select("date", F.col("value")).collect()}
    assert got == {dt.date(1999, 1, 1): 1234.5, dt.date(1999, 2, 1): 2.0}
