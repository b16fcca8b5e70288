"""Report-grid normaliser on a dirty hand-made sheet."""

import datetime as dt

import pytest

from panelcast.operators.grid import clean_long, headers, pivot_wide, rejects

SCHEMA = "sheet string, row_no int, " + ", ".join(f"c{i} string" for i in range(13))


def row(sheet, n, c0, *months):
    cells = list(months) + [None] * (12 - len(months))
    return (sheet, n, c0, *cells)


@pytest.fixture()
def grid(spark):
    rows = [
        row("s1", 0, "junk above the first header"),
        row("s1", 1, "  Revenue  "),
        row("s1", 2, "2000", "1,5", "2.5", "(3)", "x"),
        row("s1", 3, None),
        row("s1", 4, "2001", "123,4 1)", "", "7"),
        row("s1", 5, "Orders"),
        row("s1", 6, "2000", "10", "11"),
        row("s1", 7, "20O0", "12"),
        row("s1", 8, "2000", "99"),
    ]
    return spark.createDataFrame(rows, SCHEMA)


def test_headers_are_titles_without_numbers(grid):
    assert [r["title"] for r in headers(grid).orderBy("row_no").collect()] == ["junk above the first header",
                                                                              "Revenue", "Orders"]


def test_clean_values(grid):
    got = {(r["indicator"], r["date"]): (r["value"], r["value_strict"]) for r in clean_long(grid).collect()}
    assert got[("Revenue", dt.date(2000, 1, 1))] == (1.5, 1.5)
    assert got[("Revenue", dt.date(2000, 3, 1))][0] == 3.0
    # footnote mark: cut by default, glued on by the reference's cleaning
    assert got[("Revenue", dt.date(2001, 1, 1))] == (123.4, 123.41)
    assert ("Revenue", dt.date(2000, 4, 1)) not in got
    # duplicate (Orders, 2000-01): the first row wins
    assert got[("Orders", dt.date(2000, 1, 1))][0] == 10.0


def test_rejects_have_reasons(grid):
    reasons = sorted((r["indicator"], r["reason"]) for r in rejects(grid).collect())
    assert ("Orders", "bad_year") in reasons
    assert ("Orders", "duplicate") in reasons
    assert ("Revenue", "bad_value") in reasons


def test_pivot_has_fixed_width(grid):
    wide = pivot_wide(clean_long(grid), ["Revenue", "Orders", "Absent"])
    assert wide.columns == ["sheet", "date", "Revenue", "Orders", "Absent"]
    assert wide.filter("Absent IS NOT NULL").count() == 0


def test_exponents_are_numbers_unless_strict(spark):
    from panelcast.functions.columns import clean_numeric_text

    df = spark.createDataFrame([("1e-05",), ("2,5E3",), (" 12 ",), ("estimate 5",)], "raw string")
    got = df.select(clean_numeric_text("raw").alias("v"), clean_numeric_text("raw", True).alias("s")).collect()
    assert [r["v"] for r in got] == [1e-05, 2500.0, 12.0, 5.0]
    assert [r["s"] for r in got] == [None, 2.53, 12.0, 5.0]
