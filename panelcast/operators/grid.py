"""Report-grid normaliser: titled year x month blocks -> long panel.

Input schema ``(sheet, row_no, c0, c1..c12)`` (all text).  A block starts at
a *header* row (a title in c0, every month cell empty) and runs to the next
header.  Data rows carry the year in c0.  The title is carried down the
rows of its block by a fill-forward window per sheet; a sheet is a
spreadsheet tab, bounded by the file format (about 1M rows), so the
per-sheet window never holds an unbounded group.

Bad rows are not dropped silently (as one failing cell drops a whole sheet
in the reference): ``rejects`` returns them with a reason.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelcast.functions.columns import clean_numeric_text

MONTH_COLS = [f"c{m}" for m in range(1, 13)]
NUMBER_LIKE = r"^\s*[0-9]+(\.0)?\s*$"
YEAR_DIGITS = r"^[0-9]+$"


def mark_headers(grid: DataFrame) -> DataFrame:
    """G1: header = non-empty, non-numeric c0 and every month cell empty."""
    empty_months = F.coalesce(*(F.col(c) for c in MONTH_COLS)).isNull()
    c0 = F.col("c0")
    is_header = c0.isNotNull() & (F.trim(c0) != "") & ~c0.rlike(NUMBER_LIKE) & empty_months
    return grid.withColumn("is_header", is_header)


def assign_sections(grid: DataFrame) -> DataFrame:
    """Carry the trimmed title down its block; rows above the first header get NULL."""
    w = Window.partitionBy("sheet").orderBy("row_no").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    title = F.last(F.when(F.col("is_header"), F.trim(F.col("c0"))), ignorenulls=True).over(w)
    return mark_headers(grid).withColumn("indicator", title)


def block_titles(grid: DataFrame) -> list[str]:
    """All distinct titles that G1 finds, sorted: the columns of G12 (a sheet's table of contents, not its data)."""
    return sorted(r["title"] for r in headers(grid).select("title").distinct().collect())


def headers(grid: DataFrame) -> DataFrame:
    """G1: the header rows with their trimmed titles."""
    return mark_headers(grid).filter("is_header").select("sheet", "row_no", F.trim("c0").alias("title"))


def block_cells(grid: DataFrame) -> DataFrame:
    """Data rows of every block melted to (sheet, indicator, row_no, year_text, month, raw).

    All-empty rows and empty cells disappear; the year text is kept as is.
    """
    rows = assign_sections(grid).filter(F.col("indicator").isNotNull() & ~F.col("is_header"))
    rows = rows.na.drop(how="all", subset=["c0", *MONTH_COLS])
    long = rows.unpivot(["sheet", "indicator", "row_no", "c0"], MONTH_COLS, "mcol", "raw")
    return long.filter(F.col("c0").isNotNull() & F.col("raw").isNotNull()).select(
        "sheet", "indicator", "row_no", F.col("c0").alias("year_text"),
        F.substring("mcol", 2, 2).cast("int").alias("month"), "raw")


def parse_cells(cells: DataFrame) -> DataFrame:
    """Digit-only years, cleaned numbers, month-start dates.

    Adds ``year_ok``, ``value`` (footnote-aware cleaning), ``value_strict``
    (the reference cleaning) and ``date``; nothing is filtered here.
    """
    year_ok = F.col("year_text").rlike(YEAR_DIGITS) & (F.length("year_text") <= 4)
    year = F.when(year_ok, F.col("year_text").cast("int"))
    date = F.when(year.between(1, 9999), F.make_date(year, F.col("month"), F.lit(1)))
    return cells.select("*", year_ok.alias("year_ok"), date.alias("date"),
                        clean_numeric_text("raw").alias("value"),
                        clean_numeric_text("raw", strict_reference=True).alias("value_strict"))


def judged(parsed: DataFrame) -> DataFrame:
    """Every cell with its ``reason``: bad_year, bad_date, bad_value, duplicate, or NULL for a good one.

    Of the cells with the same (sheet, indicator, date) the first row is good and the others are duplicates.
    """
    reason = (F.when(~F.col("year_ok"), F.lit("bad_year"))
              .when(F.col("date").isNull(), F.lit("bad_date"))
              .when(F.col("value").isNull(), F.lit("bad_value")))
    w = Window.partitionBy("sheet", "indicator", "date", "reason").orderBy("row_no")
    later = F.col("reason").isNull() & (F.row_number().over(w) > 1)
    return parsed.withColumn("reason", reason).withColumn("reason", F.when(later, F.lit("duplicate")).otherwise(F.col("reason")))


def clean_long(grid: DataFrame) -> DataFrame:
    """The long panel (sheet, indicator, date, value, value_strict, row_no), first row wins on duplicates."""
    return judged(parse_cells(block_cells(grid))).filter(F.col("reason").isNull()).drop("reason")


def pivot_wide(long: DataFrame, indicators: Sequence[str], names: Sequence[str] | None = None) -> DataFrame:
    """One column per indicator; the values are listed explicitly (fixed plan width)."""
    names = list(names or indicators)
    p = long.groupBy("sheet", "date").pivot("indicator", list(indicators)).agg(F.max("value"))
    return p.withColumnsRenamed(dict(zip(indicators, names)))


def rejects(grid: DataFrame) -> DataFrame:
    """Every dropped cell with its reason: bad_year, bad_date, bad_value, duplicate."""
    bad = judged(parse_cells(block_cells(grid))).filter(F.col("reason").isNotNull())
    return bad.select("sheet", "row_no", "indicator", "month", "raw", "reason")
