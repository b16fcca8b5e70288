"""Report-grid adapter: monthly order revenue laid out like a statistical report.

Schema ``(sheet string, row_no int, c0..c12 string)``: one sheet per region,
one titled block per market segment, one row per year with twelve month
cells.  Cells carry deterministic dirt (decimal commas with a space as
thousands mark, brackets, footnote marks, ellipses, blank cells) and the
sheets carry a title row above the first block, a blank row after each
title, a malformed year and a repeated year row, so every branch of the
normaliser (``panelcast.operators.grid``) is exercised by real data.

Row numbers follow a rule, not a global sort: block b of a sheet starts at
1000*b, so no window needs a total order over all rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

MONTH_COLS = [f"c{m}" for m in range(1, 13)]
GRID_COLS = ["sheet", "row_no", "c0", *MONTH_COLS]


def cell_text(v, year, month):
    """Dirty text for a revenue value; the dirt kind cycles with (12*year + month) % 6."""
    plain = F.format_string("%.2f", v)
    comma = F.regexp_replace(F.regexp_replace(plain, r"\.", ","), r"^(-?[0-9]+)([0-9]{3}),", "$1 $2,")
    kind = (year * 12 + month) % 6
    return (F.when(kind == 0, plain)
            .when(kind == 1, comma)
            .when(kind == 2, F.concat(comma, F.lit(" 1)")))
            .when(kind == 3, F.concat(F.lit("("), plain, F.lit(")")))
            .when(kind == 4, F.lit("…"))
            .otherwise(F.concat(F.lit(" "), plain, F.lit(" "))))


def report_grid(om: DataFrame) -> DataFrame:
    """The grid of a monthly order aggregate (``PanelBuild.order_months``: one row per entity and month)."""
    parts = F.split(F.col("entity"), r"\|")
    cells = om.select(
        F.concat(F.lit("region_"), parts.getItem(0)).alias("sheet"),
        parts.getItem(1).alias("segment"),
        F.year("date").alias("year"), F.month("date").alias("month"),
        cell_text(F.col("rev_c").cast("double") / 100, F.year("date"), F.month("date")).alias("text"),
    )
    years = (cells.groupBy("sheet", "segment", "year").pivot("month", list(range(1, 13))).agg(F.max("text"))
             .withColumnsRenamed({str(m): f"c{m}" for m in range(1, 13)}))
    blocks = years.select("sheet", "segment").distinct().withColumn(
        "block", F.dense_rank().over(Window.partitionBy("sheet").orderBy("segment")))
    span = years.groupBy("sheet", "segment").agg(F.min("year").alias("y0"), F.max("year").alias("y1"))
    yb = years.join(blocks, ["sheet", "segment"]).join(span, ["sheet", "segment"])
    base = F.col("block") * 1000
    nulls = [F.lit(None).cast("string").alias(c) for c in MONTH_COLS]
    year_rows = yb.select("sheet", (base + 10 + F.col("year") - 1990).alias("row_no"),
                          F.col("year").cast("string").alias("c0"), *MONTH_COLS)
    bad_year = yb.filter(F.col("year") == F.col("y0")).select(
        "sheet", (base + 900).alias("row_no"), F.concat(F.col("year").cast("string"), F.lit("*")).alias("c0"), *MONTH_COLS)
    repeated = yb.filter(F.col("year") == F.col("y1")).select(
        "sheet", (base + 950).alias("row_no"), F.col("year").cast("string").alias("c0"), *MONTH_COLS)
    headers = blocks.select("sheet", base.alias("row_no"), F.concat(F.lit("  "), F.col("segment"), F.lit(" ")).alias("c0"), *nulls)
    blanks = blocks.select("sheet", (base + 1).alias("row_no"), F.lit(None).cast("string").alias("c0"), *nulls)
    titles = blocks.filter(F.col("block") == 1).select(
        "sheet", F.lit(0).alias("row_no"), F.lit("Monthly revenue by segment").alias("c0"),
        F.lit("source: orders").alias("c1"), *nulls[1:])
    out = year_rows.unionByName(bad_year).unionByName(repeated).unionByName(headers).unionByName(blanks).unionByName(titles)
    return out.select("sheet", F.col("row_no").cast("int").alias("row_no"), "c0", *MONTH_COLS)
