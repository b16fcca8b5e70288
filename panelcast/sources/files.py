"""The user's own data as panels (S1-S4, S8): flat monthly and quarterly files, and report grids.

Files are wide, as statistical offices hand them out: a date column, optionally an entity column, and one column
per series.  Every reader takes an explicit schema (the date column and the series' names), so no file is
scanned to infer one, and returns the long panel that the feature build uses.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelcast.functions.columns import nan_to_null
from panelcast.operators.calendar import add_months
from panelcast.operators.features import PanelBuild, _memo
from panelcast.operators.series import chain_index
from panelcast.params import Params
from panelcast.sources.adapters import month_spine
from panelcast.sources.report_grid import GRID_COLS

ONE = "all"  # the entity of files without an entity column


def _wide(spark: SparkSession, path: str, date: str, series: Sequence[str], entity: str | None, fmt: str,
          date_format: str, header: bool) -> DataFrame:
    if fmt == "csv":
        cols = [f"`{date}` string", *([f"`{entity}` string"] if entity else []), *(f"`{s}` double" for s in series)]
        # columns are matched by position, as CSV has no types: the schema lists them in file order
        df = spark.read.schema(", ".join(cols)).option("header", header).option("enforceSchema", False).csv(path)
        when = F.to_date(F.col(date), date_format)
    elif fmt == "parquet":
        df = spark.read.parquet(path)
        when = F.col(date).cast("date")
    else:
        raise ValueError(f"format must be csv or parquet, not {fmt!r}")
    who = F.col(entity).cast("string") if entity else F.lit(ONE)
    return df.select(who.alias("entity"), when.alias("date"), *(nan_to_null(F.col(s).cast("double")).alias(s) for s in series))


def read_monthly(spark: SparkSession, path: str, series: Sequence[str], date: str = "date", entity: str | None = None,
                 fmt: str = "csv", date_format: str = "yyyy-MM-dd", header: bool = True) -> DataFrame:
    """A wide monthly file -> ``(entity, indicator, date, value)``, dates at month start."""
    w = _wide(spark, path, date, series, entity, fmt, date_format, header)
    return (w.withColumn("date", F.trunc("date", "month")).unpivot(["entity", "date"], list(series), "indicator", "value")
            .select("entity", "indicator", "date", "value"))


def read_quarterly(spark: SparkSession, path: str, targets: Sequence[str], date: str = "date", entity: str | None = None,
                   fmt: str = "csv", date_format: str = "yyyy-MM-dd", header: bool = True) -> DataFrame:
    """A wide quarterly file -> ``(entity, target, date, level)``, dates at quarter start."""
    w = _wide(spark, path, date, targets, entity, fmt, date_format, header)
    return (w.withColumn("date", F.trunc("date", "quarter")).unpivot(["entity", "date"], list(targets), "target", "level")
            .select("entity", "target", "date", "level"))


def read_grid(spark: SparkSession, path: str) -> DataFrame:
    """Report sheets saved as text cells ``(sheet, row_no, c0..c12)`` in CSV, for ``panelcast.operators.grid``."""
    kinds = ", ".join(f"`{c}` {'int' if c == 'row_no' else 'string'}" for c in GRID_COLS)
    return spark.read.schema(kinds).option("header", True).option("enforceSchema", False).option("multiLine", True).csv(path)


class SourcePanels(PanelBuild):
    """The feature build over given panels instead of the supplied tables.

    ``panel_m`` and the optional second source ``market_m`` are monthly, ``panel_q`` quarterly.  ``chained`` names the
    indicators that are month-on-month indices (previous month = 100); they become levels before anything is
    joined or differenced (W1).
    """

    def __init__(self, spark: SparkSession, params: Params, panel_m: DataFrame, panel_q: DataFrame,
                 market_m: DataFrame | None = None, chained: Sequence[str] = ()):
        super().__init__(spark, "", params)
        self._m, self._q, self._market, self._chained = panel_m, panel_q, market_m, list(chained)

    @cached_property
    def _month_facts(self) -> tuple[dt.date, dt.date, dt.date]:
        r = self._m.agg(F.min("date").alias("lo"), F.max("date").alias("hi")).first()
        return r["lo"], r["hi"], add_months(r["hi"], 1) - dt.timedelta(days=1)

    @cached_property
    def _line_facts(self) -> tuple[dt.date, dt.date, dt.date]:
        r = self._q.where("level IS NOT NULL").agg(F.min("date").alias("lo"), F.max("date").alias("hi")).first()
        return r["lo"], r["hi"], add_months(r["hi"], 3) - dt.timedelta(days=1)

    def _levels(self, panel: DataFrame) -> DataFrame:
        if not self._chained:
            return panel
        index = F.col("indicator").isin(self._chained)
        dense = month_spine(panel.filter(index), *self.month_bounds)
        level = chain_index(dense).select("entity", "indicator", "date", F.col("level").alias("value"))
        return panel.filter(~index).unionByName(level)

    @_memo
    def panel_m(self) -> DataFrame:
        return self._levels(self._m)

    @_memo
    def market_m(self) -> DataFrame:
        return self._levels(self._market if self._market is not None else self._m.limit(0))

    @_memo
    def panel_q(self) -> DataFrame:
        return self._q
