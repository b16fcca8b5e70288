"""Leakage-free splits and back-test layouts.

Everything is a column or a generated row, never a driver loop over data:
the split is a ``split`` column, rolling origins and vintages are exploded
per row from arithmetic on the date (their count is fixed by parameters),
so no range join or cross join is needed.
"""

from __future__ import annotations

import dataclasses
import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelcast.functions.columns import to_date
from panelcast.operators.calendar import add_months
from panelcast.params import Params


@dataclasses.dataclass(frozen=True)
class SplitBounds:
    """test = last T quarters up to the anchor, valid = V quarters before, train = earlier."""

    anchor: dt.date
    test_len: int
    valid_len: int

    @property
    def test(self) -> tuple[dt.date, dt.date]:
        return add_months(self.anchor, -3 * (self.test_len - 1)), self.anchor

    @property
    def valid(self) -> tuple[dt.date, dt.date]:
        hi = add_months(self.anchor, -3 * self.test_len)
        return add_months(hi, -3 * (self.valid_len - 1)), hi

    @classmethod
    def of(cls, anchor: dt.date, p: Params) -> "SplitBounds":
        return cls(anchor, p.test_len, p.valid_len)


def split_column(b: SplitBounds, date_col: str = "date") -> Column:
    """'train' / 'valid' / 'test' / NULL (after the anchor) as one column, no unions."""
    d = F.col(date_col)
    (tlo, thi), (vlo, vhi) = b.test, b.valid
    return (F.when(d.between(to_date(tlo), to_date(thi)), F.lit("test"))
            .when(d.between(to_date(vlo), to_date(vhi)), F.lit("valid"))
            .when(d < to_date(vlo), F.lit("train")))


def chrono_split(df: DataFrame, b: SplitBounds, start: dt.date | None = None) -> DataFrame:
    """P9 + B3: start-year filter (sargable) then the split tag."""
    if start is not None:
        df = df.filter(F.col("date") >= to_date(start))
    return df.withColumn("split", split_column(b)).filter(F.col("split").isNotNull())


def quarters_before(anchor: dt.date, date_col: str = "date") -> Column:
    """Whole quarters between a date and the anchor (0 at the anchor)."""
    return (F.months_between(to_date(anchor), F.col(date_col)) / 3).cast("int")


def rolling_origins(dates: DataFrame, anchor: dt.date, test_len: int, horizon: int) -> DataFrame:
    """B4 + W9: T+H-1 forecast windows; window i spans quarters
    [anchor - 3(T-2+H-i) months, anchor - 3(T-1-i) months], training data is
    everything before its start.  Each date row is exploded into the windows
    that contain it (at most H), the horizon is its rank inside the window.
    """
    k = quarters_before(anchor)
    lo = F.greatest(F.lit(0), F.lit(test_len - 1) - k)
    hi = F.least(F.lit(test_len + horizon - 2), F.lit(test_len - 2 + horizon) - k)
    # sequence(lo, hi) counts down when lo > hi: dates outside every window go first
    ex = dates.filter(lo <= hi).select("date", F.explode(F.sequence(lo, hi)).alias("origin_id"))
    ex = ex.withColumn("origin", F.expr(f"add_months(DATE'{anchor.isoformat()}', -3 * ({test_len - 2 + horizon} - origin_id))"))
    ex = ex.withColumn("window_end", F.expr(f"add_months(DATE'{anchor.isoformat()}', -3 * ({test_len - 1} - origin_id))"))
    w = Window.partitionBy("origin_id").orderBy("date")
    return ex.withColumn("horizon", F.row_number().over(w))


def vintages(monthly: DataFrame, quarterly: DataFrame, q_last: dt.date, m_last: dt.date, n_vintages: int) -> tuple[DataFrame, DataFrame]:
    """Vintage tp drops the last tp+1 quarters of targets and the last 3*tp months of indicators.

    Each row is exploded into the vintages that still contain it (at most
    ``n_vintages``, a parameter), so per-vintage work is a keyed aggregate.
    """
    jm = F.months_between(to_date(m_last), F.col("date")).cast("int")
    mv = monthly.withColumn("vintage", F.explode(F.sequence(F.lit(0), F.least(F.lit(n_vintages - 1), F.floor(jm / 3).cast("int")))))
    jq = quarters_before(q_last)
    qv = quarterly.filter(jq >= 1).withColumn(
        "vintage", F.explode(F.sequence(F.lit(0), F.least(F.lit(n_vintages - 1), jq - 1))))
    return mv, qv


def ragged_edge(monthly: DataFrame, m_end: dt.date, availability: int | Column, value_col: str = "value") -> DataFrame:
    """With availability a < 3 the last 3-a months before ``m_end`` are not yet published -> NULL."""
    a = F.lit(availability) if isinstance(availability, int) else availability
    cutoff = F.add_months(to_date(m_end), a - 3)
    return monthly.withColumn(value_col, F.when(F.col("date") <= cutoff, F.col(value_col)))


def first_steps(paths: DataFrame, horizon: int, keys: tuple[str, ...] = ("entity", "target", "origin")) -> DataFrame:
    """The first ``horizon`` dates of every forecast path, numbered from 1."""
    w = Window.partitionBy(*keys).orderBy("date")
    return paths.withColumn("horizon", F.row_number().over(w)).filter(F.col("horizon") <= horizon)


def trim_to_quarter_end(monthly: DataFrame, q_last: dt.date) -> DataFrame:
    """Monthly rows up to the last month of the last quarter with targets."""
    return monthly.filter(F.col("date") <= F.add_months(to_date(q_last), 2))
