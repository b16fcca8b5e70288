"""Calendar spines and period helpers.

Positional lags and rolling frames are only calendar-correct on a dense
series, so every panel is densified before any window runs: one row per
key and period between global bounds, missing values as NULL.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.functions.columns import to_date


def add_months(d: dt.date, n: int) -> dt.date:
    """The month start ``n`` months from a month start."""
    m = d.month - 1 + n
    return dt.date(d.year + m // 12, m % 12 + 1, 1)


def period_sequence(start: dt.date, end: dt.date, months: int = 1):
    """Array column of period starts from ``start`` to ``end`` inclusive."""
    return F.sequence(to_date(start), to_date(end), F.expr(f"INTERVAL {int(months)} MONTH"))


def spine(keys: DataFrame, start: dt.date, end: dt.date, months: int = 1, date_col: str = "date") -> DataFrame:
    """Keys x dense period range, generated per key row (no join with a calendar table)."""
    return keys.withColumn(date_col, F.explode(period_sequence(start, end, months)))


def densify(panel: DataFrame, keys: Sequence[str], value_cols: Sequence[str], start: dt.date, end: dt.date,
            months: int = 1, date_col: str = "date") -> DataFrame:
    """Left-join the panel onto its dense spine, expressed as union + one keyed aggregate.

    The result is hash-partitioned by ``keys`` only, so the window functions
    that follow (partitioned by the same keys) need no further shuffle.
    """
    keys = list(keys)
    body = panel.filter(F.col(date_col).between(to_date(start), to_date(end))).select(*keys, date_col, *value_cols)
    dense = spine(body.select(*keys).distinct(), start, end, months, date_col)
    filled = dense.select(*keys, date_col, *(F.lit(None).cast("double").alias(v) for v in value_cols))
    return (
        filled.unionByName(body)
        .repartition(*keys)
        .groupBy(*keys, date_col)
        .agg(*(F.max(v).alias(v) for v in value_cols))
    )
