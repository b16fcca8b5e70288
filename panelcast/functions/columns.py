"""Column expressions shared by the operators.

Everything here returns a ``Column`` built from ``pyspark.sql.functions`` so
it stays inside whole-stage codegen; no Python runs per row.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, Window, WindowSpec
from pyspark.sql import functions as F


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_date(value: str | dt.date) -> Column:
    """Date literal (no time zone involved)."""
    if isinstance(value, dt.date):
        value = value.isoformat()
    return F.lit(value).cast("date")


def month_start(c: str | Column) -> Column:
    return F.trunc(col(c).cast("date"), "month")


def quarter_start(c: str | Column) -> Column:
    return F.trunc(col(c).cast("date"), "quarter")


def month_in_quarter(date: str | Column) -> Column:
    """1, 2 or 3: position of the month inside its calendar quarter."""
    return ((F.month(col(date)) - 1) % 3 + 1).cast("int")


def cents(amount: str | Column) -> Column:
    """Money as an exact integer number of cents (sums stay exact and fast)."""
    return round_whole(col(amount) * 100).cast("long")


def round_whole(x: str | Column) -> Column:
    """``F.round`` of a double to a whole number, half away from zero, without its decimal text per row.

    ``rint`` differs from it in ties only, and the distance to the nearest whole number is exact, so a
    tie is seen as one.  NULL, NaN and infinities stay what they are.
    """
    x = col(x).cast("double")
    r = F.rint(x)
    return F.when((x > 0) & (x - r == 0.5), r + 1).when((x < 0) & (x - r == -0.5), r - 1).otherwise(r)


def from_cents(c: str | Column) -> Column:
    return col(c).cast("double") / 100


def safe_ln(x: str | Column) -> Column:
    """Natural log defined only for positive values (NULL otherwise)."""
    x = col(x)
    return F.when(x > 0, F.ln(x))


def nan_to_null(x: str | Column) -> Column:
    """NaN is a missing value, as NULL is (Q4)."""
    x = col(x)
    return F.when(~F.isnan(x), x)


EXACT_SUM_TYPE = "decimal(38,12)"


def round_fixed(x: str | Column, digits: int = 6) -> Column:
    """Round half away from zero through ``DECIMAL(38,12)``, then back to double.

    Rounding a double directly breaks ties differently from one engine to
    the next (and a sum can land one ulp either side of ``...5``); going
    through a 12-digit decimal first makes the tie exact, so every engine
    rounds it the same way.
    """
    return F.round(col(x).try_cast(EXACT_SUM_TYPE), digits).cast("double")


def full_frame_mean(x: str | Column, w: WindowSpec, width: int) -> Column:
    """Trailing mean over ``width`` rows, NULL unless all ``width`` values exist.

    Plain ``avg`` over a ROWS frame emits means of partial frames at the start
    of a series and across gaps; the count guard keeps only full frames.
    The sum runs over ``DECIMAL(38,12)``, so it is exact and independent of
    the order in which a window implementation adds the rows; only the final
    division is floating point.
    """
    x = col(x)
    frame = w.rowsBetween(-(width - 1), Window.currentRow)
    exact = F.sum(x.cast(EXACT_SUM_TYPE)).over(frame).cast("double")
    return F.when(F.count(x).over(frame) == width, exact / width)


def running_chain(x: str | Column, w: WindowSpec) -> Column:
    """Level rebuilt from a chained index (base 100 = previous period).

    The first non-null value is kept as the base; every later non-null value
    multiplies the running level by x/100; NULL stays NULL and does not
    reset the chain.  x0 * prod(x_i/100) == 100 * prod over all of (x/100).
    """
    x = col(x)
    frame = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return F.when(x.isNotNull(), F.lit(100.0) * F.product(x / 100).over(frame))


def normal_cdf(z: str | Column) -> Column:
    """Standard normal CDF, Abramowitz & Stegun 26.2.17 (|error| < 7.5e-8)."""
    z = col(z)
    # Fixed published constants of the approximation (A&S 26.2.17).
    p = 0.2316419
    b1, b2, b3, b4, b5 = 0.319381530, -0.356563782, 1.781477937, -1.821255978, 1.330274429
    az = F.abs(z)
    t = 1 / (1 + p * az)
    poly = t * (b1 + t * (b2 + t * (b3 + t * (b4 + t * b5))))
    upper = normal_pdf(az) * poly
    return F.when(z >= 0, 1 - upper).otherwise(upper)


def normal_pdf(z: str | Column) -> Column:
    z = col(z)
    return F.exp(-0.5 * z * z) / F.sqrt(F.lit(2 * 3.141592653589793))


def crps_gaussian(y: str | Column, mu: str | Column, sigma: str | Column) -> Column:
    """Closed-form CRPS of N(mu, sigma^2) at observation y (Gneiting & Raftery 2007)."""
    y, mu, sigma = col(y), col(mu), col(sigma)
    z = (y - mu) / sigma
    return sigma * (
        z * (2 * normal_cdf(z) - 1) + 2 * normal_pdf(z) - 1 / F.sqrt(F.lit(3.141592653589793))
    )


# Report-cell cleaning -------------------------------------------------------

# The reference keeps only digits, comma, dot and minus, then
# reads the comma as the decimal point.
KEEP_NUMERIC_CHARS = r"[^0-9,.\-]"
FOOTNOTE_SUFFIX = r"\s+[0-9]{1,2}\)\s*$"
EXPONENT_NUMBER = r"^\s*-?[0-9]+([.,][0-9]+)?[eE][-+]?[0-9]+\s*$"


def clean_numeric_text(cell: str | Column, strict_reference: bool = False) -> Column:
    """Text cell -> double or NULL.

    ``strict_reference=True`` reproduces the reference cleaning exactly
    (footnote digits are glued onto the number).  The default first cuts a
    trailing footnote mark such as ``123,4 1)`` and reads exponents (``1e-05``).
    """
    c = col(cell).cast("string")
    if not strict_reference:
        c = F.regexp_replace(c, FOOTNOTE_SUFFIX, "")
    kept = F.regexp_replace(F.regexp_replace(c, KEEP_NUMERIC_CHARS, ""), ",", ".")
    # only plain decimal literals: Spark would also accept 'NaN', '1d', ...
    plain = F.when(kept.rlike(r"^-?([0-9]+\.?[0-9]*|\.[0-9]+)$"), kept.try_cast("double"))
    if strict_reference:
        return plain
    power = F.regexp_replace(F.trim(c), ",", ".").try_cast("double")
    return F.when(c.rlike(EXPONENT_NUMBER), power).otherwise(plain)
