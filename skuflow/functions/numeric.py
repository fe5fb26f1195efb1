"""Numeric cleaning: money strings, lenient numbers, clipping, rounding."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,4)"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean_money(c, on_error: str = "raise") -> Column:
    """F1: ``"$1,200.50"`` -> 1200.50 as decimal(18,4); blank/NULL -> 0.

    ``on_error="raise"`` keeps the strict behaviour (an unparseable string fails the
    job under ANSI mode); ``"null"`` turns junk into NULL so it can be counted (Q7)
    and then filled with 0 by the caller.
    """
    col = _c(c)
    stripped = F.nullif(F.trim(F.regexp_replace(col.cast("string"), r"[$,]", "")), F.lit(""))
    parsed = stripped.cast(MONEY) if on_error == "raise" else stripped.try_cast(MONEY)
    if on_error == "null":
        return parsed
    return F.coalesce(parsed, F.lit(0).cast(MONEY))


def number_or_null(c, dtype: str = "double") -> Column:
    """The number that a cell holds, else NULL.

    ``'nan'``-like tokens are treated as missing first because Spark would cast
    them to NaN rather than failing.
    """
    raw = F.trim(_c(c).cast("string"))
    raw = F.when(F.lower(raw).isin("nan", "na", "n/a", "null", "none", ""), None).otherwise(raw)
    return raw.try_cast(dtype)


def to_number(c, dtype: str = "double") -> Column:
    """lenient numeric parse, unparseable or missing -> 0 (``'1,200'`` -> 0, ``' 5 '`` -> 5)."""
    return F.coalesce(number_or_null(c, dtype), F.lit(0).cast(dtype))


def coerced(raw, parsed) -> Column:
    """Q7: 1 when a present raw value was forced to 0/NULL by F1/F2 parsing, else 0."""
    r = F.trim(_c(raw).cast("string"))
    return F.when(r.isNotNull() & (r != "") & _c(parsed).isNull(), 1).otherwise(0)


def clip_low(c, floor: float = 0) -> Column:
    """``max(c, floor)`` with NULL kept NULL."""
    col = _c(c)
    return F.when(col.isNull(), None).otherwise(F.greatest(col, F.lit(floor).cast("long")))


def round_money(c, scale: int = 2) -> Column:
    """half-even rounding (matches binary-float rounding of the reference for
    non-tie inputs, and is exact on decimals)."""
    return F.bround(_c(c), scale)


def truncate_long(c) -> Column:
    """truncating cast toward zero."""
    return _c(c).cast("long")


def row_sum(*cols) -> Column:
    """A4: row-wise sum treating missing as 0."""
    return reduce(lambda a, b: a + b, [F.coalesce(_c(c), F.lit(0)) for c in cols])
