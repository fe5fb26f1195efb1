"""String predicates and cleaners."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Tokens that the reference's CSV reader treats as missing (pandas
# default NA strings). Compared after trimming, case-sensitively as pandas does.
NA_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def blank_to_null(c) -> Column:
    """Trim; blank or NA token -> NULL."""
    t = F.trim(_c(c).cast("string"))
    return F.when(t.isin(NA_TOKENS), None).otherwise(t)


def strip_trailing_s(c) -> Column:
    """drop one trailing ``s`` (``3001s`` -> ``3001``)."""
    return F.regexp_replace(_c(c), "s$", "")


def underscore_spaces(c) -> Column:
    """spaces -> underscores (id formatting)."""
    return F.replace(_c(c), F.lit(" "), F.lit("_"))


def contains_ci(c, needle: str) -> Column:
    """case-insensitive substring test on the trimmed value (NULL -> NULL)."""
    return F.lower(F.trim(_c(c))).contains(needle.lower())


def excludes_ci(c, needle: str) -> Column:
    """Keep rows whose value does not contain ``needle`` (any case); NULL is kept."""
    return ~F.coalesce(contains_ci(c, needle), F.lit(False))


def equals_ci(c, value: str) -> Column:
    """Case-insensitive equality on the trimmed value."""
    return F.lower(F.trim(_c(c))) == F.lit(value.lower())


def not_equal_keep_null(c, value) -> Column:
    """``c != value`` that keeps NULLs (plain ``<>`` would drop them)."""
    return ~_c(c).eqNullSafe(F.lit(value))
