"""Assembling several per-SKU measures onto a SKU template.

The reference merges measures one left join at a time. Here the measures are
folded into columns by a single ``groupBy`` (stacked projections for separate
sources, conditional projections for one source), so assembling k measures
costs one shuffle instead of k joins; the template is then one more (left)
join, on data that is already one row per key.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def assemble(template: DataFrame, measures: dict[str, DataFrame], key: str = "SKU",
             keep_unknown: bool = False) -> DataFrame:
    """Template ⟕ measure_1 ⟕ … ⟕ measure_k, missing -> 0, for measures
    that come from different sources.

    ``measures``: output column -> DataFrame(key, value), several rows per key
    allowed (summed). Each source is projected to the wide shape (its own column
    set, the others NULL), the projections are stacked and folded by
    :func:`assemble_wide`. With ``keep_unknown`` keys outside the template are
    kept too (a full outer merge, J2).
    """
    names = list(measures)
    wide = reduce(DataFrame.unionByName, [
        df.select(F.col(key).cast("string").alias(key),
                  *[(F.col("value") if n == name else F.lit(None)).alias(n) for n in names])
        for name, df in measures.items()])
    return assemble_wide(template, wide, names, key, keep_unknown)


def assemble_wide(template: DataFrame, wide: DataFrame, names, key: str = "SKU",
                  keep_unknown: bool = False) -> DataFrame:
    """Fold (key, measure columns…) rows with one group-by (sums; NULL = absent),
    then left-join them onto the template, which has one row per key. When all
    measures come from one table, this is the single-scan plan: a conditional
    projection per measure, no join per measure."""
    folded = wide.groupBy(key).agg(*[F.sum(n).alias(n) for n in names])
    if keep_unknown:
        out = folded
    else:
        t = template.select(F.col(key).alias(key)).distinct()
        out = t.join(folded, key, "left")
    return out.select(key, *[F.coalesce(F.col(n), F.lit(0)).alias(n) for n in names])


def clipped_difference(plus, minus) -> F.Column:
    """A6 + F12: ``max(0, Σplus − Σminus)`` over already summed columns."""
    p = F.coalesce(F.col(plus) if isinstance(plus, str) else plus, F.lit(0))
    m = F.coalesce(F.col(minus) if isinstance(minus, str) else minus, F.lit(0))
    return F.greatest(F.lit(0), p - m)
