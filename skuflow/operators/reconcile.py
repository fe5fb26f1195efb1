"""Source-to-source reconciliation.

Two per-SKU tables (old and new methodology) are compared per SKU, missing
sides count as 0, and the differences, totals, one-sided SKUs and a parity
verdict are derived. The comparison is a stacked conditional aggregate, which is
the full outer join of the reference without a join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def reconcile(old: DataFrame, new: DataFrame, key: str = "SKU") -> DataFrame:
    """H4: SKU, Old_Units, New_Units, Old_Rev, New_Rev, Units_Diff, Rev_Diff, in_old, in_new.

    The two sides are stacked and folded with one conditional aggregate (one
    shuffle on the key) instead of a full outer join."""
    cols = [key, "Units", "Revenue"]
    stacked = (old.select(*cols, F.lit("old").alias("method"))
               .unionByName(new.select(*cols, F.lit("new").alias("method"))))
    return reconcile_long(stacked, key)


def reconcile_long(long: DataFrame, key: str = "SKU", method: str = "method") -> DataFrame:
    """H4 from a long table (method in {'old', 'new'}, key, Units, Revenue)."""
    def side(m, c):
        return F.sum(F.when(F.col(method) == m, F.col(c)))

    def seen(m):
        return F.count(F.when(F.col(method) == m, 1)) > 0

    j = long.groupBy(key).agg(side("old", "Units").alias("Old_Units"), side("new", "Units").alias("New_Units"),
                              side("old", "Revenue").alias("Old_Rev"), side("new", "Revenue").alias("New_Rev"),
                              seen("old").alias("in_old"), seen("new").alias("in_new"))
    j = j.withColumns({c: F.coalesce(F.col(c), F.lit(0)) for c in ["Old_Units", "New_Units", "Old_Rev", "New_Rev"]})
    return j.withColumns({
        "Units_Diff": F.bround(F.col("New_Units") - F.col("Old_Units"), 0),
        "Rev_Diff": F.bround(F.col("New_Rev") - F.col("Old_Rev"), 2),
    })


def reconcile_totals(recon: DataFrame) -> DataFrame:
    """H4 summary: grand totals, SKUs only in one source, SKUs with unit differences."""
    return recon.agg(
        F.sum("Old_Units").alias("old_units"), F.sum("New_Units").alias("new_units"),
        F.sum("Old_Rev").alias("old_revenue"), F.sum("New_Rev").alias("new_revenue"),
        F.sum(F.when(F.col("in_old") & ~F.col("in_new"), 1).otherwise(0)).cast("long").alias("only_in_old"),
        F.sum(F.when(F.col("in_new") & ~F.col("in_old"), 1).otherwise(0)).cast("long").alias("only_in_new"),
        F.sum(F.when(F.col("Units_Diff") != 0, 1).otherwise(0)).cast("long").alias("units_diff_count"),
    ).withColumn("parsers_agree", F.col("units_diff_count") == 0)


def parity(recon: DataFrame, rel_tol: float = 0.01, abs_tol: float = 0.0) -> DataFrame:
    """Per SKU, is the new value within tolerance of the old one?"""
    tol = F.greatest(F.lit(float(abs_tol)), F.lit(float(rel_tol)) * F.abs(F.col("Old_Rev").cast("double")))
    return recon.withColumn("within_tolerance", F.abs(F.col("Rev_Diff").cast("double")) <= tol)


def one_sided(recon: DataFrame, key: str = "SKU") -> DataFrame:
    """H4/O3: SKUs present in only one source, as (side, SKU) rows — sorted at
    the sink, never gathered into one array."""
    return (recon.where(F.col("in_old") != F.col("in_new"))
            .select(F.when(F.col("in_old"), "old only").otherwise("new only").alias("side"), key))
