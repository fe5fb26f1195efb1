"""Source-key -> internal-SKU mapping with bundle expansion.

A mapping dimension has the columns ``source_key string`` and ``targets
array<string>``: one target is a plain SKU, several targets are a bundle, and a
repeated target is an n-pack (each occurrence receives the full quantity).

Plan shape (A3): facts are pre-aggregated by (source key, grouping columns)
*before* the mapping join. Quantity and revenue are linear in the sums, so the
result equals expanding every raw row, but the join and the ``explode`` run on
one row per key, and the partial aggregate collapses hot keys map-side before
anything is shuffled. A shuffled join against a large mapping then moves the
aggregated rows and the mapping.

Everything a report needs — per-SKU volume, the original volume of bundle keys
(reported under the reserved SKU ``Bundles``), the volume of unmapped keys
(``SKU`` NULL) and the latest fact date — comes out of one explode and one
aggregate, so the facts are scanned and joined once per report.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BUNDLES_SKU = "Bundles"
SPLIT = "decimal(18,4)"
MONEY_SUM = "decimal(38,4)"


@dataclass
class MappedSales:
    """Result of :func:`map_sales` — lazy DataFrames over one pre-aggregate."""

    keyed: DataFrame   # source_key, *by, qty, rev, rows[, Date]
    joined: DataFrame  # keyed with targets and bundle_size, both NULL for an unmapped key
    long: DataFrame    # *by, SKU, Units, Revenue, rows[, Date]; SKU 'Bundles' = bundle volume, NULL = unmapped;
                       # ``rows`` sums to the raw fact rows per group

    @property
    def sales(self) -> DataFrame:
        """Per (``by``, SKU) expanded volume (M1 + A2)."""
        return self.long.where(F.col("SKU").isNotNull() & (F.col("SKU") != BUNDLES_SKU))

    @property
    def bundles(self) -> DataFrame:
        """Original (unexpanded) volume of bundle keys (M4/A5)."""
        return self.long.where(F.col("SKU") == BUNDLES_SKU).drop("SKU")


def pre_aggregate(facts: DataFrame, key: str, qty: str, rev: str, by: Sequence[str] = (),
                  date_col: str | None = None) -> DataFrame:
    """A3 step 1: one row per (key, *by) with summed quantity and revenue.

    String keys are trimmed and blank / ``nan`` keys dropped without alert
    (P11); NULL keys are dropped as the reference's group-by does (A1). Keys of
    another type are grouped in their native type (cheaper to hash than text)
    and are cast to string only on the aggregated rows.
    """
    is_text = dict(facts.dtypes)[key] == "string"
    k = F.trim(F.col(key)) if is_text else F.col(key)
    keep = F.col("_k").isNotNull()
    if is_text:
        keep = keep & (F.col("_k") != "") & (F.lower("_k") != "nan")
    extra = [F.col(date_col).alias("_d")] if date_col else []
    aggs = [F.sum("_q").alias("qty"), F.sum("_r").alias("rev"), F.count(F.lit(1)).alias("rows")]
    if date_col:
        aggs.append(F.max("_d").alias("Date"))
    out = (facts
           .select(k.alias("_k"), *[F.col(b) for b in by], *extra,
                   F.coalesce(F.col(qty), F.lit(0)).alias("_q"), F.coalesce(F.col(rev), F.lit(0)).alias("_r"))
           .where(keep)
           .groupBy("_k", *by)
           .agg(*aggs))
    return out.withColumnRenamed("_k", "source_key")


def join_mapping(keyed: DataFrame, mapping: DataFrame, how: str = "inner", keys: Sequence[str] = (),
                 carry: Sequence[str] = ()) -> DataFrame:
    """Join pre-aggregated facts to the mapping dim, adding ``bundle_size`` (M2).

    ``keys``: extra join columns the mapping shares with the facts; ``carry``:
    extra mapping columns to keep (e.g. a methodology label when several
    mappings are applied to one pre-aggregate). When the
    fact key is not text but the mapping key is, the (aggregated) fact key is
    cast, never the other way round.
    """
    m = mapping.select("source_key", *keys, *carry, "targets", F.size("targets").alias("bundle_size"))
    kt, mt = dict(keyed.dtypes)["source_key"], dict(m.dtypes)["source_key"]
    if kt != mt:
        keyed = keyed.withColumn("source_key", F.col("source_key").cast(mt))
    return keyed.join(m, ["source_key", *keys], how)


def split_revenue(rev, size) -> F.Column:
    """revenue / bundle size in decimal, fixed to 4 decimals so sums are exact afterwards."""
    return (F.col(rev).cast("decimal(38,6)") / F.col(size)).cast(MONEY_SUM)


def _items() -> F.Column:
    """Per pre-aggregated key: its targets with split revenue, plus one ``Bundles``
    item with the original volume when the key is a bundle, or one NULL-SKU item
    when the key is unmapped."""
    split = split_revenue("rev", "bundle_size").cast(MONEY_SUM)
    per_target = F.transform("targets", lambda t: F.struct(t.alias("SKU"), split.alias("Revenue")))
    bundle = F.when(F.col("bundle_size") > 1,
                    F.array(F.struct(F.lit(BUNDLES_SKU).alias("SKU"), F.col("rev").cast(MONEY_SUM).alias("Revenue"))))
    unmapped = F.array(F.struct(F.lit(None).cast("string").alias("SKU"), F.col("rev").cast(MONEY_SUM).alias("Revenue")))
    empty = F.array().cast(f"array<struct<SKU:string,Revenue:{MONEY_SUM}>>")
    return F.when(F.col("targets").isNull(), unmapped).otherwise(F.concat(per_target, F.coalesce(bundle, empty)))


def map_sales(facts: DataFrame, mapping: DataFrame, key: str, qty: str, rev: str,
              by: Sequence[str] = (), date_col: str | None = None, mapping_keys: Sequence[str] = ()) -> MappedSales:
    """A3 end to end: pre-aggregate -> map/expand -> one aggregate by (``by``, SKU).

    ``mapping_keys`` (a subset of ``by``) are matched against columns of the
    mapping too, so several mappings can be applied in a single pass."""
    keyed = pre_aggregate(facts, key, qty, rev, by, date_col)
    joined = join_mapping(keyed, mapping, "left", mapping_keys)
    return MappedSales(keyed=keyed, joined=joined, long=expand_long(joined, by, bool(date_col)))


def expand_long(joined: DataFrame, by: Sequence[str] = (), dated: bool = False) -> DataFrame:
    """M1 + M4 + A2 on joined pre-aggregates (qty, rev, rows, targets,
    bundle_size[, Date]): one explode of targets / bundle / unmapped items and
    one aggregate by (``by``, SKU)."""
    extra = ["Date"] if dated else []
    # raw row counts are attributed to the first item of each key only, so that
    # summing ``rows`` over a group gives its analyzed rows (Q5)
    items = (joined.select(*by, *extra, "qty", "rows", F.posexplode(_items()).alias("_pos", "_i"))
             .withColumn("rows", F.when(F.col("_pos") == 0, F.col("rows")).otherwise(F.lit(0).cast("long"))))
    aggs = [F.sum("qty").alias("Units"), F.sum("_i.Revenue").alias("Revenue"), F.sum("rows").alias("rows")]
    if dated:
        aggs.append(F.max("Date").alias("Date"))
    return items.groupBy(*by, F.col("_i.SKU").alias("SKU")).agg(*aggs)


def unmapped_keys(keyed: DataFrame, mapping: DataFrame) -> DataFrame:
    """Non-blank source keys that the mapping does not know, with their volume."""
    mt = dict(mapping.dtypes)["source_key"]
    k = keyed.withColumn("source_key", F.col("source_key").cast(mt))
    return (k.join(mapping.select("source_key"), "source_key", "left_anti")
            .withColumn("source_key", F.col("source_key").cast("string"))
            .withColumnRenamed("qty", "Units").withColumnRenamed("rev", "Revenue"))


def unmapped_of(joined: DataFrame) -> DataFrame:
    """M3 from joined pre-aggregates: the keys without a target list, with their volume."""
    return joined.where(F.col("targets").isNull()).select(
        F.col("source_key").cast("string").alias("source_key"), F.col("qty").alias("Units"), F.col("rev").alias("Revenue"), "rows")


def normalize_amazon_skus(df: DataFrame, key: str, allowed: DataFrame, metrics: dict,
                          uncast: bool = False) -> DataFrame:
    """M5: keep rows whose raw key is in the allowed list (exact, before stripping),
    strip one trailing ``s``, and sum collisions.

    ``metrics`` maps output name -> source column or list of columns (row-wise
    summed, missing = 0, A4). ``allowed`` has one column ``SKU``. ``uncast`` keeps fractions of a unit.
    """
    from skuflow.functions import row_sum, strip_trailing_s, to_number

    kept = df.join(allowed.select(F.col("SKU").alias("_allowed")),
                   F.col(key).cast("string") == F.col("_allowed"), "left_semi")
    cols = []
    for name, src in metrics.items():
        srcs = src if isinstance(src, (list, tuple)) else [src]
        cols.append(row_sum(*[to_number(s) for s in srcs]).alias(name))
    return (kept.select(strip_trailing_s(F.col(key).cast("string")).alias("SKU"), *cols)
            .groupBy("SKU").agg(*[F.sum(n).cast("double" if uncast else "long").alias(n) for n in metrics]))
