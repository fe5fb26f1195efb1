"""Published reports.

Both reports are the configured channel × SKU grid with aggregated facts placed
onto it. Inputs are one row per (Channel, SKU) per source, so every join here is
report-sized; the grid itself is a generate, not a join.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skuflow.operators.mapping import BUNDLES_SKU
from skuflow.operators.spine import clip_negatives, grid, onto_grid, with_ids

SALES_COLUMNS = ["id", "sku_channel_id", "Date", "SKU", "Channel", "Units", "Revenue"]
INVENTORY_COLUMNS = ["id", "sku_channel_id", "Date", "SKU", "Channel", "Units", "Inventory", "Inbound"]
INVENTORY_METRICS = ["Units", "Inventory", "Inbound"]
RANKS = ["channel_rank", "sku_rank"]
#: Published columns and types of each report.
PUBLISHED = {
    "sales": ("id string, sku_channel_id string, Date date, SKU string, Channel string, Units long, Revenue double"),
    "inventory": ("id string, sku_channel_id string, Date date, SKU string, Channel string, Units long, Inventory long, "
                  "Inbound long"),
}


def sales_report(long: DataFrame, sku_dim: DataFrame, channels: Sequence[str], run_date,
                 keep_ranks: bool = False) -> DataFrame:
    """R2 + R3 + R4.

    ``long``: Channel, SKU, Date, Units, Revenue — per-SKU volume plus the
    reserved ``Bundles`` SKU carrying the original bundle volume (rows with other
    SKUs, e.g. NULL for unmapped volume, only date their channel). Units are
    truncated to long; Revenue is rounded half-even to cents.
    """
    facts = long.groupBy("Channel", "SKU").agg(
        F.sum("Units").alias("Units"), F.sum("Revenue").alias("Revenue"), F.max("Date").alias("Date"))
    out = onto_grid(grid(sku_dim, channels, with_bundles=True), facts, ["Units", "Revenue"], run_date, channels)
    out = out.withColumns({
        "Units": F.col("Units").cast("long"),
        "Revenue": F.bround(F.col("Revenue").cast("decimal(38,4)"), 2).cast("double"),
    })
    out = with_ids(out, run_date)
    return out.select(*SALES_COLUMNS, *(RANKS if keep_ranks else []))


def inventory_report(facts: DataFrame, sku_dim: DataFrame, channels: Sequence[str], run_date,
                     keep_ranks: bool = False, uncast: bool = False) -> tuple[DataFrame, DataFrame]:
    """R1 + R4 + R5: (report, negative-value offenders).

    ``uncast`` keeps fractions of a unit for the contract to judge (Q3); otherwise
    metrics are truncated to whole units.

    ``facts``: Channel, SKU, Date, Units, Inventory, Inbound (one row per
    Channel × SKU from the channel builders).
    """
    agg = facts.groupBy("Channel", "SKU").agg(
        *[F.sum(m).alias(m) for m in INVENTORY_METRICS], F.max("Date").alias("Date"))
    body = onto_grid(grid(sku_dim, channels), agg, INVENTORY_METRICS, run_date, channels)
    body = body.withColumns({m: F.col(m).cast("double" if uncast else "long") for m in INVENTORY_METRICS})
    clipped, offenders = clip_negatives(body, INVENTORY_METRICS)
    out = with_ids(clipped, run_date)
    return out.select(*INVENTORY_COLUMNS, *(RANKS if keep_ranks else [])), offenders


def as_published(report: DataFrame, report_type: str) -> DataFrame:
    """The report's columns in their published types, ranks kept for ordering."""
    types = dict(field.rsplit(" ", 1) for field in PUBLISHED[report_type].split(", "))
    return report.select(*[F.col(c).cast(t).alias(c) for c, t in types.items()], *[r for r in RANKS if r in report.columns])


def wide_sales(report: DataFrame, channels: Sequence[str]) -> DataFrame:
    """One row per SKU, ``"<channel> (Units)"`` and ``"<channel> (Revenue)"``
    per configured channel (missing -> 0). Conditional sums over the fixed channel
    list instead of ``pivot``, so no distinct-values job runs first."""
    aggs = []
    for ch in channels:
        hit = F.col("Channel") == F.lit(ch)
        aggs.append(F.sum(F.when(hit, F.col("Units")).otherwise(0)).cast("long").alias(f"{ch} (Units)"))
        aggs.append(F.sum(F.when(hit, F.col("Revenue")).otherwise(0.0)).alias(f"{ch} (Revenue)"))
    return report.where(F.col("SKU") != BUNDLES_SKU).groupBy("SKU").agg(*aggs)
