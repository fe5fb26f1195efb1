"""The channel × SKU report grid and what happens on it.

The grid is bounded by configuration: the SKU dimension times the configured
channel list. It is generated by exploding the literal channel list over the SKU
dimension — there is no join to build it and its size is exactly the report
size. Facts reach the grid already aggregated to one row per (Channel, SKU), so
the join below is report-sized, never fact-sized.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skuflow.functions.ids import row_id, sku_channel_id
from skuflow.operators.mapping import BUNDLES_SKU


def _channel_array(channels: Sequence[str]) -> Column:
    return F.array(*[F.struct(F.lit(i).alias("channel_rank"), F.lit(c).alias("Channel"))
                     for i, c in enumerate(channels)])


def grid(sku_dim: DataFrame, channels: Sequence[str], with_bundles: bool = False) -> DataFrame:
    """J8 (+ R3): every configured channel × every SKU (and one ``Bundles`` row per
    channel). ``sku_dim`` has ``SKU`` and optionally ``sku_rank``.
    Output: Channel, channel_rank, SKU, sku_rank."""
    rank = F.col("sku_rank").cast("int") if "sku_rank" in sku_dim.columns else F.lit(None).cast("int")
    skus = sku_dim.select(F.col("SKU").cast("string").alias("SKU"), rank.alias("sku_rank"))
    if with_bundles:
        bundles = skus.sparkSession.range(1).select(F.lit(BUNDLES_SKU).alias("SKU"), F.lit(-1).alias("sku_rank"))
        skus = bundles.unionByName(skus)
    return (skus.select("SKU", "sku_rank", F.explode(_channel_array(channels)).alias("_ch"))
            .select("_ch.Channel", "_ch.channel_rank", "SKU", "sku_rank"))


def channel_dates(facts: DataFrame, channels: Sequence[str], date_col: str = "Date") -> DataFrame:
    """One report date per configured channel (max, never the order-dependent
    ``first``). At most ``len(channels)`` rows."""
    return (facts.where(F.col("Channel").isin(list(channels)))
            .groupBy("Channel").agg(F.max(date_col).alias("Date")))


def onto_grid(g: DataFrame, facts: DataFrame, metrics: Sequence[str], run_date,
              channels: Sequence[str]) -> DataFrame:
    """J4 + P14 + A7: place aggregated facts on the grid, fill missing metrics with 0,
    and date every row with its channel's latest fact date (run date if the
    channel has no mapped facts).

    ``facts``: Channel, SKU, Date, *metrics — one row per (Channel, SKU). Facts
    outside the grid (SKUs unknown to the catalog) still date their channel and
    then drop out (L8); unmapped volume (NULL SKU) does not date a channel, as
    in the reference, where unmapped keys expand to no row.

    A channel's date is an aggregate of its own with one row per configured
    channel, so no task holds a whole catalog. Both it and the grid join read
    all columns of ``facts``, so Spark sees one subplan and runs it once.
    """
    f = (facts.where(F.col("Channel").isin(list(channels)) & F.col("SKU").isNotNull())
         .select("Channel", "SKU", "Date", *metrics))
    dated = f.groupBy("Channel").agg(F.max(F.struct("Date", *metrics))["Date"].alias("_date"))
    run = F.to_date(F.lit(str(run_date)))
    day = F.coalesce(F.greatest("_date", "Date"), run)   # _date is the greater; naming both keeps the subplans alike
    return (g.join(f, ["Channel", "SKU"], "left")
            .join(F.broadcast(dated), "Channel", "left")
            .select(*g.columns, day.alias("Date"), *[F.coalesce(F.col(m), F.lit(0)).alias(m) for m in metrics]))


def clip_negatives(df: DataFrame, metrics: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(clipped frame, offenders) — offenders are long-form
    (Channel, SKU, metric, value) rows for every metric below 0."""
    offenders = (df.select("Channel", "SKU", F.explode(F.array(*[
        F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value")) for m in metrics])).alias("_m"))
        .select("Channel", "SKU", "_m.metric", "_m.value")
        .where(F.col("value") < 0))
    clipped = df.withColumns({m: F.greatest(F.col(m), F.lit(0).cast(df.schema[m].dataType)) for m in metrics})
    return clipped, offenders


def with_ids(df: DataFrame, run_date, underscore: bool = True) -> DataFrame:
    """``id = runYYYYMMDD_Channel_SKU`` and ``sku_channel_id = Channel_SKU``."""
    run = F.to_date(F.lit(str(run_date)))
    return df.withColumns({"id": row_id(run, "Channel", "SKU", underscore),
                           "sku_channel_id": sku_channel_id("Channel", "SKU", underscore)})
