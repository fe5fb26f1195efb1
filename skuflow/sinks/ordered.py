"""Ordered exports (O1, O3, O4, S12, S15): sorted across files without one sorting task.

``orderBy`` range-partitions the rows by a sample of the keys and sorts every range on its own, so
the files, taken by their number, hold the rows in order.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Configured channel order outer, bundles before SKUs, then configured SKU order.
REPORT_ORDER = ("channel_rank", "sku_rank", "SKU")
#: O1: combined history.
HISTORY_ORDER = ("Date", "Channel", "SKU")


def in_order(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """Rows ranged and sorted by ``order``; a missing rank comes last."""
    return df.orderBy(*[F.col(c).asc_nulls_last() for c in order])


def write_ordered(df: DataFrame, path: str, order: Sequence[str], fmt: str = "csv", drop: Sequence[str] = ()) -> None:
    """Overwrite ``path`` with numbered files in ``order``; ``drop`` leaves out columns that only sort."""
    out = in_order(df, order).drop(*drop)
    writer = out.write.mode("overwrite").option("dateFormat", "yyyy-MM-dd").format(fmt)
    (writer.option("header", True) if fmt == "csv" else writer).save(path)


def read_ordered(spark: SparkSession, path: str, schema: str, fmt: str = "csv") -> DataFrame:
    """The rows of an ordered export with ``position``, from 0, by file number and place in the file.

    A file split is read by one task from front to back, so a row's place in its split is its row id
    less the split's smallest. The window runs over one row a split, not over rows.
    """
    raw = (spark.read.schema(schema).option("header", True).format(fmt).load(path)
           .select("*", F.regexp_extract("_metadata.file_name", r"part-(\d+)", 1).cast("long").alias("_file"),
                   F.col("_metadata.file_block_start").alias("_split"), F.monotonically_increasing_id().alias("_id")))
    splits = raw.groupBy("_file", "_split").agg(F.min("_id").alias("_first"), F.count("*").alias("_n"))
    before = Window.orderBy("_file", "_split").rowsBetween(Window.unboundedPreceding, -1)
    places = splits.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    return (raw.join(F.broadcast(places), ["_file", "_split"])
            .withColumn("position", F.col("_before") + F.col("_id") - F.col("_first"))
            .drop("_file", "_split", "_id", "_first", "_n", "_before"))
