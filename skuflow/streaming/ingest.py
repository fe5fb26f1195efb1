"""File-drop ingest with Structured Streaming.

Each report kind is a file stream over the input folder filtered by its name
prefix, read with an explicit all-string schema (streams cannot infer one). Rows
are landed unchanged into a parquet table partitioned by source and report
date (taken from the file name), one table and checkpoint per source, with the file name kept for lineage. The file
sink plus the checkpoint make the landing exactly-once: a restarted or re-run
query only picks up files it has not committed, and a lost executor only
re-runs its tasks. Reports then read the newest date partition per source with
partition pruning and run the usual channel builders on it.
"""

from __future__ import annotations

import os
from typing import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from skuflow.functions.dates import date_from_name


def _schema(columns: Sequence[str]) -> str:
    return ", ".join(f"`{c}` string" for c in columns)


def _target(landed_path: str, source: str) -> tuple[str, str]:
    """The source's own table and its checkpoint: one commit log and one checkpoint each, kept
    together, so that sources and restarts cannot take each other's batches for their own."""
    return os.path.join(landed_path, f"source={source}"), os.path.join(landed_path, "_checkpoints", source)


def ingest_reports(spark: SparkSession, input_dir: str, source: str, prefix: str, columns: Sequence[str],
                   landed_path: str, sep: str = ",", ext: str = ".csv",
                   available_now: bool = True) -> StreamingQuery:
    """Start (and with ``available_now`` drain) the landing stream for one source."""
    target, ckpt = _target(landed_path, source)
    raw = (spark.readStream.schema(_schema(columns))
           .option("header", True).option("sep", sep).option("escape", '"')
           .option("pathGlobFilter", f"{prefix}*{ext}")
           .csv(input_dir))
    name = F.col("_metadata.file_name")
    landed = raw.select(*[F.col(f"`{c}`") for c in columns],
                        date_from_name(name, prefix, ext).alias("report_date"),
                        name.alias("file_name"))
    writer = (landed.where(F.col("report_date").isNotNull())
              .writeStream.format("parquet").option("checkpointLocation", ckpt)
              .partitionBy("report_date").outputMode("append"))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start(target)


def ingest_payloads(spark: SparkSession, input_dir: str, source: str, prefix: str, schema: str,
                    landed_path: str, ext: str = ".json",
                    available_now: bool = True) -> StreamingQuery:
    """Landing stream for dropped API payloads (D5–D10): one JSON document per
    file, read with the payload's explicit schema, landed with source, report
    date and file name like the report files. The flatteners in
    ``skuflow.sources.landed`` then apply to the landed rows unchanged."""
    target, ckpt = _target(landed_path, source)
    raw = (spark.readStream.schema(schema).option("multiLine", True)
           .option("pathGlobFilter", f"{prefix}*{ext}").json(input_dir))
    name = F.col("_metadata.file_name")
    landed = raw.select("*", date_from_name(name, prefix, ext).alias("report_date"),
                        name.alias("file_name"))
    writer = (landed.where(F.col("report_date").isNotNull())
              .writeStream.format("parquet").option("checkpointLocation", ckpt)
              .partitionBy("report_date").outputMode("append"))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start(target)


def latest_landed(spark: SparkSession, landed_path: str, source: str, run_date=None) -> DataFrame:
    """Rows of the newest report date of one source (the run date wins if landed).
    The date is picked by an aggregate over the partition column; the data scan is
    pruned to that one partition."""
    landed = spark.read.parquet(_target(landed_path, source)[0]).withColumn("source", F.lit(source))
    dates = landed.select("report_date").distinct()
    if run_date is not None:
        today = dates.where(F.col("report_date") == F.to_date(F.lit(str(run_date)))).limit(1).collect()
        if today:
            return landed.where(F.col("report_date") == today[0][0])
    newest = dates.agg(F.max("report_date")).first()[0]
    return landed.where(F.col("report_date") == newest) if newest is not None else landed.limit(0)
