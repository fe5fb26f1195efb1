"""Sinks (S11–S15) and the publish payload.

Each report type is a table of its own, ``reports/report=<type>``, partitioned by ``run_date``
and overwritten by partition, so a rerun replaces only its own day and types never share a
schema. Rows are written in the published order (see ``ordered``) with the published columns
only. Exports are numbered files in the same order, never coalesced into a single task. The
publish payload is a JSON-Lines stream: one summary record plus data chunks of bounded size.
"""

from __future__ import annotations

import math
from typing import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skuflow.sinks.ordered import REPORT_ORDER, in_order, write_ordered


def report_path(out_dir: str, report_type: str) -> str:
    return f"{out_dir.rstrip('/')}/reports/report={report_type}"


def write_report(df: DataFrame, out_dir: str, report_type: str, run_date, columns: Sequence[str]) -> None:
    """Overwrite this run's partition of the report's own table, ordered, published columns only."""
    ranks = [c for c in REPORT_ORDER if c in df.columns]
    rows = in_order(df.withColumn("run_date", F.to_date(F.lit(str(run_date)))), ranks).select(*columns, "run_date")
    (rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("run_date").parquet(report_path(out_dir, report_type)))


def read_written(spark: SparkSession, out_dir: str, report_type: str, run_date, schema) -> DataFrame:
    """The rows that a run has published, under the run's own schema."""
    return spark.read.schema(schema).parquet(f"{report_path(out_dir, report_type)}/run_date={run_date}")


def export_csv(df: DataFrame, path: str, order_by: Sequence[str] = REPORT_ORDER, drop: Sequence[str] = ()) -> None:
    """Header CSV export in order, dates ISO."""
    write_ordered(df, path, [c for c in order_by if c in df.columns], "csv", drop)


def export_json(df: DataFrame, path: str, order_by: Sequence[str] = REPORT_ORDER, drop: Sequence[str] = ()) -> None:
    """JSON Lines in order, ISO dates."""
    write_ordered(df, path, [c for c in order_by if c in df.columns], "json", drop)


def payload_records(report: DataFrame, status: DataFrame, report_type: str, max_rows: int = 5000,
                    chunks: int | None = None) -> DataFrame:
    """``{reportType, reportSummary{channel: date}}`` followed by data chunks
    ``{reportType, chunk, chunks, reportData[rows]}``, one JSON document per row.

    Rows are spread over ``chunks`` buckets by the MD5 of the id and sorted within
    each. By default the count is derived from the report size (one small action)
    so that no chunk holds more than about ``max_rows`` rows, whatever the report
    size; a caller that knows its report size gives it instead.
    ``status``: Channel, status (ISO date or NULL). Dates are ISO strings.
    """
    if chunks is None:
        chunks = max(1, math.ceil(report.count() / max_rows))
    rows = report.select(*[F.date_format(c, "yyyy-MM-dd").alias(c) if t == "date" else F.col(c)
                           for c, t in report.dtypes])
    digits = F.substring(F.md5(F.coalesce("id", F.lit(""))), 1, 7)
    bucket = (F.conv(digits, 16, 10).cast("long") % chunks).cast("int")
    data = (rows.withColumn("_chunk", bucket)
            .groupBy("_chunk").agg(F.array_sort(F.collect_list(F.struct(*rows.columns))).alias("reportData"))
            .select(F.col("_chunk").alias("chunk"),
                    F.to_json(F.struct(F.lit(report_type).alias("reportType"), F.col("_chunk").alias("chunk"),
                                       F.lit(chunks).alias("chunks"), "reportData")).alias("payload")))
    summary = (status.agg(F.map_from_entries(F.collect_list(F.struct("Channel", "status"))).alias("m"))
               .select(F.lit(-1).alias("chunk"),
                       F.to_json(F.struct(F.lit(report_type).alias("reportType"),
                                          F.col("m").alias("reportSummary"))).alias("payload")))
    return summary.unionByName(data)
