"""Run history and snapshot history.

Snapshots are daily inventory reports. Combining them (H1) is a union of
normalized frames; the summary log (H2/H3) is a table with one row per pipeline and
report date; anomaly flags, the idempotency guard and trends (D1–D3) are windows and
anti joins over those tables. Windows are partitioned by pipeline or by
(SKU, Channel): each partition holds one row per run date, never fact rows.
"""

from __future__ import annotations

import logging
import re
from functools import reduce
from typing import Iterable, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skuflow.functions.dates import date_from_name
from skuflow.functions.ids import row_id, sku_channel_id
from skuflow.sinks.staging import Staged, path_exists
from skuflow.sources.discovery import list_files, parse_names

log = logging.getLogger(__name__)

# Legacy snapshot headers and the names they now have.
LEGACY_HEADERS = {
    "Units Sold": "Units",
    "Last Updated": "Date",
    "units_sold": "Units",
    "last_updated": "Date",
    "inventory": "Inventory",
    "inbound": "Inbound",
    "sku": "SKU",
    "channel": "Channel",
    "id": "old_id",
}
SNAPSHOT_REQUIRED = ["SKU", "Channel", "Units", "Inventory", "Inbound"]
SNAPSHOT_COLUMNS = ["id", "sku_channel_id", "Date", "SKU", "Channel", "Units", "Inventory", "Inbound"]
LOG_SCHEMA = ("timestamp string, pipeline string, report_date date, total_records long, total_units long, "
              "total_revenue double, source_files string")
LOG_KEYS = ("pipeline", "report_date")


def normalize_snapshot(df: DataFrame, report_date, normalize_ids: bool = False) -> DataFrame | None:
    """H1 per snapshot: legacy headers renamed, ``Date`` := the snapshot's report
    date (a literal or a column), ids regenerated from that date (spaces kept
    unless ``normalize_ids``), metrics NULL -> 0 and integral. Returns None when a
    required column is missing (the snapshot is skipped)."""
    renamed = df.withColumnsRenamed({k: v for k, v in LEGACY_HEADERS.items() if k in df.columns})
    if any(c not in renamed.columns for c in SNAPSHOT_REQUIRED):
        return None
    day = report_date if not isinstance(report_date, str) else F.to_date(F.lit(report_date))
    out = renamed.withColumn("Date", day)
    out = out.withColumns({
        "SKU": F.col("SKU").cast("string"), "Channel": F.col("Channel").cast("string"),
        **{m: F.coalesce(F.col(m).cast("double"), F.lit(0.0)).cast("long") for m in ["Units", "Inventory", "Inbound"]},
    })
    out = out.withColumns({"id": row_id("Date", "Channel", "SKU", normalize_ids),
                           "sku_channel_id": sku_channel_id("Channel", "SKU", normalize_ids)})
    return out.select(*SNAPSHOT_COLUMNS)


def combine_snapshots(frames: Iterable[DataFrame]) -> DataFrame:
    """Union of normalized snapshots (sort only at the sink: Date, Channel, SKU)."""
    return reduce(lambda a, b: a.unionByName(b), list(frames))


def run_summary(report: DataFrame, pipeline: str, source_files: Sequence[str], timestamp=None,
                exclude_bundles: bool = False) -> DataFrame:
    """H2: one row — latest report date, record count, total units, total revenue
    (cents, sales only; NULL for inventory), the input file list and the run
    timestamp (a parameter so reruns are reproducible). Bundles rows double-count
    component volume by design (L6); ``exclude_bundles`` leaves them out."""
    r = report.where(F.col("SKU") != "Bundles") if exclude_bundles else report
    revenue = (F.bround(F.sum(F.col("Revenue").cast("decimal(38,2)")), 2).cast("double")
               if pipeline == "sales" and "Revenue" in report.columns else F.lit(None).cast("double"))
    ts = (F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss") if timestamp is None
          else F.lit(str(timestamp)))
    return r.agg(
        ts.alias("timestamp"),
        F.lit(pipeline).alias("pipeline"),
        F.max("Date").alias("report_date"),
        F.count(F.lit(1)).cast("long").alias("total_records"),
        F.coalesce(F.sum("Units"), F.lit(0)).cast("long").alias("total_units"),
        revenue.alias("total_revenue"),
        F.lit(", ".join(source_files)).alias("source_files"),
    ).where(F.col("total_records") > 0)


def upsert_run_log(summary: DataFrame, path: str) -> None:
    """The run log holds one row per (pipeline, report_date).

    The key is the partition, and only the partitions of ``summary`` are overwritten, so a rerun
    replaces its own row and no other run's; nothing is read back to do so.
    """
    (summary.select(*_log_columns()).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*LOG_KEYS).parquet(path))


def _log_columns() -> list[str]:
    return [field.split(" ")[0] for field in LOG_SCHEMA.split(", ")]


def read_run_log(spark, path: str) -> DataFrame:
    """The run log, empty before the first run."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], LOG_SCHEMA)
    return spark.read.schema(LOG_SCHEMA).parquet(path).select(*_log_columns())


def read_json_log(spark, path: str) -> tuple[DataFrame, DataFrame]:
    """(runs, malformed lines as ``raw``) of a JSON log; both empty before the first run.

    A line that does not parse, or that lacks a key, is malformed.
    """
    if not path_exists(spark, path):
        return spark.createDataFrame([], LOG_SCHEMA), spark.createDataFrame([], "raw string")
    lines = spark.read.text(path).where(F.trim("value") != "")
    doc = F.from_json("value", LOG_SCHEMA + ", _corrupt string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"})
    parsed = lines.select("value", doc.alias("d"))
    bad = F.col("d._corrupt").isNotNull() | F.col("d.pipeline").isNull() | F.col("d.report_date").isNull()
    return parsed.where(~bad).select("d.*").drop("_corrupt"), parsed.where(bad).select(F.col("value").alias("raw"))


def upsert_json_log(summary: DataFrame, path: str, quarantine: str) -> int:
    """Rewrite the JSON log with this run in place of its key's; returns the number of malformed lines.

    A log with a malformed line starts fresh with this run alone, and those lines are appended to
    ``quarantine``. The log has one row a run, and is staged before its folder is overwritten.
    """
    spark = summary.sparkSession
    runs, bad = read_json_log(spark, path)
    kept = Staged(bad.withColumn("path", F.lit(path)), "log-quarantine", {"n": F.count(F.lit(1))})
    n = kept.metrics["n"] or 0
    if n:
        kept.table.write.mode("append").parquet(quarantine)
        log.warning("%s: %d malformed line(s), starting fresh", path, n)
        runs = runs.limit(0)
    new = summary.select(*_log_columns())
    rows = Staged(not_yet_logged(runs, new).unionByName(new), "log-rows")
    rows.table.write.mode("overwrite").option("ignoreNullFields", False).option("dateFormat", "yyyy-MM-dd").json(path)
    rows.drop()
    kept.drop()
    return n


def anomaly_flags(history: DataFrame, value: str = "total_units", by: Sequence[str] = ("pipeline",),
                  order: str = "report_date", runs: int = 7, threshold: float = 0.5) -> DataFrame:
    """Compare each run with the mean of the previous ``runs`` runs of the
    same pipeline; flag when it deviates by more than ``threshold`` × baseline.
    The baseline is summed in the value's own type (exact for decimals) and
    divided once."""
    w = Window.partitionBy(*by).orderBy(order).rowsBetween(-runs, -1)
    v = F.col(value)
    n = F.count(v).over(w)
    base = F.when(n > 0, F.sum(v).over(w).cast("double") / n)
    dev = F.abs(v.cast("double") - F.col("baseline"))
    return (history.withColumn("baseline", base)
            .withColumn("is_anomaly", F.coalesce(dev > F.lit(threshold) * F.col("baseline"), F.lit(False))))


def not_yet_logged(incoming: DataFrame, log: DataFrame, keys: Sequence[str] = ("pipeline", "report_date")) -> DataFrame:
    """Keep only (pipeline, report_date) runs the log does not have yet. The
    log side is de-duplicated first (partial aggregation collapses repeated keys
    map-side), so a key logged many times cannot skew the anti join."""
    return incoming.join(log.select(*keys).distinct(), list(keys), "left_anti")


def trend(history: DataFrame, metric: str = "Units", keys: Sequence[str] = ("SKU", "Channel"),
          order: str = "Date") -> DataFrame:
    """Previous value and change per key across snapshot dates."""
    w = Window.partitionBy(*keys).orderBy(order)
    return (history.withColumn(f"prev_{metric}", F.lag(metric).over(w))
            .withColumn(f"delta_{metric}", F.col(metric) - F.col(f"prev_{metric}")))


SNAPSHOT_PREFIX = "inventory_report_"


def list_snapshots(spark, directory: str, prefix: str = SNAPSHOT_PREFIX) -> DataFrame:
    """(name, path, report_date) of the snapshots of a folder, by their names alone."""
    found = list_files(spark, directory, f"{prefix}*.csv", folders=True)
    return parse_names(found, [prefix], (".csv",)).select("name", "path", "report_date")


def read_snapshots(spark, directory: str, prefix: str = SNAPSHOT_PREFIX, normalize_ids: bool = False,
                   files: DataFrame | None = None) -> DataFrame | None:
    """S10 + H1: snapshots ``<prefix>YYYY-MM-DD.csv``, all of a folder or the listed ``files``, combined.

    A snapshot is a file, or the folder of numbered files that an export writes under that name.

    Snapshots written over the years carry different headers, and one CSV scan
    over mixed headers silently misaligns columns, so files are grouped by their
    header line first. The header of every file comes from one text scan that
    keeps only the first line of each file (byte offset 0 of its first split);
    each header group is then one CSV scan, normalized (legacy names, date from
    the file name, ids) and unioned. Files missing a required column are skipped.
    """
    names = list_snapshots(spark, directory, prefix) if files is None else files
    paths = [r.path for r in names.select("path").collect()]          # listing metadata: one row per file
    if not paths:
        return None
    # file paths of the metadata are URLs
    decoded = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    snapshot = F.regexp_extract(decoded, rf"(?i)/({re.escape(prefix)}[0-9-]+\.csv)(?:/[^/]*)?$", 1)
    first_lines = (spark.read.text(paths)
                   .select(snapshot.alias("name"), F.col("_metadata.file_block_start").alias("b"),
                           F.monotonically_increasing_id().alias("i"), "value"))
    # first line of each snapshot: the minimum row id within a split that starts at byte 0
    heads = (first_lines.where(F.col("b") == 0)
             .groupBy("name").agg(F.min_by("value", "i").alias("header"))
             .join(names, "name"))
    groups = {}
    for r in heads.collect():                       # one row per snapshot: listing metadata only
        groups.setdefault(r.header.lstrip("\ufeff"), []).append(r.path)
    frames = []
    for found in groups.values():
        df = (spark.read.option("header", True).option("escape", '"').csv(found)
              .withColumn("_day", date_from_name(snapshot, prefix, ".csv")))
        norm = normalize_snapshot(df, F.col("_day"), normalize_ids)
        if norm is not None:
            frames.append(norm)
    return combine_snapshots(frames) if frames else None


def update_history(spark, directory: str, table: str, prefix: str = SNAPSHOT_PREFIX, normalize_ids: bool = False,
                   again: Sequence[str] = ()) -> list[str]:
    """S10 + H1, incremental: bring the history table up to the folder; returns the dates that were read.

    The table is partitioned by report date, and its folder names say which dates it has, so only
    snapshots of other dates (and of the dates ``again``) are opened. Their partitions are
    overwritten, which makes a rerun of the same day harmless.
    """
    names = list_snapshots(spark, directory, prefix)
    held = [name.split("=", 1)[1] for name in _partitions(spark, table)]
    fresh = names.where(~F.col("report_date").cast("string").isin(sorted(set(held) - set(map(str, again)))))
    fresh = fresh.groupBy("report_date").agg(F.min(F.struct("name", "path")).alias("f")).select("report_date", "f.*")
    new = read_snapshots(spark, directory, prefix, normalize_ids, fresh)
    if new is None:
        return []
    staged = Staged(new.withColumn("report_date", F.col("Date")), "history")
    (staged.table.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("report_date").parquet(table))
    days = [str(r.report_date) for r in staged.table.select("report_date").distinct().orderBy("report_date").collect()]
    staged.drop()
    return days


def _partitions(spark, table: str) -> list[str]:
    if not path_exists(spark, table):
        return []
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(table)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return [s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory() and "=" in s.getPath().getName()]


def read_history(spark, table: str) -> DataFrame:
    """The combined history that ``update_history`` keeps (sorted only by an ordered export)."""
    return spark.read.parquet(table).select(*SNAPSHOT_COLUMNS)
