"""File-driven report runs.

A run lists the input folder once and picks the newest file per source in one
aggregate. Each source's facts are then staged on their own: a missing column, a
malformed row or a bad cell, whenever it shows, drops that source with its reason and
no other. What is counted of a source (rows, coerced cells) is observed by that one
write; unmapped keys, SKUs found and SKUs missing come from the staged facts, which have
one row per key.

Publishing is write, audit, promote: the report is staged with the contract's violations
observed on the way, and only a report without any is written to its table, from the
staged rows. The summary is computed from the written rows and replaces the run's own row
in the log.
"""

from __future__ import annotations

import logging
import os
from dataclasses import dataclass, field
from functools import reduce
from typing import Callable, Sequence

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skuflow.operators.history import (
    not_yet_logged, read_history, read_run_log, run_summary, update_history, upsert_json_log, upsert_run_log,
)
from skuflow.operators.mapping import BUNDLES_SKU, MappedSales, expand_long, unmapped_of
from skuflow.operators.quality import Contract, ContractViolation, channel_status, missing_skus, violations
from skuflow.operators.spine import channel_dates
from skuflow.plans import channels as C
from skuflow.plans.reports import INVENTORY_METRICS, PUBLISHED, as_published, inventory_report, sales_report
from skuflow.sinks import export_csv, export_json, read_written, write_report
from skuflow.sinks.ordered import HISTORY_ORDER, write_ordered
from skuflow.sinks.staging import Staged, Watch
from skuflow.sources.config import Catalog, DuplicateKeys
from skuflow.sources.discovery import find_latest_many
from skuflow.sources.reports import MalformedReport, read_report, read_sniffed

log = logging.getLogger(__name__)

#: What makes one source unusable; anything else is a fault of the run. Failed jobs come as either of the last two.
SOURCE_FAULTS = (C.MissingColumns, MalformedReport, DuplicateKeys, PySparkException, Py4JJavaError)

# Input file prefixes of the marketplace exports.
PREFIX = {
    "fba": "FBA_report_", "awd": "AWD_report_", "tpl_levels": "Flexport_levels_",
    "tpl_orders": "Flexport_orders_", "tpl_inbound": "Flexport_inbound_",
    "wfs_inventory": "Walmart_inventory_", "fbt_inventory": "FBT_inventory_", "walmart_sales": "Walmart_sales_",
    "tiktok_orders": "TikTok_orders_", "tiktok_sales": "TikTok_sales_", "amazon_orders": "Amazon_orders_",
    "amazon_sales": "Amazon_sales_", "shopify_sales": "Shopify_sales_", "shopify_orders": "Shopify_orders_",
    "walmart_orders": "Walmart_orders_",
}
AWD_PREAMBLE_LINES = 2

def sales_contract() -> Contract:
    """Q3 for the sales report (units unconstrained in sign, integral)."""
    return Contract.of(required=["id", "sku_channel_id", "Date", "SKU", "Channel", "Units", "Revenue"],
                       integral=["Units"])


def inventory_contract() -> Contract:
    """Q3 for the inventory report (metrics integral and >= 0)."""
    return Contract.of(required=["id", "sku_channel_id", "Date", "SKU", "Channel", *INVENTORY_METRICS],
                       non_negative=INVENTORY_METRICS, integral=INVENTORY_METRICS)


def _read(spark, path):
    return read_report(spark, path)


@dataclass
class SalesSource:
    channel: str                          # stamped channel, or "Mixed" when the data carries it
    prefix: str
    build: Callable                       # (spark, raw, catalog) -> MappedSales, or long facts
    frame: str                            # its contract in channels.COLUMNS
    extensions: tuple = (".csv",)
    read: Callable = _read                # (spark, path) -> raw all-string frame
    by: tuple = ()                        # grouping columns of its mapped facts


@dataclass
class InventorySource:
    name: str
    files: dict                           # file key -> prefix
    build: Callable                       # (spark, raw frames, catalog) -> inventory facts
    frames: dict                          # file key -> contract in channels.COLUMNS
    optional: tuple = ()
    channels: tuple = ()                  # channels this source reports (status when skipped)
    skip_lines: int = 0


#: One row a source of a run.
OUTCOME = ("source string, status string, reason string, files string, report_date string, rows_analyzed long, rows_found long, "
           "coerced_cells long, coercions string, unmapped_keys long, missing_skus long")


@dataclass
class RunResult:
    report: DataFrame | None                  # uncast, with ranks
    status: DataFrame                         # Q6: one row a channel
    missing: DataFrame | None = None          # Q2: (Channel or source, SKU)
    offenders: DataFrame | None = None        # R5
    source_files: list = field(default_factory=list)
    metrics: DataFrame | None = None          # Q5: source, rows_analyzed, rows_found
    sources: DataFrame | None = None          # R6, Q5, Q7: one row a source, see OUTCOME
    unmapped: DataFrame | None = None         # M3: source, source_key, Units, Revenue, rows


class _Source:
    """One source of a run: its raw frames are watched, its facts staged."""

    def __init__(self, name: str):
        self.name, self.watches, self.staged = name, [], None

    def watch(self, raw: DataFrame, frame: str) -> DataFrame:
        w = Watch(rows=F.count(F.lit(1)), **C.coercions(frame, raw.columns))
        self.watches.append(w)
        return w.on(raw)

    def stage(self, facts: DataFrame) -> DataFrame:
        self.staged = Staged(facts, f"facts-{self.name.replace(' ', '-')}")
        return self.staged.table

    def outcome(self, files: Sequence[str], day: str, found: int, unmapped: int, missing: int) -> tuple:
        got = [w.values() for w in self.watches]
        rows = [g.pop("rows") for g in got]
        forced = {c: n for g in got for c, n in g.items() if n}
        text = ", ".join(f"{c}: {n}" for c, n in sorted(forced.items()))
        return (self.name, "loaded", None, ", ".join(files), day, None if None in rows else sum(rows), found,
                sum(forced.values()), text, unmapped, missing)


def _skipped(name: str, status: str, reason: str, files: Sequence[str] = ()) -> tuple:
    log.warning("source %s: %s (%s)", name, status, reason)
    return (name, status, reason, ", ".join(files), None, None, None, None, None, None, None)


def _reason(e: Exception) -> str:
    """The first line of the error, or of the cause at the bottom of a failed job."""
    text = str(e)
    if isinstance(e, Py4JJavaError):
        cause = e.java_exception
        while cause.getCause() is not None:
            cause = cause.getCause()
        text = str(cause.getMessage())
    lines = text.strip().splitlines()
    return (lines[0] if lines else type(e).__name__)[:300]


def _is_sku():
    return F.col("SKU").isNotNull() & (F.col("SKU") != BUNDLES_SKU)


# --- sales registry -----------------------------------------------------------------------

def _long(df: DataFrame) -> DataFrame:
    """Plain per-SKU facts (no mapping) in the long form."""
    return df.select("SKU", "Units", F.col("Revenue").cast("decimal(38,4)").alias("Revenue"),
                     F.lit(0).cast("long").alias("rows"))


def _walmart(spark, raw, cat):
    return _long(C.walmart_sales(raw))


def _amazon(spark, raw, cat):
    return C.amazon_orders(raw, cat.mapping_dim(spark, "amazon"))


def _tiktok_shop(spark, raw, cat):
    return C.tiktok_shop_orders(raw, cat.mapping_dim(spark, "tiktok"))


def _shopify(spark, raw, cat):
    return C.shopify_sales(raw, cat.mapping_dim(spark, "shopify"))


def _amazon_summary(spark, raw, cat):
    return C.amazon_sales(raw, cat.mapping_dim(spark, "amazon"))


def _tiktok_summary(spark, raw, cat):
    return C.tiktok_sales(raw, cat.mapping_dim(spark, "tiktok"))


def _read_tiktok_summary(spark, path):
    return read_sniffed(spark, path, C.TIKTOK_SALES["sku"])


def _walmart_orders(spark, raw, cat):
    return _long(C.walmart_orders(raw))


def _shopify_orders(spark, raw, cat):
    return C.shopify_orders(raw, cat.mapping_dim(spark, "shopify"))


# The summary-report sources the raw-order sources replaced (C2, C3); kept as a
# registry so the old methodology can still be run and reconciled (H4).
LEGACY_SALES_REGISTRY = [
    SalesSource("Walmart", PREFIX["walmart_sales"], _walmart, "walmart_sales"),
    SalesSource("Amazon", PREFIX["amazon_sales"], _amazon_summary, "amazon_sales"),
    SalesSource("TikTok Shop", PREFIX["tiktok_sales"], _tiktok_summary, "tiktok_sales", read=_read_tiktok_summary),
    SalesSource("Mixed", PREFIX["shopify_sales"], _shopify, "shopify_sales", by=("Channel",)),
]

# Every sales source read from raw order-level exports (C8, C5, C4, C7): the
# specified end state of the migration away from pre-aggregated summaries.
RAW_ORDERS_SALES_REGISTRY = [
    SalesSource("Walmart", PREFIX["walmart_orders"], _walmart_orders, "walmart_orders"),
    SalesSource("Amazon", PREFIX["amazon_orders"], _amazon, "amazon_orders", (".txt", ".csv")),
    SalesSource("TikTok Shop", PREFIX["tiktok_orders"], _tiktok_shop, "tiktok_shop_orders"),
    SalesSource("Mixed", PREFIX["shopify_orders"], _shopify_orders, "shopify_orders", by=("Channel",)),
]

# The registry the reference runs today.
SALES_REGISTRY = [
    SalesSource("Walmart", PREFIX["walmart_sales"], _walmart, "walmart_sales"),
    SalesSource("Amazon", PREFIX["amazon_orders"], _amazon, "amazon_orders", (".txt", ".csv")),
    SalesSource("TikTok Shop", PREFIX["tiktok_orders"], _tiktok_shop, "tiktok_shop_orders"),
    SalesSource("Mixed", PREFIX["shopify_sales"], _shopify, "shopify_sales", by=("Channel",)),
]


def sales_run(spark: SparkSession, input_dir: str, catalog: Catalog, run_date,
              registry=None) -> RunResult:
    """R2 end to end: newest file per source -> channel facts -> report grid."""
    registry = registry or SALES_REGISTRY
    latest = find_latest_many(spark, input_dir, {s.prefix: s.extensions for s in registry}, run_date)
    frames = {}
    for src in registry:
        hit = latest.get(src.prefix)
        frames[src.prefix] = hit and (lambda src=src, hit=hit: src.read(spark, hit[0]), hit[0], hit[1])
    return sales_from_frames(spark, frames, catalog, run_date, registry)


def sales_from_frames(spark: SparkSession, frames: dict, catalog: Catalog, run_date, registry) -> RunResult:
    """R2 and R6 from raw frames: ``frames`` maps a source's prefix to (frame maker, file, ISO date), or None."""
    parts, files, outcomes, unmapped, missing = [], [], [], [], []
    channels, skus = list(catalog.sales_channel_order), catalog.sku_dim(spark)
    for src in registry:
        given = frames.get(src.prefix)
        name = src.channel if src.channel != "Mixed" else src.frame
        if given is None:
            outcomes.append(_skipped(src.channel, "missing", f"no file {src.prefix}*"))
            continue
        make, path, day = given
        base = os.path.basename(path)
        source = _Source(src.channel)
        try:
            raw = make()
            C.require(raw, src.frame)
            built = src.build(spark, source.watch(raw, src.frame), catalog)
            if isinstance(built, MappedSales):
                keys = source.stage(built.joined)
                long = expand_long(keys, src.by)
                lost = unmapped_of(keys).select(F.lit(name).alias("source"), "*")
                n_lost = lost.count()
                unmapped.append(lost)
            else:
                long, n_lost = source.stage(built), 0
        except SOURCE_FAULTS as e:
            outcomes.append(_skipped(src.channel, "refused", _reason(e), [base]))
            continue
        if src.channel != "Mixed":
            long = long.withColumn("Channel", F.lit(src.channel))
        facts = long.withColumn("Date", F.to_date(F.lit(day))).select("Channel", "SKU", "Units", "Revenue", "rows", "Date")
        found = facts.where(_is_sku())
        absent = missing_skus(found, skus)
        outcomes.append(source.outcome([base], day, found.count(), n_lost, absent.count()))
        parts.append(facts)
        files.append(base)
    sources = spark.createDataFrame(outcomes, OUTCOME)
    metrics = sources.where("status = 'loaded'").select("source", "rows_analyzed", "rows_found")
    if not parts:
        empty = spark.createDataFrame([], "Channel string, Date date")
        return RunResult(None, channel_status(channels, empty), source_files=files, metrics=metrics, sources=sources)
    facts = reduce(DataFrame.unionByName, parts)
    report = sales_report(facts, skus, channels, run_date, keep_ranks=True)
    missing = missing_skus(facts.where(_is_sku()), skus, "Channel", channels)
    dated = facts.where(F.col("SKU").isNotNull())
    return RunResult(report, channel_status(channels, channel_dates(dated, channels)), missing, None, files,
                     metrics, sources, reduce(DataFrame.unionByName, unmapped) if unmapped else None)


# --- inventory registry -------------------------------------------------------------------

def _fba(spark, p, cat):
    return C.fba(p["primary"], cat.allowed_dim(spark), cat.sku_dim(spark), uncast=True)


def _awd(spark, p, cat):
    return C.awd(p["primary"], cat.allowed_dim(spark), cat.sku_dim(spark), uncast=True)


def _three_pl(spark, p, cat):
    return C.three_pl(p["levels"], p["orders"], p.get("inbound"), cat.dsku_dim(spark), cat.sku_dim(spark), uncast=True)


def _wfs(spark, p, cat):
    return C.wfs(p["sales"], p["inventory"], cat.sku_dim(spark), uncast=True)


def _fbt(spark, p, cat):
    return C.fbt(p["inventory"], p.get("sales"), cat.mapping_dim(spark, "tiktok"), cat.sku_dim(spark), uncast=True)


INVENTORY_REGISTRY = [
    InventorySource("FBA", {"primary": PREFIX["fba"]}, _fba, {"primary": "fba"}, channels=("FBA",)),
    InventorySource("3PL", {"levels": PREFIX["tpl_levels"], "orders": PREFIX["tpl_orders"],
                            "inbound": PREFIX["tpl_inbound"]}, _three_pl,
                    {"levels": "tpl_levels", "orders": "tpl_orders", "inbound": "tpl_inbound"}, optional=("inbound",),
                    channels=("DTC", "Reserve")),
    InventorySource("AWD", {"primary": PREFIX["awd"]}, _awd, {"primary": "awd"}, channels=("AWD",),
                    skip_lines=AWD_PREAMBLE_LINES),
    InventorySource("WFS", {"sales": PREFIX["walmart_sales"], "inventory": PREFIX["wfs_inventory"]}, _wfs,
                    {"sales": "wfs_sales", "inventory": "wfs_inventory"}, channels=("WFS",)),
    InventorySource("FBT", {"sales": PREFIX["tiktok_orders"], "inventory": PREFIX["fbt_inventory"]}, _fbt,
                    {"sales": "tiktok_fbt_orders", "inventory": "fbt_inventory"}, channels=("FBT",)),
]

DATE_PRIORITY = ("levels", "inventory", "primary")


def inventory_run(spark: SparkSession, input_dir: str, catalog: Catalog, run_date, registry=None) -> RunResult:
    """R1 end to end: every required file of a source must be present (S8), the
    source date follows R7 (levels, else inventory, else primary)."""
    parts, files, outcomes, found_parts = [], [], [], []
    registry = registry or INVENTORY_REGISTRY
    channels, skus = list(catalog.channel_order), catalog.sku_dim(spark)
    latest = find_latest_many(spark, input_dir, {p: (".csv",) for s in registry for p in s.files.values()}, run_date)
    for src in registry:
        hits = {key: latest[prefix] for key, prefix in src.files.items() if prefix in latest}
        lacking = [src.files[k] for k in src.files if k not in hits and k not in src.optional]
        if lacking:
            outcomes.append(_skipped(src.name, "missing", f"no file {', '.join(lacking)}"))
            continue
        names = [os.path.basename(path) for path, _ in hits.values()]
        source = _Source(src.name)
        try:
            raws = {}
            for key, (path, _) in hits.items():
                raw = read_report(spark, path, skip_lines=src.skip_lines)
                C.require(raw, src.frames[key])
                raws[key] = source.watch(raw, src.frames[key])
            facts = source.stage(src.build(spark, raws, catalog))
        except SOURCE_FAULTS as e:
            outcomes.append(_skipped(src.name, "refused", _reason(e), names))
            continue
        day = next(hits[k][1] for k in DATE_PRIORITY if k in hits)
        # rows are laid on the template, so a SKU counts as found where any measure is not 0
        found = facts.where(reduce(lambda a, b: a | b, [F.col(m) != 0 for m in INVENTORY_METRICS]))
        outcomes.append(source.outcome(names, day, found.count(), 0, missing_skus(found, skus).count()))
        found_parts.append(found.select("Channel", "SKU"))
        parts.append(facts.withColumn("Date", F.to_date(F.lit(day))))
        files += names                                                # only contributing files (L19)
    sources = spark.createDataFrame(outcomes, OUTCOME)
    metrics = sources.where("status = 'loaded'").select("source", "rows_analyzed", "rows_found")
    if not parts:
        empty = spark.createDataFrame([], "Channel string, Date date")
        return RunResult(None, channel_status(channels, empty), source_files=files, metrics=metrics, sources=sources)
    facts = reduce(DataFrame.unionByName, parts)
    report, offenders = inventory_report(facts, skus, channels, run_date, keep_ranks=True, uncast=True)
    missing = missing_skus(reduce(DataFrame.unionByName, found_parts), skus, "Channel", channels)
    return RunResult(report, channel_status(channels, channel_dates(facts, channels)), missing, offenders, files, metrics, sources)


# --- publication --------------------------------------------------------------------------

def publish(spark: SparkSession, run: RunResult, report_type: str, out_dir: str, run_date,
            contract: Contract | None = None, timestamp=None, skip_logged: bool = False,
            exports: Sequence[str] = ()) -> DataFrame | None:
    """Write, audit, promote; then H2 summary from the written rows and H3 log.

    1. The uncast report is staged; the contract's violations are observed by that write.
    2. Any violation raises ContractViolation, and nothing at all is published (Q4).
    3. The staged rows replace this run's partition of ``reports/report=<type>`` (S11, O4), and each of
       ``exports`` ("csv", "json") an ordered export of the same rows (S12).
    4. Channel and source status replace the run's partition of ``status`` and ``sources`` (R10, Q5, Q6).
    5. The summary of the written rows replaces the run's row in the log, parquet and JSON (H3, S14).

    Returns the run summary. An empty extract publishes its status only and returns None (R10).
    ``skip_logged`` leaves a (pipeline, report date) that the log already has as it is (D2), and returns None.
    """
    out_dir = out_dir.rstrip("/")
    if run.report is None:
        _write_status(run, report_type, out_dir, run_date)
        return None
    contract = contract or (sales_contract() if report_type == "sales" else inventory_contract())
    counts = {f"{r.column}:{r.name}": n for r, n in zip(contract.rules, violations(contract))}
    staged = Staged(run.report, f"report-{report_type}", {
        **counts, "rows_in": F.count(F.lit(1)), "last_date": F.max("Date")})
    broken = {k: staged.metrics[k] for k in counts if staged.metrics[k]}
    if broken:
        staged.drop()
        raise ContractViolation(f"the {report_type} report violates its contract, rows by rule: {broken}")
    if skip_logged:
        this = spark.createDataFrame([(report_type, staged.metrics["last_date"])], "pipeline string, report_date date")
        if not_yet_logged(this, read_run_log(spark, f"{out_dir}/run_history")).isEmpty():
            log.info("%s of %s is logged already", report_type, staged.metrics["last_date"])
            staged.drop()
            return None
    rows = as_published(staged.table, report_type)
    names = [f.split(" ")[0] for f in PUBLISHED[report_type].split(", ")]
    write_report(rows, out_dir, report_type, run_date, names)
    for fmt in exports:
        path, ranks = f"{out_dir}/exports/{report_type}_report_{run_date}.{fmt}", [c for c in rows.columns if c not in names]
        (export_json if fmt == "json" else export_csv)(rows, path, drop=ranks)
    staged.drop()
    _write_status(run, report_type, out_dir, run_date)
    written = read_written(spark, out_dir, report_type, run_date, PUBLISHED[report_type])
    summary = Staged(run_summary(written, report_type, run.source_files, timestamp), "summary").table
    upsert_run_log(summary, f"{out_dir}/run_history")
    upsert_json_log(summary, f"{out_dir}/run_history_json", f"{out_dir}/run_history_malformed")
    return summary


def _write_status(run: RunResult, report_type: str, out_dir: str, run_date) -> None:
    tables = {"status": run.status, "sources": run.sources, "missing_skus": run.missing, "unmapped_keys": run.unmapped}
    for name, df in tables.items():
        if df is not None:
            (df.withColumns({"report": F.lit(report_type), "run_date": F.to_date(F.lit(str(run_date)))})
             .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
             .partitionBy("report", "run_date").parquet(f"{out_dir}/{name}"))


# --- combined history (H1, O1, S15) --------------------------------------------------------

def combine_inventory(spark: SparkSession, directory: str, out_dir: str) -> DataFrame | None:
    """H1: bring the history table up to the snapshots of ``directory`` and export it by Date, Channel, SKU.

    Returns the combined history, or None when there is no usable snapshot."""
    table = f"{out_dir.rstrip('/')}/history"
    update_history(spark, directory, table)
    try:
        combined = read_history(spark, table)
    except PySparkException:
        return None
    write_ordered(combined, f"{out_dir.rstrip('/')}/exports/combined_report.csv", HISTORY_ORDER)
    return combined


# --- reconciliation of two Amazon sources (H4) --------------------------------------------

def compare_amazon(spark: SparkSession, input_dir: str, catalog: Catalog, run_date, out_dir: str | None = None):
    """H4 from files: business-report sales (C2) vs raw orders (C5), per SKU; exported by SKU (O3, S15) to ``out_dir``.

    Returns (per-SKU comparison, totals) or None when either file is missing."""
    from skuflow.operators.reconcile import reconcile, reconcile_totals

    latest = find_latest_many(spark, input_dir, {PREFIX["amazon_sales"]: (".csv",),
                                                 PREFIX["amazon_orders"]: (".txt", ".csv")}, run_date)
    old, new = latest.get(PREFIX["amazon_sales"]), latest.get(PREFIX["amazon_orders"])
    if old is None or new is None:
        return None
    mapping = catalog.mapping_dim(spark, "amazon")
    o = C.amazon_sales(read_report(spark, old[0]), mapping).sales
    n = C.amazon_orders(read_report(spark, new[0]), mapping).sales
    recon = reconcile(o, n)
    if out_dir:
        staged = Staged(recon, "comparison")
        recon = staged.table
        write_ordered(recon, f"{out_dir.rstrip('/')}/exports/amazon_comparison_{run_date}.csv", ["SKU"], drop=["in_old", "in_new"])
    return recon, reconcile_totals(recon)
