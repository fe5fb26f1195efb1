"""The run and publish path as queries on the driver tables, each with its DuckDB SQL.

Every query writes what a run writes (reports, logs, exports, snapshots, mapping files) from whole
tables into a folder of its own under the session's shared folder, and returns what is read back.
"""

from __future__ import annotations

import math
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skuflow.operators.history import LOG_SCHEMA, read_history, read_json_log, read_run_log, update_history
from skuflow.operators.mapping import map_sales
from skuflow.operators.quality import channel_status
from skuflow.operators.spine import channel_dates
from skuflow.plans import channel_queries as CQ
from skuflow.plans import channels as C
from skuflow.plans.oracle import BUNDLES, GRID, MAPPED, REPORT, SALES, SQL as TABLE_SQL, _with
from skuflow.plans.reports import PUBLISHED, inventory_report
from skuflow.plans.runs import RunResult, SalesSource, publish, sales_from_frames
from skuflow.plans.warehouse import (
    CHANNELS, INVENTORY_CHANNELS, RUN_DATE, UNMAPPED_MIN_SIZE, Tables, _report, catalog_template, inventory_facts, master_skus,
    order_documents, order_lines, part_mapping,
)
from skuflow.session import checkpoint_dir
from skuflow.sinks import read_written
from skuflow.sinks.ordered import REPORT_ORDER, read_ordered, write_ordered
from skuflow.sources import landed
from skuflow.sources.config import Catalog, read_mapping, unique_mapping
from skuflow.sources.reports import read_report, split_malformed

#: Lines of one synthesized report file, snapshots of the history, rows of one payload page.
FILE_LINES = 1_000_000
SNAPSHOT_DAYS = ("1998-11-28", "1998-11-29", "1998-11-30", "1998-12-01")
PAGE = 50
BRANDS = tuple(f"Brand#{i}" for i in range(1, 26))


def _folder(spark, label: str) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def published_reports(spark, sf_dir) -> DataFrame:
    """Both reports published into one folder, twice; what its log and tables hold."""
    t, out = Tables(spark, sf_dir), _folder(spark, "published")
    inventory, _ = inventory_report(inventory_facts(t), master_skus(t), INVENTORY_CHANNELS, RUN_DATE, keep_ranks=True, uncast=True)
    sales_status = channel_status(CHANNELS, channel_dates(order_lines(t), CHANNELS))
    stock_status = channel_status(INVENTORY_CHANNELS, channel_dates(inventory_facts(t), INVENTORY_CHANNELS))
    runs = {"inventory": RunResult(inventory, stock_status), "sales": RunResult(_report(t, keep_ranks=True), sales_status)}
    for stamp in ("first", "again"):
        for kind, run in runs.items():
            publish(spark, run, kind, out, RUN_DATE, timestamp=stamp)
    rows = [read_written(spark, out, kind, RUN_DATE, PUBLISHED[kind]).agg(
        F.lit(kind).alias("pipeline"), F.count("*").alias("published_rows")) for kind in runs]
    lines, _ = read_json_log(spark, f"{out}/run_history_json")
    return (read_run_log(spark, f"{out}/run_history").drop("source_files")
            .join(rows[0].union(rows[1]), "pipeline")
            .join(lines.groupBy("pipeline").agg(F.count("*").alias("json_log_rows")), "pipeline"))


def source_outcomes(spark, sf_dir) -> DataFrame:
    """Four sources, of which one has bad cells, one lacks a column and one has no file."""
    t = Tables(spark, sf_dir)
    seven = F.col("l_linenumber") == 7
    place = F.when(F.col("o_orderpriority").isin(*CQ.AMAZON_PRIORITIES), C.AMAZON_MARKETPLACE).otherwise("Non-Amazon")
    text = lambda c: F.col(c).cast("string")
    amazon = CQ._lines(t).select(
        place.alias("sales-channel"), CQ._lookup("o_orderstatus", CQ.AMAZON_STATUS).alias("order-status"),
        text("l_partkey").alias("sku"), F.when(seven, "seven").otherwise(text("l_quantity")).alias("quantity"),
        text("l_extendedprice").alias("item-price"))
    walmart = t.lineitem.select(text("l_partkey").alias("SKU"), text("l_quantity").alias("Units_Sold"),
                                F.when(seven, "not money").otherwise(text("l_extendedprice")).alias("GMV"))
    tiktok = CQ._lines(t).select(F.lit("Completed").alias("Order Status"), text("l_partkey").alias("SKU ID"))
    mapping = part_mapping(t)
    registry = [
        SalesSource("Amazon", "a", lambda s, raw, cat: C.amazon_orders(raw, mapping), "amazon_orders"),
        SalesSource("Walmart", "w", lambda s, raw, cat: C.walmart_sales(raw), "walmart_sales"),
        SalesSource("TikTok Shop", "t", lambda s, raw, cat: C.tiktok_shop_orders(raw, mapping), "tiktok_shop_orders"),
        SalesSource("Mixed", "s", lambda s, raw, cat: C.shopify_sales(raw, mapping), "shopify_sales", by=("Channel",)),
    ]
    frames = {"a": (lambda: amazon, "a.csv", RUN_DATE), "w": (lambda: walmart, "w.csv", RUN_DATE),
              "t": (lambda: tiktok, "t.csv", RUN_DATE), "s": None}
    cat = Catalog(sku_order=BRANDS, sales_channel_order=("Amazon", "Walmart", "TikTok Shop"))
    run = sales_from_frames(spark, frames, cat, RUN_DATE, registry)
    return run.sources.select("source", "status", "rows_analyzed", "rows_found", "coerced_cells", "unmapped_keys", "missing_skus")


def quarantine_readback(spark, sf_dir) -> DataFrame:
    """Ragged report files and a JSON log with torn lines, read back with the rows put aside."""
    t, out = Tables(spark, sf_dir), _folder(spark, "ragged")
    li = t.lineitem
    files = max(8, math.ceil(li.count() / FILE_LINES))
    cells = F.when(F.col("l_linenumber") == 7, F.array(F.col("l_partkey").cast("string"), F.lit("1"), F.lit("2"), F.lit("lost"))).when(
        F.col("l_linenumber") == 6, F.array(F.col("l_partkey").cast("string"))).otherwise(
        F.array(F.col("l_partkey").cast("string"), F.lit('"1,000"'), F.col("l_extendedprice").cast("string")))
    bucket = F.pmod(F.xxhash64("l_orderkey", "l_partkey", "l_linenumber"), F.lit(files))
    rows = li.select(bucket.alias("bucket"), F.lit(1).alias("place"), F.array_join(cells, ",").alias("value"))
    heads = spark.range(files).select(F.col("id").alias("bucket"), F.lit(0).alias("place"), F.lit("SKU,Units_Sold,GMV").alias("value"))
    (heads.union(rows).repartition(files, "bucket").sortWithinPartitions("bucket", "place").drop("place")
     .write.partitionBy("bucket").text(f"{out}/reports"))
    good, bad = split_malformed(read_report(spark, f"{out}/reports/bucket=*", malformed="quarantine"))
    doc = F.to_json(F.struct(F.lit("sales").alias("pipeline"), F.to_date("o_orderdate").alias("report_date"),
                             F.lit(1).alias("total_records")))
    torn = F.when(F.col("o_orderkey") % 10 == 0, F.substring(doc, 1, 20)).otherwise(doc)
    t.orders.select(torn.alias("value")).write.text(f"{out}/log")
    runs, lines = read_json_log(spark, f"{out}/log")

    def counted(kind: str, kept: DataFrame, aside: DataFrame) -> DataFrame:
        both = kept.select(F.lit(1).alias("g"), F.lit(0).alias("b")).union(aside.select(F.lit(0), F.lit(1)))
        return both.agg(F.lit(kind).alias("kind"), F.sum("g").alias("good_rows"), F.sum("b").alias("malformed_rows"))

    return counted("report", good.select("SKU"), bad).union(counted("json_log", runs.select("pipeline"), lines))


def ordered_export(spark, sf_dir) -> DataFrame:
    """The sales report's CSV export, each row with its position in it."""
    out = _folder(spark, "export")
    rep = _report(Tables(spark, sf_dir), keep_ranks=True)
    write_ordered(rep, out, REPORT_ORDER, drop=["channel_rank", "sku_rank"])
    return read_ordered(spark, out, PUBLISHED["sales"]).select("position", "id", "Date", "SKU", "Channel", "Units", "Revenue")


def _snapshot(t: Tables, i: int) -> DataFrame:
    """One day's stock per brand; every other day under the legacy headers."""
    rows = t.part.groupBy(F.col("p_brand").alias("SKU")).agg(
        (F.sum("p_size") + i).cast("long").alias("Units"), F.count("*").alias("Inventory"), F.lit(i).cast("long").alias("Inbound"))
    rows = rows.select("SKU", F.lit("FBA").alias("Channel"), "Units", "Inventory", "Inbound")
    return rows if i % 2 == 0 else rows.withColumnsRenamed({"SKU": "sku", "Units": "Units Sold", "Channel": "channel"})


def incremental_history(spark, sf_dir) -> DataFrame:
    """Two days of snapshots, then two more; the second update opens the new ones alone."""
    t, out = Tables(spark, sf_dir), _folder(spark, "snapshots")
    table = f"{out}/history"

    def write(i: int, rows: DataFrame) -> None:
        rows.write.mode("overwrite").option("header", True).csv(f"{out}/in/inventory_report_{SNAPSHOT_DAYS[i]}.csv")

    for i in (0, 1):
        write(i, _snapshot(t, i))
    seen = update_history(spark, f"{out}/in", table)
    write(0, _snapshot(t, 0).limit(0))           # a known day that changes afterwards is not read again
    for i in (2, 3):
        write(i, _snapshot(t, i))
    seen_now = update_history(spark, f"{out}/in", table)
    return read_history(spark, table).withColumn(
        "read_by", F.when(F.col("Date").cast("string").isin(seen), 1).when(F.col("Date").cast("string").isin(seen_now), 2))


def mapping_from_files(spark, sf_dir) -> DataFrame:
    """The catalog mapping written as JSON documents, read by Spark, checked for duplicate keys, joined."""
    t, out = Tables(spark, sf_dir), _folder(spark, "mapping")
    entry = F.create_map(F.col("source_key").cast("string"), F.col("targets"))
    part_mapping(t).select(entry.alias("AMAZON_SKU_MAP")).write.json(out)
    mapping = unique_mapping(read_mapping(spark, out, "AMAZON_SKU_MAP"))
    m = map_sales(order_lines(t), mapping, "source_key", "qty", "rev", by=["Channel"])
    return m.sales.select("Channel", "SKU", "Units", F.col("Revenue").cast("double").alias("Revenue"))


def _pages(rows: DataFrame, key: str, item, root: str) -> DataFrame:
    """API pages of at most PAGE items as JSON documents."""
    page = rows.groupBy(F.floor(F.col(key) / PAGE).alias("page")).agg(F.collect_list(item).alias(root))
    return page.select(F.to_json(F.struct(root)).alias("json"))


def landed_fba(spark, sf_dir) -> DataFrame:
    """D7 -> C9: inventory summaries with details left out where a part is small."""
    t = Tables(spark, sf_dir)
    big = F.col("p_size") >= 10
    details = F.struct(
        F.floor("p_retailprice").alias("fulfillableQuantity"),
        F.struct(F.col("p_size").alias("fcProcessingQuantity")).alias("reservedQuantity"),
        F.when(big, F.col("p_size")).alias("inboundWorkingQuantity"), F.lit(1).alias("inboundShippedQuantity"),
        F.when(big, F.lit(2)).alias("inboundReceivingQuantity"))
    item = F.struct(CQ._merchant_sku().alias("sellerSku"), details.alias("inventoryDetails"))
    docs = _pages(t.part, "p_partkey", item, "inventorySummaries")
    return C.fba(landed.fba_inventory(landed.parse_landed(docs, "json", landed.FBA_DOC)), CQ._allowed(t), master_skus(t))


def landed_awd(spark, sf_dir) -> DataFrame:
    """D7 -> C10."""
    t = Tables(spark, sf_dir)
    details = F.struct(F.struct(F.floor("p_retailprice").alias("amount")).alias("availableQuantity"),
                       F.struct(F.when(F.col("p_size") >= 10, F.col("p_size")).alias("amount")).alias("inboundQuantity"))
    item = F.struct(CQ._merchant_sku().alias("sku"), details.alias("inventoryDetails"))
    docs = _pages(t.part, "p_partkey", item, "inventory")
    return C.awd(landed.awd_inventory(landed.parse_landed(docs, "json", landed.AWD_DOC)), CQ._allowed(t), master_skus(t))


def _walmart_documents(t: Tables) -> DataFrame:
    """Order documents: two PRODUCT charges that make 1.25 times the line number a unit, and a shipping charge."""
    def charge(kind: str, each):
        amount = (F.col("l_quantity").cast("decimal(18,2)") * each).cast("decimal(18,4)")
        return F.struct(F.lit(kind).alias("chargeType"), F.struct(amount.alias("amount")).alias("chargeAmount"))

    status = F.when(F.col("l_returnflag") == "R", "Cancelled").otherwise("Shipped")
    item = F.struct(
        F.col("l_partkey").cast("string").alias("sku"), status.alias("status"),
        F.struct(F.col("l_quantity").cast("string").alias("amount")).alias("orderLineQuantity"),
        F.array(charge("PRODUCT", F.col("l_linenumber").cast("decimal(18,2)")), charge("SHIPPING", F.lit(3).cast("decimal(18,2)")),
                charge("PRODUCT", F.col("l_linenumber").cast("decimal(18,2)") / 4)).alias("charges"))
    order = F.struct(F.col("o_orderkey").cast("string").alias("purchaseOrderId"), F.col("items").alias("orderLines"))
    docs = order_documents(t.lineitem, t.orders.select("o_orderkey"), item).select(
        F.to_json(F.struct(F.array(order).alias("orders"))).alias("json"))
    return landed.parse_landed(docs, "json", landed.WALMART_ORDERS_DOC)


def landed_walmart_orders(spark, sf_dir) -> DataFrame:
    """D8 -> C8: units and revenue of the lines with a status on the allow-list."""
    sales = C.walmart_orders(landed.walmart_orders(_walmart_documents(Tables(spark, sf_dir))))
    return sales.select("SKU", "Units", F.col("Revenue").cast("double").alias("Revenue"))


def landed_wfs(spark, sf_dir) -> DataFrame:
    """D8 -> C18: units sold of the orders payload and stock of the inventory payload."""
    t = Tables(spark, sf_dir)
    item = F.struct(F.col("p_partkey").cast("string").alias("sku"), F.col("p_size").alias("availableToSellQty"),
                    F.when(F.col("p_size") >= 10, F.floor("p_retailprice")).alias("inboundQty"))
    stock = landed.parse_landed(_pages(t.part, "p_partkey", item, "inventory"), "json", landed.WALMART_INVENTORY_DOC)
    return C.wfs(landed.walmart_sales(_walmart_documents(t)), landed.walmart_inventory(stock), catalog_template(t))


QUERIES = {f.__name__: f for f in (
    published_reports, source_outcomes, quarantine_readback, ordered_export, incremental_history, mapping_from_files,
    landed_fba, landed_awd, landed_walmart_orders, landed_wfs)}

_AMAZON = "o.o_orderstatus = 'F' AND o.o_orderpriority IN ('1-URGENT', '2-HIGH')"
_DAYS = ", ".join(f"({i}, DATE '{d}')" for i, d in enumerate(SNAPSHOT_DAYS))

SQL = {
    "published_reports": _with(*MAPPED, SALES, BUNDLES, GRID, REPORT) + f"""
SELECT 'sales' AS pipeline, 'again' AS "timestamp", max("Date") AS report_date, count(*) AS total_records,
  cast(sum("Units") AS BIGINT) AS total_units, cast(sum(cast("Revenue" AS DECIMAL(38,2))) AS DOUBLE) AS total_revenue,
  count(*) AS published_rows, cast(1 AS BIGINT) AS json_log_rows FROM report
UNION ALL SELECT 'inventory', 'again', max("Date"), count(*), cast(sum("Units") AS BIGINT), NULL, count(*), 1
FROM ({TABLE_SQL["inventory_report_zero_filled"]}) i""",

    "source_outcomes": f"""WITH kept AS (SELECT l.l_partkey, p.p_brand, p.p_type FROM lineitem l
  JOIN orders o ON o.o_orderkey = l.l_orderkey
  LEFT JOIN part p ON p.p_partkey = l.l_partkey AND p.p_size < {UNMAPPED_MIN_SIZE} WHERE {_AMAZON}),
found AS (SELECT p_brand AS sku FROM kept WHERE p_brand IS NOT NULL UNION SELECT p_type FROM kept WHERE p_type = 'SMALL'),
counts AS (SELECT count(*) AS n, count(*) FILTER (l_linenumber = 7) AS c FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey)
SELECT 'Amazon' AS source, 'loaded' AS status, n AS rows_analyzed, (SELECT count(*) FROM found) AS rows_found, c AS coerced_cells,
  (SELECT count(DISTINCT l_partkey) FROM kept WHERE p_brand IS NULL) AS unmapped_keys,
  25 - (SELECT count(*) FROM found WHERE sku <> 'SMALL') AS missing_skus FROM counts
UNION ALL SELECT 'Walmart', 'refused', NULL, NULL, NULL, NULL, NULL
UNION ALL SELECT 'TikTok Shop', 'refused', NULL, NULL, NULL, NULL, NULL
UNION ALL SELECT 'Mixed', 'missing', NULL, NULL, NULL, NULL, NULL""",

    "quarantine_readback": """SELECT 'report' AS kind, count(*) FILTER (l_linenumber <> 7) AS good_rows,
  count(*) FILTER (l_linenumber = 7) AS malformed_rows FROM lineitem
UNION ALL SELECT 'json_log', count(*) FILTER (o_orderkey % 10 <> 0), count(*) FILTER (o_orderkey % 10 = 0) FROM orders""",

    "ordered_export": _with(*MAPPED, SALES, BUNDLES, GRID, REPORT) + """SELECT row_number() OVER (
    ORDER BY ch.channel_rank, CASE WHEN "SKU" = 'Bundles' THEN 0 ELSE 1 END, "SKU") - 1 AS position,
  id, "Date", "SKU", "Channel", "Units", "Revenue"
FROM report JOIN (SELECT channel_rank, channel AS ranked FROM ch) ch ON ch.ranked = "Channel" """,

    "incremental_history": f"""WITH days AS (SELECT * FROM (VALUES {_DAYS}) t(i, d)),
s AS (SELECT p_brand AS sku, sum(p_size) AS u, count(*) AS n FROM part GROUP BY 1)
SELECT strftime(d, '%Y%m%d') || '_FBA_' || sku AS id, 'FBA_' || sku AS sku_channel_id, d AS "Date", sku AS "SKU",
  'FBA' AS "Channel", cast(u + i AS BIGINT) AS "Units", n AS "Inventory", cast(i AS BIGINT) AS "Inbound",
  CASE WHEN i < 2 THEN 1 ELSE 2 END AS read_by FROM s, days""",

    "mapping_from_files": TABLE_SQL["sales_by_sku_channel"],

    "landed_fba": _with(f"""raw AS (SELECT {CQ._MERCHANT} AS k, p_size, cast(floor(p_retailprice) AS BIGINT) AS price FROM part),
allowed AS (SELECT DISTINCT {CQ._MERCHANT} AS k FROM part WHERE p_size < 40),
p AS (SELECT regexp_replace(k, 's$', '') AS sku, sum(price + p_size) AS inv,
  sum(CASE WHEN p_size >= 10 THEN p_size + 3 ELSE 1 END) AS inb FROM raw WHERE k IN (SELECT k FROM allowed) GROUP BY 1),
t AS (SELECT DISTINCT p_brand AS sku FROM part)""") + """SELECT 'FBA' AS "Channel", t.sku AS "SKU", cast(0 AS BIGINT) AS "Units",
  cast(coalesce(inv, 0) AS BIGINT) AS "Inventory", cast(coalesce(inb, 0) AS BIGINT) AS "Inbound" FROM t LEFT JOIN p ON p.sku = t.sku""",

    "landed_awd": _with(f"""raw AS (SELECT {CQ._MERCHANT} AS k, p_size, cast(floor(p_retailprice) AS BIGINT) AS price FROM part),
allowed AS (SELECT DISTINCT {CQ._MERCHANT} AS k FROM part WHERE p_size < 40),
p AS (SELECT regexp_replace(k, 's$', '') AS sku, sum(price) AS inv, sum(CASE WHEN p_size >= 10 THEN p_size ELSE 0 END) AS inb
  FROM raw WHERE k IN (SELECT k FROM allowed) GROUP BY 1),
t AS (SELECT DISTINCT p_brand AS sku FROM part)""") + """SELECT 'AWD' AS "Channel", t.sku AS "SKU", cast(0 AS BIGINT) AS "Units",
  cast(coalesce(inv, 0) AS BIGINT) AS "Inventory", cast(coalesce(inb, 0) AS BIGINT) AS "Inbound" FROM t LEFT JOIN p ON p.sku = t.sku""",

    "landed_walmart_orders": """SELECT cast(l_partkey AS VARCHAR) AS "SKU", sum(l_quantity) AS "Units",
  cast(sum(cast(l_quantity AS DECIMAL(18,2)) * l_linenumber * cast(1.25 AS DECIMAL(4,2))) AS DOUBLE) AS "Revenue"
FROM lineitem JOIN orders ON o_orderkey = l_orderkey WHERE l_returnflag <> 'R' GROUP BY 1""",

    "landed_wfs": f"""WITH u AS (SELECT l_partkey AS k, sum(l_quantity) AS units FROM lineitem JOIN orders ON o_orderkey = l_orderkey
  WHERE l_returnflag <> 'R' GROUP BY 1)
SELECT 'WFS' AS "Channel", cast(p_partkey AS VARCHAR) AS "SKU", cast(trunc(coalesce(units, 0)) AS BIGINT) AS "Units",
  cast(p_size AS BIGINT) AS "Inventory", cast(CASE WHEN p_size >= 10 THEN floor(p_retailprice) ELSE 0 END AS BIGINT) AS "Inbound"
FROM part LEFT JOIN u ON u.k = p_partkey WHERE p_size < {UNMAPPED_MIN_SIZE}""",
}
