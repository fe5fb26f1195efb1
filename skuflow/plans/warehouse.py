"""The operators applied to the driver's warehouse tables (queries() entries).

Roles: an order line is a sales fact. Its source key is ``l_partkey`` (grouped
and joined in its native type, rendered as text only in outputs), its channel is
the order priority, ``P`` orders are excluded like pending marketplace orders,
units are ``l_quantity`` and revenue is ``l_extendedprice`` in decimal cents. The
part table plays the seller catalog: master SKUs are the brands, and each part
key maps to one or more SKUs (bundles, n-packs).

All readers are plain parquet scans; Catalyst prunes columns and pushes the
status/date predicates into the scans. Every query reads whole tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skuflow.functions import (
    clean_money, coerced, excludes_ci, json_field, not_equal_keep_null, row_id, row_sum, sku_channel_id, to_number,
)
from skuflow.operators.mapping import (
    BUNDLES_SKU, expand_long, join_mapping, map_sales, normalize_amazon_skus, unmapped_keys as _unmapped,
)
from skuflow.operators.history import (
    anomaly_flags, combine_snapshots, normalize_snapshot, not_yet_logged, run_summary, trend,
)
from skuflow.operators.measures import assemble_wide, clipped_difference
from skuflow.operators.quality import Contract, channel_status, violation_counts
from skuflow.operators.reconcile import parity, reconcile_long, reconcile_totals
from skuflow.operators.spine import channel_dates, clip_negatives, grid
from skuflow.plans.channels import (
    bucket_channel, order_item_units, shopify_orders, shopify_sales, tiktok_fbt_orders, walmart_orders, wfs,
)
from skuflow.plans.reports import inventory_report, sales_report, wide_sales
from skuflow.sinks import payload_records
from skuflow.sources import landed
from skuflow.sources.discovery import latest_per_prefix

# The configured channel list of the warehouse roles (order
# priorities, in report order), the excluded order status, the run date used for
# ids and as the fallback channel date, and the part size above which a part key
# has no catalog mapping.
CHANNELS = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
EXCLUDED_STATUS = "P"
RUN_DATE = "1998-12-01"
UNMAPPED_MIN_SIZE = 46


class Tables:
    """Lazy parquet readers for one scale-factor directory."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")


def order_lines(t: Tables, exclude: str | None = EXCLUDED_STATUS, keep_status: bool = False) -> DataFrame:
    """Sales facts: source_key, Channel, Date, qty, rev (decimal cents)[, o_orderstatus]."""
    o = t.orders if exclude is None else t.orders.where(not_equal_keep_null("o_orderstatus", exclude))
    o = (o
         .select("o_orderkey", F.col("o_orderpriority").alias("Channel"),
                 F.to_date("o_orderdate").alias("Date"), *(["o_orderstatus"] if keep_status else [])))
    li = t.lineitem.select("l_orderkey", "l_partkey", "l_quantity", "l_extendedprice")
    return (li.join(o, li.l_orderkey == o.o_orderkey)
            .select(F.col("l_partkey").alias("source_key"), "Channel", "Date",
                    F.col("l_quantity").alias("qty"),
                    F.col("l_extendedprice").cast("decimal(18,2)").alias("rev"),
                    *(["o_orderstatus"] if keep_status else [])))


def part_mapping(t: Tables) -> DataFrame:
    """Catalog mapping from the part table (source_key, targets).

    PROMO parts sell as 2-packs of their brand, SMALL parts as a bundle of the
    brand and a non-catalog component (the type), LARGE parts as 3-packs; other
    parts map 1:1 to their brand. Parts of size >= UNMAPPED_MIN_SIZE are absent.
    This dimension grows with the part table, so it is never broadcast blindly:
    it and the aggregated facts are shuffled on the key, and AQE may still switch
    to a broadcast once the measured size is small.
    """
    b, ty = F.col("p_brand"), F.col("p_type")
    targets = (F.when(ty == "PROMO", F.array(b, b))
               .when(ty == "SMALL", F.array(b, ty))
               .when(ty == "LARGE", F.array(b, b, b))
               .otherwise(F.array(b)))
    return (t.part.where(F.col("p_size") < UNMAPPED_MIN_SIZE)
            .select(F.col("p_partkey").alias("source_key"), targets.alias("targets")))


def master_skus(t: Tables) -> DataFrame:
    return t.part.select(F.col("p_brand").alias("SKU")).distinct()


def mapped(t: Tables):
    return map_sales(order_lines(t), part_mapping(t), "source_key", "qty", "rev", by=["Channel"],
                     date_col="Date")


def _money(c):
    return F.col(c).cast("double")


# --- queries ---------------------------------------------------------------------------

def sales_by_sku_channel(spark, sf_dir) -> DataFrame:
    """A3 + M1 + A2."""
    m = mapped(Tables(spark, sf_dir))
    return m.sales.select("Channel", "SKU", "Units", _money("Revenue").alias("Revenue"))


def _report(t: Tables, keep_ranks=False) -> DataFrame:
    return sales_report(mapped(t).long, master_skus(t), CHANNELS, RUN_DATE, keep_ranks=keep_ranks)


def sales_report_zero_filled(spark, sf_dir) -> DataFrame:
    """Flagship: R2 + R3 + R4 + J8 + J4 + P14."""
    return _report(Tables(spark, sf_dir))


def sales_report_wide(spark, sf_dir) -> DataFrame:
    """A9 / R11."""
    return wide_sales(_report(Tables(spark, sf_dir)), CHANNELS)


def bundle_rows(spark, sf_dir) -> DataFrame:
    """A5 + M2 + M4: original volume of bundle keys per channel."""
    m = mapped(Tables(spark, sf_dir))
    return m.bundles.select("Channel", "Units", _money("Revenue").alias("Revenue"))


def unmapped_keys(spark, sf_dir) -> DataFrame:
    """M3 + J7: keys without a mapping, with their volume, per channel."""
    t = Tables(spark, sf_dir)
    keyed = mapped(t).keyed
    return _unmapped(keyed, part_mapping(t)).select("Channel", "source_key", "Units", _money("Revenue").alias("Revenue"),
                             F.col("rows").cast("long").alias("rows"))


def missing_skus_by_channel(spark, sf_dir) -> DataFrame:
    """Q2 (+ L8): master SKUs with no sales in a channel ('missing') and sold SKUs
    outside the master list that the grid drops ('unknown'). One full join of
    the grid with the sold (Channel, SKU) pairs yields both sides in one pass."""
    t = Tables(spark, sf_dir)
    present = (mapped(t).sales.where(F.col("Channel").isin(CHANNELS))
               .select("Channel", "SKU", F.lit(True).alias("_sold")))
    g = grid(master_skus(t), CHANNELS).select("Channel", "SKU", F.lit(True).alias("_grid"))
    j = g.join(present, ["Channel", "SKU"], "full")
    issue = F.when(F.col("_sold").isNull(), "missing").when(F.col("_grid").isNull(), "unknown")
    return j.select("Channel", "SKU", issue.alias("issue")).where(F.col("issue").isNotNull())


# --- predicates and scalar functions ----------------------------------------------------

def status_substring_filter(spark, sf_dir) -> DataFrame:
    """P6 + F4 + F5: drop rows whose priority contains 'low' in any case; NULL kept."""
    return (Tables(spark, sf_dir).orders.where(excludes_ci("o_orderpriority", "low"))
            .select("o_orderkey", "o_orderpriority"))


def null_safe_not_equal(spark, sf_dir) -> DataFrame:
    """``status != 'O'`` keeping NULL statuses (here 'F' is blanked to NULL)."""
    o = Tables(spark, sf_dir).orders.select("o_orderkey", F.nullif("o_orderstatus", F.lit("F")).alias("status"))
    return o.where(not_equal_keep_null("status", "O"))


def status_exact_filter(spark, sf_dir) -> DataFrame:
    """P5: two conjunctive equality filters (merged into one scan predicate)."""
    o = Tables(spark, sf_dir).orders
    return (o.where(F.col("o_orderstatus") == "F").where(F.col("o_orderpriority") == "1-URGENT")
            .select("o_orderkey", "o_totalprice"))


def either_positive_filter(spark, sf_dir) -> DataFrame:
    """Disjunctive numeric predicate, then counts per flag."""
    li = Tables(spark, sf_dir).lineitem
    kept = li.where((F.col("l_discount") > 0.05) | (F.col("l_tax") > 0.05))
    return kept.groupBy("l_returnflag", "l_linestatus").agg(
        F.count(F.lit(1)).alias("lines"), F.sum("l_quantity").alias("units"))


def membership_semi(spark, sf_dir) -> DataFrame:
    """P9 + J6: lines of PROMO parts via a left-semi join."""
    t = Tables(spark, sf_dir)
    promo = t.part.where(F.col("p_type") == "PROMO").select(F.col("p_partkey").alias("l_partkey"))
    kept = t.lineitem.join(promo, "l_partkey", "left_semi")
    return kept.groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("lines"), F.sum("l_quantity").alias("units"))


def sku_suffix_normalize(spark, sf_dir) -> DataFrame:
    """M5 + F6 + A4: raw keys with a trailing 's' (PROMO parts), allow-list semi
    join before stripping, collisions summed."""
    part = Tables(spark, sf_dir).part
    raw = part.select(F.when(F.col("p_type") == "PROMO", F.concat("p_brand", F.lit("s"))).otherwise(F.col("p_brand"))
                      .alias("raw_key"), "p_size", F.floor("p_retailprice").alias("price_floor"))
    allowed = (part.select(F.col("p_brand").alias("SKU"))
               .unionByName(part.where((F.col("p_type") == "PROMO") & (F.col("p_size") < 10))
                            .select(F.concat("p_brand", F.lit("s")).alias("SKU"))).distinct())
    return normalize_amazon_skus(raw, "raw_key", allowed, {"Units": "p_size", "Inventory": ["p_size", "price_floor"]})


def row_wise_sum(spark, sf_dir) -> DataFrame:
    """A4: row-wise sum with missing = 0."""
    li = Tables(spark, sf_dir).lineitem
    return li.select("l_orderkey", "l_linenumber", row_sum("l_quantity", "l_tax", "l_discount").alias("total"))


def money_clean(spark, sf_dir) -> DataFrame:
    """F1: currency text ``$1,234.56`` back to an amount."""
    o = Tables(spark, sf_dir).orders
    text = F.concat(F.lit("$"), F.format_number("o_totalprice", 2))
    return o.select("o_orderkey", text.alias("money_text"), clean_money(text).cast("double").alias("amount"))


def coerce_number(spark, sf_dir) -> DataFrame:
    """F2 + Q7: lenient numbers (JSON digits parse, event names do not) and the
    count of present values that were forced to 0."""
    e = Tables(spark, sf_dir).events
    k_raw = json_field("props", "k")
    return e.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("events"),
        F.sum(to_number(k_raw, "long")).cast("long").alias("k_total"),
        F.sum(coerced("event_type", F.trim("event_type").try_cast("double"))).cast("long").alias("text_coerced"))


def json_field_query(spark, sf_dir) -> DataFrame:
    """one field of a JSON object column."""
    e = Tables(spark, sf_dir).events
    return e.select("event_id", json_field("props", "k").alias("k"))


def json_items_explode(spark, sf_dir) -> DataFrame:
    """F15 + F16 + F17 + J5 + C15: orders whose items arrive as a JSON array
    (built from the tables, see order_documents), cancelled orders dropped,
    items exploded, DSKU looked up, qty summed by SKU."""
    t = Tables(spark, sf_dir)
    item = F.struct(F.col("l_partkey").cast("string").alias("dsku"), F.col("l_quantity").cast("long").alias("qty"))
    status = F.when(F.col("o_orderstatus") == EXCLUDED_STATUS, "CANCELLED").otherwise("FULFILLED")
    orders = order_documents(t.lineitem, t.orders.select("o_orderkey", status.alias("Order Status")), item).select(
        "Order Status", F.to_json("items").alias("Items"))
    return order_item_units(orders, dsku_dim(t), "Order Status", "Items")


DOC_LINES = 8


def order_documents(lines: DataFrame, orders: DataFrame, item) -> DataFrame:
    """Line arrays of synthesized API documents with the columns of ``orders`` (o_orderkey, ...).

    Lines meet their order first and are grouped by the same key, so the join's partitioning serves
    the grouping and line data is shuffled once. A group is an order's lines of one line-number
    bucket, the part of a document that an API page would hold.
    """
    bucket = F.floor((F.col("l_linenumber") - 1) / DOC_LINES)
    joined = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return joined.groupBy("l_orderkey", bucket.alias("doc_part")).agg(
        F.collect_list(item).alias("items"), *[F.any_value(c).alias(c) for c in orders.columns])


def dsku_dim(t: Tables) -> DataFrame:
    return (t.part.where(F.col("p_size") < UNMAPPED_MIN_SIZE)
            .select(F.col("p_partkey").cast("string").alias("dsku"), F.col("p_brand").alias("SKU")))


def dict_lookup(spark, sf_dir) -> DataFrame:
    """Scalar dictionary lookup as an inner join (unknown keys drop)."""
    t = Tables(spark, sf_dir)
    n = t.nation.select(F.col("n_nationkey").alias("s_nationkey"), F.col("n_name").alias("nation"))
    return t.supplier.join(n, "s_nationkey", "inner").select("s_suppkey", "nation")


# --- measures on templates (inventory channel shapes) -----------------------------------

def _flag_qty(flag):
    return F.when(F.col("l_returnflag") == flag, F.col("l_quantity")).otherwise(0.0)


def catalog_template(t: Tables) -> DataFrame:
    return t.part.where(F.col("p_size") < UNMAPPED_MIN_SIZE).select(F.col("p_partkey").cast("string").alias("SKU"))


def reserve_clip(spark, sf_dir) -> DataFrame:
    """A6 + F12 + C14: levels per MSKU over facilities (lines): DTC = Σ DTC,
    Reserve = max(0, Σ RS − Σ Ops WIP); only catalog SKUs (semi join on the
    native key, cast to text after aggregation)."""
    t = Tables(spark, sf_dir)
    levels = t.lineitem.select(F.col("l_partkey").alias("MSKU"),
                               _flag_qty("A").alias("DTC Total Quantity"), _flag_qty("N").alias("RS Total Quantity"),
                               _flag_qty("R").alias("Ops WIP Quantity"))
    catalog = t.part.where(F.col("p_size") < UNMAPPED_MIN_SIZE).select(F.col("p_partkey").alias("MSKU"))
    agg = (levels.join(catalog, "MSKU", "left_semi")
           .groupBy("MSKU")
           .agg(F.sum("DTC Total Quantity").alias("DTC"), F.sum("RS Total Quantity").alias("rs"),
                F.sum("Ops WIP Quantity").alias("wip")))
    return agg.select(F.col("MSKU").cast("string").alias("SKU"), "DTC", clipped_difference("rs", "wip").alias("Reserve"))


def outer_merge_measures(spark, sf_dir) -> DataFrame:
    """J2 + C18: sales units ⟗ inventory (both aggregated per SKU), then the
    catalog template; WFS-shaped raw frames are derived from the lines."""
    t = Tables(spark, sf_dir)
    li = t.lineitem
    sales_raw = (li.where((F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "F"))
                 .select(F.col("l_partkey").cast("string").alias("SKU"), F.col("l_quantity").alias("Units_Sold")))
    inv_raw = (li.where((F.col("l_returnflag") == "A") & (F.col("l_linestatus") == "O"))
               .select(F.col("l_partkey").cast("string").alias("SKU"), F.col("l_quantity").alias("Available units"),
                       F.lit(1).alias("Inbound units")))
    return wfs(sales_raw, inv_raw, catalog_template(t)).drop("Channel")


def chained_template(spark, sf_dir) -> DataFrame:
    """J1 + J3 + C17: three measures onto the catalog template. All three come from
    the lines here, so one scan projects each measure conditionally and one
    group-by on the native part key folds them, instead of three chained joins."""
    t = Tables(spark, sf_dir)
    flag, status, qty = F.col("l_returnflag"), F.col("l_linestatus"), F.col("l_quantity")
    wide = t.lineitem.select(F.col("l_partkey").alias("SKU"),
                             F.when(flag == "A", qty).alias("Inventory"),
                             F.when(flag == "N", qty).alias("Units"),
                             F.when((flag == "R") & (status == "O"), qty).alias("Inbound"))
    template = t.part.where(F.col("p_size") < UNMAPPED_MIN_SIZE).select(F.col("p_partkey").alias("SKU"))
    out = assemble_wide(template, wide, ["Inventory", "Units", "Inbound"])
    return out.withColumn("SKU", F.col("SKU").cast("string"))


def union_channels(spark, sf_dir) -> DataFrame:
    """Union by name with missing columns filled with NULL."""
    t = Tables(spark, sf_dir)
    c = t.customer.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"),
                          F.col("c_acctbal").alias("balance"), F.col("c_mktsegment").alias("segment"),
                          F.lit("customer").alias("kind"))
    s = t.supplier.select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"),
                          F.col("s_acctbal").alias("balance"), F.lit("supplier").alias("kind"))
    return c.unionByName(s, allowMissingColumns=True)


# Market segment -> reporting channel for the warehouse roles.
SEGMENT_BUCKETS = {"MACHINERY": "TikTok Shopify", "BUILDING": "Target", "AUTOMOBILE": "Shopify",
                   "FURNITURE": "Shopify"}


def channel_bucket(spark, sf_dir) -> DataFrame:
    """CASE bucketing with an 'Others' default."""
    c = Tables(spark, sf_dir).customer
    return (c.select(bucket_channel("c_mktsegment", SEGMENT_BUCKETS).alias("bucket"),
                     F.col("c_acctbal").cast("decimal(18,2)").alias("bal"))
            .groupBy("bucket").agg(F.count(F.lit(1)).alias("customers"), F.sum("bal").cast("double").alias("balance")))


def channel_dates_query(spark, sf_dir) -> DataFrame:
    """A7 + Q6: latest data date per configured channel, or 'No data'."""
    o = Tables(spark, sf_dir).orders.where(not_equal_keep_null("o_orderstatus", EXCLUDED_STATUS))
    facts = o.select(F.col("o_orderpriority").alias("Channel"), F.to_date("o_orderdate").alias("Date"))
    return channel_status(CHANNELS, channel_dates(facts, CHANNELS))


def surrogate_ids(spark, sf_dir) -> DataFrame:
    """R4 + F7–F9: date_channel_key ids (spaces -> underscores)."""
    o = Tables(spark, sf_dir).orders
    d = F.to_date("o_orderdate")
    return o.select("o_orderkey", row_id(d, "o_orderpriority", F.col("o_custkey").cast("string")).alias("id"),
                    sku_channel_id("o_orderpriority", F.col("o_custkey").cast("string")).alias("sku_channel_id"))


def _balances(t: Tables) -> DataFrame:
    return t.customer.select(F.col("c_mktsegment").alias("Channel"), F.col("c_custkey").cast("string").alias("SKU"),
                             "c_acctbal")


def clip_with_offenders(spark, sf_dir) -> DataFrame:
    """Negatives clipped to 0."""
    clipped, _ = clip_negatives(_balances(Tables(spark, sf_dir)), ["c_acctbal"])
    return clipped


def negative_offenders(spark, sf_dir) -> DataFrame:
    """The offender table (every metric value below 0)."""
    _, offenders = clip_negatives(_balances(Tables(spark, sf_dir)), ["c_acctbal"])
    return offenders


CUSTOMER_CONTRACT = dict(required=["c_name", "c_mktsegment"], non_negative=["c_acctbal"], integral=["c_nationkey"])


def contract_violations(spark, sf_dir) -> DataFrame:
    """Q3: per-rule violation counts in one aggregate pass."""
    return violation_counts(Tables(spark, sf_dir).customer, Contract.of(**CUSTOMER_CONTRACT))


def report_contract(spark, sf_dir) -> DataFrame:
    """Q3/Q4 on the published sales report (what the gate checks before writing)."""
    rep = _report(Tables(spark, sf_dir))
    return violation_counts(rep, Contract.of(required=["id", "sku_channel_id", "Date", "SKU", "Channel"],
                                             integral=["Units"]))


# Fixed value: order statuses on the C8 allow-list for the warehouse roles.
ALLOWED_STATUSES = ["F", "O"]


def price_times_qty(spark, sf_dir) -> DataFrame:
    """Status allow-list, Revenue = Quantity × Unit Price, summed by SKU.

    The unit price is a property of the part, so Σ(qty × price) = price × Σqty
    (exact in decimal): lines are summed per (part, order status) before the part
    join, which then sees one row per part key and status instead of one per line.
    The builder's allow-list on the status reaches the orders scan."""
    t = Tables(spark, sf_dir)
    orders = t.orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_orderstatus")
    per_part = (t.lineitem.select("l_orderkey", "l_partkey", "l_quantity").join(orders, "l_orderkey")
                .groupBy("l_partkey", "o_orderstatus").agg(F.sum("l_quantity").alias("Quantity")))
    raw = (per_part.join(t.part.select(F.col("p_partkey").alias("l_partkey"), "p_brand", "p_retailprice"), "l_partkey")
           .select(F.col("p_brand").alias("SKU"), "Quantity", F.col("p_retailprice").alias("Unit Price"),
                   F.col("o_orderstatus").alias("Order Line Status")))
    out = walmart_orders(raw, statuses=ALLOWED_STATUSES)
    return out.select("SKU", "Units", F.col("Revenue").cast("double").alias("Revenue"))


# The sales-channel name each order priority arrives with in the
# raw Shopify order export of the warehouse roles ('Wholesale' is bucketed to
# Others), and the order status that counts as paid.
SOURCE_CHANNELS = {"1-URGENT": "web", "2-HIGH": "online_store", "3-MEDIUM": "tiktok",
                   "4-NOT SPECIFIED": "marketplace_connect", "5-LOW": "pos"}
PAID_STATUS = "F"


def shopify_orders_paid(spark, sf_dir) -> DataFrame:
    """Raw order lines as a Shopify order export (paid = finished orders,
    price from the part), Revenue = price × quantity, channel bucketed from the
    source name, mapped with bundles, per (channel, SKU). The price belongs to the
    part, so lines are summed per (part, status, priority) before the part join."""
    t = Tables(spark, sf_dir)
    src = None
    for prio, name in SOURCE_CHANNELS.items():
        hit = F.col("o_orderpriority") == prio
        src = F.when(hit, name) if src is None else src.when(hit, name)
    lines = (t.lineitem.select("l_orderkey", "l_partkey", "l_quantity")
             .join(t.orders.select("o_orderkey", "o_orderstatus", "o_orderpriority"),
                   F.col("l_orderkey") == F.col("o_orderkey"))
             .groupBy("l_partkey", "o_orderstatus", "o_orderpriority").agg(F.sum("l_quantity").alias("l_quantity")))
    raw = (lines.join(t.part.select("p_partkey", "p_retailprice"), F.col("l_partkey") == F.col("p_partkey"))
           .select(F.when(F.col("o_orderstatus") == PAID_STATUS, "paid").otherwise("pending").alias("Financial Status"),
                   F.col("l_partkey").cast("string").alias("Lineitem sku"),
                   F.col("l_quantity").alias("Lineitem quantity"), F.col("p_retailprice").alias("Lineitem price"),
                   src.alias("Source name")))
    m = shopify_orders(raw, part_mapping(t))
    return m.long.where(F.col("SKU").isNotNull()).select("Channel", "SKU", "Units", _money("Revenue").alias("Revenue"))


# --- files, history, reconciliation, windows -------------------------------------------

def latest_per_prefix_query(spark, sf_dir) -> DataFrame:
    """S6 + S7 + O2 + F10: file names synthesized from the orders
    (``Orders_<priority>_<date>.<txt|csv>``); per prefix the run-date file wins,
    else the newest date, ties by extension order."""
    o = Tables(spark, sf_dir).orders
    ext = F.when(F.col("o_orderstatus") == "F", ".txt").otherwise(".csv")
    name = F.concat(F.lit("Orders_"), F.replace("o_orderpriority", F.lit(" "), F.lit("_")), F.lit("_"),
                    F.date_format("o_orderdate", "yyyy-MM-dd"), ext)
    prefixes = [f"Orders_{c.replace(' ', '_')}_" for c in CHANNELS]
    return latest_per_prefix(o.select(name.alias("name")), prefixes, (".txt", ".csv"), RUN_DATE)


LEGACY_BEFORE = "1998-01-01"


def combine_history(spark, sf_dir) -> DataFrame:
    """H1 + U2: monthly snapshots (channel = return flag, SKU = part key) where
    older months carry the legacy snake_case headers; both are normalized, dated
    from the snapshot, re-keyed and unioned. The two header groups are split on
    the raw ship date, so each group's predicate reaches the parquet scan."""
    li = Tables(spark, sf_dir).lineitem
    cut = F.lit(LEGACY_BEFORE).cast("timestamp_ntz")

    def snaps(part):
        return (li.where(part)
                .select(F.trunc(F.to_date("l_shipdate"), "month").alias("snap_date"), "l_returnflag",
                        F.col("l_partkey").cast("string").alias("k"), "l_quantity", "l_linenumber")
                .groupBy("snap_date", "l_returnflag", "k")
                .agg(F.sum("l_quantity").alias("u"), F.count(F.lit(1)).alias("inv"),
                     F.max("l_linenumber").alias("inb")))

    legacy = snaps(F.col("l_shipdate") < cut).select(
        "snap_date", F.col("k").alias("sku"), F.col("l_returnflag").alias("channel"), F.col("u").alias("units_sold"),
        F.col("inv").alias("inventory"), F.col("inb").alias("inbound"), F.lit("legacy-id").alias("id"))
    current = snaps(F.col("l_shipdate") >= cut).select(
        "snap_date", F.col("k").alias("SKU"), F.col("l_returnflag").alias("Channel"), F.col("u").alias("Units"),
        F.col("inv").alias("Inventory"), F.col("inb").alias("Inbound"))
    frames = [normalize_snapshot(f, F.col("snap_date")) for f in (legacy, current)]
    return combine_snapshots([f for f in frames if f is not None])


SOURCE_FILES = ["lineitem.parquet", "orders.parquet", "part.parquet"]
RUN_TIMESTAMP = "1998-12-01T06:00:00"


def run_summary_query(spark, sf_dir) -> DataFrame:
    """H2 + A8: one summary row for the sales report (timestamp is a parameter)."""
    return run_summary(_report(Tables(spark, sf_dir)), "sales", SOURCE_FILES, RUN_TIMESTAMP)


def one_to_one_mapping(t: Tables) -> DataFrame:
    """The legacy summary methodology: every catalog part is its brand, no bundles."""
    return (t.part.where(F.col("p_size") < UNMAPPED_MIN_SIZE)
            .select(F.col("p_partkey").alias("source_key"), F.array("p_brand").alias("targets")))


def _old_new(t: Tables) -> DataFrame:
    """Both methodologies in one pass. One scan and one pre-aggregate per part
    key carry conditional sums for 'old' (all statuses) and 'new' (pending
    excluded); a single join against the union of both mappings then yields one
    row per (key, method), which is expanded and aggregated once by SKU."""
    lines = order_lines(t, exclude=None, keep_status=True)
    is_new = not_equal_keep_null("o_orderstatus", EXCLUDED_STATUS)
    keyed = (lines.groupBy("source_key")
             .agg(F.sum("qty").alias("q_old"), F.sum("rev").alias("r_old"), F.count(F.lit(1)).alias("n_old"),
                  F.sum(F.when(is_new, F.col("qty"))).alias("q_new"), F.sum(F.when(is_new, F.col("rev"))).alias("r_new"),
                  F.count(F.when(is_new, 1)).alias("n_new")))
    mappings = (one_to_one_mapping(t).withColumn("method", F.lit("old"))
                .unionByName(part_mapping(t).withColumn("method", F.lit("new"))))
    joined = join_mapping(keyed, mappings, "inner", carry=["method"])
    old = F.col("method") == "old"
    per_method = (joined.where(F.when(old, F.col("n_old")).otherwise(F.col("n_new")) > 0)
                  .select("method", "targets", "bundle_size",
                          F.when(old, F.col("q_old")).otherwise(F.col("q_new")).alias("qty"),
                          F.when(old, F.col("r_old")).otherwise(F.col("r_new")).alias("rev"),
                          F.when(old, F.col("n_old")).otherwise(F.col("n_new")).alias("rows")))
    long = expand_long(per_method, by=["method"])
    return reconcile_long(long.where(F.col("SKU").isNotNull() & (F.col("SKU") != BUNDLES_SKU)))


def reconcile_sources(spark, sf_dir) -> DataFrame:
    """H4 + J8 + F20: old (all statuses, 1:1) vs new (pending excluded, bundles) per SKU."""
    r = _old_new(Tables(spark, sf_dir))
    return r.select("SKU", "Old_Units", "New_Units", "Units_Diff", _money("Old_Rev").alias("Old_Rev"),
                    _money("New_Rev").alias("New_Rev"), _money("Rev_Diff").alias("Rev_Diff"), "in_old", "in_new")


def reconcile_totals_query(spark, sf_dir) -> DataFrame:
    """H4 + A8 + J7: totals, one-sided SKUs, SKUs with unit differences."""
    t = reconcile_totals(_old_new(Tables(spark, sf_dir)))
    return t.withColumns({"old_revenue": _money("old_revenue"), "new_revenue": _money("new_revenue")})


def parity_tolerance(spark, sf_dir) -> DataFrame:
    """Revenue within 1 % of the old methodology?"""
    p = parity(_old_new(Tables(spark, sf_dir)), rel_tol=0.01)
    return p.select("SKU", _money("Rev_Diff").alias("Rev_Diff"), "within_tolerance")


def _daily_runs(t: Tables) -> DataFrame:
    e = t.events
    return (e.select(F.col("event_type").alias("pipeline"), F.to_date("ts").alias("report_date"),
                     F.col("value").cast("decimal(18,2)").alias("v"))
            .groupBy("pipeline", "report_date").agg(F.sum("v").alias("total")))


def anomaly_trailing_7(spark, sf_dir) -> DataFrame:
    """W1 + D1: each day's total against the mean of the previous 7 runs."""
    flagged = anomaly_flags(_daily_runs(Tables(spark, sf_dir)), value="total", runs=7, threshold=0.5)
    return flagged.select("pipeline", "report_date", _money("total").alias("total"), "baseline", "is_anomaly")


def idempotency_guard(spark, sf_dir) -> DataFrame:
    """(pipeline, report_date) runs of open orders not yet logged by finished ones."""
    o = Tables(spark, sf_dir).orders.select(F.col("o_orderpriority").alias("pipeline"),
                                            F.to_date("o_orderdate").alias("report_date"), "o_orderstatus")
    log = o.where(F.col("o_orderstatus") == "F")
    incoming = o.where(F.col("o_orderstatus") == "O").select("pipeline", "report_date").distinct()
    return not_yet_logged(incoming, log)


def sku_trend(spark, sf_dir) -> DataFrame:
    """W2 + D3: monthly units per brand with the previous month's value and change
    (lines pre-aggregated by part and month before the catalog join)."""
    t = Tables(spark, sf_dir)
    pre = (t.lineitem.select("l_partkey", F.trunc(F.to_date("l_shipdate"), "month").alias("Date"), "l_quantity")
           .groupBy("l_partkey", "Date").agg(F.sum("l_quantity").alias("u")))
    monthly = (pre.join(t.part.select(F.col("p_partkey").alias("l_partkey"), F.col("p_brand").alias("SKU")),
                        "l_partkey")
               .groupBy("SKU", "Date").agg(F.sum("u").alias("Units")))
    return trend(monthly, "Units", keys=("SKU",), order="Date")


ROLLUP_FROM, ROLLUP_TO = "1998-11-01", "1998-12-01"


def rollup_totals(spark, sf_dir) -> DataFrame:
    """Trailing-window sales by (SKU, channel) plus the grand total row."""
    t = Tables(spark, sf_dir)
    li = (t.lineitem.where((F.col("l_shipdate") >= F.lit(ROLLUP_FROM).cast("timestamp_ntz"))
                           & (F.col("l_shipdate") < F.lit(ROLLUP_TO).cast("timestamp_ntz")))
          .select("l_orderkey", "l_partkey", "l_quantity",
                  (F.col("l_extendedprice").cast("decimal(18,2)")
                   * (F.lit(1) - F.col("l_discount").cast("decimal(18,2)"))).alias("net")))
    o = t.orders.select("o_orderkey", F.col("o_orderpriority").alias("Channel"))
    p = t.part.select("p_partkey", F.col("p_brand").alias("SKU"))
    # parts are joined to one row per part and channel, and both grouping sets expand those
    sums = (li.join(o, F.col("l_orderkey") == F.col("o_orderkey")).groupBy("l_partkey", "Channel")
            .agg(F.sum("l_quantity").alias("qty"), F.sum("net").alias("net")))
    j = sums.join(p, F.col("l_partkey") == F.col("p_partkey"))
    g = j.groupingSets([["SKU", "Channel"], []], "SKU", "Channel").agg(
        F.sum("qty").alias("units"), F.sum("net").cast("double").alias("net_sales"),
        (F.grouping_id() > 0).alias("is_total"))
    return g


SOURCE_NAMES = {"1-URGENT": "web", "2-HIGH": "shop", "3-MEDIUM": "tiktok", "4-NOT SPECIFIED": "marketplace-connect",
                "5-LOW": "pos"}


def net_of_discounts(spark, sf_dir) -> DataFrame:
    """D10 -> C6: landed Shopify order documents (built from the tables, see
    order_documents) are flattened, net = qty × price − Σ discount allocations,
    bucketed by source name and mapped with bundles, per (channel, SKU)."""
    t = Tables(spark, sf_dir)
    dec = lambda c: F.col(c).cast("decimal(18,2)")
    src = None
    for prio, name in SOURCE_NAMES.items():
        src = F.when(F.col("o_orderpriority") == prio, name) if src is None else src.when(
            F.col("o_orderpriority") == prio, name)
    item = F.struct(F.col("l_partkey").cast("string").alias("sku"), F.col("l_quantity").cast("long").alias("quantity"),
                    dec("p_retailprice").cast("string").alias("price"),
                    F.array(F.struct((dec("l_extendedprice") * dec("l_discount")).cast("string").alias("amount")))
                    .alias("discount_allocations"))
    lines = t.lineitem.join(t.part.select("p_partkey", "p_retailprice"), F.col("l_partkey") == F.col("p_partkey"))
    order = F.struct(F.col("o_orderkey").cast("string").alias("id"), src.alias("source_name"),
                     F.lit("paid").alias("financial_status"), F.col("items").alias("line_items"))
    docs = (order_documents(lines, t.orders.select("o_orderkey", "o_orderpriority"), item)
            .select(F.to_json(F.struct(F.array(order).alias("orders"))).alias("json")))
    raw = landed.shopify_orders(landed.parse_landed(docs, "json", landed.SHOPIFY_ORDERS_DOC))
    m = shopify_sales(raw, part_mapping(t))
    return m.long.where(F.col("SKU").isNotNull()).select("Channel", "SKU", "Units", _money("Revenue").alias("Revenue"))


FBT_PRIORITIES = ["1-URGENT", "2-HIGH"]


def landed_tiktok_fbt(spark, sf_dir) -> DataFrame:
    """D9 -> C13: landed TikTok order documents (see order_documents; status 140 =
    cancelled, FBT for urgent/high orders) flattened and run through the FBT
    orders builder (cancelled dropped, FBT only, mapped with bundles)."""
    t = Tables(spark, sf_dir)
    item = F.struct(F.col("l_partkey").cast("string").alias("sku_id"), F.lit("n/a").alias("seller_sku"),
                    F.col("l_quantity").cast("long").alias("quantity"))
    order = F.struct(
        F.col("o_orderkey").cast("string").alias("order_id"),
        F.when(F.col("o_orderstatus") == EXCLUDED_STATUS, 140).otherwise(130).alias("order_status"),
        F.when(F.col("o_orderpriority").isin(FBT_PRIORITIES), "TIKTOK_FULFILLMENT").otherwise("SELLER_SHIPPING")
        .alias("fulfillment_type"),
        F.col("items").alias("line_items"),
        F.struct(F.col("o_totalprice").cast("decimal(18,2)").cast("string").alias("total_amount")).alias("payment"))
    orders = t.orders.select("o_orderkey", "o_orderstatus", "o_orderpriority", "o_totalprice")
    docs = (order_documents(t.lineitem, orders, item)
            .select(F.to_json(F.struct(F.struct(F.array(order).alias("orders")).alias("data"))).alias("json")))
    raw = landed.tiktok_orders(landed.parse_landed(docs, "json", landed.TIKTOK_ORDERS_DOC))
    m = tiktok_fbt_orders(raw, part_mapping(t))
    return m.long.where(F.col("SKU").isNotNull()).select("SKU", "Units", _money("Revenue").alias("Revenue"))


# --- inventory report on the warehouse roles ----------------------------------------------

# The inventory channels in report order, and which return flag
# plays which inventory channel (WFS, FBT and Reserve have no facts here and
# are zero-filled, dated with the run date).
INVENTORY_CHANNELS = ["FBA", "AWD", "WFS", "FBT", "DTC", "Reserve"]
FLAG_CHANNEL = {"A": "FBA", "N": "AWD", "R": "DTC"}


def inventory_facts(t: Tables) -> DataFrame:
    li = t.lineitem
    f_qty = F.when(F.col("l_linestatus") == "F", F.col("l_quantity")).otherwise(0.0)
    o_qty = F.when(F.col("l_linestatus") == "O", F.col("l_quantity")).otherwise(0.0)
    pre = (li.groupBy("l_partkey", "l_returnflag")
           .agg(F.sum(f_qty).alias("Units"), (F.sum(o_qty) - F.sum(f_qty)).alias("Inventory"),
                F.count(F.lit(1)).alias("Inbound"), F.max(F.to_date("l_shipdate")).alias("Date")))
    p = t.part.select(F.col("p_partkey").alias("l_partkey"), F.col("p_brand").alias("SKU"))
    return pre.join(p, "l_partkey").select(bucket_channel("l_returnflag", FLAG_CHANNEL).alias("Channel"), "SKU",
                                            "Date", "Units", "Inventory", "Inbound")


def inventory_report_zero_filled(spark, sf_dir) -> DataFrame:
    """R1 + R4 + R5 + R7: channel × SKU inventory grid, negatives clipped."""
    t = Tables(spark, sf_dir)
    rep, _ = inventory_report(inventory_facts(t), master_skus(t), INVENTORY_CHANNELS, RUN_DATE)
    return rep


def inventory_offenders(spark, sf_dir) -> DataFrame:
    """The values that were clipped."""
    t = Tables(spark, sf_dir)
    _, off = inventory_report(inventory_facts(t), master_skus(t), INVENTORY_CHANNELS, RUN_DATE)
    return off


def source_metrics(spark, sf_dir) -> DataFrame:
    """Q5: per channel, raw rows analyzed and SKU rows found (one pass)."""
    long = mapped(Tables(spark, sf_dir)).long
    found = F.col("SKU").isNotNull() & (F.col("SKU") != "Bundles")
    return long.groupBy("Channel").agg(F.sum("rows").cast("long").alias("rows_analyzed"),
                                       F.count(F.when(found, 1)).alias("rows_found"))


#: Data documents of the payload, a parameter: the report has one row per channel and brand.
PAYLOAD_CHUNKS = 8
PAYLOAD_SCHEMA = ("reportType string, chunk int, chunks int, reportSummary map<string,string>, reportData array<struct<"
                  "id:string,sku_channel_id:string,Date:string,SKU:string,Channel:string,Units:bigint,Revenue:double>>")


def payload_json(spark, sf_dir) -> DataFrame:
    """The publish payload's JSON documents read back: one row per channel of the
    summary record (chunk -1) and per report row of the data chunks, with its place."""
    rep = _report(Tables(spark, sf_dir))
    status = rep.groupBy("Channel").agg(F.date_format(F.max("Date"), "yyyy-MM-dd").alias("status"))
    doc = payload_records(rep, status, "sales", chunks=PAYLOAD_CHUNKS).select(
        "chunk", F.from_json("payload", PAYLOAD_SCHEMA).alias("doc"))
    data = doc.where("chunk >= 0").select("doc.*").select(
        "reportType", "chunk", "chunks", F.posexplode("reportData").alias("place", "row")).select(
        "reportType", "chunk", "chunks", "place", "row.*")
    summary = doc.where("chunk < 0").select(
        F.col("doc.reportType").alias("reportType"), "chunk", F.explode("doc.reportSummary").alias("Channel", "Date"))
    return data.unionByName(summary, allowMissingColumns=True)


QUERIES = {
    "sales_by_sku_channel": sales_by_sku_channel,
    "sales_report_zero_filled": sales_report_zero_filled,
    "sales_report_wide": sales_report_wide,
    "bundle_rows": bundle_rows,
    "unmapped_keys": unmapped_keys,
    "missing_skus_by_channel": missing_skus_by_channel,
    "status_substring_filter": status_substring_filter,
    "null_safe_not_equal": null_safe_not_equal,
    "status_exact_filter": status_exact_filter,
    "either_positive_filter": either_positive_filter,
    "membership_semi": membership_semi,
    "sku_suffix_normalize": sku_suffix_normalize,
    "row_wise_sum": row_wise_sum,
    "money_clean": money_clean,
    "coerce_number": coerce_number,
    "json_field": json_field_query,
    "json_items_explode": json_items_explode,
    "dict_lookup": dict_lookup,
    "reserve_clip": reserve_clip,
    "outer_merge_measures": outer_merge_measures,
    "chained_template": chained_template,
    "union_channels": union_channels,
    "channel_bucket": channel_bucket,
    "channel_dates": channel_dates_query,
    "surrogate_ids": surrogate_ids,
    "clip_with_offenders": clip_with_offenders,
    "negative_offenders": negative_offenders,
    "contract_violations": contract_violations,
    "report_contract": report_contract,
    "price_times_qty": price_times_qty,
    "shopify_orders_paid": shopify_orders_paid,
    "latest_per_prefix": latest_per_prefix_query,
    "combine_history": combine_history,
    "run_summary": run_summary_query,
    "reconcile_sources": reconcile_sources,
    "reconcile_totals": reconcile_totals_query,
    "parity_tolerance": parity_tolerance,
    "anomaly_trailing_7": anomaly_trailing_7,
    "idempotency_guard": idempotency_guard,
    "sku_trend": sku_trend,
    "rollup_totals": rollup_totals,
    "net_of_discounts": net_of_discounts,
    "landed_tiktok_fbt": landed_tiktok_fbt,
    "inventory_report_zero_filled": inventory_report_zero_filled,
    "inventory_offenders": inventory_offenders,
    "source_metrics": source_metrics,
    "payload_json": payload_json,
}
