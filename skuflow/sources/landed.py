"""Landed API payloads -> the raw report columns the channel builders read.

Each platform response is a JSON document with nested arrays. A payload table
is read with an explicit schema (``read_landed``) or parsed from a string column
(``parse_landed``); the flatteners below only use ``explode``, nested field
access and higher-order functions, then rename to the CSV column names so the
same C-builders apply unchanged.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skuflow.plans.channels import COLUMNS, WALMART_ORDER_STATUSES, require

# Payload schemas of the documented platform responses.
TPL_LEVELS_DOC = ("items array<struct<logisticsSku:string,merchantSku:string,dtcTotalQuantity:bigint,"
                       "rsTotalQuantity:bigint,opsWipQuantity:bigint,inTransitQuantity:bigint>>")
TPL_ORDERS_DOC = ("orders array<struct<createdAt:string,orderStatus:string,"
                       "items:array<struct<dsku:string,qty:bigint>>>>")
FBA_DOC = ("inventorySummaries array<struct<sellerSku:string,inventoryDetails:struct<fulfillableQuantity:bigint,"
           "reservedQuantity:struct<fcProcessingQuantity:bigint>,inboundWorkingQuantity:bigint,"
           "inboundShippedQuantity:bigint,inboundReceivingQuantity:bigint>>>")
AWD_DOC = ("inventory array<struct<sku:string,inventoryDetails:struct<availableQuantity:struct<amount:bigint>,"
           "inboundQuantity:struct<amount:bigint>>>>")
WALMART_ORDERS_DOC = ("orders array<struct<purchaseOrderId:string,orderLines:array<struct<sku:string,status:string,"
                      "orderLineQuantity:struct<amount:string>,"
                      "charges:array<struct<chargeType:string,chargeAmount:struct<amount:decimal(18,4)>>>>>>>")
WALMART_INVENTORY_DOC = "inventory array<struct<sku:string,availableToSellQty:bigint,inboundQty:bigint>>"
TIKTOK_ORDERS_DOC = ("data struct<orders:array<struct<order_id:string,order_status:int,fulfillment_type:string,"
                     "line_items:array<struct<sku_id:string,seller_sku:string,quantity:bigint>>,"
                     "payment:struct<total_amount:string>>>>")
TIKTOK_INVENTORY_DOC = ("data struct<inventories:array<struct<seller_sku:string,available_quantity:bigint,"
                        "in_transit_quantity:bigint>>>")
SHOPIFY_ORDERS_DOC = ("orders array<struct<id:string,source_name:string,financial_status:string,"
                      "line_items:array<struct<sku:string,quantity:bigint,price:string,"
                      "discount_allocations:array<struct<amount:string>>>>>>")

# TikTok order status codes and fulfillment type, and the Shopify
# API source names with the report's sales-channel names they correspond to.
TIKTOK_CANCELLED_CODE = 140
TIKTOK_FBT_TYPE = "TIKTOK_FULFILLMENT"
SHOPIFY_SOURCE_TO_CHANNEL = {
    "web": "Online Store",
    "shop_app": "Shop",
    "shop": "Shop",
    "subscription_contract": "Loop Subscriptions",
    "tiktok": "TikTok",
    "marketplace-connect": "Marketplace Connect",
    "marketplace_connect": "Marketplace Connect",
}


def _each(doc: DataFrame, array_col, alias: str, *keep) -> DataFrame:
    """One row per array element. ``explode_outer`` + an explicit NULL filter is
    used instead of ``explode`` because the filter Spark infers for an inner
    explode (``size(arr) > 0``) is pushed below the parse and would evaluate the
    JSON parse again for every consumer."""
    col = F.col(array_col) if isinstance(array_col, str) else array_col
    return doc.select(*keep, F.explode_outer(col).alias(alias)).where(F.col(alias).isNotNull())


def conform(df: DataFrame, frame: str, fill: tuple = ()) -> DataFrame:
    """``df`` with every column that the builder of ``frame`` declares (Q1).

    A payload that lacks a column must say so: names in ``fill`` become NULL, any other missing
    column raises MissingColumns.
    """
    known = df.withColumns({c: F.lit(None).cast("string") for c in fill if c not in df.columns})
    require(known, frame)
    return known


def read_landed(spark: SparkSession, path: str, schema: str, multiline: bool = True) -> DataFrame:
    return spark.read.option("multiLine", multiline).schema(schema).json(path)


def parse_landed(df: DataFrame, column: str, schema: str) -> DataFrame:
    """Payload documents stored as strings -> typed columns (PERMISSIVE)."""
    return df.select(F.from_json(column, schema).alias("_doc")).select("_doc.*")


def tpl_levels(doc: DataFrame) -> DataFrame:
    """D5 -> C14 columns."""
    it = _each(doc, "items", "i")
    return it.select(F.col("i.merchantSku").alias("MSKU"), F.col("i.logisticsSku").alias("DSKU"),
                     F.col("i.dtcTotalQuantity").alias("DTC Total Quantity"),
                     F.col("i.rsTotalQuantity").alias("RS Total Quantity"),
                     F.col("i.opsWipQuantity").alias("Ops WIP Quantity"),
                     F.col("i.inTransitQuantity").alias("In Transit Quantity"))


def tpl_orders(doc: DataFrame) -> DataFrame:
    """D6 -> C15 columns; items stay an array of (dsku, qty) — re-serialized so the
    order builder's JSON parse applies unchanged."""
    o = _each(doc, "orders", "o")
    return o.select(F.col("o.createdAt").alias("CREATEDAT"), F.col("o.orderStatus").alias("Order Status"),
                    F.to_json("o.items").alias("Items"))


def _zero(c: str) -> Column:
    return F.coalesce(F.col(c), F.lit(0))


def fba_inventory(doc: DataFrame) -> DataFrame:
    """D7 -> C9 frame: Inbound = working + shipped + receiving; the payload has no units sold."""
    s = _each(doc, "inventorySummaries", "s")
    d = "s.inventoryDetails"
    return conform(s.select(F.col("s.sellerSku").alias("Merchant SKU"),
                            _zero(f"{d}.fulfillableQuantity").alias("Available"),
                            _zero(f"{d}.reservedQuantity.fcProcessingQuantity").alias("FC transfer"),
                            (_zero(f"{d}.inboundWorkingQuantity") + _zero(f"{d}.inboundShippedQuantity")
                             + _zero(f"{d}.inboundReceivingQuantity")).alias("Inbound")),
                   "fba", fill=("Units Sold Last 30 Days",))


def awd_inventory(doc: DataFrame) -> DataFrame:
    """D7 -> C10 frame."""
    s = _each(doc, "inventory", "s")
    return conform(s.select(F.col("s.sku").alias("SKU"),
                            _zero("s.inventoryDetails.availableQuantity.amount").alias("Available in AWD (units)"),
                            _zero("s.inventoryDetails.inboundQuantity.amount").alias("Inbound to AWD (units)")), "awd")


def walmart_lines(doc: DataFrame) -> DataFrame:
    """Order lines with their quantity and GMV = Σ PRODUCT charges."""
    orders = _each(doc, "orders", "o")
    lines = _each(orders, "o.orderLines", "l", F.col("o.purchaseOrderId").alias("po"))
    product = F.filter("l.charges", lambda ch: ch["chargeType"] == "PRODUCT")
    gmv = F.aggregate(product, F.lit(0).cast("decimal(38,4)"),
                      lambda acc, ch: (acc + F.coalesce(ch["chargeAmount"]["amount"], F.lit(0))).cast("decimal(38,4)"))
    return lines.select(F.col("po").alias("Purchase Order ID"), F.col("l.sku").alias("SKU"),
                        F.col("l.orderLineQuantity.amount").alias("Quantity"), gmv.alias("GMV"),
                        F.col("l.status").alias("Order Line Status"))


def walmart_orders(doc: DataFrame) -> DataFrame:
    """D8 -> C8 frame: a line's unit price is its GMV per unit, to the four decimals that money carries."""
    qty = F.col("Quantity").try_cast("decimal(18,4)")
    price = F.when(qty != 0, (F.col("GMV").cast("decimal(18,4)") / qty).cast("decimal(18,4)")).otherwise(0)
    return conform(walmart_lines(doc).withColumn("Unit Price", price), "walmart_orders")


def walmart_sales(doc: DataFrame) -> DataFrame:
    """D8 -> C1 and C18 frame: units and GMV of the lines that count as sold."""
    sold = walmart_lines(doc).where(F.col("Order Line Status").isin(*WALMART_ORDER_STATUSES))
    return conform(sold.select("SKU", F.col("Quantity").alias("Units_Sold"), F.col("GMV").cast("decimal(18,4)").alias("GMV")),
                   "walmart_sales")


def walmart_inventory(doc: DataFrame) -> DataFrame:
    """D8 -> C18 inventory frame."""
    s = _each(doc, "inventory", "s")
    return conform(s.select(F.col("s.sku").alias("SKU"), F.col("s.availableToSellQty").alias("Available units"),
                            F.col("s.inboundQty").alias("Inbound units")), "wfs_inventory")


def tiktok_orders(doc: DataFrame) -> DataFrame:
    """D9 -> C13/C4 columns: one row per line item; status code 140 is cancelled."""
    o = _each(doc, "data.orders", "o")
    li = _each(o, "o.line_items", "li", "o")
    status = F.when(F.col("o.order_status") == TIKTOK_CANCELLED_CODE, "Cancelled").otherwise(
        F.col("o.order_status").cast("string"))
    fulfil = F.when(F.col("o.fulfillment_type") == TIKTOK_FBT_TYPE, "Fulfillment by TikTok Shop").otherwise(
        F.col("o.fulfillment_type"))
    return li.select(F.col("o.order_id").alias("Order ID"), status.alias("Order Status"),
                     F.col("li.sku_id").alias("SKU ID"), F.col("li.seller_sku").alias("Seller SKU"),
                     F.col("li.quantity").alias("Quantity"), F.col("o.payment.total_amount").alias("Order Amount"),
                     fulfil.alias("Fulfillment Type"))


def tiktok_inventory(doc: DataFrame) -> DataFrame:
    """D9 -> C11 columns."""
    s = _each(doc, "data.inventories", "s")
    return s.select(F.col("s.seller_sku").alias("Reference code"),
                    F.col("s.available_quantity").alias("Available inventory"),
                    F.col("s.in_transit_quantity").alias("In Transit: Total Quantity"))


def shopify_orders(doc: DataFrame) -> DataFrame:
    """D10 -> C6 columns: net = quantity × price − Σ discount allocations, rounded
    half-even to cents (F13); lines with zero quantity and zero net are dropped; the API source
    name becomes the report's sales-channel name (unknown/NULL kept as is and
    bucketed to Others by C6)."""
    o = _each(doc, "orders", "o")
    li = _each(o, "o.line_items", "li", F.col("o.source_name").alias("src"))
    money = "decimal(38,4)"
    discounts = F.aggregate("li.discount_allocations", F.lit(0).cast(money),
                            lambda acc, d: (acc + F.coalesce(d["amount"].cast(money), F.lit(0))).cast(money))
    qty = F.coalesce(F.col("li.quantity"), F.lit(0))
    net = F.bround(qty.cast(money) * F.coalesce(F.col("li.price").cast(money), F.lit(0)) - discounts, 2)
    channel = None
    for src, name in SHOPIFY_SOURCE_TO_CHANNEL.items():
        hit = F.lower("src") == src
        channel = F.when(hit, name) if channel is None else channel.when(hit, name)
    out = li.select(channel.otherwise(F.col("src")).alias("Sales channel"),
                    F.coalesce(F.col("li.sku"), F.lit("")).alias("Product variant SKU"),
                    qty.alias("Quantity ordered"), net.alias("Net sales"))
    return out.where(~((F.col("Quantity ordered") == 0) & (F.col("Net sales") == 0)))
