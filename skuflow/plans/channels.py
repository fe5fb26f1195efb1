"""Channel report builders (C1–C18): raw report DataFrame -> canonical facts.

Inputs are all-string frames as the report scan produces them (see
``skuflow.sources.reports``). Sales builders return the long mapped form of
``skuflow.operators.mapping.map_sales`` (``SKU`` ``Bundles`` = original bundle
volume, NULL = unmapped volume); inventory builders return one row per template
SKU with ``Channel, SKU, Units, Inventory, Inbound``.

Each builder is a handful of built-in expressions, one pre-aggregation and at
most one mapping join; nothing is evaluated here.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skuflow.functions import (
    blank_to_null, clean_money, coerced, equals_ci, excludes_ci, not_equal_keep_null, number_or_null, parse_items, row_sum,
    to_number,
)
from skuflow.operators.mapping import map_sales, normalize_amazon_skus
from skuflow.operators.measures import assemble, clipped_difference
from skuflow.operators.quality import missing_columns

# Report column names, status values and channel buckets of the
# marketplace exports, as the reference reads them.
WALMART_SALES = {"sku": "SKU", "units": "Units_Sold", "revenue": "GMV"}
AMAZON_SALES = {"sku": "MSKU", "units": "Net units sold", "revenue": "Net sales"}
TIKTOK_SALES = {"sku": "SKU ID", "units": "Items sold", "revenue": "GMV"}
AMAZON_MARKETPLACE = "Amazon.com"
AMAZON_SHIPPED = "Shipped"
SHOPIFY_SALES = {"sku": "Product variant SKU", "channel": "Sales channel", "revenue": "Net sales",
                 "units": "Quantity ordered"}
SHOPIFY_DRAFT = "Draft Orders"
SHOPIFY_BUCKETS = {"TikTok": "TikTok Shopify", "Marketplace Connect": "Target", "Online Store": "Shopify",
                   "Shop": "Shopify", "Loop Subscriptions": "Shopify"}
SHOPIFY_BUCKET_DEFAULT = "Others"
#: Raw order exports name the source; compared lower-cased with - and blanks as _.
SHOPIFY_SOURCES = {"web": "Shopify", "online_store": "Shopify", "tiktok": "TikTok Shopify",
                   "marketplace_connect": "Target"}
SHOPIFY_ORDERS = {"status": "Financial Status", "sku": "Lineitem sku", "units": "Lineitem quantity",
                  "price": "Lineitem price", "source": "Source name"}
SHOPIFY_PAID = "paid"
WALMART_ORDERS = {"sku": "SKU", "units": "Quantity", "price": "Unit Price", "status": "Order Line Status"}
WALMART_ORDER_STATUSES = ("Acknowledged", "Shipped", "Delivered")
TIKTOK_ORDERS_COLUMNS = ["Order Status", "SKU ID", "Seller SKU", "Quantity", "Order Amount", "Fulfillment Type",
                         "Warehouse Name"]
TIKTOK_FBT_FULFILLMENT = "Fulfillment by TikTok Shop"
CANCEL_TOKEN = "cancel"
FBA = {"sku": "Merchant SKU", "units": "Units Sold Last 30 Days", "inventory": ["Available", "FC transfer"],
       "inbound": "Inbound"}
AWD = {"sku": "SKU", "inventory": "Available in AWD (units)", "inbound": "Inbound to AWD (units)"}
FBT_INVENTORY = {"sku": "Reference code", "inventory": "Available inventory", "inbound": "In Transit: Total Quantity"}
TPL_LEVELS = {"sku": "MSKU", "dtc": "DTC Total Quantity", "rs": "RS Total Quantity", "wip": "Ops WIP Quantity"}
TPL_ORDERS = {"status": "Order Status", "items": "Items"}
TPL_CANCELLED = "CANCELLED"
TPL_INBOUND = {"sku": "MSKU", "inbound": ["IN_TRANSIT_WITHIN_DELIVERR_UNDER_60_DAYS", "IN_TRANSIT_TO_DELIVERR"]}
WFS_INVENTORY = {"sku": "SKU", "inventory": "Available units", "inbound": "Inbound units"}


class MissingColumns(ValueError):
    pass


@dataclass(frozen=True)
class Columns:
    """What a builder reads of a raw frame (Q1): text, lenient numbers (F2), strict money (F1), and what may be absent."""

    text: tuple = ()
    numbers: tuple = ()
    money: tuple = ()
    optional: tuple = ()

    @property
    def required(self) -> list[str]:
        return [c for c in (*self.text, *self.numbers, *self.money) if c not in self.optional]


#: One contract per raw frame of the builders C1–C18; adapters of landed payloads fill the same columns.
COLUMNS = {
    "walmart_sales": Columns(("SKU",), ("Units_Sold",), ("GMV",)),
    "amazon_sales": Columns(("MSKU",), ("Net units sold",), ("Net sales",)),
    "tiktok_sales": Columns(("SKU ID",), ("Items sold",), ("GMV",)),
    "tiktok_shop_orders": Columns(("Order Status", "SKU ID"), ("Quantity",), ("SKU Subtotal After Discount",)),
    "amazon_orders": Columns(("sales-channel", "order-status", "sku"), ("quantity",), ("item-price",)),
    "shopify_sales": Columns(("Product variant SKU", "Sales channel"), ("Quantity ordered",), ("Net sales",)),
    "shopify_orders": Columns(("Financial Status", "Lineitem sku", "Source name"), ("Lineitem quantity",), ("Lineitem price",)),
    "walmart_orders": Columns(("SKU", "Order Line Status"), ("Quantity",), ("Unit Price",)),
    "tiktok_fbt_orders": Columns(("Order Status", "SKU ID", "Fulfillment Type"), ("Quantity",), ("Order Amount",),
                                 ("Fulfillment Type", "Quantity", "Order Amount")),
    "fba": Columns(("Merchant SKU",), ("Units Sold Last 30 Days", "Available", "FC transfer", "Inbound")),
    "awd": Columns(("SKU",), ("Available in AWD (units)", "Inbound to AWD (units)")),
    "fbt_inventory": Columns(("Reference code",), ("Available inventory", "In Transit: Total Quantity")),
    "tpl_levels": Columns(("MSKU",), ("DTC Total Quantity", "RS Total Quantity", "Ops WIP Quantity")),
    "tpl_orders": Columns(("Order Status", "Items")),
    "tpl_inbound": Columns(("MSKU",), ("IN_TRANSIT_WITHIN_DELIVERR_UNDER_60_DAYS", "IN_TRANSIT_TO_DELIVERR")),
    "wfs_sales": Columns(("SKU",), ("Units_Sold",)),
    "wfs_inventory": Columns(("SKU",), ("Available units", "Inbound units")),
}


def require(df: DataFrame, frame: str) -> None:
    """Q1: by the schema alone; a source that fails it yields no table."""
    missing = missing_columns(df, COLUMNS[frame].required)
    if missing:
        raise MissingColumns(f"{frame}: missing columns {missing}")


def coercions(frame: str, present: Sequence[str]) -> dict[str, Column]:
    """Q7: per number column, how many present cells are forced to 0."""
    return {c: F.coalesce(F.sum(coerced(c, number_or_null(c))), F.lit(0)) for c in COLUMNS[frame].numbers if c in present}


def _money(c) -> F.Column:
    return clean_money(c)


# --- sales ---------------------------------------------------------------------------------

def walmart_sales(raw: DataFrame) -> DataFrame:
    """SKU, Units, Revenue summed by SKU; no mapping, no bundles."""
    c = WALMART_SALES
    require(raw, "walmart_sales")
    return (raw.select(blank_to_null(c["sku"]).alias("SKU"), to_number(c["units"]).alias("Units"),
                       _money(c["revenue"]).alias("Revenue"))
            .where(F.col("SKU").isNotNull())
            .groupBy("SKU").agg(F.sum("Units").alias("Units"), F.sum("Revenue").alias("Revenue")))


def amazon_sales(raw: DataFrame, mapping: DataFrame):
    """Business-report sales through the Amazon map (M1)."""
    c = AMAZON_SALES
    require(raw, "amazon_sales")
    facts = raw.select(F.col(c["sku"]).alias("k"), to_number(c["units"]).alias("q"), _money(c["revenue"]).alias("r"))
    return map_sales(facts, mapping, "k", "q", "r")


def tiktok_sales(raw: DataFrame, mapping: DataFrame):
    """Product sales report (header/delimiter sniffed by the scan)."""
    c = TIKTOK_SALES
    require(raw, "tiktok_sales")
    facts = raw.select(F.col(c["sku"]).alias("k"), to_number(c["units"]).alias("q"), _money(c["revenue"]).alias("r"))
    return map_sales(facts, mapping, "k", "q", "r")


def tiktok_shop_orders(raw: DataFrame, mapping: DataFrame):
    """C4: all fulfillment types, cancelled dropped, revenue = SKU subtotal after discount."""
    require(raw, "tiktok_shop_orders")
    kept = raw.where(excludes_ci("Order Status", CANCEL_TOKEN))
    facts = kept.select(F.col("SKU ID").alias("k"), to_number("Quantity").alias("q"),
                        _money("SKU Subtotal After Discount").alias("r"))
    return map_sales(facts, mapping, "k", "q", "r")


def amazon_orders(raw: DataFrame, mapping: DataFrame):
    """Amazon.com marketplace, Shipped only (Pending excluded by choice, L22);
    ``item-price`` is already the line total."""
    require(raw, "amazon_orders")
    kept = raw.where(F.col("sales-channel") == AMAZON_MARKETPLACE).where(F.col("order-status") == AMAZON_SHIPPED)
    facts = kept.select(F.col("sku").alias("k"), to_number("quantity").alias("q"), _money("item-price").alias("r"))
    return map_sales(facts, mapping, "k", "q", "r")


def bucket_channel(c, buckets: dict[str, str] = SHOPIFY_BUCKETS, default: str = SHOPIFY_BUCKET_DEFAULT) -> F.Column:
    """Sales-channel name -> reporting channel; unknown or NULL -> default."""
    col = F.col(c) if isinstance(c, str) else c
    expr = None
    for name, bucket in buckets.items():
        expr = (F.when(col == name, bucket) if expr is None else expr.when(col == name, bucket))
    return expr.otherwise(default) if expr is not None else F.lit(default)


def shopify_sales(raw: DataFrame, mapping: DataFrame, buckets: dict[str, str] = SHOPIFY_BUCKETS):
    """Draft Orders dropped (NULL channel kept, P4), net > 0 or qty > 0 (P8),
    channel bucketed (P13), mapped and summed by (Channel, SKU)."""
    c = SHOPIFY_SALES
    require(raw, "shopify_sales")
    net, qty = _money(c["revenue"]), to_number(c["units"])
    kept = raw.where(not_equal_keep_null(c["channel"], SHOPIFY_DRAFT)).where((net > 0) | (qty > 0))
    facts = kept.select(F.col(c["sku"]).alias("k"), bucket_channel(c["channel"], buckets).alias("Channel"),
                        qty.alias("q"), _money(c["revenue"]).alias("r"))
    return map_sales(facts, mapping, "k", "q", "r", by=["Channel"])


def shopify_orders(raw: DataFrame, mapping: DataFrame, buckets: dict[str, str] = SHOPIFY_SOURCES):
    """Paid orders; Revenue = line price × quantity; channel from the source name."""
    c = SHOPIFY_ORDERS
    require(raw, "shopify_orders")
    kept = raw.where(F.col(c["status"]) == SHOPIFY_PAID)
    qty = to_number(c["units"], "decimal(18,4)")
    source = F.regexp_replace(F.lower(F.trim(c["source"])), "[- ]+", "_")
    facts = kept.select(F.col(c["sku"]).alias("k"), bucket_channel(source, buckets).alias("Channel"),
                        to_number(c["units"]).alias("q"), (_money(c["price"]) * qty).alias("r"))
    return map_sales(facts, mapping, "k", "q", "r", by=["Channel"])


def walmart_orders(raw: DataFrame, statuses: Sequence[str] = WALMART_ORDER_STATUSES) -> DataFrame:
    """Allow-listed line statuses (L20); Revenue = Quantity × Unit Price; by SKU."""
    c = WALMART_ORDERS
    require(raw, "walmart_orders")
    kept = raw.where(F.col(c["status"]).isin(list(statuses)))
    qty = to_number(c["units"], "decimal(18,4)")
    return (kept.select(blank_to_null(c["sku"]).alias("SKU"), to_number(c["units"]).alias("Units"),
                        (_money(c["price"]) * qty).alias("Revenue"))
            .where(F.col("SKU").isNotNull())
            .groupBy("SKU").agg(F.sum("Units").alias("Units"), F.sum("Revenue").alias("Revenue")))


def tiktok_fbt_orders(raw: DataFrame, mapping: DataFrame):
    """Lenient projection, cancelled dropped, Fulfillment by TikTok Shop only,
    revenue = order amount; mapped like every marketplace source."""
    require(raw, "tiktok_fbt_orders")
    df = raw.select(*[c for c in TIKTOK_ORDERS_COLUMNS if c in raw.columns])
    fulfil = F.col("Fulfillment Type") if "Fulfillment Type" in df.columns else F.lit("")
    kept = df.where(excludes_ci("Order Status", CANCEL_TOKEN)).where(equals_ci(fulfil, TIKTOK_FBT_FULFILLMENT))
    qty = to_number("Quantity") if "Quantity" in df.columns else F.lit(0.0)
    amt = _money("Order Amount") if "Order Amount" in df.columns else F.lit(0).cast("decimal(18,4)")
    facts = kept.select(F.col("SKU ID").alias("k"), qty.alias("q"), amt.alias("r"))
    return map_sales(facts, mapping, "k", "q", "r")


# --- inventory -----------------------------------------------------------------------------

def _on_template(template: DataFrame, parsed: DataFrame, channel: str, uncast: bool = False) -> DataFrame:
    """J1 + P12 + P14: master SKU template ⟕ parsed measures, constant channel, 0-filled.
    ``uncast`` leaves fractions of a unit in, for the report contract to refuse (Q3, Q4)."""
    t = template.select(F.col("SKU").cast("string").alias("SKU"))
    out = t.join(parsed, "SKU", "left")
    metrics = ["Units", "Inventory", "Inbound"]
    return out.select(F.lit(channel).alias("Channel"), "SKU",
                      *[F.coalesce(F.col(m) if m in parsed.columns else F.lit(None), F.lit(0))
                        .cast("double" if uncast else "long").alias(m) for m in metrics])


def fba(raw: DataFrame, allowed: DataFrame, template: DataFrame, uncast: bool = False) -> DataFrame:
    """M5 on the merchant SKU; Inventory = Available + FC transfer."""
    c = FBA
    require(raw, "fba")
    parsed = normalize_amazon_skus(raw, c["sku"], allowed,
                                   {"Units": c["units"], "Inventory": c["inventory"], "Inbound": c["inbound"]}, uncast)
    return _on_template(template, parsed, "FBA", uncast)


def awd(raw: DataFrame, allowed: DataFrame, template: DataFrame, uncast: bool = False) -> DataFrame:
    """M5 on SKU; no sales in this report (Units = 0)."""
    c = AWD
    require(raw, "awd")
    parsed = normalize_amazon_skus(raw, c["sku"], allowed, {"Inventory": c["inventory"], "Inbound": c["inbound"]}, uncast)
    return _on_template(template, parsed, "AWD", uncast)


def fbt_inventory(raw: DataFrame) -> DataFrame:
    """C11: SKU, Inventory, Inbound summed across warehouses (key trimmed first, L13)."""
    c = FBT_INVENTORY
    require(raw, "fbt_inventory")
    return (raw.select(blank_to_null(c["sku"]).alias("SKU"), to_number(c["inventory"]).alias("Inventory"),
                       to_number(c["inbound"]).alias("Inbound"))
            .where(F.col("SKU").isNotNull())
            .groupBy("SKU").agg(F.sum("Inventory").alias("Inventory"), F.sum("Inbound").alias("Inbound")))


def fbt(inventory_raw: DataFrame, orders_raw: DataFrame | None, mapping: DataFrame, template: DataFrame,
        uncast: bool = False) -> DataFrame:
    """FBT inventory with Units from FBT-fulfilled TikTok orders (0 when absent)."""
    inv = fbt_inventory(inventory_raw)
    if orders_raw is not None:
        units = tiktok_fbt_orders(orders_raw, mapping).sales.select("SKU", "Units")
        inv = inv.join(units, "SKU", "full")
    return _on_template(template, inv, "FBT", uncast)


def three_pl(levels_raw: DataFrame, orders_raw: DataFrame, inbound_raw: DataFrame | None,
             dsku_dim: DataFrame, template: DataFrame, strict_items: bool = True, uncast: bool = False) -> DataFrame:
    """C14–C17: DTC and Reserve rows.

    DTC: Inventory = Σ DTC quantity, Units = Σ item qty of non-cancelled orders
    (items JSON exploded, DSKU looked up), Inbound = Σ two in-transit columns.
    Reserve: Inventory = max(0, Σ RS − Σ Ops WIP); Units = Inbound = 0.
    The three DTC measures are folded with one union + group-by (J3).
    """
    lv, od = TPL_LEVELS, TPL_ORDERS
    require(levels_raw, "tpl_levels")
    require(orders_raw, "tpl_orders")
    if inbound_raw is not None:
        require(inbound_raw, "tpl_inbound")
    t = template.select(F.col("SKU").cast("string").alias("SKU"))
    levels = (levels_raw.select(F.col(lv["sku"]).cast("string").alias("SKU"), to_number(lv["dtc"]).alias("dtc"),
                                to_number(lv["rs"]).alias("rs"), to_number(lv["wip"]).alias("wip"))
              .join(t, "SKU", "left_semi")
              .groupBy("SKU").agg(F.sum("dtc").alias("dtc"), F.sum("rs").alias("rs"), F.sum("wip").alias("wip")))
    units = order_item_units(orders_raw, dsku_dim, od["status"], od["items"], strict_items)
    measures = {"Inventory": levels.select("SKU", F.col("dtc").alias("value")),
                "Units": units.select("SKU", F.col("Units").alias("value"))}
    if inbound_raw is not None:
        ib = TPL_INBOUND
        inbound = (inbound_raw.select(F.col(ib["sku"]).cast("string").alias("SKU"),
                                      row_sum(*[to_number(x) for x in ib["inbound"]]).alias("value"))
                   .join(t, "SKU", "left_semi"))
        measures["Inbound"] = inbound
    dtc = assemble(t, measures)
    dtc = _on_template(t, dtc, "DTC", uncast)
    reserve = _on_template(t, levels.select("SKU", clipped_difference("rs", "wip").alias("Inventory")), "Reserve", uncast)
    return dtc.unionByName(reserve)


def order_item_units(orders_raw: DataFrame, dsku_dim: DataFrame, status: str = "Order Status",
                     items: str = "Items", strict: bool = True) -> DataFrame:
    """Non-cancelled orders (NULL status kept, P4) -> items JSON (F15) ->
    one row per item (F16) -> DSKU looked up (J5; unknown dropped) -> Σ qty by SKU.
    Item quantities are summed per DSKU before the lookup join (A3), so the join
    sees one row per DSKU rather than one per item."""
    kept = orders_raw.where(not_equal_keep_null(status, TPL_CANCELLED))
    # explode_outer + NULL filter: an inner explode makes Spark infer a
    # size(...) > 0 filter that is pushed below the parse and parses twice
    item = kept.select(F.explode_outer(parse_items(items, strict)).alias("it")).where(F.col("it").isNotNull())
    per_dsku = (item.select(F.col("it.dsku").alias("dsku"), to_number("it.qty").cast("long").alias("qty"))
                .where(F.col("dsku").isNotNull())
                .groupBy("dsku").agg(F.sum("qty").alias("qty")))
    return (per_dsku.join(dsku_dim.select("dsku", "SKU"), "dsku", "inner")
            .groupBy("SKU").agg(F.sum("qty").alias("Units")))


def wfs(sales_raw: DataFrame, inventory_raw: DataFrame, template: DataFrame, uncast: bool = False) -> DataFrame:
    """Walmart sales units (by SKU) full-joined with WFS inventory; the
    inventory side is aggregated too (L12), so duplicate SKUs cannot fan out."""
    c = WFS_INVENTORY
    require(sales_raw, "wfs_sales")
    require(inventory_raw, "wfs_inventory")
    sales = (sales_raw.select(blank_to_null(WALMART_SALES["sku"]).alias("SKU"),
                              to_number(WALMART_SALES["units"]).alias("Units"))
             .where(F.col("SKU").isNotNull()).groupBy("SKU").agg(F.sum("Units").alias("Units")))
    inv = (inventory_raw.select(blank_to_null(c["sku"]).alias("SKU"), to_number(c["inventory"]).alias("Inventory"),
                                to_number(c["inbound"]).alias("Inbound"))
           .where(F.col("SKU").isNotNull())
           .groupBy("SKU").agg(F.sum("Inventory").alias("Inventory"), F.sum("Inbound").alias("Inbound")))
    return _on_template(template, sales.join(inv, "SKU", "full"), "WFS", uncast)
