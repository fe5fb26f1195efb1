"""The channel builders C1–C5, C9–C12, C14, C16 and C17 on raw frames with their real headers.

The raw frames are derived from the warehouse tables (an order line is a report row, text
cells as the exports carry them), so every builder runs over whole tables. Each query has
its DuckDB SQL beside it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skuflow.plans import channels as C
from skuflow.plans.oracle import BUNDLES, JOINED, KEYED, MAPPING, SALES, _with
from skuflow.plans.warehouse import Tables, catalog_template, dsku_dim, master_skus, order_documents, part_mapping

# The cells that the order status and priority become in the raw frames.
SHOP_STATUS = {"P": "Cancelled", "O": "To ship", "F": "Completed"}
AMAZON_STATUS = {"P": "Pending", "O": "Cancelled", "F": "Shipped"}
AMAZON_PRIORITIES = ("1-URGENT", "2-HIGH")
FULFILLED = "3-MEDIUM"


def _lookup(column: str, cells: dict[str, str]):
    return F.create_map(*(F.lit(x) for pair in cells.items() for x in pair))[F.col(column)]


def _text(column: str):
    return F.col(column).cast("string")


def _money_text(column: str):
    return F.concat(F.lit("$"), F.format_number(F.col(column).cast("decimal(18,2)"), 2))


def _lines(t: Tables) -> DataFrame:
    return t.lineitem.join(t.orders.select("o_orderkey", "o_orderstatus", "o_orderpriority"),
                           F.col("l_orderkey") == F.col("o_orderkey"))


def _volume(m) -> DataFrame:
    """SKU volume and the original volume of bundles."""
    return m.long.where(F.col("SKU").isNotNull()).select("SKU", "Units", F.col("Revenue").cast("double").alias("Revenue"))


def walmart_sales(spark, sf_dir) -> DataFrame:
    """Units and formatted money per SKU."""
    raw = Tables(spark, sf_dir).lineitem.select(
        _text("l_partkey").alias("SKU"), _text("l_quantity").alias("Units_Sold"), _money_text("l_extendedprice").alias("GMV"))
    return C.walmart_sales(raw).select("SKU", "Units", F.col("Revenue").cast("double").alias("Revenue"))


def amazon_sales(spark, sf_dir) -> DataFrame:
    """Business report, returned lines left out."""
    t = Tables(spark, sf_dir)
    raw = t.lineitem.where(F.col("l_returnflag") != "R").select(
        _text("l_partkey").alias("MSKU"), _text("l_quantity").alias("Net units sold"),
        _money_text("l_extendedprice").alias("Net sales"))
    return _volume(C.amazon_sales(raw, part_mapping(t)))


def tiktok_sales(spark, sf_dir) -> DataFrame:
    """Product report, open lines."""
    t = Tables(spark, sf_dir)
    raw = t.lineitem.where(F.col("l_linestatus") == "O").select(
        _text("l_partkey").alias("SKU ID"), _text("l_quantity").alias("Items sold"), _money_text("l_extendedprice").alias("GMV"))
    return _volume(C.tiktok_sales(raw, part_mapping(t)))


def tiktok_shop_orders(spark, sf_dir) -> DataFrame:
    """C4: cancelled orders dropped by their status text."""
    t = Tables(spark, sf_dir)
    raw = _lines(t).select(
        _lookup("o_orderstatus", SHOP_STATUS).alias("Order Status"), _text("l_partkey").alias("SKU ID"),
        _text("l_quantity").alias("Quantity"), _money_text("l_extendedprice").alias("SKU Subtotal After Discount"))
    return _volume(C.tiktok_shop_orders(raw, part_mapping(t)))


def amazon_orders(spark, sf_dir) -> DataFrame:
    """Shipped lines of the marketplace."""
    t = Tables(spark, sf_dir)
    place = F.when(F.col("o_orderpriority").isin(*AMAZON_PRIORITIES), C.AMAZON_MARKETPLACE).otherwise("Non-Amazon")
    raw = _lines(t).select(
        place.alias("sales-channel"), _lookup("o_orderstatus", AMAZON_STATUS).alias("order-status"),
        _text("l_partkey").alias("sku"), _text("l_quantity").alias("quantity"), _text("l_extendedprice").alias("item-price"))
    return _volume(C.amazon_orders(raw, part_mapping(t)))


def _allowed(t: Tables) -> DataFrame:
    return t.part.where(F.col("p_size") < 40).select(_merchant_sku().alias("SKU")).distinct()


def _merchant_sku():
    return F.when(F.col("p_type") == "PROMO", F.concat("p_brand", F.lit("s"))).otherwise(F.col("p_brand"))


def fba_inventory(spark, sf_dir) -> DataFrame:
    """Merchant SKUs on the allow-list, inventory of two columns, numbers such as ``40.0``."""
    t = Tables(spark, sf_dir)
    raw = t.part.select(
        _merchant_sku().alias("Merchant SKU"), F.concat(_text("p_size"), F.lit(".0")).alias("Units Sold Last 30 Days"),
        F.floor("p_retailprice").cast("string").alias("Available"), _text("p_size").alias("FC transfer"),
        (F.col("p_size") * 2).cast("string").alias("Inbound"))
    return C.fba(raw, _allowed(t), master_skus(t))


def awd_inventory(spark, sf_dir) -> DataFrame:
    """No sales in the report."""
    t = Tables(spark, sf_dir)
    raw = t.part.select(_merchant_sku().alias("SKU"), F.floor("p_retailprice").cast("string").alias("Available in AWD (units)"),
                        _text("p_size").alias("Inbound to AWD (units)"))
    return C.awd(raw, _allowed(t), master_skus(t))


def fbt_inventory(spark, sf_dir) -> DataFrame:
    """C11 + C12: stock summed over warehouses, units from orders that the marketplace fulfils."""
    t = Tables(spark, sf_dir)
    stock = t.part.select(
        F.concat(F.lit(" "), "p_brand").alias("Reference code"), _text("p_size").alias("Available inventory"),
        F.floor("p_retailprice").cast("string").alias("In Transit: Total Quantity"))
    kind = F.when(F.col("o_orderpriority") == FULFILLED, C.TIKTOK_FBT_FULFILLMENT).otherwise("Fulfillment by seller")
    orders = _lines(t).select(
        _lookup("o_orderstatus", SHOP_STATUS).alias("Order Status"), _text("l_partkey").alias("SKU ID"),
        _text("l_quantity").alias("Quantity"), _text("l_extendedprice").alias("Order Amount"), kind.alias("Fulfillment Type"))
    return C.fbt(stock, orders, part_mapping(t), master_skus(t))


def three_pl(spark, sf_dir) -> DataFrame:
    """C14–C17: levels, order items, inbound and reserve of the warehouse provider."""
    t = Tables(spark, sf_dir)

    def flagged(flag: str):
        return F.when(F.col("l_returnflag") == flag, F.col("l_quantity")).otherwise(0).cast("string")

    levels = t.lineitem.select(
        _text("l_partkey").alias("MSKU"), flagged("A").alias("DTC Total Quantity"), flagged("N").alias("RS Total Quantity"),
        flagged("R").alias("Ops WIP Quantity"))
    item = F.struct(_text("l_partkey").alias("dsku"), F.col("l_quantity").cast("long").alias("qty"))
    status = F.when(F.col("o_orderstatus") == "P", C.TPL_CANCELLED).alias("Order Status")
    orders = order_documents(t.lineitem, t.orders.select("o_orderkey", status), item).select(
        "Order Status", F.to_json("items").alias("Items"))
    first, second = C.TPL_INBOUND["inbound"]
    inbound = t.part.select(_text("p_partkey").alias("MSKU"), _text("p_size").alias(first), F.lit("1").alias(second))
    dskus = dsku_dim(t).select("dsku", F.col("dsku").alias("SKU"))
    return C.three_pl(levels, orders, inbound, dskus, catalog_template(t))


def _mapped_sql(where: str, orders: bool = True) -> str:
    source = "lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey" if orders else "lineitem l"
    lines = f"""lines AS (SELECT cast(l.l_partkey AS VARCHAR) AS source_key, 'all' AS channel, DATE '1970-01-01' AS d,
  l.l_quantity AS q, cast(l.l_extendedprice AS DECIMAL(18,2)) AS r FROM {source} WHERE {where})"""
    return _with(lines, KEYED, MAPPING, JOINED, SALES, BUNDLES) + """SELECT sku AS "SKU", units AS "Units",
  cast(revenue AS DOUBLE) AS "Revenue" FROM sales UNION ALL SELECT 'Bundles', units, cast(revenue AS DOUBLE) FROM bund"""


_MERCHANT = "CASE WHEN p_type = 'PROMO' THEN p_brand || 's' ELSE p_brand END"
_STRIPPED = f"""raw AS (SELECT {_MERCHANT} AS k, p_size, cast(floor(p_retailprice) AS BIGINT) AS price FROM part),
allowed AS (SELECT DISTINCT {_MERCHANT} AS k FROM part WHERE p_size < 40),
p AS (SELECT regexp_replace(k, 's$', '') AS sku, sum(p_size) AS size, sum(price) AS price FROM raw
      WHERE k IN (SELECT k FROM allowed) GROUP BY 1),
t AS (SELECT DISTINCT p_brand AS sku FROM part)"""

QUERIES = {
    "walmart_sales": walmart_sales, "amazon_sales": amazon_sales, "tiktok_sales": tiktok_sales,
    "tiktok_shop_orders": tiktok_shop_orders, "amazon_orders": amazon_orders, "fba_inventory": fba_inventory,
    "awd_inventory": awd_inventory, "fbt_inventory": fbt_inventory, "three_pl": three_pl,
}

SQL = {
    "walmart_sales": """SELECT cast(l_partkey AS VARCHAR) AS "SKU", sum(l_quantity) AS "Units",
  cast(sum(cast(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS "Revenue" FROM lineitem GROUP BY 1""",
    "amazon_sales": _mapped_sql("l.l_returnflag <> 'R'", orders=False),
    "tiktok_sales": _mapped_sql("l.l_linestatus = 'O'", orders=False),
    "tiktok_shop_orders": _mapped_sql("o.o_orderstatus IS DISTINCT FROM 'P'"),
    "amazon_orders": _mapped_sql("o.o_orderstatus = 'F' AND o.o_orderpriority IN ('1-URGENT', '2-HIGH')"),
    "fba_inventory": _with(_STRIPPED) + """SELECT 'FBA' AS "Channel", t.sku AS "SKU", cast(coalesce(size, 0) AS BIGINT) AS "Units",
  cast(coalesce(price + size, 0) AS BIGINT) AS "Inventory", cast(coalesce(2 * size, 0) AS BIGINT) AS "Inbound"
FROM t LEFT JOIN p ON p.sku = t.sku""",
    "awd_inventory": _with(_STRIPPED) + """SELECT 'AWD' AS "Channel", t.sku AS "SKU", cast(0 AS BIGINT) AS "Units",
  cast(coalesce(price, 0) AS BIGINT) AS "Inventory", cast(coalesce(size, 0) AS BIGINT) AS "Inbound"
FROM t LEFT JOIN p ON p.sku = t.sku""",
    "fbt_inventory": _mapped_sql("o.o_orderstatus IS DISTINCT FROM 'P' AND o.o_orderpriority = '3-MEDIUM'").split("SELECT sku AS")[0]
    + """, inv AS (SELECT p_brand AS sku, sum(p_size) AS inv, sum(cast(floor(p_retailprice) AS BIGINT)) AS inb FROM part GROUP BY 1)
SELECT 'FBT' AS "Channel", inv.sku AS "SKU", cast(trunc(coalesce(sales.units, 0)) AS BIGINT) AS "Units",
  cast(inv.inv AS BIGINT) AS "Inventory", cast(inv.inb AS BIGINT) AS "Inbound"
FROM inv LEFT JOIN sales ON sales.sku = inv.sku""",
    "three_pl": """WITH lv AS (SELECT l_partkey AS k, sum(CASE WHEN l_returnflag = 'A' THEN l_quantity ELSE 0 END) AS dtc,
  sum(CASE WHEN l_returnflag = 'N' THEN l_quantity ELSE 0 END) AS rs,
  sum(CASE WHEN l_returnflag = 'R' THEN l_quantity ELSE 0 END) AS wip FROM lineitem GROUP BY 1),
u AS (SELECT l_partkey AS k, sum(cast(l_quantity AS BIGINT)) AS units FROM lineitem JOIN orders ON o_orderkey = l_orderkey
      WHERE o_orderstatus IS DISTINCT FROM 'P' GROUP BY 1),
t AS (SELECT p_partkey AS k, p_size + 1 AS inb FROM part WHERE p_size < 46)
SELECT 'DTC' AS "Channel", cast(t.k AS VARCHAR) AS "SKU", cast(coalesce(units, 0) AS BIGINT) AS "Units",
  cast(coalesce(dtc, 0) AS BIGINT) AS "Inventory", cast(inb AS BIGINT) AS "Inbound"
FROM t LEFT JOIN lv ON lv.k = t.k LEFT JOIN u ON u.k = t.k
UNION ALL SELECT 'Reserve', cast(t.k AS VARCHAR), 0, cast(greatest(0, coalesce(rs - wip, 0)) AS BIGINT), 0
FROM t LEFT JOIN lv ON lv.k = t.k""",
}
