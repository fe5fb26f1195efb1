"""C1–C18 on small report files of own rows; expected values are worked out by hand."""

import pytest
from pyspark.sql import functions as F

from skuflow.plans import channels as C
from skuflow.sources.reports import read_report, read_sniffed


def by_sku(df, *cols):
    return {r["SKU"]: tuple(float(r[c]) for c in cols) for r in df.collect()}


def long_rows(m):
    return {(r["Channel"] if "Channel" in r.asDict() else None, r["SKU"]): (float(r["Units"]), float(r["Revenue"]))
            for r in m.long.collect()}


@pytest.fixture
def raw(spark, report_path):
    return lambda name, **kw: read_report(spark, report_path(name), **kw)


def test_c1_walmart_sales(raw):
    out = by_sku(C.walmart_sales(raw("Walmart_sales_2026-02-11.csv")), "Units", "Revenue")
    assert out["4410"] == (15, 2310.75)
    assert out["UL77"] == (3, 42.0)          # unknown SKUs survive until the grid


def test_c2_amazon_sales(spark, raw, catalog):
    m = C.amazon_sales(raw("Amazon_sales_2026-02-10.csv"), catalog.mapping_dim(spark, "amazon"))
    s = by_sku(m.sales, "Units", "Revenue")
    assert s == {"4410": (5, 155.0), "4430": (6, 111.0)}
    assert m.bundles.count() == 0
    unmapped = m.long.where(F.col("SKU").isNull()).first()     # GHOST-9: volume kept under a NULL SKU
    assert (float(unmapped.Units), float(unmapped.Revenue)) == (4, 29.60)


def test_c3_tiktok_sales_sniffed(spark, report_path, catalog):
    raw = read_sniffed(spark, report_path("TikTok_sales_2026-02-09.csv"), "SKU ID")
    m = C.tiktok_sales(raw, catalog.mapping_dim(spark, "tiktok"))
    assert by_sku(m.sales, "Units", "Revenue") == {"4410": (3, 63.75), "4450": (8, 91.2)}
    b = m.bundles.first()
    assert (float(b.Units), float(b.Revenue)) == (4, 91.2)


def test_c4_tiktok_shop_orders(spark, raw, catalog):
    df = raw("TikTok_orders_2026-02-11.csv")
    assert df.count() == 6                       # leading blank line skipped, raw rows
    m = C.tiktok_shop_orders(df, catalog.mapping_dim(spark, "tiktok"))
    assert by_sku(m.sales, "Units", "Revenue") == {"4410": (7, 149.10), "4450": (8, 82.0)}
    b = m.bundles.first()
    assert (float(b.Units), float(b.Revenue)) == (4, 82.0)


def test_c4_requires_columns(spark, catalog):
    df = spark.createDataFrame([("x",)], "`SKU ID` string")
    with pytest.raises(C.MissingColumns):
        C.tiktok_shop_orders(df, catalog.mapping_dim(spark, "tiktok"))


def test_c5_amazon_orders_tsv(spark, raw, catalog):
    df = raw("Amazon_orders_2026-02-11.txt")
    assert df.count() == 7
    m = C.amazon_orders(df, catalog.mapping_dim(spark, "amazon"))
    assert by_sku(m.sales, "Units", "Revenue") == {"4410": (3, 74.40), "4430": (5, 86.25)}
    assert m.bundles.count() == 0
    unmapped = m.long.where(F.col("SKU").isNull()).first()
    assert float(unmapped.Units) == 2                        # GHOST-9 key volume


def test_c6_shopify_sales(spark, raw, catalog):
    m = C.shopify_sales(raw("Shopify_sales_2026-02-11.csv"), catalog.mapping_dim(spark, "shopify"))
    got = {(r.Channel, r.SKU): (float(r.Units), float(r.Revenue)) for r in m.sales.collect()}
    assert got[("Shopify", "4410")] == (3, 47.10)
    assert got[("TikTok Shopify", "4410")] == (2, 38.40)
    for sku in ("4430", "4440", "4480"):
        assert got[("Target", sku)] == (2, 18.0)
    assert not any(ch == "Others" for ch, _ in got)            # NoSuchTin is unmapped, draft dropped
    bundles = {r.Channel: (float(r.Units), float(r.Revenue)) for r in m.bundles.collect()}
    assert bundles == {"TikTok Shopify": (1, 38.40), "Target": (2, 54.0)}


def test_c7_shopify_orders(spark, catalog):
    df = spark.createDataFrame([
        ("paid", "MINT2", "2", "12.50", "pos"), ("paid", "4410", "1", "20.00", "web"), ("paid", "4410", "2", "3.00", "online_store"), ("paid", "4410", "1", "7.00", "TikTok"),
        ("paid", "4410", "1", "1.00", None),
        ("refunded", "4410", "5", "20.00", "web"), ("paid", "SpiceTrio", "1", "30.00", "marketplace_connect"),
    ], "`Financial Status` string, `Lineitem sku` string, `Lineitem quantity` string, `Lineitem price` string, "
       "`Source name` string")
    m = C.shopify_orders(df, catalog.mapping_dim(spark, "shopify"))
    got = {(r.Channel, r.SKU): (float(r.Units), float(r.Revenue)) for r in m.sales.collect()}
    assert got[("Shopify", "4410")] == (3, 26.0) and got[("TikTok Shopify", "4410")] == (1, 7.0)
    assert got[("Others", "4410")] == (5, 26.0)               # 2-pack: 2 × 2 units and 25.00, and one without a source
    assert got[("Target", "4440")] == (1, 10.0)


def test_c8_walmart_orders(spark):
    df = spark.createDataFrame([("4410", "2", "9.99", "Shipped"), ("4410", "1", "9.99", "Cancelled"),
                                ("4420", "3", "$1.50", "Delivered")],
                               "SKU string, Quantity string, `Unit Price` string, `Order Line Status` string")
    got = by_sku(C.walmart_orders(df), "Units", "Revenue")
    assert got == {"4410": (2, 19.98), "4420": (3, 4.5)}


def test_c9_fba(spark, raw, catalog):
    out = C.fba(raw("FBA_report_2026-02-11.csv"), catalog.allowed_dim(spark), catalog.sku_dim(spark))
    got = by_sku(out, "Units", "Inventory", "Inbound")
    assert got["4410"] == (13, 35, 12)
    assert got["4430"] == (9, 25, 6)                  # 9.0 and 21.0 are numbers too
    assert got["4490"] == (0, 0, 0)
    assert out.count() == 7 and {r.Channel for r in out.collect()} == {"FBA"}


def test_c10_awd_preamble(spark, raw, catalog):
    df = raw("AWD_report_2026-02-11.csv", skip_lines=2)
    assert df.count() == 3
    got = by_sku(C.awd(df, catalog.allowed_dim(spark), catalog.sku_dim(spark)), "Units", "Inventory", "Inbound")
    assert got["4410"] == (0, 60, 0) and got["4420"] == (0, 96, 24)


def test_c11_c12_fbt(spark, raw, catalog):
    inv = by_sku(C.fbt_inventory(raw("FBT_inventory_2026-02-11.csv")), "Inventory", "Inbound")
    assert inv["4410"] == (91, 10)
    out = C.fbt(raw("FBT_inventory_2026-02-11.csv"), raw("TikTok_orders_2026-02-11.csv"),
                catalog.mapping_dim(spark, "tiktok"), catalog.sku_dim(spark))
    got = by_sku(out, "Units", "Inventory", "Inbound")
    assert got["4410"] == (5, 91, 10)
    assert got["4450"] == (2, 18, 0)
    no_sales = by_sku(C.fbt(raw("FBT_inventory_2026-02-11.csv"), None, catalog.mapping_dim(spark, "tiktok"),
                            catalog.sku_dim(spark)), "Units")
    assert no_sales["4410"] == (0,)


def test_c13_tiktok_fbt_orders(spark, raw, catalog):
    m = C.tiktok_fbt_orders(raw("TikTok_orders_2026-02-11.csv"), catalog.mapping_dim(spark, "tiktok"))
    assert by_sku(m.sales, "Units", "Revenue") == {"4410": (5, 100.50), "4450": (2, 19.0)}
    b = m.bundles.first()
    assert (float(b.Units), float(b.Revenue)) == (1, 19.0)


def test_c14_c17_three_pl(spark, raw, catalog):
    out = C.three_pl(raw("Flexport_levels_2026-02-11.csv"), raw("Flexport_orders_2026-02-11.csv"),
                     raw("Flexport_inbound_2026-02-11.csv"), catalog.dsku_dim(spark), catalog.sku_dim(spark))
    got = {(r.Channel, r.SKU): (r.Units, r.Inventory, r.Inbound) for r in out.collect()}
    assert got[("DTC", "4410")] == (5, 76, 9)
    assert got[("DTC", "4420")] == (3, 64, 7)     # the cancelled order does not count; qty 4.0 does
    assert got[("Reserve", "4410")] == (0, 15, 0)
    assert got[("Reserve", "4420")] == (0, 15, 0)
    assert len(got) == 14


def test_c16_inbound_optional(spark, raw, catalog):
    out = C.three_pl(raw("Flexport_levels_2026-02-11.csv"), raw("Flexport_orders_2026-02-11.csv"), None,
                     catalog.dsku_dim(spark), catalog.sku_dim(spark))
    assert all(r.Inbound == 0 for r in out.collect())


def test_c15_strict_items(spark, catalog):
    df = spark.createDataFrame([("FULFILLED", "[{oops")], "`Order Status` string, Items string")
    assert C.order_item_units(df, catalog.dsku_dim(spark), strict=False).count() == 0
    with pytest.raises(Exception):
        C.order_item_units(df, catalog.dsku_dim(spark)).collect()
    text = spark.createDataFrame([("FULFILLED", '[{"dsku":"DQ7MINT01","qty":"4"},{"dsku":"DQ7MINT01","qty":2.0}]')],
                                 "`Order Status` string, Items string")
    assert C.order_item_units(text, catalog.dsku_dim(spark)).first().Units == 6


def test_c6_formatted_money_without_quantity(spark, catalog):
    df = spark.createDataFrame([("4410", "Shop", "$1,200.00", "0")],
                               "`Product variant SKU` string, `Sales channel` string, `Net sales` string, `Quantity ordered` string")
    assert float(C.shopify_sales(df, catalog.mapping_dim(spark, "shopify")).sales.first().Revenue) == 1200.0


def test_c18_wfs(spark, raw, catalog):
    out = C.wfs(raw("Walmart_sales_2026-02-11.csv"), raw("Walmart_inventory_2026-02-11.csv"), catalog.sku_dim(spark))
    got = by_sku(out, "Units", "Inventory", "Inbound")
    assert got["4410"] == (15, 88, 36) and got["4420"] == (6, 27, 0)
    assert "UL77" not in got and got["4490"] == (0, 0, 0)


def test_l13_fbt_key_trimmed_before_grouping(spark):
    df = spark.createDataFrame([(" 4410", "5", "1"), ("4410 ", "7", "2")],
                               "`Reference code` string, `Available inventory` string, `In Transit: Total Quantity` string")
    rows = C.fbt_inventory(df).collect()
    assert [(r.SKU, r.Inventory, r.Inbound) for r in rows] == [("4410", 12.0, 3.0)]
