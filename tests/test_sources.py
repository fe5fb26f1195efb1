"""S1–S10 scans and discovery, S9 configuration, D5–D10 landed payloads."""

import datetime as dt
import json

import pytest

from skuflow.sources import landed
from skuflow.sources.config import Catalog, ConfigError, read_mapping, read_ordered_list
from skuflow.sources.discovery import find_latest, latest_per_prefix, list_files
from skuflow.sources.reports import read_report, read_sniffed, sniff_header


def test_bom_and_blank_lines(spark, tmp_path):
    p = tmp_path / "x.csv"
    p.write_bytes("﻿SKU,Qty\n\n4410,2\n4420,NA\n".encode("utf-8"))
    rows = {r.SKU: r.Qty for r in read_report(spark, str(p)).collect()}
    assert rows == {"4410": "2", "4420": None}


def test_latin1_fallback(spark, tmp_path):
    p = tmp_path / "l.csv"
    p.write_bytes(b"SKU,Name\n4410,Caf\xe9\n")
    rows = read_report(spark, str(p)).collect()
    assert len(rows) == 1 and rows[0].Name == "Café"


def test_quoted_json_cell(spark, report_path):
    df = read_report(spark, report_path("Flexport_orders_2026-02-11.csv"))
    items = {r["Marketplace Order ID"]: json.loads(r["Items"]) for r in df.collect()}
    assert items["W-31"] == [{"dsku": "DQ7CLOV01", "qty": 3}, {"dsku": "DQ7MINT01", "qty": 1}]


def test_quoted_line_break_is_one_row(spark, tmp_path):
    p = tmp_path / "r.csv"
    p.write_text('SKU,Note,Units\nA,"left at\nthe door",7\nB,plain,1\n')
    assert {(r.SKU, r.Units) for r in read_report(spark, str(p)).collect()} == {("A", "7"), ("B", "1")}
    p.write_text('Report,x\nMade,y\nSKU,Note,Units\nA,"left at\nthe door",7\nMade,y,\n')
    got = {(r.SKU, r.Note, r.Units) for r in read_report(spark, str(p), skip_lines=2).collect()}
    assert got == {("A", "left at\nthe door", "7"), ("Made", "y", None)}     # equal to a preamble line, yet data


def test_header_far_down(spark, tmp_path):
    p = tmp_path / "r.csv"
    p.write_text("note;x\n" * 60 + "SKU ID;Units\nK1;4\n")
    assert sniff_header(spark, str(p), "SKU ID").skip_lines == 60
    assert [tuple(r) for r in read_sniffed(spark, str(p), "SKU ID").collect()] == [("K1", "4")]


def test_empty_newest_file_is_listed(spark, tmp_path):
    from skuflow.sources.discovery import find_latest

    (tmp_path / "Stock_2026-03-01.csv").write_text("a\n1\n")
    (tmp_path / "Stock_2026-03-02.csv").write_text("")
    assert find_latest(spark, str(tmp_path), "Stock_", run_date="2026-03-09")[1] == "2026-03-02"


def test_snapshots_in_a_folder_with_a_space(spark, tmp_path):
    from skuflow.operators.history import read_snapshots

    d = tmp_path / "snap dir"
    d.mkdir()
    (d / "inventory_report_2026-03-01.csv").write_text("Channel,SKU,Units,Inventory,Inbound\nFBA,K1,1,2,3\n")
    assert read_snapshots(spark, str(d)).count() == 1


def test_semicolon_sniff(spark, tmp_path):
    p = tmp_path / "t.csv"
    p.write_text("range line;;\n;;\nSKU ID;GMV;Items sold\n1;2,50;3\n")
    s = sniff_header(spark, str(p), "SKU ID")
    assert (s.skip_lines, s.sep) == (2, ";")
    r = read_sniffed(spark, str(p), "SKU ID").first()
    assert (r["SKU ID"], r["GMV"], r["Items sold"]) == ("1", "2,50", "3")


def test_sniff_fallback(spark, tmp_path):
    p = tmp_path / "n.csv"
    p.write_text("a\nb\nX,Y\n1,2\n")
    assert sniff_header(spark, str(p), "SKU ID").skip_lines == 2


def _touch(d, *names):
    for n in names:
        (d / n).write_text("h\n1\n")


def test_latest_report(spark, tmp_path):
    _touch(tmp_path, "FBA_report_2026-01-01.csv", "FBA_report_2026-02-11.csv", "FBA_report_2026-02-30.csv",
           "AWD_report_2026-03-01.csv", "fba_report_notes.csv")
    path, day = find_latest(spark, str(tmp_path), "FBA_report_", (".csv",), "2026-03-05")
    assert path.endswith("FBA_report_2026-02-11.csv") and day == "2026-02-11"
    # today's file wins outright
    path, day = find_latest(spark, str(tmp_path), "FBA_report_", (".csv",), "2026-01-01")
    assert day == "2026-01-01"
    assert find_latest(spark, str(tmp_path), "Nope_", (".csv",), "2026-01-01") is None


def test_extension_tie_break(spark, tmp_path):
    _touch(tmp_path, "Amazon_orders_2026-02-11.csv", "Amazon_orders_2026-02-11.txt", "Amazon_orders_2026-02-01.txt")
    path, _ = find_latest(spark, str(tmp_path), "Amazon_orders_", (".txt", ".csv"), "2026-03-01")
    assert path.endswith(".txt")
    path, _ = find_latest(spark, str(tmp_path), "Amazon_orders_", (".csv", ".txt"), "2026-03-01")
    assert path.endswith("2026-02-11.csv")


def test_latest_per_prefix_many(spark):
    names = spark.createDataFrame([("A_2026-01-01.csv",), ("A_2026-01-03.csv",), ("B_2026-01-02.csv",),
                                   ("A_2026-13-01.csv",), ("C_2026-01-09.csv",)], "name string")
    got = {r.prefix: (r.name, r.report_date) for r in latest_per_prefix(names, ["A_", "B_"], (".csv",),
                                                                         "2026-02-01").collect()}
    assert got == {"A_": ("A_2026-01-03.csv", dt.date(2026, 1, 3)), "B_": ("B_2026-01-02.csv", dt.date(2026, 1, 2))}


def test_listing_reads_no_content(spark, tmp_path):
    _touch(tmp_path, "x_2026-01-01.csv")
    plan = list_files(spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan.split("ReadSchema")[-1]


def test_catalog_errors(tmp_path):
    with pytest.raises(ConfigError):
        Catalog.from_dir(str(tmp_path))
    for name in ["flexport_map.json", "tiktok_map.json", "shopify_map.json", "amazon_map.json"]:
        (tmp_path / name).write_text("{}")
    (tmp_path / "catalog.json").write_text("{broken")
    with pytest.raises(ConfigError):
        Catalog.from_dir(str(tmp_path))


def test_catalog_dims(spark, catalog):
    assert [r.SKU for r in catalog.sku_dim(spark).orderBy("sku_rank").collect()][:2] == ["4410", "4420"]
    m = {r.source_key: r.targets for r in catalog.mapping_dim(spark, "tiktok").collect()}
    assert m["5810000000000000777"] == ["4450", "4450"]


def test_read_mapping_json(spark, tmp_path):
    p = tmp_path / "m.json"
    p.write_text(json.dumps({"SHOPIFY_SKU_MAP": {"a": ["1", "1"], "b": []}}, indent=2))
    got = {r.source_key: r.targets for r in read_mapping(spark, str(p), "SHOPIFY_SKU_MAP").collect()}
    assert got == {"a": ["1", "1"], "b": []}
    q = tmp_path / "c.json"
    q.write_text(json.dumps({"SKU_ORDER": ["9", "1"]}))
    assert [(r.sku_rank, r.SKU) for r in read_ordered_list(spark, str(q), "SKU_ORDER").collect()] == [(0, "9"), (1, "1")]


def _doc(spark, obj, schema):
    return landed.parse_landed(spark.createDataFrame([(json.dumps(obj),)], "j string"), "j", schema)


def test_landed_three_pl(spark, catalog):
    from skuflow.plans import channels as C

    lv = landed.tpl_levels(_doc(spark, {"items": [
        {"logisticsSku": "DQ7MINT01", "merchantSku": "4410", "dtcTotalQuantity": 100, "rsTotalQuantity": 50,
         "opsWipQuantity": 10, "inTransitQuantity": 5}]}, landed.TPL_LEVELS_DOC))
    od = landed.tpl_orders(_doc(spark, {"orders": [
        {"createdAt": "x", "orderStatus": "FULFILLED", "items": [{"dsku": "DQ7MINT01", "qty": 2}]},
        {"createdAt": "x", "orderStatus": "CANCELLED", "items": [{"dsku": "DQ7MINT01", "qty": 9}]}]},
        landed.TPL_ORDERS_DOC))
    out = C.three_pl(lv, od, None, catalog.dsku_dim(spark), catalog.sku_dim(spark))
    got = {(r.Channel, r.SKU): (r.Units, r.Inventory) for r in out.collect()}
    assert got[("DTC", "4410")] == (2, 100) and got[("Reserve", "4410")] == (0, 40)


def test_landed_fba_awd(spark):
    fba = landed.fba_inventory(_doc(spark, {"inventorySummaries": [{"sellerSku": "4410", "inventoryDetails": {
        "fulfillableQuantity": 40, "reservedQuantity": {"fcProcessingQuantity": 3}, "inboundWorkingQuantity": 1,
        "inboundShippedQuantity": 2, "inboundReceivingQuantity": 4}}]}, landed.FBA_DOC)).first()
    assert (fba["Merchant SKU"], fba["Available"], fba["FC transfer"], fba["Inbound"]) == ("4410", 40, 3, 7)
    awd = landed.awd_inventory(_doc(spark, {"inventory": [{"sku": "4420", "inventoryDetails": {
        "availableQuantity": {"amount": 80}, "inboundQuantity": {"amount": 5}}}]}, landed.AWD_DOC)).first()
    assert (awd["Available in AWD (units)"], awd["Inbound to AWD (units)"]) == (80, 5)


def test_landed_walmart(spark):
    from skuflow.plans import channels as C

    doc = _doc(spark, {"orders": [{"purchaseOrderId": "1", "orderLines": [
        {"sku": "4410", "status": "Shipped", "orderLineQuantity": {"amount": "2"},
         "charges": [{"chargeType": "PRODUCT", "chargeAmount": {"amount": 19.98}},
                     {"chargeType": "SHIPPING", "chargeAmount": {"amount": 5.0}}]}]}]}, landed.WALMART_ORDERS_DOC)
    raw = landed.walmart_orders(doc).withColumnRenamed("GMV", "Unit Price")
    r = landed.walmart_orders(doc).first()
    assert float(r.GMV) == 19.98 and r.Quantity == "2"
    inv = landed.walmart_inventory(_doc(spark, {"inventory": [{"sku": "4410", "availableToSellQty": 7,
                                                               "inboundQty": 1}]}, landed.WALMART_INVENTORY_DOC))
    assert inv.first()["Available units"] == 7
    assert raw.count() == 1 and C.WALMART_ORDERS["status"] in raw.columns


def test_landed_tiktok(spark, catalog):
    from skuflow.plans import channels as C

    doc = _doc(spark, {"data": {"orders": [
        {"order_id": "1", "order_status": 130, "fulfillment_type": "TIKTOK_FULFILLMENT",
         "line_items": [{"sku_id": "5810000000000000421", "seller_sku": "a", "quantity": 2}],
         "payment": {"total_amount": "50.00"}},
        {"order_id": "2", "order_status": 140, "fulfillment_type": "TIKTOK_FULFILLMENT",
         "line_items": [{"sku_id": "5810000000000000421", "seller_sku": "a", "quantity": 7}],
         "payment": {"total_amount": "70.00"}}]}}, landed.TIKTOK_ORDERS_DOC)
    m = C.tiktok_fbt_orders(landed.tiktok_orders(doc), catalog.mapping_dim(spark, "tiktok"))
    r = m.sales.first()
    assert (r.SKU, float(r.Units), float(r.Revenue)) == ("4410", 2.0, 50.0)
    inv = landed.tiktok_inventory(_doc(spark, {"data": {"inventories": [
        {"seller_sku": "4410", "available_quantity": 80, "in_transit_quantity": 10}]}}, landed.TIKTOK_INVENTORY_DOC))
    assert C.fbt_inventory(inv).first().Inventory == 80


def test_landed_shopify(spark, catalog):
    from skuflow.plans import channels as C

    doc = _doc(spark, {"orders": [{"id": "1", "source_name": "web", "financial_status": "paid", "line_items": [
        {"sku": "4410", "quantity": 2, "price": "10.00", "discount_allocations": [{"amount": "1.50"}]},
        {"sku": "4410", "quantity": 0, "price": "10.00", "discount_allocations": []}]},
        {"id": "2", "source_name": None, "line_items": [
            {"sku": "4410", "quantity": 1, "price": "5.00", "discount_allocations": []}]}]}, landed.SHOPIFY_ORDERS_DOC)
    raw = landed.shopify_orders(doc)
    assert raw.count() == 2                       # zero-quantity, zero-net line dropped
    m = C.shopify_sales(raw, catalog.mapping_dim(spark, "shopify"))
    got = {(r.Channel, r.SKU): (float(r.Units), float(r.Revenue)) for r in m.sales.collect()}
    assert got == {("Shopify", "4410"): (2.0, 18.5), ("Others", "4410"): (1.0, 5.0)}


def test_find_latest_many(spark, tmp_path):
    from skuflow.sources.discovery import find_latest_many

    _touch(tmp_path, "A_2026-01-01.csv", "A_2026-01-05.csv", "B_2026-01-02.txt", "B_2026-01-02.csv", "C_x.csv")
    got = find_latest_many(spark, str(tmp_path), {"A_": (".csv",), "B_": (".txt", ".csv"), "Z_": (".csv",)},
                           "2026-02-01")
    assert set(got) == {"A_", "B_"}
    assert got["A_"][1] == "2026-01-05" and got["B_"][0].endswith("B_2026-01-02.txt")
