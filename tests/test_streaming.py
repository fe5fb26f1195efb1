"""File-drop ingest with Structured Streaming (exactly-once landing)."""

import datetime as dt

from skuflow.streaming import ingest_reports, latest_landed

COLS = ["Item_Name", "SKU", "GMV", "Units_Sold", "Orders"]


def _write(d, name, rows):
    (d / name).write_text("Item_Name,SKU,GMV,Units_Sold,Orders\n" + "".join(f"{r}\n" for r in rows))


def test_ingest_and_latest(spark, tmp_path):
    inbox, out, ck = tmp_path / "in", str(tmp_path / "landed"), str(tmp_path / "ck")
    inbox.mkdir()
    _write(inbox, "Walmart_sales_2026-02-10.csv", ['A,4410,"$1,000.00",3,3'])
    _write(inbox, "Walmart_sales_2026-02-11.csv", ["A,4410,$5.00,1,1", "B,4420,$2.00,2,2"])
    _write(inbox, "Walmart_inventory_2026-02-11.csv", ["x,4410,1,1,1"])
    q = ingest_reports(spark, str(inbox), "walmart_sales", "Walmart_sales_", COLS, out)
    q.awaitTermination(120)
    landed = spark.read.parquet(out)
    assert landed.count() == 3
    latest = latest_landed(spark, out, "walmart_sales")
    assert {r.report_date for r in latest.collect()} == {dt.date(2026, 2, 11)}
    assert latest.count() == 2
    # a rerun commits nothing twice; a new drop is picked up incrementally
    _write(inbox, "Walmart_sales_2026-02-12.csv", ["C,4430,$9.00,9,9"])
    q = ingest_reports(spark, str(inbox), "walmart_sales", "Walmart_sales_", COLS, out)
    q.awaitTermination(120)
    assert spark.read.parquet(out).count() == 4
    assert latest_landed(spark, out, "walmart_sales", run_date="2026-02-10").count() == 1


def test_ingest_landed_payloads(spark, tmp_path, catalog):
    import json

    from skuflow.plans import channels as C
    from skuflow.sources import landed
    from skuflow.streaming import ingest_payloads

    inbox, out = tmp_path / "in", str(tmp_path / "landed")
    inbox.mkdir()
    doc = {"orders": [{"id": "1", "source_name": "tiktok", "financial_status": "paid", "line_items": [
        {"sku": "MINT2", "quantity": 1, "price": "30.00", "discount_allocations": [{"amount": "2.00"}]}]}]}
    (inbox / "Shopify_api_2026-02-11.json").write_text(json.dumps(doc, indent=2))
    q = ingest_payloads(spark, str(inbox), "shopify_api", "Shopify_api_", landed.SHOPIFY_ORDERS_DOC, out)
    q.awaitTermination(120)
    rows = latest_landed(spark, out, "shopify_api")
    raw = landed.shopify_orders(rows)
    m = C.shopify_sales(raw, catalog.mapping_dim(spark, "shopify"))
    got = {(r.Channel, r.SKU): (float(r.Units), float(r.Revenue)) for r in m.sales.collect()}
    assert got == {("TikTok Shopify", "4410"): (2.0, 28.0)}        # 2-pack: each unit of the pair counts


def test_sources_and_restarts_lose_nothing(spark, tmp_path):
    inbox, out = tmp_path / "in", str(tmp_path / "out")
    inbox.mkdir()
    for name in ("A_2026-03-01.csv", "B_2026-03-01.csv"):
        (inbox / name).write_text("SKU,Units\nK1,1\n")

    def land(source):
        ingest_reports(spark, str(inbox), source, f"{source}_", ["SKU", "Units"], out).awaitTermination()

    land("A")
    land("B")
    (inbox / "A_2026-03-02.csv").write_text("SKU,Units\nK2,2\n")
    land("A")
    assert latest_landed(spark, out, "B").count() == 1
    assert [r.SKU for r in latest_landed(spark, out, "A").collect()] == ["K2"]
    assert latest_landed(spark, out, "A", run_date="2026-03-01").count() == 1
