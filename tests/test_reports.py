"""R1–R10 on in-memory frames and end to end from the report files."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from skuflow.operators.history import read_json_log, read_run_log
from skuflow.operators.quality import ContractViolation
from skuflow.plans.reports import inventory_report, sales_report, wide_sales
from skuflow.plans.runs import inventory_run, publish, sales_run
from skuflow.sinks import payload_records
from tests.conftest import REPORTS

D = dt.date(2026, 2, 11)
INV_CH = ["FBA", "AWD", "WFS", "FBT", "DTC", "Reserve"]
SALES_CH = ["Amazon", "Walmart", "TikTok Shop", "Shopify", "TikTok Shopify", "Target", "Others"]


@pytest.fixture
def inventory_df(spark):
    return spark.createDataFrame([("FBA", "4410", 5, 100, 10, D), ("FBA", "4420", 3, 50, 5, D),
                                  ("AWD", "4410", 0, 200, 20, D), ("AWD", "4420", 0, 80, 8, D)],
                                 "Channel string, SKU string, Units long, Inventory long, Inbound long, Date date")


@pytest.fixture
def sales_df(spark):
    return spark.createDataFrame([("4410", "Amazon", 5.0, 125.0, D), ("4420", "Amazon", 3.0, 60.0, D),
                                  ("4410", "Walmart", 2.0, 40.0, D), ("4420", "Walmart", 1.0, 20.0, D)],
                                 "SKU string, Channel string, Units double, Revenue double, Date date")


def test_inventory_report_grid(spark, catalog, inventory_df):
    rep, off = inventory_report(inventory_df, catalog.sku_dim(spark), INV_CH, "2026-03-01")
    rows = {(r.Channel, r.SKU): r for r in rep.collect()}
    assert len(rows) == len(INV_CH) * 7
    fba = rows[("FBA", "4410")]
    assert (fba.Units, fba.Inventory, fba.Inbound) == (5, 100, 10)
    assert (rows[("FBA", "4490")].Units, rows[("FBA", "4490")].Inventory) == (0, 0)
    assert fba.id == "20260301_FBA_4410" and fba.sku_channel_id == "FBA_4410"
    assert rows[("FBA", "4490")].Date == D                 # channel date, not run date
    assert rows[("WFS", "4410")].Date == dt.date(2026, 3, 1)  # zero channel: run date
    assert off.count() == 0
    assert rep.columns == ["id", "sku_channel_id", "Date", "SKU", "Channel", "Units", "Inventory", "Inbound"]


def test_inventory_clips_negative(spark, catalog):
    neg = spark.createDataFrame([("FBA", "4410", 0, -1, 0, D)],
                                "Channel string, SKU string, Units long, Inventory long, Inbound long, Date date")
    rep, off = inventory_report(neg, catalog.sku_dim(spark), INV_CH, "2026-03-01")
    assert rep.where("Channel = 'FBA' AND SKU = '4410'").first().Inventory == 0
    o = off.collect()
    assert [(r.Channel, r.SKU, r.metric, r.value) for r in o] == [("FBA", "4410", "Inventory", -1.0)]


def _long(df):
    return df.withColumn("Revenue", F.col("Revenue").cast("decimal(38,4)"))


def test_sales_report_with_bundles(spark, catalog, sales_df):
    bundles = spark.createDataFrame([("Bundles", "Amazon", 2.0, 30.0, D)],
                                    "SKU string, Channel string, Units double, Revenue double, Date date")
    rep = sales_report(_long(sales_df.unionByName(bundles)), catalog.sku_dim(spark), SALES_CH, "2026-03-01")
    rows = {(r.Channel, r.SKU): r for r in rep.collect()}
    assert len(rows) == len(SALES_CH) * 8
    assert (rows[("Amazon", "4410")].Units, rows[("Amazon", "4410")].Revenue) == (5, 125.0)
    assert all(rows[("TikTok Shop", s)].Units == 0 for s in ["4410", "Bundles"])
    assert (rows[("Amazon", "Bundles")].Units, rows[("Amazon", "Bundles")].Revenue) == (2, 30.0)
    assert all(" " not in r.id for r in rows.values())
    assert rows[("TikTok Shop", "4410")].id == "20260301_TikTok_Shop_4410"


def test_sales_units_truncate_and_cents(spark, catalog):
    df = spark.createDataFrame([("4410", "Amazon", 2.9, 10.125, D), ("4420", "Amazon", -1.5, -3.0, D)],
                               "SKU string, Channel string, Units double, Revenue double, Date date")
    rows = {r.SKU: r for r in sales_report(_long(df), catalog.sku_dim(spark), ["Amazon"], "2026-03-01").collect()}
    assert (rows["4410"].Units, rows["4410"].Revenue) == (2, 10.12)      # half-even cents
    assert (rows["4420"].Units, rows["4420"].Revenue) == (-1, -3.0)      # negatives allowed in sales


def test_wide_report(spark, catalog, sales_df):
    rep = sales_report(_long(sales_df), catalog.sku_dim(spark), SALES_CH, "2026-03-01")
    wide = {r.SKU: r.asDict() for r in wide_sales(rep, SALES_CH).collect()}
    assert wide["4410"]["Amazon (Units)"] == 5 and wide["4410"]["Walmart (Revenue)"] == 40.0
    assert "Bundles" not in wide and len(wide) == 7


def test_sales_run_from_files(spark, catalog):
    run = sales_run(spark, REPORTS, catalog, "2026-03-01")
    rows = {(r.Channel, r.SKU): (r.Units, r.Revenue) for r in run.report.collect()}
    assert rows[("Walmart", "4410")] == (15, 2310.75)
    assert rows[("Amazon", "4430")] == (5, 86.25)
    assert rows[("TikTok Shop", "4450")] == (8, 82.0)
    assert rows[("TikTok Shop", "Bundles")] == (4, 82.0)
    assert rows[("TikTok Shopify", "4410")] == (2, 38.4)
    assert rows[("Target", "Bundles")] == (2, 54.0)
    assert rows[("Others", "4410")] == (0, 0.0)
    status = {r.Channel: r.status for r in run.status.collect()}
    assert status["Amazon"] == "2026-02-11" and status["Others"] == "No data"
    assert sorted(run.source_files) == sorted(["Walmart_sales_2026-02-11.csv", "Amazon_orders_2026-02-11.txt",
                                               "TikTok_orders_2026-02-11.csv", "Shopify_sales_2026-02-11.csv"])
    missing = {(r.Channel, r.SKU) for r in run.missing.collect()}
    assert ("Amazon", "4490") in missing and ("Walmart", "4410") not in missing


def test_inventory_run_from_files(spark, catalog):
    run = inventory_run(spark, REPORTS, catalog, "2026-03-01")
    rows = {(r.Channel, r.SKU): (r.Units, r.Inventory, r.Inbound) for r in run.report.collect()}
    assert rows[("FBA", "4410")] == (13, 35, 12)
    assert rows[("AWD", "4420")] == (0, 96, 24)
    assert rows[("WFS", "4410")] == (15, 88, 36)
    assert rows[("FBT", "4410")] == (5, 91, 10)
    assert rows[("DTC", "4410")] == (5, 76, 9)
    assert rows[("Reserve", "4420")] == (0, 15, 0)
    assert len(rows) == 6 * 7


def test_inventory_run_skips_source_missing_required_file(spark, catalog, tmp_path):
    for name in os.listdir(REPORTS):
        if not name.startswith("Flexport_levels_"):
            os.symlink(os.path.join(REPORTS, name), tmp_path / name)
    run = inventory_run(spark, str(tmp_path), catalog, "2026-03-01")
    status = {r.Channel: r.status for r in run.status.collect()}
    assert status["DTC"] == "No data" and status["FBA"] == "2026-02-11"
    assert all(f.startswith(("FBA", "AWD", "Walmart", "FBT", "TikTok")) for f in run.source_files)


def test_empty_extract(spark, catalog, tmp_path):
    run = sales_run(spark, str(tmp_path), catalog, "2026-03-01")
    assert run.report is None and {r.status for r in run.status.collect()} == {"No data"}
    assert publish(spark, run, "sales", str(tmp_path / "out"), "2026-03-01") is None


def test_publish_gate_and_history(spark, catalog, tmp_path):
    out = str(tmp_path / "out")
    run = sales_run(spark, REPORTS, catalog, "2026-03-01")
    summary = publish(spark, run, "sales", out, "2026-03-01", timestamp="2026-03-01T08:00:00").first()
    # zero-filled channels carry the run date, and the summary takes the max over all rows
    assert summary.total_records == 7 * 8 and summary.report_date == dt.date(2026, 3, 1)
    written = spark.read.parquet(os.path.join(out, "reports"))
    assert written.where("report = 'sales'").count() == 56
    publish(spark, run, "sales", out, "2026-03-01", timestamp="2026-03-01T09:00:00")   # rerun: same partition
    assert spark.read.parquet(os.path.join(out, "reports")).count() == 56
    logged = read_run_log(spark, os.path.join(out, "run_history")).collect()      # one row a day: the later run's
    assert [(r.pipeline, r.timestamp) for r in logged] == [("sales", "2026-03-01T09:00:00")]


def test_gate_blocks_publication(spark, catalog, tmp_path):
    bad = spark.createDataFrame([("FBA", "4410", 0, 0, 0, D)],
                                "Channel string, SKU string, Units long, Inventory long, Inbound long, Date date")
    rep, _ = inventory_report(bad, catalog.sku_dim(spark), INV_CH, "2026-03-01")
    from skuflow.plans.runs import RunResult
    broken = RunResult(rep.withColumn("Inventory", F.lit(-5).cast("long")), rep.limit(0))
    with pytest.raises(ContractViolation):
        publish(spark, broken, "inventory", str(tmp_path / "o"), "2026-03-01")
    assert not os.path.exists(tmp_path / "o")


def test_payload_chunks(spark, catalog, sales_df):
    rep = sales_report(_long(sales_df), catalog.sku_dim(spark), SALES_CH, "2026-03-01")
    status = spark.createDataFrame([("Amazon", "2026-02-11"), ("Others", None)], "Channel string, status string")
    docs = [json.loads(r.payload) for r in payload_records(rep, status, "sales", max_rows=10).collect()]
    head = [d for d in docs if "reportSummary" in d]
    data = [d for d in docs if "reportData" in d]
    assert head[0]["reportSummary"]["Amazon"] == "2026-02-11"
    assert sum(len(d["reportData"]) for d in data) == 56 and all(d["chunks"] == 6 for d in data)
    assert data[0]["reportData"][0]["Date"] in ("2026-02-11", "2026-03-01")


def test_sales_run_metrics(spark, catalog):
    run = sales_run(spark, REPORTS, catalog, "2026-03-01")
    m = {r.source: (r.rows_analyzed, r.rows_found) for r in run.metrics.collect()}
    assert m["Amazon"] == (7, 2) and m["TikTok Shop"] == (6, 2) and m["Walmart"] == (4, 4)


def test_compare_amazon(spark, catalog):
    from skuflow.plans.runs import compare_amazon

    recon, totals = compare_amazon(spark, REPORTS, catalog, "2026-03-01")
    r = {x.SKU: x for x in recon.collect()}
    assert (r["4410"].Old_Units, r["4410"].New_Units, r["4410"].Units_Diff) == (5, 3, -2)
    assert r["4430"].Units_Diff == -1
    t = totals.first()
    assert (t.units_diff_count, t.parsers_agree) == (2, False)


def test_legacy_registry_and_one_sided(spark, catalog):
    from skuflow.operators.reconcile import one_sided, reconcile
    from skuflow.plans.runs import LEGACY_SALES_REGISTRY

    old = sales_run(spark, REPORTS, catalog, "2026-03-01", registry=LEGACY_SALES_REGISTRY)
    rows = {(r.Channel, r.SKU): (r.Units, r.Revenue) for r in old.report.collect()}
    assert rows[("Amazon", "4410")] == (5, 155.0)
    assert rows[("TikTok Shop", "4450")] == (8, 91.2) and rows[("TikTok Shop", "Bundles")] == (4, 91.2)
    a = spark.createDataFrame([("1", 1.0, 1.0)], "SKU string, Units double, Revenue double")
    b = spark.createDataFrame([("2", 1.0, 1.0)], "SKU string, Units double, Revenue double")
    assert {(r.side, r.SKU) for r in one_sided(reconcile(a, b)).collect()} == {("old only", "1"), ("new only", "2")}


def test_exports(spark, catalog, sales_df, tmp_path):
    from skuflow.sinks import export_csv, export_json

    rep = sales_report(_long(sales_df), catalog.sku_dim(spark), SALES_CH, "2026-03-01", keep_ranks=True)
    export_csv(rep.drop("channel_rank", "sku_rank"), str(tmp_path / "csv"), order_by=["Channel", "SKU"])
    export_json(rep.drop("channel_rank", "sku_rank"), str(tmp_path / "json"))
    back = spark.read.option("header", True).csv(str(tmp_path / "csv"))
    assert back.count() == 56 and back.columns[:3] == ["id", "sku_channel_id", "Date"]
    assert spark.read.json(str(tmp_path / "json")).where("Date = '2026-02-11'").count() > 0


def test_raw_orders_registry(spark, catalog, tmp_path):
    from skuflow.plans.runs import RAW_ORDERS_SALES_REGISTRY

    (tmp_path / "Walmart_orders_2026-02-11.csv").write_text(
        "Purchase Order ID,Order Date,SKU,Quantity,Unit Price,Order Line Status\n"
        "P1,2026-02-10,4410,2,$10.00,Shipped\nP2,2026-02-10,4410,1,$10.00,Cancelled\nP3,2026-02-10,4420,3,5.50,Delivered\n")
    (tmp_path / "Shopify_orders_2026-02-11.csv").write_text(
        "Name,Financial Status,Lineitem sku,Lineitem quantity,Lineitem price,Source name\n"
        "#1,paid,MINT2,1,20.00,tiktok\n#2,refunded,4410,4,9.00,web\n#3,paid,4410,2,9.00,online_store\n")
    run = sales_run(spark, str(tmp_path), catalog, "2026-03-01", registry=RAW_ORDERS_SALES_REGISTRY)
    rows = {(r.Channel, r.SKU): (r.Units, r.Revenue) for r in run.report.collect()}
    assert rows[("Walmart", "4410")] == (2, 20.0) and rows[("Walmart", "4420")] == (3, 16.5)
    assert rows[("TikTok Shopify", "4410")] == (2, 20.0) and rows[("TikTok Shopify", "Bundles")] == (1, 20.0)
    assert rows[("Shopify", "4410")] == (2, 18.0)
    assert rows[("Amazon", "4410")] == (0, 0.0)
    status = {r.Channel: r.status for r in run.status.collect()}
    assert status["Walmart"] == "2026-02-11" and status["Amazon"] == "No data"
