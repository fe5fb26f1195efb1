"""Write, audit, promote: what a run publishes, refuses and records."""

import datetime as dt
import glob
import json
import os
import shutil

import pytest
from pyspark.sql import functions as F

from skuflow.operators.history import read_json_log, read_run_log
from skuflow.operators.quality import ContractViolation
from skuflow.plans.runs import combine_inventory, compare_amazon, inventory_run, publish, sales_run
from skuflow.sinks.ordered import read_ordered
from skuflow.plans.reports import PUBLISHED
from skuflow.sources.config import Catalog, DuplicateKeys, read_mapping, unique_mapping
from skuflow.sources.reports import MALFORMED, MalformedReport, read_report, split_malformed
from tests.conftest import CONFIG, REPORTS

DAY = "2026-03-01"


@pytest.fixture
def inputs(tmp_path):
    folder = tmp_path / "input"
    shutil.copytree(REPORTS, folder)
    return folder


def outcomes(run):
    return {r.source: r for r in run.sources.collect()}


def edit(folder, prefix, change):
    path = glob.glob(f"{folder}/{prefix}*")[0]
    with open(path, encoding="utf-8") as fh:
        text = fh.read()
    with open(path, "w", encoding="utf-8") as fh:
        fh.write(change(text))


def test_both_reports_share_a_folder(spark, catalog, tmp_path):
    """Inventory first, then sales: each keeps its own columns, the revenue is summed, reruns replace."""
    out = str(tmp_path / "out")
    inv, sales = inventory_run(spark, REPORTS, catalog, DAY), sales_run(spark, REPORTS, catalog, DAY)
    for stamp in ("08:00", "09:00"):
        publish(spark, inv, "inventory", out, DAY, timestamp=stamp)
        summary = publish(spark, sales, "sales", out, DAY, timestamp=stamp).first()
    assert summary.total_revenue == pytest.approx(sum(r.Revenue for r in sales.report.collect()))
    for kind, run in (("inventory", inv), ("sales", sales)):
        got = spark.read.parquet(f"{out}/reports/report={kind}/run_date={DAY}")
        assert got.schema.simpleString() == f"struct<{PUBLISHED[kind].replace(' ', ':').replace(',:', ',').replace('long', 'bigint')}>"
        assert got.count() == run.report.count()
    logged = {r.pipeline: r for r in read_run_log(spark, f"{out}/run_history").collect()}
    assert set(logged) == {"inventory", "sales"} and logged["sales"].total_revenue == summary.total_revenue
    assert {r.timestamp for r in logged.values()} == {"09:00"} and logged["inventory"].total_revenue is None
    lines, bad = read_json_log(spark, f"{out}/run_history_json")
    assert lines.count() == 2 and bad.count() == 0


def test_fractions_of_a_unit_are_refused(spark, catalog, inputs, tmp_path):
    edit(inputs, "FBT_inventory_", lambda t: t + "4410,2.5,0\n" if t.splitlines()[0].count(",") == 2 else
         t.rstrip("\n") + "\n" + ",".join("4410" if c == "Reference code" else "2.5" if c == "Available inventory" else "0"
                                          for c in t.splitlines()[0].split(",")) + "\n")
    run = inventory_run(spark, str(inputs), catalog, DAY)
    fbt = run.report.where("Channel = 'FBT' AND SKU = '4410'").first()
    assert fbt.Inventory == 93.5
    with pytest.raises(ContractViolation, match="Inventory:integral"):
        publish(spark, run, "inventory", str(tmp_path / "out"), DAY)
    assert not os.path.exists(tmp_path / "out")


def test_one_bad_cell_drops_one_source(spark, catalog, inputs, tmp_path):
    edit(inputs, "Walmart_sales_", lambda t: t.rstrip("\n") + "\n" + ",".join(
        {"SKU": "4410", "Units_Sold": "1", "GMV": "not money"}.get(c, "") for c in t.splitlines()[0].split(",")) + "\n")
    run = sales_run(spark, str(inputs), catalog, DAY)
    got = outcomes(run)
    assert got["Walmart"].status == "refused" and "not money" in got["Walmart"].reason
    assert {s: r.status for s, r in got.items() if s != "Walmart"} == {"Amazon": "loaded", "TikTok Shop": "loaded", "Mixed": "loaded"}
    assert not [f for f in run.source_files if f.startswith("Walmart")]
    publish(spark, run, "sales", str(tmp_path / "out"), DAY)
    status = {r.Channel: r.status for r in spark.read.parquet(f"{tmp_path}/out/status").collect()}
    assert status["Walmart"] == "No data" and status["Amazon"] == "2026-02-11"
    told = {r.source: r.status for r in spark.read.parquet(f"{tmp_path}/out/sources").collect()}
    assert told["Walmart"] == "refused" and told["Amazon"] == "loaded"


@pytest.mark.parametrize("prefix, source", [("Walmart_sales_", "Walmart"), ("TikTok_orders_", "TikTok Shop")])
def test_ragged_rows_and_missing_columns_drop_one_source(spark, catalog, inputs, prefix, source):
    edit(inputs, prefix, lambda t: t.rstrip("\n") + "\n" + "x," * (t.splitlines()[-1].count(",") + 3) + "y\n")
    got = outcomes(sales_run(spark, str(inputs), catalog, DAY))
    assert got[source].status == "refused" and "malformed" in got[source].reason
    assert sum(r.status == "loaded" for r in got.values()) == 3
    edit(inputs, prefix, lambda t: t.replace("SKU", "Sku number"))
    assert "missing columns" in outcomes(sales_run(spark, str(inputs), catalog, DAY))[source].reason


def test_inventory_source_is_dropped_alone(spark, catalog, inputs):
    edit(inputs, "AWD_report_", lambda t: "\n".join(t.splitlines()[:2] + t.splitlines()[3:]) + "\n")
    edit(inputs, "Flexport_orders_", lambda t: t.replace("[{", "[{{"))
    run = inventory_run(spark, str(inputs), catalog, DAY)
    got = outcomes(run)
    assert (got["3PL"].status, got["FBA"].status, got["WFS"].status, got["FBT"].status) == ("refused", "loaded", "loaded", "loaded")
    assert got["AWD"].status == "refused"
    status = {r.Channel: r.status for r in run.status.collect()}
    assert (status["DTC"], status["Reserve"], status["AWD"], status["FBA"]) == ("No data", "No data", "No data", "2026-02-11")


def test_what_is_observed_of_a_source(spark, catalog, inputs):
    edit(inputs, "Amazon_orders_", lambda t: t.replace("\t2\t", "\ttwo\t", 1))
    run = sales_run(spark, str(inputs), catalog, DAY)
    amazon = outcomes(run)["Amazon"]
    raw = read_report(spark, glob.glob(f"{inputs}/Amazon_orders_*")[0])
    assert amazon.rows_analyzed == raw.count() == 7
    assert (amazon.coerced_cells, amazon.coercions) == (1, "quantity: 1")
    assert amazon.missing_skus == len(catalog.sku_order) - amazon.rows_found
    lost = {(r.source, r.source_key) for r in run.unmapped.collect()}
    assert amazon.unmapped_keys == len([1 for s, _ in lost if s == "Amazon"])
    inv = inventory_run(spark, REPORTS, catalog, DAY)
    fba = outcomes(inv)["FBA"]
    assert fba.rows_analyzed > 0 and fba.rows_found + fba.missing_skus == len(catalog.sku_order)
    missing = {(r.Channel, r.SKU) for r in inv.missing.collect()}
    assert len([1 for c, _ in missing if c == "FBA"]) == fba.missing_skus


def test_unmapped_keys_are_reported(spark, catalog, inputs, tmp_path):
    edit(inputs, "TikTok_orders_", lambda t: t.rstrip("\n") + "\n" + ",".join(
        {"Order Status": "Completed", "SKU ID": "999000999", "Quantity": "3", "SKU Subtotal After Discount": "$6.00"}.get(c, "")
        for c in next(x for x in t.splitlines() if x.strip()).split(",")) + "\n")
    run = sales_run(spark, str(inputs), catalog, DAY)
    lost = {r.source_key: (r.source, float(r.Units), float(r.Revenue)) for r in run.unmapped.collect()}
    assert lost["999000999"] == ("TikTok Shop", 3.0, 6.0)
    publish(spark, run, "sales", str(tmp_path / "out"), DAY)
    written = spark.read.parquet(f"{tmp_path}/out/unmapped_keys").where("source_key = '999000999'")
    assert written.count() == 1


def test_empty_extract_publishes_its_status(spark, catalog, tmp_path):
    (tmp_path / "in").mkdir()
    run = sales_run(spark, str(tmp_path / "in"), catalog, DAY)
    out = str(tmp_path / "out")
    assert publish(spark, run, "sales", out, DAY) is None
    assert {r.status for r in spark.read.parquet(f"{out}/status").collect()} == {"No data"}
    assert {r.status for r in spark.read.parquet(f"{out}/sources").collect()} == {"missing"}
    assert not os.path.exists(f"{out}/reports") and not os.path.exists(f"{out}/run_history")


def test_logged_runs_can_be_left_alone(spark, catalog, tmp_path):
    out = str(tmp_path / "out")
    run = sales_run(spark, REPORTS, catalog, DAY)
    assert publish(spark, run, "sales", out, DAY, timestamp="a", skip_logged=True) is not None
    assert publish(spark, run, "sales", out, DAY, timestamp="b", skip_logged=True) is None
    assert [r.timestamp for r in read_run_log(spark, f"{out}/run_history").collect()] == ["a"]


def test_published_order_and_columns(spark, catalog, tmp_path):
    """O4 in the table and in both exports: channels as configured, bundles first, SKUs as configured."""
    out = str(tmp_path / "out")
    run = sales_run(spark, REPORTS, catalog, DAY)
    publish(spark, run, "sales", out, DAY, exports=("csv", "json"))
    want = [(c, s) for c in catalog.sales_channel_order for s in ("Bundles", *catalog.sku_order)]
    rows = read_ordered(spark, f"{out}/exports/sales_report_{DAY}.csv", PUBLISHED["sales"]).orderBy("position").collect()
    assert [(r.Channel, r.SKU) for r in rows] == want and [r.position for r in rows] == list(range(len(want)))
    parts = sorted(glob.glob(f"{out}/exports/sales_report_{DAY}.json/part-*"))
    lines = [json.loads(x) for p in parts for x in open(p)]
    assert [(x["Channel"], x["SKU"]) for x in lines] == want and "channel_rank" not in lines[0]
    table = read_ordered(spark, f"{out}/reports/report=sales/run_date={DAY}", PUBLISHED["sales"], "parquet").orderBy("position")
    assert [(r.Channel, r.SKU) for r in table.collect()] == want


def test_combined_and_comparison_outputs(spark, catalog, tmp_path):
    folder, out = tmp_path / "in", str(tmp_path / "out")
    folder.mkdir()
    (folder / "inventory_report_2026-01-02.csv").write_text("SKU,Channel,Units,Inventory,Inbound\nB,FBA,1,2,3\nA,FBA,1,2,3\nA,AWD,1,2,3\n")
    (folder / "inventory_report_2026-01-01.csv").write_text("SKU,Channel,Units,Inventory,Inbound\nZ,WFS,1,2,3\n")
    assert combine_inventory(spark, str(folder), out).count() == 4
    schema = "id string, sku_channel_id string, Date date, SKU string, Channel string, Units long, Inventory long, Inbound long"
    got = read_ordered(spark, f"{out}/exports/combined_report.csv", schema).orderBy("position").collect()
    assert [(r.Date, r.Channel, r.SKU) for r in got] == [
        (dt.date(2026, 1, 1), "WFS", "Z"), (dt.date(2026, 1, 2), "AWD", "A"), (dt.date(2026, 1, 2), "FBA", "A"),
        (dt.date(2026, 1, 2), "FBA", "B")]
    recon, _ = compare_amazon(spark, REPORTS, catalog, DAY, out)
    text = [x for p in sorted(glob.glob(f"{out}/exports/amazon_comparison_{DAY}.csv/part-*")) for x in open(p).read().splitlines()]
    heads = [x for x in text if x.startswith("SKU,")]
    skus = [x.split(",")[0] for x in text if not x.startswith("SKU,")]
    assert heads and skus == sorted(skus) and len(skus) == recon.count()


def test_malformed_rows_of_every_kind(spark, tmp_path):
    path = str(tmp_path / "Walmart_sales_2026-01-01.csv")
    with open(path, "w") as fh:
        fh.write('SKU,Units_Sold,GMV\nA,1,2\nB,1,2,lost\nC,1\n"D,x","5 ""a,b""",6\n\nE,1,2,,\n"F\nG",1,2\n')
    good, bad = split_malformed(read_report(spark, path, malformed="quarantine"))
    assert [r.SKU for r in good.orderBy("SKU").collect()] == ["A", "C", "D,x", "F\nG"]
    assert sorted(r[MALFORMED] for r in bad.collect()) == ["B,1,2,lost", "E,1,2,,"]
    assert good.count() == 4 and bad.count() == 2
    for action in (lambda df: df.count(), lambda df: df.select("SKU").collect(), lambda df: df.collect()):
        with pytest.raises(Exception, match="malformed report"):
            action(read_report(spark, path))
    with open(path, "w") as fh:
        fh.write("made by\nsome tool\nSKU,Units_Sold\nA,1\nB,2,3\n")
    good, bad = split_malformed(read_report(spark, path, skip_lines=2, malformed="quarantine"))
    assert [r.SKU for r in good.collect()] == ["A"] and bad.count() == 1
    with open(path, "w") as fh:
        fh.write('one,"a\nb"\nSKU,Units_Sold\nA,1\n')
    with pytest.raises(MalformedReport):
        read_report(spark, path, skip_lines=1)


def test_mappings_read_by_spark(spark, catalog, tmp_path):
    big = Catalog.from_spark(CONFIG)
    for which in ("amazon", "tiktok", "shopify"):
        a = {r.source_key: r.targets for r in catalog.mapping_dim(spark, which).collect()}
        assert a == {r.source_key: r.targets for r in big.mapping_dim(spark, which).collect()}
    one, two = sales_run(spark, REPORTS, catalog, DAY), sales_run(spark, REPORTS, big, DAY)
    assert sorted(one.report.drop("Date").collect()) == sorted(two.report.drop("Date").collect())
    lines = tmp_path / "map"
    lines.mkdir()
    (lines / "a.json").write_text('{"AMAZON_SKU_MAP": {"k1": ["A"], "k2": ["A", "B"]}}\n{"AMAZON_SKU_MAP": {"k3": null, "k1": ["A"]}}\n')
    got = {r.source_key: r.targets for r in unique_mapping(read_mapping(spark, str(lines), "AMAZON_SKU_MAP")).collect()}
    assert got == {"k1": ["A"], "k2": ["A", "B"], "k3": []}
    (lines / "b.json").write_text('{"AMAZON_SKU_MAP": {"k2": ["B", "A"]}}\n')
    with pytest.raises(DuplicateKeys, match="k2"):
        unique_mapping(read_mapping(spark, str(lines), "AMAZON_SKU_MAP"))
    broken = Catalog(**{**big.__dict__, "mapping_paths": {**big.mapping_paths, "amazon": (str(lines), "AMAZON_SKU_MAP")}})
    got = outcomes(sales_run(spark, REPORTS, broken, DAY))
    assert got["Amazon"].status == "refused" and got["TikTok Shop"].status == "loaded"
