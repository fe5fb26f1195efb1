"""H1–H4, D1–D4 and the quality operators Q1–Q7."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from skuflow.operators import history as H
from skuflow.operators import quality as Q
from skuflow.operators.reconcile import parity, reconcile, reconcile_totals


def test_normalize_legacy_snapshot(spark):
    legacy = spark.createDataFrame([("4410", "FBA", 3, 10, None, "old")],
                                   "sku string, channel string, units_sold long, inventory long, inbound long, id string")
    out = H.normalize_snapshot(legacy, "2025-12-01").first()
    assert (out.id, out.Date, out.Units, out.Inbound) == ("20251201_FBA_4410", dt.date(2025, 12, 1), 3, 0)
    spaced = spark.createDataFrame([("4410", "TikTok Shop", 1, 2, 3)],
                                   "SKU string, Channel string, Units long, Inventory long, Inbound long")
    assert H.normalize_snapshot(spaced, "2025-12-02").first().id == "20251202_TikTok Shop_4410"   # L16
    missing = spark.createDataFrame([("4410",)], "SKU string")
    assert H.normalize_snapshot(missing, "2025-12-02") is None


def test_combine(spark):
    a = spark.createDataFrame([("1", "A", 1, 1, 1)], "SKU string, Channel string, Units long, Inventory long, Inbound long")
    frames = [H.normalize_snapshot(a, "2025-01-01"), H.normalize_snapshot(a, "2025-01-02")]
    assert H.combine_snapshots(frames).count() == 2


def test_run_summary_goldens(spark):
    sales = spark.createDataFrame([("a", dt.date(2026, 1, 1), 10, 100.0), ("b", dt.date(2026, 1, 2), 20, 50.55)],
                                  "SKU string, Date date, Units long, Revenue double")
    r = H.run_summary(sales, "sales", ["a.csv", "b.csv"], "2026-01-02T10:00:00").first()
    assert (r.total_units, r.total_revenue, r.report_date, r.source_files, r.total_records) == (
        30, 150.55, dt.date(2026, 1, 2), "a.csv, b.csv", 2)
    inv = sales.drop("Revenue")
    assert H.run_summary(inv, "inventory", []).first().total_revenue is None
    assert H.run_summary(sales.limit(0), "sales", []).count() == 0          # no-op when empty


def _run(spark, pipeline, day, units, stamp="t"):
    return spark.createDataFrame([(stamp, pipeline, dt.date.fromisoformat(day), 1, units, 1.0, "f")], H.LOG_SCHEMA)


def test_run_log_is_keyed(spark, tmp_path):
    path = str(tmp_path / "log")
    assert H.read_run_log(spark, path).count() == 0
    for args in [("sales", "2026-01-01", 1, "a"), ("sales", "2026-01-01", 2, "b"), ("sales", "2026-01-02", 3),
                 ("inventory", "2026-01-01", 4), ("sales", "2026-01-01", 5, "c")]:
        H.upsert_run_log(_run(spark, *args), path)
    got = sorted((r.pipeline, str(r.report_date), r.total_units, r.timestamp) for r in H.read_run_log(spark, path).collect())
    assert got == [("inventory", "2026-01-01", 4, "t"), ("sales", "2026-01-01", 5, "c"), ("sales", "2026-01-02", 3, "t")]


def test_json_log_restarts_when_malformed(spark, tmp_path):
    path, aside = str(tmp_path / "log"), str(tmp_path / "aside")
    assert H.upsert_json_log(_run(spark, "sales", "2026-01-01", 1), path, aside) == 0
    assert H.upsert_json_log(_run(spark, "sales", "2026-01-02", 2), path, aside) == 0
    assert H.upsert_json_log(_run(spark, "sales", "2026-01-02", 3), path, aside) == 0
    good, bad = H.read_json_log(spark, path)
    assert sorted(r.total_units for r in good.collect()) == [1, 3] and bad.count() == 0
    (tmp_path / "log" / "more.json").write_text('{"pipeline": "sales", "report_da\n{"timestamp": "x"}\n\n')
    assert H.read_json_log(spark, path)[1].count() == 2
    assert H.upsert_json_log(_run(spark, "sales", "2026-01-03", 4), path, aside) == 2
    good, bad = H.read_json_log(spark, path)
    assert [r.total_units for r in good.collect()] == [4] and bad.count() == 0
    assert sorted(r.raw for r in spark.read.parquet(aside).collect()) == ['{"pipeline": "sales", "report_da', '{"timestamp": "x"}']


def test_history_reads_only_unseen_dates(spark, tmp_path):
    folder, table = tmp_path / "in", str(tmp_path / "history")
    folder.mkdir()
    head = "SKU,Channel,Units,Inventory,Inbound\n"
    (folder / "inventory_report_2026-01-01.csv").write_text(head + "A,FBA,1,2,3\n")
    (folder / "inventory_report_2026-01-02.csv").write_text("sku,channel,units_sold,inventory,inbound\nA,FBA,4,5,6\n")
    (folder / "inventory_report_2026-01-03.csv").write_text("SKU,Channel\nA,FBA\n")
    assert H.update_history(spark, str(folder), table) == ["2026-01-01", "2026-01-02"]
    (folder / "inventory_report_2026-01-01.csv").write_text("not,read,again\n")
    (folder / "inventory_report_2026-01-04.csv").write_text(head + "A,FBA,7,8,9\n")
    assert H.update_history(spark, str(folder), table) == ["2026-01-04"]
    assert H.update_history(spark, str(folder), table) == []
    (folder / "inventory_report_2026-01-02.csv").write_text(head + "A,FBA,10,5,6\nB,FBA,0,0,0\n")
    assert H.update_history(spark, str(folder), table, again=["2026-01-02"]) == ["2026-01-02"]
    got = sorted((str(r.Date), r.SKU, r.Units) for r in H.read_history(spark, table).collect())
    assert got == [("2026-01-01", "A", 1), ("2026-01-02", "A", 10), ("2026-01-02", "B", 0), ("2026-01-04", "A", 7)]


def test_anomaly_and_guard_and_trend(spark):
    days = [(dt.date(2026, 1, d), 100) for d in range(1, 9)] + [(dt.date(2026, 1, 9), 400)]
    hist = spark.createDataFrame([("sales", d, u) for d, u in days], "pipeline string, report_date date, total_units long")
    flags = {r.report_date.day: (r.baseline, r.is_anomaly) for r in H.anomaly_flags(hist).collect()}
    assert flags[1] == (None, False) and flags[8] == (100.0, False) and flags[9] == (100.0, True)
    log = hist.where("report_date < '2026-01-05'")
    assert H.not_yet_logged(hist, log).count() == 5
    snaps = spark.createDataFrame([("1", "A", dt.date(2026, 1, 1), 5), ("1", "A", dt.date(2026, 1, 2), 8)],
                                  "SKU string, Channel string, Date date, Units long")
    t = {r.Date.day: (r.prev_Units, r.delta_Units) for r in H.trend(snaps).collect()}
    assert t == {1: (None, None), 2: (5, 3)}


def test_reconcile(spark):
    old = spark.createDataFrame([("4410", 10.0, 259.9), ("4430", 5.0, 79.95)], "SKU string, Units double, Revenue double")
    new = spark.createDataFrame([("4410", 1.0, 24.99), ("4430", 5.0, 79.95), ("4450", 1.0, 1.0)],
                                "SKU string, Units double, Revenue double")
    r = {x.SKU: x for x in reconcile(old, new).collect()}
    assert (r["4410"].Units_Diff, r["4410"].Rev_Diff) == (-9.0, -234.91)
    assert r["4450"].in_new and not r["4450"].in_old and r["4450"].Old_Units == 0
    t = reconcile_totals(reconcile(old, new)).first()
    assert (t.only_in_old, t.only_in_new, t.units_diff_count, t.parsers_agree) == (0, 1, 2, False)
    p = {x.SKU: x.within_tolerance for x in parity(reconcile(old, new), rel_tol=0.01).collect()}
    assert p == {"4410": False, "4430": True, "4450": False}


def test_quality_ops(spark):
    df = spark.createDataFrame([("a", 1.0, 2), (None, -1.0, 3), ("c", 2.5, None)], "name string, bal double, n int")
    assert Q.missing_columns(df, ["name", "zzz"]) == ["zzz"]
    c = Q.Contract.of(required=["name"], non_negative=["bal"], integral=["bal"])
    v = {(r.column, r.rule): r.violations for r in Q.violation_counts(df, c).collect()}
    assert v == {("name", "required"): 1, ("bal", "non_negative"): 1, ("bal", "integral"): 1}
    bad = Q.violating_rows(df, c).collect()
    assert len(bad) == 2
    with pytest.raises(Q.ContractViolation):
        Q.gate(df, c)
    Q.gate(df.where("name = 'a'"), c)
    m = Q.source_metrics(df, df.where("n IS NOT NULL"), "src").first()
    assert (m.rows_analyzed, m.rows_found) == (3, 2)
    dates = spark.createDataFrame([("FBA", dt.date(2026, 1, 1))], "Channel string, Date date")
    st = {r.Channel: r.status for r in Q.channel_status(["FBA", "AWD"], dates).collect()}
    assert st == {"FBA": "2026-01-01", "AWD": "No data"}
    sk = spark.createDataFrame([("1",), ("2",)], "SKU string")
    present = spark.createDataFrame([("A", "1")], "ch string, SKU string")
    miss = {(r.ch, r.SKU) for r in Q.missing_skus(present, sk, "ch", ["A", "B"]).collect()}
    assert miss == {("A", "2"), ("B", "1"), ("B", "2")}
    raw = spark.createDataFrame([("1",), ("x",), (None,)], "v string")
    cnt = Q.coercion_counts(raw, {"bad": ("v", F.col("v").try_cast("double"))}).first().bad
    assert cnt == 1


def test_read_snapshots_mixed_headers(spark, tmp_path):
    (tmp_path / "inventory_report_2025-01-01.csv").write_text(
        "id,sku,channel,units_sold,inventory,inbound\nx,4410,FBA,1,2,3\nx,4420,FBA,,5,6\n")
    (tmp_path / "inventory_report_2025-02-01.csv").write_text(
        "id,sku_channel_id,Date,SKU,Channel,Units,Inventory,Inbound\na,b,2025-01-31,4410,TikTok Shop,7,8,9\n")
    (tmp_path / "inventory_report_2025-03-01.csv").write_text("SKU,Channel\n4410,FBA\n")   # skipped
    (tmp_path / "notes.csv").write_text("a\n")
    out = {(r.Date.isoformat(), r.SKU, r.Channel): (r.id, r.Units, r.Inventory, r.Inbound)
           for r in H.read_snapshots(spark, str(tmp_path)).collect()}
    assert out == {
        ("2025-01-01", "4410", "FBA"): ("20250101_FBA_4410", 1, 2, 3),
        ("2025-01-01", "4420", "FBA"): ("20250101_FBA_4420", 0, 5, 6),
        ("2025-02-01", "4410", "TikTok Shop"): ("20250201_TikTok Shop_4410", 7, 8, 9),
    }


def test_run_summary_bundles_double_count(spark):
    rep = spark.createDataFrame([("4410", dt.date(2026, 1, 1), 4, 10.0), ("Bundles", dt.date(2026, 1, 1), 2, 5.0)],
                                "SKU string, Date date, Units long, Revenue double")
    assert H.run_summary(rep, "sales", []).first().total_units == 6                      # L6: by design
    assert H.run_summary(rep, "sales", [], exclude_bundles=True).first().total_units == 4
