"""F1–F20 and the predicate helpers on literal rows."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from skuflow import functions as S


def one(spark, expr, value, schema="v string"):
    return spark.createDataFrame([(value,)], schema).select(expr.alias("r")).first()["r"]


@pytest.mark.parametrize("raw,expected", [
    ("$1,200.50", Decimal("1200.5")), ("29.97", Decimal("29.97")), ("", Decimal("0")), (None, Decimal("0")),
    (" $5 ", Decimal("5")),
])
def test_clean_money(spark, raw, expected):
    assert one(spark, S.clean_money("v"), raw) == expected


def test_clean_money_number_input(spark):
    assert one(spark, S.clean_money("v"), 10, "v int") == Decimal("10")


def test_clean_money_strict_raises_on_junk(spark):
    with pytest.raises(Exception):
        one(spark, S.clean_money("v"), "abc")


def test_clean_money_null_mode_counts_junk(spark):
    df = spark.createDataFrame([("abc",), ("$3",), (None,)], "v string")
    out = df.select(S.coerced("v", S.clean_money("v", on_error="null")).alias("c")).agg(F.sum("c")).first()[0]
    assert out == 1


@pytest.mark.parametrize("raw,expected", [("1,200", 0.0), (" 5 ", 5.0), ("nan", 0.0), (None, 0.0), ("x", 0.0),
                                          ("7", 7.0)])
def test_to_number(spark, raw, expected):
    assert one(spark, S.to_number("v"), raw) == expected


def test_text_helpers(spark):
    assert one(spark, S.strip_trailing_s("v"), "4430s") == "4430"
    assert one(spark, S.strip_trailing_s("v"), "4430ss") == "4430s"
    assert one(spark, S.underscore_spaces("v"), "TikTok Shop") == "TikTok_Shop"
    assert one(spark, S.blank_to_null("v"), "  ") is None
    assert one(spark, S.blank_to_null("v"), "N/A") is None
    assert one(spark, S.blank_to_null("v"), " 4410 ") == "4410"


def test_null_safe_predicates(spark):
    df = spark.createDataFrame([("CANCELLED",), ("FULFILLED",), (None,)], "s string")
    kept = df.where(S.not_equal_keep_null("s", "CANCELLED")).collect()
    assert {r.s for r in kept} == {None, "FULFILLED"}
    df2 = spark.createDataFrame([("Cancelled by buyer",), ("Completed",), (None,)], "s string")
    assert df2.where(S.excludes_ci("s", "cancel")).count() == 2
    assert df2.where(S.equals_ci("s", " completed ")).count() == 0
    assert df2.where(S.equals_ci("s", "completed")).count() == 1


def test_ids(spark):
    df = spark.createDataFrame([("TikTok Shop", "4410")], "Channel string, SKU string")
    r = df.select(S.row_id(F.to_date(F.lit("2026-02-11"))).alias("id"), S.sku_channel_id().alias("sc"),
                  S.sku_channel_id(underscore=False).alias("raw")).first()
    assert r.id == "20260211_TikTok_Shop_4410" and r.sc == "TikTok_Shop_4410" and r.raw == "TikTok Shop_4410"


def test_date_from_name(spark):
    import datetime as dt
    assert one(spark, S.date_from_name("v", "FBA_report_", ".csv"), "FBA_report_2026-02-11.csv") == dt.date(2026, 2, 11)
    assert one(spark, S.date_from_name("v", "FBA_report_", ".csv"), "fba_REPORT_2026-02-11.csv") == dt.date(2026, 2, 11)
    assert one(spark, S.date_from_name("v", "FBA_report_", ".csv"), "FBA_report_2026-02-30.csv") is None
    assert one(spark, S.date_from_name("v", "FBA_report_", ".csv"), "AWD_report_2026-02-11.csv") is None


def test_rounding_truncation_clip(spark):
    assert one(spark, S.round_money(F.col("v")), Decimal("0.125"), "v decimal(10,4)") == Decimal("0.12")
    assert one(spark, S.round_money(F.col("v")), Decimal("0.135"), "v decimal(10,4)") == Decimal("0.14")
    assert one(spark, S.truncate_long(F.col("v")), -2.7, "v double") == -2
    assert one(spark, S.clip_low(F.col("v")), -3, "v long") == 0
    assert one(spark, S.row_sum("v", F.lit(None), F.lit(2)), 3, "v long") == 5


def test_items_json(spark):
    df = spark.createDataFrame([('[{"dsku":"A","qty":2},{"dsku":"B"}]',), ("not json",), (None,)], "v string")
    items = df.select(F.explode(S.parse_items("v")).alias("i")).select(
        "i.dsku", F.coalesce("i.qty", F.lit(0)).alias("qty")).collect()
    assert sorted((r.dsku, r.qty) for r in items) == [("A", 2), ("B", 0)]
    assert one(spark, S.json_field("v", "k"), '{"k": 69}') == "69"
    assert one(spark, S.json_field("v", "missing", "0"), '{"k": 69}') == "0"
