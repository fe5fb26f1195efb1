"""Every registered query against its DuckDB oracle on the smallest driver tables
(the driver repeats this at sf0.01)."""

import math
import re

import duckdb
import pytest

import __spark_entry__ as entry
from tests.conftest import SF_SMALL

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else v
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    yield con
    con.close()


def test_every_query_has_an_oracle_or_is_rows_only():
    q, sql = entry.queries(), entry.oracle_sql()
    assert set(sql) <= set(q)
    own = {k for k in q if not re.match(r"op\d+_|pipeline$", k)}  # the optional operators test their own
    assert own == set(sql) & own


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_matches_oracle(spark, duck, name):
    df = entry.queries()[name](spark, SF_SMALL)
    res = duck.execute(entry.oracle_sql()[name])
    dcols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(dcols)
    assert _rows(df.columns, [tuple(r) for r in df.collect()]) == _rows(dcols, res.fetchall())


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["id", "sku_channel_id", "Date", "SKU", "Channel", "Units", "Revenue"]
    assert df.count() > 0


def test_report_invariants(spark):
    from pyspark.sql import functions as F

    from skuflow.plans import warehouse as w

    t = w.Tables(spark, SF_SMALL)
    skus = w.master_skus(t).count()
    sales = w.sales_report_zero_filled(spark, SF_SMALL)
    agg = sales.agg(F.count(F.lit(1)).alias("n"), F.countDistinct("id").alias("ids")).first()
    assert agg.n == agg.ids == len(w.CHANNELS) * (skus + 1)
    inv = w.inventory_report_zero_filled(spark, SF_SMALL)
    agg = inv.agg(F.count(F.lit(1)).alias("n"), F.countDistinct("id").alias("ids"),
                  F.min(F.least("Units", "Inventory", "Inbound")).alias("low")).first()
    assert agg.n == agg.ids == len(w.INVENTORY_CHANNELS) * skus and agg.low >= 0
