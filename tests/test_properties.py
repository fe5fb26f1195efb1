"""Invariants of the mapping operator against a brute-force row-by-row expansion
(the reference's per-row semantics), on generated facts and mappings."""

from collections import defaultdict

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from skuflow.operators.mapping import BUNDLES_SKU, map_sales
from skuflow.operators.spine import grid, onto_grid

KEYS = ["k1", "k2", "k3", "k4", " k5 ", ""]
SKUS = ["A", "B", "C"]

facts_st = st.lists(st.tuples(st.sampled_from(KEYS), st.integers(-3, 9),
                              st.decimals(min_value=-50, max_value=500, places=2, allow_nan=False)),
                    min_size=1, max_size=25)
mapping_st = st.dictionaries(st.sampled_from(["k1", "k2", "k3", "k5"]),
                             st.lists(st.sampled_from(SKUS), min_size=1, max_size=3), max_size=4)


def brute(facts, mapping):
    units, rev, b_units, b_rev, un_units = defaultdict(float), defaultdict(float), 0.0, 0.0, 0.0
    for k, q, r in facts:
        key = k.strip()
        if not key:
            continue
        targets = mapping.get(key)
        if targets is None:
            un_units += q
            continue
        for t in targets:
            units[t] += q
            rev[t] += float(r) / len(targets)
        if len(targets) > 1:
            b_units += q
            b_rev += float(r)
    return units, rev, b_units, b_rev, un_units


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(facts=facts_st, mapping=mapping_st)
def test_map_sales_matches_row_by_row(spark, facts, mapping):
    df = spark.createDataFrame([(k, float(q), r) for k, q, r in facts], "k string, q double, r decimal(18,2)")
    m = spark.createDataFrame([(k, v) for k, v in mapping.items()] or [("zz", ["A"])],
                              "source_key string, targets array<string>")
    got = map_sales(df, m, "k", "q", "r")
    units, rev, b_units, b_rev, un_units = brute(facts, mapping)
    sales = {r.SKU: (r.Units, float(r.Revenue)) for r in got.sales.collect()}
    assert set(sales) == {s for s in units}
    for s, (u, v) in sales.items():
        assert u == units[s]
        assert abs(v - rev[s]) < 1e-3 * max(1, len(facts))      # split fixed to 4 decimals per key
    b = got.bundles.collect()
    assert (float(b[0].Units) if b else 0.0) == b_units
    assert abs((float(b[0].Revenue) if b else 0.0) - b_rev) < 1e-9
    un = got.long.where(F.col("SKU").isNull()).collect()
    assert (un[0].Units if un else 0.0) == un_units
    # every non-blank fact row is attributed exactly once (Q5 rows)
    assert (got.long.agg(F.sum("rows")).first()[0] or 0) == sum(1 for k, _, _ in facts if k.strip())


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(facts=facts_st, mapping=mapping_st, channels=st.lists(st.sampled_from(["X", "Y Z", "W"]), min_size=1,
                                                             max_size=3, unique=True))
def test_grid_is_complete_and_unique(spark, facts, mapping, channels):
    df = spark.createDataFrame([(k, float(q), r, channels[i % len(channels)]) for i, (k, q, r) in enumerate(facts)],
                               "k string, q double, r decimal(18,2), Channel string")
    m = spark.createDataFrame([(k, v) for k, v in mapping.items()] or [("zz", ["A"])],
                              "source_key string, targets array<string>")
    long = map_sales(df.withColumn("Date", F.to_date(F.lit("2026-01-01"))), m, "k", "q", "r", by=["Channel"],
                     date_col="Date").long
    skus = spark.createDataFrame([(s,) for s in SKUS], "SKU string")
    out = onto_grid(grid(skus, channels, with_bundles=True), long, ["Units", "Revenue"], "2026-02-01", channels)
    rows = out.collect()
    assert len(rows) == len(channels) * (len(SKUS) + 1)
    assert len({(r.Channel, r.SKU) for r in rows}) == len(rows)
    total = sum(r.Units for r in rows if r.SKU != BUNDLES_SKU)
    _, _, _, _, _ = brute(facts, mapping)
    expected = sum(q * len(mapping[k.strip()]) for k, q, _ in facts if k.strip() in mapping)
    assert total == expected
