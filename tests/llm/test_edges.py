"""Every operator and stage on odd rows and on an empty table."""

import pytest

import corpus_pipeline
from skuflow.llm import ctw, decontaminate, mixing, pii, quality, secrets, simhash, suffixes, toxicity, urlfilter

PER_ROW = {
    "ctw": ctw.score, "suffixes": suffixes.remove_repeats, "mixing": mixing.mix, "simhash": simhash.near_duplicates,
    "quality": quality.judge, "pii": pii.report,
}


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (1, 1, 0), (2, None, None), (None, 0, 1)], "doc_id long, quality int, toxic int")


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame([(1, "a b c d e f"), (2, None), (3, ""), (None, "x y z"), (4, "one two")],
                                 "item_id long, text string")


@pytest.mark.parametrize("name", sorted(PER_ROW))
def test_one_row_per_document(make, odd_rows, name):
    docs = make(odd_rows)
    got = sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in PER_ROW[name](docs).collect())
    assert got == sorted((r[0] is None, r[0] or 0) for r in odd_rows)
    assert PER_ROW[name](docs.limit(0)).collect() == []


def test_toxicity_without_classes(make, odd_rows, labels):
    docs = make(odd_rows)
    got = toxicity.score(docs, toxicity.fit(docs, labels)).collect()
    assert len(got) == len(odd_rows) and {r["predicted"] for r in got} == {0}
    assert toxicity.score(docs.limit(0), toxicity.fit(docs.limit(0), labels.limit(0))).collect() == []


def test_secrets_and_leaks_on_odd_rows(make, odd_rows, items):
    docs = make(odd_rows)
    assert all(r["doc_id"] == 8 for r in secrets.find_secrets(docs).collect())
    assert secrets.find_secrets(docs.limit(0)).collect() == []
    assert [(r["doc_id"], r["item_id"]) for r in decontaminate.find_leaks(docs, items).collect()] == [(7, 4)]
    assert decontaminate.find_leaks(docs.limit(0), items).collect() == []
    assert decontaminate.find_leaks(docs, items.limit(0)).collect() == []
    assert decontaminate.decontaminate(docs, items).count() == len(odd_rows) - 1


def test_urls_on_odd_rows(spark):
    pages = spark.createDataFrame([(1, None, None), (1, None, None), (None, "no scheme", ""), (2, "http://", "<a href="),
                                   (3, "x://A.COM", "<a href='//b.org/'>")], "page_id long, url string, html string")
    pages = pages.selectExpr("*", "'h' AS host", "1 AS rule", "2 AS score")
    got = {(r["page_id"], r["host"], r["path"], r["rule"], r["verdict"]) for r in urlfilter.judge(pages).collect()}
    assert got == {(1, "", "", None, "allow"), (None, "", "", None, "allow"), (2, "", "", None, "allow"),
                   (3, "a.com", "", None, "allow")}
    assert urlfilter.judge(pages.limit(0)).collect() == []


def test_stages_keep_columns(spark, make, odd_rows, labels, items, tmp_path):
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    items.write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = make(odd_rows)
    counts = {"toxicity": 13, "simhash": 10, "decontaminate": 12, "pii": 13}
    for name, step in corpus_pipeline.STAGES:
        got = step(spark, docs, str(tmp_path))
        assert set(docs.columns) <= set(got.columns)
        if name in counts:
            assert got.columns == docs.columns and got.count() == counts[name], name
        else:
            assert got.count() > 0
        assert step(spark, docs.limit(0), str(tmp_path)).count() == 0
