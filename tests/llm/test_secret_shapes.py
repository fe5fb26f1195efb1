"""Candidates of any length, PEM blocks in linear time, the dictionary and all features of the forest."""

import time

import pytest
from pyspark.sql import functions as F

from skuflow.llm import secrets


@pytest.mark.parametrize("text, value", [
    (f'token = "{"A1b2" * 60}" x', "A1b2" * 60), (f"password='{'q9 Z' * 100}'", "q9 Z" * 100),
    (f"ftp://{'u' * 90}:{'p4' * 90}@x.org", "p4" * 90)])
def test_long_values(text, value):
    assert value in [text[a:b] for a, b in secrets.spans(text)]


def test_pem_blocks():
    start, end = "-----BEGIN RSA PRIVATE KEY-----\n", "-----END RSA PRIVATE KEY-----"
    one, two = start + "MII+/=\n" + end, "-----BEGIN PRIVATE KEY-----\nZZ\n-----END PRIVATE KEY-----"
    text = f"{end} a {one} b {start} no? {end} {two}"
    assert [text[a:b] for a, b in secrets.pem_blocks(text)] == [one, two]
    assert secrets.pem_blocks(start * 3 + end) == [(0, 3 * len(start) + len(end))]
    begun = time.perf_counter()
    assert secrets.pem_blocks(start * 8000) == []
    assert time.perf_counter() - begun < 1


def test_dictionary_is_the_most_frequent(make):
    texts = ["one two three four five", "one two three four", "Two THREE", "three", None, ""]
    docs = make(list(enumerate(texts)))
    assert [secrets.dictionary(docs, size=n) for n in (1, 3, 4, 99)] == [
        ["three"], ["three", "two", "four"], ["three", "two", "four", "one"], ["three", "two", "four", "one", "five"]]
    assert secrets.dictionary(docs.limit(0)) == []


def test_forest_keeps_the_features_of_rules(spark):
    """With ``blind``, rows that lack a rule's features are judged by the rest, and rows that have them by both."""
    n = len(secrets.NAMES)
    row = lambda i, hot, assigned: [float(i % 7 + 20 * hot), *([0.0] * (n - 1))][:13] + [float(assigned)] + [0.0] * (n - 14)
    rows = [(f"v{i}", i % 2, row(i, i % 2, i % 2)) for i in range(200)]
    findings = spark.createDataFrame(rows, "value string, weak int, features array<double>")
    forest = secrets.train(findings, "weak", blind=secrets.RULED)
    assert forest.featureImportances[secrets.NAMES.index("assigned")] > 0
    vectors = spark.createDataFrame([(row(3, 1, 0),), (row(3, 0, 0),)], "features array<double>").select(
        secrets.array_to_vector(F.col("features")).alias("vector"))
    assert [r["prediction"] for r in forest.transform(vectors).collect()] == [1.0, 0.0]
