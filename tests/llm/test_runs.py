"""Periodic runs against brute force over all periods and starts."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from skuflow.llm import queries, runs

SF = "/root/testdata/sf0.001"


def slow_runs(w, least=6, times=4, most=1000):
    """By all periods up to ``most``: no text here has a smallest period beyond it."""
    found = {}
    for q in range(1, min(len(w) // times, most) + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j + q - i >= max(least, times * q):
                found.setdefault((i, j + q - i), q)  # the smallest period comes first
            i = max(j, i + 1)
    return sorted((s, n, q) for (s, n), q in found.items())


def random_words(rng):
    w = []
    for _ in range(rng.randrange(6)):
        if rng.random() < 0.5:
            w += [str(rng.randrange(rng.choice([1, 2, 3, 50]))) for _ in range(rng.randrange(30))]
        else:
            unit = [str(rng.randrange(rng.choice([1, 2, 5, 40]))) for _ in range(rng.randrange(1, rng.choice([4, 12, 60])))]
            w += (unit * rng.randrange(2, 9))[:rng.randrange(1, 400)]
    return w


@pytest.mark.parametrize("least, times", [(6, 4), (1, 4), (30, 5)])
def test_matches_brute_force(least, times):
    rng = random.Random(times * 100 + least)
    for _ in range(120):
        docs = [random_words(rng) for _ in range(rng.randrange(1, 12))]
        ids = np.array([int(x) for w in docs for x in w], np.int64)
        got = runs.find_runs(ids, np.array([len(w) for w in docs]), least, times)
        assert got == [(i, *r) for i, w in enumerate(docs) for r in slow_runs(w, least, times)]


def test_equal_fingerprints_decide_nothing(monkeypatch):
    """With all fingerprints equal every block is a hit, and the words alone give the same runs."""
    monkeypatch.setattr(runs, "_ODD", (np.uint64(0), np.uint64(0)))
    rng = random.Random(8)
    for _ in range(30):
        docs = [random_words(rng)[:150] for _ in range(4)]
        ids = np.array([int(x) for w in docs for x in w], np.int64)
        got = runs.find_runs(ids, np.array([len(w) for w in docs]))
        assert got == [(i, *r) for i, w in enumerate(docs) for r in slow_runs(w)]


def test_long_texts_stay_cheap():
    one = np.zeros(300_000, np.int64)
    assert runs.find_runs(one, np.array([300_000])) == [(0, 0, 300_000, 1)]
    unit = np.arange(40_000)
    ids = np.concatenate([unit, unit, unit, unit, unit[:7], np.arange(50_000, 90_000)])
    assert runs.find_runs(ids, np.array([len(ids)])) == [(0, 0, 160_007, 40_000)]
    with pytest.raises(ValueError):
        runs.find_runs(one, np.array([300_000]), times=3)


def expected(doc_id, text, planted=True):
    w = (text or "").encode().split()
    if planted and doc_id is not None and w and zlib.crc32(str(doc_id).encode()) % 10 == 0:
        n, g = len(w), zlib.crc32(str(doc_id).encode()) // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    found = slow_runs(w)
    gone = {i for s, n, q in found for i in range(s + q, s + n)}
    best = min(found, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=(None, None, None))
    return (doc_id, len(found), *best, None if best[0] is None else 1000 * best[1] // best[2],
            hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in found).encode()).hexdigest(),
            hashlib.sha256(b" ".join(x for i, x in enumerate(w) if i not in gone)).hexdigest())


def test_query_matches_brute_force(spark):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = sorted(tuple(r) for r in queries.op13_runs(spark, SF).collect())
    small = {i for i, t in texts.items() if len((t or "").split()) < 1200}
    assert len(got) == len(texts) and len(small) > 150
    assert [r for r in got if r[0] in small] == sorted(expected(i, texts[i]) for i in small)
    assert sum(r[1] for r in got) > 10


def test_odd_rows(make, odd_rows):
    loop = "a b c " * 30
    rows = [*odd_rows, (20, loop), (20, loop), (None, loop), (21, "    " * 9), (22, "x\x00 x\x00 " * 5)]
    docs = make(rows).withColumn("runs", F.lit(1)).withColumn("collapsed", F.lit(1))
    key = lambda r: (r[0] is None, r[0] or 0, r[7])
    got = sorted((tuple(r) for r in runs.digest(runs.periodic_runs(docs)).collect()), key=key)
    assert got == sorted((expected(r[0], r[1], planted=False) for r in rows), key=key)
    assert runs.periodic_runs(docs.limit(0)).collect() == []
