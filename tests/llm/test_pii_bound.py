"""The bound on term and entity counts loses no term."""

import math
import random

from pyspark.sql import functions as F

from skuflow.llm import pii


def corpus():
    rng = random.Random(6)
    rows = []
    for i in range(400):
        words = [f"w{min(int(rng.expovariate(0.05)), 200)}" for _ in range(rng.randrange(5, 40))]
        if i % 5 == 0:
            who, at = rng.choice([1, 1, 1, 2, 2, i]), rng.randrange(len(words))
            words[at:at] = [f"owner{who}", f"mail{who}@example.org"]
        if i % 25 == 0:
            words += ["secretname", f"+49 170 {i:07d}"]
        rows.append((i, " ".join(words)))
    return rows + rows[:40] + [(None, rows[0][1]), (500, None), (501, "")]


def test_spans_are_the_same_without_the_bound(make, monkeypatch):
    docs = make(corpus())
    with_bound = sorted(pii.report(docs).drop("text_hash").collect(), key=str)
    pairs = pii.entity_terms(docs, pii.entity_texts(pii.base_spans(docs))).count()
    monkeypatch.setattr(pii, "_possible", lambda *a: F.lit(True))
    assert sorted(pii.report(docs).collect(), key=str) == with_bound
    assert pii.entity_terms(docs, pii.entity_texts(pii.base_spans(docs))).count() > 2 * pairs
    assert sum(r["n_term"] for r in with_bound) > 20


def test_terms_match_brute_force(make):
    """df, weights and disclosure counted by hand over all documents."""
    rows = corpus()
    docs = make(rows)
    got = {(r["entity"], r["term"]): r["disclosure"] for r in pii.disclosing_terms(
        pii.entity_terms(docs, pii.entity_texts(pii.base_spans(docs)))).collect()}
    spans = {r["text_hash"]: r for r in pii.entity_texts(pii.base_spans(docs)).collect()}
    n, df_term = len(rows), {}
    for r in docs.select(pii._terms(F.col("text")).alias("t")).collect():
        for t in r["t"]:
            df_term[t] = df_term.get(t, 0) + 1
    df_entity, weight = {}, {}
    for r in spans.values():
        near = {}
        for p in r["places"]:
            near.setdefault(p["entity"], set()).update(p["close"])
        for e, close in near.items():
            df_entity[e] = df_entity.get(e, 0) + r["n"]
            for t in r["terms"]:
                both, w = weight.get((e, t), (0, 0.0))
                weight[e, t] = both + r["n"], w + r["n"] * (1.0 if t in close else pii.FAR)
    want = {}
    for (e, t), (both, w) in weight.items():
        rate = df_entity[e] / n
        given = (w + pii.PRIOR * rate) / (max(df_term[t], both) + pii.PRIOR)
        score = math.log(given / rate) / math.log(1 / rate)
        if score >= 0.9:
            want[e, t] = score
    assert got.keys() == want.keys() and len(want) > 10
    assert all(abs(got[k] - want[k]) < 1e-9 for k in want)
