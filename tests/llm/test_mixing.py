"""Targets under repeated and missing ids, and whole documents."""

from collections import Counter

import pytest

from skuflow.llm import mixing


def taken_by_source(got):
    taken, target = Counter(), {}
    for r in got:
        assert r["taken"] == r["copies"] * r["size"] and r["copies"] <= 2
        taken[r["source"]] += r["taken"]
        target[r["source"]] = r["target"]
    return taken, target


def decisions(got):
    return Counter((r["doc_id"], r["source"], r["size"], r["copies"]) for r in got)


@pytest.mark.parametrize("parts", [3, 1024])
@pytest.mark.parametrize("hot", [None, 7])
def test_half_of_a_source_under_one_id(make, monkeypatch, hot, parts):
    """Half of the rows of one size share an id and a text; each target is met within one document a cell."""
    monkeypatch.setattr(mixing, "PARTS", parts)
    monkeypatch.setattr(mixing, "BUCKET_ROWS", 200)
    ten = " ".join(["word"] * 10)
    rows = [(hot, ten, "a") for _ in range(1500)] + [(100 + i, ten, "a") for i in range(1500)]
    rows += [(5000 + i, f"{ten} x{i}", "b") for i in range(900)] + [(hot, "x y z", None) for _ in range(700)]
    rows += [(None, None, "a"), (9, "", "a"), (9, "", "a")]
    got = mixing.mix(make(rows)).collect()
    assert len(got) == len(rows)
    taken, target = taken_by_source(got)
    for source, size in (("a", 10), ("b", 11), (None, 3)):
        assert abs(taken[source] - target[source]) <= size, source
    again = mixing.mix(make(rows[::-1]).repartition(11)).collect()
    assert decisions(again) == decisions(got)
    kept = mixing.mixed_documents(make(rows)).collect()
    assert decisions(kept) == Counter({k: n for k, n in decisions(got).items() if k[3]})
    assert {r["component_id"] for r in kept} == {"c"}


def test_rows_of_one_id_are_decided_by_their_text(make):
    rows = [(1, f"text number {i} of one id", "a") for i in range(400)] + [(2 + i, "other text here", "b") for i in range(400)]
    taken, target = taken_by_source(mixing.mix(make(rows)).collect())
    assert all(abs(taken[s] - target[s]) <= 6 for s in target)


def test_no_answer_is_an_error(spark, monkeypatch):
    monkeypatch.setattr(mixing, "STEPS", 1)
    cells = spark.createDataFrame([(0, s, 5) for s in (1, 10, 40, 100)], "sid int, size long, n long")
    goals = spark.createDataFrame([(0, 500.0)], "sid int, target double")
    with pytest.raises(RuntimeError, match="converged"):
        mixing.solve(cells, goals)
