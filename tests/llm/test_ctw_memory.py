"""What tasks of the language model hold, and how often they tell a gram."""

import random
import tracemalloc
from collections import Counter

import pyarrow as pa

from skuflow.llm import ctw


def test_grams_take_few_bytes():
    rng = random.Random(3)
    raw = [bytes(rng.choices(b"abc \xc3", k=rng.randrange(0, 4000))) for _ in range(300)]
    slow, at = [], [0]
    for r in raw:
        p = bytes(ctw.DEPTH) + r + b"\0"
        slow += [int.from_bytes(p[i:i + ctw.DEPTH + 1]) for i in range(len(r) + 1)]
        at.append(len(slow))
    tracemalloc.start()
    got, start = ctw.grams(raw)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert got.tolist() == slow and start.tolist() == at
    assert most < 24 * len(slow)  # eight for a gram, twice, and the texts


def test_a_task_tells_a_gram_once(monkeypatch):
    monkeypatch.setattr(ctw, "FLUSH", 50)
    texts = ["The cat sat", None, "the cat", "", "é sat on the cat"] * 20
    batch, train = [7] * 60 + [8] * 40, [i % 3 for i in range(100)]
    given = pa.RecordBatch.from_arrays([pa.array(batch), pa.array(texts), pa.array(train)], names=["batch", "text", "train"])

    def run():
        return [r for b in ctw._ask(iter([given.slice(0, 37), given.slice(37)])) for r in b.to_pylist()]

    want = Counter()
    for b, t, n in zip(batch, texts, train):
        raw = (t or "").encode().lower()
        for key in [*((g, None) for g in ctw.grams([raw])[0].tolist()), *((None, w) for w in raw.split())]:
            want[b, *key] += n
    rows = run()
    assert len(rows) == len(want) and {(r["batch"], r["gram"], r["word"]): r["n"] for r in rows} == want
    monkeypatch.setattr(ctw, "HELD_WORDS", 3)  # told in parts, the sums stay
    parts = Counter()
    for r in run():
        parts[r["batch"], r["gram"], r["word"]] += r["n"]
    assert parts == want and set(parts) == set(want)
