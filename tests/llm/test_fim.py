"""Fill-in-the-middle against plain slicing."""

import hashlib
import random

from pyspark.sql import functions as F

from skuflow.llm import fim


def slow(doc_id, text):
    text = text or ""
    x = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(x[8 * i:8 * i + 8], 16) for i in range(4)]
    n = len(text)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return n, "plain", None, None, text
    p, m, s = text[:a], text[a:b], text[b:]
    if h[3] % 100 < 20:
        return n, "spm", a, b - a, f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", a, b - a, f"<P>{p}<S>{s}<M>{m}"


def check(df, texts):
    rows = fim.fill_in_middle(df).withColumn("back", fim.restore(F.col("output"), F.col("form"))).collect()
    got = sorted(((r["doc_id"] is None, r["doc_id"] or 0), (r["n"], r["form"], str(r["prefix_chars"]), str(r["middle_chars"]), r["output"]),
                  r["back"]) for r in rows)
    want = []
    for i, t in texts:
        n, form, a, b, out = slow(i, t)
        want.append(((i is None, i or 0), (n, form, str(a), str(b), out), t or ""))
    assert got == sorted(want)


def test_matches_slicing(make):
    rng = random.Random(4)
    alphabet = "ab <>PSM\né中\U0001f600"
    texts = [(i, "".join(rng.choices(alphabet, k=rng.choice([0, 1, 2, 3, 40, 3000])))) for i in range(300)]
    shared = "".join(rng.choices("abcdefgh é中\U0001f600", k=20_000))
    texts += [(1000 + i, "x" * i + shared[i * 31:]) for i in range(40)] + [(2000, "z" * 100_000), (2001, "<" * 70_000 + "P>"), (2002, "é" * 50_000)]
    check(make(texts), texts)


def test_odd_rows(make, odd_rows):
    docs = make(odd_rows).withColumnRenamed("word", "output").withColumnRenamed("score", "h1")
    check(docs, [(r[0], r[1]) for r in odd_rows])
    assert fim.fill_in_middle(docs.limit(0)).collect() == []


def test_marks_across_chunks_and_shared_chunks():
    """A control string is seen wherever the chunks meet, and equal passages are summarised once."""
    rng = random.Random(9)
    body = "".join(rng.choices("abcdef gh", k=60_000)).encode()
    ends = fim.chunk_ends(body)
    assert len(ends) > 20 and ends[-1] == len(body) and max(b - a for a, b in zip([0, *ends], ends)) <= fim.MOST
    moved = fim.chunk_ends(b"some other start " + body)
    assert {e + 17 for e in ends[1:]} <= set(moved)
    for end in ends[:-1]:
        for cut in (1, 2):
            text = body[:end - cut] + b"<M>" + body[end - cut:]
            assert fim.Chunked(text, fim.Summaries()).marked
    cache = fim.Summaries()
    assert not fim.Chunked(body, cache).marked
    first = cache.misses
    fim.Chunked(b"some other start " + body, cache)
    assert cache.misses <= first + 2 and cache.hits >= len(ends) - 2
    tiny = fim.Summaries(most=5000)
    assert fim.Chunked(body, tiny).n == 60_000 and tiny.held <= 5000


def test_chunks_of_one_byte(monkeypatch):
    """Borders of chunks shorter than a control string."""
    monkeypatch.setattr(fim, "chunk_ends", lambda text: list(range(1, len(text) + 1)))
    assert fim.Chunked(b"ab<M>c", fim.Summaries()).marked
    assert not fim.Chunked(b"ab<M c", fim.Summaries()).marked
    text = "aé中\U0001f600z".encode()
    doc = fim.Chunked(text, fim.Summaries())
    assert doc.n == 5 and [doc.byte_of(i) for i in range(6)] == [0, 1, 3, 6, 10, 11]
