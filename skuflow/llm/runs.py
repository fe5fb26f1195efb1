"""Periodic runs of words by dyadic square catching (operator 13).

The words of a text are numbered from 0. A run is a stretch of smallest period q and of at
least ``max(least, times * q)`` words that no neighbouring word extends. Words that a run
repeats after its first q words can be collapsed.

The words of a batch of documents form one appended stream. At level k, every completed block
of 2**k words owns a catcher for the periods 2**(k+1) - 1 to 2**(k+2) - 2: any stretch of such
a period holds a whole block in each copy, and as words arrive the catcher compares its block
with the block that many words later. Blocks are named by fingerprints that double from level
to level, and all catchers of a level advance together, as rows of one comparison. A block
that comes again is the core of a square; squares of one period on neighbouring blocks merge
into a stretch, whose two ends are then compared word by word, and whose inside is checked
the same way, so a fingerprint never decides a result.

A text of n words costs about 2 n comparisons a level and has log2(n / 8) levels.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skuflow.llm.common import bounded_batches

#: A run has at least this many words, and this many times its period (at least four).
LEAST, TIMES = 6, 4
#: Words put into one stream; a longer text has a stream of its own.
STREAM_WORDS = 1 << 19
#: Comparisons held at once.
CELLS = 1 << 22
_ODD = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))


def find_runs(ids: np.ndarray, lengths: np.ndarray, least: int = LEAST, times: int = TIMES) -> list[tuple[int, int, int, int]]:
    """(document, start, length, period) of all runs; ``ids`` are the words of all documents, one after another."""
    if times < 4:
        raise ValueError("times is 4 or more: shorter runs need not hold three blocks in a row")
    docs = np.arange(len(lengths))
    found: dict[int, list[tuple[int, int, int]]] = defaultdict(list)
    prints = ids.astype(np.uint64) * _ODD[0]
    level = 0
    while True:
        size = 1 << level
        shortest = 2 * size - 1
        keep = lengths >= max(least, times * shortest)
        if not keep.all():  # documents too short for this level leave the stream
            inside = np.repeat(keep, lengths)
            ids, prints, docs, lengths = ids[inside], prints[inside], docs[keep], lengths[keep]
        if not len(docs):
            break
        ends = np.cumsum(lengths)
        for period, lo, hi in _stretches(prints, size, shortest, least, times):
            d = int(np.searchsorted(ends, lo, "right"))
            while d < len(ends) and ends[d] - lengths[d] < hi:
                begin, end = int(ends[d] - lengths[d]), int(ends[d])
                _merge(found[int(docs[d])], ids[begin:end], period, max(lo - begin, 0),
                       min(hi, end - period) - begin, size, least, times)
                d += 1
        # the next level's blocks are two of this level's; what runs over the end is never trusted
        wider = prints.copy()
        wider[:-size] = (prints[:-size] * _ODD[0] + prints[size:]) * _ODD[1]
        wider ^= wider >> np.uint64(29)
        prints, level = wider, level + 1
    return sorted((d, s, n, p) for d, runs in found.items() for s, n, p in runs)


def _stretches(prints: np.ndarray, size: int, shortest: int, least: int, times: int) -> list[tuple[int, int, int]]:
    """(period, from, to) of neighbouring blocks that come again ``period`` words later, by period."""
    blocks = prints[::size]
    hits: list[np.ndarray] = []
    if size <= 8:
        for period in range(shortest, shortest + 2 * size):
            later = prints[period::size]
            same = later == blocks[:len(later)]
            three = np.flatnonzero(same[:-2] & same[1:-1] & same[2:]) if len(same) > 2 else np.empty(0, np.int64)
            hits.append(np.stack([np.full(len(three), period), three], 1))
    elif len(prints) > shortest:
        padded = np.concatenate([prints, np.zeros(2 * size, np.uint64)])
        windows = sliding_window_view(padded, 2 * size)[shortest:len(prints):size]
        step = max(4, CELLS // (2 * size))
        for at in range(0, len(windows), step):
            part = windows[at:at + step + 2]
            same = part == blocks[at:at + len(part), None]
            three = np.argwhere(same[:-2] & same[1:-1] & same[2:])
            hits.append(np.stack([three[:, 1] + shortest, three[:, 0] + at], 1))
    if not hits:
        return []
    hit = np.concatenate(hits)
    hit = hit[np.lexsort((hit[:, 1], hit[:, 0]))]
    if not len(hit):
        return []
    new = np.flatnonzero((np.diff(hit[:, 0]) != 0) | (np.diff(hit[:, 1]) != 1)) + 1
    first, last = hit[np.r_[0, new]], hit[np.r_[new - 1, len(hit) - 1]]
    lo, hi = first[:, 1] * size, (last[:, 1] + 3) * size
    period = first[:, 0]
    enough = hi - lo + 2 * size - 2 >= np.maximum(least, times * period) - period
    return list(zip(period[enough].tolist(), lo[enough].tolist(), hi[enough].tolist()))


def _merge(runs: list[tuple[int, int, int]], words: np.ndarray, period: int, lo: int, hi: int, size: int,
           least: int, times: int) -> None:
    """Add the run of ``period`` around the stretch from ``lo`` to ``hi``, unless a shorter period explains it."""
    if hi <= lo or any(s <= lo and hi + period <= s + n and period % p == 0 for s, n, p in runs):
        return
    same = words[lo:hi] == words[lo + period:hi + period]
    if not same.all():  # equal fingerprints of unequal blocks: go by the words alone
        bad = np.flatnonzero(~same)
        for a, b in zip(np.r_[-1, bad], np.r_[bad, len(same)]):
            _merge(runs, words, period, lo + int(a) + 1, lo + int(b), size, least, times)
        return
    while lo:
        same = words[max(lo - size, 0):lo] == words[max(lo - size, 0) + period:lo + period]
        miss = np.flatnonzero(~same)
        lo -= len(same) - 1 - int(miss[-1]) if len(miss) else len(same)
        if len(miss):
            break
    while hi + period < len(words):
        later = words[hi + period:hi + period + size]
        miss = np.flatnonzero(words[hi:hi + len(later)] != later)
        hi += int(miss[0]) if len(miss) else len(later)
        if len(miss):
            break
    run = (lo, hi + period - lo, period)
    if run[1] >= max(least, times * period) and not any(s == lo and n == run[1] for s, n, _ in runs):
        runs.append(run)


def _streams(texts: list[bytes | None]) -> Iterator[list[list[bytes]]]:
    """The words of the texts, in groups of about STREAM_WORDS words."""
    group, held = [], 0
    for text in texts:
        words = (text or b"").split()
        if group and held + len(words) > STREAM_WORDS:
            yield group
            group, held = [], 0
        group.append(words)
        held += len(words)
    if group:
        yield group


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  least: int = LEAST, times: int = TIMES) -> DataFrame:
    """(doc_id, n_words, runs, collapsed): one row per row of ``docs``.

    ``runs`` are structs (start, length, period) by start, then period; ``collapsed`` is the
    text's words joined by one space, without those that any run holds after its first period.
    A null, empty or blank text has no words, no runs and an empty ``collapsed``. Ids are carried
    as they are, null or repeated, and no row depends on another. Other columns are not read.
    """
    bounded_batches(docs.sparkSession)
    kind = "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed binary"
    run_type = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("runs", run_type), ("collapsed", pa.binary())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for group in _streams(batch.column(1).to_pylist()):
                number: dict[bytes, int] = defaultdict(count().__next__)
                lengths = np.array([len(w) for w in group], np.int64)
                ids = np.fromiter((number[w] for words in group for w in words), np.int64, int(lengths.sum()))
                runs: list[list[dict]] = [[] for _ in group]
                kept = [None] * len(group)
                for d, start, length, period in find_runs(ids, lengths, least, times):
                    runs[d].append({"start": start, "length": length, "period": period})
                    if kept[d] is None:
                        kept[d] = np.ones(len(group[d]), bool)
                    kept[d][start + period:start + length] = False
                texts = [b" ".join(words if k is None else [words[i] for i in np.flatnonzero(k)]) for words, k in zip(group, kept)]
                yield pa.record_batch([batch.column(0).slice(at, len(group)), pa.array(lengths), pa.array(runs, run_type),
                                       pa.array(texts, pa.binary())], schema=schema)
                at += len(group)

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").cast("binary").alias("text"))
    return rows.mapInArrow(work, kind).withColumn("collapsed", F.col("collapsed").cast("string"))


def repeat_some(id_: Column, text: Column) -> Column:
    """The text, or for ids with crc32(id) % 10 = 0 its words with a periodic tail.

    With h = crc32 of the decimal id and g = floor(h / 10), word i from a = g % n on becomes word
    a + (i - a) % p with p = 1 + floor((n - a) / (3 + g % 8)). A null id leaves the text alone.
    """
    h = F.crc32(id_.cast("string"))
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")

    def planted(w: Column) -> Column:
        n, g = F.size(w).cast("long"), F.floor(h / 10).cast("long")
        a = F.pmod(g, n)
        p = F.lit(1) + F.floor((n - a) / (3 + F.pmod(g, F.lit(8))))
        return F.concat_ws(" ", F.transform(w, lambda word, i: F.when(i < a, word).otherwise(
            F.element_at(w, (a + F.pmod(i - a, p) + 1).cast("int")))))

    cut = F.transform(F.array(words), lambda w: F.when(F.size(w) > 0, planted(w)).otherwise(F.lit("")))
    return F.when(F.pmod(h, F.lit(10)) == 0, F.element_at(cut, 1)).otherwise(text)


def digest(found: DataFrame) -> DataFrame:
    """The strongest run of each row of ``periodic_runs`` and digests of its runs and its collapsed text.

    The strongest run has the greatest length / period, then the smallest start, then period;
    without a run its four columns are null.
    """
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    best = F.get(F.array_sort("runs", lambda x, y: F.coalesce(
        *(F.when(a < b, F.lit(-1)).when(a > b, F.lit(1)) for a, b in (
            (y["length"] * x["period"], x["length"] * y["period"]), (x["start"], y["start"]), (x["period"], y["period"]))),
        F.lit(0))), 0)
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.when(F.size("runs") > 0, F.concat(F.array_join(lines, "\n"), F.lit("\n"))).otherwise(F.lit("")), 256)
        .alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"))
