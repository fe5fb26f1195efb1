"""LM scoring by context-tree weighting over bytes (operator 3).

Every byte is decomposed into eight binary choices. For each choice and each context of the
0 to ``DEPTH`` preceding bytes, Krichevsky-Trofimov estimates from the training counts are mixed
over all depths: Pw = (Pe + prod Pw(children)) / 2 bottom-up, and the predictive probability
top-down with the weights Pe / (Pe + prod Pw(children)). Grams are grouped by their last SPLIT context
bytes: a group holds whole subtrees below that depth (of 2**24 grams at most, however large the corpus), so one
task works them through by array operations, once upwards and once downwards. The few levels above are tables keyed
by (context, node), each built by Spark from the one below by one aggregation.

Texts are lower-cased (A-Z), start after DEPTH zero bytes and end with one zero byte, so a text's
score is a sum over its grams of DEPTH + 1 bytes. Documents are scored in batches: a batch
asks for its distinct grams and words, an equality join answers, and a cogroup with the texts adds
up. Batches are ranges of ids, cut up by a hash of id and text where they hold too many bytes.
Beside the list of those, no table is broadcast and no (document, word) pair is shuffled.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skuflow.llm.common import Staged, bounded_batches, bounded_groups, release, repeated, stage

DEPTH = 4
#: Context bytes by which grams are grouped.
SPLIT = 2
FOLDS = 10
#: Neighbouring ids that are scored together, unless their texts are too long.
BATCH = 4096
#: Bytes whose grams are sorted at once.
FLUSH = 1 << 21
#: Grams and words that a task holds, summed by batch, before it writes them.
HELD_GRAMS, HELD_WORDS = 1 << 20, 1 << 18
#: Bytes of texts that are scored at once.
PIECE = 1 << 20


def _bytes(texts: pa.Array | pa.ChunkedArray) -> list[bytes]:
    return [(t or b"").lower() for t in texts.cast(pa.binary()).to_pylist()]


def grams(raw: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Grams of several texts as integers, newest byte lowest, and where each text's begin."""
    pad = bytes(DEPTH)
    flat = np.frombuffer(pad + pad.join(r + b"\0" for r in raw), np.uint8)
    start = np.concatenate([[0], np.cumsum([len(r) + 1 for r in raw], dtype=np.int64)])
    out = flat[:len(flat) - DEPTH].astype(np.int64)
    for i in range(1, DEPTH + 1):  # in place: a gram takes eight bytes
        out <<= 8
        out |= flat[i:len(flat) - DEPTH + i]
    if len(raw) < 2:
        return out, start
    own = np.ones(len(out), bool)  # not those that begin in one text and end in the next
    own[(start[1:-1] + DEPTH * np.arange(len(raw) - 1))[:, None] + np.arange(DEPTH)] = False
    return out[own], start


ASKED = pa.schema([("batch", pa.int64()), ("gram", pa.int64()), ("word", pa.binary()), ("n", pa.int64())])


class _Asked:
    """Distinct grams and words of the texts of a batch so far, and how often training texts have them."""

    def __init__(self):
        self.parts: list[tuple[np.ndarray, np.ndarray]] = []
        self.words: Counter[bytes] = Counter()

    def add(self, raw: list[bytes], train: int) -> None:
        """``train``: how often the texts count."""
        keys, n = np.unique(grams(raw)[0], return_counts=True)
        self.parts.append((keys, n * train))
        if len(self.parts) > 1:
            keys, n = (np.concatenate(x) for x in zip(*self.parts))
            order = np.argsort(keys, kind="stable")
            keys, n = keys[order], n[order]
            first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
            self.parts = [(keys[first], np.add.reduceat(n, first))]
        if train == 1:
            for r in raw:
                self.words.update(r.split())
        else:
            self.words.update({w: n * train for w, n in Counter(w for r in raw for w in r.split()).items()})

    def rows(self, batch: int) -> Iterator[pa.RecordBatch]:
        for keys, n in self.parts:
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(keys), batch)), pa.array(keys), pa.nulls(len(keys), pa.binary()),
                                              pa.array(n)], schema=ASKED)
        size = len(self.words)
        yield pa.RecordBatch.from_arrays([pa.array(np.full(size, batch)), pa.nulls(size, pa.int64()), pa.array(list(self.words), pa.binary()),
                                          pa.array(np.fromiter(self.words.values(), np.int64, size))], schema=ASKED)


def _ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A batch's grams and words, told once by a task that holds no more than HELD_GRAMS and HELD_WORDS of them."""
    texts: dict[tuple[int, int], list[bytes]] = {}
    held: dict[int, _Asked] = {}
    size = 0

    def fold() -> None:
        for (batch, train), raw in texts.items():
            held.setdefault(batch, _Asked()).add(raw, train)
        texts.clear()

    for b in batches:
        for batch, raw, train in zip(b.column(0).to_pylist(), _bytes(b.column(1)), b.column(2).to_pylist()):
            texts.setdefault((batch, train), []).append(raw)
            size += len(raw)
            if size > FLUSH:
                fold()
                size = 0
                if (sum(len(k) for a in held.values() for k, _ in a.parts) > HELD_GRAMS
                        or sum(len(a.words) for a in held.values()) > HELD_WORDS):
                    while held:
                        k, a = held.popitem()
                        yield from a.rows(k)
    fold()
    while held:
        k, a = held.popitem()
        yield from a.rows(k)


def asked(docs: DataFrame) -> DataFrame:
    """(batch, gram, word, n): distinct grams and words of each batch with their training counts."""
    train = F.when(F.col("held_out"), 0).otherwise(F.col("copies"))
    return docs.select("batch", "text", train.alias("train")).mapInArrow(_ask, "batch long, gram long, word binary, n long")


def _log_gamma(x: Column) -> Column:
    """Stirling's series after eight steps up; error below 1e-10 for x >= 0.5."""
    y = x + 8
    series = (y - 0.5) * F.log(y) - y + 0.5 * math.log(2 * math.pi) + 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5)
    product = F.lit(1.0)
    for i in range(8):
        product = product * (x + i)
    return series - F.log(product)


def _estimate() -> Column:
    """Log Krichevsky-Trofimov probability of a zeros and b ones in any order."""
    a, b = F.col("a"), F.col("b")
    return _log_gamma(a + 0.5) + _log_gamma(b + 0.5) - _log_gamma(a + b + 1.0) - math.log(math.pi)


def _estimates(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``_estimate`` of arrays."""
    def log_gamma(x):
        y = x + 8
        series = (y - 0.5) * np.log(y) - y + 0.5 * math.log(2 * math.pi) + 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5)
        return series - np.log(np.prod([x + i for i in range(8)], axis=0))

    return log_gamma(a + 0.5) + log_gamma(b + 0.5) - log_gamma(a + b + 1.0) - math.log(math.pi)


class _Level:
    """One depth of the subtrees of a group: distinct (context, node), their counts and weights."""

    def __init__(self, key: np.ndarray, a: np.ndarray, b: np.ndarray, below: np.ndarray | None = None):
        self.key, self.up = np.unique(key, return_inverse=True)
        self.a, self.b = (np.bincount(self.up, x) for x in (a, b))
        self.pw, self.keep = _estimates(self.a, self.b), np.ones(len(self.key))
        if below is not None:
            rest = np.bincount(self.up, below)
            self.keep = 1 / (1 + np.exp(np.minimum(rest - self.pw, 700)))
            self.pw = np.logaddexp(self.pw, rest) - math.log(2)
        self.kt = (self.b + 0.5) / (self.a + self.b + 1)


def _levels(gram: np.ndarray, n: np.ndarray, choice: int) -> list[_Level]:
    """Depths DEPTH to SPLIT for one of the eight choices; ``up`` leads from the grams, or the depth below, into a level."""
    byte = gram & 255
    node, bit = byte + 256 >> 8 - choice, byte >> 7 - choice & 1  # a node is a 1 followed by the bits before
    levels = [_Level(gram >> 8 << 8 | node, n * (1 - bit), n * bit)]
    for depth in range(DEPTH - 1, SPLIT - 1, -1):
        last = levels[-1]
        levels.append(_Level(last.key & (1 << 8 * depth + 8) - 1, last.a, last.b, last.pw))
    return levels


def _subtrees(counts: pd.DataFrame) -> pd.DataFrame:
    """(context, node, a, b, pw, keep) at depth SPLIT of the grams of a group."""
    gram, n = counts["gram"].to_numpy(), counts["n"].to_numpy()
    tops = [_levels(gram, n, k)[-1] for k in range(8)]
    key = np.concatenate([t.key for t in tops])
    return pd.DataFrame({"context": key >> 8, "node": (key & 255).astype(np.int32),
                         **{c: np.concatenate([getattr(t, c) for t in tops]) for c in ("a", "b", "pw", "keep")}})


def _told(counts: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
    """(gram, log10_p) of a group, from what depth SPLIT makes of the depths above."""
    gram, n = counts["gram"].to_numpy(), counts["n"].to_numpy()
    at = known["context"].to_numpy() << 8 | known["node"].to_numpy()
    order = np.argsort(at)
    at, p_known, rest_known = at[order], known["p1"].to_numpy()[order], known["rest"].to_numpy()[order]
    total = np.zeros(len(gram))
    for choice in range(8):
        levels = _levels(gram, n, choice)
        top = np.searchsorted(at, levels[-1].key)
        p, rest = p_known[top], rest_known[top]
        for upper, level in zip(levels[:0:-1], levels[-2::-1]):
            p = p[upper.up] + rest[upper.up] * level.keep * level.kt
            rest = rest[upper.up] * (1 - level.keep)
        p = p[levels[0].up]
        total += np.log10(np.where(gram >> 7 - choice & 1, p, 1 - p))
    return pd.DataFrame({"gram": gram, "log10_p": total})


def gram_scores(counts: DataFrame) -> DataFrame:
    """(gram, log10 p): probability of a gram's newest byte after the bytes before, for every gram given."""
    grouped = counts.withColumn("part", F.call_function("shiftright", F.col("gram"), F.lit(8)).bitwiseAND(F.lit((1 << 8 * SPLIT) - 1)))
    levels = [stage(grouped.groupBy("part").applyInPandas(
        _subtrees, "context long, node int, a double, b double, pw double, keep double"), "ctw-level")]
    for depth in range(SPLIT - 1, -1, -1):
        cut = F.col("context").bitwiseAND(F.lit((1 << 8 * depth) - 1)).alias("context")
        up = levels[-1].groupBy(cut, "node").agg(F.sum("a").alias("a"), F.sum("b").alias("b"), F.sum("pw").alias("below"))
        up = up.withColumn("own", _estimate())
        high, low = F.greatest("own", "below"), F.least("own", "below")
        up = up.withColumn("pw", high + F.log1p(F.exp(low - high)) - math.log(2))
        levels.append(stage(up.withColumn("keep", 1 / (1 + F.exp(F.least(F.col("below") - F.col("own"), F.lit(700.0)))))
                            .drop("below", "own"), "ctw-level"))
    kt = (F.col("b") + 0.5) / (F.col("a") + F.col("b") + 1)
    known = levels[-1].select("context", "node", (F.col("keep") * kt).alias("p1"), (1 - F.col("keep")).alias("rest"))
    for depth in range(1, SPLIT + 1):
        parent = known.select(F.col("context").alias("up"), "node", F.col("p1").alias("p_up"), F.col("rest").alias("rest_up"))
        own = levels[SPLIT - depth].withColumn("up", F.col("context").bitwiseAND(F.lit((1 << 8 * (depth - 1)) - 1)))
        known = stage(own.join(parent, ["up", "node"]).select(
            "context", "node", (F.col("p_up") + F.col("rest_up") * F.col("keep") * kt).alias("p1"),
            (F.col("rest_up") * (1 - F.col("keep"))).alias("rest")), "ctw-mix")
    return grouped.groupBy("part").cogroup(known.groupBy("context")).applyInPandas(
        _told, "gram long, log10_p double")


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", folds: int = FOLDS) -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte.

    ``score`` is the model's log10 probability of the lower-cased bytes and the end. Null and
    empty texts are an end alone. Repeated rows stay; a null doc_id counts as the empty text and
    so is held out. Without training documents every estimate is that of an empty count.
    """
    held = F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))) % folds == 0
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"),
                       held.alias("held_out"), F.coalesce(F.floor(F.col(id_col).cast("long") / BATCH), F.lit(-1)).alias("batch"))
    bounded_batches(docs.sparkSession)
    rows = bounded_groups(rows)
    spark = docs.sparkSession
    wanted = Staged(asked(rows), "ctw-asked")
    asks = stage(wanted.df.where("gram is not null").groupBy("batch", "gram").agg(F.sum("n").alias("n")), "ctw-grams-asked")
    words = Staged(wanted.df.where("word is not null").groupBy("batch", "word").agg(F.sum("n").alias("n")), "ctw-words")
    wanted.drop()
    vocabulary = stage(words.df.groupBy("word").agg(F.sum("n").alias("c")), "ctw-vocabulary")
    words_told = stage(words.df.join(vocabulary, "word").select("batch", "word", F.col("c").cast("double").alias("value")), "ctw-words-told")
    words.drop()
    release(spark)
    counts = Staged(asks.groupBy("gram").agg(F.sum("n").alias("n")), "ctw-counts")
    by_gram = stage(gram_scores(counts.df), "ctw-grams")
    counts.drop()
    release(spark)
    grams_told = asks.join(by_gram, "gram").select("batch", "gram", F.lit(None).cast("binary").alias("word"), F.col("log10_p").alias("value"))
    ends = rows.agg(F.coalesce(F.sum(F.when(~F.col("held_out"), F.col("copies"))), F.lit(0)).alias("ends")).first()["ends"]
    size = vocabulary.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count_if(F.col("c") > 0).alias("v")).first()
    n, v = size["n"] + ends, size["v"] + (ends > 0)
    told = grams_told.union(words_told.select("batch", F.lit(None).cast("long").alias("gram"), "word", "value"))
    whole = math.log10(n + 0.1 * (v + 1))

    def add(texts: pa.Table, answers: pa.Table) -> pa.Table:
        is_gram = answers["gram"].is_valid()
        by_key, by_word = answers.filter(is_gram), answers.filter(pc.invert(is_gram))
        keys, values = pd.Index(by_key["gram"].to_numpy()), by_key["value"].to_numpy()
        known = by_word["value"].to_numpy()
        logs = dict(zip(by_word["word"].to_pylist(), np.where(known > 0, np.log10(known + 0.1), -1.0).tolist()))  # log10(0.1) is -1
        sizes = pc.add(pc.fill_null(pc.binary_length(texts["text"]), 0), 1).to_pylist()
        n_tokens, n_known, base, total = [], [], [], []
        at = 0
        while at < len(sizes):  # some texts at a time, so that arrays stay small
            to, held_bytes = at, 0
            while to < len(sizes) and (to == at or held_bytes + sizes[to] < PIECE):
                held_bytes += sizes[to]
                to += 1
            raw = _bytes(texts["text"].slice(at, to - at))
            g, start = grams(raw)
            sums = np.concatenate([[0.0], np.cumsum(values[keys.get_indexer(g)])])
            total.extend((sums[start[1:]] - sums[start[:-1]]).tolist())
            for r in raw:
                found = [logs[w] for w in r.split()]
                n_tokens.append(len(found) + 1)
                n_known.append(len(found) - found.count(-1.0) + (ends > 0))
                base.append(math.fsum(found) + math.log10(ends + 0.1) - (len(found) + 1) * whole)
            at = to
        return pa.table({
            "doc_id": texts["doc_id"], "held_out": texts["held_out"], "copies": texts["copies"], "n_tokens": pa.array(n_tokens, pa.int64()),
            "n_known": pa.array(n_known, pa.int64()), "train_tokens": pa.array(np.full(len(sizes), n, np.int64)), "base_score": pa.array(base, pa.float64()),
            "score": pa.array(total, pa.float64()), "bits_per_byte": -np.array(total) / math.log10(2) / np.array(sizes)})

    kinds = ("doc_id long, held_out boolean, copies long, n_tokens long, n_known long, train_tokens long, base_score double, "
             "score double, bits_per_byte double")
    return repeated(rows.groupBy("batch").cogroup(told.groupBy("batch")).applyInArrow(add, kinds))
