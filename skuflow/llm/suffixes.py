"""Repeat dedup by hash groups: bytes covered by strings that an earlier document holds (operator 4).

Two suffixes are equal over LENGTH bytes exactly if the same sample position lies in both
at the same distance, the bytes before it agree and the sample's rank agrees. No suffix is ordered:
a difference-cover suffix sort is replaced by a content-defined sample and equality of hashes.

1. Cover sample. Of each LENGTH-byte string the K-gram with the least hash (the leftmost one)
   is its sample position. Like a difference cover it gives any two equal strings a common
   position at the same distance, at about one position in 16 instead of one in four. Each
   batch of documents tells its distinct sample K-grams, and one grouping by K-gram keeps those that two
   documents hold; every other string is unique.
2. Sample ranks. The suffixes that share a sample position are one block: the text from
   the first to the end of the last of them. Equal blocks share a rank, and the smallest doc_id
   that holds a rank settles all other holders of it: their whole block repeats.
3. Ties. Only where one K-gram has several ranks (around edits) are the block's strings compared one
   by one, LENGTH bytes each by digest, to find those that a smaller doc_id holds. A string has SIDE bytes
   before its sample or SIDE bytes after it, so blocks are dealt by these bytes and only those
   of one bucket with several documents are cut into strings, after the shuffle.

Blocks are compared by the hash of their K-gram and a 64-bit polynomial hash, strings by 128-bit digests. Only blocks
of step 3 travel as bytes: their first holder's batch is read once more. Batches are ranges of doc_id, cut up by a hash of
id and text where they hold more than ``common.GROUP_BYTES``, so a group is bounded in bytes, and copies inside a batch are collapsed before anything is shuffled.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skuflow.llm.common import Staged, bounded_batches, bounded_groups, release, repeated, stage

LENGTH, K = 50, 20
#: Bytes beside a sample position that every string sampled there holds on one side.
SIDE = (LENGTH - K) // 2
BATCH = 2048
#: Bytes of documents whose sample K-grams are collapsed together.
FLUSH = 1 << 22
#: Bytes hashed at once; a longer text is worked through in overlapping pieces.
PIECE = 1 << 20
#: Bytes of short texts that are hashed as one array.
JOIN = 1 << 18
#: Low bits of a packed hash that hold the place in a piece.
PLACE = np.uint64((1 << 21) - 1)

_rng = np.random.default_rng(20)
_BYTE = _rng.integers(0, 1 << 64, 256, dtype=np.uint64)
_BASE = int(_rng.integers(0, 1 << 63, dtype=np.uint64)) * 8 + 5 & (1 << 64) - 1
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, for texts of n bytes."""
    size = 1 << max(12, n.bit_length())
    if size not in _POWERS:
        with np.errstate(over="ignore"):
            both = []
            for base in (_BASE, pow(_BASE, -1, 1 << 64)):
                f = np.full(size, np.uint64(base))
                f[0] = 1
                both.append(np.cumprod(f, dtype=np.uint64))
        _POWERS[size] = tuple(both)
    return _POWERS[size]


def _mixed(h: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        h = h ^ h >> np.uint64(33)
        h *= np.uint64(0xFF51AFD7ED558CCD)
    return h ^ h >> np.uint64(33)


def _joined(pieces: list[tuple[int, int, bytes]]) -> tuple[np.ndarray, ...]:
    """``sampled`` for pieces (text, place in the text, bytes) of LENGTH bytes or more, hashed as one array."""
    text, at, raw = zip(*pieces)
    n = np.array([len(r) for r in raw])
    start = np.cumsum(n) - n
    stop = start + n - LENGTH + 1
    b = np.frombuffer(b"".join(raw), np.uint8)
    up, down = _powers(len(b))
    with np.errstate(over="ignore"):
        sums = np.zeros(len(b) + 1, np.uint64)
        np.cumsum(_BYTE[b] * up[:len(b)], out=sums[1:])
        h = _mixed((sums[K:] - sums[:-K]) * down[:len(b) - K + 1])
    value, width = (h & ~PLACE) | np.arange(len(h), dtype=np.uint64), 1
    goal = LENGTH - K + 1
    while width < goal:  # sliding minimum by doubling, the left one at a tie
        step = min(width, goal - width)
        value = np.minimum(value[:-step], value[step:])
        width += step
    new = np.concatenate([[True], value[1:] != value[:-1]])
    new[start] = True
    new[stop[:-1]] = True  # strings from here on would cross into the next piece
    first = np.flatnonzero(new)
    last = np.concatenate([first[1:] - 1, [len(value) - 1]])
    of = np.searchsorted(start, first, "right") - 1
    inside = first < stop[of]
    first, last, of = first[inside], last[inside], of[inside]
    where = (value[first] & PLACE).astype(np.int64)
    distance = where - first
    with np.errstate(over="ignore"):
        block = (sums[last + LENGTH] - sums[first]) * down[first]
        digest = _mixed(block ^ distance.astype(np.uint64) * np.uint64(_BASE))
    shift = (np.array(at) - start)[of]
    return np.array(text)[of], h[where].view(np.int64), digest.view(np.int64), first + shift, last + shift, distance


def sampled(raw: list[bytes]) -> tuple[np.ndarray, ...]:
    """(text, hash, digest, first, last, distance) of each sample position of each text.

    first and last are the starts of the strings it samples; digest is a 64-bit polynomial hash of
    their block, mixed with the distance from its start to the sample.
    """
    parts, held, size = [], [], 0
    for i, r in enumerate(raw):
        for at in range(0, len(r) - LENGTH + 1, PIECE):
            held.append((i, at, r[at:at + PIECE + LENGTH - 1]))
            size += len(held[-1][2])
            if size >= JOIN:
                parts.append(_joined(held))
                held, size = [], 0
    if held:
        parts.append(_joined(held))
    if not parts:
        return tuple(np.zeros(0, np.int64) for _ in range(6))
    return tuple(np.concatenate(x) for x in zip(*parts))


def samples(raw: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash, position, first, last) of each sample position of one text."""
    _, h, _, first, last, distance = sampled([raw])
    return h, first + distance, first, last


def _told(docs: DataFrame) -> DataFrame:
    """(hash, batch, several): sample K-grams of each batch, and whether several of its documents hold it."""
    schema = pa.schema([("hash", pa.int64()), ("batch", pa.int64()), ("several", pa.bool_())])

    def tell(batch: int, raw: list[bytes]) -> pa.RecordBatch:
        text, h, *_ = sampled(raw)
        order = np.lexsort((text, h))
        text, h = text[order], h[order]
        at = np.flatnonzero(_changes(h))
        end = np.append(at[1:], len(h))[:len(at)] - 1
        return pa.RecordBatch.from_arrays([
            pa.array(h[at]), pa.array(np.full(len(at), batch)), pa.array(text[at] != text[end])], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[bytes]] = {}
        size = 0
        for b in batches:
            for batch, text in zip(*(c.to_pylist() for c in b.columns)):
                raw = _bytes(text)
                if len(raw) >= LENGTH:
                    held.setdefault(batch, []).append(raw)
                    size += len(raw)
                if size > FLUSH:
                    yield from (tell(k, raw) for k, raw in held.items())
                    held, size = {}, 0
        yield from (tell(k, raw) for k, raw in held.items())

    told = docs.where("doc_id is not null").select("batch", "text").mapInArrow(run, "hash long, batch long, several boolean")
    # one number beside the hash keeps the largest shuffle narrow
    return told.select("hash", (F.col("batch") * 2 + F.col("several").cast("int")).alias("mark"))


def _ties(blocks: DataFrame) -> DataFrame:
    """(hash, digest, ties): the starts in a rank's block of strings that a smaller doc_id holds in another rank."""
    end = F.length("block") - LENGTH
    middle = F.col("distance") - SIDE
    before = F.struct(F.lit(0).alias("side"), F.lit(0).alias("lo"), F.least(middle, end).alias("hi"),
                      F.substring("block", middle + 1, F.lit(SIDE)).alias("beside"))
    after = F.struct(F.lit(1).alias("side"), F.greatest(middle + 1, F.lit(0)).alias("lo"), end.alias("hi"),
                     F.substring("block", F.col("distance") + K + 1, F.lit(SIDE)).alias("beside"))
    bucket = ["hash", "side", "beside"]
    dealt = (blocks.select("hash", "digest", "first", "block", F.explode(F.array(before, after)).alias("part"))
             .select("hash", "digest", "first", "block", "part.*").where("lo <= hi"))
    same = Window.partitionBy(*bucket)
    several = dealt.withColumn("low", F.min("first").over(same)).withColumn("high", F.max("first").over(same)).where("low < high")
    string = F.unhex(F.md5(F.substring("block", F.col("t") + 1, F.lit(LENGTH)))).alias("string")
    strings = (several.select(*bucket, "digest", "first", "block", F.explode(F.sequence("lo", "hi")).alias("t"))
               .select(*bucket, "digest", "first", "t", string))
    earlier = strings.withColumn("low", F.min("first").over(Window.partitionBy(*bucket, "string"))).where("low < first")
    return earlier.groupBy("hash", "digest").agg(F.array_sort(F.collect_set("t")).alias("ties"))


def _bytes(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "replace")


def _changes(*sorted_columns: np.ndarray) -> np.ndarray:
    """Whether a row differs from the row before; the first one does."""
    out = np.zeros(len(sorted_columns[0]), bool)
    out[:1] = True
    for c in sorted_columns:
        out[1:] |= c[1:] != c[:-1]
    return out


def _slabs(texts: pd.Series) -> Iterator[tuple[int, list[bytes]]]:
    """Neighbouring texts of about JOIN bytes, with the place of the first."""
    held, size, at = [], 0, 0
    for i, text in enumerate(texts):
        raw = _bytes(text)
        if held and size + len(raw) > JOIN:
            yield at, held
            held, size, at = [], 0, i
        held.append(raw)
        size += len(raw)
    if held:
        yield at, held


class _Ranks:
    """Ranks (hash, digest) in the order of their digests, looked up by arrays."""

    def __init__(self, ranks: pd.DataFrame):
        self.rows = ranks.sort_values("digest", ignore_index=True)
        self.hash, self.digest = (self.rows[c].to_numpy(np.int64) for c in ("hash", "digest"))

    def find(self, h: np.ndarray, digest: np.ndarray) -> np.ndarray:
        """The row of each (hash, digest), -1 where there is none."""
        out = np.full(len(h), -1)
        at = np.searchsorted(self.digest, digest)
        left = np.arange(len(h))
        while len(left):  # once, unless two K-grams share a digest
            left = left[at[left] < len(self.digest)]
            left = left[self.digest[at[left]] == digest[left]]
            hit = self.hash[at[left]] == h[left]
            out[left[hit]] = at[left[hit]]
            left = left[~hit]
            at[left] += 1
        return out


def _ranks(texts: pd.DataFrame, shared: pd.DataFrame) -> pd.DataFrame:
    """Distinct blocks of a batch at shared sample positions, by digest, with the smallest doc_id."""
    hashes = np.unique(shared["hash"].to_numpy(np.int64))
    parts = []
    texts = texts[texts["doc_id"].notna()]
    ids = texts["doc_id"].to_numpy(np.int64)
    for start, raw in _slabs(texts["text"]) if len(hashes) else ():
        text, h, digest, *_ = sampled(raw)
        hit = hashes[np.minimum(np.searchsorted(hashes, h), len(hashes) - 1)] == h
        parts.append((h[hit], digest[hit], ids[start + text[hit]]))
    h, digest, low = (np.concatenate(x) for x in zip(*parts)) if parts else (np.zeros(0, np.int64) for _ in range(3))
    order = np.lexsort((low, digest, h))
    order = order[_changes(h[order], digest[order])]
    batch = shared["batch"].iloc[0] if len(shared) else 0
    return pd.DataFrame({"batch": np.full(len(order), batch, np.int64), "hash": h[order], "digest": digest[order], "low": low[order]})


def _blocks(texts: pd.DataFrame, firsts: pd.DataFrame) -> pd.DataFrame:
    """The bytes of ranks whose first holder is in the batch."""
    wanted = _Ranks(firsts)
    holder = wanted.rows["first"].to_numpy(np.int64)
    block: list[bytes | None] = [None] * len(holder)
    distances = np.zeros(len(holder), np.int32)
    texts = texts[texts["doc_id"].isin(set(holder.tolist()))]
    ids = texts["doc_id"].to_numpy(np.int64)
    for start, raw in _slabs(texts["text"]):
        text, h, digest, first, last, distance = sampled(raw)
        rank = wanted.find(h, digest)
        own = np.flatnonzero(rank >= 0)
        own = own[holder[rank[own]] == ids[start + text[own]]]
        distances[rank[own]] = distance[own]
        for r, t, lo, hi in zip(*(x[own].tolist() for x in (rank, text, first, last))):
            if block[r] is None:
                block[r] = raw[t][lo:hi + LENGTH]
    out = wanted.rows[["hash", "digest", "first"]].assign(distance=distances, block=block)
    return out[out["block"].notna()]


def _covers(ids: np.ndarray, raw: list[bytes], ranks: _Ranks, low: np.ndarray, tied: np.ndarray, ties: list) -> tuple[np.ndarray, ...]:
    """(text, start, stop) of the repeated stretches of texts with these ids."""
    text, h, digest, first, last, _ = sampled(raw)
    rank = ranks.find(h, digest)
    at = np.flatnonzero(rank >= 0)
    whole = low[rank[at]] < ids[text[at]]
    at, rest = at[whole], at[~whole & tied[rank[at]]]
    own = [ties[r] for r in rank[rest].tolist()]
    n = [len(x) for x in own]
    start = np.repeat(first[rest], n) + np.concatenate([*own, np.zeros(0, np.int64)]).astype(np.int64)
    return (np.concatenate([text[at], np.repeat(text[rest], n)]), np.concatenate([first[at], start]),
            np.concatenate([last[at], start]) + LENGTH)


def _removed(texts: pd.DataFrame, ranks: pd.DataFrame, kept: bool) -> pd.DataFrame:
    """The digest columns of each document of a batch, and the bytes left if ``kept``."""
    known = _Ranks(ranks)
    low = known.rows["low"].to_numpy(np.int64)
    ties = known.rows["ties"].tolist()
    tied = known.rows["ties"].notna().to_numpy()
    out = []
    for part in (texts[texts["doc_id"].notna()], texts[texts["doc_id"].isna()]):
        named = part["doc_id"].notna().all()
        ids, copies = part["doc_id"].fillna(0).to_numpy(np.int64), part["copies"].tolist()
        for start, raw in _slabs(part["text"]):
            size = np.array([len(r) for r in raw])
            begin = np.cumsum(size) - size
            gone = None
            if named and len(low):
                text, first, stop = _covers(ids[start:], raw, known, low, tied, ties)
                if len(text):
                    edge = np.zeros(size.sum() + 1, np.int32)
                    np.add.at(edge, begin[text] + first, 1)
                    np.add.at(edge, begin[text] + stop, -1)
                    gone = np.cumsum(edge[:-1]) > 0
                    cut = np.bincount(text, minlength=len(raw)) > 0
            for i, r in enumerate(raw):
                left, spans = r, 0
                if gone is not None and cut[i]:
                    own = gone[begin[i]:begin[i] + size[i]]
                    spans = int(_starts(own))
                    left = np.frombuffer(r, np.uint8)[~own].tobytes()
                out.append((int(ids[start + i]) if named else None, len(r), len(r) - len(left), spans, hashlib.sha256(left).hexdigest(),
                            copies[start + i], *([left] if kept else [])))
    frame = pd.DataFrame(out, columns=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "copies", *(["kept"] if kept else [])])
    return frame.astype({"doc_id": "Int64"})


def _starts(gone: np.ndarray) -> int:
    return gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum()


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", kept: bool = True) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256 and, if asked for, kept (the bytes left).

    Null texts count as empty; texts under LENGTH bytes lose nothing. A document without an id
    neither loses bytes nor makes others lose any; rows that repeat an id are judged against
    smaller ids only. An empty table gives an empty result; other columns are ignored.
    """
    batch = F.coalesce(F.floor(F.col(id_col).cast("long") / BATCH), F.lit(-1)).alias("batch")
    rows = docs.select(batch, F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    spark = docs.sparkSession
    same_gram = Window.partitionBy("hash")
    bounded_batches(docs.sparkSession)
    rows = bounded_groups(rows)
    # a document tells a K-gram once, so two rows or a mark of several are two documents (or rows of one id)
    shared = Staged(_told(rows).withColumn("n", F.count("*").over(same_gram)).where("n > 1 or mark % 2 <> 0")
                    .select(F.shiftright("mark", 1).alias("batch"), "hash").distinct(), "suffix-shared")
    release(spark)
    held = Staged(rows.groupBy("batch").cogroup(shared.df.groupBy("batch")).applyInPandas(
        _ranks, "batch long, hash long, digest long, low long"), "suffix-held")
    shared.drop()
    release(spark)
    several = F.min("digest").over(same_gram) != F.max("digest").over(same_gram)
    first = F.min("low").over(Window.partitionBy("hash", "digest"))
    ranked = stage(held.df.withColumn("several", several).withColumn("first", first), "suffix-ranks")
    held.drop()
    release(spark)
    tied = ranked.where(F.col("several") & (F.col("low") == F.col("first"))).select("batch", "hash", "digest", "first")
    blocks = Staged(rows.groupBy("batch").cogroup(tied.groupBy("batch")).applyInPandas(
        _blocks, "hash long, digest long, first long, distance int, block binary"), "suffix-blocks")
    release(spark)
    ties = stage(_ties(blocks.df), "suffix-ties")
    blocks.drop()
    release(spark)
    known = (ranked.join(ties, ["hash", "digest"], "left")
             .select("batch", "hash", "digest", F.col("first").alias("low"), "ties"))
    columns = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, copies long"
    return repeated(rows.groupBy("batch").cogroup(known.groupBy("batch")).applyInPandas(
        lambda texts, ranks: _removed(texts, ranks, kept), columns + (", kept binary" if kept else "")))
