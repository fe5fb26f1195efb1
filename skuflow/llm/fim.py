"""Fill-in-the-middle by content-defined chunks (operator 12).

A rolling hash over the last 16 bytes cuts every text into chunks where its low bits are zero,
so passages that texts share yield the same chunks wherever they stand. A task keeps a cache
from a chunk's bytes to its boundary summary: how many characters start in it, whether it holds a
control string, and its first and last two bytes, with which neighbours are checked for a control
string across their border. The key is the content itself, so a hit is an equal chunk and
never just an equal hash. Summaries add up: their running sums give a text's characters and
the chunk that holds a cut, and only that chunk is looked through for the cut's byte.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import OrderedDict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skuflow.llm.common import bounded_batches

#: Control strings before prefix, suffix and middle.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: A chunk has CHUNK bytes on average and at most MOST.
CHUNK, MOST = 1 << 10, 1 << 14
#: Bytes of chunks that a task's cache holds; the least recently used go first.
CACHE_BYTES = 1 << 25
#: Bytes whose chunks are cut at once.
BLOCK = 1 << 22
_MARKS = tuple(m.encode() for m in (PREFIX, SUFFIX, MIDDLE))
# one 32-bit number per byte value, by a rule
_GEAR = np.array([(v + 1) * 0x9E3779B1 % (1 << 32) ^ (v + 7) ** 5 * 0x85EBCA6B % (1 << 32) for v in range(256)], np.uint32)


def chunk_ends(text: bytes) -> list[int]:
    """Where the chunks of ``text`` end, its own end included; the same bytes end a chunk in every text."""
    ends: list[int] = []
    for at in range(0, len(text), BLOCK):
        back = min(at, 15)
        rolled = _GEAR[np.frombuffer(text, np.uint8, min(BLOCK, len(text) - at) + back, at - back)]
        for step in (1, 2, 4, 8):  # the hash of 2 * step bytes from two of ``step`` bytes
            wider = rolled.copy()
            wider[step:] += rolled[:-step] << np.uint32(step)
            rolled = wider
        ends += (np.flatnonzero((rolled[back:] >> np.uint32(8)) % np.uint32(CHUNK) == 0) + at + 1).tolist()
    if not ends or ends[-1] != len(text):
        ends.append(len(text))
    if max(b - a for a, b in zip([0, *ends], ends)) <= MOST:
        return ends
    return [c for a, b in zip([0, *ends], ends) for c in (*range(a + MOST, b, MOST), b)]


def _starts(chunk: bytes) -> np.ndarray:
    """Which bytes of UTF-8 start a character."""
    return (np.frombuffer(chunk, np.uint8) & 0xC0) != 0x80


class Summaries:
    """Boundary summaries of chunks, kept by content: (characters, holds a control string, head, tail)."""

    def __init__(self, most: int = CACHE_BYTES):
        self.most, self.held, self.hits, self.misses = most, 0, 0, 0
        self.known: OrderedDict[bytes, tuple[int, bool, bytes, bytes]] = OrderedDict()

    def of(self, chunk: bytes) -> tuple[int, bool, bytes, bytes]:
        found = self.known.get(chunk)
        if found:
            self.hits += 1
            self.known.move_to_end(chunk)
            return found
        self.misses += 1
        found = (int(_starts(chunk).sum()), any(m in chunk for m in _MARKS), chunk[:2], chunk[-2:])
        self.known[chunk] = found
        self.held += len(chunk)
        while self.held > self.most:
            self.held -= len(self.known.popitem(last=False)[0])
        return found


class Chunked:
    """A text as chunks: its characters, whether it holds a control string, and the byte of any character."""

    def __init__(self, text: bytes, cache: Summaries):
        self.text, self.ends = text, chunk_ends(text) if text else []
        self.sums, self.marked, tail = [], False, b""
        total = 0
        for a, b in zip([0, *self.ends], self.ends):
            n, marked, head, last = cache.of(text[a:b])
            border = tail + head
            self.marked = self.marked or marked or any(m in border for m in _MARKS)
            tail = last if b - a > 1 else (tail + last)[-2:]
            total += n
            self.sums.append(total)
        self.n = total

    def byte_of(self, character: int) -> int:
        """The byte at which the character of this number starts; for n, the text's end."""
        if character >= self.n:
            return len(self.text)
        i = bisect_left(self.sums, character + 1)
        a = self.ends[i - 1] if i else 0
        before = self.sums[i - 1] if i else 0
        return a + int(np.flatnonzero(_starts(self.text[a:self.ends[i]]))[character - before])


def fill_in_middle(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = 1,
                   plain_percent: int = 10, spm_percent: int = 20) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output): one row per row of ``docs``.

    The four numbers h1 to h4 are 8-digit groups of sha256(``seed``:id). The cuts fall after the
    smaller and the greater of h1 % (n + 1) and h2 % (n + 1) characters. ``form`` is plain
    (``output`` is the text, no cuts) for an empty text, one that holds a control string, and
    ``plain_percent`` of the others; spm for ``spm_percent`` of the rest, else psm. A null text
    counts as empty, a null id as an empty id; rows that repeat an id and a text get equal
    results. Other columns are not read.
    """
    bounded_batches(docs.sparkSession)
    id_ = F.col(id_col).cast("long")
    hexed = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(id_.cast("string"), F.lit(""))), 256)
    rows = docs.select(id_.alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary").alias("text"),
                       hexed.alias("_hex"))
    drawn = rows.select("doc_id", "text", *(F.conv(F.substring("_hex", 8 * i + 1, 8), 16, 10).cast("long").alias(f"h{i + 1}")
                                            for i in range(4)))
    schema = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()),
                        ("middle_chars", pa.int64()), ("output", pa.binary())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = Summaries()
        p, s, m = _MARKS
        for batch in batches:
            out = []
            for text, h1, h2, h3, h4 in zip(*(batch.column(i).to_pylist() for i in range(1, 6))):
                doc = Chunked(text, cache)
                if not text or doc.marked or h3 % 100 >= 100 - plain_percent:
                    out.append((doc.n, "plain", None, None, text))
                    continue
                a, b = sorted((h1 % (doc.n + 1), h2 % (doc.n + 1)))
                i, j = doc.byte_of(a), doc.byte_of(b)
                if h4 % 100 < spm_percent:
                    out.append((doc.n, "spm", a, b - a, b"".join((s, text[j:], p, text[:i], m, text[i:j]))))
                else:
                    out.append((doc.n, "psm", a, b - a, b"".join((p, text[:i], s, text[j:], m, text[i:j]))))
            columns = [pa.array(c, f.type) for c, f in zip(zip(*out) if out else [()] * 5, list(schema)[1:])]
            yield pa.record_batch([batch.column(0), *columns], schema=schema)

    kind = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output binary"
    return drawn.mapInArrow(work, kind).withColumn("output", F.col("output").cast("string"))


def restore(output: Column, form: Column) -> Column:
    """The exact text, from an output and its form alone.

    Pieces hold no control string, and none can arise where pieces meet: each starts with ``<`` and
    ends with ``>``, so the first found is the one that was put there.
    """
    cut = {f: f"(?s)^{a}(.*?){b}(.*?){c}(.*)$" for f, (a, b, c) in
           {"psm": (PREFIX, SUFFIX, MIDDLE), "spm": (SUFFIX, PREFIX, MIDDLE)}.items()}
    return (F.when(form == "psm", F.regexp_replace(output, cut["psm"], "$1$3$2"))
            .when(form == "spm", F.regexp_replace(output, cut["spm"], "$2$3$1")).otherwise(output))
