"""SimHash near-duplicates by deletion-variant signatures (operator 6).

Two fingerprints that differ in at most k bits are cut into k // 2 + 1 segments: one
segment then differs by at most one bit. Every distinct fingerprint is indexed under each
of its segments with one bit wildcarded, an equality join on (segment, wildcard, masked
value) brings candidates together, and the full distance is verified. Buckets with more
than ``bucket`` fingerprints are not paired: their members are indexed under all
k-wildcard masks of the whole fingerprint, where a group holds at most 2**k values, so
no link is lost and no large group is expanded into pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skuflow.llm.common import bounded_batches, connected_components, stage

SEED = 42
#: Shingles hashed at once, which bounds the memory for a very long text.
CHUNK = 1 << 16


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """Unsigned 64-bit SimHash of a whole text; zero when it has no words."""
    w = (text or "").encode("utf-8", "replace").lower().split()
    if not w:
        return 0
    n = max(1, len(w) - shingle + 1)
    ones = np.zeros(64, np.int64)
    for at in range(0, n, CHUNK):
        part = w[at:at + CHUNK + shingle - 1]
        grams = zip(*(part[i:] for i in range(shingle))) if len(w) >= shingle else [part]
        h = np.fromiter((xxhash.xxh64_intdigest(b" ".join(g), SEED) for g in grams), np.uint64)
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > n, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, id_col: str, text_col: str, shingle: int) -> DataFrame:
    """(doc_id, text_hash, fp): fp is the fingerprint as a signed long."""
    schema = pa.schema([("doc_id", pa.int64()), ("text_hash", pa.int64()), ("fp", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = np.array([fingerprint(t, shingle) for t in b.column(2).to_pylist()], np.uint64)
            yield pa.record_batch([b.column(0), b.column(1), pa.array(fp.view(np.int64))], schema=schema)

    text = F.col(text_col).cast("string")
    return (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("text_hash"), text.alias("text"))
            .mapInArrow(run, "doc_id long, text_hash long, fp long"))


def links(prints: DataFrame, max_bits: int, bucket: int) -> DataFrame:
    """Verified pairs (u, v), u > v, that join all distinct ``fp`` within ``max_bits``."""
    if not 0 <= max_bits <= 3:
        raise ValueError("max_bits is 0 to 3")
    if max_bits == 0:
        return prints.select(F.col("fp").alias("u"), F.col("fp").alias("v")).where("u > v")
    parts = max_bits // 2 + 1
    cuts = [64 * i // parts for i in range(parts + 1)]
    seg = [sum(1 << b for b in range(lo, hi)) for lo, hi in zip(cuts, cuts[1:])]
    signed = [m - (1 << 64) if m >> 63 else m for m in seg]
    by_bit = F.array(*(F.lit(signed[s]) for s in range(parts) for _ in range(cuts[s], cuts[s + 1])))
    bit = F.explode(F.sequence(F.lit(0), F.lit(63))).alias("bit")
    keyed = prints.select("fp", bit).select("fp", "bit", _cleared(F.col("fp").bitwiseAND(
        F.element_at(by_bit, F.col("bit") + 1)), F.col("bit")).alias("key"))
    # of one bucket: how many, so that only shared buckets go on
    shared = stage(keyed.groupBy("bit", "key").agg(F.count("*").alias("n")).where("n > 1"), "simhash-buckets")
    # both sides grow with the corpus: the same shuffled join at every size
    members = stage(keyed.join(shared.hint("merge"), ["bit", "key"]), "simhash-members")
    near = members.where(F.col("n") <= bucket)
    a, b = near.alias("a"), near.alias("b")
    pairs = a.join(b, (F.col("a.bit") == F.col("b.bit")) & (F.col("a.key") == F.col("b.key"))
                   & (F.col("a.fp") > F.col("b.fp"))
                   & (F.bit_count(F.col("a.fp").bitwiseXOR(F.col("b.fp"))) <= max_bits))
    pairs = pairs.select(F.col("a.fp").alias("u"), F.col("b.fp").alias("v"))
    return pairs.union(_masked_links(members.where(F.col("n") > bucket).select("fp").distinct(), max_bits)).distinct()


def _cleared(value, bit):
    return value.bitwiseAND(F.bitwise_not(F.call_function("shiftleft", F.lit(1).cast("long"), bit)))


def _masked_links(prints: DataFrame, max_bits: int) -> DataFrame:
    """Links among members of crowded buckets: equal values under a mask of max_bits wildcards."""
    rows = prints.select("fp", F.col("fp").alias("value"), F.lit(-1).alias("last"), F.lit("").alias("mask"))
    for left in range(max_bits, 0, -1):
        bit = F.explode(F.sequence(F.col("last") + 1, F.lit(64 - left))).alias("bit")
        rows = rows.select("fp", "value", "mask", bit).select(
            "fp", _cleared(F.col("value"), F.col("bit")).alias("value"), F.col("bit").alias("last"),
            F.concat_ws(",", "mask", "bit").alias("mask"))
    groups = rows.groupBy("mask", "value").agg(F.collect_set("fp").alias("fps")).where(F.size("fps") > 1)
    return (groups.select(F.array_min("fps").alias("v"), F.explode("fps").alias("u"))
            .where("u > v").select("u", "v"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    shingle: int = 3, max_bits: int = 2, bucket: int = 256) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits), component_id.

    component_id is the smallest doc_id reachable over fingerprints within ``max_bits``.
    Null and blank texts have fingerprint zero and are linked like any other. Copies share
    one fingerprint and are collapsed before any join. Repeated rows stay; a null doc_id
    takes part, but is never a component_id unless no document of its group has an id.
    Other columns are ignored; an empty table gives an empty result.
    """
    return groups(docs, id_col, text_col, shingle, max_bits, bucket).drop("text_hash", "component_hash")


def groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
           shingle: int = 3, max_bits: int = 2, bucket: int = 256) -> DataFrame:
    """``near_duplicates`` with the ``text_hash`` (xxhash64) of each row and of its component's first row.

    Rows of one id are told apart by it; the first row has the smallest doc_id, then the smallest hash.
    """
    bounded_batches(docs.sparkSession)
    prints = stage(fingerprints(docs, id_col, text_col, shingle), "simhash-fp")
    classes = stage(prints.groupBy("fp").agg(F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "text_hash"))).alias("rep")), "simhash-classes")
    roots = connected_components(links(classes.select("fp"), max_bits, bucket), "simhash-cc")
    roots = stage(roots.withColumnRenamed("node", "fp"), "simhash-roots")
    linked = classes.join(roots, "fp")
    named = (linked.select("fp", "root").join(linked.groupBy("root").agg(F.min("rep").alias("best")), "root")
             .select("fp", "best"))
    labels = classes.join(named, "fp", "left").select("fp", F.coalesce("best", "rep").alias("best"))
    return prints.join(labels, "fp").select(
        "doc_id", "text_hash", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.col("best.doc_id").alias("component_id"), F.col("best.text_hash").alias("component_hash"))
