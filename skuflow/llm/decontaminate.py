"""Benchmark decontamination by size-partitioned MinHash containment search (operator 2).

Items are cut into distinct shingles of five words. Partitions of items by size (powers of
two of the shingle count m) each get one sketch size: the bottom-k MinHash values of an
item, with k above the number of shingles that an occurrence at the threshold may lack. A
document that contains ``threshold`` of an item then holds at least one sketch shingle, so
the search by equality join over the shingles of whole documents loses no occurrence, in
documents of any length. Candidates are verified by exact containment over all shingles.

Everything is DataFrame code. Sketch and candidate tables are written to the shared folder,
so Spark joins them by broadcast only below the session's threshold.

Words are runs of letters and digits, lower-cased. An item with fewer than five words has
one shingle, its whole sequence; documents then give their shingles of that many words too, for
the lengths (four at most) that occur among the items. A text with no words never matches.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skuflow.llm.common import stage

SHINGLE = 5
THRESHOLD = 0.8


def _words(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), "")


def _grams(size: int, value: Callable[..., Column], short: Sequence[int] = ()) -> Column:
    """Array with ``value`` of the words of every shingle of the column ``w``, also of ``short`` numbers of words."""
    n = F.size("w")
    starts = lambda k: F.slice("w", F.lit(1), F.greatest(n - (k - 1), F.lit(0)))
    after = lambda i, k: (F.get("w", i + j) for j in range(1, k))
    each = F.transform(starts(size), lambda x, i: value(x, *after(i, size)))
    whole = F.when(n >= size, each).when(n > 0, F.array(value(F.concat_ws(" ", "w"))))
    if not short:
        return whole
    runs = lambda k: F.transform(starts(k), lambda x, i: value(F.concat_ws(" ", x, *after(i, k))))
    return F.concat(whole, *map(runs, short))


def _string(*parts: Column) -> Column:
    return F.concat_ws(" ", *parts)


def _rows(df: DataFrame, size: int, *keep: str, short: Sequence[int] = ()) -> DataFrame:
    """``keep``, string and hash of every shingle, one row each."""
    both = df.select(*keep, F.arrays_zip(_grams(size, _string, short).alias("s"),
                                         _grams(size, F.xxhash64, short).alias("h")).alias("g"))
    return both.select(*keep, F.explode_outer("g").alias("g")).select(*keep, "g.s", "g.h").where("s is not null")


def item_shingles(items: DataFrame, id_col: str = "item_id", text_col: str = "text",
                  size: int = SHINGLE) -> DataFrame:
    """(item_id, n_items, m, s, h): distinct shingles; items of equal words form one, the smallest id."""
    classes = (items.select(F.col(id_col).alias("item_id"), _words(F.col(text_col)).alias("w"))
               .where(F.size("w") > 0).groupBy("w")
               .agg(F.min("item_id").alias("item_id"), F.count("*").alias("n_items")))
    grams = _rows(classes, size, "item_id", "n_items").distinct()
    sizes = grams.groupBy("item_id", "n_items").agg(F.count("*").alias("m"))
    return grams.join(sizes, ["item_id", "n_items"])


def sketches(shingles: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(h, item_id, part): bottom-k values, k fixed for each size partition 2**part <= m."""
    top = F.pow(F.lit(2), F.col("part") + 1).cast("long") - 1
    spare = lambda m: m - F.ceil(m * threshold - 1e-9) + 1
    by_item = F.struct("h", "s")
    return (shingles.withColumn("part", F.floor(F.log2("m")).cast("int"))
            .withColumn("k", F.greatest(spare(top), spare(F.col("m"))))
            .groupBy("item_id", "part", "k").agg(F.sort_array(F.collect_list(by_item)).alias("all"))
            .select("item_id", "part", F.explode(F.slice("all", F.lit(1), F.col("k").cast("int"))).alias("low"))
            .select(F.col("low.h").alias("h"), "item_id", "part").distinct())


def _need(threshold: float) -> Column:
    return F.ceil(F.col("m") * threshold - 1e-9)


def find_leaks(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               item_id_col: str = "item_id", item_text_col: str = "text",
               size: int = SHINGLE, threshold: float = THRESHOLD) -> DataFrame:
    """One row per document and contained item: doc_id, text_hash, item_id, n_items, m, matched.

    ``matched`` of the item's ``m`` distinct shingles occur in the document. Items of equal
    words are one item with the smallest id and their number in ``n_items``. Rows with the
    same doc_id (null included) and text count once. Null or wordless texts match nothing;
    empty tables give an empty result; other columns are ignored.
    """
    full = stage(item_shingles(items, item_id_col, item_text_col, size), "leak-items")
    low = stage(sketches(full, threshold), "leak-sketch")
    keys = stage(low.select("h").distinct(), "leak-keys")
    length = F.size(F.split("s", " ")).alias("n")  # words hold no blanks
    short = sorted(r["n"] for r in full.select(length).where(F.col("n") < size).distinct().collect())  # size - 1 at most
    texts = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(F.col(text_col)).alias("text_hash"),
                        _words(F.col(text_col)).alias("w"))
    # the outer form keeps Catalyst from computing the array a second time as a filter
    hashes = texts.select("doc_id", "text_hash", F.explode_outer(_grams(size, F.xxhash64, short)).alias("h"))
    hits = hashes.join(keys, "h", "left_semi").distinct()
    found = stage(hits.join(low, "h").select("doc_id", "text_hash", "item_id").distinct(), "leak-candidates")
    same = lambda a, b: a["doc_id"].eqNullSafe(b["doc_id"]) & (a["text_hash"] == b["text_hash"])
    some = found.select("doc_id", "text_hash").distinct()
    grams = _rows(texts.join(some, same(texts, some), "left_semi"), size, "doc_id", "text_hash", short=short)
    match = grams.join(full, ["h", "s"]).select("doc_id", "text_hash", "item_id", "n_items", "m", "s")
    match = match.join(found, same(match, found) & (match["item_id"].eqNullSafe(found["item_id"])), "left_semi")
    return (match.distinct().groupBy("doc_id", "text_hash", "item_id", "n_items", "m")
            .agg(F.count("*").alias("matched")).where(F.col("matched") >= _need(threshold)))


def decontaminate(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  **options) -> DataFrame:
    """The documents, all columns, without those that contain an item.

    Null and wordless texts stay, as do all documents of an empty ``items``; equal rows stay or go together,
    rows that share an id (null included) are judged by their own texts. Ties need no order.
    """
    bad = find_leaks(docs, items, id_col, text_col, **options).select(
        F.col("doc_id").alias("_leak_id"), F.col("text_hash").alias("_leak_hash")).distinct()
    bad = stage(bad, "leak-bad")
    return docs.join(bad, F.col(id_col).eqNullSafe(F.col("_leak_id"))
                     & (F.xxhash64(F.col(text_col)) == F.col("_leak_hash")), "left_anti")
