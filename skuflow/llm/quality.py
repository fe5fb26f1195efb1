"""Quality rules with thresholds from mergeable quantile sketches (operator 9).

Every document gets four base counts from its whole text. The method's signals are integer
rates; a sketch of each per (lang, source) counts them in buckets whose width grows with the
value (exact below 2**BITS, then BITS - 1 leading bits: relative error below 2**(1 - BITS)).
Such sketches merge by adding counts, so partial ones combine on the map side, a
language's sketch is the sum of its sources' and the corpus' the sum of all. They cover every
row, also those that fail the base rule. A group of n documents takes its own quantiles with weight
n / (n + ``prior``) and its language's for the rest; a language leans on the corpus in the same way.

A signal's fence lies ``reach`` times the distance from the median to the outer quantile beyond
that quantile; no constant takes part. Documents are joined with the fences of their group, and
kept if they pass the base rule and every fence.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skuflow.llm.common import bounded_batches, stage

SYMBOLS = b"#*$%&|<>"
SPACES = b" \t\n\x0b\x0c\r"
WINDOW = 5
BITS = 7
#: Signals, and which side of the distribution is suspect.
SIGNALS = {"symbol_rate": "high", "dup_line_rate": "high", "repeat_rate": "high", "upper_rate": "high", "word_length": "both"}
QUANTILES = {"low": 0.1, "mid": 0.5, "high": 0.9}
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def counts(text: str | None) -> tuple[int, int, int, int, int, int, int]:
    """The base counts of a whole text, then its lines with a word and its A-Z letters."""
    raw = (text or "").encode("utf-8", "replace")
    words = raw.split()
    symbols = len(raw) - len(raw.translate(None, SYMBOLS))
    chars = len(text or "") - (len(raw) - len(raw.translate(None, SPACES)))
    lines = [x for x in raw.split(b"\n") if x.strip(SPACES)]
    upper = len(raw) - len(raw.translate(None, b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"))
    return (len(words), chars, symbols, len(lines) - len(set(lines)), _repeated(words), len(lines), upper)


def _repeated(words: list[bytes]) -> int:
    """Words in windows of five that occur twice or more in the text."""
    windows = list(zip(*(words[i:] for i in range(WINDOW))))
    if len(set(windows)) == len(windows):
        return 0
    seen = Counter(windows)
    total, end = 0, 0
    for i, w in enumerate(windows):
        if seen[w] > 1:
            total += i + WINDOW - max(i, end)
            end = i + WINDOW
    return total


def signals(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
            source_col: str = "source") -> DataFrame:
    """doc_id, lang, source, the base counts, base_failed and the method's integer rates."""
    names = [*BASE, "n_lines", "n_upper"]
    schema = pa.schema([("doc_id", pa.int64()), ("lang", pa.string()), ("source", pa.string()),
                        *((n, pa.int64()) for n in names)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [counts(t) for t in b.column(3).to_pylist()]
            found = [pa.array([r[i] for r in rows], pa.int64()) for i in range(len(names))]
            yield pa.RecordBatch.from_arrays([*(b.column(i).cast(schema.types[i]) for i in range(3)), *found], schema=schema)

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(lang_col).cast("string").alias("lang"),
                       F.col(source_col).cast("string").alias("source"), F.col(text_col).cast("string").alias("text"))
    kinds = ", ".join(["doc_id long, lang string, source string", *(f"{n} long" for n in names)])
    found = rows.mapInArrow(run, kinds)

    def rate(over: str, under: str) -> Column:
        return F.floor(F.col(over) * 10_000 / F.greatest(F.col(under), F.lit(1))).cast("long")

    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return found.select(
        "doc_id", "lang", "source", *BASE, failed.alias("base_failed"),
        rate("n_symbols", "word_chars").alias("symbol_rate"), rate("n_dup_lines", "n_lines").alias("dup_line_rate"),
        rate("n_repeat_words", "n_words").alias("repeat_rate"), rate("n_upper", "word_chars").alias("upper_rate"),
        F.floor(F.col("word_chars") * 100 / F.greatest("n_words", F.lit(1))).cast("long").alias("word_length"))


def bucket(value: Column) -> Column:
    """The lowest value that shares a sketch bucket with a value of 0 or more."""
    spare = F.greatest(F.length(F.bin(value)) - BITS, F.lit(0))
    return F.call_function("shiftleft", F.call_function("shiftright", value, spare), spare)


def sketch(rows: DataFrame) -> DataFrame:
    """(lang, source, signal, bucket, n) over all rows."""
    pairs = F.explode(F.array(*(F.struct(F.lit(s).alias("signal"), bucket(F.col(s)).alias("bucket")) for s in SIGNALS)))
    return (rows.select("lang", "source", pairs.alias("x"))
            .groupBy("lang", "source", "x.signal", "x.bucket").agg(F.count("*").alias("n")))


def quantiles(sketches: DataFrame, *by: str) -> DataFrame:
    """``by``, signal, docs and the sketch's quantiles: the first bucket that reaches each rank."""
    merged = sketches.groupBy(*by, "signal", "bucket").agg(F.sum("n").alias("n"))
    group = Window.partitionBy(*by, "signal")
    upto = F.sum("n").over(group.orderBy("bucket"))
    ranked = merged.withColumn("upto", upto).withColumn("docs", F.sum("n").over(group))
    return ranked.groupBy(*by, "signal", "docs").agg(*(
        F.min(F.when(F.col("upto") >= F.ceil(q * F.col("docs")), F.col("bucket"))).alias(name)
        for name, q in QUANTILES.items()))


def fences(sketches: DataFrame, prior: float = 50.0, reach: float = 3.0) -> DataFrame:
    """(lang, source, fences): a map of lowest and highest value allowed for every signal."""
    own = quantiles(sketches, "lang", "source")
    language = quantiles(sketches, "lang").withColumnsRenamed({c: f"l_{c}" for c in ("lang", "signal", "docs", *QUANTILES)})
    corpus = quantiles(sketches).withColumnsRenamed({c: f"c_{c}" for c in ("signal", "docs", *QUANTILES)})
    both = (own.join(language, F.col("lang").eqNullSafe(F.col("l_lang")) & (F.col("signal") == F.col("l_signal")))
            .join(corpus, F.col("signal") == F.col("c_signal")))
    own_share, language_share = (F.col(n) / (F.col(n) + F.lit(prior)) for n in ("docs", "l_docs"))
    value = {c: own_share * F.col(c) + (1 - own_share) * (
        language_share * F.col(f"l_{c}") + (1 - language_share) * F.col(f"c_{c}")) for c in QUANTILES}
    step = 1 + 1 / 2 ** (BITS - 1)  # a bucket stands for values up to this much larger
    high = value["high"] * step + reach * (value["high"] - value["mid"])
    low = value["low"] - reach * (value["mid"] - value["low"])
    low = F.when(F.col("signal").isin([s for s, side in SIGNALS.items() if side == "both"]), low).otherwise(F.lit(-1.0))
    return both.groupBy("lang", "source").agg(F.map_from_entries(F.collect_list(
        F.struct("signal", F.struct(low.alias("low"), high.alias("high"))))).alias("fences"))


def judge(docs: DataFrame, prior: float = 50.0, reach: float = 3.0, **columns: str) -> DataFrame:
    """doc_id, the base counts, base_failed, kept, failed (names of the signals past their fence).

    Null and empty texts have no words and fail the base rule. A null lang or source is a
    group of its own. Repeated rows stay; an empty table gives an empty result.
    """
    bounded_batches(docs.sparkSession)
    rows = stage(signals(docs, **columns), "quality-signals")
    limits = stage(fences(stage(sketch(rows), "quality-sketch"), prior, reach), "quality-fences")
    limits = limits.withColumnsRenamed({"lang": "_lang", "source": "_source"})
    joined = rows.join(limits, F.col("lang").eqNullSafe(F.col("_lang")) & F.col("source").eqNullSafe(F.col("_source")), "left")
    beyond = F.filter(F.array(*(
        F.when((F.col(s) > F.col("fences")[s]["high"]) | (F.col(s) < F.col("fences")[s]["low"]), F.lit(s)) for s in SIGNALS)),
        lambda x: x.isNotNull())
    return joined.withColumn("failed", beyond).select(
        "doc_id", *BASE, "base_failed", (~F.col("base_failed") & (F.size("failed") == 0)).alias("kept"), "failed")
