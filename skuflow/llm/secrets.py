"""Secret scan with a random forest that removes false positives (operator 7).

Candidates are PEM blocks, JSON web tokens, any value given to a credential name or in an address,
and runs of token characters that are no plain word and vary enough. Each gets features of
its length, character classes and transitions between them, coverage by words frequent in
the corpus, place in a path or address, and neighbouring words. Labelled findings train
Spark's random forest; a candidate is a secret when the forest's probability reaches ``threshold``.

Without a table of labelled findings some candidates are judged by rules (``weak_label``): fixed
formats and values given to a credential name are confirmed; e-mail and web addresses, IPs, card
and phone numbers, dates, UUIDs, placeholders and numbered names (three values or more that differ
in digits only) are false positives. The rest is left to the forest. It sees every judged row twice
then, once as it is and once without the features that a rule looks at (``RULED``), so that it uses
these features but does not lean on them alone.
"""

from __future__ import annotations

import bisect
import math
import re
from collections import Counter
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skuflow.llm.common import bounded_batches, stage

#: Names that a credential is assigned to.
CUE = re.compile(r"(?i)(pass(?:word|wd|phrase)?|secret|token|api[_-]?key|access[_-]?key|auth|bearer|credential|private[_-]?key)")
GIVEN = CUE.pattern + r"[A-Za-z0-9_\-]{0,32}[\"']?(?:\s*(?:=>|:=|[=:])\s*(?:bearer\s+|basic\s+)?|(?<=bearer)\s+(?=\S*[0-9]))"
#: Marks around a PEM block, and what cannot stand inside one.
PEM = re.compile(r"(?P<open>-----BEGIN [A-Z ]*PRIVATE KEY-----)|(?P<close>-----END [A-Z ]*PRIVATE KEY-----)|[^A-Za-z0-9+/=\s:,\-]+")
#: Candidates after PEM blocks, in order of precedence; the last group is the value.
SHAPES = [re.compile(x) for x in (
    r"(?<![A-Za-z0-9_\-])(eyJ[A-Za-z0-9_\-]{5,}\.[A-Za-z0-9_\-]{5,}\.[A-Za-z0-9_\-]*)",
    r"://[^\s:/@]+:([^\s:/@]+)@",
    GIVEN + r"\"([^\"\n]{4,})\"", GIVEN + r"'([^'\n]{4,})'", GIVEN + r"([^\s\"',;<>()\[\]{}]{4,})")]
#: What a text holds if a shape can occur in it; None: a credential name.
HINTS = ("eyJ", "://", None, None, None)
#: Marks at the ends of a run belong to the sentence.
RUN = re.compile(r"(?<![A-Za-z0-9+/_\-@#$%^&~])[A-Za-z0-9+/_\-][A-Za-z0-9+/_\-.@!#$%^&*~]{6,}[A-Za-z0-9+/_\-](?:={0,2}(?![A-Za-z0-9]))")
#: Least entropy of a run in bits a character; a run of letters in one case that is this long is no plain word.
VARIED, LONG = 2.5, 20
#: Fixed provider formats.
FORMATS = re.compile(r"AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36}|sk-[A-Za-z0-9]{20,}|xox[abp]-[A-Za-z0-9-]{10,}|AIza[0-9A-Za-z_\-]{35}")
NAMES = ["length", "digits", "uppers", "lowers", "others", "transitions", "distinct", "entropy", "hex", "coverage",
         "slashes", "in_path", "quoted", "assigned", "cue_before", "cue_near", "digit_runs"]
#: Features that ``weak_label`` looks at too.
RULED = [NAMES.index(n) for n in ("in_path", "assigned", "cue_before", "cue_near")]
#: What is surely no secret, whole values.
HARMLESS = re.compile(r"""(?ix)[\w.%+\-]+@[\w\-]+(\.[\w\-]+)+ | \d{1,3}(\.\d{1,3}){3} | \d{4}[\-/.]\d\d?[\-/.]\d\d?([T ].*)?
    | [0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12} | \+?\d{1,4}([.\-]\d{2,4}){2,4} | \d{4}([\-]?\d{4}){2}[\-]?\d{1,7} | www\..*""")
PLACEHOLDER = re.compile(r"(?i)<.*>|\$\{?\w+\}?|%\w+%|[x*.\-]+|changeme|example.*|your[_\- ].*|null|none|true|false|undefined")
#: Text looked at on either side of a candidate.
NEAR = 48
#: Corpus words that make the dictionary: a bounded list of the most frequent.
DICTIONARY = 5000


def _kind(c: str) -> int:
    return 0 if c.isdigit() else 1 if c.isupper() else 2 if c.islower() else 3


def _coverage(value: str, dictionary: frozenset[str]) -> float:
    """Share of the letters inside words of the dictionary, longest first."""
    low, at, hit = value.lower(), 0, 0
    while at < len(low):
        n = next((k for k in range(min(12, len(low) - at), 2, -1) if low[at:at + k] in dictionary), 0)
        hit += n
        at += n or 1
    return hit / len(low)


def features(text: str, start: int, stop: int, dictionary: frozenset[str]) -> list[float]:
    value = text[start:stop]
    n = len(value)
    kinds = [_kind(c) for c in value]
    share = [kinds.count(k) / n for k in range(4)]
    p = np.array(list(Counter(value).values())) / n
    before, after = text[max(0, start - NEAR):start], text[stop:stop + NEAR]
    word = re.search(r"([A-Za-z_\-]+)[\s\"'=:>]*$", before)
    runs = re.findall(r"[0-9]+", value)
    return [float(n), *share, sum(a != b for a, b in zip(kinds, kinds[1:])) / n, len(p) / n, float(-(p * np.log2(p)).sum()),
            float(all(c in "0123456789abcdefABCDEF" for c in value)), _coverage(value, dictionary), float(value.count("/")),
            float(bool(re.search(r"(://|www\.|[/\\.])\S*$", before)) or after[:1] in ("/", "\\", ".")),
            float(before[-1:] in ("'", '"') and after[:1] in ("'", '"')), float(bool(re.search(r"[=:]\s*[\"']?$", before))),
            float(bool(word and CUE.search(word[1]))), float(bool(CUE.search(before + " " + after))), float(len(runs))]


def weak_label(text: str, start: int, stop: int) -> int | None:
    """1 for a confirmed finding, 0 for a false positive, None where no rule decides."""
    value, before = text[start:stop], text[max(0, start - NEAR):start]
    if PLACEHOLDER.fullmatch(value):
        return 0
    if FORMATS.fullmatch(value) or SHAPES[0].fullmatch(value) or pem_blocks(value) == [(0, len(value))]:
        return 1
    if re.search(GIVEN + r"[\"']?$", before, re.I) or re.search(r"://[^\s:/@]+:$", before) and text[stop:stop + 1] == "@":
        return None if value.isalpha() else 1
    return 0 if HARMLESS.fullmatch(value) or re.search(r"(?:://|www\.)\S*$|https?:$", before) else None


def _varied(v: str) -> bool:
    """No plain word, and enough entropy."""
    if v.isalpha() and len(v) < LONG and (v.isupper() or v[1:].islower()):
        return False
    n = len(v)
    return sum(k * math.log2(n / k) for k in Counter(v).values()) >= VARIED * n


def pem_blocks(text: str) -> list[tuple[int, int]]:
    """From each opening mark to the next closing one, by one walk over the marks."""
    found, start = [], None
    for m in PEM.finditer(text) if "-----BEGIN" in text else ():
        if m.lastgroup == "close" and start is not None:
            found.append((start, m.end()))
        if m.lastgroup != "open":
            start = None
        elif start is None:
            start = m.start()
    return found


def spans(text: str) -> list[tuple[int, int]]:
    """Candidates of a text in its order; none overlaps one of an earlier shape."""
    found = pem_blocks(text)
    cue = bool(CUE.search(text))
    for shape, hint in zip(SHAPES, HINTS):
        if cue if hint is None else hint in text:
            found = _apart(found, [m.span(m.lastindex) for m in shape.finditer(text)])
    return _apart(found, [m.span() for m in RUN.finditer(text) if _varied(m.group())])


def _apart(kept: list[tuple[int, int]], new: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Both, in order, without the new spans that overlap a kept one."""
    starts = [a for a, _ in kept]
    some = []
    for a, b in new:
        i = bisect.bisect_left(starts, b)
        if i == 0 or kept[i - 1][1] <= a:
            some.append((a, b))
    return sorted([*kept, *some])


def dictionary(docs: DataFrame, text_col: str = "text", size: int = DICTIONARY) -> list[str]:
    """The ``size`` words of three letters or more that most documents hold, ties by spelling.

    A histogram of the counts on a log scale, of some thousand steps at most, tells which counts can be
    among them; only words with such counts are ranked, and only the ranked ones reach the driver.
    """
    word = F.explode_outer(F.array_distinct(F.split(F.lower(F.coalesce(F.col(text_col), F.lit(""))), r"[^\p{L}]+")))
    counts = docs.select(word.alias("word")).where("length(word) between 3 and 12").groupBy("word").count()
    counts = stage(counts.withColumn("step", F.floor(F.log2("count") * 64)), "secret-words")
    least, total = 0, 0
    for step, n in sorted(map(tuple, counts.groupBy("step").agg(F.count("*")).collect()), reverse=True):
        least, total = step, total + n
        if total >= size:
            break
    top = stage(counts.where(F.col("step") >= least).orderBy(F.desc("count"), "word").limit(size).select("word"), "secret-dictionary")
    return [r["word"] for r in top.collect()]


def candidates(docs: DataFrame, words: list[str], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, start, stop, value, weak, features): one row per candidate, offsets in code points."""
    known = docs.sparkSession.sparkContext.broadcast(words)  # at most DICTIONARY words

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        vocabulary = frozenset(known.value)
        for b in batches:
            rows = []
            for doc, text in zip(b["doc_id"], b["text"]):
                for a, z in spans(text or ""):
                    rows.append((doc, a, z, text[a:z], weak_label(text, a, z), features(text, a, z, vocabulary)))
            out = pd.DataFrame(rows, columns=["doc_id", "start", "stop", "value", "weak", "features"])
            yield out.astype({"doc_id": "Int64", "weak": "Int32"})

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInPandas(run, "doc_id long, start int, stop int, value string, weak int, features array<double>")


def weakly_judged(found: DataFrame) -> DataFrame:
    """(value, weak, features): distinct values; unjudged ones that differ in digits only, three or more, are 0."""
    values = found.groupBy("value").agg(F.max("weak").alias("weak"), F.min("features").alias("features"))
    letters = F.length(F.regexp_replace("value", "[^A-Za-z]", "")) >= 4
    named = values.withColumn("name", F.when(letters, F.regexp_replace("value", "[0-9]+", "#")).otherwise(F.col("value")))
    numbered = named.where(letters).groupBy("name").agg(F.count("*").alias("_n")).where("_n >= 3").select(
        "name", F.lit(0).alias("_zero"))
    return named.join(numbered, "name", "left").select("value", F.coalesce("weak", "_zero").alias("weak"), "features")


def train(findings: DataFrame, label_col: str, max_findings: int = 20_000, trees: int = 40, depth: int = 8,
          blind: Sequence[int] = ()):
    """Forest over at most ``max_findings`` distinct labelled findings of each label, chosen by hash.

    Each counts a second time with the features ``blind`` set to 0. None where a label is missing.
    """
    rows = findings.where(F.col(label_col).isNotNull()).groupBy("value", F.col(label_col).alias("label")).agg(
        F.min("features").alias("features"))
    some = [rows.where(F.col("label") == c).orderBy(F.xxhash64("value"), "value").limit(max_findings) for c in (0, 1)]
    rows = some[0].union(some[1])
    if blind:
        rows = rows.union(rows.withColumn("features", F.transform("features", lambda x, i: F.when(i.isin(*blind), 0.0).otherwise(x))))
    sample = stage(rows.select(F.col("label").cast("double").alias("label"),
                                                 array_to_vector("features").alias("vector")), "secret-sample")
    sizes = {r["label"]: r["count"] for r in sample.groupBy("label").count().collect()}
    if len(sizes) < 2:
        return None
    weight = F.when(F.col("label") == 1, 0.5 / sizes[1.0]).otherwise(0.5 / sizes[0.0]) * (sizes[0.0] + sizes[1.0])
    forest = RandomForestClassifier(featuresCol="vector", labelCol="label", weightCol="weight", numTrees=trees,
                                    maxDepth=depth, seed=7, minInstancesPerNode=2)
    return forest.fit(sample.withColumn("weight", weight))


def find_secrets(docs: DataFrame, labelled: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text",
                 threshold: float = 0.5) -> DataFrame:
    """One row per candidate: doc_id, start, stop, value_sha256, probability, is_secret.

    ``labelled``: (doc_id, start, label) of judged findings; without it, weak labels. With one
    label only, every candidate keeps it. Null and empty texts have no candidates; repeated
    rows give repeated findings; an empty table gives an empty result.
    """
    bounded_batches(docs.sparkSession)
    found = stage(candidates(docs, dictionary(docs, text_col), id_col, text_col), "secret-candidates")
    if labelled is None:
        judged, label = weakly_judged(found), "weak"
    else:
        marks = labelled.groupBy("doc_id", "start").agg(F.max("label").alias("label"))
        judged, label = found.join(marks, ["doc_id", "start"]), "label"
    model = train(judged, label, blind=RULED if labelled is None else ())
    vectors = found.withColumn("vector", array_to_vector("features"))
    if model is None:
        only = judged.agg(F.coalesce(F.max(label), F.lit(0)).cast("double").alias("p")).first()["p"]
        scored = vectors.withColumn("probability_1", F.lit(only))
    else:
        scored = model.transform(vectors).withColumn("probability_1", vector_to_array("probability")[1])
    p = F.round("probability_1", 9)
    return scored.select("doc_id", "start", "stop", F.sha2("value", 256).alias("value_sha256"),
                         p.alias("probability"), (p >= threshold).alias("is_secret"))
