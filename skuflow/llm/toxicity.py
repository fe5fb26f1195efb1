"""Toxicity by a gap-weighted subsequence-kernel SVM on words with Nystroem landmarks (operator 8).

The kernel compares words by the three-letter subsequences they share, each weighted by
``DECAY`` to the length it spans (at most ``SPAN`` letters), so an insult with letters
inserted, dropped or attached keeps most of its similarity. Runs of single letters
("i d i o t") are read as one word too. Landmarks are words that labelled sentences single
out, plus plain words; the SVM is linear in the Nystroem features K_mm^(-1/2) k_m(word).
A sentence scores as its worst word, a document as its worst sentence, and a logistic
fit on the sample turns that into a probability.

Being linear in the kernel values, the model folds into one weight per subsequence, so
tasks score each distinct word with table look-ups and hold a table of fixed size.

Training reads at most ``max_docs`` labelled documents of each class, chosen by hash: a
documented bound. Labels, lang, source and doc_id are no inputs of a score.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skuflow.llm.common import bounded_batches, stage

ORDER, DECAY, SPAN = 3, 0.6, 7
#: Letters fold into 64 codes, so a subsequence of three has one of 2**18 indices.
CODES = 64
#: Longer words are scored in overlapping pieces of this many letters.
PIECE = 24
#: (second, third) offsets of the subsequences that start at a letter.
OFFSETS = [(i, j) for j in range(2, SPAN) for i in range(1, j)]
_MARKS = "*_-'\"`~,;:.!?()[]{}<>|#$%&=+/\\"
#: Words cached by a task between batches.
CACHE = 1 << 17


def text_words(text: str | None) -> set[str]:
    """Distinct lower-cased words, outer marks off; letter runs merged; marks inside on and off.

    A document is as toxic as its worst sentence and a sentence as its worst word, so the
    sentences of a text need no telling apart here; marks end a run of letters.
    """
    tokens = (text or "").lower().split()
    out, letters = set(), set()
    for t in set(tokens):
        core = t.strip(_MARKS)
        if len(core) >= ORDER:
            out.add(core)
            if not core.isalnum() and len(plain := "".join(c for c in core if c.isalnum())) >= ORDER:
                out.add(plain)
        elif len(t) == 1 and t.isalnum():
            letters.add(t)
    if letters:
        run: list[str] = []
        for t in [*tokens, ""]:
            if t in letters:
                run.append(t)
            elif run:
                if len(run) >= ORDER:
                    out.add("".join(run))
                run = []
    return out


def _pieces(word: str) -> list[str]:
    if len(word) <= PIECE:
        return [word]
    return [word[i:i + PIECE] for i in range(0, len(word) - PIECE // 2, PIECE // 2)]


def _codes(words: list[str], wide: int = PIECE) -> tuple[np.ndarray, np.ndarray]:
    """Letter codes of words, padded by -1, and lengths; no subsequence starts at letter ``wide`` or later."""
    n = np.fromiter((len(w) for w in words), np.int64, len(words))
    flat = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64) % CODES
    out = np.full((len(words), wide + SPAN), -1, np.int64)
    out[np.arange(wide + SPAN) < n[:, None]] = flat
    return out, n


def _occurrences(codes: np.ndarray):
    """(subsequence index, present, weight) of all words for each pair of offsets."""
    wide = codes.shape[1] - SPAN
    first = codes[:, :wide]
    for i, j in OFFSETS:
        third = codes[:, j:j + wide]
        yield (first * CODES + codes[:, i:i + wide]) * CODES + third, third >= 0, DECAY ** (j + 1)


def _norms(n: np.ndarray) -> np.ndarray:
    """Norm of a word of n letters that repeats no subsequence."""
    squares = sum(DECAY ** (2 * j + 2) * np.maximum(0, n - j) for _, j in OFFSETS)
    return np.sqrt(np.maximum(squares, DECAY ** (2 * ORDER)))


def features(words: list[str]) -> list[dict[int, float]]:
    """Normalised subsequence weights of each word."""
    codes, n = _codes(words)
    rows: list[dict[int, float]] = [{} for _ in words]
    norms = _norms(n)
    for index, present, weight in _occurrences(codes):
        for r, c in zip(*np.nonzero(present)):
            k = int(index[r, c])
            rows[r][k] = rows[r].get(k, 0.0) + weight / norms[r]
    return rows


def kernel(a: list[dict[int, float]], b: list[dict[int, float]]) -> np.ndarray:
    """Subsequence kernel of two lists of words' features."""
    ids = {k: i for i, k in enumerate({k for x in b for k in x})}
    right = np.zeros((len(b), len(ids) + 1))
    for i, x in enumerate(b):
        for k, v in x.items():
            right[i, ids[k]] = v
    left = np.zeros((len(a), len(ids) + 1))
    for i, x in enumerate(a):
        for k, v in x.items():
            left[i, ids.get(k, -1)] += v
    left[:, -1] = 0
    return left @ right.T


@dataclass
class Model:
    """Folded SVM: a weight for every subsequence, the bias, and the logistic fit."""

    weights: np.ndarray
    bias: float
    slope: float = 1.0
    offset: float = 0.0

    def word_scores(self, words: list[str]) -> np.ndarray:
        if not words:
            return np.zeros(0)
        parts = [(i, p) for i, w in enumerate(words) for p in _pieces(w)]
        owner = np.array([i for i, _ in parts])
        starts = np.array([len(p) - ORDER + 1 for _, p in parts])
        out = np.full(len(words), -np.inf)
        table = np.append(self.weights, 0.0)  # the last entry is for letters past the end
        for wide in range(8, PIECE + 1, 8):  # short words have few starts; steps of 8 leave numpy's order of summation as it is
            own = np.flatnonzero((starts <= wide) & ((starts > wide - 8) | (wide == 8)))
            if not len(own):
                continue
            codes, n = _codes([parts[k][1] for k in own], wide)
            total = np.zeros(len(own))
            for index, present, weight in _occurrences(codes):
                total += weight * table[np.where(present, index, -1)].sum(axis=1)
            np.maximum.at(out, owner[own], total / _norms(n) + self.bias)
        return out

    def worst(self, texts: list[str | None], known: dict[str, float]) -> list[tuple[float, str]]:
        """Score and word of each text's worst sentence; the bias where there is no word."""
        sets = [text_words(t) for t in texts]
        new = list(set().union(*sets) - known.keys())
        if len(known) + len(new) > CACHE:
            known.clear()
            new = list(set().union(*sets))
        for at in range(0, len(new), 1 << 14):
            part = new[at:at + (1 << 14)]
            known.update(zip(part, self.word_scores(part).tolist()))
        out = []
        for words in sets:
            top = max(map(known.__getitem__, words), default=self.bias)
            out.append((top, max((w for w in words if known[w] == top), default="")))
        return out

    def probability(self, raw: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * raw + self.offset, -500, 500)))


def _svm(x: np.ndarray, y: np.ndarray, share: np.ndarray, cost: float = 100.0, steps: int = 60) -> np.ndarray:
    """Linear SVM with squared hinge loss by Newton steps; the last weight is the bias."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x.shape[1])
    ridge = np.ones(x.shape[1])
    ridge[-1] = 1e-6
    for _ in range(steps):
        gap = 1 - y * (x @ w)
        on = gap > 0
        g = ridge * w - 2 * cost * x[on].T @ (share[on] * y[on] * gap[on])
        h = np.diag(ridge) + 2 * cost * (x[on] * share[on, None]).T @ x[on]
        step = np.linalg.solve(h, g)
        w -= step
        if np.abs(step).max() < 1e-9:
            break
    return w


def _logistic(raw: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Platt's fit with his smoothed targets; the slope stays positive."""
    n1, n0 = int((y > 0).sum()), int((y <= 0).sum())
    target = np.where(y > 0, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    x = np.stack([raw, np.ones_like(raw)], axis=1)
    w = np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        step = np.linalg.solve(h, x.T @ (p - target) + 1e-3 * (w - [1.0, 0.0]))
        w = w - np.clip(step, -5, 5)
        w[0] = max(w[0], 0.1)
        if np.abs(step).max() < 1e-8:
            break
    return float(w[0]), float(w[1])


def held_out(id_col: str, folds: int) -> Column:
    """crc32 of the id as text leaves remainder 0; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))) % folds == 0


def _sample(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str,
            folds: int, max_docs: int) -> DataFrame:
    """(text, toxic): distinct texts of at most max_docs training documents of each class."""
    known = (labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).where(~held_out(id_col, folds))
             .groupBy(F.col(id_col).alias("key")).agg((F.max(label_col) > 0).cast("int").alias("toxic")))
    # only ids with a document count towards the bound
    known = known.join(docs.select(F.col(id_col).alias("key")).distinct(), "key", "left_semi")
    order = [F.xxhash64("key"), F.col("key")]
    some = reduce(DataFrame.union, (known.where(F.col("toxic") == c).orderBy(*order).limit(max_docs) for c in (0, 1)))
    some = stage(some, "toxic-ids")
    rows = docs.select(F.col(id_col).alias("key"), F.col(text_col).cast("string").alias("text")).join(some, "key")
    return stage(rows.groupBy("text").agg(F.max("toxic").alias("toxic")), "toxic-sample")


def _word_counts(sample: DataFrame) -> DataFrame:
    """(word, pos, neg): texts of either label that hold the word."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = [(w, c) for t, c in zip(b["text"], b["toxic"]) for w in text_words(t)]
            yield pd.DataFrame(rows, columns=["word", "toxic"])

    return (sample.mapInPandas(run, "word string, toxic int").groupBy("word")
            .agg(F.sum("toxic").alias("pos"), F.sum(1 - F.col("toxic")).alias("neg")))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "toxic", folds: int = 5, max_docs: int = 2000, landmarks: int = 160,
        plain_words: int = 6000) -> Model:
    """Train on a bounded sample; without both classes in it, every score is the same (0.5 at most).

    Bounds: ``max_docs`` documents a class, ``landmarks`` landmark words, ``plain_words``
    words as negatives, as many again mined as hard ones.
    """
    sample = _sample(docs, labels, id_col, text_col, label_col, folds, max_docs)
    classes = {r["toxic"]: r["count"] for r in sample.groupBy("toxic").count().collect()}
    empty = Model(np.zeros(CODES ** ORDER), 0.0, 0.0, -30.0 if classes.get(0) or not classes else 30.0)
    if not (classes.get(0) and classes.get(1)):
        return empty
    counts = stage(_word_counts(sample), "toxic-words")
    odds = F.log((F.col("pos") + 0.5) / (classes[1] + 1)) - F.log((F.col("neg") + 0.5) / (classes[0] + 1))
    marked = [(r["word"], r["odds"]) for r in counts.where("pos >= 3").withColumn("odds", odds).where("odds > 1.5")
              .orderBy(F.desc("odds"), "word").limit(8 * landmarks).collect()]
    plain = [r["word"] for r in counts.where("pos <= neg * 2").orderBy(F.xxhash64("word"), "word")
             .limit(plain_words).collect()]
    if not marked or not plain:
        return empty
    # landmarks: telling words that differ from each other, and plain words
    chosen: list[str] = []
    told = [p for w, _ in marked for p in _pieces(w)[:1]]
    near = kernel(f := features(told), f)
    taken: list[int] = []
    for i in range(len(told)):
        if len(taken) < landmarks * 3 // 4 and all(near[i, j] < 0.9 for j in taken):
            taken.append(i)
    chosen = [told[i] for i in taken] + [_pieces(w)[0] for w in plain[:landmarks - len(taken)]]
    z = features(chosen)
    values, vectors = np.linalg.eigh(kernel(z, z))
    keep = values > 1e-6 * values[-1]
    whiten = (vectors[:, keep] / np.sqrt(values[keep])) @ vectors[:, keep].T

    strength = dict(marked)
    witnesses = _witnesses(sample.where("toxic = 1"), strength)
    hard: list[str] = []
    model = empty
    for _ in range(3):
        no = list(dict.fromkeys([*plain, *hard]))
        yes = [w for w in witnesses if w not in set(no)] or [told[0]]
        words = [_pieces(w)[0] for w in [*yes, *no]]
        y = np.concatenate([np.ones(len(yes)), -np.ones(len(no))])
        share = np.where(y > 0, 1 / len(yes), 2 / len(no))
        w = _svm(kernel(features(words), z) @ whiten, y, share)
        beta = whiten @ w[:-1]
        weights = np.zeros(CODES ** ORDER)
        for b, x in zip(beta, z):
            for k, v in x.items():
                weights[k] += b * v
        model = Model(weights, float(w[-1]))
        found = [(r["toxic"], r["raw"], r["word"]) for r in _scored(sample, model, "toxic").collect()]
        hard = list(dict.fromkeys([*hard, *(x for c, raw, x in found if not c and raw > -0.9 and x)]))[:plain_words]
        worst = {x for c, raw, x in found if c and raw > 0 and x}
        witnesses = list(dict.fromkeys([*witnesses, *sorted(worst)]))
    raw = np.array([r for _, r, _ in found])
    model.slope, model.offset = _logistic(raw, np.array([c for c, _, _ in found]))
    return model


def _witnesses(toxic: DataFrame, strength: dict[str, float]) -> list[str]:
    """The most telling word of each toxic text."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            best = [max(text_words(t), key=lambda w: (strength.get(w, 0.0), w), default="")
                    for t in b["text"]]
            yield pd.DataFrame({"word": [w for w in best if w in strength]}, dtype=object)

    return sorted(r["word"] for r in toxic.select("text").mapInPandas(run, "word string").distinct().collect())


def _scored(docs: DataFrame, model: Model, *keep: str) -> DataFrame:
    """``keep`` columns, raw score and worst word of the ``text`` of every row."""
    bounded_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model.weights)  # a table of fixed size
    bias = model.bias

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, float] = {}
        local = Model(shared.value, bias)
        for b in batches:
            for at in range(0, b.num_rows, 512):
                part = b.slice(at, 512)
                found = local.worst(part.column(0).to_pylist(), known)
                raw = pa.array([float(s) for s, _ in found], pa.float64())
                yield pa.RecordBatch.from_arrays([*part.columns[1:], raw, pa.array([w for _, w in found], pa.string())],
                                                 [*keep, "raw", "word"])

    kinds = [f"`{c}` {t}" for c, t in docs.select(*keep).dtypes]
    return docs.select("text", *keep).mapInArrow(run, ", ".join([*kinds, "raw double", "word string"]))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", folds: int = 5) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted, worst_word.

    Null, empty and wordless texts score as a text without any suspicious word. Repeated
    rows stay; a null doc_id counts as held out; an empty table gives an empty result.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    raw = _scored(rows, model, "doc_id")
    prob = 1 / (1 + F.exp(-(F.lit(model.slope) * F.col("raw") + F.lit(model.offset))))
    return (raw.withColumn("score", prob)
            .select("doc_id", held_out("doc_id", folds).alias("held_out"), "score",
                    (F.col("score") >= 0.5).cast("int").alias("predicted"), F.col("word").alias("worst_word")))


def keep_clean(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows, all columns, that the model does not reject."""
    own = [f"c{i}" for i in range(len(docs.columns))]
    rows = docs.toDF(*own).withColumn("text", F.col(own[docs.columns.index(text_col)]).cast("string"))
    prob = 1 / (1 + F.exp(-(F.lit(model.slope) * F.col("raw") + F.lit(model.offset))))
    return _scored(rows, model, *own).where(prob < 0.5).select(*own).toDF(*docs.columns)
