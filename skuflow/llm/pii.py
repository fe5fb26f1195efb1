"""Personal data by patterns and information-theoretic sanitisation (operator 10).

Base spans come from patterns of four kinds. The values found are protected entities. How
strongly a term reveals one is estimated from the corpus: with df the number of documents,
PMI(t, e) = log(P(e|t) / P(e)) is compared with the information content IC(e) = log(1 / P(e)),
where P(e) = df(e) / N. All tokens of every document that holds an entity count, whatever the
entity's df. P(e|t) = (df(t, e) + PRIOR df(e) / N) / (df(t) + PRIOR) damps rare terms
smoothly, and a document that holds the term only away from the entity adds FAR to df(t, e).
A term whose PMI reaches ``generalise_at`` of the entity's IC is generalised in the documents
that hold both, and removed from ``remove_at`` on. A pair whose counts rule that out is dropped
before it is formed.

All steps are DataFrame expressions. Java's greedy group loops recurse, so the patterns use
possessive forms, which match the same; look-behinds start a search at the head of a run only,
which keeps long runs linear and finds the same leftmost matches.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skuflow.llm.common import Staged, release, stage

#: Fixed kinds, in order, with their patterns.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)++",
    "ip": r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: What a text must hold for the pattern to be tried.
HINTS = {"email": "@", "ip": ".", "card": None, "phone": "+"}
KINDS = [*PATTERNS, "term"]
SPAN = "array<struct<start:int,stop:int,value:string>>"
#: Characters and words on either side of an entity that count as near.
REACH, NEAR = 80, 5
#: What a document adds to df(t, e) if the term is nowhere near, and documents of the corpus' rate that the estimate starts from.
FAR, PRIOR = 2 / 3, 0.5


def _located(text: Column, pattern: Column) -> Column:
    """Spans of all matches, in code points: gaps from split, matches from regexp_extract_all."""
    both = F.zip_with(F.split(text, pattern, -1), F.regexp_extract_all(text, pattern, F.lit(0)),
                      lambda gap, hit: F.struct(F.length(gap).alias("gap"), hit.alias("hit")))
    start = F.struct(F.lit(0).alias("at"), F.array().cast(SPAN).alias("spans"))

    def add(acc: Column, x: Column) -> Column:
        lo = acc["at"] + x["gap"]
        hi = lo + F.coalesce(F.length(x["hit"]), F.lit(0))
        span = F.struct(lo.alias("start"), hi.alias("stop"), x["hit"].alias("value"))
        spans = F.when(x["hit"].isNull(), acc["spans"]).otherwise(F.concat(acc["spans"], F.array(span)).cast(SPAN))
        return F.struct(hi.alias("at"), spans.alias("spans"))

    return F.aggregate(both, start, add, lambda acc: acc["spans"])


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(value: Column) -> Column:
    digits = _digits(value)
    n = F.length(digits)

    def add(acc: Column, i: Column) -> Column:
        d = F.substr(digits, n - i + 1, F.lit(1)).cast("int")
        twice = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
        return acc + F.when(i % 2 == 0, twice).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), n), F.lit(0), add) % 10 == 0


VALID = {
    "email": lambda v: F.lit(True),
    "ip": lambda v: F.forall(F.split(v, r"\."), lambda p: F.coalesce(p.try_cast("int"), F.lit(256)) <= 255),
    "card": lambda v: F.length(_digits(v)).between(13, 19) & _luhn(v),
    "phone": lambda v: F.length(_digits(v)).between(9, 15),
}


def _spans(text: Column, kind: str) -> Column:
    pattern = PATTERNS[kind]
    found = F.filter(_located(text, F.lit(pattern)), lambda s: VALID[kind](s["value"]))
    hint = HINTS[kind]
    maybe = text.contains(hint) if hint else text.rlike(r"[0-9](?:[\x20-]?[0-9]){12}")
    if kind == "ip":
        maybe = maybe & text.rlike(r"[0-9]\.[0-9]+\.[0-9]+\.[0-9]")
    return F.when(maybe, found).otherwise(F.array().cast(SPAN))


def base_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text_hash, text, email, ip, card, phone): text only where a span was found."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    found = rows.select("doc_id", F.xxhash64("text").alias("text_hash"), "text", *(_spans(text, k).alias(k) for k in PATTERNS))
    return found.withColumn("text", F.when(_any(), F.col("text")))


def _any() -> Column:
    return sum((F.size(k) for k in PATTERNS), F.lit(0)) > 0


def _terms(text: Column) -> Column:
    """Distinct lower-cased runs of letters and digits."""
    return F.array_remove(F.array_distinct(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+")), "")


def _near(text: Column, s: Column) -> Column:
    """The terms within REACH characters and about NEAR words of a span."""
    spaces = r"[\x20\x09-\x0D]+"
    left = F.split(F.substr(text, F.greatest(s["start"] - REACH + 1, F.lit(1)), F.least(s["start"], F.lit(REACH))), spaces)
    right = F.split(F.substr(text, s["stop"] + 1, F.lit(REACH)), spaces)
    # a word that the window cuts in two is no term
    left = F.when(s["start"] > REACH, F.slice(left, 2, F.greatest(F.size(left) - 1, F.lit(0)))).otherwise(left)
    right = F.when(F.length(text) > s["stop"] + REACH, F.slice(right, 1, F.greatest(F.size(right) - 1, F.lit(0)))).otherwise(right)
    return _terms(F.concat_ws(" ", F.slice(F.reverse(left), 1, NEAR + 1), F.slice(right, 1, NEAR + 1)))


def entity_texts(found: DataFrame) -> DataFrame:
    """(text_hash, n, terms, places): each distinct text that holds an entity.

    ``n`` is the number of documents with the text, ``terms`` its distinct tokens, ``places`` its
    entities with the terms close to them.
    """
    columns = [F.first(c).alias(c) for c in ("text", *PATTERNS)]
    texts = found.where("text is not null").groupBy("text_hash").agg(F.count_distinct(F.struct("doc_id")).alias("n"), *columns)
    places = F.transform(F.concat(*PATTERNS), lambda s: F.struct(s["value"].alias("entity"), _near(F.col("text"), s).alias("close")))
    return texts.select("text_hash", "n", _terms(F.col("text")).alias("terms"), places.alias("places"))


def _possible(df_entity: Column, df_term: Column, n: Column, threshold: float) -> Column:
    """Whether a term of ``df_term`` documents can disclose an entity of ``df_entity``, at best.

    The estimate grows with the documents that hold both, of which there are at most
    min(df_entity, df_term); so no pair that reaches the threshold fails this.
    """
    rate = df_entity / n
    best = (F.least(df_entity, df_term) + PRIOR * rate) / (df_term + PRIOR)
    return best >= F.pow(rate, F.lit(1 - threshold)) * (1 - 1e-9)


def entity_terms(docs: DataFrame, texts: DataFrame, text_col: str = "text", threshold: float = 0.9) -> DataFrame:
    """(text_hash, n, entity, term, near, df_entity, df_term, docs): entities of ``texts`` with tokens of their text.

    Tokens are counted over all documents first. A token leaves a text whose entities it cannot
    disclose by ``_possible``, and only then is paired with them: common words meet no entity.
    """
    n = F.lit(docs.count())
    held = texts.select("text_hash", "n", F.explode(F.array_distinct("places.entity")).alias("entity"))
    counts = held.groupBy("entity").agg(F.sum("n").alias("df_entity"))
    held = stage(held.join(counts, "entity"), "pii-held")
    rates = held.groupBy("text_hash").agg(F.collect_set("df_entity").alias("rates"))
    seen = docs.select(F.explode(_terms(F.col(text_col).cast("string"))).alias("term")).groupBy("term").agg(
        F.count("*").alias("df_term"))
    tokens = texts.join(rates, "text_hash").select("text_hash", "rates", F.explode("terms").alias("term"))
    rare = tokens.join(seen, "term").where(F.exists("rates", lambda e: _possible(e, F.col("df_term"), n, threshold)))
    pairs = rare.drop("rates").join(held, "text_hash").where(_possible(F.col("df_entity"), F.col("df_term"), n, threshold))
    close = texts.select("text_hash", F.explode("places").alias("p")).select(
        "text_hash", F.col("p.entity").alias("entity"), F.explode("p.close").alias("term")).distinct().withColumn("near", F.lit(True))
    return pairs.join(close, ["text_hash", "entity", "term"], "left").withColumns({
        "near": F.coalesce("near", F.lit(False)), "docs": n})


def disclosing_terms(pairs: DataFrame, threshold: float = 0.9) -> DataFrame:
    """(entity, term, disclosure) of the ``pairs`` (``entity_terms``) that reach the threshold."""
    counted = pairs.groupBy("entity", "term").agg(
        F.sum("n").alias("both"), F.sum(F.col("n") * F.when(F.col("near"), 1.0).otherwise(FAR)).alias("weight"),
        *(F.max(c).alias(c) for c in ("df_entity", "df_term", "docs")))
    rate = F.col("df_entity") / F.col("docs")
    given = (F.col("weight") + PRIOR * rate) / (F.greatest("df_term", "both") + PRIOR)
    return counted.where("docs > df_entity").select("entity", "term", (F.log(given / rate) / F.log(1 / rate)).alias("disclosure")).where(
        F.col("disclosure") >= threshold)


def all_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
              generalise_at: float = 0.9, remove_at: float = 0.98) -> DataFrame:
    """``base_spans`` with ``term``, spans whose value is the term's disclosure level.

    Null and empty texts have no spans; empty tables give an empty result; rows with equal id
    and text count as one document in the statistics and keep their own row.
    """
    found = stage(base_spans(docs, id_col, text_col), "pii-base")
    texts = Staged(entity_texts(found), "pii-texts")
    pairs = Staged(entity_terms(docs, texts.df, text_col, generalise_at), "pii-pairs")
    texts.drop()
    terms = disclosing_terms(pairs.df, generalise_at)
    some = found.where("text is not null")
    words = stage(pairs.df.join(terms, ["entity", "term"]).groupBy(F.col("text_hash").alias("_hash"), "term")
                  .agg(F.max("disclosure").alias("d"))
                  .groupBy("_hash").agg(F.sort_array(F.collect_list("term")).alias("words"),
                                        F.collect_set(F.when(F.col("d") >= remove_at, F.col("term"))).alias("gone")), "pii-words")
    pairs.drop()
    release(docs.sparkSession)
    # copies of a text share a hash: the words reach them by narrow rows, the texts join by id and hash
    matched = some.select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash")).distinct().join(words, "_hash")
    joined = some.join(matched, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_hash") == F.col("_hash")), "left")
    # runs of letters and digits are matched whole, so that no word hides a longer one
    pattern = F.concat(F.lit(r"(?iu)(?<![\p{L}\p{N}])(?:"), F.array_join("words", "|"), F.lit(r")(?![\p{L}\p{N}])"))
    hits = F.when(F.col("words").isNotNull(), _located(F.col("text"), pattern)).otherwise(F.array().cast(SPAN))
    base = F.concat(*(F.col(k) for k in PATTERNS))
    clear = F.filter(F.col("hits"), lambda t: ~F.exists("base", lambda s: (s["start"] < t["stop"]) & (t["start"] < s["stop"])))
    level = F.transform(clear, lambda t: F.struct(t["start"].alias("start"), t["stop"].alias("stop"), F.when(
        F.array_contains("gone", F.lower(t["value"])), "removed").otherwise("generalised").alias("value")))
    with_terms = joined.withColumn("hits", hits).withColumn("base", base).withColumn("term", level.cast(SPAN))
    plain = found.where("text is null").withColumn("term", F.array().cast(SPAN))
    keep = ["doc_id", "text_hash", "text", *KINDS]
    return with_terms.select(*keep).unionByName(plain.select(*keep))


def _listed(*kinds: str) -> Column:
    def named(kind: str) -> Column:
        return F.transform(kind, lambda s: F.concat_ws(":", F.lit(kind), s["start"], s["stop"]))

    return F.array_join(F.concat(*map(named, kinds)), ",")


def report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, n_term, spans: one row per document."""
    spans = all_spans(docs, id_col, text_col, **options)
    counts = [F.size(k).cast("long").alias(f"n_{k}") for k in KINDS]
    return spans.select("doc_id", *counts, F.sha2(_listed(*PATTERNS), 256).alias("base_sha256"), _listed(*KINDS).alias("spans"))


def sanitise(docs: DataFrame, **options) -> DataFrame:
    """The documents, all columns: base spans become [KIND], terms [TERM] or nothing; n_chars follows."""
    text = F.coalesce(F.col("text"), F.lit(""))
    has = sum((F.size(_spans(text, k)) for k in PATTERNS), F.lit(0)) > 0
    spans = all_spans(docs, **options).where("text is not null").select(
        F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"), *(F.col(k).alias(f"_{k}") for k in KINDS))
    spans = stage(spans.dropDuplicates(["_id", "_hash"]), "pii-spans")

    def tagged(kind: str) -> Column:
        return F.transform(f"_{kind}", lambda s: F.struct(
            s["start"].alias("start"), s["stop"].alias("stop"),
            (F.when(s["value"] == "removed", "").otherwise("[TERM]") if kind == "term"
             else F.lit(f"[{kind.upper()}]")).alias("tag")))

    marks = F.array_sort(F.concat(*map(tagged, KINDS)))
    empty = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def add(acc: Column, s: Column) -> Column:
        gap = F.substr("text", acc["at"] + 1, F.greatest(s["start"] - acc["at"], F.lit(0)))
        over = s["stop"] <= acc["at"]
        return F.struct(F.greatest(acc["at"], s["stop"]).alias("at"),
                        F.when(over, acc["out"]).otherwise(F.concat(acc["out"], gap, s["tag"])).alias("out"))

    done = F.aggregate("_marks", empty, add,
                       lambda acc: F.concat(acc["out"], F.substr("text", acc["at"] + 1, F.length("text"))))
    marked = docs.where(has).join(spans, F.col("doc_id").eqNullSafe(F.col("_id"))
                                  & (F.xxhash64("text") == F.col("_hash"))).withColumn("_marks", marks)
    changed = marked.withColumn("_text", done).select(*(
        F.col("_text").alias(c) if c == "text" else F.length("_text").cast(t).alias(c) if c == "n_chars" else F.col(c)
        for c, t in docs.dtypes))
    return docs.where(~has).unionByName(changed)
