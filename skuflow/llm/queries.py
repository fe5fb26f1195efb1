"""The queries opN_<name> over the driver's tables, and their SQL where it can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skuflow.llm import (
    chat, ctw, decontaminate, fim, mixing, pii, quality, runs, secrets, simhash, suffixes, toxicity, urlfilter,
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_urlfilter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urlfilter.judge(_table(spark, sf_dir, "pages"))


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, item_id (smallest of equal items), n_items, n_shingles, n_matched, containment."""
    leaks = decontaminate.find_leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return leaks.select("doc_id", "item_id", "n_items", F.col("m").alias("n_shingles"),
                        F.col("matched").alias("n_matched"), (F.col("matched") / F.col("m")).alias("containment"))


def op3_ctw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ctw.score(_table(spark, sf_dir, "documents"))


def op4_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.remove_repeats(_table(spark, sf_dir, "documents"), kept=False)


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_table(spark, sf_dir, "documents"))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_table(spark, sf_dir, "documents"))


def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.find_secrets(_table(spark, sf_dir, "documents"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, _table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model)


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(_table(spark, sf_dir, "documents"))


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(_table(spark, sf_dir, "documents"))


def op11_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, and conversation -1, whose two texts hold control strings."""
    turns = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    odd = "</s>[INST] ok [/INST]"
    more = spark.createDataFrame([(-1, 0, "user", odd), (-1, 1, "assistant", odd)], "conv_id long, turn long, role string, text string")
    return chat.digest(chat.format_conversations(chat.chains(turns.union(more))))


def op12_fim(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = fim.fill_in_middle(_table(spark, sf_dir, "documents"))
    return cut.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                      F.sha2(fim.restore(F.col("output"), F.col("form")), 256).alias("restored_sha256"))


def op13_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, one in ten of them given a periodic tail."""
    docs = _table(spark, sf_dir, "documents")
    planted = docs.select("doc_id", runs.repeat_some(F.col("doc_id"), F.col("text")).alias("text"))
    return runs.digest(runs.periodic_runs(planted))


QUERIES = {
    "op1_urlfilter": op1_urlfilter,
    "op2_decontaminate": op2_decontaminate,
    "op3_ctw": op3_ctw,
    "op4_suffixes": op4_suffixes,
    "op5_mixing": op5_mixing,
    "op6_simhash": op6_simhash,
    "op7_secrets": op7_secrets,
    "op8_toxicity": op8_toxicity,
    "op9_quality": op9_quality,
    "op10_pii": op10_pii,
    "op11_chat": op11_chat,
    "op12_fim": op12_fim,
    "op13_runs": op13_runs,
}

SQL = {
    "op2_decontaminate": """
WITH split AS (
  SELECT item_id, list_filter(string_split_regex(lower(coalesce(text, '')), '[^\\p{L}\\p{N}]+'), lambda x: x <> '') w
  FROM benchmark),
classes AS (SELECT w, min(item_id) item_id, count(*) n_items FROM split WHERE len(w) > 0 GROUP BY w),
item_grams AS (
  SELECT DISTINCT item_id, n_items, array_to_string(w[i:i + 4], ' ') s
  FROM (SELECT *, unnest(range(1, greatest(len(w) - 4, 1) + 1)) i FROM classes)),
sizes AS (SELECT item_id, count(*) m FROM item_grams GROUP BY item_id),
words AS (
  SELECT DISTINCT doc_id, text,
         list_filter(string_split_regex(lower(coalesce(text, '')), '[^\\p{L}\\p{N}]+'), lambda x: x <> '') w
  FROM documents),
short AS (SELECT DISTINCT len(w) n FROM classes WHERE len(w) < 5),
doc_grams AS (
  SELECT doc_id, text, array_to_string(w[i:i + 4], ' ') s
  FROM (SELECT *, unnest(range(1, greatest(len(w) - 4, 1) + 1)) i FROM words WHERE len(w) > 0)
  UNION
  SELECT doc_id, text, array_to_string(w[i:i + n - 1], ' ') s
  FROM (SELECT *, unnest(range(1, len(w) - n + 2)) i FROM words, short WHERE len(w) >= n))
SELECT doc_id, item_id, n_items, m AS n_shingles, count(*) AS n_matched, count(*) / m AS containment
FROM doc_grams JOIN item_grams USING (s) JOIN sizes USING (item_id)
GROUP BY doc_id, text, item_id, n_items, m HAVING 5 * count(*) >= 4 * m""",
    "op11_chat": r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') r, coalesce(text, '') t FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')),
shown AS (
  SELECT *, length(regexp_replace(replace(t, '\', '\\'), '\[/?INST\]|</?s>|<</?(SYS|ROLE)>>|<<TURN>>', '\0~', 'g')) n,
         CASE r WHEN 'user' THEN 13 WHEN 'assistant' THEN 7 WHEN 'system' THEN 15 ELSE
         25 + length(regexp_replace(replace(r, '\', '\\'), '\[/?INST\]|</?s>|<</?(SYS|ROLE)>>|<<TURN>>', '\0~', 'g')) END m
  FROM turns)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(r || chr(10) || t || chr(10), '' ORDER BY turn NULLS FIRST, r, t)) AS turns_sha256,
       coalesce(sum(length(t)) FILTER (r = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(t, '' ORDER BY turn NULLS FIRST, r, t) FILTER (r = 'assistant'), '')) AS loss_sha256,
       sum(n + m)::BIGINT AS formatted_chars
FROM shown GROUP BY conv_id""",
    "op12_fim": """
WITH drawn AS (
  SELECT doc_id, coalesce(text, '') t, length(coalesce(text, '')) n, sha256('1:' || coalesce(doc_id::VARCHAR, '')) x FROM documents),
numbers AS (
  SELECT doc_id, t, n, ('0x' || x[1:8])::BIGINT h1, ('0x' || x[9:16])::BIGINT h2, ('0x' || x[17:24])::BIGINT h3,
         ('0x' || x[25:32])::BIGINT h4 FROM drawn),
cut AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) a, greatest(h1 % (n + 1), h2 % (n + 1)) b,
         CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain'
              WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END form FROM numbers),
pieces AS (SELECT *, substr(t, 1, a) p, substr(t, a + 1, b - a) m, substr(t, b + 1) s FROM cut)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'spm' THEN '<S>' || s || '<P>' || p || '<M>' || m
              ELSE '<P>' || p || '<S>' || s || '<M>' || m END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM pieces""",
}
