"""URL filter by link-graph propagation (operator 1).

Rules (host, path, verdict) judge a url by the longest one that fits. Hosts of which more than
half of the pages are allowed or blocked by rules become trusted or blocked seeds. Trust
flows along host edges as personalised PageRank from the trusted seeds; distrust flows against
the edges from the blocked ones, since a host that links to blocked hosts is suspect. A url
without a rule is blocked where its host's distrust is more than ``threshold`` of its trust and
distrust together.

Edges are counted by pair of hosts on the map side, so a host with a third of all pages is
one row per task. Scores are tables, written to the shared folder after every step.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skuflow.llm.common import Staged, stage

#: (host, path, verdict) of the contract.
RULES = (("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
         ("net", "/es/", "block"), ("net", "/fr/", "block"))
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Absolute links: the host after the scheme or a leading double slash.
LINK = r"(?is)\bhref\s*=\s*[\"']?\s*(?:https?:)?//([^/?#\"'\s>]+)"


def host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), _UPPER, _LOWER)


def path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def longest_rule(rules=RULES) -> tuple[Column, Column]:
    """Rule string and verdict for the columns host and path; null where none fits.

    ``rules`` is a short literal list; the longest host and path wins, then the first.
    """
    fits, string, verdict = [], [], []
    for h, p, v in sorted(rules, key=lambda r: -len(r[0] + r[1])):
        fits.append(((F.col("host") == h) | F.col("host").endswith(f".{h}")) & F.col("path").startswith(p))
        string.append(F.when(fits[-1], F.lit(h + p)))
        verdict.append(F.when(fits[-1], F.lit(v)))
    return F.coalesce(*string, F.lit(None)), F.coalesce(*verdict, F.lit(None))


def host_edges(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(src, dst, n): absolute links between different hosts."""
    links = pages.select(host(F.col(url_col)).alias("src"), F.explode_outer(
        F.regexp_extract_all(F.coalesce(F.col(html_col), F.lit("")), F.lit(LINK), F.lit(1))).alias("dst"))
    links = links.withColumn("dst", F.translate("dst", _UPPER, _LOWER))
    return links.where("src <> '' and dst <> '' and src <> dst").groupBy("src", "dst").agg(F.count("*").alias("n"))


def propagate(edges: DataFrame, seeds: DataFrame, damping: float = 0.85, tolerance: float = 1e-6) -> DataFrame:
    """(host, trust, distrust) from (src, dst, n) and (host, trusted, blocked) seed weights.

    Both are personalised PageRanks of total 1; what a host without further edges holds goes back
    to the seeds. Without seeds of a kind its scores are 0. Steps go on until they change less than
    ``tolerance`` in total and reach no further host; each shrinks the change by ``damping``, so they end.
    """
    both = edges.select(F.lit("trust").alias("kind"), "src", "dst", "n").union(
        edges.select(F.lit("distrust"), F.col("dst"), F.col("src"), F.col("n")))
    out = both.groupBy("kind", "src").agg(F.sum("n").alias("out"))
    graph = stage(both.join(out, ["kind", "src"]).select("kind", "src", "dst", (F.col("n") / F.col("out")).alias("p")), "url-graph")
    marked = seeds.select(F.explode(F.array(
        F.struct(F.lit("trust").alias("kind"), "host", F.col("trusted").cast("double").alias("w")),
        F.struct(F.lit("distrust").alias("kind"), "host", F.col("blocked").cast("double").alias("w")))).alias("x")).select("x.*")
    marked = marked.where("w > 0")
    total = marked.groupBy("kind").agg(F.sum("w").alias("all"))
    first = marked.join(total, "kind").select("kind", "host", (F.col("w") / F.col("all")).alias("seed"))
    seeded = stage(first, "url-seeds")
    state = Staged(seeded.withColumn("score", F.col("seed")), "url-scores")
    while True:
        moved = (state.df.join(graph, (state.df["kind"] == graph["kind"]) & (state.df["host"] == graph["src"]))
                 .groupBy(graph["kind"], F.col("dst").alias("host")).agg((damping * F.sum(F.col("score") * F.col("p"))).alias("got")))
        kept = moved.groupBy("kind").agg(F.sum("got").alias("sum"))
        back = seeded.join(kept, "kind", "left").select(
            "kind", "host", "seed", (F.col("seed") * (1 - F.coalesce("sum", F.lit(0.0)))).alias("got"))
        new = (moved.select("kind", "host", F.lit(0.0).alias("seed"), "got").unionByName(back)
               .groupBy("kind", "host").agg(F.sum("seed").alias("seed"), F.sum("got").alias("score")))
        following = Staged(new, "url-scores")
        old = state.df.select("kind", "host", F.col("score").alias("was"))
        change, reached = following.df.join(old, ["kind", "host"], "full").agg(
            F.sum(F.abs(F.coalesce("score", F.lit(0.0)) - F.coalesce("was", F.lit(0.0)))),
            F.count(F.when(F.col("was").isNull(), 1))).first()
        state.drop()
        state = following
        if change is None or (change < tolerance and not reached):
            break
    score = lambda kind: F.sum(F.when(F.col("kind") == kind, F.col("score")).otherwise(0.0)).alias(kind)
    return state.df.groupBy("host").agg(score("trust"), score("distrust"))


def judge(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", rules=RULES,
          threshold: float = 0.5, damping: float = 0.85) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict, trust, distrust.

    A null url or one without ``://`` has an empty host and path, which no rule or edge reaches,
    and is allowed, as is a host with neither trust nor distrust. Null html has no links.
    Repeated rows stay; an empty table gives an empty result.
    """
    rule, verdict = longest_rule(rules)
    rows = pages.select(F.col(id_col).alias("page_id"), host(F.col(url_col)).alias("host"), path(F.col(url_col)).alias("path"))
    rows = rows.withColumn("rule", rule).withColumn("by_rule", verdict)
    hosts = rows.where("host <> ''").groupBy("host").agg(
        F.count("*").alias("n"), F.count_if(F.col("by_rule") == "allow").alias("allowed"),
        F.count_if(F.col("by_rule") == "block").alias("blocked"))
    seeds = hosts.select("host", *(F.when(2 * F.col(c) > F.col("n"), F.col(c)).otherwise(0).alias(to)
                                   for c, to in (("allowed", "trusted"), ("blocked", "blocked"))))
    scores = propagate(host_edges(pages, url_col, html_col), stage(seeds, "url-hosts"), damping)
    scores = stage(scores, "url-verdicts").withColumnRenamed("host", "_host")
    bad = F.col("distrust") > threshold * (F.col("trust") + F.col("distrust"))
    return rows.join(scores, F.col("host") == F.col("_host"), "left").select(
        "page_id", "host", "path", "rule",
        F.coalesce("by_rule", F.when(bad, "block"), F.lit("allow")).alias("verdict"), "trust", "distrust")
