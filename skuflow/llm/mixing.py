"""Mixing sources to target weights by entropy balancing (operator 5).

The rates that meet every source's token target while staying closest in entropy to one
copy a document tilt exponentially with document size: rate = min(2, exp(lambda * size /
scale)), one multiplier lambda a source. The dual is convex; safeguarded Newton steps solve it
for all sources together, each step one aggregation over counts by (source, size), which
determine a document's rate. Rates become copies cell by cell, from the largest size down,
with the token error carried on. Which documents of a cell get the extra copy goes by the
hash of id and text, bucket by bucket; rows that share both are equal, and where only some of
them get it, any of them may, so their number is met exactly whatever repeats.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from skuflow.llm.common import Staged, bounded_batches, stage

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2.0
#: A (source, size) cell has a hash bucket for about this many rows; only one bucket of it is ranked.
BUCKET_ROWS = 50_000
#: Equal rows that a cell must divide are dealt to this many parts, of which one is ranked.
PARTS = 1024
#: Newton steps after which a source that has not met its target is an error.
STEPS = 200


@F.pandas_udf(LongType())
def n_words(text: pd.Series) -> pd.Series:
    """Number of words ``[^\\x20\\x09-\\x0D]+``; null counts as empty."""
    return pd.Series([len(t.encode("utf-8", "replace").split()) if t else 0 for t in text], dtype="int64")


def targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE) -> DataFrame:
    """(source, sid, source_size, target) from (source, size, n).

    Sources weigh ``weights`` in turn, by code point with null last. A target stops at
    ``MOST`` times the source's size: with sources in order of that cap over weight, the level
    is the first at which the rest shares what the capped ones leave. The table has a row
    a source.
    """
    total = sizes.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    order = Window.orderBy(F.asc_nulls_last("source"))
    weight = F.element_at(F.array(*(F.lit(float(w)) for w in weights)), (F.col("sid") % len(weights) + 1).cast("int"))
    ranked = (total.withColumn("sid", F.row_number().over(order) - 1).withColumn("w", weight)
              .withColumn("cap", MOST * F.col("source_size")))
    by_level = Window.orderBy(F.col("cap") / F.col("w"), "sid")
    before, rest = by_level.rowsBetween(Window.unboundedPreceding, -1), by_level.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy()
    level = ((share * F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
             / F.sum("w").over(rest))
    fits = F.when(F.col("cap") / F.col("w") >= F.col("level"), F.col("level"))
    return (ranked.withColumn("level", level).withColumn("fit", F.min(F.struct(F.when(fits.isNotNull(), F.lit(0)).otherwise(1),
            F.col("cap") / F.col("w"), F.col("sid"), F.col("level").alias("level"))).over(everything))
            .select("source", "sid", "source_size", F.least(F.col("cap"), F.col("w") * F.col("fit.level")).alias("target")))


def _rate(lam: Column, size: Column, scale: Column) -> Column:
    return F.least(F.lit(MOST), F.exp(F.least(lam * size / scale, F.lit(50.0))))


def solve(cells: DataFrame, goals: DataFrame) -> DataFrame:
    """(sid, scale, lam, full) per source: the multipliers that meet the targets.

    ``full`` marks a target at its cap, where every rate is ``MOST``. Newton steps stay
    inside the known bracket and fall back on halving it.
    """
    start = (cells.groupBy("sid").agg((F.sum(F.col("n") * F.col("size") * F.col("size")) / F.sum(F.col("n") * F.col("size")))
                                      .alias("scale"), F.sum(F.col("n") * F.col("size")).alias("mass"))
             .join(goals.select("sid", "target"), "sid"))
    none = F.lit(None).cast("double")
    start = start.select("sid", F.coalesce("scale", F.lit(1.0)).alias("scale"), "target",
                         (F.col("target") >= MOST * F.col("mass") * (1 - 1e-12)).alias("full"),
                         F.lit(0.0).alias("lam"), none.alias("lo"), none.alias("hi"), F.lit(False).alias("done"))
    state = Staged(start, "mix-state")
    for step in range(STEPS + 1):
        left = state.df.where("not full and not done").limit(1).collect()
        if not left:
            break
        if step == STEPS:
            raise RuntimeError(f"entropy balancing has not converged: {left[0]}")
        lam, size = F.col("lam"), F.col("size")
        rate = _rate(lam, size, F.col("scale"))
        slope = F.when(rate < MOST, rate * size / F.col("scale")).otherwise(0.0)
        keys = ["sid", "scale", "target", "full", "lam", "lo", "hi", "done"]
        sums = cells.join(state.df, "sid").groupBy(*keys).agg(
            (F.sum(F.col("n") * size * rate) - F.col("target")).alias("f"),
            F.sum(F.col("n") * size * slope).alias("df"))
        lo, hi = F.when(F.col("f") < 0, lam).otherwise(F.col("lo")), F.when(F.col("f") >= 0, lam).otherwise(F.col("hi"))
        met = F.col("done") | (F.abs("f") <= 1e-9 * F.col("target")) | (F.col("hi") - F.col("lo") <= 1e-12 * F.abs(lam))
        newton = F.when(F.col("df") > 0, lam - F.col("f") / F.col("df"))
        halfway = (F.when(F.col("lo").isNull(), F.col("hi") * 2 - 1).when(F.col("hi").isNull(), F.col("lo") * 2 + 1)
                   .otherwise((F.col("lo") + F.col("hi")) / 2))
        inside = newton.isNotNull() & (newton > F.coalesce("lo", F.col("hi") - 8)) & (newton < F.coalesce("hi", F.col("lo") + 8))
        moved = (sums.withColumn("lo", lo).withColumn("hi", hi).withColumn("done", F.coalesce(met, F.lit(False)))
                 .withColumn("lam", F.when(F.col("done") | F.col("full"), lam).when(inside, newton).otherwise(halfway)))
        following = Staged(moved.select(*keys), "mix-state")
        state.drop()
        state = following
    # rounded, so that the order of summation cannot change a copy
    return state.df.select("sid", "scale", F.round("lam", 9).alias("lam"), "full")


def _round_cells(pdf: pd.DataFrame) -> pd.DataFrame:
    """Extra copies of each cell of a source, largest size first; the token error goes to the next."""
    pdf = pdf.sort_values("size", ascending=False)
    error, extra = 0.0, []
    for size, n, part in zip(pdf["size"], pdf["n"], pdf["part"]):
        exact = n * part
        take = int(min(n, max(0, np.floor(exact + (error / size if size else 0.0) + 0.5)))) if part > 0 or error else 0
        error += size * (exact - take)
        extra.append(take)
    return pdf.assign(extra=extra)[["sid", "size", "n", "whole", "extra"]]


def plan(sized: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE) -> DataFrame:
    """(source, size, source_size, target, whole, buckets, below, edge, rest) from (source, size, h).

    A document of the cell takes ``whole`` copies, and one more if its bucket h % ``buckets`` is
    under ``below``, or is ``below`` and its ``h`` is under ``edge``. Of the rows with ``h`` = ``edge``,
    ``rest`` take one more, or all where ``rest`` is null.
    """
    counts = stage(sized.groupBy("source", "size").agg(F.count("*").alias("n")), "mix-counts")
    goals = stage(targets(counts, weights, share), "mix-goals")
    named = goals.select(F.col("source").alias("_source"), "sid")
    cells = stage(counts.join(named, F.col("source").eqNullSafe(F.col("_source"))).select("sid", "size", "n"), "mix-cells")
    rates = solve(cells, goals)
    rate = F.when(F.col("full"), MOST).otherwise(_rate(F.col("lam"), F.col("size"), F.col("scale")))
    # a whole number stays one although exp() may miss it by a hair
    rated = cells.join(rates, "sid").withColumn("rate", F.round(rate, 9)).select(
        "sid", "size", "n", F.floor("rate").alias("whole"), (F.col("rate") - F.floor("rate")).alias("part"))
    rounded = rated.groupBy("sid").applyInPandas(_round_cells, "sid int, size long, n long, whole long, extra long")
    whole = stage(rounded.withColumn("buckets", F.ceil(F.col("n") / BUCKET_ROWS)).join(goals, "sid"), "mix-whole")
    some = whole.where("extra > 0 and extra < n").select("sid", "size", "extra", "buckets", F.col("source").alias("_source"))
    # buckets are taken whole, in order, until the extra copies run out in one of them
    inside = sized.join(some.withColumnRenamed("size", "_size"),
                        F.col("source").eqNullSafe(F.col("_source")) & (F.col("size") == F.col("_size"))).select(
        "sid", "size", "extra", "h", F.pmod("h", "buckets").alias("bucket"))
    classes = stage(inside.groupBy("sid", "size", "extra", "bucket", "h").agg(F.count("*").alias("m")), "mix-classes")
    spread = classes.groupBy("sid", "size", "extra", "bucket").agg(F.sum("m").alias("m"))
    ends = _where_it_ends(spread, "bucket", "extra").select(
        "sid", "size", F.col("bucket").alias("below"), (F.col("extra") - F.col("before")).alias("left"))
    # and so are the classes of that bucket, by their hash
    last = classes.join(ends, ["sid", "size"]).where("bucket = below and left > 0")
    edges = _where_it_ends(last, "h", "left").select(
        "sid", "size", F.col("h").alias("edge"), (F.col("left") - F.col("before")).alias("rest"))
    out = whole.join(ends.select("sid", "size", "below"), ["sid", "size"], "left").join(edges, ["sid", "size"], "left")
    # no bucket is left over where every document takes the extra copy
    everyone = F.when(F.col("extra") >= F.col("n"), F.col("buckets")).otherwise(F.lit(0))
    return stage(out.select("source", "size", "source_size", "target", "whole", "buckets",
                            F.coalesce("below", everyone).alias("below"), "edge", "rest"), "mix-plan")


def _where_it_ends(rows: DataFrame, order: str, amount: str) -> DataFrame:
    """The row of each cell in which the running sum of ``m`` passes ``amount``, with the sum ``before`` it."""
    by = Window.partitionBy("sid", "size").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    summed = rows.withColumn("before", F.coalesce(F.sum("m").over(by), F.lit(0)))
    return summed.where(F.col("before") <= F.col(amount)).where(F.col("before") + F.col("m") > F.col(amount))


def _hash(id_: Column, text: Column) -> Column:
    return F.xxhash64(id_.cast("string"), text.cast("string"), F.lit("mix"))


def _decide(rows: DataFrame, cells: DataFrame) -> DataFrame:
    """``rows`` (with _src, size, _h) and source_size, target, copies, taken."""
    named = cells.withColumnsRenamed({"source": "_source", "size": "_size", "whole": "_whole", "buckets": "_buckets",
                                      "below": "_below", "edge": "_edge", "rest": "_rest"})
    joined = rows.join(named, F.col("_src").eqNullSafe(F.col("_source")) & (F.col("size") == F.col("_size")))
    bucket = F.pmod("_h", "_buckets")
    more = (bucket < F.col("_below")) | ((bucket == F.col("_below")) & (F.col("_h") < F.col("_edge")))
    tied = F.coalesce((bucket == F.col("_below")) & (F.col("_h") == F.col("_edge")), F.lit(False))
    done = joined.where(~tied).withColumn("_more", F.coalesce(more, F.lit(False)))
    if not cells.where("rest is not null").isEmpty():
        done = done.unionByName(_divided(joined.where(tied)))
    return (done.withColumn("copies", F.col("_whole") + F.col("_more").cast("long"))
            .withColumn("taken", F.col("copies") * F.col("size"))
            .drop("_source", "_size", "_whole", "_buckets", "_below", "_edge", "_rest", "_more"))


def _divided(tied: DataFrame) -> DataFrame:
    """Of the equal rows at each cell's edge, ``_rest`` get ``_more``.

    Rows are numbered as they are staged and dealt to PARTS parts; parts are taken whole until the
    rest runs out in one, and that part alone is ranked.
    """
    held = stage(tied.withColumn("_row", F.monotonically_increasing_id()), "mix-tied")
    part = F.pmod(F.xxhash64("_row"), F.lit(PARTS))
    key = [F.coalesce("_source", F.lit("")).alias("s"), F.col("_source").isNull().alias("z"), F.col("size").alias("n")]
    narrow = held.select(*key, part.alias("part"), "_row", "_rest")
    by = Window.partitionBy("s", "z", "n")
    counts = narrow.groupBy("s", "z", "n", "part", "_rest").agg(F.count("*").alias("m"))
    before = F.coalesce(F.sum("m").over(by.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ends = (counts.withColumn("before", before).where("before <= _rest and before + m > _rest")
            .select("s", "z", "n", F.col("part").alias("last"), (F.col("_rest") - F.col("before")).alias("left")))
    ranked = narrow.join(ends, ["s", "z", "n"]).where("part = last and left > 0")
    nth = F.row_number().over(by.orderBy("_row"))
    rows = ranked.withColumn("nth", nth).where("nth = left").select("s", "z", "n", F.col("_row").alias("top"))
    found = ends.join(rows, ["s", "z", "n"], "left")
    joined = held.join(found, (F.coalesce("_source", F.lit("")) == F.col("s")) & (F.col("_source").isNull() == F.col("z"))
                       & (F.col("size") == F.col("n")), "left")
    # without an end, every equal row gets one more
    more = F.col("last").isNull() | (part < F.col("last")) | ((part == F.col("last")) & (F.col("_row") <= F.col("top")))
    return joined.withColumn("_more", F.coalesce(more, F.lit(False))).drop("s", "z", "n", "last", "left", "top", "_row")


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights: tuple[float, ...] = WEIGHTS, share: float = SHARE) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, copies, taken.

    Null and blank texts have size 0 and take 0 words. A null source is a source of its own.
    Rows that repeat an id, or have none, are decided by id and text; of equal rows as many take
    one more copy as the target needs. An empty table gives an empty result; other columns are ignored.
    """
    bounded_batches(docs.sparkSession)
    sized = stage(docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).cast("string").alias("_src"),
                              n_words(F.col(text_col).cast("string")).alias("size"),
                              _hash(F.col(id_col), F.col(text_col)).alias("_h")), "mix-sized")
    cells = plan(sized.select(F.col("_src").alias("source"), "size", F.col("_h").alias("h")), weights, share)
    return _decide(sized, cells).select("doc_id", F.col("_src").alias("source"), "size", "source_size", "target", "copies", "taken")


def mixed_documents(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE) -> DataFrame:
    """The documents that the mix takes, all columns, with size, source_size, target, copies and taken.

    Columns of these five names are replaced. Rows are decided as in ``mix``.
    """
    bounded_batches(docs.sparkSession)
    rows = docs.drop("size", "source_size", "target", "copies", "taken").withColumns({
        "_src": F.col("source").cast("string"), "size": n_words(F.col("text").cast("string")),
        "_h": _hash(F.col("doc_id"), F.col("text"))})
    sized = stage(rows.select(F.col("_src").alias("source"), "size", F.col("_h").alias("h")), "mix-sized")
    return _decide(rows, plan(sized, weights, share)).where("copies > 0").drop("_src", "_h")
