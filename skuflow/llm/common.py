"""Helpers shared by the operators: staged tables and connected components.

Words are the maximal runs of ``[^\\x20\\x09-\\x0D]``. ``bytes.split`` cuts at exactly
these six characters and ``bytes.lower`` maps A-Z alone, so Python tasks work on UTF-8
bytes.
"""

from __future__ import annotations

import gc
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; a scratch folder only on a local master."""
    sc = spark.sparkContext
    configured = (spark.conf.get("spark.checkpoint.dir", None)
                  or sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir())
    if not configured:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="llm-stage-")
        sc.setCheckpointDir(configured)
    return configured


class Staged:
    """A table written to the shared folder: cuts lineage, survives lost executors.

    Spark reads its size from the files, so joins with it become broadcasts only
    below the session's own threshold.
    """

    def __init__(self, df: DataFrame, label: str):
        self.spark = df.sparkSession
        self.path = f"{shared_dir(self.spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
        df.write.parquet(self.path)
        self.df = self.spark.read.schema(df.schema).parquet(self.path)

    def drop(self) -> None:
        """Delete the files of a table that a later one has replaced."""
        jvm = self.spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(self.path)
        path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def stage(df: DataFrame, label: str) -> DataFrame:
    return Staged(df, label).df


def bounded_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Send at most ``rows`` documents to a Python task at once: texts are long rows."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= rows:
        spark.conf.set(key, str(rows))


#: Bytes of text that a batch may hold before it is cut up.
GROUP_BYTES = 1 << 26


def bounded_groups(rows: DataFrame) -> DataFrame:
    """``rows`` (batch, doc_id, text, ...) with batches of about GROUP_BYTES at most, and ``copies``.

    Equal rows become one with their number in ``copies``. A batch of more bytes is dealt by the
    hash of id and text, under new numbers of 61 bits. The list of such batches has at most
    one entry for GROUP_BYTES of the corpus, so it is broadcast. One text is never cut.
    """
    twice = rows.groupBy("doc_id", F.xxhash64("text").alias("h")).agg(F.count("*").alias("n")).where("n > 1")
    if twice.isEmpty():
        one = rows.withColumn("copies", F.lit(1).cast("long"))
    else:
        one = stage(rows.groupBy(*rows.columns).agg(F.count("*").alias("copies")), "batch-rows")
    size = F.sum(F.coalesce(F.octet_length("text"), F.lit(0)) + 64)
    heavy = one.groupBy(F.col("batch").alias("_batch")).agg(size.alias("_bytes")).where(F.col("_bytes") > GROUP_BYTES)
    heavy = stage(heavy.select("_batch", F.ceil(F.col("_bytes") / GROUP_BYTES).alias("_pieces")), "batch-heavy")
    dealt = one.join(F.broadcast(heavy), F.col("batch") == F.col("_batch"), "left")
    piece = F.pmod(F.xxhash64("doc_id", "text"), F.col("_pieces"))
    own = F.when(F.col("_pieces").isNull(), F.col("batch")).otherwise(F.pmod(F.xxhash64("batch", piece), F.lit(1 << 61)))
    return dealt.withColumn("batch", own).drop("_batch", "_pieces")


def repeated(rows: DataFrame) -> DataFrame:
    """Each row ``copies`` times, without that column."""
    names = [c for c in rows.columns if c != "copies"]
    return rows.select(*names, F.explode(F.sequence(F.lit(1).cast("long"), "copies")).alias("_copy")).select(*names)


def release(spark: SparkSession) -> None:
    """Let Spark's cleaner delete the shuffle files of finished stages, which waits for the driver's JVM."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def connected_components(edges: DataFrame, label: str = "cc") -> DataFrame:
    """(node, root) for every node of the long pairs (u, v); root is the smallest node reached.

    Alternating large-star and small-star steps: each step links nodes to the smallest
    known neighbour, and the edge set never grows. Every step is written to the shared
    folder, and the loop ends when a step changes nothing. Self links give (u, u); an
    empty input gives an empty result.
    """
    clean = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    state = Staged(clean, label)
    seen = None
    while True:
        now = state.df.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if seen == now:
            break
        seen = now
        nxt = Staged(_star_step(state.df), label)
        state.drop()
        state = nxt
    stars = state.df
    return (stars.select(F.col("u").alias("node"), F.col("v").alias("root"))
            .union(stars.select("v", "v")).groupBy("node").agg(F.min("root").alias("root")))


def _star_step(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").union(edges.select("v", "u"))
    lowest = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    large = (both.join(lowest, "u").where("v > u")
             .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
    below = large.groupBy("u").agg(F.min("v").alias("m"))
    small = (large.join(below, "u").where("v <> m")
             .select(F.col("v").alias("u"), F.col("m").alias("v"))
             .union(below.select("u", F.col("m").alias("v"))))
    loops = edges.where("u = v").select("u", "v")
    return small.union(loops).distinct()
