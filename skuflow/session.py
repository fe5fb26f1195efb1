"""Session helpers.

Production code receives a session from the cluster; ``get_session`` exists for
tests, tools and the bench. Cluster-level knobs (AQE, skew join, partition sizing)
are set here so that a local run plans the same way a cluster run would.
"""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Reports are tiny compared with the facts; let AQE turn a shuffled join
    # into a broadcast one only when the measured (not estimated) side is small.
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64MB",
    # post-shuffle partitions are coalesced/split toward this size by AQE
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128MB",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "skuflow", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for lineage cuts and staged tables.

    Reads ``spark.checkpoint.dir`` from the session. Only on a local master without that
    setting (tests) a scratch folder is created and registered; a cluster must name one.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if not configured:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="skuflow-ckpt-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(configured)
    return configured
