"""Staged tables and the metrics observed while they are written.

A staged table is written to the shared folder of the session and read again: it cuts
lineage, survives lost executors and keeps a failure inside the part of a run that caused it.
Metrics ride on the same pass (``DataFrame.observe``), so counting never scans a source twice.
"""

from __future__ import annotations

import threading
import uuid
from typing import Mapping

from pyspark.sql import Column, DataFrame, Observation, SparkSession

from skuflow.session import checkpoint_dir


class Watch:
    """Metrics of one frame, delivered by the write that runs it.

    A metric whose frame the planner could leave out altogether (an empty side of a join)
    is not delivered; ``values`` then gives None for it.
    """

    def __init__(self, **metrics: Column):
        self.names = list(metrics)
        self.exprs = [e.alias(n) for n, e in metrics.items()]
        self.observation = Observation(f"watch-{uuid.uuid4().hex}")

    def on(self, df: DataFrame) -> DataFrame:
        return df.observe(self.observation, *self.exprs)

    def values(self, seconds: float = 20) -> dict:
        """The metrics; call it only after the write has ended."""
        got: dict = {}
        waiter = threading.Thread(target=lambda: got.update(self.observation.get), daemon=True)
        waiter.start()
        waiter.join(seconds)
        return {n: got.get(n) for n in self.names}


class Staged:
    """``df`` written once to the shared folder; ``table`` reads it, ``metrics`` were observed on the way."""

    def __init__(self, df: DataFrame, label: str, metrics: Mapping[str, Column] | None = None):
        self.spark = df.sparkSession
        self.path = f"{checkpoint_dir(self.spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
        watch = Watch(**metrics) if metrics else None
        (watch.on(df) if watch else df).write.parquet(self.path)
        self.metrics = watch.values() if watch else {}
        self.table = self.spark.read.schema(df.schema).parquet(self.path)

    def drop(self) -> None:
        delete_path(self.spark, self.path)


def _fs_path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs_path(spark, path)
    return fs.exists(p)


def delete_path(spark: SparkSession, path: str) -> None:
    fs, p = _fs_path(spark, path)
    fs.delete(p, True)
