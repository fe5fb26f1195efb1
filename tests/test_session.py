"""Checkpoint folder: the session's setting wins; a scratch folder only when unset."""

import os

from skuflow.session import checkpoint_dir


def test_checkpoint_dir_uses_session_setting(spark):
    d = checkpoint_dir(spark)
    assert d and spark.sparkContext.getCheckpointDir() is not None
    assert checkpoint_dir(spark) == d or os.path.basename(d) in spark.sparkContext.getCheckpointDir()


def test_reliable_checkpoint_cuts_lineage(spark):
    checkpoint_dir(spark)
    df = spark.range(100).selectExpr("id % 7 AS k").groupBy("k").count().checkpoint(eager=True)
    assert "Exchange" not in df._jdf.queryExecution().executedPlan().toString()
    assert df.count() == 7
