"""Sessions with the settings the operators rely on."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def session(name: str = "pitlake", **settings: str) -> SparkSession:
    """A session in UTC with adaptive plans; ``settings`` use two underscores for a dot."""
    builder = SparkSession.builder.appName(name)
    for key, value in (SETTINGS | {k.replace("__", "."): v for k, v in settings.items()}).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def cut(df: DataFrame) -> DataFrame:
    """``df`` computed and written to the checkpoint folder, so loops don't repeat what led to it.

    The folder is the session's ``spark.checkpoint.dir``; where none is set, a temporary one serves on a
    local master and anything else is an error.
    """
    context = df.sparkSession.sparkContext
    if not context.getCheckpointDir():
        folder = df.sparkSession.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
        if not folder:
            if not context.master.startswith("local[") and context.master != "local":
                raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
            folder = tempfile.mkdtemp(prefix="pitlake-")
        context.setCheckpointDir(folder)
    return df.checkpoint()


def spread(df: DataFrame) -> DataFrame:
    """``df`` in two partitions a core at least, for work that costs far more than moving its rows: a small file, or one row group, is one task else."""
    parts = 2 * df.sparkSession.sparkContext.defaultParallelism
    return df if df.isStreaming or df.rdd.getNumPartitions() >= parts else df.repartition(parts)
