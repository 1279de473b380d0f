"""Lineage cuts."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the shared folder named by ``spark.checkpoint.dir``.

    A session without that setting gets a temporary folder only in local mode.
    """
    spark = df.sparkSession
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None:
            if not context.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
            folder = tempfile.mkdtemp(prefix="martloom-checkpoint-")
        context.setCheckpointDir(folder)
    return df.checkpoint()
