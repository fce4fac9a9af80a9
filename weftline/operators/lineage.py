"""Cutting the lineage of loops."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame


def cut(df: DataFrame) -> DataFrame:
    """The same rows, written to the shared folder of spark.checkpoint.dir. Where that is unset, a local folder will do on a local master, as in tests; a cluster must set it."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        shared = df.sparkSession.conf.get("spark.checkpoint.dir", None)
        if not shared and not context.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        context.setCheckpointDir(shared or tempfile.mkdtemp(prefix="weftline-"))
    return df.checkpoint()
