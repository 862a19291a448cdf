"""Cuts of lineage in the folder that driver and executors share."""

from __future__ import annotations

import re
import tempfile

from pyspark.sql import DataFrame, SparkSession


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder the session names; one of our own only on a local master, where none is named."""
    sc = spark.sparkContext
    named = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if not named:
        if not re.fullmatch(r"local(\[[^\[\]]*\])?", sc.master):
            raise RuntimeError("name a folder that driver and executors share in spark.checkpoint.dir")
        named = tempfile.mkdtemp(prefix="tidemark-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(named)
    return named


def cut(df: DataFrame) -> DataFrame:
    """Cuts lineage through the shared checkpoint folder: a lost executor does not lose it."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
