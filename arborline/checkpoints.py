"""Cutting of long lineages in the folder that driver and executors share."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the cluster's spark.checkpoint.dir; only a local session without one gets a folder of its own."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is not None:
        return
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared is None:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        shared = tempfile.mkdtemp(prefix="arborline-checkpoint-")
    sc.setCheckpointDir(shared)


def checkpointed(df: DataFrame) -> DataFrame:
    """Write df once to the shared checkpoint folder and cut its lineage.

    Besides saving work, this makes sums of floats one value: computed twice, they may differ in the last place.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()
