"""Cutting lineage, for operators that read an intermediate result several times."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder of the session; where none is set (tests, one machine), one in the warehouse."""
    context = spark.sparkContext
    known = context._jsc.sc().getCheckpointDir()
    if known.isDefined():
        return known.get()
    said = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
    said = said or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_checkpoints"
    context.setCheckpointDir(said)
    return said


def checkpointed(frame: DataFrame) -> DataFrame:
    """``frame``, written to the shared folder and read back, so that lost executors cost no recomputation.

    Files go when the last reference does, where spark.cleaner.referenceTracking.cleanCheckpoints is set.
    """
    checkpoint_dir(frame.sparkSession)
    return frame.checkpoint()


def in_few(frame: DataFrame, rows: int, each: int = 1 << 16) -> DataFrame:
    """``frame`` in no more partitions than ``rows`` rows need: a small table in many tasks is mostly files."""
    return frame.coalesce(max(1, -(-rows // each)))
