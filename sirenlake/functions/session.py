"""Session helpers: shared scratch space and lineage cuts that survive lost executors."""

from __future__ import annotations

import math
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder, shared by all executors, that ``spark.checkpoint.dir`` or ``setCheckpointDir`` names."""
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not named:
        raise ValueError("name a folder that all executors share in spark.checkpoint.dir")
    return named


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder; nothing is ever overwritten."""
    return f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """The same rows from a table written to the shared folder, so lost executors cost nothing.

    A table also gives the optimiser true sizes. A checkpoint keeps the estimates of the plan it
    replaces, which grow with every round of an iterative job until planning dominates.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "stage")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def spread(df: DataFrame, rows: int) -> DataFrame:
    """The same rows dealt evenly to tasks of about ``rows`` rows each.

    Scans of written tables follow the files and their row groups, so some tasks get most rows and others none.
    """
    return df.repartition(max(1, math.ceil(df.count() / rows)))
