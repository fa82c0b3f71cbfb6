"""Cutting lineage where a DataFrame is used more than once."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def checkpoint_folder(spark: SparkSession) -> str:
    """Shared folder for checkpoints: the one the cluster names in ``spark.checkpoint.dir``. Where
    that is unset, a folder below the warehouse, or in local mode a temporary one.

    A warehouse on the machines' own disks is no shared folder, so on a cluster it is refused."""
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if spark.sparkContext.master.startswith("local"):
        return tempfile.mkdtemp(prefix="gridspark-")
    warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    default = spark._jvm.org.apache.hadoop.fs.FileSystem.getDefaultUri(spark._jsc.hadoopConfiguration()).toString()
    if warehouse.startswith("file:") or "://" not in warehouse and default.startswith("file:"):
        raise ValueError("Set spark.checkpoint.dir to a folder that all executors share")
    return f"{warehouse}/_checkpoints-{uuid.uuid4().hex}"


# Spark's own settings for an action whose result is written; none changes a row.
_STEP = {
    # What it shuffles goes from the disks when it ends, since nothing else reads these files. Without it the shuffles of
    # all steps of a query lie there together. Read since 4.1; earlier the files stay until the driver collects garbage.
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    # The virtual machine leaves longer methods uncompiled; Spark then cuts them into short ones.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Rows in the order of their groups are not hashed or sorted again.
    "spark.sql.execution.replaceHashWithSortAgg": "true",
}


@contextmanager
def step(spark: SparkSession) -> Iterator[None]:
    """For actions that write a step of a query; the session's settings come back after it."""
    before = {name: spark.conf.get(name, None) for name in _STEP}
    for name, value in _STEP.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def settle(df: DataFrame) -> DataFrame:
    """Compute once and write to the checkpoint folder, where it outlives executors.

    Row numbering and whole-group facts read their input twice; without a cut each level of them
    would double the work below. The partitioning is kept, so what follows does not shuffle again.
    """
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(checkpoint_folder(df.sparkSession))
    with step(df.sparkSession):
        # A plan of its own, so that no other DataFrame looks for its shuffles.
        return df.select("*").checkpoint(eager=True)


def stored(df: DataFrame) -> DataFrame:
    """Compute once, as Parquet in the checkpoint folder: columns that compress, for long tables whose partitioning
    what follows does not use. A partition is one file, whose rows keep their order."""
    folder = f"{checkpoint_folder(df.sparkSession).rstrip('/')}/stored-{uuid.uuid4().hex}"
    with step(df.sparkSession):
        df.select("*").write.parquet(folder, compression="zstd")
    return df.sparkSession.read.schema(df.schema).parquet(folder)
