"""Small shared parts: reading tables, run folders, plain text folding, joins that stand hot keys."""

from __future__ import annotations

import string
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridspark.operators.settling import checkpoint_folder

#: A key with at least this share of all rows is hot; there are at most ``1 / HOT_SHARE`` of them.
HOT_SHARE = 1 / 1000


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """One of the sample tables."""
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


class Run:
    """A folder of its own in the shared checkpoint folder, for the tables that one call writes.

    The files are plain Parquet: a lost executor costs its running tasks, never a stage that is done.
    The folder stays when the call ends, since the returned DataFrame still reads it; who owns the
    checkpoint folder clears it.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.folder = f"{checkpoint_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"

    def write(self, df: DataFrame, name: str) -> DataFrame:
        """Compute ``df`` once and read it back from the run folder."""
        df.write.parquet(f"{self.folder}/{name}")
        return self.spark.read.schema(df.schema).parquet(f"{self.folder}/{name}")


def plain_lower(text: Column) -> Column:
    """Lower-case A-Z and nothing else. Texts of single bytes take the faster built-in way."""
    return F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(
        F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    )


def join_hot(rows: DataFrame, facts: DataFrame, key: str, size: str, total: int) -> DataFrame:
    """Inner join of many ``rows`` to one row of ``facts`` per key, where few keys may hold most rows.

    ``facts[size]`` is the number of rows with the key and ``total`` the number of all rows, so at
    most ``1 / HOT_SHARE`` facts are hot: those are broadcast and their rows are not shuffled. No
    other key is large, so the rest is an ordinary shuffle join. Both inputs are read twice.
    """
    hot = F.broadcast(facts.where(F.col(size) >= max(2.0, total * HOT_SHARE)))
    return rows.join(hot, key).unionByName(rows.join(hot.select(key), key, "left_anti").join(facts, key))


def remainder(doc_id: Column, divisor: int) -> Column:
    """CRC-32 of the id as text, modulo ``divisor``: the folds of the labelled rows."""
    return F.crc32(doc_id.cast("string").cast("binary")) % divisor


class Adam:
    """The usual adaptive gradient steps over a dict of numpy arrays."""

    def __init__(self, weights: dict, rate: float):
        self.weights, self.rate, self.t = weights, rate, 0
        self.m = {k: 0 * w for k, w in weights.items()}
        self.v = {k: 0 * w for k, w in weights.items()}

    def step(self, gradients: dict) -> None:
        self.t += 1
        for k, g in gradients.items():
            self.m[k] += 0.1 * (g - self.m[k])
            self.v[k] += 0.001 * (g * g - self.v[k])
            scale = self.rate * (1 - 0.999**self.t) ** 0.5 / (1 - 0.9**self.t)
            self.weights[k] -= scale * self.m[k] / (self.v[k] ** 0.5 + 1e-8)
