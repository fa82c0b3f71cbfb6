"""Positions of rows in the order of their group, for groups of any size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from gridspark.operators.settling import stored


def positioned(df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str, keep: Sequence[str] | None = None,
               facts: DataFrame | None = None) -> DataFrame:
    """Row number from 1 per group, in the order of ``order`` (NULLs first), behind the columns to ``keep`` (all).

    ``facts`` has one row per group, whose columns come behind it; groups without one are left out. They meet the counts
    of the groups, so that no row moves for them.

    Rows are sorted over all partitions, so a group may span several of them. Each partition counts its rows of a
    group; running sums of those counts, one line per partition and group, place the rows of the next.
    """
    by: list[str | Column] = [*keys, *order]
    columns = list(dict.fromkeys([*keys, *(df.columns if keep is None else keep)]))
    placed = stored(df.repartitionByRange(*by).sortWithinPartitions(*by).select(*columns, F.monotonically_increasing_id().alias("_n")))
    placed = placed.withColumn("_part", F.shiftright("_n", 33))
    parts = placed.groupBy(*keys, "_part").agg(F.min("_n").alias("_first"), F.count(F.lit(1)).alias("_here"))
    before = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(*keys, "_part", "_first", F.coalesce(F.sum("_here").over(before), F.lit(0)).alias("_before"))
    position = F.col("_n") - F.col("_first") + F.col("_before") + 1
    extra = [] if facts is None else [c for c in facts.columns if c not in keys]
    if facts is not None:
        parts = parts.join(facts, list(keys))
    # Stored, so that its size is known when the join is planned: where it is small, the rows are not shuffled again.
    return placed.join(stored(parts), [*keys, "_part"]).select(*(df.columns if keep is None else keep), position.alias(name), *extra)
