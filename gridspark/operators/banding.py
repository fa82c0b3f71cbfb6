"""Ordered and whole-group operators that survive a sheet holding a third of all rows.

A window partitioned by sheet puts a whole sheet into one task. Here a group is cut into bands
of ``BAND_ROWS`` consecutive rows. Work per row stays inside ``(group, band)``; only one summary
row per band is looked at per group, and its result comes back by a join on ``(group, band)``.
Cells are shuffled on ``(sheet, band)`` once; what follows reuses that partitioning.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

BAND_BITS = 10
BAND_ROWS = 1 << BAND_BITS

Aggregate = Callable[[str], Column]


def band(row: str | Column) -> Column:
    """Number of the band of a row number."""
    return F.shiftright(F.col(row) if isinstance(row, str) else row, BAND_BITS)


def with_bands(df: DataFrame, first_row: Column, last_row: Column) -> DataFrame:
    """One copy of each row per band of ``first_row..last_row``, for a join on group and band."""
    return df.withColumn("band", F.explode(F.sequence(band(first_row), band(last_row))))


def attach(df: DataFrame, keys: Sequence[str],
           facts: Mapping[str, tuple[Column, Aggregate]]) -> DataFrame:
    """Add aggregates of the whole group to each row; ``df`` has a ``band`` column.

    Each fact is (aggregate within a band, aggregate that combines the bands).
    """
    parts = df.groupBy(*keys, "band").agg(*[agg.alias(name) for name, (agg, _) in facts.items()])
    whole = Window.partitionBy(*keys)
    summary = parts.select(
        *keys, "band", *[combine(name).over(whole).alias(name) for name, (_, combine) in facts.items()]
    )
    return df.join(summary, [*keys, "band"])


def meet(rows: DataFrame, facts: DataFrame, keys: Sequence[str], order: str = "row", how: str = "inner") -> DataFrame:
    """Join one row per group to the rows of the group, spread by row band; ``how`` is ``inner``
    or ``left_anti``.

    The groups meet their bands first, one line per band, and the rows meet those.
    """
    placed = rows.withColumn("_band", band(order))
    spots = placed.select(*keys, "_band").distinct().join(facts, list(keys), how)
    return placed.join(spots, [*keys, "_band"]).drop("_band")


SALTS = 32


def look_up(rows: DataFrame, rules: DataFrame, key: str, spread: Sequence[str], how: str = "left") -> DataFrame:
    """Join rules, some per key, to rows of which a key may hold very many: rules stand once per salt, and a row takes
    the salt of its ``spread`` columns, so no exchange is on the key alone."""
    salted = rules.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    placed = rows.withColumn("_salt", F.pmod(F.xxhash64(*spread), F.lit(SALTS)).cast("int"))
    return placed.join(salted, [key, "_salt"], how).drop("_salt")


def running(df: DataFrame, keys: Sequence[str], order: str | Sequence[str], *,
            latest: Mapping[str, Column] | None = None,
            counted: Mapping[str, Column] | None = None) -> DataFrame:
    """Running state in row order; ``df`` has a ``band`` column that does not decrease with ``order``.

    ``latest[name]`` is a value, NULL where there is none: adds the last one at or before the row.
    ``counted[name]`` is a condition: adds how many rows up to and including this one meet it.
    """
    latest, counted = latest or {}, counted or {}
    order = [order] if isinstance(order, str) else list(order)
    position = F.struct(*order)
    marked = df.select(
        "*",
        *[F.when(v.isNotNull(), F.struct(position.alias("at"), v.alias("value"))).alias(f"_m_{n}")
          for n, v in latest.items()],
        *[F.coalesce(c.cast("bigint"), F.lit(0)).alias(f"_m_{n}") for n, c in counted.items()],
    )
    inside = Window.partitionBy(*keys, "band").orderBy(*order).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    before = Window.partitionBy(*keys).orderBy("band").rowsBetween(Window.unboundedPreceding, -1)

    parts = marked.groupBy(*keys, "band").agg(
        *[F.max_by(f"_m_{n}", f"_m_{n}.at").alias(f"_p_{n}") for n in latest],
        *[F.sum(f"_m_{n}").alias(f"_p_{n}") for n in counted],
    )
    carried = parts.select(
        *keys, "band",
        *[F.last(f"_p_{n}", ignorenulls=True).over(before).alias(f"_c_{n}") for n in latest],
        *[F.sum(f"_p_{n}").over(before).alias(f"_c_{n}") for n in counted],
    )
    joined = marked.select(
        "*",
        *[F.last(f"_m_{n}", ignorenulls=True).over(inside).alias(f"_i_{n}") for n in latest],
        *[F.sum(f"_m_{n}").over(inside).alias(f"_i_{n}") for n in counted],
    ).join(carried, [*keys, "band"])
    return joined.select(
        *[F.col(c) for c in df.columns],
        *[F.coalesce(f"_i_{n}", f"_c_{n}")["value"].alias(n) for n in latest],
        *[(F.col(f"_i_{n}") + F.coalesce(f"_c_{n}", F.lit(0))).alias(n) for n in counted],
    )


def numbered(df: DataFrame, keys: Sequence[str], order: str | Sequence[str], name: str) -> DataFrame:
    """Row number from 1 per group."""
    return running(df, keys, order, counted={name: F.lit(1)})


def contiguous_prefix(df: DataFrame, keys: Sequence[str], row: str, start: Column,
                      stop: Column | None = None) -> DataFrame:
    """Rows of a group from ``start`` on without a gap, up to the first row where ``stop`` holds.

    ``df`` holds one row per present row number, none before ``start``; the ``stop`` row is kept.
    """
    counted = {"_seen": F.lit(1)}
    if stop is not None:
        counted["_stops"] = stop
    run = running(df, keys, row, counted=counted)
    keep = F.col(row) - F.col("_seen") == start - 1
    if stop is not None:
        keep = keep & (F.col("_stops") - F.coalesce(stop.cast("int"), F.lit(0)) == 0)
    return run.filter(keep).select(*df.columns)
