"""From cells to records: binding layouts, row records, headers, table rows, unpivot."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from gridspark.functions.numeric import parsed_cell
from gridspark.functions.text import canonical_text, clean_text, header_name
from gridspark.model import SHEET, not_empty
from gridspark.operators.banding import (
    attach, band, contiguous_prefix, numbered, running, with_bands,
)
from gridspark.operators.settling import settle, stored

ROW = [*SHEET, "band", "row"]


# --- cells and layouts -------------------------------------------------------------------------

def banded(cells: DataFrame) -> DataFrame:
    return cells.withColumn("band", band("row"))


def with_layout(df: DataFrame, layout: DataFrame) -> DataFrame:
    """Join per-sheet layout columns to cells or row records on (sheet, band), so that a huge
    sheet is spread over tasks. ``layout`` has one row per sheet and a ``last_row``."""
    return df.join(with_bands(layout, F.lit(1).cast("bigint"), F.col("last_row")), [*SHEET, "band"])


def sheet_rows(cells: DataFrame, layout: DataFrame, wanted: Column | None = None,
               head_rows: Column | None = None) -> DataFrame:
    """One record per non-empty row: (workbook, sheet, band, row, cells MAP<col, cell>), stored.

    ``wanted`` prunes cells by layout columns before they are grouped. Cells are shuffled here,
    once, on (sheet, band). The rows of ``head_rows`` are wanted too, and a record tells in ``is_head``
    whether it is one of them, so that :func:`head` moves no other.
    """
    # Names of workbooks and sheets begin alike: a number in front of them is what the sorts compare.
    spot = F.xxhash64(*SHEET, "band")
    filled = banded(cells.filter(not_empty(F.col("raw")))).withColumn("_spot", spot)
    # Once per sheet, not for each of its cells.
    placed = layout if head_rows is None else layout.withColumn("_heads", head_rows)
    places = with_bands(placed, F.lit(1).cast("bigint"), F.col("last_row")).withColumn("_spot", spot)
    bound = filled.join(places, ["_spot", *SHEET, "band"])
    marks = [] if head_rows is None else ["is_head"]
    if marks:
        bound = bound.withColumn("is_head", F.array_contains("_heads", F.col("row")))
        wanted = None if wanted is None else wanted | F.col("is_head")
    if wanted is not None:
        bound = bound.filter(wanted)
    line = ["_spot", *ROW, *marks]
    # Sorted by line, cells are gathered as they come; a hashed gathering would soon fall back to sorting them as well.
    # They are parsed before it, in compiled code.
    parsed = bound.select(*line, "col", "raw", "kind", "ts", "number_format").sortWithinPartitions(*line).select(
        *line, F.struct("col", parsed_cell()).alias("_cell"))
    return stored(parsed.groupBy(*line).agg(F.map_from_entries(F.collect_list("_cell")).alias("cells")).drop("_spot"))


def pivot_cells(cells: DataFrame, columns: Mapping[str, int] | None = None) -> DataFrame:
    """Cells to one record per row: a map by column number, or named columns."""
    rows = cells.groupBy(*ROW).agg(
        F.map_from_entries(F.collect_list(F.struct("col", parsed_cell()))).alias("cells"))
    if columns is None:
        return rows
    return rows.select(*ROW, *[at(F.col("cells"), F.lit(i))["raw"].alias(n) for n, i in columns.items()])


def at(cells: Column, col: Column) -> Column:
    """Cell of a row record, NULL when empty."""
    return F.element_at(cells, col.cast("int"))


def head(rows: DataFrame, layout: DataFrame, head_rows: Column) -> DataFrame:
    """``layout`` with ``head`` MAP<row, MAP<col, cell>>: the configured rows of each sheet.

    Title and header rows are named by configuration, so that the map of a sheet is bounded.
    """
    picked = (
        with_layout(rows.filter("is_head") if "is_head" in rows.columns else rows,
                    layout.select(*SHEET, "last_row", head_rows.alias("head_rows")))
        .filter(F.array_contains("head_rows", F.col("row")))
        .groupBy(*SHEET)
        .agg(F.map_from_entries(F.collect_list(F.struct("row", "cells"))).alias("head"))
    )
    return layout.join(picked, SHEET, "left")


def head_at(row: Column, col: Column) -> Column:
    """Cell of a ``head`` map."""
    return F.element_at(F.element_at(F.col("head"), row.cast("bigint")), col.cast("int"))


def area_cells(area: Column) -> Column:
    """Cells of a rectangle of ``head`` in reading order: ARRAY<STRUCT<row, col, cell>>."""
    per_row = F.transform(
        F.map_entries(F.map_filter(
            F.col("head"), lambda r, _: r.between(area["first_row"], area["last_row"]))),
        lambda e: F.transform(
            F.map_entries(F.map_filter(
                e["value"], lambda c, _: c.between(area["first_column"], area["last_column"]))),
            lambda c: F.struct(e["key"].alias("row"), c["key"].alias("col"), c["value"].alias("cell")),
        ),
    )
    return F.array_sort(F.flatten(per_row))


# --- headers and table rows --------------------------------------------------------------------

def header_row(cells: DataFrame) -> DataFrame:
    """First row of each sheet with a cell that is not blank."""
    return (
        cells.filter(clean_text(F.col("raw")) != "")
        .groupBy(*SHEET)
        .agg(F.min("row").alias("header_row"))
    )


def header_cells(cells: Column) -> Column:
    """Cells of a header record from column A up to the first empty one."""
    ordered = F.array_sort(F.map_entries(cells))
    return F.filter(ordered, lambda c, i: c["key"] == i + 1)


def header_columns(cells: DataFrame, headers: DataFrame) -> DataFrame:
    """(workbook, sheet, col, name) of the contiguous header from column A.

    A header is one row, so the records that are unfolded here are small.
    """
    first = (
        cells.filter(not_empty(F.col("raw")))
        .join(headers.withColumnRenamed("header_row", "row"), [*SHEET, "row"])
        .groupBy(*SHEET)
        .agg(F.map_from_entries(F.collect_list(F.struct("col", parsed_cell()))).alias("cells"))
    )
    return first.select(*SHEET, F.explode(header_cells(F.col("cells"))).alias("c")).select(
        *SHEET, F.col("c.key").alias("col"), header_name(F.col("c.value.raw")).alias("name"))


def table_rows(rows: DataFrame, keys: Sequence[str], start: Column, stop_on_empty: bool = True) -> DataFrame:
    """Rows of a table from ``start``: up to the first empty row, or all that are not empty."""
    below = rows.filter(F.col("row") >= start)
    return contiguous_prefix(below, keys, "row", start) if stop_on_empty else below


def until_total(rows: DataFrame, keys: Sequence[str], is_total: Column, inclusive: bool) -> DataFrame:
    """Rows of each group up to its first total row."""
    last = attach(rows, keys, {"_total": (F.min(F.when(is_total, F.col("row"))), F.min)})
    row, total = F.col("row"), F.col("_total")
    keep = total.isNull() | ((row <= total) if inclusive else (row < total))
    return last.filter(keep).select(*rows.columns)


# --- context -----------------------------------------------------------------------------------

def carry_forward(df: DataFrame, keys: Sequence[str], levels: Mapping[str, Column],
                  resets: Mapping[str, Sequence[str]], row: str = "row") -> DataFrame:
    """Hierarchical headings carried down: each level is the last marker at or above the row.

    ``resets[level]`` names the levels whose later marker clears it. Every level is carried with
    its row number, so that a reset is a comparison of positions and all levels share one pass.
    """
    carried = running(
        df, keys, row,
        latest={f"_l_{n}": F.when(m.isNotNull(), F.struct(F.col(row).alias("at"), m.alias("value")))
                for n, m in levels.items()},
    )
    position = lambda n: F.coalesce(F.col(f"_l_{n}")["at"], F.lit(-1))
    values = []
    for name in levels:
        alive = F.lit(True)
        for other in resets.get(name, ()):
            alive = alive & (position(other) < position(name))
        values.append(F.when(alive, F.col(f"_l_{name}")["value"]).alias(name))
    return carried.select(*df.columns, *values)


def ordinals(df: DataFrame, keys: Sequence[str], group: str, row: str = "row",
             group_order: str = "ordre_section", line_order: str = "ordre_ligne") -> DataFrame:
    """Order of first appearance of ``group`` within ``keys``, and line number within the group."""
    # One summary row per (group, band): its join key spreads a group that fills a whole sheet.
    parts = settle(df.groupBy(*keys, group, "band").agg(F.min(row).alias("_first"), F.count("*").alias("_n")))
    starts = parts.groupBy(*keys, group).agg(F.min("_first").alias("_first"))
    ranks = numbered(starts.withColumn("band", band("_first")), keys, "_first", group_order)
    before = Window.partitionBy(*keys, group).orderBy("band").rowsBetween(Window.unboundedPreceding, -1)
    placed = parts.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).join(
        ranks.select(*keys, group, group_order), [*keys, group])
    inside = F.row_number().over(Window.partitionBy(*keys, group, "band").orderBy(row))
    return (
        df.withColumn("_inside", inside)
        .join(placed.select(*keys, group, "band", "_before", group_order), [*keys, group, "band"])
        .select(*df.columns, group_order, (F.col("_inside") + F.col("_before")).alias(line_order))
    )


def unpivot_measures(rows: DataFrame, measures: Column, keep: Sequence[str]) -> DataFrame:
    """One output row per (record, measure): ``measures`` is ARRAY<STRUCT<col, …>>.

    Adds the measure's struct as ``measure`` and its cell as ``cell``; empty cells are kept.
    """
    long = rows.select(*keep, "cells", F.explode(measures).alias("measure"))
    return long.select(*keep, "measure", at(F.col("cells"), F.col("measure.col")).alias("cell"))


# --- merged headers ----------------------------------------------------------------------------

def merged_headers(cells: DataFrame, merged: DataFrame, rows: DataFrame) -> DataFrame:
    """(workbook, sheet, row, label, col): the label of each merge on a header row, per column.

    ``rows`` gives (workbook, sheet, row, first_column, last_column); merges over several rows,
    beyond the column limits or without a label are left out.
    """
    spans = (
        merged.filter(F.col("min_row") == F.col("max_row"))
        .withColumnRenamed("min_row", "row")
        .join(rows, [*SHEET, "row"])
        .filter((F.col("min_col") >= F.col("first_column")) & (F.col("max_col") <= F.col("last_column")))
    )
    filled = cells.filter(not_empty(F.col("raw"))).select(*SHEET, "row", F.col("col").alias("min_col"), "raw")
    # Merges are few beside cells: their places are hashed, so no cell is sorted, and only cells met are cleaned.
    return (
        filled.join(spans.hint("shuffle_hash"), [*SHEET, "row", "min_col"])
        .withColumn("label", clean_text(F.col("raw"))).filter(F.col("label") != "")
        .select(*SHEET, "row", "label", F.explode(F.sequence("min_col", "max_col")).alias("col"))
    )


# --- market rows -------------------------------------------------------------------------------

def propagate_market(df: DataFrame, keys: Sequence[str], is_market: Column,
                     values: Sequence[str], row: str = "row", prefix: str = "marche_") -> DataFrame:
    """Copy the last market row of each group onto its other rows.

    Adds ``<prefix><value>`` per value and ``has_market``; market rows themselves are dropped.
    """
    # Market rows are few: they alone are aggregated, and meet the bands of their group before the rows do.
    market = df.filter(is_market).groupBy(*keys).agg(F.max_by(F.struct(*values), row).alias("_last"))
    others = df.filter(~F.coalesce(is_market, F.lit(False)))
    known = others.join(others.select(*keys, "band").distinct().join(market, list(keys), "left"), [*keys, "band"])
    return known.select(
        *df.columns,
        *[F.col("_last")[v].alias(f"{prefix}{v}") for v in values],
        F.col("_last").isNotNull().alias("has_market"),
    )


def check_headers(actual: Column, expected: Sequence[str]) -> Column:
    """Header texts equal the expected ones, in canonical form and in order."""
    wanted = F.array(*[F.lit(e) for e in expected])
    return F.transform(actual, canonical_text) == wanted


# --- periods -----------------------------------------------------------------------------------

def align_periods(periods: Column) -> Column:
    """ARRAY<DATE> of all tables of a sheet to STRUCT<current, previous>, NULL unless there are
    exactly two distinct dates."""
    distinct = F.array_distinct(periods)
    return F.when(
        (F.size(distinct) == 2) & ~F.exists(distinct, lambda d: d.isNull()),
        F.struct(F.array_max(distinct).alias("current"), F.array_min(distinct).alias("previous")),
    )

