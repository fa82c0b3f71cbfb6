"""Table blocks found by their anchor label, wherever they stand on the sheet."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from gridspark.fixed import GRAND_TOTAL, SEVERAL_ITEMS
from gridspark.functions.numeric import is_integral, parsed_cell, to_number
from gridspark.functions.text import canonical_text
from gridspark.model import SHEET, not_empty
from gridspark.operators.banding import band, numbered, running
from gridspark.operators.settling import settle, stored

BLOCK = [*SHEET, "header_row", "label_col"]
SPAN = [*SHEET, "label_col", "last_col", "keep_blank"]

# Measure headers that make a VILLE label an anchor, and the context labels.
MEASURE_HEADERS = ("AIVAM", "SOFAC")
CONTEXT_LABELS = ("ANNEE", "VILLE", "MOIS")


def keyed(cells: DataFrame) -> DataFrame:
    """Cells with the canonical text of text cells as ``key``, made once for all block operators."""
    return cells.withColumn("key", F.when(F.col("kind") == "s", canonical_text(F.col("raw"))))


def discover_blocks(cells: DataFrame, is_anchor: Column) -> DataFrame:
    """One row per block: (workbook, sheet, header_row, label_col, last_col, anchor, headers,
    block_index). ``cells`` carries ``band`` and ``key``; ``is_anchor`` tests them.

    A block is an anchor and the contiguous non-empty cells to its right, ended by an empty cell
    or another anchor; ``headers`` is ARRAY<STRUCT<col, raw, key>>. An anchor VILLE may also be a
    filter: it counts only with a measure header. Runs are islands within one sheet row.
    """
    line = [*SHEET, "band", "row"]
    by_col = Window.partitionBy(*line).orderBy("col")
    filled = cells.filter(not_empty(F.col("raw"))).select(*line, "col", "raw", "key", F.when(is_anchor, F.col("key")).alias("anchor_key"))
    # Few rows hold an anchor: their numbers are hashed, and no other cell is sorted.
    anchored = filled.filter("anchor_key is not null").select(*line).distinct()
    marked = filled.join(anchored.hint("shuffle_hash"), line, "left_semi")
    starts = F.col("anchor_key").isNotNull() | (F.col("col") - F.lag("col").over(by_col) != 1)
    runs = (
        marked.withColumn("starts", F.coalesce(starts, F.lit(True)))
        .withColumn("island", F.sum(F.col("starts").cast("int")).over(by_col))
        .groupBy(*SHEET, "band", "row", "island")
        .agg(
            F.min_by(F.struct("anchor_key", "raw"), "col").alias("anchor"),
            F.min("col").alias("label_col"), F.max("col").alias("last_col"),
            F.array_sort(F.collect_list(F.struct("col", "raw", "key"))).alias("run"),
        )
        .filter((F.col("anchor.anchor_key").isNotNull()) & (F.col("last_col") > F.col("label_col")))
        .withColumn("headers", F.slice("run", F.lit(2), F.size("run")))
    )
    measured = F.exists("headers", lambda h: F.coalesce(h["key"].isin(*MEASURE_HEADERS), F.lit(False)))
    blocks = runs.filter((F.col("anchor.anchor_key") != "VILLE") | measured).select(
        *SHEET, "band", F.col("row").alias("header_row"), "label_col", "last_col",
        F.col("anchor.anchor_key").alias("anchor"), "headers",
    )
    # Numbering reads its input twice.
    return numbered(settle(blocks), SHEET, ["header_row", "label_col"], "block_index")


def period_context(cells: DataFrame, blocks: DataFrame, lookback: Column) -> DataFrame:
    """``blocks`` with ``annee``, ``ville`` and ``mois``: the value right of the nearest such label
    above the header, leftmost first, within ``lookback`` rows and the block's columns.

    The cells above a header are a spine of exact positions, ``lookback`` rows by the width of the
    block, and labels (by ``key``) join it there, so that no pair of block and label is tried in
    vain.
    """
    by_col = Window.partitionBy(*SHEET, "band", "row").orderBy("col")
    right = F.when(F.lead("col").over(by_col) == F.col("col") + 1, F.lead("raw").over(by_col))
    labels = (
        cells.filter(not_empty(F.col("raw")))
        .withColumn("neighbour", right)
        .filter(F.col("key").isin(*CONTEXT_LABELS) & F.col("neighbour").isNotNull())
        .select(*SHEET, "row", "col", F.col("key").alias("label"), "neighbour")
    )
    # The lookback is a small configured number; the offsets are its spine.
    sight = blocks.filter(lookback >= 1).select(
        *BLOCK, F.explode(F.sequence(F.lit(1), lookback.cast("int"))).alias("above"), "last_col",
    ).select(
        *BLOCK, (F.col("header_row") - F.col("above")).alias("row"),
        F.explode(F.sequence(F.col("label_col"), F.col("last_col") - 1)).alias("col"),
    )
    number = to_number(F.col("neighbour"))
    value = F.when(is_integral(number), number.cast("decimal(30,0)").cast("string")).otherwise(F.col("neighbour"))
    nearest = F.struct(-F.col("row"), F.col("col"))
    found = (
        sight.filter("row >= 1").join(labels, [*SHEET, "row", "col"])
        .withColumn("value", value)
        .groupBy(*BLOCK)
        .agg(*[
            F.min_by(F.when(F.col("label") == name, F.col("value")),
                     F.when(F.col("label") == name, nearest)).alias(name.lower())
            for name in CONTEXT_LABELS
        ])
    )
    return blocks.join(found, BLOCK, "left")


def block_axis(cells: DataFrame, blocks: DataFrame) -> DataFrame:
    """``blocks`` with ``axis`` (``cells`` carries ``key``): the topmost cell that is not blank in the label column, when it
    stands above the header. It is the same for all blocks of a column."""
    top = (
        cells.filter(F.coalesce("key", "raw") != "")
        .groupBy(*SHEET, F.col("col").alias("label_col"))
        .agg(F.min_by("raw", "row").alias("_top"), F.min("row").alias("_top_row"))
    )
    return (
        blocks.join(top, [*SHEET, "label_col"], "left")
        .withColumn("axis", F.when(F.col("_top_row") < F.col("header_row"), F.col("_top")))
        .drop("_top", "_top_row")
    )


def block_rows(cells: DataFrame, blocks: DataFrame, keep_blank: Column,
               last_row: str = "last_row") -> DataFrame:
    """Rows below each block header: (block keys, band, row, label, cells MAP<col, cell>).

    With ``keep_blank`` the block ends at the first row empty in all its columns, else at the first
    empty label. Rows are islands of consecutive row numbers per distinct column span; a block
    takes the rest of the island its header is part of. ``blocks`` gives the ``last_row`` to read.
    """
    wanted = blocks.withColumn("keep_blank", keep_blank)
    # Distinct spans, once per band from their first header down: the join key of the cells.
    spans = (
        wanted.groupBy(*SPAN)
        .agg(F.min("header_row").alias("_from"), F.max(last_row).alias("_to"))
        .withColumn("band", F.explode(F.sequence(band("_from"), band("_to"))))
        .withColumn("col", F.explode(F.sequence("label_col", "last_col")))
    )
    lines = (
        cells.filter(not_empty(F.col("raw")))
        .join(spans, [*SHEET, "band", "col"])
        .filter(F.col("row").between(F.col("_from"), F.col("_to")))
        .groupBy(*SPAN, "band", "row")
        .agg(F.map_from_entries(F.collect_list(F.struct("col", parsed_cell()))).alias("cells"))
        .withColumn("label", F.element_at("cells", F.col("label_col"))["raw"])
        .filter(F.col("keep_blank") | F.col("label").isNotNull())
    )
    lines = stored(lines)
    islands = numbered(lines, SPAN, "row", "_n").withColumn("island", F.col("row") - F.col("_n")).drop("_n")
    ends = islands.groupBy(*SPAN, "island").agg(F.max("row").alias("_end"))
    placed = (
        wanted.join(
            islands.select(*SPAN, F.col("row").alias("header_row"), "island"), [*SPAN, "header_row"])
        .join(ends, [*SPAN, "island"])
        .select(*SPAN, "island", "header_row", "_end", F.col(last_row).alias("_limit"))
        .withColumn("band", F.explode(F.sequence(band("header_row"), band("_end"))))
    )
    return (
        islands.join(placed, [*SPAN, "island", "band"])
        .filter((F.col("row") > F.col("header_row")) & (F.col("row") <= F.col("_limit")))
        .select(*BLOCK, "last_col", "band", "row", "label", "cells")
    )


def blank_label_stops(cells: DataFrame, blocks: DataFrame, rows: DataFrame) -> DataFrame:
    """Blocks that ended at an empty label although the row below still holds measures."""
    last = rows.groupBy(*BLOCK).agg(F.max("row").alias("_end"))
    below = blocks.join(last, BLOCK, "left").select(
        *BLOCK, "last_row", (F.coalesce("_end", "header_row") + 1).alias("row"),
        F.explode(F.sequence(F.col("label_col") + 1, F.col("last_col"))).alias("col"))
    measures = cells.filter(not_empty(F.col("raw"))).select(*SHEET, "row", "col")
    return below.filter("row <= last_row").join(measures, [*SHEET, "row", "col"]).select(*BLOCK, "row").distinct()


def is_grand_total(label: Column) -> Column:
    return canonical_text(label) == GRAND_TOTAL


def assign_zones(markers: DataFrame, blocks: DataFrame) -> DataFrame:
    """``blocks`` with ``marker_row``, ``marker_col``, ``marker`` and ``zone_end`` of their zone.

    A zone reaches from its marker down to the next row with a marker (``zone_end``, exclusive,
    NULL for the last) and right to the next marker of its row. The row step is an as-of join, done
    as a running state over the union of marker rows and blocks; the markers of one row are a
    short array, whose rightmost entry before the block is taken. Zones do not overlap, so a
    block gets one marker at most; a block outside every zone is dropped.
    """
    rows = markers.groupBy(*SHEET, "row").agg(
        F.array_sort(F.collect_list(F.struct("col", "raw"))).alias("markers"))
    ranked = numbered(rows.withColumn("band", band("row")), SHEET, "row", "_n")
    following = ranked.select(*SHEET, (F.col("_n") - 1).alias("_n"), F.col("row").alias("zone_end"))
    zones = ranked.join(following, [*SHEET, "_n"], "left")
    points = zones.select(
        *SHEET, "band", "row", F.lit(0).alias("place"), F.lit(None).cast("int").alias("label_col"),
        F.struct("row", "zone_end", "markers").alias("zone"),
    ).unionByName(blocks.select(
        *SHEET, band("header_row").alias("band"), F.col("header_row").alias("row"),
        F.lit(1).alias("place"), "label_col"), allowMissingColumns=True)
    placed = (
        running(points, SHEET, ["row", "place", "label_col"], latest={"in_zone": F.col("zone")})
        .filter((F.col("place") == 1) & F.col("in_zone").isNotNull())
        .withColumn("m", F.array_max(F.filter(
            "in_zone.markers", lambda m: m["col"] <= F.col("label_col"))))
        .filter(F.col("m.col") < F.col("label_col"))
    )
    return blocks.join(placed.select(
        *SHEET, F.col("row").alias("header_row"), "label_col",
        F.col("in_zone.row").alias("marker_row"), F.col("m.col").alias("marker_col"),
        F.col("m.raw").alias("marker"), "in_zone.zone_end"), BLOCK)


def resolve_filters(blocks: DataFrame, page_filters: DataFrame, several: str = SEVERAL_ITEMS) -> DataFrame:
    """Replace the caption "(several items)" in ``mois`` by the selected items, comma-joined."""
    selected = (
        page_filters.filter(F.col("field") == "MOIS")
        .groupBy(*SHEET, F.col("min_col").alias("label_col"))
        .agg(F.array_sort(F.collect_list(F.struct("item_ord", "item"))).alias("_items"))
        .select(*SHEET, "label_col", F.array_join(F.col("_items.item"), ",").alias("_selected"))
    )
    use = (canonical_text(F.col("mois")) == several) & F.col("_selected").isNotNull()
    return (
        blocks.join(selected, [*SHEET, "label_col"], "left")
        .withColumn("mois", F.when(use, F.col("_selected")).otherwise(F.col("mois")))
        .drop("_selected")
    )
