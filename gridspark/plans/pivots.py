"""Sheets of pivot tables: concession groups, and the long staging of every block."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from gridspark.fixed import CONCESSION, DEFAULT_LOOKBACK, PIVOT_STAGING, ROW_LABELS_ANCHOR
from gridspark.functions.numeric import measure_of
from gridspark.functions.text import canonical_text, clean_text
from gridspark.model import SHEET, issue, not_empty
from gridspark.operators.banding import band
from gridspark.operators.blocks import (
    BLOCK, assign_zones, blank_label_stops, block_axis, block_rows, discover_blocks, is_grand_total,
    keyed, period_context, resolve_filters,
)
from gridspark.operators.grid import at, banded, unpivot_measures, until_total, with_layout
from gridspark.operators.select import find_cells
from gridspark.operators.settling import settle, stored
from gridspark.plans.common import Extraction, among, of_family, sheet_issues, union_all
from gridspark.plans.routing import setting, setting_int, setting_list

ZONE_PREFIX = "TPR "
CONCESSION_HEADERS = ("AIVAM", "SOFAC", "TOTAL_GENERAL")


def pivot_layout(routed: DataFrame, family: str) -> DataFrame:
    anchors = setting_list("anchor_labels")
    anchors = F.when(F.size(anchors) > 0, anchors).otherwise(F.array(F.lit(ROW_LABELS_ANCHOR)))
    if family == CONCESSION:
        anchors = F.array(F.lit(ROW_LABELS_ANCHOR))
    return of_family(routed, family).select(
        *SHEET, "last_row",
        F.transform(anchors, canonical_text).alias("anchor_keys"),
        F.coalesce(setting_int("context_lookback"), F.lit(DEFAULT_LOOKBACK)).alias("lookback"),
        F.coalesce(setting("blank_label_policy"), F.lit("stop")).alias("blank_policy"),
    )


def _bound(cells: DataFrame, layout: DataFrame) -> DataFrame:
    """Cells of the family's sheets with their band and whether they are an anchor, without what no block operator reads."""
    filled = cells.filter(not_empty(F.col("raw")))
    bound = keyed(with_layout(banded(filled), layout.select(*SHEET, "last_row", "anchor_keys")))
    return stored(bound.withColumn("is_anchor", F.array_contains("anchor_keys", F.col("key"))).drop("last_row", "anchor_keys", "formula"))


def extract_pivot_staging(cells: DataFrame, routed: DataFrame, page_filters: DataFrame) -> Extraction:
    """(workbook, row, col, the 11 columns of the staging table); totals and blanks are kept."""
    layout = settle(pivot_layout(routed, PIVOT_STAGING))
    bound = _bound(cells, layout)
    found = settle(discover_blocks(bound, F.col("is_anchor")).join(layout, SHEET))
    blocks = resolve_filters(
        block_axis(bound, period_context(bound, found, F.col("lookback"))), page_filters)
    axis_key = canonical_text(F.col("axis"))
    blocks = blocks.withColumns({
        "periodicite": F.when(F.startswith(axis_key, F.lit("MOIS")), "MENSUEL")
        .when(F.startswith(axis_key, F.lit("ANNEE")), "ANNUEL"),
        "dimension": F.when(F.col("anchor") == "VILLE", "VILLE").otherwise("MARQUE"),
    })
    blocks = settle(blocks)
    unnamed = blocks.filter(F.col("periodicite").isNull()).select(*issue(
        "axis", "unknown synthesis axis", row=F.col("header_row"), col=F.col("label_col")))
    without = layout.join(found.select(*SHEET).distinct(), SHEET, "left_anti")
    policy = F.col("blank_policy")
    faults = union_all([
        unnamed,
        sheet_issues(without, (F.lit(True), "anchors", "no pivot table anchors found")),
        sheet_issues(layout, (~policy.isin("stop", "keep_with_values"), "policy", "invalid blank_label_policy")),
    ])
    lines = stored(block_rows(bound, blocks, policy == "keep_with_values"))
    stops = blank_label_stops(
        cells, blocks.filter(policy == "stop"), lines).select(*issue(
            "blank_label", "empty label with cached measures", row=F.col("row"), col=F.col("label_col"),
            policy="warning"))
    context = blocks.select(
        *BLOCK, "block_index", "headers", "axis", "periodicite", "annee", "mois", "ville", "dimension")
    # Blocks meet their rows per band, so that one long block is spread over tasks.
    spread = context.join(
        lines.groupBy(*BLOCK).agg(F.max("band").alias("_last")), BLOCK
    ).withColumn("band", F.explode(F.sequence(band("header_row"), F.col("_last"))))
    long = unpivot_measures(
        lines.join(spread, [*BLOCK, "band"]), F.col("headers"),
        [*BLOCK, "row", "label", "block_index", "axis", "periodicite", "annee", "mois", "ville", "dimension"])
    by_city = F.col("dimension") == "VILLE"
    rows = long.select(
        "workbook", "sheet", "row", F.col("measure.col").alias("col"), F.col("block_index").cast("int").alias("bloc_index"),
        clean_text(F.col("axis")).alias("axe"), "periodicite",
        # A year is published as found: a number, or a text such as "(Tous)".
        F.coalesce(F.col("annee").try_cast("bigint").cast("string"), clean_text(F.col("annee"))).alias("annee"),
        F.col("mois").alias("mois"), "dimension",
        F.when(~by_city, F.col("label")).alias("marque"),
        F.when(by_city, F.col("label")).otherwise(F.col("ville")).alias("ville"),
        clean_text(F.col("measure.raw")).alias("organisme"),
        measure_of(F.col("cell")).alias("valeur"),
    )
    return Extraction(rows, union_all([faults, stops]), lambda some: _block_footprint(some, blocks, lines))


def _block_footprint(cells: DataFrame, blocks: DataFrame, lines: DataFrame) -> DataFrame:
    """Header runs, the rows above them that are searched for context, and the block rows."""
    searched = blocks.select(
        *SHEET, F.explode(F.sequence(
            F.greatest(F.lit(1).cast("bigint"), F.col("header_row") - F.greatest("lookback", F.lit(0))),
            F.col("header_row"))).alias("row"), "label_col", "last_col",
    ).select(*SHEET, "row", F.explode(F.sequence("label_col", "last_col")).alias("col"))
    above = cells.select(*SHEET, "row", "col").join(searched, [*SHEET, "row", "col"])
    return above.unionByName(among(cells, lines))


def extract_concession(cells: DataFrame, routed: DataFrame) -> Extraction:
    """(workbook, sheet, row, the 7 columns of the concession table), total rows included."""
    layout = settle(pivot_layout(routed, CONCESSION))
    bound = _bound(cells, layout)
    markers = find_cells(bound, lambda raw: F.startswith(F.upper(clean_text(raw)), F.lit(ZONE_PREFIX))).select(
        *SHEET, "row", "col", clean_text(F.col("raw")).alias("raw"))
    found = settle(discover_blocks(bound, F.col("is_anchor")).join(layout, SHEET))
    zoned = settle(assign_zones(settle(markers), found))
    header = lambda key: F.array_max(F.transform(
        F.filter("headers", lambda h: h["key"] == key), lambda h: h["col"]))
    blocks = period_context(bound, zoned, F.col("lookback")).withColumns({
        "groupe": F.substr(F.col("marker"), F.lit(len(ZONE_PREFIX) + 1)),
        "year": F.when(F.col("annee").rlike(r"^-?\d+$"), F.col("annee").try_cast("int")),
        "cols": F.struct(*[header(k).alias(k) for k in CONCESSION_HEADERS]),
        "last_row": F.coalesce(F.col("zone_end") - 1, F.col("last_row")),
    })
    blocks = settle(blocks)
    lines = settle(block_rows(bound, blocks, F.lit(False)))
    total = is_grand_total(F.col("label"))
    kept = until_total(lines, BLOCK, total, inclusive=True)

    totals = kept.filter(total).select(*BLOCK).distinct()
    zone = [*SHEET, "row", "col"]
    at_block = lambda kind, message: issue(kind, message, row=F.col("header_row"), col=F.col("label_col"))
    faults = union_all([
        sheet_issues(layout.join(markers.select(*SHEET).distinct(), SHEET, "left_anti"),
                     (F.lit(True), "markers", "no TPR concession group found")),
        markers.join(zoned.select(*SHEET, F.col("marker_row").alias("row"), F.col("marker_col").alias("col")),
                     zone, "left_anti")
        .select(*issue("zone", "no pivot table for concession group", row=F.col("row"), col=F.col("col"))),
        blocks.filter(F.least(*[F.col("cols")[k].isNotNull() for k in CONCESSION_HEADERS]) == F.lit(False))
        .select(*at_block("headers", "AIVAM, SOFAC or Total général missing")),
        blocks.filter(F.col("year").isNull()).select(*at_block("year", "missing integer year")),
        blocks.join(totals, BLOCK, "left_anti").select(*at_block("total", "missing Total général")),
    ])
    spread = blocks.select(*BLOCK, "groupe", "year", "cols").join(
        kept.groupBy(*BLOCK).agg(F.max("band").alias("_last")), BLOCK
    ).withColumn("band", F.explode(F.sequence(band("header_row"), F.col("_last"))))
    joined = kept.join(spread, [*BLOCK, "band"])

    def measure(key: str):
        return measure_of(at(F.col("cells"), F.col("cols")[key]))

    rows = joined.select(
        *SHEET, "row", "header_row", "label_col",
        F.col("groupe").alias("groupe_concessionnaire"), F.col("year").alias("annee"), F.col("label").alias("marque"),
        measure("AIVAM").alias("aivam"), measure("SOFAC").alias("sofac"), measure("TOTAL_GENERAL").alias("total"),
        F.when(total, "total").otherwise("marque").alias("row_type"),
    )
    marked = markers.select(*SHEET, "row", "col")
    visits = lambda some: _block_footprint(some, blocks, lines).unionByName(some.join(marked, [*SHEET, "row", "col"], "left_semi").select(*SHEET, "row", "col"))
    stops = blank_label_stops(cells, blocks.join(totals, BLOCK, "left_anti"), lines).select(*issue(
        "blank_label", "empty label with cached measures", row=F.col("row"), col=F.col("label_col"), policy="warning"))
    return Extraction(rows, union_all([faults, stops]), visits)

