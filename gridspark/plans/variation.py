"""Variation tables: two shared periods, aligned whatever their column order, and a variation."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from gridspark.fixed import VARIATION
from gridspark.functions.coords import col_index
from gridspark.functions.dates import period_label
from gridspark.functions.numeric import measure_of, percentage_of, two_decimals
from gridspark.functions.text import clean_text
from gridspark.model import SHEET
from gridspark.operators.banding import contiguous_prefix
from gridspark.operators.grid import align_periods, at, banded, head, head_at, sheet_rows, with_layout
from gridspark.operators.settling import settle
from gridspark.plans.common import Extraction, among, of_family, sheet_issues, union_all
from gridspark.plans.routing import setting_list

_TABLE = (
    "struct<header_row:bigint,data_start_row:bigint,data_end_row:bigint,ville_column:string,"
    "variation_column:string,value_columns:array<string>,skip_empty_rows:boolean>"
)
TABLE = [*SHEET, "table_ord"]


def variation_layout(routed: DataFrame) -> DataFrame:
    return of_family(routed, VARIATION).select(
        *SHEET, "last_row",
        F.transform(setting_list("tables", _TABLE), lambda t, i: F.struct(
            i.alias("table_ord"), t["header_row"].alias("header_row"),
            t["data_start_row"].alias("data_start_row"), t["data_end_row"].alias("data_end_row"),
            col_index(t["ville_column"]).alias("city_col"),
            col_index(t["variation_column"]).alias("variation_col"),
            F.transform(t["value_columns"], col_index).alias("value_cols"),
            F.coalesce(t["skip_empty_rows"], F.lit(False)).alias("skip_empty"),
        )).alias("tables"),
    )


def extract_variation(cells: DataFrame, routed: DataFrame) -> Extraction:
    """(workbook, sheet, row, table_ord, axis_ord, ville, axe, valeur)."""
    layout = settle(variation_layout(routed))
    head_rows = F.array_distinct(F.transform("tables", lambda t: t["header_row"]))
    columns = lambda t: F.concat(F.array(t["city_col"], t["variation_col"]), t["value_cols"])
    data = F.exists("tables", lambda t: F.col("row").between(t["data_start_row"], t["data_end_row"])
                    & F.array_contains(columns(t), F.col("col")))
    records = sheet_rows(cells, layout, data, head_rows)

    known = head(records, layout, head_rows).withColumn("tables", F.transform("tables", lambda t: F.struct(
        t["table_ord"].alias("table_ord"), t["data_start_row"].alias("data_start_row"),
        t["data_end_row"].alias("data_end_row"), t["city_col"].alias("city_col"),
        t["variation_col"].alias("variation_col"), t["value_cols"].alias("value_cols"),
        t["skip_empty"].alias("skip_empty"),
        F.transform(t["value_cols"], lambda c: head_at(t["header_row"], c)["ts"].cast("date")).alias("periods"),
    ))).drop("head")
    known = settle(known.withColumn(
        "aligned", align_periods(F.flatten(F.transform("tables", lambda t: t["periods"])))))
    any_table = lambda test: F.exists("tables", test)
    faults = sheet_issues(
        known,
        (F.coalesce(F.size("tables"), F.lit(0)) <= 0, "tables", "at least one table required"),
        (any_table(lambda t: F.size(t["value_cols"]) != 2), "period_columns", "exactly two period columns required"),
        (any_table(lambda t: F.exists(t["periods"], lambda p: p.isNull())), "period", "period header is not a date"),
        (any_table(lambda t: F.get(t["periods"], F.lit(0)) == F.get(t["periods"], F.lit(1))),
         "period", "period headers must be different"),
        (F.col("aligned").isNull(), "periods", "tables must share the same two periods"),
    )
    lines = (
        with_layout(records, known).filter(F.col("aligned").isNotNull())
        .withColumn("t", F.explode(F.filter(
            "tables", lambda t: F.col("row").between(t["data_start_row"], t["data_end_row"]))))
        .withColumn("cells", F.map_filter("cells", lambda c, _: F.array_contains(columns(F.col("t")), c)))
        .filter(F.size("cells") > 0)
        .select(*SHEET, F.col("t.table_ord").alias("table_ord"), "band", "row", "cells", "t", "aligned",
                F.col("t.data_start_row").alias("start"))
    )
    # Read once for each kind of table, and twice by the look for gaps.
    lines = settle(lines)
    # Tables that skip empty rows need no look at their neighbours.
    stopping = contiguous_prefix(lines.filter("not t.skip_empty"), TABLE, "row", F.col("start"))
    kept = union_all([stopping, lines.filter("t.skip_empty")])

    def period_value(period: str):
        c = at(F.col("cells"), F.get("t.value_cols", F.array_position("t.periods", F.col(f"aligned.{period}")).cast("int") - 1))
        return two_decimals(percentage_of(c))

    change = at(F.col("cells"), F.col("t.variation_col"))
    axes = F.array(
        F.struct(period_label(F.col("aligned.current")).alias("axe"), period_value("current").alias("valeur")),
        F.struct(period_label(F.col("aligned.previous")).alias("axe"), period_value("previous").alias("valeur")),
        F.struct(F.lit("Variation").alias("axe"), two_decimals(measure_of(change)).alias("valeur")),
    )
    rows = kept.select(
        *TABLE, "row", clean_text(at(F.col("cells"), F.col("t.city_col"))["raw"]).alias("ville"), axes.alias("axes"),
    ).select(*TABLE, "row", "ville", F.posexplode("axes").alias("axis_ord", "a")).select(*TABLE, "row", "axis_ord", "ville", "a.axe", "a.valeur")
    headers = lambda some: with_layout(banded(some), layout).filter(F.exists("tables", lambda t: (
        F.col("row") == t["header_row"]) & F.array_contains(t["value_cols"], F.col("col")))).select(*SHEET, "row", "col")
    return Extraction(rows, faults, lambda some: headers(some).unionByName(among(some, kept)))
