"""What is read before any extraction: lists of workbooks, page filters, stored cells; headers and audits of what is read."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import functions as F

from gridspark import fixed
from gridspark.model import SHEET, read_cells, write_cells
from gridspark.operators.settling import checkpoint_folder, settle
from gridspark.plans import checks as C
from gridspark.plans.details import extract_details
from gridspark.sources.pivots import page_filters
from gridspark.sources.workbooks import discover, discover_paths, unzip
from reports.families import flat_grid
from reports.grids import lay, routed, spot, table, text
from reports.ingestion import store_files
from reports.packages import pack, pack_orders, relationships, sheet_xml


def _folder(spark, name):
    folder = f"{checkpoint_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    return folder if "://" in folder else re.sub("^(file:)?/*", "file:///", folder)


def discover_workbooks(spark, sf_dir):
    """The workbooks of a folder that also holds lock files and notes, read whole and by path."""
    folder = _folder(spark, "inbox")
    books = table(spark, sf_dir, "orders").withColumn("book", F.floor(F.col("o_orderkey") / 1000)).groupBy("book").applyInPandas(
        pack_orders, "workbook string, content binary")
    stem = F.regexp_replace("workbook", r"\.xlsx$", "")
    names = F.explode(F.array("workbook", F.concat(F.lit("~$"), "workbook"), F.concat(stem, F.lit(".txt")), F.concat(stem, F.lit(".XLSM"))))
    store_files(books.select(names.alias("workbook"), "content", F.lit(folder).alias("folder"))).count()
    whole = discover(spark, folder).select("workbook", (F.octet_length("content") > 0).alias("filled"))
    return whole.join(discover_paths(spark, folder), "workbook").select("workbook", F.col("filled").cast("int").alias("filled"))


_LIST_SQL = """
SELECT DISTINCT 'orders ' || (o_orderkey // 1000) || s AS workbook, 1 AS filled FROM orders, (VALUES ('.xlsx'), ('.XLSM')) v(s)
"""

_NS = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'


def pivot_package(names, hidden):
    """A workbook with one pivot whose page field has these items, some of them hidden."""
    items = "".join(f'<item x="{i}"{" h=" + chr(34) + "1" + chr(34) if n in hidden else ""}/>' for i, n in enumerate(names))
    shared = "".join(f'<s v="{n} &amp; co"/>' for n in names)
    extra = {
        "xl/worksheets/_rels/sheet1.xml.rels": relationships([("rId1", "pivotTable", "../pivotTables/pivotTable1.xml")]),
        "xl/pivotTables/pivotTable1.xml": f'<pivotTableDefinition {_NS}><location ref="D6:F20"/><pivotFields><pivotField/><pivotField><items>{items}'
                                          '<item t="default"/></items></pivotField></pivotFields><pageFields><pageField fld="1"/></pageFields></pivotTableDefinition>',
        "xl/pivotTables/_rels/pivotTable1.xml.rels": relationships([("rId1", "pivotCacheDefinition", "../pivotCache/pivotCacheDefinition1.xml")]),
        "xl/pivotCache/pivotCacheDefinition1.xml": f'<pivotCacheDefinition {_NS}><cacheFields><cacheField name="Ville"/><cacheField name="Priorité">'
                                                   f"<sharedItems>{shared}</sharedItems></cacheField></cacheFields></pivotCacheDefinition>",
    }
    return pack({"Pivot": sheet_xml([])}, [], extra=extra)


def pack_pivots(batches):
    """Workbooks whose page field has the priorities of a customer's orders, those of status P hidden."""
    import pandas as pd

    for batch in batches:
        rows = batch.itertuples(index=False, name=None)
        yield pd.DataFrame([(f"client {int(book)}.xlsx", pivot_package(sorted(names), set(hidden))) for book, names, hidden in rows],
                           columns=["workbook", "content"])


def pivot_filters(spark, sf_dir):
    """The items that the page filters of many workbooks show."""
    orders = table(spark, sf_dir, "orders").withColumn("book", F.col("o_custkey"))
    names = orders.groupBy("book").agg(
        F.collect_set("o_orderpriority").alias("names"),
        F.collect_set(F.when(F.col("o_orderstatus") == "P", F.col("o_orderpriority"))).alias("hidden"))
    books = names.mapInPandas(pack_pivots, "workbook string, content binary")
    return page_filters(settle(unzip(books)))


_PIVOT_SQL = """
WITH p AS (SELECT o_custkey, o_orderpriority, bool_or(o_orderstatus = 'P') AS hidden FROM orders GROUP BY ALL),
n AS (SELECT *, CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderpriority) - 1 AS INTEGER) AS item_ord FROM p)
SELECT 'client ' || o_custkey || '.xlsx' AS workbook, 'Pivot' AS sheet, 4 AS min_col, 'PRIORITE' AS field, item_ord,
  o_orderpriority || ' & co' AS item FROM n WHERE NOT hidden
"""


def stored_cells(spark, sf_dir):
    """A cell table written by sheet and band, and read back for some bands of one column."""
    orders = table(spark, sf_dir, "orders")
    row = F.col("o_orderkey") + 1
    cells = lay(orders, "o.xlsx", F.concat(F.lit("s "), "o_orderstatus"), [
        spot(row, "A", F.col("o_totalprice").cast("decimal(18,2)"), number_format="#,##0,"), text(row, "C", F.col("o_orderpriority"))])
    folder = _folder(spark, "cells")
    write_cells(cells, folder)
    return read_cells(spark, folder).where("row >= 1024 and col = 1").select("workbook", "sheet", "row", "col", "raw", "kind", "number_format")


_STORED_SQL = """
SELECT 'o.xlsx' AS workbook, 's ' || o_orderstatus AS sheet, o_orderkey + 1 AS row, 1 AS col, CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) AS raw,
  'n' AS kind, '#,##0,' AS number_format FROM orders WHERE o_orderkey >= 1023
"""


def header_checks(spark, sf_dir):
    """Headers and fields that a table lacks, per sheet, for fixed and for flat tables."""
    lines = table(spark, sf_dir, "orders")
    rows = lines.select(F.lit("o.xlsx").alias("workbook"), F.concat(F.lit("c"), F.col("o_custkey").cast("string")).alias("sheet"), F.col("o_orderkey").alias("row"),
                        F.col("o_orderpriority").alias("ville"), F.col("o_orderstatus").alias("axe"))
    full = rows.withColumn("valeur", F.lit(1))
    found = [
        C.check_schema(rows, "variation"), C.check_schema(full, "variation"), C.check_header(rows, ("ville", "axe"), "variation"),
        C.check_header(full, fixed.HEADERS["variation"], "variation"), C.check_header(rows, ("marque", "ville", "marque"), "details"),
        C.check_header(full, fixed.HEADERS["details"], "details")]
    union = found[0]
    for issues in found[1:]:
        union = union.unionByName(issues)
    return union.select("sheet", "kind", "message", "policy", "stage")


_HEADER_SQL = """
SELECT sheet, 'schema' AS kind, message, 'reject' AS policy, 'validate' AS stage
FROM (SELECT DISTINCT 'c' || o_custkey AS sheet FROM orders), (VALUES ('missing fields: valeur'), ('header differs: ville, axe'),
  ('flat header has an empty or a repeated name'), ('header lacks a required detail field')) v(message)
"""


def audit_visits(spark, sf_dir):
    """Errors and formulas of flat tables: those that the extractor looks at, asked for the suspects alone."""
    key, col = F.col("row") + F.regexp_extract("sheet", r"\d+", 0).cast("bigint"), F.col("col")
    below = F.col("row") > 3
    cells = flat_grid(spark, sf_dir).withColumns({
        "raw": F.when(below & (col == 3) & (key % 7 == 0), "#N/A").when(below & (col == 8) & (key % 5 == 0), "#REF!").otherwise(F.col("raw")),
        "formula": F.when(below & col.isin(6, 8) & (key % 11 == 0), "A1+#REF!").otherwise(F.col("formula"))})
    cells = settle(cells)
    found = extract_details(cells, routed(cells, fixed.DETAILS, {"stop_on_empty_row": False}))
    suspects = C.suspects(cells)
    return C.audit(suspects, found.visits(suspects), "reject", "warning").select("sheet", "row", "col", "kind", "message", "policy")


_VISITS_SQL = """
WITH b AS (SELECT 'part ' || (o_orderkey // 5000) AS sheet, 4 + o_orderkey % 5000 + CASE WHEN o_orderkey % 5000 >= 3000 THEN 1 ELSE 0 END AS row,
             o_orderkey // 5000 AS s FROM orders)
SELECT sheet, row, 3 AS col, 'error_value' AS kind, 'error value #N/A' AS message, 'reject' AS policy FROM b WHERE (row + s) % 7 = 0
UNION ALL SELECT sheet, row, 6, 'formula_error', 'formula names an error: #REF!', 'reject' FROM b WHERE (row + s) % 11 = 0
"""

REPORTS = {
    "discover_workbooks": (discover_workbooks, _LIST_SQL), "pivot_filters": (pivot_filters, _PIVOT_SQL), "stored_cells": (stored_cells, _STORED_SQL),
    "header_checks": (header_checks, _HEADER_SQL), "audit_visits": (audit_visits, _VISITS_SQL),
}
