"""Workbooks written from tables in tasks and read back as cells."""

from __future__ import annotations

import io
import re
import uuid
import zipfile

from pyspark.sql import functions as F

from gridspark.operators.settling import checkpoint_folder, settle
from gridspark.sources.workbooks import ingest, ingest_parts, list_parts, unzip, unzip_parts
from reports.grids import table
from reports.packages import pack_orders


def workbooks(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").withColumn("book", F.floor(F.col("o_orderkey") / 1000))
    return orders.groupBy("book").applyInPandas(pack_orders, "workbook string, content binary")


def ingest_cells(spark, sf_dir):
    cells, _, _ = ingest(workbooks(spark, sf_dir))
    return cells.select("workbook", "sheet", "row", "col", "raw", "kind", F.date_format("ts", "yyyy-MM-dd").alias("day"), "formula", "number_format")


_BOOK = "'orders ' || (o_orderkey // 1000) || '.xlsx'"
_CELLS_SQL = f"""
WITH b AS (SELECT {_BOOK} AS workbook, 'Commandes & co' AS sheet, o_orderkey % 1000 + 2 AS row, o.* FROM orders o)
SELECT workbook, sheet, row, 1 AS col, o_orderpriority AS raw, 's' AS kind, NULL AS day, NULL AS formula, 'General' AS number_format FROM b
UNION ALL SELECT workbook, sheet, row, 2, o_orderstatus, 's', NULL, NULL, 'General' FROM b
UNION ALL SELECT workbook, sheet, row, 3, CAST(o_totalprice AS VARCHAR), 'n', NULL, NULL, '#,##0,' FROM b
UNION ALL SELECT workbook, sheet, row, 4, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S'), 'd', strftime(o_orderdate, '%Y-%m-%d'), NULL, 'mmm-yy' FROM b
UNION ALL SELECT workbook, sheet, row, 5, CASE WHEN o_orderstatus = 'P' THEN NULL WHEN o_orderpriority = '5-LOW' THEN '#REF!' ELSE ' n° ' || o_orderkey || ' & co' END,
  CASE WHEN o_orderstatus = 'P' THEN 'n' WHEN o_orderpriority = '5-LOW' THEN 'e' ELSE 's' END, NULL,
  CASE WHEN o_orderstatus = 'P' THEN 'C' || row || '*2' WHEN o_orderpriority = '5-LOW' THEN '#REF!+1' END, 'General' FROM b
"""


def ingest_sheets(spark, sf_dir):
    _, sheets, merged = ingest(workbooks(spark, sf_dir))
    shown = sheets.select("workbook", "sheet", "ordinal", "sheet_state", "last_row", "last_col")
    ranges = merged.groupBy("workbook", "sheet").agg(F.max("max_col").alias("merged_to"))
    return shown.join(ranges, ["workbook", "sheet"], "left")


_SHEETS_SQL = f"""
SELECT {_BOOK} AS workbook, 'Commandes & co' AS sheet, 0 AS ordinal, 'visible' AS sheet_state, max(o_orderkey % 1000) + 2 AS last_row, 5 AS last_col, 2 AS merged_to
FROM orders GROUP BY 1
UNION ALL SELECT DISTINCT {_BOOK}, 'cachée', 1, 'hidden', 1, 1, NULL FROM orders
"""

# --- packages as files, read part by part ------------------------------------------------------

def _stored(batches):
    """Write packages as files below ``folder``; a task that runs again writes the same files."""
    import pandas as pd
    from pyarrow import fs

    for batch in batches:
        for workbook, content, folder in zip(batch["workbook"], batch["content"], batch["folder"]):
            system, inside = fs.FileSystem.from_uri(folder)
            system.create_dir(inside, recursive=True)
            with system.open_output_stream(f"{inside}/{workbook}") as file:
                file.write(content)
            yield pd.DataFrame([[workbook, f"{folder}/{workbook}"]], columns=["workbook", "path"])


def _files(spark, books):
    folder = f"{checkpoint_folder(spark).rstrip('/')}/packages-{uuid.uuid4().hex}"
    folder = folder if "://" in folder else re.sub("^(file:)?/*", "file:///", folder)
    return store_files(books.withColumn("folder", F.lit(folder)))


def store_files(books):
    """(workbook, path) of packages (workbook, content, folder) written as files."""
    return settle(books.mapInPandas(_stored, "workbook string, path string"))


def ingest_streamed(spark, sf_dir):
    """The cells of the same workbooks, stored as files and read part by part."""
    found = ingest_parts(unzip_parts(_files(spark, workbooks(spark, sf_dir))))
    return found.cells.select("workbook", "sheet", "row", "col", "raw", "kind", F.date_format("ts", "yyyy-MM-dd").alias("day"), "formula", "number_format")


def package_parts(spark, sf_dir):
    """The parts that each package lists, and how many tasks are given parts of it."""
    listed = list_parts(_files(spark, workbooks(spark, sf_dir)))
    return listed.groupBy("workbook").agg(
        F.count_if(F.col("part").like("%worksheets/sheet%")).alias("sheets"), F.count_if(F.col("part").like("%.rels")).alias("links"),
        F.count_if(F.col("fault").isNotNull()).alias("faults"))


_PARTS_SQL = f"SELECT DISTINCT {_BOOK} AS workbook, 2 AS sheets, 1 AS links, 0 AS faults FROM orders"


def pack_faulty(key, frame):
    """Every third workbook is cut off, every third has a sheet with an end tag missing in the middle."""
    import pandas as pd

    book = pack_orders(key, frame)
    content, kind = book["content"][0], int(key[0]) % 3
    if kind == 1:
        content = content[: len(content) // 2]
    if kind == 2:
        with zipfile.ZipFile(io.BytesIO(content)) as archive:
            parts = {n: archive.read(n) for n in archive.namelist()}
        sheet = "xl/worksheets/sheet1.xml"
        parts[sheet] = parts[sheet].replace(b"</v></c>", b"</c>", 1)
        buffer = io.BytesIO()
        with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as archive:
            for name, text in parts.items():
                archive.writestr(name, text)
        content = buffer.getvalue()
    return pd.DataFrame([[book["workbook"][0], content]], columns=["workbook", "content"])


def bad_packages(spark, sf_dir):
    """What cannot be read of good, cut and malformed packages, and the sheets of which cells are left."""
    orders = table(spark, sf_dir, "orders").withColumn("book", F.floor(F.col("o_orderkey") / 1000))
    found = ingest_parts(unzip(orders.groupBy("book").applyInPandas(pack_faulty, "workbook string, content binary")))
    faults = found.faults.select("workbook", "sheet", F.when(F.col("fault").startswith("malformed"), "malformed").otherwise("unreadable").alias("state"))
    read = found.cells.select("workbook", "sheet", F.lit("read").alias("state")).distinct()
    return faults.distinct().unionByName(read)


_BAD_SQL = f"""
SELECT DISTINCT {_BOOK} AS workbook, CASE (o_orderkey // 1000) % 3 WHEN 1 THEN '' ELSE 'Commandes & co' END AS sheet,
  CASE (o_orderkey // 1000) % 3 WHEN 0 THEN 'read' WHEN 1 THEN 'unreadable' ELSE 'malformed' END AS state
FROM orders
"""

REPORTS = {
    "ingest_cells": (ingest_cells, _CELLS_SQL), "ingest_sheets": (ingest_sheets, _SHEETS_SQL), "ingest_streamed": (ingest_streamed, _CELLS_SQL),
    "package_parts": (package_parts, _PARTS_SQL), "bad_packages": (bad_packages, _BAD_SQL),
}
