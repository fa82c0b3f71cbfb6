"""Tables written as published and read back: content, order and status, over one run and over two."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from gridspark.model import SHEET
from gridspark.operators.settling import checkpoint_folder, settle
from gridspark.sinks.snapshots import current_table, read_snapshot, snapshot, write_snapshot
from gridspark.sinks.tables import read_tables, write_tables
from reports.grids import money, table

_KEY = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
_FIELDS = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")


def _folder(spark: SparkSession) -> str:
    return f"{checkpoint_folder(spark).rstrip('/')}/published-{uuid.uuid4().hex}"


def written_order(spark, sf_dir):
    """Every line item as four lines of one sheet (and some of another), written in many files and read back."""
    lines = table(spark, sf_dir, "lineitem")
    entries = F.posexplode(F.array(*[F.struct(F.lit(f).alias("field"), money(f).alias("montant_mad")) for f in _FIELDS]))
    rows = lines.select(
        F.lit("lignes.xlsx").alias("workbook"), F.when(F.col("l_linenumber") == 7, "autres").otherwise("lignes").alias("sheet"),
        F.col("l_orderkey").alias("row"), *_KEY, entries.alias("k", "e"))
    rows = rows.select("*", F.concat_ws("; ", *[F.col(c).cast("string") for c in _KEY], "e.field").alias("label"), "e.montant_mad", (F.col("e.montant_mad") * 100).cast("bigint").alias("cents"))
    verdicts = rows.groupBy(*SHEET).agg(F.lit("success").alias("status"), F.count("*").alias("rows"))
    folder = _folder(spark)
    write_tables(rows, verdicts, ["label", "montant_mad"], [*_KEY, "k", "cents"], folder)
    return read_tables(spark, folder, ["label", "montant_mad"]).select(
        "status", "sheet_slug", F.col("_order").alias("place"), "label", "montant_mad")


_ORDER_SQL = f"""
WITH e AS (
  SELECT {", ".join(_KEY)}, CASE WHEN l_linenumber = 7 THEN 'autres' ELSE 'lignes' END AS sheet_slug, unnest(range(0, 4)) AS k,
    unnest([{", ".join(f"CAST({f} AS DECIMAL(18,2))" for f in _FIELDS)}]) AS v, unnest([{", ".join(f"'{f}'" for f in _FIELDS)}]) AS field
  FROM lineitem)
SELECT 'success' AS status, sheet_slug, row_number() OVER (PARTITION BY sheet_slug ORDER BY {", ".join(_KEY)}, k, v) AS place,
  concat_ws('; ', {", ".join(_KEY)}, field) AS label, CAST(CAST(round(v, 0) AS DECIMAL(18,0)) AS VARCHAR) AS montant_mad FROM e
"""


def _run(spark: SparkSession, orders: DataFrame, status, output: str, previous: str | None = None) -> None:
    rows = settle(orders.select(
        F.concat(F.lit("Suivi "), (F.col("c") % 5).cast("string"), F.lit(".xlsx")).alias("workbook"),
        F.concat(F.lit("Client n° "), F.col("c").cast("string")).alias("sheet"), "c", F.col("o_orderkey").alias("row"),
        F.col("o_orderpriority").alias("label"), money("o_totalprice").alias("value")))
    judged = rows.groupBy(*SHEET, "c").agg(F.count("*").alias("rows")).select(*SHEET, status.alias("status"), "rows", F.lit("suivi").alias("table"))
    write_tables(rows, judged, ["label", "value"], ["row"], f"{output}/tables/suivi")
    before = None if previous is None else read_snapshot(spark, previous)
    write_snapshot(snapshot(judged, judged, output, before), output)


def snapshots_taken_over(spark, sf_dir):
    """Two runs, the second over a third of the sheets: what each sheet shows after it, and the run that wrote it."""
    orders, folder = table(spark, sf_dir, "orders").withColumn("c", F.col("o_custkey") % 50), _folder(spark)
    _run(spark, orders, F.lit("success"), f"{folder}/one")
    again = orders.where("c % 3 = 0 and o_orderkey % 2 = 1")
    _run(spark, again, F.when(F.col("c") % 2 == 0, "rejected").otherwise("success"), f"{folder}/two", f"{folder}/one")
    rows = current_table(spark, f"{folder}/two", "suivi", ["label", "value"])
    runs = read_snapshot(spark, f"{folder}/two").where("sheet is not null").select(*SHEET, F.element_at(F.split("run", "/"), -1).alias("run"))
    return rows.join(runs, SHEET).select(*SHEET, "status", "run", F.col("_order").alias("place"), "label", "value")


_TAKEN_SQL = """
WITH o AS (SELECT *, o_custkey % 50 AS c FROM orders),
again AS (SELECT DISTINCT c FROM o WHERE c % 3 = 0 AND o_orderkey % 2 = 1),
k AS (SELECT o.*, again.c IS NOT NULL AS second FROM o LEFT JOIN again USING (c))
SELECT 'Suivi ' || (c % 5) || '.xlsx' AS workbook, 'Client n° ' || c AS sheet, CASE WHEN second AND c % 2 = 0 THEN 'rejected' ELSE 'success' END AS status,
  CASE WHEN second THEN 'two' ELSE 'one' END AS run, row_number() OVER (PARTITION BY c ORDER BY o_orderkey) AS place,
  o_orderpriority AS label, regexp_replace(regexp_replace(CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR), '(\\.\\d*?)0+$', '\\1'), '\\.$', '') AS value
FROM k WHERE NOT second OR o_orderkey % 2 = 1
"""

REPORTS = {"written_order": (written_order, _ORDER_SQL), "snapshots_taken_over": (snapshots_taken_over, _TAKEN_SQL)}
