"""Snapshots of runs: what each sheet and workbook last gave, by reference to the run that wrote it.

A run writes only what it judged. Its ``snapshot`` table has a row for every sheet that it or an earlier run judged,
with the folder of the run that holds the sheet's table, issues and rejection, and a row without a sheet for every
workbook, with the run that holds its manifest. What a run did not touch keeps its reference, so nothing is copied,
flat tables included, and a sheet is in one status only.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from gridspark.model import ISSUES, SHEET
from gridspark.sinks.tables import PARTITIONS, folders, read_tables, workbook_slug

SNAPSHOT = ("workbook string, sheet string, workbook_slug string, sheet_slug string, table string, status string, "
            "rows bigint, run string")
_REASONS = "array<struct<kind:string,message:string,count:bigint,first_row:bigint>>"
REJECTION = f"workbook string, sheet string, reasons {_REASONS}"
MANIFEST = ("workbook string, sheet string, ordinal int, family string, parser string, status string, rows bigint, output string, "
            f"errors {_REASONS}, warnings {_REASONS}, started_at string, finished_at string, success_count bigint, rejected_count bigint")


def snapshot(judged: DataFrame, workbooks: DataFrame, run: str, previous: DataFrame | None = None) -> DataFrame:
    """SNAPSHOT rows after a run. ``judged`` is (workbook, sheet, status, rows, table), ``workbooks`` the names of all
    that the run read, also those without a judged sheet."""
    places = folders(judged).join(judged.select(*SHEET, "table"), SHEET)
    names = [c.split()[0] for c in SNAPSHOT.split(", ")]
    sheets = places.withColumn("run", F.lit(run)).select(names)
    blank = lambda name, kind="string": F.lit(None).cast(kind).alias(name)
    books = workbooks.select("workbook").distinct().select(
        "workbook", blank("sheet"), workbook_slug(F.col("workbook")).alias("workbook_slug"), blank("sheet_slug"), blank("table"),
        blank("status"), blank("rows", "bigint"), F.lit(run).alias("run"))
    current = sheets.unionByName(books)
    if previous is None:
        return current
    old, new = previous.alias("o"), current.select(*SHEET).alias("n")
    same = (F.col("o.workbook") == F.col("n.workbook")) & F.col("o.sheet").eqNullSafe(F.col("n.sheet"))
    return current.unionByName(old.join(new, same, "left_anti").select(names))


def write_snapshot(entries: DataFrame, output: str, mode: str = "errorifexists") -> None:
    entries.write.mode(mode).parquet(f"{output}/snapshot")


def read_snapshot(spark: SparkSession, output: str) -> DataFrame:
    return spark.read.schema(SNAPSHOT).parquet(f"{output}/snapshot")


def _from_runs(entries: DataFrame, read: Callable[[str, DataFrame], DataFrame]) -> DataFrame | None:
    """``read`` of each run that some entry refers to, with the entries of that run; there is one a run, not a sheet."""
    runs = [r.run for r in entries.select("run").distinct().orderBy("run").collect()]
    parts = [read(run, entries.where(F.col("run") == run)) for run in runs]
    return reduce(DataFrame.unionByName, parts) if parts else None


def current_table(spark: SparkSession, output: str, table: str, columns: Sequence[str], separator: str = ";") -> DataFrame | None:
    """The rows of a table as of the run in ``output``, whichever run wrote them, with ``workbook``, ``sheet`` and ``_order``;
    None when no sheet has any."""
    mine = read_snapshot(spark, output).where((F.col("table") == table) & ((F.col("rows") > 0) | (F.col("status") == "success")))

    def read(run: str, entries: DataFrame) -> DataFrame:
        rows = read_tables(spark, f"{run}/tables/{table}", columns, separator)
        return rows.join(entries.select(*SHEET, *PARTITIONS), PARTITIONS).select(*SHEET, "status", *columns, "_order")

    return _from_runs(mine, read)


def current_issues(spark: SparkSession, output: str) -> DataFrame:
    """The issues of every sheet and workbook as of the run in ``output``."""
    def read(run: str, entries: DataFrame) -> DataFrame:
        issues, keys = spark.read.schema(ISSUES).parquet(f"{run}/issues"), entries.select("workbook", F.coalesce("sheet", F.lit("")).alias("sheet"))
        return issues.join(keys, SHEET, "left_semi")

    found = _from_runs(read_snapshot(spark, output), read)
    return found if found is not None else spark.createDataFrame([], ISSUES)


def current_rejections(spark: SparkSession, output: str) -> DataFrame | None:
    """The rejection reports of the sheets that are rejected as of the run in ``output``."""
    mine = read_snapshot(spark, output).where("status = 'rejected'")
    return _from_runs(mine, lambda run, entries: spark.read.schema(REJECTION).json(f"{run}/rejections").join(
        entries.select(*SHEET), SHEET, "left_semi"))


def current_manifests(spark: SparkSession, output: str) -> DataFrame | None:
    """The manifest entries of every workbook, from the last run that read it."""
    mine = read_snapshot(spark, output).where("sheet is null")
    return _from_runs(mine, lambda run, entries: spark.read.schema(MANIFEST).json(f"{run}/manifests").join(
        entries.select("workbook"), "workbook", "left_semi"))
