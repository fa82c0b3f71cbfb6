"""Rejection reports and run manifests as JSON."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F

from gridspark.model import SHEET
from gridspark.operators.banding import band, look_up
from gridspark.sinks.tables import folders, workbook_slug


def reasons(issues: DataFrame, policy: str, name: str) -> DataFrame:
    """Messages per sheet and how often each occurs; a message repeated on many rows is one entry,
    so that a sheet with a fault on every row still has a short report."""
    counted = issues.filter(F.col("policy") == policy).groupBy(*SHEET, "kind", "message").agg(
        F.count("*").alias("n"), F.min("row").alias("first_row"))
    return counted.groupBy(*SHEET).agg(F.array_sort(F.collect_list(F.struct(
        "kind", "message", F.col("n").alias("count"), "first_row"))).alias(name))


def rejections(issues: DataFrame) -> DataFrame:
    """(workbook, sheet, reasons) of every rejected sheet."""
    return reasons(issues, "reject", "reasons")


def write_rejections(issues: DataFrame, path: str, mode: str = "errorifexists") -> None:
    rejections(issues).write.mode(mode).json(path)


def manifest(verdicts: DataFrame, issues: DataFrame, started_at: str, finished_at: str) -> DataFrame:
    """The sheets of each workbook with family, status, rows, errors and warnings, and its counts.

    A workbook is one row (``part`` 0); one with more sheets than a band is cut into parts, each
    with the counts of the whole.
    """
    sheets = (
        verdicts.join(reasons(issues, "reject", "errors"), SHEET, "left")
        .join(reasons(issues, "warning", "warnings"), SHEET, "left")
        .withColumn("part", band(F.coalesce("ordinal", F.lit(0))))
    )
    totals = verdicts.groupBy("workbook").agg(
        F.count_if(F.col("status") == "success").alias("success_count"),
        F.count_if(F.col("status") == "rejected").alias("rejected_count"))
    entry = F.struct("ordinal", "sheet", "family", "status", "rows", "errors", "warnings")
    parts = sheets.groupBy("workbook", "part").agg(F.array_sort(F.collect_list(entry)).alias("sheets"))
    return parts.join(totals, "workbook").select(
        "workbook", "part", F.lit(started_at).alias("started_at"), F.lit(finished_at).alias("finished_at"),
        "sheets", "success_count", "rejected_count")


def manifest_entries(judged: DataFrame, workbooks: DataFrame, issues: DataFrame, parsers: Mapping[str, str], started_at: str,
                     finished_at: str) -> DataFrame:
    """One row per judged sheet, of one shape at every size: family, parser, status, rows, output, errors and warnings, with
    the times of the run and the counts of the sheet's workbook. A workbook without a judged sheet is a row without one.

    ``judged`` is (workbook, sheet, ordinal, family, status, rows, table), ``workbooks`` every name that the run read, and
    ``parsers`` names the extractor of each table. ``output`` is the folder below the run's own.
    """
    places = folders(judged)
    kept = (F.col("rows") > 0) | (F.col("status") == "success")
    path = F.concat(F.lit("tables/"), "table", F.lit("/status="), "status", F.lit("/workbook_slug="), "workbook_slug", F.lit("/sheet_slug="), "sheet_slug")
    parser = F.lit(None).cast("string")
    for table, name in parsers.items():
        parser = F.when(F.col("table") == table, name).otherwise(parser)
    entries = (
        judged.select(*SHEET, "ordinal", "family", "table").join(places, SHEET)
        .join(reasons(issues, "reject", "errors"), SHEET, "left").join(reasons(issues, "warning", "warnings"), SHEET, "left")
        .select(*SHEET, "ordinal", "family", parser.alias("parser"), "status", "rows", F.when(kept, path).otherwise("rejections").alias("output"),
                "errors", "warnings"))
    counts = judged.groupBy("workbook").agg(
        F.count_if(F.col("status") == "success").alias("success_count"), F.count_if(F.col("status") == "rejected").alias("rejected_count"))
    books = workbooks.select("workbook").distinct().join(counts, "workbook", "left").fillna(0, ["success_count", "rejected_count"])
    # Sheets meet their workbook by salts: one workbook may have most sheets.
    counted = look_up(entries, books, "workbook", ["sheet"], "inner")
    bare = books.join(counts.select("workbook"), "workbook", "left_anti")
    return counted.unionByName(bare, allowMissingColumns=True).withColumns({"started_at": F.lit(started_at), "finished_at": F.lit(finished_at)})


def write_manifest(manifests: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """One folder per workbook; the entries of a large one are spread over files."""
    manifests.withColumn("workbook_slug", workbook_slug(F.col("workbook"))).write.mode(mode).partitionBy(
        "workbook_slug").json(path)
