"""The batch run: workbooks in, published tables, rejections and manifest out.

Each stage is a written table in a shared folder, so that its consumers read it instead of computing
it again and a lost executor costs no more than its own tasks.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession, functions as F

from gridspark import fixed
from gridspark.model import SHEET, VALIDATE, issue, read_cells, write_cells
from gridspark.operators.banding import meet
from gridspark.plans import checks
from gridspark.plans.activity import extract_activity
from gridspark.plans.common import Extraction, union_all
from gridspark.plans.competitor import extract_quarterly, extract_staging, extract_summary
from gridspark.plans.details import details_lines, extract_details
from gridspark.plans.penetration import extract_penetration
from gridspark.plans.pivots import extract_concession, extract_pivot_staging
from gridspark.plans.routing import Rules, check_rules, route_report, routing_issues, setting
from gridspark.plans.variation import extract_variation
from gridspark.sinks.reports import manifest_entries, write_manifest, write_rejections
from gridspark.sinks.snapshots import read_snapshot, snapshot, write_snapshot
from gridspark.sinks.tables import write_lines, write_tables
from gridspark.sources.pivots import page_filters
from gridspark.sources.workbooks import (
    checked_cells_of, chunk_faults, discover, discover_paths, package_faults, read_merged_of, read_sheets_of, readable, true_cells,
    unzip, unzip_parts,
)


@dataclass(frozen=True)
class Table:
    """One published table: how its rows are made, checked and ordered."""

    family: str
    extract: Callable[..., Extraction]
    check: Callable[[DataFrame], DataFrame]
    order: tuple[str, ...]
    side: tuple[str, ...] = ()


TABLES = {
    "activity": Table(fixed.ACTIVITY, extract_activity, checks.check_activity, ("row",)),
    "summary": Table(fixed.SUMMARY, extract_summary, checks.check_summary, ("section_ord", "category_ord", "row")),
    "staging": Table(fixed.SUMMARY, extract_staging, checks.check_staging, ("section_ord", "row"), ("merged",)),
    "quarterly": Table(fixed.QUARTERLY, extract_quarterly, checks.check_quarterly,
                       ("section_ord", "category_ord", "row")),
    "details": Table(fixed.DETAILS, extract_details, checks.check_details, ("row",)),
    "penetration": Table(fixed.PENETRATION, extract_penetration, checks.check_penetration,
                         ("row", "table_ord", "col")),
    "concession": Table(fixed.CONCESSION, extract_concession, checks.check_concession, ("row", "label_col")),
    "pivot_staging": Table(fixed.PIVOT_STAGING, extract_pivot_staging, checks.check_pivot_staging,
                           ("row", "bloc_index", "col"), ("page_filters",)),
    "variation": Table(fixed.VARIATION, extract_variation, checks.check_variation,
                       ("row", "table_ord", "axis_ord")),
}


def stage_folder(spark: SparkSession, output: str) -> str:
    """Folder for stage tables: below the one the cluster names, else below the output."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    return f"{(shared or output).rstrip('/')}/stages-{uuid.uuid4().hex}"


def staged(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def check_table(name: str, rows: DataFrame, routed: DataFrame) -> DataFrame:
    """Validation issues of a table. Flat sheets with layout ``flat`` have no fixed fields."""
    if name != "details":
        return TABLES[name].check(rows)
    flat = routed.filter(F.coalesce(setting("layout"), F.lit("summary")) == "flat").select(*SHEET)
    detailed = meet(rows, flat, SHEET, how="left_anti")
    required = F.array(*[F.lit(c) for c in fixed.HEADERS["details"]])
    lacking = detailed.filter(F.size(F.array_except(required, F.col("names"))) > 0)
    missing = lacking.select(*SHEET).distinct().select(
        *issue("schema", "header lacks a required detail field", stage=VALIDATE))
    return union_all([TABLES[name].check(detailed), missing])


def run_batch(spark: SparkSession, input_path: str, output: str, rules: Rules,
              previous: str | None = None, separator: str = ";", bom: bool = True, streamed: bool = True) -> DataFrame:
    """Process every workbook; returns the verdicts.

    Writes ``tables/<table>``, ``rejections``, ``issues``, ``manifests`` and ``snapshot`` below ``output``.
    ``previous`` is the output of the run before: the snapshot refers to it, or to what it refers to, for all that this
    run did not judge. Packages are ``streamed`` part by part; for a store that only Spark can open, say False.
    """
    faults = check_rules(rules).orderBy("check", "subject").limit(20).collect()
    if faults:
        raise ValueError("Faulty rules: " + "; ".join(f"{f.check} {f.subject}: {f.message}" for f in faults))
    started = datetime.now(timezone.utc).isoformat()
    work = stage_folder(spark, output)
    whole = unzip_parts(discover_paths(spark, input_path)) if streamed else unzip(discover(spark, input_path))
    parts = staged(whole, f"{work}/parts")
    broken = package_faults(parts)
    parts = readable(parts, broken)
    write_cells(checked_cells_of(parts), f"{work}/cells")
    checked = read_cells(spark, f"{work}/cells")
    cells = true_cells(checked)
    sheets = staged(read_sheets_of(parts, cells), f"{work}/sheets")
    report = staged(route_report(sheets, rules), f"{work}/report")
    routed = report.filter("outcome = 'routed'").select(
        *SHEET, "ordinal", "last_row", "last_col", "family", "structure")
    side = {
        "merged": staged(read_merged_of(parts), f"{work}/merged"),
        "page_filters": staged(page_filters(parts), f"{work}/page_filters"),
    }
    # Formulas and errors are few; they are asked about, and no list of all visited cells is made.
    suspect = staged(checks.suspects(cells), f"{work}/suspects")
    results: dict[str, DataFrame] = {}
    # A package that cannot be read has no sheets; its issue names the workbook alone.
    unread = broken.withColumn("sheet", F.lit("")).select(*issue("package", F.col("fault")))
    malformed = chunk_faults(checked, parts).select(*issue("package", F.col("fault")))
    issues = [routing_issues(report), unread, malformed]
    present = {r.family for r in routed.select("family").distinct().collect()}  # of the few known families
    for name, table in ((n, t) for n, t in TABLES.items() if t.family in present):
        extraction = table.extract(cells, routed, *[side[s] for s in table.side])
        rows = staged(extraction.rows, f"{work}/rows/{name}")
        audit = checks.audit(suspect, extraction.visits(suspect), rules.error_policy, rules.missing_cache_policy)
        found = union_all([extraction.issues, audit, check_table(name, rows, routed)])
        issues.append(staged(found, f"{work}/issues/{name}"))
        results[name] = rows
    all_issues = staged(union_all(issues), f"{output}/issues")
    counted = [r.groupBy(*SHEET).agg(F.count("*").alias("rows")) for r in results.values()]
    counts = union_all(counted) if counted else spark.createDataFrame([], "workbook string, sheet string, rows bigint")
    judged = report.filter(F.col("outcome").isin("routed", "family_mismatch", "routed_twice",
                                                 "ambiguous_name", "ambiguous_workbook"))
    verdicts = staged(checks.verdict(judged.select(*SHEET, "ordinal", "family"), counts, all_issues),
                      f"{work}/verdicts")
    layout = F.coalesce(setting("layout"), F.lit("summary"))
    table_of = F.when((F.col("family") == fixed.SUMMARY) & (layout == "staging"), "staging")
    for name, table in TABLES.items():
        table_of = table_of.when(F.col("family") == table.family, name)
    placed = staged(verdicts.join(routed.select(*SHEET, "structure"), SHEET, "left").withColumn("table", table_of).drop("structure"),
                    f"{work}/placed")
    for name, rows in results.items():
        mine, path = placed.filter(F.col("table") == name), f"{output}/tables/{name}"
        if name == "details":
            write_lines(details_lines(rows, mine, separator, bom), path)
        else:
            write_tables(rows, mine, list(fixed.HEADERS[name]), list(TABLES[name].order), path, separator, bom)
    write_rejections(all_issues, f"{output}/rejections")
    finished = datetime.now(timezone.utc).isoformat()
    read = sheets.select("workbook").unionByName(broken.select("workbook"))
    parsers = {name: table.extract.__name__ for name, table in TABLES.items()}
    write_manifest(manifest_entries(placed, read, all_issues, parsers, started, finished), f"{output}/manifests")
    write_snapshot(snapshot(placed, read, output, None if previous is None else read_snapshot(spark, previous)), output)
    return verdicts
