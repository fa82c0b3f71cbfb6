"""Routing of many workbooks by a small set of rules."""

from __future__ import annotations

from pyspark.sql import functions as F

from gridspark import fixed
from gridspark.plans import routing as R
from reports.grids import table

FAMILIES = {
    fixed.ACTIVITY: {"family_sheets": ["GLOBAL"]},
    fixed.DETAILS: {"family_sheets": ["Détails"]},
    fixed.VARIATION: {"family_sheets": ["Table"]},
    fixed.CONCESSION: {"family_sheets": ["Concession"]},
    fixed.QUARTERLY: {"enabled": False, "family_sheets": ["Trimestre"]},
}
WORKBOOKS = {
    "defaults": {"sheets": {
        "GLOBAL": {"family": fixed.ACTIVITY, "label_column": "A", "limits": {"first_row": 1, "last_row": 117}},
        "Détails": {"family": fixed.DETAILS, "layout": "details"},
        "Concession": {"family": fixed.DETAILS},
        "Trimestre": {"family": fixed.QUARTERLY},
    }},
    "workbooks": [
        {"file_name": "Book  1.xlsx", "enabled_families": [fixed.ACTIVITY, fixed.DETAILS],
         "sheets": {"global": {"limits": {"last_row": 200}}}},
        {"file_name": "book 2.xlsx", "inherit_defaults": False, "sheets": {"Global": {"family": fixed.ACTIVITY, "label_column": "B"}}},
        {"file_name": "book 3.xlsx"}, {"file_name": "BOOK 3.xlsx"},
    ],
}


def sheets(spark, sf_dir):
    """A workbook per document: its sheets depend on language and quality."""
    docs = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    entry = lambda name, when=None, state="visible": F.when(
        F.lit(True) if when is None else when, F.struct(F.lit(name).alias("sheet"), (
            state if not isinstance(state, str) else F.lit(state)).alias("state")))
    listed = F.array_compact(F.array(
        entry("  Global "), entry("détails", state=F.when(F.col("quality") == 1, "visible").otherwise("hidden")),
        entry("TABLE", F.col("lang") == "en"), entry("Concession"), entry("Trimestre"), entry("Divers"),
        entry("divers ", F.col("lang") == "fr")))
    return docs.select(
        F.concat(F.lit("book "), F.col("doc_id").cast("string"), F.lit(".xlsx")).alias("workbook"),
        F.posexplode(listed).alias("ordinal", "s"),
    ).select("workbook", F.col("s.sheet").alias("sheet"), "ordinal", F.col("s.state").alias("sheet_state"),
             F.lit(10).cast("bigint").alias("last_row"), F.lit(5).alias("last_col"))


def _rules(spark):
    return R.rules_from_mappings(spark, FAMILIES, WORKBOOKS)


def route_report(spark, sf_dir):
    return R.route_report(sheets(spark, sf_dir), _rules(spark)).select("workbook", "sheet", "sheet_key", "outcome")


_DOCS = "(SELECT doc_id, lang, quality FROM documents LEFT JOIN labels USING (doc_id))"
_ROUTE_SQL = f"""
WITH s AS (
  SELECT doc_id, lang, quality, unnest(CASE WHEN lang = 'en' THEN ['  Global ', 'détails', 'TABLE', 'Concession', 'Trimestre', 'Divers']
    WHEN lang = 'fr' THEN ['  Global ', 'détails', 'Concession', 'Trimestre', 'Divers', 'divers ']
    ELSE ['  Global ', 'détails', 'Concession', 'Trimestre', 'Divers'] END) AS sheet FROM {_DOCS}),
k AS (SELECT *, lower(trim(sheet)) AS sheet_key FROM s)
SELECT 'book ' || doc_id || '.xlsx' AS workbook, sheet, sheet_key,
  CASE WHEN sheet_key = 'divers' AND lang = 'fr' THEN 'ambiguous_name' WHEN doc_id = 3 THEN 'ambiguous_workbook'
    WHEN sheet_key IN ('divers', 'trimestre') OR (doc_id = 1 AND sheet_key IN ('table', 'concession')) THEN 'not_configured'
    WHEN sheet_key = 'détails' AND coalesce(quality, 0) <> 1 THEN 'hidden'
    WHEN sheet_key = 'table' OR (doc_id = 2 AND sheet_key <> 'global') THEN 'no_structure'
    WHEN sheet_key = 'concession' THEN 'family_mismatch' ELSE 'routed' END AS outcome FROM k
UNION ALL SELECT 'book ' || doc_id || '.xlsx', NULL, 'table', 'not_found' FROM {_DOCS} WHERE lang <> 'en' AND doc_id <> 1
"""


def route(spark, sf_dir):
    routed = R.route(sheets(spark, sf_dir), _rules(spark))
    return routed.select("workbook", "sheet", "family", F.element_at("structure", F.lit("limits.last_row")).alias("to"))


_ROUTED_SQL = f"""
WITH o AS ({_ROUTE_SQL})
SELECT workbook, sheet, CASE sheet_key WHEN 'global' THEN '{fixed.ACTIVITY}' ELSE '{fixed.DETAILS}' END AS family,
  CASE WHEN sheet_key <> 'global' OR workbook = 'book 2.xlsx' THEN NULL WHEN workbook = 'book 1.xlsx' THEN '200' ELSE '117' END AS to
FROM o WHERE outcome = 'routed'
"""


def sheet_index(spark, sf_dir):
    return R.sheet_index(sheets(spark, sf_dir)).filter("same_key > 1").select("workbook", "sheet", "same_key")


_INDEX_SQL = "SELECT 'book ' || doc_id || '.xlsx' AS workbook, unnest(['Divers', 'divers ']) AS sheet, 2 AS same_key FROM documents WHERE lang = 'fr'"


def effective_rules(spark, sf_dir):
    rules = _rules(spark)
    wanted = table(spark, sf_dir, "documents").select(
        F.concat(F.lit("book "), F.col("doc_id").cast("string"), F.lit(".xlsx")).alias("workbook_key"), F.lit("global").alias("sheet_key"))
    leaf = lambda path: F.element_at("structure", F.lit(path))
    return R.effective_rules(wanted, rules.structures, rules.workbooks).select(
        "workbook_key", "entries", leaf("label_column").alias("label"), leaf("limits.first_row").alias("first_row"), leaf("limits.last_row").alias("last_row"))


_EFFECTIVE_SQL = """
SELECT 'book ' || doc_id || '.xlsx' AS workbook_key, CASE WHEN doc_id = 3 THEN 2 ELSE 1 END AS entries, CASE WHEN doc_id = 2 THEN 'B' ELSE 'A' END AS label,
  CASE WHEN doc_id <> 2 THEN '1' END AS first_row, CASE doc_id WHEN 1 THEN '200' WHEN 2 THEN NULL ELSE '117' END AS last_row FROM documents
"""


def check_rules(spark, sf_dir):
    """Faults of rules drawn from the tables: owners by nation, a layout per customer."""
    nation, customer = table(spark, sf_dir, "nation"), table(spark, sf_dir, "customer")
    family = lambda k: F.when(k % 5 == 0, F.lit("unknown")).otherwise(F.lit(fixed.ACTIVITY))
    key = lambda k: F.concat(F.lit("sheet "), k.cast("string"))
    k, c = F.col("n_nationkey"), F.col("c_custkey")
    owners = nation.select(family(k).alias("family"), key(k).alias("sheet_key"), F.lit(True).alias("enabled")).unionByName(
        nation.filter("n_regionkey = 1").select(F.lit(fixed.ACTIVITY).alias("family"), key(k).alias("sheet_key"), F.lit(True).alias("enabled")))
    limit = F.create_map(
        F.lit("family"), F.lit(fixed.ACTIVITY), F.lit("limits.first_row"), (c % 100).cast("string"), F.lit("limits.last_row"), F.lit("50"),
        F.lit("limits.first_column"), F.lit("1"), F.lit("limits.last_column"), F.lit("9"),
        F.lit("label_column"), F.when(F.col("c_mktsegment") == "MACHINERY", "7").otherwise("A"))
    structures = customer.select(F.concat(F.lit("b"), c.cast("string")).alias("workbook_key"), key(c % 30).alias("sheet_key"), limit.alias("structure"))
    books = customer.select(F.concat(F.lit("b"), c.cast("string")).alias("workbook_key"), F.lit(True).alias("inherit_defaults"),
                            F.when(F.col("c_nationkey") == 0, F.array(F.lit("nowhere"))).when(
                                F.col("c_nationkey") == 1, F.array().cast("array<string>")).alias("enabled_families"))
    faults = R.check_rules(R.Rules(owners, structures, books, "reject", "ignore"))
    return faults.groupBy("check", "subject").agg(F.count("*").alias("n"))


_CHECK_SQL = f"""
WITH o AS (SELECT 'sheet ' || n_nationkey AS k, CASE WHEN n_nationkey % 5 = 0 THEN 'unknown' ELSE '{fixed.ACTIVITY}' END AS f FROM nation
  UNION ALL SELECT 'sheet ' || n_nationkey, '{fixed.ACTIVITY}' FROM nation WHERE n_regionkey = 1),
s AS (SELECT c_custkey, c_mktsegment, c_nationkey, 'sheet ' || (c_custkey % 30) AS k FROM customer)
SELECT 'policy' AS "check", 'missing_formula_cache_policy' AS subject, 1 AS n
UNION ALL SELECT 'unknown_family', 'unknown', 1
UNION ALL SELECT 'two_owners', k, 1 FROM o GROUP BY k HAVING count(*) > 1
UNION ALL SELECT 'unowned_sheet', k, count(*) FROM s WHERE k NOT IN (SELECT k FROM o) GROUP BY k
UNION ALL SELECT 'family_mismatch', s.k, count(*) FROM s JOIN o ON s.k = o.k WHERE o.f <> '{fixed.ACTIVITY}' GROUP BY s.k
UNION ALL SELECT 'limits', k, count(*) FROM s WHERE c_custkey % 100 > 50 GROUP BY k
UNION ALL SELECT 'column', k, count(*) FROM s WHERE c_mktsegment = 'MACHINERY' GROUP BY k
UNION ALL SELECT 'enabled_families', 'b' || c_custkey, 1 FROM s WHERE c_nationkey = 1
UNION ALL SELECT 'unknown_family', 'nowhere', count(*) FROM s WHERE c_nationkey = 0 HAVING count(*) > 0
"""

REPORTS = {
    "route_report": (route_report, _ROUTE_SQL), "route": (route, _ROUTED_SQL), "sheet_index": (sheet_index, _INDEX_SQL),
    "effective_rules": (effective_rules, _EFFECTIVE_SQL), "check_rules": (check_rules, _CHECK_SQL),
}
