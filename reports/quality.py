"""Audit, validation, verdicts and published text over whole tables with faults in them."""

from __future__ import annotations

from pyspark.sql import Window, functions as F

from gridspark import fixed
from gridspark.functions.numeric import to_measure
from gridspark.model import SHEET
from gridspark.plans import checks as C
from gridspark.plans.details import extract_details
from gridspark.sinks import reports
from gridspark.sinks.reports import manifest, rejections
from gridspark.sinks.tables import published
from reports.families import flat_grid
from reports.grids import money, routed, table


def _book(df, sheet, row):
    return df.withColumns({"workbook": F.lit("book.xlsx"), "sheet": sheet.cast("string"), "row": row.cast("bigint")})


def _found(issues):
    return issues.select("sheet", "row", "kind", "policy", "stage")


def duplicate_keys(spark, sf_dir):
    rows = _book(table(spark, sf_dir, "customer"), F.lit("s"), F.col("c_custkey"))
    return _found(C.check_duplicate_keys(rows, ("c_nationkey", "c_mktsegment")))


_DUP_SQL = """
SELECT 's' AS sheet, c_custkey AS row, 'duplicate_key' AS kind, 'reject' AS policy, 'validate' AS stage
FROM customer QUALIFY row_number() OVER (PARTITION BY c_nationkey, c_mktsegment ORDER BY c_custkey) > 1
"""


def contiguity(spark, sf_dir):
    """Lines numbered per customer but checked per customer and status."""
    orders = _book(table(spark, sf_dir, "orders"), F.lit("s"), F.col("o_orderkey"))
    nth = F.row_number().over(Window.partitionBy("o_custkey").orderBy("o_orderkey"))
    rows = orders.withColumns({"ordre_ligne": nth, "organisme": F.col("o_custkey").cast("string"), "section": F.col("o_orderstatus")})
    return _found(C.check_contiguity(rows))


_CONT_SQL = """
WITH n AS (SELECT o_custkey, o_orderstatus, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS a,
             row_number() OVER (PARTITION BY o_custkey, o_orderstatus ORDER BY o_orderkey) AS b FROM orders)
SELECT 's' AS sheet, min(o_orderkey) AS row, 'contiguity' AS kind, 'reject' AS policy, 'validate' AS stage
FROM n WHERE a <> b GROUP BY o_custkey, o_orderstatus
"""


def market_consistency(spark, sf_dir):
    rows = _book(table(spark, sf_dir, "orders"), F.col("o_custkey"), F.col("o_orderkey")).withColumn(
        "maybe", F.nullif("o_orderpriority", F.lit("5-LOW")))
    return _found(C.check_market_consistency(rows, ["o_orderstatus"], ["maybe"]))


_CONSISTENT_SQL = """
SELECT CAST(o_custkey AS VARCHAR) AS sheet, CAST(NULL AS BIGINT) AS row, 'market_consistency' AS kind, 'reject' AS policy, 'validate' AS stage
FROM orders GROUP BY o_custkey, o_orderstatus HAVING count(DISTINCT o_orderpriority) > 1
"""


def exclusivity(spark, sf_dir):
    section = F.element_at(F.array(*[F.lit(s) for s in (*fixed.MONETARY_SECTIONS, fixed.RATIO_SECTION, "AUTRE")]),
                           (F.col("o_orderkey") % 6 + 1).cast("int"))
    rows = _book(table(spark, sf_dir, "orders"), F.lit("s"), F.col("o_orderkey")).select(
        *SHEET, "row", section.alias("section"), F.when(F.col("o_orderstatus") != "F", F.col("o_totalprice")).alias("money"),
        F.when(F.col("o_orderstatus") == "F", F.col("o_totalprice")).alias("ratio"))
    return C.check_exclusivity(rows, ["money"], ["ratio"]).select("sheet", "row", "kind", "message")


_EXCLUSIVE_SQL = """
SELECT 's' AS sheet, o_orderkey AS row, 'exclusivity' AS kind,
  CASE WHEN o_orderkey % 6 < 4 THEN 'monetary section contains ratio values' WHEN o_orderkey % 6 = 4 THEN 'ratio section contains monetary values'
       ELSE 'unexpected section' END AS message
FROM orders WHERE (o_orderkey % 6 < 4 AND o_orderstatus = 'F') OR (o_orderkey % 6 = 4 AND o_orderstatus <> 'F') OR o_orderkey % 6 = 5
"""


def row_checks(spark, sf_dir):
    """Totals, technical rows and scientific notation among part names."""
    word = F.element_at(F.array(*[F.lit(w) for w in ("x", "total", "1E5", "marché")]), (F.col("p_size") % 4 + 1).cast("int"))
    price = F.when(F.col("p_size") % 7 == 0, F.lit("0.0000001")).otherwise(money("p_retailprice").cast("string"))
    rows = _book(table(spark, sf_dir, "part"), F.col("p_brand"), F.col("p_partkey")).select(
        *SHEET, "row", word.alias("organisme"), to_measure(price).alias("value"))
    found = [C.check_no_total(rows), C.check_technical_rows(rows), C.check_notation(rows)]
    return _found(C.union_all(found))


_ROWS_SQL = """
WITH k AS (SELECT p_brand AS sheet, p_partkey AS row, CASE p_size % 4 WHEN 1 THEN 'total' WHEN 3 THEN 'technical_row' END AS kind FROM part
  UNION ALL SELECT p_brand, p_partkey, CASE WHEN p_size % 4 = 2 OR p_size % 7 = 0 THEN 'notation' END FROM part)
SELECT sheet, row, kind, 'reject' AS policy, 'validate' AS stage FROM k WHERE kind IS NOT NULL
"""


def domain_checks(spark, sf_dir):
    """Event rows as tables of four families, each with values outside their domain."""
    events = _book(table(spark, sf_dir, "events"), F.col("user_id"), F.col("event_id"))
    kind = F.col("event_type")
    measure = to_measure(F.when(kind == "view", "n.c.").when(kind == "click", "NS").otherwise(money("value").cast("string")))
    city = F.when(kind == "signup", "VILLE").when(kind == "error", "PAYS").otherwise("MARQUE")
    period = F.when(kind == "error", "JOUR").otherwise("MENSUEL")
    label = F.when(kind == "purchase", "Total général").otherwise("m")
    pen = events.select(*SHEET, "row", label.alias("marque"), F.lit("v").alias("ville"), period.alias("periodicite"), city.alias("dimension"),
                        F.when(kind != "click", "a").alias("axe"), F.lit("s").alias("sous_axe"), measure.alias("valeur"))
    con = events.select(*SHEET, "row", F.lit("g").alias("groupe_concessionnaire"), F.when(kind != "click", 2026).alias("annee"),
                        label.alias("marque"), measure.alias("aivam"), measure.alias("sofac"), measure.alias("total"), F.lit("marque").alias("row_type"))
    piv = pen.select(*SHEET, "row", F.lit(1).alias("bloc_index"), "axe", "periodicite", F.lit(2026).alias("annee"), F.lit("1").alias("mois"), "dimension", "marque", "ville",
                     F.lit("").alias("organisme"), "valeur")
    var = events.select(*SHEET, "row", F.when(kind == "error", "").otherwise("v").alias("ville"), F.lit("a").alias("axe"), measure.alias("valeur"))
    found = {"penetration": C.check_penetration(pen), "concession": C.check_concession(con),
             "pivot_staging": C.check_pivot_staging(piv), "variation": C.check_variation(var)}
    return C.union_all([d.groupBy("sheet", "kind", "message").agg(F.count("*").alias("n")).withColumn("family", F.lit(f)) for f, d in found.items()])


_DOMAIN_SQL = """
WITH e AS (SELECT CAST(user_id AS VARCHAR) AS sheet, event_type AS t FROM events),
f AS (
  SELECT sheet, 'penetration' AS family, 'dimension' AS kind, 'dimension is neither brand nor city' AS message FROM e WHERE t = 'error'
  UNION ALL SELECT sheet, 'penetration', 'dimension', 'a brand stands in a city row' FROM e WHERE t = 'signup'
  UNION ALL SELECT sheet, 'penetration', 'label', 'row without a label, or a total row' FROM e WHERE t = 'purchase'
  UNION ALL SELECT sheet, 'penetration', 'periodicite', 'unknown periodicity' FROM e WHERE t = 'error'
  UNION ALL SELECT sheet, 'penetration', 'axis', 'axis or sub-axis is blank' FROM e WHERE t = 'click'
  UNION ALL SELECT sheet, 'penetration', 'measure', 'valeur is neither a number nor a known marker' FROM e WHERE t = 'view'
  UNION ALL SELECT sheet, 'concession', 'group', 'no concession group, or no whole year' FROM e WHERE t = 'click'
  UNION ALL SELECT sheet, 'concession', 'row_type', 'row type does not fit the brand' FROM e WHERE t = 'purchase'
  UNION ALL SELECT sheet, 'concession', 'measure', m || ' is neither a number nor a known marker' FROM e, (VALUES ('aivam'), ('sofac'), ('total')) v(m) WHERE t = 'view'
  UNION ALL SELECT sheet, 'pivot_staging', 'dimension', 'block dimension is neither brand nor city' FROM e WHERE t = 'error'
  UNION ALL SELECT sheet, 'pivot_staging', 'dimension', 'a brand stands in a city row' FROM e WHERE t = 'signup'
  UNION ALL SELECT sheet, 'pivot_staging', 'organisme', 'block row without an organisation' FROM e
  UNION ALL SELECT sheet, 'pivot_staging', 'axis', 'block axis is blank or its periodicity unknown' FROM e WHERE t IN ('error', 'click')
  UNION ALL SELECT sheet, 'pivot_staging', 'measure', 'valeur is neither a number nor a known marker' FROM e WHERE t = 'view'
  UNION ALL SELECT sheet, 'variation', 'city', 'rate row without a city' FROM e WHERE t = 'error'
  UNION ALL SELECT sheet, 'variation', 'measure', 'valeur is neither a number nor a known marker' FROM e WHERE t = 'view')
SELECT sheet, kind, message, count(*) AS n, family FROM f GROUP BY ALL
"""


def _audited(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    row = F.col("l_orderkey") * 8 + F.col("l_linenumber")
    raw = F.when(F.col("l_returnflag") == "A", "#div/0!").when(F.col("l_returnflag") == "N", money("l_extendedprice").cast("string"))
    formula = F.when(F.col("l_linestatus") == "O", F.concat(F.lit("A1*#Ref!+#N/A+"), F.col("l_partkey").cast("string"))).when(
        F.col("l_quantity") > 25, F.lit("B2*2"))
    return _book(lines, F.concat(F.lit("s"), (F.col("l_suppkey")).cast("string")), row).select(
        *SHEET, "row", F.col("l_linenumber").alias("col"), raw.alias("raw"), F.lit("s").alias("kind"), formula.alias("formula"),
    ).distinct()


def audit(spark, sf_dir):
    """Faulty cells an extractor looked at: here those of the first five columns."""
    cells = _audited(spark, sf_dir)
    issues = C.audit(cells, cells.filter("col <= 5").select(*SHEET, "row", "col"), "reject", "warning")
    return issues.groupBy("sheet", "kind", "message", "policy").agg(F.count("*").alias("n"))


_AUDIT_SQL = """
WITH c AS (SELECT DISTINCT 's' || l_suppkey AS sheet, l_orderkey, l_linenumber,
    CASE l_returnflag WHEN 'A' THEN '#div/0!' WHEN 'N' THEN CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR) END AS raw,
    CASE WHEN l_linestatus = 'O' THEN 'A1*#Ref!+#N/A+' || l_partkey WHEN l_quantity > 25 THEN 'B2*2' END AS formula FROM lineitem WHERE l_linenumber <= 5),
i AS (SELECT sheet, 'error_value' AS kind, 'error value #div/0!' AS message, 'reject' AS policy FROM c WHERE raw = '#div/0!'
  UNION ALL SELECT sheet, 'formula_error', 'formula names an error: #N/A,#REF!', 'reject' FROM c WHERE formula LIKE 'A1%'
  UNION ALL SELECT sheet, 'missing_cache', 'formula without a stored value', 'warning' FROM c WHERE formula IS NOT NULL AND raw IS NULL)
SELECT sheet, kind, message, policy, count(*) AS n FROM i GROUP BY ALL
"""


def _judged(spark, sf_dir):
    """Sheets are customers; urgent orders reject at validation, those of status F at audit."""
    orders = _book(table(spark, sf_dir, "orders"), F.col("o_custkey"), F.col("o_orderkey"))
    customer = _book(table(spark, sf_dir, "customer"), F.col("c_custkey"), F.lit(0)).select(
        F.concat(F.lit("book "), F.col("c_nationkey").cast("string"), F.lit(".xlsx")).alias("workbook"), "sheet", F.col("c_custkey").cast("int").alias("ordinal"),
        F.lit("f").alias("family"))
    orders = orders.drop("workbook").join(customer.select(*SHEET), "sheet")
    urgent = F.col("o_orderpriority") == "1-URGENT"
    issues = orders.filter(urgent).select(
        *SHEET, "row", F.lit(None).cast("int").alias("col"), F.lit("k").alias("kind"), F.concat(F.lit("status "), "o_orderstatus").alias("message"),
        F.when(F.col("o_orderstatus") == "P", "warning").otherwise("reject").alias("policy"),
        F.when(F.col("o_orderstatus") == "F", "audit").otherwise("validate").alias("stage"))
    counts = orders.groupBy(*SHEET).agg(F.count("*").alias("rows"))
    return orders, customer, counts, issues


def verdict(spark, sf_dir):
    _, customer, counts, issues = _judged(spark, sf_dir)
    return C.verdict(customer, counts, issues).select("workbook", "sheet", "status", "rows")


_FACTS = """
WITH f AS (SELECT o_custkey, count(*) AS n, bool_or(o_orderpriority = '1-URGENT' AND o_orderstatus <> 'P') AS rej,
    bool_or(o_orderpriority = '1-URGENT' AND o_orderstatus = 'F') AS broken FROM orders GROUP BY 1),
v AS (SELECT 'book ' || c_nationkey || '.xlsx' AS workbook, CAST(c_custkey AS VARCHAR) AS sheet, c_custkey,
    CASE WHEN coalesce(rej, false) THEN 'rejected' ELSE 'success' END AS status, CASE WHEN coalesce(broken, false) THEN 0 ELSE coalesce(n, 0) END AS rows
  FROM customer LEFT JOIN f ON o_custkey = c_custkey)
"""


def apply_policy(spark, sf_dir):
    orders, _, _, issues = _judged(spark, sf_dir)
    return C.apply_policy(orders, issues).select("sheet", "o_orderkey")


def rejection_report(spark, sf_dir):
    _, _, _, issues = _judged(spark, sf_dir)
    return rejections(issues).select("workbook", "sheet", F.explode("reasons").alias("r")).select(
        "workbook", "sheet", "r.message", F.col("r.count").alias("n"), F.col("r.first_row").alias("first_row"))


_REJECTED_SQL = """
SELECT 'book ' || c_nationkey || '.xlsx' AS workbook, CAST(o_custkey AS VARCHAR) AS sheet, 'status ' || o_orderstatus AS message, count(*) AS n, min(o_orderkey) AS first_row
FROM orders JOIN customer ON c_custkey = o_custkey WHERE o_orderpriority = '1-URGENT' AND o_orderstatus <> 'P' GROUP BY ALL
"""


def run_manifest(spark, sf_dir):
    _, customer, counts, issues = _judged(spark, sf_dir)
    m = manifest(C.verdict(customer, counts, issues), issues, "t0", "t1")
    return m.select("workbook", "part", "success_count", "rejected_count", F.size("sheets").alias("n_sheets"),
                    F.aggregate("sheets", F.lit(0).cast("bigint"), lambda a, s: a + s["rows"]).alias("rows"))


_MANIFEST_SQL = _FACTS + """
, t AS (SELECT workbook, count_if(status = 'success') AS success_count, count_if(status = 'rejected') AS rejected_count FROM v GROUP BY 1)
SELECT v.workbook, c_custkey // 1024 AS part, success_count, rejected_count, count(*) AS n_sheets, sum(rows) AS rows
FROM v JOIN t ON t.workbook = v.workbook GROUP BY ALL
"""


def manifest_entries(spark, sf_dir):
    """One entry per sheet with the counts of its workbook, whatever the number of sheets."""
    _, customer, counts, issues = _judged(spark, sf_dir)
    judged = C.verdict(customer, counts, issues).withColumn("table", F.lit("details"))
    extra = judged.select(F.lit("unread.xlsx").alias("workbook")).distinct()
    entries = reports.manifest_entries(judged, judged.select("workbook").unionByName(extra), issues, {"details": "extract_details"}, "t0", "t1")
    return entries.select("workbook", "sheet", "ordinal", "parser", "status", "rows", "output", "success_count", "rejected_count", "finished_at")


_ENTRIES_SQL = _FACTS + """
, t AS (SELECT workbook, count_if(status = 'success') AS success_count, count_if(status = 'rejected') AS rejected_count FROM v GROUP BY 1)
SELECT v.workbook, v.sheet, CAST(c_custkey AS INTEGER) AS ordinal, 'extract_details' AS parser, status, rows,
  CASE WHEN rows > 0 OR status = 'success' THEN 'tables/details/status=' || status || '/workbook_slug='
    || replace(replace(v.workbook, '.xlsx', ''), ' ', '_') || '/sheet_slug=' || v.sheet ELSE 'rejections' END AS output,
  success_count, rejected_count, 't1' AS finished_at FROM v JOIN t ON t.workbook = v.workbook
UNION ALL SELECT 'unread.xlsx', NULL, NULL, NULL, NULL, NULL, NULL, 0, 0, 't1'
"""


def published_text(spark, sf_dir):
    """Rows as written to the delimited files, with their folders."""
    orders, customer, counts, issues = _judged(spark, sf_dir)
    rows = orders.select(*SHEET, "row", F.col("o_orderpriority").alias("label"), to_measure(money("o_totalprice").cast("string")).alias("montant_mad"),
                         to_measure((money("o_totalprice") / 1000).cast("decimal(18,5)").cast("string")).alias("value"))
    return published(rows, C.verdict(customer, counts, issues), ["label", "montant_mad", "value"], ["row"]).drop("_row").withColumnRenamed("_order0", "at")


_PUBLISHED_SQL = _FACTS + r"""
SELECT status, replace(replace(workbook, '.xlsx', ''), ' ', '_') AS workbook_slug, sheet AS sheet_slug, o_orderkey AS at, o_orderpriority AS label,
  CAST(CAST(round(CAST(o_totalprice AS DECIMAL(18,2)), 0) AS DECIMAL(18,0)) AS VARCHAR) AS montant_mad,
  regexp_replace(CAST(CAST(CAST(o_totalprice AS DECIMAL(18,2)) * 0.001 AS DECIMAL(18,5)) AS VARCHAR), '\.?0+$', '') AS value
FROM orders JOIN v ON v.c_custkey = o_custkey WHERE rows > 0
"""


def details_checks(spark, sf_dir):
    """Typing of flat tables: every order sheet is sound, and numbers read as texts are reported."""
    cells = flat_grid(spark, sf_dir)
    bad = cells.withColumn("raw", F.when((F.col("col") == 2) & (F.col("row") > 3) & F.endswith("raw", F.lit("7")), "n.c.").otherwise(F.col("raw")))
    rows = extract_details(bad, routed(bad, fixed.DETAILS, {"stop_on_empty_row": False})).rows
    return _found(C.check_details(rows))


_DETAILS_SQL = """
SELECT 'part ' || (o_orderkey // 5000) AS sheet, 4 + o_orderkey % 5000 + CASE WHEN o_orderkey % 5000 >= 3000 THEN 1 ELSE 0 END AS row,
  'measure' AS kind, 'reject' AS policy, 'validate' AS stage
FROM orders WHERE CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) LIKE '%7'
"""

REPORTS = {
    "duplicate_keys": (duplicate_keys, _DUP_SQL), "contiguity": (contiguity, _CONT_SQL),
    "market_consistency": (market_consistency, _CONSISTENT_SQL), "exclusivity": (exclusivity, _EXCLUSIVE_SQL),
    "row_checks": (row_checks, _ROWS_SQL), "domain_checks": (domain_checks, _DOMAIN_SQL), "details_checks": (details_checks, _DETAILS_SQL),
    "audit": (audit, _AUDIT_SQL), "verdict": (verdict, _FACTS + "SELECT workbook, sheet, status, rows FROM v"),
    "apply_policy": (apply_policy, _FACTS + "SELECT sheet, o_orderkey FROM orders JOIN v ON c_custkey = o_custkey WHERE status = 'success'"),
    "rejection_report": (rejection_report, _REJECTED_SQL), "manifest": (run_manifest, _MANIFEST_SQL),
    "published_text": (published_text, _PUBLISHED_SQL), "manifest_entries": (manifest_entries, _ENTRIES_SQL),
}
