"""One report per family of layouts; the grids grow with the tables, sheet by sheet."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from gridspark import fixed
from gridspark.model import SHEET
from gridspark.operators.settling import settle, stored
from gridspark.plans.activity import extract_activity
from gridspark.plans.common import union_all
from gridspark.plans.competitor import extract_quarterly, extract_staging, extract_summary
from gridspark.plans.details import as_table, extract_details
from gridspark.plans.penetration import extract_penetration
from gridspark.plans.pivots import extract_concession, extract_pivot_staging
from gridspark.plans.variation import extract_variation
from reports.grids import dated, flag, lay, money, num, number_of, routed, spot, table, text

PRIORITIES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")
STATUSES = ("F", "O", "P")

# --- flat tables -------------------------------------------------------------------------------

FLAT_HEADER = ("Marque", "Nombre", "Ville", "Mois", "Année", "Source")
FLAT_ROWS = 5000
FLAT_BREAK = 3000


def flat_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as sheets of 5,000 rows below a title, with an empty row after the 3,000th."""
    orders = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey") % FLAT_ROWS
    sheet = F.concat(F.lit("part "), F.floor(F.col("o_orderkey") / FLAT_ROWS).cast("string"))
    row = 4 + k + (k >= FLAT_BREAK).cast("int")
    french = F.translate(F.format_number("o_totalprice", 2), ",.", chr(160) + ",")
    data = lay(orders, "orders.xlsx", sheet, [
        text(row, "A", F.col("o_orderpriority")), text(row, "B", french), text(row, "C", F.col("o_orderstatus")),
        spot(row, "D", F.month("o_orderdate")), spot(row, "E", F.year("o_orderdate")),
        spot(row, "F", F.col("o_custkey")), text(row, "H", "note"),
    ])
    sheets = orders.select(sheet.alias("s")).distinct()
    # A blank line of white space above the header does not count as a header.
    top = lay(sheets, "orders.xlsx", F.col("s"), [
        text(2, "A", "  "), *[text(3, i + 1, h) for i, h in enumerate(FLAT_HEADER)], text(3, "H", "note")])
    return data.unionByName(top)


def _flat(spark: SparkSession, sf_dir: str, structure: dict) -> DataFrame:
    cells = settle(flat_grid(spark, sf_dir))
    rows = extract_details(cells, routed(cells, fixed.DETAILS, structure)).rows
    names = ("marque", "nombre", "ville", "mois", "annee", "source")
    return as_table(rows, names).select(
        "sheet", "row", "marque", num("nombre").alias("nombre"), "ville", F.col("mois").cast("int").alias("mois"),
        F.col("annee").cast("int").alias("annee"), "source")


def flat_table(spark, sf_dir):
    return _flat(spark, sf_dir, {})


def flat_table_skip_blank(spark, sf_dir):
    return _flat(spark, sf_dir, {"stop_on_empty_row": False})


_FLAT_SQL = """
WITH base AS (
  SELECT 'part ' || (o_orderkey // 5000) AS sheet,
         4 + o_orderkey % 5000 + CASE WHEN o_orderkey % 5000 >= 3000 THEN 1 ELSE 0 END AS row, o.*
  FROM orders o),
placed AS (SELECT *, row - row_number() OVER (PARTITION BY sheet ORDER BY row) AS gap FROM base)
SELECT sheet, row, o_orderpriority AS marque, CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) AS nombre,
       o_orderstatus AS ville, CAST(month(o_orderdate) AS INTEGER) AS mois, CAST(year(o_orderdate) AS INTEGER) AS annee,
       CAST(o_custkey AS VARCHAR) AS source
FROM placed
"""

# --- activity ----------------------------------------------------------------------------------

ACTIVITY_LAYOUT = {
    "limits": {"first_row": 1, "last_row": 3000, "first_column": 1, "last_column": 9},
    "title_area": {"first_row": 1, "last_row": 3, "first_column": 1, "last_column": 9},
    "year_cells": {"reference": "B7", "comparison": "C7"},
    "label_column": "A",
    "data_columns": dict(zip(fixed.ACTIVITY_MEASURES, "BCDEFGHI")),
    "infer_sections": True,
    "default_section": "ACTIVITE",
    "skip_labels": ["Dossiers en nombre"],
    "unit_tokens": ["dirham", "pourcentage"],
    "sections": {"PRODUCTION_NETTE": ["PRODUCTION NETTE"], "ENCOURS_SAIN": ["ENCOURS SAINS"]},
    "hierarchy": {
        "types": {"PRETS_AFFECTES": ["PRÊTS AFFECTÉS"], "PRETS_NON_AFFECTES": ["PRÊTS NON AFFECTÉS"]},
        "categories": {"VEHICULES": ["VÉHICULES"], "REVOLVING": ["REVOLVING"]},
        "products": {"CREDIT_CLASSIQUE": ["CRÉDIT CLASSIQUE"], "LOA": ["LOA"]},
    },
}


def activity_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as sheets of 500 with headings between them: five lines per customer, of which
    some stay empty."""
    customer = table(spark, sf_dir, "customer")
    k = F.col("c_custkey") % 500
    sheet = F.concat(F.lit("C "), F.floor(F.col("c_custkey") / 500).cast("string"))
    line = lambda slot: 10 + 5 * k + slot
    alternate = lambda every, a, b: F.when(
        k % every == 0, F.when(F.floor(k / every) % 2 == 0, a).otherwise(b))
    label = (F.when(k % 5 == 1, "Crédit classique").when(k % 5 == 3, "loa").otherwise(F.col("c_name")))
    data = lay(customer, "activity.xlsx", sheet, [
        text(line(0), "A", alternate(100, "Production  nette", "ENCOURS SAINS")),
        text(line(1), "A", alternate(50, "Prêts affectés", "Prêts non affectés")),
        text(line(2), "A", alternate(10, "Véhicules", "Revolving")),
        text(line(3), "A", label),
        spot(line(3), "B", money("c_acctbal")),
        spot(line(3), "C", F.when(F.col("c_nationkey") == 0, "ns").otherwise(F.col("c_nationkey").cast("string")), "s"),
        spot(line(3), "G", (F.col("c_nationkey") / 100).cast("decimal(6,2)"), number_format="0.0%"),
        text(line(4), "A", F.when(k % 25 == 24, "Sous-total clients")),
        spot(line(4), "B", F.when(k % 25 == 24, F.lit(1))),
    ])
    top = lay(customer.select(sheet.alias("s")).distinct(), "activity.xlsx", F.col("s"), [
        text(1, "A", "Situation à fin mars 2026"), spot(7, "B", F.lit(2026)), text(7, "C", "année 2025")])
    return data.unionByName(top)


def activity(spark, sf_dir):
    cells = settle(activity_grid(spark, sf_dir))
    rows = extract_activity(cells, routed(cells, fixed.ACTIVITY, ACTIVITY_LAYOUT)).rows
    return rows.select(
        "organisme", F.col("date_reporting").cast("string").alias("date_reporting"), "section", "type_pret", "categorie",
        "produit", "annee_reference", "annee_comparaison", num("montant_reference_mad").alias("montant_reference_mad"),
        num("montant_comparaison_mad").alias("montant_comparaison_mad"),
        flag("montant_comparaison_mad").alias("montant_comparaison_flag"),
        num("variation_montant_pct").alias("variation_montant_pct"), "ordre_section", "ordre_ligne")


_ACTIVITY_SQL = """
WITH base AS (
  SELECT *, c_custkey // 500 AS s, c_custkey % 500 AS k FROM customer),
marks AS (
  SELECT *, last_value(CASE WHEN k % 100 = 0 THEN k END IGNORE NULLS) OVER w AS sec_at,
         last_value(CASE WHEN k % 50 = 0 THEN k END IGNORE NULLS) OVER w AS type_at,
         last_value(CASE WHEN k % 10 = 0 THEN k END IGNORE NULLS) OVER w AS cat_at,
         last_value(CASE WHEN k % 5 IN (1, 3) THEN k END IGNORE NULLS) OVER w AS prod_at
  FROM base WINDOW w AS (PARTITION BY s ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
context AS (
  SELECT *,
    CASE WHEN sec_at IS NULL THEN 'ACTIVITE' WHEN (sec_at // 100) % 2 = 0 THEN 'PRODUCTION_NETTE' ELSE 'ENCOURS_SAIN' END AS section,
    CASE WHEN type_at IS NULL THEN '' WHEN (type_at // 50) % 2 = 0 THEN 'PRETS_AFFECTES' ELSE 'PRETS_NON_AFFECTES' END AS type_pret,
    CASE WHEN cat_at IS NULL OR cat_at < coalesce(type_at, -1) THEN ''
         WHEN (cat_at // 10) % 2 = 0 THEN 'VEHICULES' ELSE 'REVOLVING' END AS category,
    CASE WHEN prod_at >= greatest(coalesce(type_at, -1), coalesce(cat_at, -1)) THEN
         CASE WHEN prod_at % 5 = 1 THEN 'CREDIT_CLASSIQUE' ELSE 'LOA' END END AS cur
  FROM marks),
firsts AS (SELECT s, section, min(k) AS first_k FROM context GROUP BY s, section),
ranks AS (SELECT s, section, row_number() OVER (PARTITION BY s ORDER BY first_k) AS ordre_section FROM firsts)
SELECT 'C ' || s AS organisme, '2026-03-31' AS date_reporting, section, type_pret,
  CASE WHEN k % 5 NOT IN (1, 3) AND cur = 'LOA' AND category = '' THEN 'VEHICULES' ELSE category END AS categorie,
  CASE WHEN k % 5 = 1 THEN 'CREDIT_CLASSIQUE' WHEN k % 5 = 3 THEN 'LOA'
       WHEN cur = 'LOA' THEN 'LOA_' || upper(replace(c_name, '#', '_')) ELSE upper(replace(c_name, '#', '_')) END AS produit,
  2026 AS annee_reference, 2025 AS annee_comparaison,
  CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS DOUBLE) AS montant_reference_mad,
  CASE WHEN c_nationkey <> 0 THEN CAST(c_nationkey AS DOUBLE) END AS montant_comparaison_mad,
  CASE WHEN c_nationkey = 0 THEN 'NS' END AS montant_comparaison_flag,
  CAST(c_nationkey AS DOUBLE) AS variation_montant_pct, ordre_section,
  row_number() OVER (PARTITION BY s, section ORDER BY k) AS ordre_ligne
FROM context JOIN ranks USING (s, section)
"""

# --- competitor summary and quarters -----------------------------------------------------------

SUMMARY_LAYOUT = {
    "label_column": "B",
    "category_blocks": {"F": ["E", "F", "G"], "O": ["I", "J", "K"], "P": ["M", "N", "O"]},
    "sections": {
        "PRODUCTION_NETTE": {"category_row": 11, "period_row": 13, "data_start_row": 16, "data_end_row": 24},
        "CES_SUR_ENCOURS_BRUT": {"category_row": 31, "period_row": 33, "data_start_row": 36, "data_end_row": 44},
    },
}
_SUMMARY_COLUMNS = {"F": "EFG", "O": "IJK", "P": "MNO"}


def _by_customer(spark, sf_dir, *aggs) -> DataFrame:
    """Orders by customer, priority and status, and per customer and status as the market."""
    orders = table(spark, sf_dir, "orders")
    detail = orders.groupBy("o_custkey", "o_orderstatus", "o_orderpriority").agg(*aggs)
    market = orders.groupBy("o_custkey", "o_orderstatus").agg(*aggs).withColumn("o_orderpriority", F.lit("Marché"))
    return detail.unionByName(market)


def _line(start: int):
    """Market row in the middle of the organisms; a share row and a total row are added below."""
    place = F.when(F.col("o_orderpriority") == "Marché", 3)
    for i, p in enumerate(PRIORITIES):
        place = place.when(F.col("o_orderpriority") == p, i if i < 3 else i + 1)
    return start + place


def summary_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A sheet per customer: amounts and ratios of its orders by priority and status."""
    # No cell comes twice from distinct facts, except the labels, which stand once for all statuses.
    facts = stored(_by_customer(spark, sf_dir, F.sum(money("o_totalprice")).alias("total"), F.count("*").alias("n")).distinct())
    sheet = F.concat(F.lit("c"), F.col("o_custkey").cast("string"))
    first = F.coalesce(*[F.when(F.col("o_orderstatus") == status, number_of(columns[0])) for status, columns in _SUMMARY_COLUMNS.items()])
    only = lambda v: F.when(F.col("o_orderstatus").isin(*_SUMMARY_COLUMNS), v)
    cells = []
    for start, percent in ((16, False), (36, True)):
        row = _line(start)
        cells += [
            spot(row, first, only(F.col("total") if not percent else F.col("n")),
                 number_format="0.0%" if percent else "#,##0,"),
            spot(row, first + 1, only(F.col("n")), number_format="General"),
            spot(row, first + 2, only((F.col("n") / 100).cast("decimal(10,2)")), number_format="0.0%"),
        ]
    labels = lay(facts.select("o_custkey", "o_orderpriority").distinct(), "summary.xlsx", sheet, [
        text(_line(start), "B", F.col("o_orderpriority")) for start in (16, 36)])
    data = lay(facts, "summary.xlsx", sheet, cells).unionByName(labels)
    heads = [text(1, "A", "Synthèse"), dated(1, "D", "2026-03-15")]
    for columns in _SUMMARY_COLUMNS.values():
        for row in (13, 33):
            heads += [text(row, columns[0], "Mar-26"), dated(row, columns[1], "2025-03-01")]
    for start in (16, 36):
        heads += [text(start + 6, "B", "Part de marché"), spot(start + 6, "E", F.lit(1)),
                  text(start + 7, "B", "TOTAL"), spot(start + 7, "E", F.lit(2))]
    top = lay(facts.select(sheet.alias("s")).distinct(), "summary.xlsx", F.col("s"), heads)
    return data.unionByName(top)


def summary(spark, sf_dir):
    cells = stored(summary_grid(spark, sf_dir))
    rows = extract_summary(cells, routed(cells, fixed.SUMMARY, SUMMARY_LAYOUT)).rows
    return rows.select(
        "sheet", F.col("date_reporting").cast("string").alias("date_reporting"), "section", "organisme", "categorie",
        "periode_reference", "periode_comparaison", *[num(c).alias(c) for c in fixed.HEADERS["summary"][6:]])


_SUMMARY_SQL = """
WITH d AS (SELECT o_custkey, o_orderstatus AS st, o_orderpriority AS pr, sum(CAST(o_totalprice AS DECIMAL(18,2))) AS t, count(*) AS n
           FROM orders GROUP BY ALL),
m AS (SELECT o_custkey, st, sum(t) AS mt, sum(n) AS mn FROM d GROUP BY ALL),
j AS (SELECT * FROM d JOIN m USING (o_custkey, st)),
s AS (SELECT unnest(['PRODUCTION_NETTE', 'CES_SUR_ENCOURS_BRUT']) AS section)
SELECT 'c' || o_custkey AS sheet, '2026-03-31' AS date_reporting, section, pr AS organisme, st AS categorie,
  '2026-03' AS periode_reference, '2025-03' AS periode_comparaison,
  CASE WHEN section = 'PRODUCTION_NETTE' THEN CAST(CAST(t AS DECIMAL(24,2)) * 0.001 AS DOUBLE) END AS valeur_reference_mdh,
  CASE WHEN section = 'PRODUCTION_NETTE' THEN CAST(n AS DOUBLE) END AS valeur_comparaison_mdh,
  CASE WHEN section = 'PRODUCTION_NETTE' THEN CAST(n AS DOUBLE) END AS evolution_pct,
  CASE WHEN section = 'PRODUCTION_NETTE' THEN CAST(CAST(mt AS DECIMAL(24,2)) * 0.001 AS DOUBLE) END AS marche_reference_mdh,
  CASE WHEN section = 'PRODUCTION_NETTE' THEN CAST(mn AS DOUBLE) END AS marche_comparaison_mdh,
  CASE WHEN section = 'PRODUCTION_NETTE' THEN CAST(mn AS DOUBLE) END AS evolution_marche_pct,
  CASE WHEN section <> 'PRODUCTION_NETTE' THEN CAST(n * 100 AS DOUBLE) END AS ratio_reference_pct,
  CASE WHEN section <> 'PRODUCTION_NETTE' THEN CAST(n AS DOUBLE) END AS ratio_comparaison_pct,
  CASE WHEN section <> 'PRODUCTION_NETTE' THEN CAST(n AS DOUBLE) END AS evolution_ratio_points,
  CASE WHEN section <> 'PRODUCTION_NETTE' THEN CAST(mn * 100 AS DOUBLE) END AS marche_ratio_reference_pct,
  CASE WHEN section <> 'PRODUCTION_NETTE' THEN CAST(mn AS DOUBLE) END AS marche_ratio_comparaison_pct,
  CASE WHEN section <> 'PRODUCTION_NETTE' THEN CAST(mn AS DOUBLE) END AS evolution_marche_ratio_points
FROM j, s
"""

QUARTERLY_LAYOUT = {
    "label_column": "B", "annee": 2026,
    "title_area": {"first_row": 1, "last_row": 3, "first_column": 1, "last_column": 28},
    "category_blocks": {"F": ["E", "F", "G", "H"], "O": ["J", "K", "L", "M"], "P": ["O", "P", "Q", "R"]},
    "sections": {"PRODUCTION_NETTE": {"period_row": 13, "data_start_row": 16, "data_end_row": 24}},
}


def quarterly_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A sheet per customer: amounts of its orders by priority, status and quarter of the year."""
    quarters = [F.sum(F.when(F.quarter("o_orderdate") == q, money("o_totalprice"))).alias(f"t{q}") for q in range(1, 5)]
    facts = _by_customer(spark, sf_dir, *quarters)
    sheet = F.concat(F.lit("c"), F.col("o_custkey").cast("string"))
    row = _line(16)
    cells = [text(row, "B", F.col("o_orderpriority"))]
    heads = [text(2, "B", "Synthèse par trimestre")]
    for status, columns in QUARTERLY_LAYOUT["category_blocks"].items():
        for q, column in enumerate(columns, start=1):
            cells.append(spot(row, column, F.when(F.col("o_orderstatus") == status, F.col(f"t{q}")), number_format="#,##0,"))
            heads.append(text(13, column, f" t{q}"))
    data = lay(facts, "quarterly.xlsx", sheet, cells)
    top = lay(facts.select(sheet.alias("s")).distinct(), "quarterly.xlsx", F.col("s"), heads)
    return data.unionByName(top).distinct()


def quarterly(spark, sf_dir):
    cells = settle(quarterly_grid(spark, sf_dir))
    rows = extract_quarterly(cells, routed(cells, fixed.QUARTERLY, QUARTERLY_LAYOUT)).rows
    return rows.select(
        "sheet", F.col("date_reporting").cast("string").alias("date_reporting"), "section", "organisme", "categorie", "annee",
        *[num(c).alias(c) for c in fixed.HEADERS["quarterly"][5:13]])


def _quarter_sql(alias: str, source: str) -> str:
    return ", ".join(
        f"CAST(CAST({source}{q} AS DECIMAL(24,2)) * 0.001 AS DOUBLE) AS {alias.format(q=q)}" for q in range(1, 5))


_QUARTERLY_SQL = f"""
WITH d AS (SELECT o_custkey, o_orderstatus AS st, o_orderpriority AS pr,
  {", ".join(f"sum(CASE WHEN quarter(o_orderdate) = {q} THEN CAST(o_totalprice AS DECIMAL(18,2)) END) AS t{q}" for q in range(1, 5))}
  FROM orders GROUP BY ALL),
m AS (SELECT o_custkey, st, {", ".join(f"sum(t{q}) AS m{q}" for q in range(1, 5))} FROM d GROUP BY ALL)
SELECT 'c' || o_custkey AS sheet, '2026-12-31' AS date_reporting, 'PRODUCTION_NETTE' AS section, pr AS organisme,
  st AS categorie, 2026 AS annee, {_quarter_sql("t{q}_mdh", "t")}, {_quarter_sql("marche_t{q}_mdh", "m")}
FROM d JOIN m USING (o_custkey, st)
"""

# --- staging with merged headers ---------------------------------------------------------------

STAGING_LAYOUT = {
    "layout": "staging", "label_column": "B",
    "limits": {"first_row": 9, "last_row": 40, "first_column": 2, "last_column": 23},
    "sections": {"PRODUCTION_NETTE": {"category_row": 11, "period_row": 13, "data_start_row": 16, "data_end_row": 23}},
}
FLAGS = ("A", "N", "R")


def staging_grid(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """A sheet per part: quantities and prices by line number, below a merged header per return
    flag; lines without a sale stay blank."""
    facts = stored(table(spark, sf_dir, "lineitem").groupBy("l_partkey", "l_linenumber", "l_returnflag").agg(
        F.sum(money("l_quantity")).alias("q"), F.sum(money("l_extendedprice")).alias("p")))
    sheet = F.concat(F.lit("p"), F.col("l_partkey").cast("string"))
    row = 15 + F.col("l_linenumber")
    first = F.when(F.col("l_returnflag") == "A", 5).when(F.col("l_returnflag") == "N", 8).otherwise(11)
    # Labels stand once for all flags, and flags may share a column: what makes a cell is distinct before it is laid out.
    place = facts.withColumn("first", first)
    data = union_all([lay(place.select("l_partkey", "l_linenumber", *some).distinct(), "staging.xlsx", sheet, [cell]) for some, cell in (
        ([], text(row, "B", F.concat(F.lit("line "), F.col("l_linenumber").cast("string")))),
        (["first", "q"], spot(row, F.col("first"), F.col("q"), number_format="0")),
        (["first", "p"], spot(row, F.col("first") + 1, F.col("p"), number_format="#,##0,")))])
    heads = [text(2, "B", "Mars 2026"), text(23, "B", "Marché"), text(11, "Y", "beyond")]
    for i, f in enumerate(FLAGS):
        heads += [text(11, 5 + 3 * i, f"flag {f} "), dated(13, 5 + 3 * i, "2026-03-01"), text(13, 6 + 3 * i, "prix")]
    sheets = facts.select(F.lit("staging.xlsx").alias("workbook"), sheet.alias("sheet")).distinct()
    cells = stored(data.unionByName(lay(sheets, "staging.xlsx", F.col("sheet"), heads)))
    ranges = F.array(*[
        F.struct(F.lit(11).cast("bigint").alias("min_row"), F.lit(11).cast("bigint").alias("max_row"),
                 F.lit(a).alias("min_col"), F.lit(b).alias("max_col"))
        for a, b in ((5, 6), (8, 9), (11, 12), (25, 26))])
    return cells, sheets.select(*SHEET, F.explode(ranges).alias("m")).select(*SHEET, "m.*")


def staging(spark, sf_dir):
    cells, merged = staging_grid(spark, sf_dir)
    rows = extract_staging(cells, routed(cells, fixed.SUMMARY, STAGING_LAYOUT), merged).rows
    return rows.select(
        F.col("date_reporting").cast("string").alias("date_reporting"), "sheet", "section", "category_label_raw",
        "period_label_raw", "row_label_raw", "row_type", num("value").alias("value"), "number_format", "source_row",
        "source_column")


_STAGING_SQL = """
WITH f AS (SELECT l_partkey, l_linenumber AS ln, l_returnflag AS fl, sum(CAST(l_quantity AS DECIMAL(18,2))) AS q,
                  sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS p FROM lineitem GROUP BY ALL),
parts AS (SELECT DISTINCT l_partkey FROM f),
spine AS (SELECT l_partkey, unnest(range(1, 9)) AS ln FROM parts),
flags AS (SELECT * FROM (VALUES ('A', 'E', 'F'), ('N', 'H', 'I'), ('R', 'K', 'L')) v(fl, c1, c2)),
labels AS (SELECT DISTINCT l_partkey, ln FROM f),
cols AS (SELECT spine.*, fl, c1, c2, kind FROM spine, flags, (VALUES (1), (2)) k(kind))
SELECT '2026-03-31' AS date_reporting, 'p' || cols.l_partkey AS sheet, 'PRODUCTION_NETTE' AS section,
  'flag ' || cols.fl AS category_label_raw, CASE WHEN kind = 1 THEN '2026-03-01' ELSE 'prix' END AS period_label_raw,
  CASE WHEN cols.ln = 8 THEN 'Marché' WHEN labels.ln IS NOT NULL THEN 'line ' || cols.ln ELSE '' END AS row_label_raw,
  CASE WHEN cols.ln = 8 THEN 'marche' ELSE 'organisme' END AS row_type,
  CAST(CASE WHEN kind = 1 THEN q ELSE p END AS DOUBLE) AS value,
  CASE WHEN f.q IS NULL THEN 'General' WHEN kind = 1 THEN '0' ELSE '#,##0,' END AS number_format,
  15 + cols.ln AS source_row, CASE WHEN kind = 1 THEN c1 ELSE c2 END AS source_column
FROM cols LEFT JOIN f ON f.l_partkey = cols.l_partkey AND f.ln = cols.ln AND f.fl = cols.fl
LEFT JOIN labels ON labels.l_partkey = cols.l_partkey AND labels.ln = cols.ln
"""

# --- penetration -------------------------------------------------------------------------------

PENETRATION_LAYOUT = {
    "dimension": "MARQUE", "ville": "GLOBAL", "periodicite": "MENSUEL",
    "axis_row": 7, "header_row": 8, "data_start_row": 9, "label_column": "A",
    "axis_groups": [{"axis_column": "C", "value_columns": ["C", "D"]}, {"axis_column": "F", "value_columns": ["F"]}],
}


def penetration_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A sheet per user: counts, values and a share by event type, then the grand total."""
    events = table(spark, sf_dir, "events")
    facts = events.groupBy("user_id", "event_type").agg(
        F.count("*").alias("n"), F.sum(F.when(F.col("value") >= 5, money("value"))).alias("v"))
    ranked = facts.withColumn("k", F.row_number().over(Window.partitionBy("user_id").orderBy("event_type")))
    last = facts.groupBy("user_id").agg(F.count("*").alias("k"))
    sheet = F.concat(F.lit("u"), F.col("user_id").cast("string"))
    row = 8 + F.col("k")
    data = lay(ranked, "events.xlsx", sheet, [
        text(row, "A", F.col("event_type")), spot(row, "C", F.col("n")), spot(row, "D", F.col("v")),
        spot(row, "F", (F.col("n") / 1000).cast("decimal(12,3)"), number_format="0.0%")])
    below = lay(last, "events.xlsx", sheet, [
        text(9 + F.col("k"), "A", "Total général"), spot(9 + F.col("k"), "C", F.lit(1)),
        text(10 + F.col("k"), "A", "after"), spot(10 + F.col("k"), "C", F.lit(1)),
        text(8, "A", "marque"), dated(7, "C", "2026-04-01"), text(7, "F", "Taux de pénétration"),
        text(8, "C", "AIVAM"), text(8, "D", "SOFAC"), dated(8, "F", "2026-04-01", '"TPR" mmm yyyy')])
    return data.unionByName(below)


def penetration(spark, sf_dir):
    cells = settle(penetration_grid(spark, sf_dir))
    rows = extract_penetration(cells, routed(cells, fixed.PENETRATION, PENETRATION_LAYOUT)).rows
    return rows.select("sheet", "marque", "ville", "periodicite", "dimension", "axe", "sous_axe", num("valeur").alias("valeur"))


_PENETRATION_SQL = """
WITH f AS (SELECT user_id, event_type, count(*) AS n, sum(CASE WHEN value >= 5 THEN CAST(value AS DECIMAL(18,2)) END) AS v
           FROM events GROUP BY ALL),
wide AS (SELECT user_id, event_type, CAST(n AS DOUBLE) AS m1, CAST(v AS DOUBLE) AS m2,
                CAST(CAST(n AS DECIMAL(18,1)) * 0.1 AS DOUBLE) AS m3 FROM f),
long AS (SELECT * FROM wide UNPIVOT INCLUDE NULLS (valeur FOR m IN (m1, m2, m3)))
SELECT 'u' || user_id AS sheet, event_type AS marque, 'GLOBAL' AS ville, 'MENSUEL' AS periodicite, 'MARQUE' AS dimension,
  CASE m WHEN 'm3' THEN 'Taux de pénétration' ELSE 'avril 2026' END AS axe,
  CASE m WHEN 'm1' THEN 'AIVAM' WHEN 'm2' THEN 'SOFAC' ELSE 'TPR avr 2026' END AS sous_axe, valeur
FROM long
"""

# --- concession --------------------------------------------------------------------------------


def concession_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A sheet per supplier: a zone per return flag, in it a pivot per line status, rows by line
    number, the grand total last; the columns of the second pivot are permuted."""
    lines = table(spark, sf_dir, "lineitem")
    keys = ["l_suppkey", "l_returnflag", "l_linestatus"]
    facts = lines.groupBy(*keys, "l_linenumber").agg(
        F.sum(money("l_quantity")).alias("q"), F.sum(money("l_tax") * 100).alias("t"))
    place = Window.partitionBy(*keys).orderBy("l_linenumber")
    ranked = facts.withColumn("k", F.row_number().over(place)).withColumn(
        "label", F.concat(F.lit("m"), F.col("l_linenumber").cast("string")))
    totals = facts.groupBy(*keys).agg(
        F.sum("q").alias("q"), F.sum("t").alias("t"), (F.count("*") + 1).cast("int").alias("k")).withColumn(
        "label", F.lit("Total général"))
    rows = ranked.drop("l_linenumber").unionByName(totals)
    sheet = F.concat(F.lit("s"), F.col("l_suppkey").cast("string"))
    top = 2 + 20 * F.when(F.col("l_returnflag") == "A", 0).when(F.col("l_returnflag") == "N", 1).otherwise(2)
    second = F.col("l_linestatus") == "O"
    left = F.when(second, 8).otherwise(2)
    aivam, sofac, total = left + F.when(second, 3).otherwise(1), left + 2, left + F.when(second, 1).otherwise(3)
    row = top + 3 + F.col("k")
    data = lay(rows, "concession.xlsx", sheet, [
        text(row, left, F.col("label")), spot(row, aivam, F.col("q")), spot(row, sofac, F.col("t")),
        spot(row, total, F.col("q") + F.col("t"))])
    heads = lay(facts.select(*keys).distinct(), "concession.xlsx", sheet, [
        text(top, 1, F.concat(F.lit("TPR  group "), F.col("l_returnflag"))),
        text(top + 1, left, "Année"), spot(top + 1, left + 1, F.when(second, 2026).otherwise(2025)),
        text(top + 3, left, "Étiquettes de lignes"), text(top + 3, aivam, "Aivam"), text(top + 3, sofac, "SOFAC"),
        text(top + 3, total, "Total général")])
    return data.unionByName(heads).distinct()


def concession(spark, sf_dir):
    cells = settle(concession_grid(spark, sf_dir))
    rows = extract_concession(cells, routed(cells, fixed.CONCESSION, {"context_lookback": 8})).rows
    return rows.select(
        "sheet", "groupe_concessionnaire", "annee", "marque", num("aivam").alias("aivam"), num("sofac").alias("sofac"),
        num("total").alias("total"), "row_type")


_CONCESSION_SQL = """
SELECT 's' || l_suppkey AS sheet, 'group ' || l_returnflag AS groupe_concessionnaire,
  CASE WHEN l_linestatus = 'O' THEN 2026 ELSE 2025 END AS annee,
  CASE WHEN grouping(l_linenumber) = 1 THEN 'Total général' ELSE 'm' || l_linenumber END AS marque,
  CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS aivam,
  CAST(sum(CAST(l_tax AS DECIMAL(18,2)) * 100) AS DOUBLE) AS sofac,
  CAST(sum(CAST(l_quantity AS DECIMAL(18,2)) + CAST(l_tax AS DECIMAL(18,2)) * 100) AS DOUBLE) AS total,
  CASE WHEN grouping(l_linenumber) = 1 THEN 'total' ELSE 'marque' END AS row_type
FROM lineitem
GROUP BY GROUPING SETS ((l_suppkey, l_returnflag, l_linestatus, l_linenumber), (l_suppkey, l_returnflag, l_linestatus))
"""

# --- pivot staging -----------------------------------------------------------------------------

PIVOT_LAYOUT = {"anchor_labels": ["Étiquettes de lignes"], "context_lookback": 8, "blank_label_policy": "keep_with_values"}


def pivot_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A sheet per customer: a pivot per order year, side by side, rows by priority, columns by
    status. The lowest priority has no label, only values."""
    orders = table(spark, sf_dir, "orders").withColumn("y", F.year("o_orderdate"))
    facts = orders.groupBy("o_custkey", "y", "o_orderpriority").agg(
        *[F.sum(F.when(F.col("o_orderstatus") == s, 1)).alias(s) for s in STATUSES])
    place = Window.partitionBy("o_custkey", "y").orderBy("o_orderpriority")
    facts = facts.withColumn("row", 7 + F.row_number().over(place)).withColumn("left", 1 + 5 * (F.col("y") - 1995))
    sheet = F.concat(F.lit("c"), F.col("o_custkey").cast("string"))
    row, left = F.col("row"), F.col("left")
    label = F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderpriority"))
    data = lay(facts, "pivots.xlsx", sheet, [
        text(row, left, label), *[spot(row, left + 1 + i, F.col(s)) for i, s in enumerate(STATUSES)]])
    blocks = facts.select("o_custkey", "y", "left").distinct()
    heads = lay(blocks, "pivots.xlsx", sheet, [
        text(1, left, F.when(F.col("y") % 2 == 0, "Mois M").otherwise("ANNEE N-1")),
        text(3, left, "VILLE"), text(3, left + 1, "Rabat"),
        text(4, left, "année"), spot(4, left + 1, F.col("y")),
        text(5, left, "Mois"), text(5, left + 1, F.when(F.col("y") < 1998, "(Plusieurs éléments)").otherwise("3")),
        text(7, left, "Étiquettes de lignes"), *[text(7, left + 1 + i, f"st {s}") for i, s in enumerate(STATUSES)]])
    return data.unionByName(heads)


def pivot_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The months of a customer's orders as the selected items of the filter of its year."""
    orders = table(spark, sf_dir, "orders")
    return orders.select(
        F.lit("pivots.xlsx").alias("workbook"), F.concat(F.lit("c"), F.col("o_custkey").cast("string")).alias("sheet"),
        (1 + 5 * (F.year("o_orderdate") - 1995)).alias("min_col"), F.lit("MOIS").alias("field"),
        F.month("o_orderdate").alias("item_ord"), F.month("o_orderdate").cast("string").alias("item")).distinct()


def pivot_staging(spark, sf_dir):
    cells = stored(pivot_grid(spark, sf_dir))
    rows = extract_pivot_staging(
        cells, routed(cells, fixed.PIVOT_STAGING, PIVOT_LAYOUT), pivot_filters(spark, sf_dir)).rows
    return rows.select(
        "sheet", "bloc_index", "axe", "periodicite", "annee", "mois", "dimension", "marque", "ville", "organisme",
        num("valeur").alias("valeur"))


_PIVOT_SQL = """
WITH o AS (SELECT *, year(o_orderdate) AS y FROM orders),
f AS (SELECT o_custkey, y, o_orderpriority AS pr, sum(CASE WHEN o_orderstatus = 'F' THEN 1 END) AS f,
        sum(CASE WHEN o_orderstatus = 'O' THEN 1 END) AS o, sum(CASE WHEN o_orderstatus = 'P' THEN 1 END) AS p
      FROM o GROUP BY ALL),
b AS (SELECT o_custkey, y, row_number() OVER (PARTITION BY o_custkey ORDER BY y) AS bloc_index
      FROM (SELECT DISTINCT o_custkey, y FROM o)),
m AS (SELECT o_custkey, y, string_agg(CAST(mo AS VARCHAR), ',' ORDER BY mo) AS months
      FROM (SELECT DISTINCT o_custkey, y, month(o_orderdate) AS mo FROM o) GROUP BY ALL),
long AS (SELECT * FROM f UNPIVOT INCLUDE NULLS (valeur FOR st IN (f, o, p)))
SELECT 'c' || long.o_custkey AS sheet, CAST(bloc_index AS INTEGER) AS bloc_index,
  CASE WHEN long.y % 2 = 0 THEN 'Mois M' ELSE 'ANNEE N-1' END AS axe,
  CASE WHEN long.y % 2 = 0 THEN 'MENSUEL' ELSE 'ANNUEL' END AS periodicite, CAST(long.y AS VARCHAR) AS annee,
  CASE WHEN long.y < 1998 THEN months ELSE '3' END AS mois, 'MARQUE' AS dimension,
  CASE WHEN pr <> '5-LOW' THEN pr END AS marque, 'Rabat' AS ville, 'st ' || upper(st) AS organisme, CAST(valeur AS DOUBLE) AS valeur
FROM long JOIN b ON b.o_custkey = long.o_custkey AND b.y = long.y JOIN m ON m.o_custkey = long.o_custkey AND m.y = long.y
"""

# --- variation ---------------------------------------------------------------------------------

VARIATION_LAYOUT = {"tables": [
    {"header_row": 3, "data_start_row": 4, "data_end_row": 20, "ville_column": "B",
     "value_columns": ["C", "D"], "variation_column": "E"},
    {"header_row": 3, "data_start_row": 4, "data_end_row": 28, "ville_column": "J",
     "value_columns": ["K", "L"], "variation_column": "M", "skip_empty_rows": True}]}


def variation_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A sheet per part: discounts before and since 1998 by return flag (periods in one order) and by
    line number (in the other, with gaps)."""
    lines = table(spark, sf_dir, "lineitem")
    late = F.col("l_shipdate") >= F.lit("1998-07-01").cast("timestamp_ntz")
    sums = [F.sum(F.when(late, money("l_discount"))).alias("cur"), F.sum(F.when(~late, money("l_discount"))).alias("prev"),
            F.sum(money("l_quantity")).alias("chg")]
    by_flag = lines.groupBy("l_partkey", "l_returnflag").agg(*sums).withColumn(
        "row", 3 + F.row_number().over(Window.partitionBy("l_partkey").orderBy("l_returnflag")))
    by_line = lines.groupBy("l_partkey", "l_linenumber").agg(*sums).withColumn("row", 3 + F.col("l_linenumber"))
    sheet = F.concat(F.lit("p"), F.col("l_partkey").cast("string"))
    row = F.col("row")
    cells = lambda label, letters: [
        text(row, letters[0], label), spot(row, letters[1], F.col("cur"), number_format="0.00%"),
        spot(row, letters[2], F.col("prev"), number_format="0.00%"), spot(row, letters[3], F.col("chg"))]
    heads = [dated(3, "C", "2026-04-01"), dated(3, "D", "2026-03-01"), dated(3, "K", "2026-03-01"), dated(3, "L", "2026-04-01")]
    return (
        lay(by_flag, "variation.xlsx", sheet, cells(F.col("l_returnflag"), "BCDE"))
        .unionByName(lay(by_line, "variation.xlsx", sheet, cells(F.concat(F.lit("line "), F.col("l_linenumber").cast("string")), "JLKM")))
        .unionByName(lay(lines.select("l_partkey").distinct(), "variation.xlsx", sheet, heads))
    )


def variation(spark, sf_dir):
    cells = settle(variation_grid(spark, sf_dir))
    rows = extract_variation(cells, routed(cells, fixed.VARIATION, VARIATION_LAYOUT)).rows
    return rows.select("sheet", "ville", "axe", num("valeur").alias("valeur"))


_VARIATION_SQL = """
WITH b AS (SELECT l_partkey, 'flag' AS t, l_returnflag AS ville, l_shipdate, l_discount, l_quantity FROM lineitem
  UNION ALL SELECT l_partkey, 'line', 'line ' || l_linenumber, l_shipdate, l_discount, l_quantity FROM lineitem),
f AS (SELECT l_partkey, t, ville,
  sum(CASE WHEN l_shipdate >= TIMESTAMP '1998-07-01' THEN CAST(l_discount AS DECIMAL(18,2)) END) * 100 AS cur,
  sum(CASE WHEN l_shipdate < TIMESTAMP '1998-07-01' THEN CAST(l_discount AS DECIMAL(18,2)) END) * 100 AS prev,
  sum(CAST(l_quantity AS DECIMAL(18,2))) AS chg FROM b GROUP BY ALL),
wide AS (SELECT l_partkey, t, ville, CAST(cur AS DOUBLE) AS m1, CAST(prev AS DOUBLE) AS m2, CAST(chg AS DOUBLE) AS m3 FROM f),
long AS (SELECT * FROM wide UNPIVOT INCLUDE NULLS (valeur FOR m IN (m1, m2, m3)))
SELECT 'p' || l_partkey AS sheet, ville, CASE m WHEN 'm1' THEN 'avr-26' WHEN 'm2' THEN 'mars-26' ELSE 'Variation' END AS axe, valeur
FROM long
"""

REPORTS = {
    "flat_table": (flat_table, _FLAT_SQL + "WHERE gap = 3"),
    "flat_table_skip_blank": (flat_table_skip_blank, _FLAT_SQL),
    "activity": (activity, _ACTIVITY_SQL),
    "summary": (summary, _SUMMARY_SQL),
    "staging": (staging, _STAGING_SQL),
    "quarterly": (quarterly, _QUARTERLY_SQL),
    "penetration": (penetration, _PENETRATION_SQL),
    "concession": (concession, _CONCESSION_SQL),
    "pivot_staging": (pivot_staging, _PIVOT_SQL),
    "variation": (variation, _VARIATION_SQL),
}
