"""Scalar functions over whole columns."""

from __future__ import annotations

from pyspark.sql import functions as F

from gridspark.functions import coords, dates, numeric, text
from gridspark.sinks.tables import apply_places, published_text
from reports.grids import flag, money, num, table


def _documents(name, function):
    def run(spark, sf_dir):
        return table(spark, sf_dir, "documents").select("doc_id", function(F.col("text")).alias(name))
    return run


_CLEAN = r"trim(regexp_replace(text, '\s+', ' ', 'g'))"
_CANON = "trim(regexp_replace(upper(replace(strip_accents({0}), 'ß', 'ss')), '[^A-Z0-9]+', '_', 'g'), '_')"
_SLUG = r"trim(regexp_replace(lower(regexp_replace(strip_accents({0}), '[^\x00-\x7F]', '', 'g')), '[^a-z0-9]+', '_', 'g'), '_')"


def contains_total(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    word = F.element_at(F.array(*[F.lit(w) for w in ("", " total", "-Totaux", "/Total général", " sous-total")]),
                        (F.col("p_size") % 5 + 1).cast("int"))
    label = F.concat("p_name", word)
    return part.select("p_partkey", label.alias("label"), text.contains_total(label).cast("int").alias("is_total"))


_TOTAL_SQL = """
WITH l AS (SELECT p_partkey, p_name || ['', ' total', '-Totaux', '/Total général', ' sous-total'][p_size % 5 + 1] AS label FROM part)
SELECT p_partkey, label, CAST(regexp_matches(trim(regexp_replace(upper(strip_accents(label)), '[^A-Z0-9]+', '_', 'g'), '_'),
  '(^|_)TOTAL(_|$)') AS INTEGER) AS is_total FROM l
"""


def sheet_key(spark, sf_dir):
    doc = table(spark, sf_dir, "documents")
    name = F.concat(F.lit("  "), F.upper("source"), F.lit("   Straße É "), F.initcap("lang"))
    return doc.select("doc_id", text.sheet_key(name).alias("k"))


def header_name(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    return part.select("p_partkey", text.header_name(F.concat_ws(" - ", "p_brand", "p_type")).alias("name"))


SEGMENTS = {"VEHICULES": ["automobile"], "BATIMENT": ["Building", "furniture"], "MENAGE": ["Hoûsehold"]}


def map_alias(spark, sf_dir):
    customer = table(spark, sf_dir, "customer")
    return customer.select("c_custkey", text.map_alias(F.col("c_mktsegment"), SEGMENTS).alias("target"))


def readable(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    ts = F.when(F.col("o_orderstatus") != "P", F.col("o_orderdate"))
    return orders.select("o_orderkey", text.readable(F.concat(F.lit("  "), "o_orderpriority"), ts).alias("label"))


def column_letters(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", (F.col("l_partkey") % 16384 + 1).cast("int").alias("i"))
    letter = coords.col_letter(F.col("i"))
    return lines.select("l_orderkey", "l_linenumber", "i", letter.alias("letters"), coords.col_index(letter).alias("back"))


_LETTERS_SQL = """
WITH i AS (SELECT l_orderkey, l_linenumber, CAST(l_partkey % 16384 + 1 AS INTEGER) AS i FROM lineitem)
SELECT *, CASE WHEN i <= 26 THEN chr(64 + i) WHEN i <= 702 THEN chr(CAST(64 + (i - 1) // 26 AS INTEGER)) || chr(CAST(65 + (i - 1) % 26 AS INTEGER))
  ELSE chr(CAST(64 + (i - 27) // 676 AS INTEGER)) || chr(CAST(65 + ((i - 27) // 26) % 26 AS INTEGER)) || chr(CAST(65 + (i - 1) % 26 AS INTEGER)) END AS letters,
  i AS back FROM i
"""

# Prices as people write them, with texts between them.


def _decorated():
    french = F.translate(F.format_number("l_extendedprice", 2), ",.", chr(160) + ",")
    line, ret = F.col("l_linenumber"), F.col("l_returnflag")
    return (F.when((line == 1) & (ret == "A"), " ns ").when((line == 2) & (ret == "R"), "#ref!")
            .when((line == 3) & (ret == "N"), " n.c. ").when((line == 4) & (ret == "A"), "  ").otherwise(french))


_PRICE = "CAST(l_extendedprice AS DECIMAL(18,2))"
_WORD = ("CASE WHEN l_linenumber = 1 AND l_returnflag = 'A' THEN 'NS' WHEN l_linenumber = 2 AND l_returnflag = 'R' THEN '#REF!' "
         "WHEN l_linenumber = 3 AND l_returnflag = 'N' THEN 'n.c.' END")
_NONE = f"({_WORD} IS NOT NULL OR (l_linenumber = 4 AND l_returnflag = 'A'))"


def to_measure(spark, sf_dir):
    m = numeric.to_measure(_decorated())
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", num(m).alias("number"), flag(m).alias("flag"))


def format_scaling(spark, sf_dir):
    fmt = F.element_at(F.array(*[F.lit(f) for f in ("#,##0,", "#,##0", '#,##0,"k"', "0.0%", "#,##0;0,", "#,##0,,", "0.00%")]), F.col("l_linenumber"))
    m = numeric.to_measure(money("l_extendedprice").cast("string"))
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", numeric.has_thousands(fmt).cast("int").alias("thousands"),
        num(numeric.scaled(m, fmt)).alias("scaled"), num(numeric.percentage(m, fmt)).alias("percentage"))


_SCALING_SQL = f"""
SELECT l_orderkey, l_partkey, CAST(l_linenumber IN (1, 3) AS INTEGER) AS thousands,
  CAST(CASE WHEN l_linenumber IN (1, 3) THEN {_PRICE} * 0.001 ELSE {_PRICE} END AS DOUBLE) AS scaled,
  CAST(CASE WHEN l_linenumber IN (4, 7) THEN {_PRICE} * 100 ELSE {_PRICE} END AS DOUBLE) AS percentage FROM lineitem
"""


def format_decimal(spark, sf_dir):
    m = numeric.to_measure(_decorated())
    n = m["num"]
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", numeric.format_decimal(n).alias("plain"), numeric.format_decimal(n, 0).alias("whole"),
        numeric.format_decimal(-n, 1).alias("tenths"), numeric.format_measure(numeric.two_decimals(m), 2).alias("published"))


_FORMAT_SQL = f"""
WITH b AS (SELECT l_orderkey, l_partkey, CASE WHEN NOT {_NONE} THEN {_PRICE} END AS n, {_WORD} AS w FROM lineitem)
SELECT l_orderkey, l_partkey, regexp_replace(CAST(n AS VARCHAR), '\\.?0+$', '') AS plain,
  CAST(CAST(round(n, 0) AS DECIMAL(18,0)) AS VARCHAR) AS whole, CAST(CAST(round(-n, 1) AS DECIMAL(18,1)) AS VARCHAR) AS tenths,
  coalesce(w, CAST(n AS VARCHAR), '') AS published FROM b
"""


def to_int(spark, sf_dir):
    m = numeric.to_measure((money("l_quantity") / F.when(F.col("l_linenumber") > 3, 2).otherwise(1)).cast("decimal(18,3)").cast("string"))
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", numeric.to_int(m).cast("int").alias("whole"))


def is_scientific(spark, sf_dir):
    shown = F.when(F.col("o_orderstatus") == "F", F.format_string("%.3e", "o_totalprice")).when(
        F.col("o_orderstatus") == "O", money("o_totalprice").cast("string")).otherwise(F.lit(" 1E5 x"))
    return table(spark, sf_dir, "orders").select("o_orderkey", numeric.is_scientific(shown).cast("int").alias("scientific"))


def rounding_rule(spark, sf_dir):
    """Rounding by column name, and the text that is published."""
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", money("l_extendedprice").alias("prix_mad"), (money("l_extendedprice") / 7).cast("decimal(18,4)").alias("part_pct"),
        money("l_tax").alias("dossiers_reference"), money("l_discount").alias("value"))
    rounded = apply_places(lines)
    fields = {f.name: f for f in lines.schema}
    shown = lines.select("l_orderkey", "l_partkey", published_text(fields["part_pct"]).alias("shown"))
    return rounded.select(
        "l_orderkey", "l_partkey", *[F.col(c).cast("double").alias(c) for c in ("prix_mad", "part_pct", "dossiers_reference", "value")]
    ).unionByName(shown.select(
        "l_orderkey", "l_partkey", *[F.lit(None).cast("double").alias(c) for c in ("prix_mad", "dossiers_reference", "value")],
        F.col("shown").cast("double").alias("part_pct")))


_ROUNDING_SQL = f"""
WITH b AS (SELECT l_orderkey, l_partkey, {_PRICE} AS p, CAST(CAST({_PRICE} AS DECIMAL(24,8)) / 7 AS DECIMAL(18,4)) AS q,
           CAST(l_tax AS DECIMAL(18,2)) AS t, CAST(l_discount AS DECIMAL(18,2)) AS v FROM lineitem)
SELECT l_orderkey, l_partkey, CAST(round(p, 0) AS DOUBLE) AS prix_mad, CAST(round(q, 1) AS DOUBLE) AS part_pct,
  CAST(round(t, 0) AS DOUBLE) AS dossiers_reference, CAST(v AS DOUBLE) AS value FROM b
UNION ALL SELECT l_orderkey, l_partkey, NULL, CAST(round(q, 1) AS DOUBLE), NULL, NULL FROM b
"""

_ABBR = "['janv', 'févr', 'mars', 'avr', 'mai', 'juin', 'juil', 'août', 'sept', 'oct', 'nov', 'déc']"
_LONG = "['janvier', 'février', 'mars', 'avril', 'mai', 'juin', 'juillet', 'août', 'septembre', 'octobre', 'novembre', 'décembre']"
_WORDS = ("janvier", "fév", "Mars", "avr", "mai", "JUIN", "juil", "août", "sept", "oct", "novembre", "Déc")


def _month_word():
    return F.element_at(F.array(*[F.lit(w) for w in _WORDS]), F.month("o_orderdate"))


def parse_period(spark, sf_dir):
    """``Mars-15``, ``avr./2015`` and dates; texts that are no period give NULL."""
    year = F.year("o_orderdate") + 15
    shown = (F.when(F.col("o_orderstatus") == "F", F.concat(_month_word(), F.lit("-"), (year % 100).cast("string")))
             .when(F.col("o_orderpriority") == "5-LOW", F.lit("hier"))
             .otherwise(F.concat(F.lit("au "), _month_word(), F.lit(". / "), year.cast("string"))))
    ts = F.when((F.col("o_orderstatus") == "P") & (F.col("o_orderpriority") != "5-LOW"), F.col("o_orderdate"))
    return table(spark, sf_dir, "orders").select("o_orderkey", dates.parse_period(shown, ts).alias("period"))


_PERIOD_SQL = """
SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN (year(o_orderdate) + 15) || strftime(o_orderdate, '-%m')
  WHEN o_orderpriority = '5-LOW' THEN NULL WHEN o_orderstatus = 'P' THEN strftime(o_orderdate, '%Y-%m')
  ELSE (year(o_orderdate) + 15) || strftime(o_orderdate, '-%m') END AS period FROM orders
"""


def reporting_date_text(spark, sf_dir):
    shown = F.concat(F.lit("Situation arrêtée à fin "), _month_word(), F.lit(" "), (F.year("o_orderdate") + 20).cast("string"), F.lit(" en MDH"))
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", dates.reporting_date_text(shown).cast("string").alias("date_reporting"),
        dates.to_reporting_date(F.date_format("o_orderdate", "yyyy-MM-dd")).cast("string").alias("configured"),
        dates.to_reporting_date(shown).cast("string").alias("wrong"), dates.first_year(shown).alias("y"))


_REPORTING_SQL = """
SELECT o_orderkey, CAST(last_day(CAST(o_orderdate AS DATE) + INTERVAL 20 YEAR) AS VARCHAR) AS date_reporting,
  CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS configured, CAST(NULL AS VARCHAR) AS wrong,
  CASE WHEN year(o_orderdate) + 20 BETWEEN 2000 AND 2099 THEN CAST(year(o_orderdate) + 20 AS INTEGER) END AS y FROM orders
"""


def french_labels(spark, sf_dir):
    ts = F.when(F.col("o_orderstatus") != "P", F.col("o_orderdate"))
    fmt = F.when(F.col("o_orderstatus") == "F", '"tpr" mmm').otherwise("mmm-yy")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", dates.axis_label(F.col("o_orderpriority"), ts, fmt).alias("axis"), dates.period_label(F.col("o_orderdate")).alias("period"))


_LABELS_SQL = f"""
SELECT o_orderkey, CASE o_orderstatus WHEN 'P' THEN o_orderpriority
  WHEN 'F' THEN 'TPR ' || {_ABBR}[month(o_orderdate)] || ' ' || year(o_orderdate)
  ELSE {_LONG}[month(o_orderdate)] || ' ' || year(o_orderdate) END AS axis,
  {_ABBR}[month(o_orderdate)] || '-' || strftime(o_orderdate, '%y') AS period FROM orders
"""

REPORTS = {
    "clean_text": (_documents("cleaned", text.clean_text), f"SELECT doc_id, {_CLEAN} AS cleaned FROM documents"),
    "canonical_text": (_documents("canonical", text.canonical_text), f"SELECT doc_id, {_CANON.format('text')} AS canonical FROM documents"),
    "slugify": (_documents("slug", text.slugify), f"SELECT doc_id, {_SLUG.format('text')} AS slug FROM documents"),
    "contains_total": (contains_total, _TOTAL_SQL),
    "sheet_key": (sheet_key, "SELECT doc_id, lower(source) || ' strasse é ' || lower(lang) AS k FROM documents"),
    "header_name": (header_name, "SELECT p_partkey, replace(lower(p_brand), '#', '_') || '_' || lower(p_type) AS name FROM part"),
    "map_alias": (map_alias, "SELECT c_custkey, CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'VEHICULES' WHEN 'BUILDING' THEN 'BATIMENT' "
                             "WHEN 'FURNITURE' THEN 'BATIMENT' WHEN 'HOUSEHOLD' THEN 'MENAGE' END AS target FROM customer"),
    "readable": (readable, "SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN o_orderpriority ELSE strftime(o_orderdate, '%Y-%m-%d') END AS label FROM orders"),
    "column_letters": (column_letters, _LETTERS_SQL),
    "to_measure": (to_measure, f"SELECT l_orderkey, l_partkey, CASE WHEN NOT {_NONE} THEN CAST({_PRICE} AS DOUBLE) END AS number, {_WORD} AS flag FROM lineitem"),
    "format_scaling": (format_scaling, _SCALING_SQL),
    "format_decimal": (format_decimal, _FORMAT_SQL),
    "to_int": (to_int, "SELECT l_orderkey, l_partkey, CASE WHEN l_linenumber <= 3 OR CAST(l_quantity AS INTEGER) % 2 = 0 THEN "
                       "CAST(l_quantity / CASE WHEN l_linenumber > 3 THEN 2 ELSE 1 END AS INTEGER) END AS whole FROM lineitem"),
    "is_scientific": (is_scientific, "SELECT o_orderkey, CAST(o_orderstatus = 'F' AS INTEGER) AS scientific FROM orders"),
    "rounding_rule": (rounding_rule, _ROUNDING_SQL),
    "parse_period": (parse_period, _PERIOD_SQL),
    "reporting_date_text": (reporting_date_text, _REPORTING_SQL),
    "french_labels": (french_labels, _LABELS_SQL),
}
