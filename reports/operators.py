"""Grid and block operators one by one, over whole tables."""

from __future__ import annotations

from pyspark.sql import Window, functions as F

from gridspark import fixed
from gridspark.model import SHEET
from gridspark.operators import blocks as B, grid as G, select as S
from gridspark.operators.banding import band
from gridspark.plans.activity import activity_layout, report_years
from gridspark.plans.common import reporting_date
from gridspark.plans.pivots import pivot_layout
from reports.families import (
    ACTIVITY_LAYOUT, PIVOT_LAYOUT, concession_grid, flat_grid, penetration_grid, pivot_filters, pivot_grid,
    staging_grid,
)
from reports.grids import lay, money, routed, spot, table, text


def with_band(df, row="row"):
    return df.withColumn("band", band(row))


# --- selection ---------------------------------------------------------------------------------

def clip(spark, sf_dir):
    return S.clip(flat_grid(spark, sf_dir), {"first_row": 4, "last_row": 1000, "first_column": 2, "last_column": 3}).select(
        "sheet", "row", "col", F.when(F.col("col") == 3, F.col("raw")).alias("status"))


_CLIP_SQL = """
WITH b AS (SELECT *, 'part ' || (o_orderkey // 5000) AS sheet, 4 + o_orderkey % 5000 AS row FROM orders WHERE o_orderkey % 5000 < 3000)
SELECT sheet, row, col, CASE WHEN col = 3 THEN o_orderstatus END AS status FROM b, (VALUES (2), (3)) v(col) WHERE row <= 1000
"""


def cell_at(spark, sf_dir):
    cells = B.settle(flat_grid(spark, sf_dir))
    return S.cell_at(cells, "$F4").select("sheet", "raw").unionByName(S.cell_at(cells, "E3").select("sheet", "raw"))


_CELL_SQL = """
SELECT 'part ' || (o_orderkey // 5000) AS sheet, CAST(o_custkey AS VARCHAR) AS raw FROM orders WHERE o_orderkey % 5000 = 0
UNION ALL SELECT DISTINCT 'part ' || (o_orderkey // 5000), 'Année' FROM orders
"""


def find_cells(spark, sf_dir):
    found = S.find_cells(concession_grid(spark, sf_dir), lambda raw: F.startswith(raw, F.lit("TPR ")))
    return found.select("sheet", "row", "col", "raw")


_FIND_SQL = """
SELECT DISTINCT 's' || l_suppkey AS sheet, CASE l_returnflag WHEN 'A' THEN 2 WHEN 'N' THEN 22 ELSE 42 END AS row, 1 AS col,
  'TPR  group ' || l_returnflag AS raw FROM lineitem
"""


def row_type(spark, sf_dir):
    label = F.when(F.col("o_orderpriority") == "1-URGENT", "  marché ").when(
        F.col("o_orderpriority") == "2-HIGH", "Part de Marché").otherwise(F.col("o_orderpriority"))
    return table(spark, sf_dir, "orders").select("o_orderkey", S.row_type(label).alias("row_type"))


def business_rows(spark, sf_dir):
    label = F.concat_ws(" ", "p_name", F.element_at(F.array(*[F.lit(w) for w in ("", "total", "(unités)", "MAD", "x")]),
                                                     (F.col("p_size") % 5 + 1).cast("int")))
    part = table(spark, sf_dir, "part").withColumn("label", label)
    return S.business_rows(part, "label", ["Large widget x"], ["unité", "MAD"]).select("p_partkey", "label")


_BUSINESS_SQL = """
WITH b AS (SELECT p_partkey, p_size, p_name || ' ' || ['', 'total', '(unités)', 'MAD', 'x'][p_size % 5 + 1] AS label FROM part)
SELECT p_partkey, label FROM b WHERE p_size % 5 IN (0, 4) AND lower(trim(label)) <> 'large widget x'
"""

# --- rows and headers --------------------------------------------------------------------------


def header_row(spark, sf_dir):
    return G.header_row(flat_grid(spark, sf_dir)).select("sheet", "header_row")


def header_columns(spark, sf_dir):
    cells = B.settle(flat_grid(spark, sf_dir))
    return G.header_columns(cells, G.header_row(cells)).select("sheet", "col", "name")


_SHEETS = "(SELECT DISTINCT 'part ' || (o_orderkey // 5000) AS sheet FROM orders)"


def pivot_cells(spark, sf_dir):
    cells = G.banded(flat_grid(spark, sf_dir).filter("row > 3"))
    return G.pivot_cells(cells, {"priority": 1, "status": 3, "customer": 6, "nothing": 7}).select(
        "sheet", "row", "priority", "status", "customer", "nothing")


_PIVOT_CELLS_SQL = """
SELECT 'part ' || (o_orderkey // 5000) AS sheet, 4 + o_orderkey % 5000 + CASE WHEN o_orderkey % 5000 >= 3000 THEN 1 ELSE 0 END AS row,
  o_orderpriority AS priority, o_orderstatus AS status, CAST(o_custkey AS VARCHAR) AS customer, CAST(NULL AS VARCHAR) AS nothing FROM orders
"""


def table_rows(spark, sf_dir):
    """All orders as sheets of 200 rows, each with an empty row somewhere: the rows above it."""
    sheet, place = F.floor(F.col("o_orderkey") / 200), F.col("o_orderkey") % 200
    orders = table(spark, sf_dir, "orders").withColumns({"sheet": sheet, "row": place + (place >= 20 + sheet % 150).cast("int")})
    first = orders.groupBy("sheet").agg(F.min("row").alias("start"))
    return G.table_rows(with_band(orders).join(first, "sheet"), ["sheet"], F.col("start")).select("sheet", "o_orderkey")


_TABLE_ROWS_SQL = """
WITH o AS (SELECT o_orderkey // 200 AS sheet, o_orderkey, o_orderkey % 200 AS place FROM orders),
b AS (SELECT sheet, o_orderkey, place + CASE WHEN place >= 20 + sheet % 150 THEN 1 ELSE 0 END AS row FROM o),
n AS (SELECT sheet, o_orderkey, row, min(row) OVER (PARTITION BY sheet) AS f, row_number() OVER (PARTITION BY sheet ORDER BY row) AS n FROM b)
SELECT sheet, o_orderkey FROM n WHERE row - n = f - 1
"""


def until_total(spark, sf_dir):
    """Orders of a customer up to its first urgent one, inclusive and exclusive."""
    orders = with_band(table(spark, sf_dir, "orders").withColumn("row", F.col("o_orderkey")))
    urgent = F.col("o_orderpriority") == "1-URGENT"
    parts = [G.until_total(orders, ["o_custkey"], urgent, inclusive).select(
        "o_custkey", "o_orderkey", F.lit(int(inclusive)).alias("inclusive")) for inclusive in (True, False)]
    return parts[0].unionByName(parts[1])


_UNTIL_SQL = """
WITH b AS (SELECT o_custkey, o_orderkey, min(CASE WHEN o_orderpriority = '1-URGENT' THEN o_orderkey END) OVER (PARTITION BY o_custkey) AS t FROM orders)
SELECT o_custkey, o_orderkey, 1 AS inclusive FROM b WHERE t IS NULL OR o_orderkey <= t
UNION ALL SELECT o_custkey, o_orderkey, 0 FROM b WHERE t IS NULL OR o_orderkey < t
"""

# --- context -----------------------------------------------------------------------------------


def carry_forward(spark, sf_dir):
    """Headings carried down the orders of a status; a later type clears the category."""
    orders = with_band(table(spark, sf_dir, "orders").withColumn("row", F.col("o_orderkey")))
    levels = {"heading": F.when(F.col("o_orderkey") % 37 == 0, F.col("o_orderpriority")),
              "category": F.when(F.col("o_orderkey") % 11 == 0, F.col("o_custkey").cast("string"))}
    return G.carry_forward(orders, ["o_orderstatus"], levels, {"category": ["heading"]}).select("o_orderkey", "heading", "category")


_CARRY_SQL = """
WITH b AS (SELECT o_orderkey, o_custkey,
    last_value(CASE WHEN o_orderkey % 37 = 0 THEN o_orderpriority END IGNORE NULLS) OVER w AS heading,
    last_value(CASE WHEN o_orderkey % 37 = 0 THEN o_orderkey END IGNORE NULLS) OVER w AS h_at,
    last_value(CASE WHEN o_orderkey % 11 = 0 THEN o_custkey END IGNORE NULLS) OVER w AS cat,
    last_value(CASE WHEN o_orderkey % 11 = 0 THEN o_orderkey END IGNORE NULLS) OVER w AS c_at
  FROM orders WINDOW w AS (PARTITION BY o_orderstatus ORDER BY o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
SELECT o_orderkey, heading, CASE WHEN coalesce(h_at, -1) < c_at THEN CAST(cat AS VARCHAR) END AS category FROM b
"""


def ordinals(spark, sf_dir):
    customer = with_band(table(spark, sf_dir, "customer").withColumn("row", F.col("c_custkey")))
    return G.ordinals(customer, ["c_nationkey"], "c_mktsegment").select("c_custkey", "ordre_section", "ordre_ligne")


_ORDINALS_SQL = """
WITH f AS (SELECT c_nationkey, c_mktsegment, min(c_custkey) AS k FROM customer GROUP BY ALL),
r AS (SELECT c_nationkey, c_mktsegment, row_number() OVER (PARTITION BY c_nationkey ORDER BY k) AS ordre_section FROM f)
SELECT c_custkey, ordre_section, row_number() OVER (PARTITION BY c_nationkey, c_mktsegment ORDER BY c_custkey) AS ordre_ligne
FROM customer JOIN r USING (c_nationkey, c_mktsegment)
"""


def propagate_market(spark, sf_dir):
    """The last urgent order of a customer as the market of its other orders."""
    orders = with_band(table(spark, sf_dir, "orders").select(
        "o_custkey", "o_orderkey", F.col("o_orderkey").alias("row"), F.col("o_orderstatus").alias("status"), money("o_totalprice").alias("price"), "o_orderpriority"))
    known = G.propagate_market(orders, ["o_custkey"], F.col("o_orderpriority") == "1-URGENT", ["status", "price"])
    return known.select("o_orderkey", "marche_status", F.col("marche_price").cast("double").alias("marche_price"), F.col("has_market").cast("int").alias("has_market"))


_MARKET_SQL = """
WITH m AS (SELECT o_custkey, max_by(o_orderstatus, o_orderkey) AS s, max_by(CAST(o_totalprice AS DECIMAL(18,2)), o_orderkey) AS p
           FROM orders WHERE o_orderpriority = '1-URGENT' GROUP BY o_custkey)
SELECT o_orderkey, s AS marche_status, CAST(p AS DOUBLE) AS marche_price, CAST(m.o_custkey IS NOT NULL AS INTEGER) AS has_market
FROM orders o LEFT JOIN m USING (o_custkey) WHERE o_orderpriority <> '1-URGENT'
"""


def unpivot_measures(spark, sf_dir):
    cells = G.banded(penetration_grid(spark, sf_dir).filter("row > 8"))
    columns = F.array(*[F.struct(F.lit(i).alias("col"), F.lit(n).alias("name")) for i, n in ((3, "n"), (4, "v"))])
    rows = G.pivot_cells(cells).withColumn("label", G.at(F.col("cells"), F.lit(1))["raw"]).filter("label not in ('after', 'Total général')")
    return G.unpivot_measures(rows, columns, ["sheet", "label"]).select(
        "sheet", "label", F.col("measure.name").alias("name"), F.col("cell.num").cast("double").alias("value"))


_UNPIVOT_SQL = """
WITH f AS (SELECT 'u' || user_id AS sheet, event_type AS label, CAST(count(*) AS DOUBLE) AS n,
             CAST(sum(CASE WHEN value >= 5 THEN CAST(value AS DECIMAL(18,2)) END) AS DOUBLE) AS v FROM events GROUP BY ALL)
SELECT sheet, label, name, value FROM f UNPIVOT INCLUDE NULLS (value FOR name IN (n, v))
"""


def merged_headers(spark, sf_dir):
    cells, merged = staging_grid(spark, sf_dir)
    rows = cells.select(*SHEET).distinct().select(
        *SHEET, F.lit(11).cast("bigint").alias("row"), F.lit(2).alias("first_column"), F.lit(23).alias("last_column"))
    return G.merged_headers(cells, merged, rows).select("sheet", "row", "label", "col")


_MERGED_SQL = """
SELECT 'p' || l_partkey AS sheet, 11 AS row, 'flag ' || fl AS label, col
FROM (SELECT DISTINCT l_partkey FROM lineitem), (VALUES ('A', 5), ('A', 6), ('N', 8), ('N', 9), ('R', 11), ('R', 12)) v(fl, col)
"""


def check_headers(spark, sf_dir):
    """Customers whose statuses, by order, are exactly a wanted header."""
    orders = table(spark, sf_dir, "orders")
    whole = orders.groupBy("o_custkey").agg(F.array_sort(F.collect_list(F.struct("o_orderkey", "o_orderstatus")))["o_orderstatus"].alias("s"))
    return whole.select("o_custkey", *[
        G.check_headers(F.col("s"), tuple(wanted)).cast("int").alias(f"is_{wanted.lower()}") for wanted in ("FO", "OF", "FFOO", "O")])


_HEADERS_SQL = """
WITH w AS (SELECT o_custkey, string_agg(o_orderstatus, '' ORDER BY o_orderkey) AS s FROM orders GROUP BY o_custkey)
SELECT o_custkey, CAST(s = 'FO' AS INTEGER) AS is_fo, CAST(s = 'OF' AS INTEGER) AS is_of, CAST(s = 'FFOO' AS INTEGER) AS is_ffoo,
  CAST(s = 'O' AS INTEGER) AS is_o FROM w
"""


def align_periods(spark, sf_dir):
    """Order years of a customer, aligned where there are exactly two."""
    orders = table(spark, sf_dir, "orders").select("o_custkey", F.date_trunc("year", F.col("o_orderdate").cast("timestamp")).cast("date").alias("d")).distinct()
    periods = orders.groupBy("o_custkey").agg(F.collect_list("d").alias("ds"))
    aligned = G.align_periods(F.col("ds"))
    return periods.select("o_custkey", aligned["current"].cast("string").alias("cur"), aligned["previous"].cast("string").alias("prev"))


_ALIGN_SQL = """
SELECT o_custkey, CASE WHEN count(DISTINCT year(o_orderdate)) = 2 THEN max(year(o_orderdate)) || '-01-01' END AS cur,
  CASE WHEN count(DISTINCT year(o_orderdate)) = 2 THEN min(year(o_orderdate)) || '-01-01' END AS prev FROM orders GROUP BY o_custkey
"""


def _title_grid(spark, sf_dir):
    """A sheet per order: month and year in one of three places, a second year behind it."""
    orders = table(spark, sf_dir, "orders")
    year = (F.year("o_orderdate") + 15).cast("string")
    is_text = F.col("o_orderstatus") != "F"
    month = F.element_at(F.array(*[F.lit(m) for m in fixed.MONTH_NAMES]), F.month("o_orderdate"))
    split = F.col("o_orderstatus") == "O"
    return lay(orders, "titles.xlsx", F.col("o_orderkey").cast("string"), [
        text(1, "A", "Statistiques"), text(2, "B", F.when(is_text, F.concat_ws(" ", month, F.when(~split, year)))),
        text(2, "C", F.when(split, year)), spot(2, "D", F.when(~is_text, F.lit("x")), ts=F.when(~is_text, F.col("o_orderdate"))),
        text(3, "A", "contre 2001 et 2002"), text(9, "A", "hors zone 1999"),
    ])


def report_titles(spark, sf_dir):
    """Reporting date and years from the title area."""
    cells = B.settle(_title_grid(spark, sf_dir))
    structure = {k: v for k, v in ACTIVITY_LAYOUT.items() if k != "year_cells"}
    layout = activity_layout(routed(cells, fixed.ACTIVITY, structure))
    rows = G.sheet_rows(cells, layout)
    known = report_years(G.head(rows, layout, F.array(*[F.lit(i).cast("bigint") for i in (1, 2, 3)])))
    return known.select(
        "sheet", reporting_date(F.col("title")).cast("string").alias("date_reporting"), "annee_reference", "annee_comparaison")


_TITLES_SQL = """
WITH b AS (SELECT o_orderkey, o_orderstatus, CAST(o_orderdate AS DATE) AS d, year(o_orderdate) + 15 AS y FROM orders),
t AS (SELECT *, CASE WHEN o_orderstatus = 'F' THEN CASE WHEN year(d) >= 2000 THEN year(d) END ELSE y END AS first_y FROM b)
SELECT CAST(o_orderkey AS VARCHAR) AS sheet,
  CAST(CASE WHEN o_orderstatus = 'F' THEN last_day(d) ELSE last_day(d + INTERVAL 15 YEAR) END AS VARCHAR) AS date_reporting,
  CASE WHEN coalesce(first_y, 2001) <> 2001 THEN CAST(first_y AS INTEGER) WHEN first_y = 2001 THEN NULL ELSE NULL END AS annee_reference,
  CASE WHEN coalesce(first_y, 2001) <> 2001 THEN 2001 END AS annee_comparaison FROM t
"""

# --- blocks ------------------------------------------------------------------------------------


def _blocks(spark, sf_dir):
    cells = B.settle(pivot_grid(spark, sf_dir))
    layout = pivot_layout(routed(cells, fixed.PIVOT_STAGING, PIVOT_LAYOUT), fixed.PIVOT_STAGING)
    bound = B.settle(B.keyed(G.with_layout(G.banded(cells), layout.select(*SHEET, "last_row", "anchor_keys"))))
    found = B.discover_blocks(bound, F.array_contains("anchor_keys", F.col("key")))
    return bound, B.settle(found.join(layout, SHEET))


def discover_blocks(spark, sf_dir):
    _, blocks = _blocks(spark, sf_dir)
    return blocks.select("sheet", "block_index", "header_row", "label_col", "last_col",
                         F.array_join(F.col("headers.raw"), "|").alias("headers"))


_YEARS = "(SELECT DISTINCT o_custkey, year(o_orderdate) AS y FROM orders)"
_DISCOVER_SQL = f"""
SELECT 'c' || o_custkey AS sheet, row_number() OVER (PARTITION BY o_custkey ORDER BY y) AS block_index, 7 AS header_row,
  CAST(1 + 5 * (y - 1995) AS INTEGER) AS label_col, CAST(4 + 5 * (y - 1995) AS INTEGER) AS last_col, 'st F|st O|st P' AS headers FROM {_YEARS}
"""


def period_context(spark, sf_dir):
    bound, blocks = _blocks(spark, sf_dir)
    return B.period_context(bound, blocks, F.lit(3)).select("sheet", "label_col", "annee", "ville", "mois")


_CONTEXT_SQL = f"""
SELECT 'c' || o_custkey AS sheet, CAST(1 + 5 * (y - 1995) AS INTEGER) AS label_col, CAST(y AS VARCHAR) AS annee, CAST(NULL AS VARCHAR) AS ville,
  CASE WHEN y < 1998 THEN '(Plusieurs éléments)' ELSE '3' END AS mois FROM {_YEARS}
"""


def block_axis(spark, sf_dir):
    bound, blocks = _blocks(spark, sf_dir)
    return B.block_axis(bound, blocks).select("sheet", "label_col", "axis")


_AXIS_SQL = f"""
SELECT 'c' || o_custkey AS sheet, CAST(1 + 5 * (y - 1995) AS INTEGER) AS label_col,
  CASE WHEN y % 2 = 0 THEN 'Mois M' ELSE 'ANNEE N-1' END AS axis FROM {_YEARS}
"""


def block_rows(spark, sf_dir):
    """Rows of each block under both policies for blank labels."""
    bound, blocks = _blocks(spark, sf_dir)
    parts = [B.block_rows(bound, blocks, F.lit(keep)).select("sheet", "label_col", "row", "label", F.lit(int(keep)).alias("keep"))
             for keep in (True, False)]
    return parts[0].unionByName(parts[1])


_ROWS_SQL = """
WITH r AS (SELECT o_custkey, year(o_orderdate) AS y, o_orderpriority AS pr,
             7 + row_number() OVER (PARTITION BY o_custkey, year(o_orderdate) ORDER BY o_orderpriority) AS row
           FROM (SELECT DISTINCT o_custkey, o_orderdate, o_orderpriority FROM (SELECT o_custkey, make_date(CAST(year(o_orderdate) AS INTEGER), 1, 1) AS o_orderdate, o_orderpriority FROM orders)))
SELECT 'c' || o_custkey AS sheet, CAST(1 + 5 * (y - 1995) AS INTEGER) AS label_col, row, CASE WHEN pr <> '5-LOW' THEN pr END AS label, 1 AS keep FROM r
UNION ALL SELECT 'c' || o_custkey, CAST(1 + 5 * (y - 1995) AS INTEGER), row, pr, 0 FROM r WHERE pr <> '5-LOW'
"""


def assign_zones(spark, sf_dir):
    cells = B.settle(concession_grid(spark, sf_dir))
    layout = pivot_layout(routed(cells, fixed.CONCESSION, {}), fixed.CONCESSION)
    bound = B.settle(B.keyed(G.with_layout(G.banded(cells), layout.select(*SHEET, "last_row", "anchor_keys"))))
    found = B.settle(B.discover_blocks(bound, F.array_contains("anchor_keys", F.col("key"))))
    markers = S.find_cells(bound, lambda raw: F.startswith(raw, F.lit("TPR "))).select(*SHEET, "row", "col", "raw")
    return B.assign_zones(markers, found).select("sheet", "header_row", "label_col", "marker_row", "marker_col", "marker", "zone_end")


_ZONES_SQL = """
WITH z AS (SELECT DISTINCT l_suppkey, l_returnflag AS f, CASE l_returnflag WHEN 'A' THEN 2 WHEN 'N' THEN 22 ELSE 42 END AS m FROM lineitem),
e AS (SELECT *, lead(m) OVER (PARTITION BY l_suppkey ORDER BY m) AS zone_end FROM z),
b AS (SELECT DISTINCT l_suppkey, l_returnflag AS f, l_linestatus AS st FROM lineitem)
SELECT 's' || l_suppkey AS sheet, m + 3 AS header_row, CASE WHEN st = 'O' THEN 8 ELSE 2 END AS label_col, m AS marker_row, 1 AS marker_col,
  'TPR  group ' || f AS marker, zone_end FROM e JOIN b USING (l_suppkey, f)
"""


def resolve_filters(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    caption = F.when(F.col("y") < 1998, "(plusieurs éléments)").otherwise("(Tous)")
    blocks = orders.select("o_custkey", F.year("o_orderdate").alias("y")).distinct().select(
        F.lit("pivots.xlsx").alias("workbook"), F.concat(F.lit("c"), F.col("o_custkey").cast("string")).alias("sheet"),
        (1 + 5 * (F.col("y") - 1995)).alias("label_col"), caption.alias("mois"))
    return B.resolve_filters(blocks, pivot_filters(spark, sf_dir)).select("sheet", "label_col", "mois")


_FILTERS_SQL = """
WITH m AS (SELECT DISTINCT o_custkey, year(o_orderdate) AS y, month(o_orderdate) AS mo FROM orders)
SELECT 'c' || o_custkey AS sheet, CAST(1 + 5 * (y - 1995) AS INTEGER) AS label_col,
  CASE WHEN y < 1998 THEN string_agg(CAST(mo AS VARCHAR), ',' ORDER BY mo) ELSE '(Tous)' END AS mois FROM m GROUP BY o_custkey, y
"""

REPORTS = {
    "clip": (clip, _CLIP_SQL), "cell_at": (cell_at, _CELL_SQL), "find_cells": (find_cells, _FIND_SQL),
    "row_type": (row_type, "SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN 'marche' WHEN '2-HIGH' THEN 'part_marche' ELSE 'organisme' END AS row_type FROM orders"),
    "business_rows": (business_rows, _BUSINESS_SQL),
    "header_row": (header_row, f"SELECT sheet, 3 AS header_row FROM {_SHEETS}"),
    "header_columns": (header_columns, f"SELECT sheet, col, name FROM {_SHEETS}, (VALUES (1, 'marque'), (2, 'nombre'), (3, 'ville'), (4, 'mois'), (5, 'annee'), (6, 'source')) v(col, name)"),
    "pivot_cells": (pivot_cells, _PIVOT_CELLS_SQL),
    "table_rows": (table_rows, _TABLE_ROWS_SQL), "until_total": (until_total, _UNTIL_SQL),
    "carry_forward": (carry_forward, _CARRY_SQL), "ordinals": (ordinals, _ORDINALS_SQL),
    "propagate_market": (propagate_market, _MARKET_SQL), "unpivot_measures": (unpivot_measures, _UNPIVOT_SQL),
    "merged_headers": (merged_headers, _MERGED_SQL), "check_headers": (check_headers, _HEADERS_SQL),
    "align_periods": (align_periods, _ALIGN_SQL), "report_titles": (report_titles, _TITLES_SQL),
    "discover_blocks": (discover_blocks, _DISCOVER_SQL), "period_context": (period_context, _CONTEXT_SQL),
    "block_axis": (block_axis, _AXIS_SQL), "block_rows": (block_rows, _ROWS_SQL),
    "assign_zones": (assign_zones, _ZONES_SQL), "resolve_filters": (resolve_filters, _FILTERS_SQL),
}
