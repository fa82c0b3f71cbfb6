"""Banded operators against plain Python on groups that span many bands, and small helpers."""

import random
import time
from decimal import Decimal

from pyspark.sql import functions as F

from gridspark.functions import dates as D, numeric as N, text as T
from gridspark.operators import grid as G
from gridspark.operators.banding import BAND_ROWS, attach, band, contiguous_prefix, running
from gridspark.operators.blocks import discover_blocks
from gridspark.plans import checks as C, competitor
from gridspark.plans.routing import flatten, rules_from_mappings, check_rules
from gridspark.sinks.tables import read_tables, write_tables
from tests.layout import grid, sheets_of


def numbers(spark, rows, schema="k string, row bigint, v string"):
    return spark.createDataFrame(rows, schema).withColumn("band", band("row"))


def sample(seed=1, n=5000):
    rng = random.Random(seed)
    # One group holds most rows; rows have gaps.
    return [("hot" if rng.random() < 0.9 else "cold", r, rng.choice(["a", "b", None, None])) for r in range(1, n) if rng.random() < 0.8]


def test_running_matches_a_loop(spark):
    rows = sample()
    got = {(r.k, r.row): (r.last, r.n) for r in running(
        numbers(spark, rows), ["k"], "row", latest={"last": F.col("v")}, counted={"n": F.col("v") == "a"}).collect()}
    state, expected = {}, {}
    for k, row, v in rows:
        last, n = state.get(k, (None, 0))
        state[k] = (v or last, n + (v == "a"))
        expected[k, row] = state[k]
    assert got == expected and max(r for _, r, _ in rows) > 4 * BAND_ROWS


def test_attach_whole_group(spark):
    rows = sample(2)
    got = attach(numbers(spark, rows), ["k"], {"top": (F.max("row"), F.max), "n": (F.count("*"), F.sum)})
    for k in ("hot", "cold"):
        mine = [r for g, r, _ in rows if g == k]
        assert [tuple(r) for r in got.filter(F.col("k") == k).select("top", "n").distinct().collect()] == [(max(mine), len(mine))]


def test_contiguous_prefix_over_bands(spark):
    rows = [("x", r, None) for r in range(10, 3000) if r != 2500] + [("y", r, None) for r in range(10, 20)] + [("z", 11, None)]
    kept = contiguous_prefix(numbers(spark, rows), ["k"], "row", F.lit(10))
    assert sorted(tuple(r) for r in kept.groupBy("k").agg(F.max("row"), F.count("*")).collect()) == [("x", 2499, 2490), ("y", 19, 10)]


def test_carry_forward_resets(spark):
    rows = [("s", r, v) for r, v in ((1, "T1"), (2, "C1"), (1500, "x"), (1600, "T2"), (1700, "x"), (4000, "C2"), (4001, "x"))]
    starts = lambda c: F.when(F.startswith("v", F.lit(c)), F.col("v"))
    got = G.carry_forward(numbers(spark, rows), ["k"], {"t": starts("T"), "c": starts("C")}, {"c": ["t"]})
    assert [(r.t, r.c) for r in got.orderBy("row").collect()] == [
        ("T1", None), ("T1", "C1"), ("T1", "C1"), ("T2", None), ("T2", None), ("T2", "C2"), ("T2", "C2")]


def test_ordinals(spark):
    rows = [("s", 5, "b"), ("s", 2000, "a"), ("s", 2001, "b"), ("s", 9000, "a"), ("t", 1, "a")]
    got = G.ordinals(numbers(spark, rows), ["k"], "v", group_order="g", line_order="l").orderBy("k", "row").collect()
    assert [(r.g, r.l) for r in got] == [(1, 1), (2, 1), (1, 2), (2, 2), (1, 1)]


def values(spark, texts, column):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r.v for r in df.select("i", column(F.col("t")).alias("v")).orderBy("i").collect()]


def test_text_functions(spark):
    assert values(spark, [" Étiquettes  de" + chr(160) + "lignes ", None, "N°½", "Straße"], T.canonical_text) == [
        "ETIQUETTES_DE_LIGNES", "", "N_1_2", "STRASSE"]
    assert values(spark, ["Synthése É.xlsx", "a--b", "日本 x"], T.slugify) == ["synthese_e_xlsx", "a_b", "x"]
    assert values(spark, ["Total", "TOTALITE", "sous-total", ""], T.contains_total) == [True, False, True, False]


def test_numbers(spark):
    def show(c):
        m = N.to_measure(c)
        return N.format_measure(m)
    assert values(spark, ["1 234,50", "ns", "#n/a", "abc ", None, "  ", "-0.0", "1e3", "1_000", "NaN", "٣"], show) == [
        "1234.5", "NS", "#N/A", "abc", "", "", "0", "1000", "1000", "NaN", "٣"]
    assert values(spark, ["2870.929", "0.5", "-0.5", "-0.4"], lambda c: N.format_decimal(N.to_number(c), 0)) == ["2871", "1", "-1", "0"]
    assert values(spark, ["#,##0,", '0"a,"', "#,##0,,", "0;0,", None], lambda c: N.has_thousands(c)) == [True, False, False, False, False]


def test_dates(spark):
    assert values(spark, ["Mar-26", "fév. 2025", "", "févr. 2025", "sept/07"], D.parse_period) == ["2026-03", "2025-02", "", None, "2007-09"]
    shown = values(spark, ["au 31 AOÛT 2026", "février - 2024", "mars 1999"], lambda c: D.reporting_date_text(c).cast("string"))
    assert shown == ["2026-08-31", "2024-02-29", None]


def rows_of(spark, rows, schema):
    return spark.createDataFrame([("b", "s", i + 1, *r) for i, r in enumerate(rows)], "workbook string, sheet string, row bigint, " + schema)


def test_duplicates_treat_nulls_as_equal(spark):
    rows = rows_of(spark, [("a", None), ("a", None), ("a", "x"), ("a", None)], "p string, q string")
    assert sorted(r.row for r in C.check_duplicate_keys(rows, ("p", "q")).collect()) == [2, 4]


def test_market_consistency_counts_nulls(spark):
    rows = rows_of(spark, [("g", 1, None), ("g", 1, 2), ("h", None, None), ("h", None, None)], "g string, a int, b int")
    assert C.check_market_consistency(rows, ["g"], ["a", "b"]).count() == 1


def test_audit_policies(spark):
    cells = grid(spark, {"A1": "#ref!", "B1": {"formula": "A1+#NUM!", "value": 1}, "C1": {"formula": "X"}, "D9": "#N/A"})
    seen = cells.filter("row = 1").select("workbook", "sheet", "row", "col")
    found = sorted((r.col, r.kind, r.policy) for r in C.audit(cells, seen, "reject", "warning").collect())
    assert found == [(1, "error_value", "reject"), (2, "formula_error", "reject"), (3, "missing_cache", "warning")]


def test_rules_of_the_configuration(spark):
    assert flatten({"a": {"b": 1, "c": ["x"]}, "d": True}) == {"a.b": "1", "a.c": '["x"]', "d": "true"}
    table = {"header_row": 1, "data_start_row": 5, "data_end_row": 4, "ville_column": "B", "variation_column": "?", "value_columns": ["C"]}
    rules = rules_from_mappings(
        spark, {"production_marque_variation_tpr": {"family_sheets": ["T", "t "]}},
        {"defaults": {"sheets": {"T": {"family": "production_marque_variation_tpr", "tables": [table]}, "U": {"family": "x"}}}},
        {"excel": {"error_policy": "maybe"}})
    assert {r.check for r in check_rules(rules).collect()} == {
        "policy", "two_owners", "unowned_sheet", "period_columns", "table_rows", "column"}


def test_snapshots_replace_stale_sheets(spark, tmp_path):
    schema = "label string, montant_mad decimal(18,2)"
    verdicts = lambda status, sheets: spark.createDataFrame([("b.xlsx", s, status, 1) for s in sheets], "workbook string, sheet string, status string, rows bigint")
    def rows(sheets, text):
        df = spark.createDataFrame([("b.xlsx", s, 1, text) for s in sheets], "workbook string, sheet string, row bigint, label string")
        return df.withColumn("montant_mad", F.lit("1.5").cast("decimal(18,2)"))
    one, two = str(tmp_path / "one"), str(tmp_path / "two")
    write_tables(rows(["x", "y"], " old;\n"), verdicts("success", ["x", "y"]), ["label", "montant_mad"], ["row"], one)
    write_tables(rows(["x"], "new"), verdicts("rejected", ["x"]), ["label", "montant_mad"], ["row"], two, previous=one)
    got = sorted((r.status, r.sheet_slug, r.label, r.montant_mad) for r in read_tables(spark, two, ["label", "montant_mad"]).collect())
    assert got == [("rejected", "x", "new", "2"), ("success", "y", " old;\n", "2")] and schema


def test_layout_helpers(spark):
    assert sheets_of(spark, ["a"]).first().sheet_state == "visible"


def test_plain_notation(spark):
    shown = {"1.23456789E7": "12345678.9", "1.0E-4": "0.0001", "-1.5e+3": "-1500", "12.5": "12.5", "7": "7", "2E20": "200000000000000000000",
             "-1.2345678901234567E-5": "-0.000012345678901234567", "0.0E0": "0", "1.0E0": "1", "text": "text", None: None, "12E1": "120"}
    assert values(spark, list(shown), N.plain_notation) == list(shown.values())


def test_published_places():
    from gridspark.sinks.tables import decimal_places

    assert [decimal_places(n) for n in ("evolution_pct", "dossiers_reference", "montant_mad", "dossiers_pct", "valeur", "ecart_points")] == [1, 0, 0, 1, None, 1]


def test_slugs_fold_once(spark):
    texts = ["Été à Fès", "ﬁn ½ Œuvre", "plain Text 1", "", None]
    got = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").select("i", T.slugify(F.col("t")).alias("s"))
    assert [r.s for r in sorted(got.collect())] == ["ete_a_fes", "fin_12_uvre", "plain_text_1", "", None]
    # Once for texts with characters that become several, once for the others; none where all is ASCII.
    assert got._jdf.queryExecution().analyzed().toString().count("translate(") == 2


def test_lines_without_values_do_not_meet_the_market(spark, monkeypatch):
    seen = []
    whole = competitor.propagate_market
    monkeypatch.setattr(competitor, "propagate_market", lambda df, *a, **k: seen.append(df) or whole(df, *a, **k))
    rows = [("m", 3, None), ("a", 1, 1), ("b", 2, None), ("c", 4, 2)]
    df = spark.createDataFrame([("w", "s", 0, "x", "y", k, "m", r, v) for k, r, v in rows],
                               "workbook string, sheet string, band int, section string, categorie string, canonical string, market_key string, row bigint, v int")
    got = competitor._with_market(df, ("v",)).collect()
    assert sorted((r.canonical, r.v, r.marche_v, r.has_market) for r in got) == [("a", 1, None, True), ("c", 2, None, True)]
    assert seen[0].count() == 3


def test_discover_blocks_reads_the_cells_once(spark):
    """Blocks are found before they are numbered, so the cells are not searched again for each pass of the numbering."""
    rows = [("w", "s", r, c, raw, raw) for r, c, raw in [
        (1, 1, "X"), (2, 1, "A"), (2, 2, "h"), (2, 3, "i"), (2, 5, "A"), (2, 6, "j"), (3, 1, "B"), (3, 2, "k"),
        (BAND_ROWS + 7, 4, "A"), (BAND_ROWS + 7, 5, "l"), (BAND_ROWS + 8, 1, "A"), (BAND_ROWS + 9, 1, ""), (BAND_ROWS + 9, 2, "A")]]
    cells = spark.createDataFrame(rows, "workbook string, sheet string, row bigint, col int, raw string, key string").withColumn("band", band("row"))
    found = discover_blocks(cells, F.col("key") == "A")
    got = [(r.header_row, r.label_col, r.last_col, [h.raw for h in r.headers], r.block_index) for r in found.orderBy("block_index").collect()]
    assert got == [(2, 1, 3, ["h", "i"], 1), (2, 5, 6, ["j"], 2), (BAND_ROWS + 7, 4, 5, ["l"], 3)]
    assert "collect_list" not in found._jdf.queryExecution().optimizedPlan().toString()


def test_dates_are_found_by_one_pattern(spark):
    texts = {"Situation mars 2026 et avril 2025": "2026-03-31", "mars 20 avril./- 2025": "2025-04-30", "xmars 2026": None, "mars 2026x": None, "Février\n2024": "2024-02-29",
             "déc\u00a02031": "2031-12-31", "mai \u0085 2020": None, "mai \u00852020": "2020-05-31", "mai, 2020": None, "": None, "mar 2o26": None, "MARS2026": None}
    got = spark.createDataFrame([(t,) for t in texts], "t string").select("t", D.reporting_date_text(F.col("t")).cast("string").alias("d"))
    assert {r.t: r.d for r in got.collect()} == texts
    # No list of words, and of a text without accents no folding.
    assert "regexp_extract_all" not in got._jdf.queryExecution().analyzed().toString()
    short = spark.createDataFrame([("Mar-26",), ("mar-2026",), ("mar-202",), ("juin/20",), ("",), (None,)], "t string")
    assert [r[0] for r in short.select(D.parse_period(F.col("t"))).collect()] == ["2026-03", "2026-03", None, "2020-06", "", ""]


def test_years_of_a_title_are_read_once(spark):
    from gridspark import fixed
    from gridspark.plans.activity import activity_layout, report_years
    from tests.layout import routed_for

    cells = grid(spark, {"A1": "mars 2026 contre", "B1": "2025", "A2": "2024"})
    layout = activity_layout(routed_for(spark, cells, fixed.ACTIVITY, {"limits": {"first_row": 1, "last_row": 9, "first_column": 1, "last_column": 9}}))
    known = report_years(G.head(G.sheet_rows(cells, layout), layout, F.array(F.lit(1).cast("bigint"), F.lit(2).cast("bigint"))))
    shown = known.select("sheet", "annee_reference", "annee_comparaison")
    assert [(r[1], r[2]) for r in shown.collect()] == [(2026, 2025)]
    assert shown._jdf.queryExecution().optimizedPlan().toString().count("array_distinct") == 1


def test_simple_numbers_are_read_as_they_stand(spark):
    texts = {"12.5": "12.5", "+5": "5", "-0012.50": "-12.5", "5\n": "5", "5\u0085": "5", "1 234,5": "1234.5", "5.": "5", ".5": "0.5", "1_0": "10", "NS": None, "5\nx": None,
             "1234567890123": None, "": None}
    got = spark.createDataFrame([(t,) for t in texts], "t string").select("t", N.to_number(F.col("t"), F.lit("n")).alias("n"))
    assert {r.t: r.n for r in got.collect()} == {t: None if n is None else Decimal(n) for t, n in texts.items()}
    # A number without spaces or commas is neither stripped nor translated first.
    assert r"^[+-]?\d{1,12}" in got._jdf.queryExecution().analyzed().toString()


def test_merged_headers_sort_no_cells(spark):
    cells = grid(spark, {"B2": " Total\u00a0net ", "E2": "  ", "B3": "x"})
    merged = spark.createDataFrame([("book.xlsx", "S", 2, 2, 2, 4), ("book.xlsx", "S", 2, 2, 5, 6), ("book.xlsx", "S", 3, 4, 2, 4)],
                                   "workbook string, sheet string, min_row bigint, max_row bigint, min_col int, max_col int")
    rows = spark.createDataFrame([("book.xlsx", "S", 2, 1, 9)], "workbook string, sheet string, row bigint, first_column int, last_column int")
    found = G.merged_headers(cells, merged, rows)
    assert sorted((r.row, r.label, r.col) for r in found.collect()) == [(2, "Total net", c) for c in (2, 3, 4)]
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "shuffle_hash" in plan and plan.index("AS label") < plan.index("Join")


def shuffle_files(spark):
    blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllBlocks().mkString(" ").split()
    return {b for b in blocks if b.startswith("shuffle_")}


def test_steps_leave_no_shuffle_files(spark):
    from gridspark.operators import settling

    before = shuffle_files(spark)
    counted = numbers(spark, sample()).groupBy("k", "v").count()
    kept = [keep(counted) for keep in (settling.settle, settling.stored)]
    until = time.time() + 20
    while (left := shuffle_files(spark) - before) and time.time() < until:
        time.sleep(0.2)
    assert not left
    wanted = sorted(map(tuple, counted.collect()), key=str)
    assert all(sorted(map(tuple, k.collect()), key=str) == wanted for k in kept)


def test_settings_of_a_step_end_with_it(spark):
    from gridspark.operators import settling

    spark.conf.set("spark.sql.codegen.hugeMethodLimit", "65000")
    try:
        with settling.step(spark):
            assert spark.conf.get("spark.sql.codegen.hugeMethodLimit") == "8000"
        assert spark.conf.get("spark.sql.codegen.hugeMethodLimit") == "65000"
        assert spark.conf.get("spark.sql.execution.replaceHashWithSortAgg") == "false"
    finally:
        spark.conf.unset("spark.sql.codegen.hugeMethodLimit")


def test_head_rows_are_marked_where_cells_meet_their_sheet(spark):
    cells = grid(spark, {"A1": "title", "B3": "1", "C3": "x", "B9": "out", f"B{BAND_ROWS + 5}": "2"})
    layout = cells.groupBy(*G.SHEET).agg(F.max("row").alias("last_row"))
    heads = F.array(F.lit(1).cast("bigint"), F.lit(3).cast("bigint"))
    rows = G.sheet_rows(cells, layout, F.col("row") > BAND_ROWS, heads)
    assert {r.row: (r.is_head, sorted(r.cells)) for r in rows.collect()} == {1: (True, [1]), 3: (True, [2, 3]), BAND_ROWS + 5: (False, [2])}
    # As files they can be read by columns; cells of a line are gathered in one go.
    assert rows.inputFiles() and all(f.endswith(".parquet") for f in rows.inputFiles())
    assert [sorted(r.head) for r in G.head(rows, layout, heads).collect()] == [[1, 3]]


def test_market_is_sought_among_market_rows_alone(spark):
    rows = [("a", 1, "m", "x"), ("a", 2, "o", "y"), ("a", BAND_ROWS + 1, "m", "z"), ("a", 3 * BAND_ROWS, "o", None), ("b", 1, "o", "w"), ("b", 2, None, "v"), (None, 1, "o", "u")]
    df = numbers(spark, rows, "k string, row bigint, what string, v string")
    got = G.propagate_market(df, ["k"], F.col("what") == "m", ["v"])
    assert sorted((r.k, r.row, r.marche_v, r.has_market) for r in got.collect()) == [
        ("a", 2, "z", True), ("a", 3 * BAND_ROWS, "z", True), ("b", 1, None, False), ("b", 2, None, False)]
    # No window over the bands of a group, and no aggregate of the other rows' values.
    assert "Window" not in got._jdf.queryExecution().optimizedPlan().toString()


def test_slots_without_a_value_are_dropped_before_they_are_read(spark):
    from gridspark.functions.numeric import parsed_cell

    cells = grid(spark, {"A2": "Un", "B2": "1", "C2": "  ", "D2": "12345678901234567890", "A3": "Marché"})
    layout = cells.groupBy(*G.SHEET).agg(F.max("row").alias("last_row")).selectExpr(
        "workbook", "sheet", "last_row", "1 AS label_column", "'MARCHE' AS market_key", "'PART' AS share_key",
        "array(named_struct('section', 'S', 'section_ord', 0, 'data_start_row', 1, 'data_end_row', 9)) AS sections",
        "array(named_struct('category_ord', 0, 'categorie', 'b', 'columns', array(2)), named_struct('category_ord', 1, 'categorie', 'c', 'columns', array(3)), "
        "named_struct('category_ord', 2, 'categorie', 'd', 'columns', array(4))) AS slots")
    records = G.banded(cells).groupBy(*G.ROW).agg(F.map_from_entries(F.collect_list(F.struct("col", parsed_cell()))).alias("cells"))
    lines = competitor._market_lines(records, layout, 1)
    assert sorted((r.row, r.categorie) for r in lines.collect()) == [(2, "b"), (2, "d"), (3, "b"), (3, "c"), (3, "d")]
