"""Workbooks written with the standard library, read back, and run end to end."""

import json
from datetime import datetime
from pathlib import Path

import pytest

from gridspark import fixed
from gridspark.plans.batch import run_batch
from gridspark.plans.routing import rules_from_mappings
from gridspark.sources import workbooks as W
from gridspark.sources.pivots import page_filters
from reports.packages import cell_xml, pack, relationships, sheet_xml

HEAD = '<?xml version="1.0"?>'
MAIN = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'


def pivot_parts():
    """A pivot on the first sheet: field 0 filters months, field 1 is not a page field."""
    items = "".join(f"<item {a}/>" for a in ('x="0"', 'x="1" h="1"', 'x="2"', 'x="3"', 'x="9"', 't="default"', 'x="4"'))
    return {
        "xl/worksheets/_rels/sheet1.xml.rels": relationships([("rId1", "pivotTable", "../pivotTables/pivotTable1.xml")]),
        "xl/pivotTables/pivotTable1.xml": f'{HEAD}<pivotTableDefinition {MAIN}><location ref="F6:H20"/><pivotFields>'
        f'<pivotField><items>{items}</items></pivotField><pivotField/></pivotFields><pageFields><pageField fld="0"/></pageFields></pivotTableDefinition>',
        "xl/pivotTables/_rels/pivotTable1.xml.rels": relationships(
            [("rId1", "pivotCacheDefinition", "../pivotCache/pivotCacheDefinition1.xml")]),
        "xl/pivotCache/pivotCacheDefinition1.xml": f'{HEAD}<pivotCacheDefinition {MAIN}><cacheFields><cacheField name="Mois">'
        '<sharedItems><n v="1"/><s v="caché"/><n v="3.0"/><m/><s v="a &amp; b"/></sharedItems></cacheField>'
        '<cacheField name="Autre"/></cacheFields></pivotCacheDefinition>',
    }


def flat_sheet():
    cells = []
    for i, name in enumerate(("Marque", "Nombre", "Ville", "Mois", "Année", "Source")):
        cells.append((1, "", cell_xml(f"{'ABCDEF'[i]}1", name, "inlineStr")))
    for r in (2, 3):
        cells += [(r, "", cell_xml(f"A{r}", "0", "s")), (r, "", cell_xml(f"B{r}", f"{r}.50")), (r, "", cell_xml(f"C{r}", "1", "s")),
                  (r, "", cell_xml(f"D{r}", "4")), (r, "", cell_xml(f"E{r}", "2026")), (r, "", cell_xml(f"F{r}", "src", "str"))]
    return sheet_xml(cells)


def typed_sheet():
    return sheet_xml([
        (1, "", cell_xml("A1", "0.28999999999999998", style=1)), (1, "", cell_xml("B1", "46113", style=3)),
        (1, "", cell_xml("C1", "1", "b")), (1, "", cell_xml("D1", "#N/A", "e", formula="1/0")),
        (1, "", cell_xml("E1", None, formula="")), (1, "", cell_xml("F1", "0.5", style=4)), (1, "", cell_xml("G1", "2", "s")),
        (3, "", cell_xml("A3", "59")), (3, "", cell_xml("AA3", "12345678901234567890")),
    ], ["A1:C2"])


STRINGS = ["Dacia <&>", "Fès", "<si><r><t>ri</t></r><r><t xml:space=\"preserve\"> ch</t></r></si>"]


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    path = tmp_path_factory.mktemp("in")
    book = pack({"Détails": flat_sheet(), "Types": typed_sheet(), "cachée": flat_sheet()}, STRINGS,
                {"cachée": "veryHidden"}, pivot_parts())
    (path / "Suivi 2026.XLSX").write_bytes(book)
    (path / "~$Suivi 2026.xlsx").write_bytes(b"lock")
    (path / "notes.txt").write_text("x")
    return path


def test_discover(spark, folder):
    assert [r.workbook for r in W.discover(spark, str(folder)).select("workbook").collect()] == ["Suivi 2026.XLSX"]
    for wrong in (folder / "notes.txt", folder / "nowhere"):
        with pytest.raises(ValueError):
            W.discover(spark, str(wrong))


def test_ingest_types(spark, folder):
    cells, sheets, merged = W.ingest(W.discover(spark, str(folder)))
    typed = {(r.row, r.col): r for r in cells.filter("sheet = 'Types'").collect()}
    assert (typed[1, 1].raw, typed[1, 1].kind, typed[1, 1].number_format) == ("0.29", "n", "0.0%")
    assert typed[1, 2].ts == datetime(2026, 4, 1) and typed[1, 2].raw == "2026-04-01 00:00:00"
    assert (typed[1, 3].raw, typed[1, 3].kind) == ("True", "b")
    assert (typed[1, 4].raw, typed[1, 4].kind, typed[1, 4].formula) == ("#N/A", "e", "1/0")
    assert (typed[1, 5].raw, typed[1, 5].formula) == (None, "")
    assert (typed[1, 6].raw, typed[1, 6].kind) == ("12:00:00", "s")
    assert typed[1, 7].raw == "ri ch" and typed[3, 27].raw == "12345678901234567890"
    assert cells.filter("sheet = 'Détails' and row = 2 and col = 1").first().raw == "Dacia <&>"
    shown = sorted((r.ordinal, r.sheet, r.sheet_state, r.last_row, r.last_col) for r in sheets.collect())
    assert shown == [(0, "Détails", "visible", 3, 6), (1, "Types", "visible", 3, 27), (2, "cachée", "veryHidden", 3, 6)]
    assert [tuple(r)[1:] for r in merged.collect()] == [("Types", 1, 2, 1, 3)]


def test_small_chunks_give_the_same_cells(spark, folder, monkeypatch):
    import io
    import zipfile

    data = zipfile.ZipFile(folder / "Suivi 2026.XLSX").read("xl/worksheets/sheet1.xml")
    monkeypatch.setattr(W, "CHUNK_BYTES", 64)
    pieces = list(W._chunks(io.BytesIO(data), "sheet"))
    assert [p[0] for p in pieces if p[2]] == [0, 1, 2] and pieces[-1][2] == b""
    for _, opening, body, closing in pieces[:-1]:
        assert opening.startswith(b"<worksheet") and body.count(b"</row>") == 1 and closing.endswith(b"</worksheet>")


def test_page_filters(spark, folder):
    parts = W.settle(W.unzip(W.discover(spark, str(folder))))
    found = page_filters(parts).orderBy("item_ord").collect()
    assert [(r.sheet, r.min_col, r.field, r.item) for r in found] == [
        ("Détails", 6, "MOIS", "1"), ("Détails", 6, "MOIS", "3"), ("Détails", 6, "MOIS", "a & b")]


def test_batch(spark, folder, tmp_path):
    rules = rules_from_mappings(
        spark, {fixed.DETAILS: {"family_sheets": ["détails", "Types", "cachée"]}},
        {"defaults": {"sheets": {"Détails": {"family": fixed.DETAILS, "layout": "details"},
                                 "Types": {"family": fixed.DETAILS, "layout": "flat"}}}},
        {"excel": {"error_policy": "reject"}})
    verdicts = run_batch(spark, str(folder), str(tmp_path / "out"), rules).collect()
    assert sorted((r.sheet, r.status, r.rows) for r in verdicts) == [("Détails", "success", 2), ("Types", "rejected", 0)]
    files = list(Path(tmp_path / "out/tables").rglob("status=success/workbook_slug=suivi_2026/sheet_slug=details/part=0/*.txt"))
    text = files[0].read_text(encoding="utf-8")
    assert text == "﻿marque;nombre;ville;mois;annee;source\nDacia <&>;2.5;Fès;4;2026;src\nDacia <&>;3.5;Fès;4;2026;src\n".replace("﻿", chr(0xFEFF))
    entries = [json.loads(x) for p in Path(tmp_path / "out/manifests").rglob("*.json") for x in p.read_text(encoding="utf-8").splitlines()]
    assert {(e["success_count"], e["rejected_count"], e["parser"]) for e in entries} == {(1, 1, "extract_details")}
    assert {e["sheet"]: (e["rows"], e["output"]) for e in entries} == {
        "Détails": (2, "tables/details/status=success/workbook_slug=suivi_2026/sheet_slug=details"), "Types": (0, "rejections")}
    rejected = json.loads(next(Path(tmp_path / "out/rejections").rglob("*.json")).read_text(encoding="utf-8"))
    assert rejected["sheet"] == "Types" and {r["kind"] for r in rejected["reasons"]} >= {"error_value"}


def test_bad_packages_are_issues(spark, tmp_path):
    good = pack({"Types": typed_sheet()}, STRINGS, {})
    for name, content in (("good.xlsx", good), ("bad.xlsx", b"no package"), ("cut.xlsx", good[: len(good) // 2])):
        (tmp_path / name).write_bytes(content)
    parts = W.unzip(W.discover(spark, str(tmp_path)))
    faults = W.package_faults(parts)
    assert sorted(r.workbook for r in faults.collect()) == ["bad.xlsx", "cut.xlsx"]
    cells, sheets, _ = W.ingest(W.discover(spark, str(tmp_path)))
    assert {r.workbook for r in sheets.collect()} == {r.workbook for r in cells.collect()} == {"good.xlsx"}


def test_parts_are_read_one_by_one(spark, folder):
    """Listed and streamed part by part, a package gives the same rows; its parts spread over tasks."""
    by = lambda parts: sorted((r.workbook, r.part, r.chunk, r.items_before, r.xml, r.styles_xml, r.fault) for r in parts.collect())
    whole, files = W.unzip(W.discover(spark, str(folder))), W.discover_paths(spark, str(folder))
    assert set(files.columns) == {"workbook", "path"}
    parts = W.unzip_parts(files)
    assert by(parts) == by(whole)
    sheets = parts.filter("book_xml is not null").withColumn("task", W.F.spark_partition_id())
    assert sheets.select("part").distinct().count() == 3 and parts.rdd.getNumPartitions() > 1


def test_faults_of_packages_and_chunks(spark, tmp_path):
    good = flat_sheet()
    broken = good.replace("</v>", "", 1)
    odd = good.replace('<row r="2"', '<row r="two"', 1)
    (tmp_path / "a.xlsx").write_bytes(pack({"Good": good, "Broken": broken, "Odd": odd}, STRINGS, {}))
    (tmp_path / "b.xlsx").write_bytes(b"no package")
    cut = pack({"Good": good}, STRINGS, {})
    (tmp_path / "c.xlsx").write_bytes(cut.replace(b"PK\x01\x02", b"PK\x01\x03"))
    for parts in (W.unzip(W.discover(spark, str(tmp_path))), W.unzip_parts(W.discover_paths(spark, str(tmp_path)))):
        found = W.ingest_parts(parts)
        assert sorted((r.workbook, r.sheet) for r in found.faults.collect()) == [
            ("a.xlsx", "Broken"), ("a.xlsx", "Odd"), ("b.xlsx", ""), ("c.xlsx", "")]
        assert {(r.workbook, r.sheet) for r in found.cells.collect()} == {("a.xlsx", "Good")}


def test_malformed_strings_are_a_fault(spark, tmp_path):
    (tmp_path / "a.xlsx").write_bytes(pack({"Good": flat_sheet()}, ["<si><t>open</si>", *list(STRINGS)[1:]], {}))
    found = W.ingest_parts(W.unzip(W.discover(spark, str(tmp_path))))
    assert [(r.workbook, r.sheet) for r in found.faults.collect()] == [("a.xlsx", "")]


def test_small_parts_leave_a_task_together():
    import pandas as pd

    book = pack({"Types": typed_sheet()}, STRINGS, extra=pivot_parts())
    frames = list(W._unzip(iter([pd.DataFrame([[f"{i}.xlsx", book] for i in range(50)] + [["bad.xlsx", b"no"]], columns=["workbook", "content"])])))
    assert len(frames) == 1
    assert frames[0].groupby("workbook").size().nunique() == 2 and list(frames[0].loc[frames[0]["fault"].notna(), "workbook"]) == ["bad.xlsx"]


def test_small_parts_are_parsed_once_a_chunk(spark, folder):
    """Below the lines of a chunk, not above them, where they would be parsed for every line."""
    cells = W.checked_cells_of(W.unzip(W.discover(spark, str(folder))))
    plan = cells._jdf.queryExecution().optimizedPlan().toString().split("\n")
    lines = next(i for i, line in enumerate(plan) if "Generate" in line and "row_pos" in line)
    assert min(i for i, line in enumerate(plan) if "numFmts" in line or "styles_xml" in line) > lines
