"""What is written can be read back: order of huge sheets, headers, folders, and snapshots over several runs."""

import random
from pathlib import Path

from pyspark.sql import functions as F

from gridspark import fixed
from gridspark.operators.ordering import positioned
from gridspark.plans.batch import run_batch
from gridspark.plans.routing import rules_from_mappings
from gridspark.sinks import snapshots, tables
from gridspark.sinks.tables import folders, read_tables, write_tables
from reports.packages import pack
from tests.test_ingestion import STRINGS, flat_sheet, typed_sheet

VERDICTS = "workbook string, sheet string, status string, rows bigint"


def test_positions_over_partitions(spark):
    rng = random.Random(8)
    rows = [("hot" if rng.random() < 0.8 else rng.choice("ab"), rng.randrange(10**6), i) for i in range(4000)]
    got = positioned(spark.createDataFrame(rows, "k string, o long, i int").repartition(7), ["k"], ["o", "i"], "n").collect()
    wanted, seen = {}, {}
    for k, _, i in sorted(rows):
        seen[k] = seen.get(k, 0) + 1
        wanted[i] = seen[k]
    assert {r.i: r.n for r in got} == wanted


def test_order_comes_back_over_many_parts(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(tables, "FILE_LINES_BITS", 5)
    rng = random.Random(9)
    rows = [("b.xlsx", s, i, rng.randrange(5), f'{s}; "{i}"\n') for s, n in (("huge", 3000), ("small", 3), ("edge", 31)) for i in range(n)]
    df = spark.createDataFrame(rows, "workbook string, sheet string, row bigint, ord int, label string").repartition(5)
    verdicts = spark.createDataFrame([("b.xlsx", s, "success", 1) for s in ("huge", "small", "edge")], VERDICTS)
    write_tables(df, verdicts, ["label"], ["ord", "row"], str(tmp_path / "t"))
    got = sorted((r.sheet_slug, r._order, r.label) for r in read_tables(spark, str(tmp_path / "t"), ["label"]).collect())
    wanted, at = [], {}
    for _, s, _, _, label in sorted(rows, key=lambda r: (r[1], r[3], r[2])):
        at[s] = at.get(s, 0) + 1
        wanted.append((s, at[s], label))
    assert got == sorted(wanted)
    # All parts of a sheet together are its table.
    parts = sorted((tmp_path / "t").glob("status=success/workbook_slug=b/sheet_slug=small/part=*/*.txt"))
    assert "".join(p.read_text(encoding="utf-8") for p in parts).startswith(tables.BOM + "label\n")


def test_header_without_rows_and_equal_slugs(spark, tmp_path):
    verdicts = spark.createDataFrame([("x.xlsx", "A 1", "success", 1), ("x.xlsm", "a-1", "success", 1), ("y.xlsx", "none", "success", 0),
                                      ("y.xlsx", "bad", "rejected", 0)], VERDICTS)
    rows = spark.createDataFrame([("x.xlsx", "A 1", 1, "first"), ("x.xlsm", "a-1", 1, "second")], "workbook string, sheet string, row bigint, label string")
    write_tables(rows, verdicts, ["label"], ["row"], str(tmp_path / "t"))
    got = read_tables(spark, str(tmp_path / "t"), ["label"], header=True).collect()
    slugs = {r.sheet: r.sheet_slug for r in folders(verdicts).collect()}
    assert len(set(slugs.values())) == 4 and slugs["none"] == "none"
    assert sorted((r.sheet_slug, r._order) for r in got) == sorted([(slugs["A 1"], 0), (slugs["A 1"], 1), (slugs["a-1"], 0), (slugs["a-1"], 1), ("none", 0)])


def test_snapshots_of_runs(spark, tmp_path):
    rules = rules_from_mappings(
        spark, {fixed.DETAILS: {"family_sheets": ["détails", "Types"]}},
        {"defaults": {"sheets": {"Détails": {"family": fixed.DETAILS, "layout": "details"},
                                 "Types": {"family": fixed.DETAILS, "layout": "flat"}}}},
        {"excel": {"error_policy": "reject"}})
    first, second = tmp_path / "in1", tmp_path / "in2"
    first.mkdir(), second.mkdir()
    book = lambda *sheets: pack({n: x for n, x in sheets}, STRINGS, {})
    (first / "one.xlsx").write_bytes(book(("Détails", flat_sheet()), ("Types", typed_sheet())))
    (first / "two.xlsx").write_bytes(book(("Détails", flat_sheet())))
    (first / "bad.xlsx").write_bytes(b"no package")
    (second / "two.xlsx").write_bytes(book(("Types", typed_sheet())))
    (second / "bad.xlsx").write_bytes(book(("Détails", flat_sheet())))
    out = [str(tmp_path / f"out{i}") for i in (1, 2)]
    run_batch(spark, str(first), out[0], rules)
    run_batch(spark, str(second), out[1], rules, previous=out[0])
    entries = {(r.workbook, r.sheet): (r.status, Path(r.run).name) for r in snapshots.read_snapshot(spark, out[1]).collect()}
    assert entries == {
        ("one.xlsx", "Détails"): ("success", "out1"), ("one.xlsx", "Types"): ("rejected", "out1"), ("one.xlsx", None): (None, "out1"),
        ("two.xlsx", "Détails"): ("success", "out1"), ("two.xlsx", "Types"): ("rejected", "out2"), ("two.xlsx", None): (None, "out2"),
        ("bad.xlsx", "Détails"): ("success", "out2"), ("bad.xlsx", None): (None, "out2")}
    rows = snapshots.current_table(spark, out[1], "details", fixed.HEADERS["details"]).collect()
    assert sorted((r.workbook, r.sheet, r._order, r.nombre) for r in rows) == [
        (w, "Détails", i, v) for w in ("bad.xlsx", "one.xlsx", "two.xlsx") for i, v in ((1, "2.5"), (2, "3.5"))]
    issues = {(r.workbook, r.sheet, r.kind) for r in snapshots.current_issues(spark, out[1]).collect()}
    assert ("one.xlsx", "Types", "error_value") in issues and not any(k == "package" for _, _, k in issues)
    assert {(r.workbook, r.sheet) for r in snapshots.current_rejections(spark, out[1]).collect()} == {("one.xlsx", "Types"), ("two.xlsx", "Types")}
    manifests = {r.workbook: (r.success_count, r.rejected_count) for r in snapshots.current_manifests(spark, out[1]).collect()}
    assert manifests["one.xlsx"] == (1, 1) and manifests["two.xlsx"] == (0, 1)
    assert "package" in {r.kind for r in snapshots.current_issues(spark, out[0]).collect()}


def test_positions_are_kept_as_columns_in_files(spark):
    rows = spark.range(100).selectExpr("id % 3 AS k", "-id AS o", "CAST(id AS string) AS line")
    got = positioned(rows, ["k"], ["o"], "n", keep=["k", "line"])
    assert got.columns == ["k", "line", "n"] and all(f.endswith(".parquet") for f in got.inputFiles()) and got.inputFiles()
    assert {r.line: r.n for r in got.where("k = 0").collect()} == {str(i): (99 - i) // 3 + 1 for i in range(0, 100, 3)}


def test_facts_of_a_group_meet_its_counts(spark):
    rows = spark.range(100).selectExpr("id % 3 AS k", "-id AS o", "CAST(id AS string) AS line")
    facts = spark.createDataFrame([(0, "zero"), (2, "two"), (7, "none")], "k long, folder string")
    got = positioned(rows, ["k"], ["o"], "n", keep=["k", "line"], facts=facts)
    assert got.columns == ["k", "line", "n", "folder"]
    assert sorted((r.line, r.n, r.folder) for r in got.collect()) == sorted(
        (str(i), (99 - i) // 3 + 1 if i % 3 == 0 else (98 - i) // 3 + 1, "zero" if i % 3 == 0 else "two") for i in range(100) if i % 3 != 1)


def test_lines_move_once_before_they_have_their_place(spark):
    rows = spark.createDataFrame([("b.xlsx", s, i, f"{s}{i}") for s in ("kept", "other") for i in range(40)], "workbook string, sheet string, row bigint, label string")
    verdicts = spark.createDataFrame([("b.xlsx", "kept", "success", 40)], VERDICTS)
    lines = tables.table_lines(rows, verdicts, ["label"], ["row"], ";", False)
    assert sorted((r.position, r.line) for r in lines.collect()) == [(0, "label"), *((i + 1, f"kept{i}") for i in range(40))]
    # What is sorted holds no folder names: these come with the counts of the sheets.
    placed = [spark.read.parquet(f.rsplit("/", 1)[0]).columns for f in lines.inputFiles()]
    assert ["workbook", "sheet", "line", "_n"] in placed
