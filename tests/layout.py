"""Small grids written by hand as cell tables."""

from __future__ import annotations

from datetime import date, datetime

from gridspark.functions.numeric import to_number  # noqa: F401  (import check)
from gridspark.model import CELLS, SHEETS


def col(letters: str) -> int:
    number = 0
    for letter in letters:
        number = number * 26 + ord(letter) - 64
    return number


def split_a1(a1: str) -> tuple[int, int]:
    letters = a1.rstrip("0123456789")
    return int(a1[len(letters):]), col(letters)


def cell_row(workbook, sheet, a1, value):
    """``value`` is text, a number, a date, or (value, number format), or a dict with ``formula``."""
    row, column = split_a1(a1)
    number_format, formula = "General", None
    if isinstance(value, dict):
        formula, value = value["formula"], value.get("value")
    if isinstance(value, tuple):
        value, number_format = value
    ts, kind = None, "s"
    if isinstance(value, bool):
        raw, kind = str(value), "b"
    elif isinstance(value, datetime) or isinstance(value, date):
        ts = value if isinstance(value, datetime) else datetime(value.year, value.month, value.day)
        raw, kind = ts.strftime("%Y-%m-%d %H:%M:%S"), "d"
    elif isinstance(value, (int, float)):
        raw, kind = str(value), "n"
    else:
        raw = value
    return (workbook, sheet, row, column, raw, kind, ts, formula, number_format)


def grid(spark, cells: dict[str, object], workbook="book.xlsx", sheet="S"):
    return spark.createDataFrame([cell_row(workbook, sheet, a1, v) for a1, v in cells.items()], CELLS)


def book(spark, sheets: dict[str, dict[str, object]], workbook="book.xlsx"):
    rows = [cell_row(workbook, s, a1, v) for s, cells in sheets.items() for a1, v in cells.items()]
    return spark.createDataFrame(rows, CELLS)


def sheets_of(spark, names, workbook="book.xlsx", state="visible", last_row=200, last_col=60):
    return spark.createDataFrame(
        [(workbook, n, i, state, last_row, last_col) for i, n in enumerate(names)], SHEETS)


def lines(letters: str, first: int, table: list[list[object]]) -> dict[str, object]:
    """Cells of a table: ``letters`` as ``"A B C"``, rows from ``first``; None leaves a cell out."""
    names = letters.split()
    return {
        f"{c}{first + i}": v
        for i, values in enumerate(table) for c, v in zip(names, values) if v is not None
    }


def routed_for(spark, cells, family, structure):
    """Every sheet of ``cells`` routed to one family with one structure."""
    from gridspark.model import SHEET
    from gridspark.plans.routing import flatten
    from pyspark.sql import functions as F

    flat = flatten({"family": family, **structure})
    pairs = [F.lit(x) for kv in flat.items() for x in kv]
    return cells.groupBy(*SHEET).agg(
        F.lit(0).alias("ordinal"), F.max("row").alias("last_row"), F.max("col").alias("last_col")
    ).select(*SHEET, "ordinal", "last_row", "last_col", F.lit(family).alias("family"),
             F.create_map(*pairs).alias("structure"))


def plain(measure):
    """A collected measure as a float, a flag text or None."""
    if measure is None or (measure["num"] is None and measure["flag"] is None):
        return None
    return measure["flag"] if measure["flag"] is not None else float(measure["num"])
