"""What the family pipelines share."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

from gridspark.functions.binding import let
from gridspark.functions.dates import first_year, month_end, reporting_date_text, to_reporting_date
from gridspark.model import SHEET, issue
from gridspark.operators.grid import area_cells
from gridspark.plans.routing import setting, setting_area, setting_int


class Extraction(NamedTuple):
    """Typed rows of a family (with workbook, sheet and source row), issues, and what it looks at.

    ``visits`` gives, of any of the sheets' cells, the (workbook, sheet, row, col) that the extractor visits: by tests
    of rows and columns against layouts and kept rows, so that an audit of few cells never lists all visited ones.
    """

    rows: DataFrame
    issues: DataFrame
    visits: Callable[[DataFrame], DataFrame]


def among(cells: DataFrame, kept: DataFrame) -> DataFrame:
    """(workbook, sheet, row, col) of the cells that stand in kept row records (with ``cells`` MAP<col, cell>)."""
    records = kept.select(*SHEET, "row", F.map_keys("cells").alias("_cols"))
    return cells.select(*SHEET, "row", "col").join(records, [*SHEET, "row"]).where(
        F.array_contains("_cols", F.col("col"))).select(*SHEET, "row", "col")


def of_family(routed: DataFrame, family: str) -> DataFrame:
    return routed.filter(F.col("family") == family)


def area_or(path: str, default: Column) -> Column:
    """A configured rectangle, else a default one."""
    return F.when(setting_int(f"{path}.first_row").isNotNull(), setting_area(path)).otherwise(default)


def literal_area(area: dict[str, int]) -> Column:
    return F.struct(*[F.lit(v).alias(k) for k, v in area.items()])


def area_rows(area: Column) -> Column:
    return F.sequence(area["first_row"].cast("bigint"), area["last_row"].cast("bigint"))


def reporting_date(area: Column) -> Column:
    """Month end of the first date cell of an area of ``head``, else of the first French month and
    year in its texts, read in order."""
    def read(cells: Column) -> Column:
        dated = F.try_element_at(F.filter(cells, lambda c: c["cell"]["ts"].isNotNull()), F.lit(1))
        text = F.array_join(F.transform(cells, lambda c: c["cell"]["raw"]), " ")
        return F.coalesce(month_end(dated["cell"]["ts"]), reporting_date_text(text))

    return let(area_cells(area), read)


def configured_date(area: Column) -> Column:
    """A configured ``date_reporting`` must be valid; without one the area is read."""
    configured = setting("date_reporting")
    given = configured.isNotNull() & (configured != "")
    return F.when(given, to_reporting_date(configured)).otherwise(reporting_date(area))


def title_years(area: Column) -> Column:
    """Distinct ``20yy`` of an area of ``head`` in reading order."""
    years = F.transform(area_cells(area), lambda c: first_year(c["cell"]["raw"]))
    return F.array_distinct(F.filter(years, lambda y: y.isNotNull()))


def section_array(*fields: str) -> Column:
    """ARRAY of the configured sections with integer settings, in order."""
    from gridspark.plans.routing import setting_names
    return F.transform(setting_names("sections"), lambda name, i: F.struct(
        i.alias("section_ord"), name.alias("section"),
        *[setting_int(F.concat(F.lit("sections."), name, F.lit(f".{f}"))).alias(f) for f in fields]))


def sheet_issues(layout: DataFrame, *faults: tuple[Column, str, Column | str]) -> DataFrame:
    """A rejecting issue per sheet and fault that holds."""
    as_column = lambda m: m if isinstance(m, Column) else F.lit(m)
    found = F.filter(
        F.array(*[F.when(when, F.struct(F.lit(kind).alias("k"), as_column(message).alias("m")))
                  for when, kind, message in faults]),
        lambda f: f.isNotNull())
    return layout.select(*SHEET, F.explode(found).alias("f")).select(*issue(F.col("f.k"), F.col("f.m")))


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)
