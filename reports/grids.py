"""Lay tables out as report grids."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from gridspark.model import SHEET
from gridspark.plans.routing import flatten


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table; one stored in fewer pieces than there are cores is spread over them, as each of its
    rows becomes many cells."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    cores = spark.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)


def money(c: str | Column) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("decimal(18,2)")


def letters(index: int) -> str:
    name = ""
    while index:
        index, rest = divmod(index - 1, 26)
        name = chr(65 + rest) + name
    return name


def number_of(name: str) -> int:
    index = 0
    for letter in name:
        index = index * 26 + ord(letter) - 64
    return index


def spot(row: Column | int, col: Column | int | str, value: Column, kind: str = "n",
         number_format: str | Column = "General", ts: Column | None = None) -> Column:
    """One cell: the value as text, NULL leaves it out."""
    row = row if isinstance(row, Column) else F.lit(row)
    col = F.lit(number_of(col)) if isinstance(col, str) else col if isinstance(col, Column) else F.lit(col)
    number_format = number_format if isinstance(number_format, Column) else F.lit(number_format)
    raw = value.cast("string")
    if ts is not None:
        raw, kind = F.date_format(ts, "yyyy-MM-dd HH:mm:ss"), "d"
    return F.struct(
        row.cast("bigint").alias("row"), col.cast("int").alias("col"), raw.alias("raw"), F.lit(kind).alias("kind"),
        (F.lit(None) if ts is None else ts).cast("timestamp_ntz").alias("ts"), F.lit(None).cast("string").alias("formula"),
        number_format.alias("number_format"))


def text(row: Column | int, col: Column | int | str, value: str | Column) -> Column:
    return spot(row, col, F.lit(value) if isinstance(value, str) else value, "s")


def dated(row: Column | int, col: Column | int | str, iso: str, number_format: str = "mmm-yy") -> Column:
    return spot(row, col, F.lit(iso), number_format=number_format, ts=F.lit(iso).cast("timestamp_ntz"))


def lay(df: DataFrame, workbook: str | Column, sheet: Column, cells: Sequence[Column]) -> DataFrame:
    """Cells of each input row, those with a value."""
    book = F.lit(workbook) if isinstance(workbook, str) else workbook
    return (
        df.select(book.alias("workbook"), sheet.alias("sheet"), F.explode(F.array(*cells)).alias("c"))
        .filter("c.raw is not null").select(*SHEET, "c.*")
    )


def routed(cells: DataFrame, family: str, structure: dict) -> DataFrame:
    """All sheets of a grid routed to one family."""
    pairs = [F.lit(x) for kv in flatten({"family": family, **structure}).items() for x in kv]
    return cells.groupBy(*SHEET).agg(
        F.max("row").alias("last_row"), F.max("col").alias("last_col"),
    ).select(*SHEET, F.lit(0).alias("ordinal"), "last_row", "last_col",
             F.lit(family).alias("family"), F.create_map(*pairs).alias("structure"))


def num(measure: str | Column) -> Column:
    """Number of a measure as a double."""
    return (F.col(measure) if isinstance(measure, str) else measure)["num"].cast("double")


def flag(measure: str | Column) -> Column:
    return (F.col(measure) if isinstance(measure, str) else measure)["flag"]
