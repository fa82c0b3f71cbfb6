"""Data model: one long cell table for the sheets of all workbooks.

A row of ``cells`` is one non-empty cell. A formula cell without a cached value is a row with
``raw IS NULL``; every test of emptiness therefore looks at ``raw``. Dates carry ``ts`` and the
text ``yyyy-MM-dd HH:mm:ss``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

CELLS = (
    "workbook string, sheet string, row bigint, col int, raw string, kind string, "
    "ts timestamp_ntz, formula string, number_format string"
)
SHEETS = (
    "workbook string, sheet string, ordinal int, sheet_state string, last_row bigint, last_col int"
)
MERGED = (
    "workbook string, sheet string, min_row bigint, max_row bigint, min_col int, max_col int"
)
PAGE_FILTERS = (
    "workbook string, sheet string, min_col int, field string, item_ord int, item string"
)
RULES = (
    "family string, sheet_key string, workbook_key string, enabled boolean, "
    "structure map<string,string>"
)
ISSUES = (
    "workbook string, sheet string, row bigint, col int, kind string, message string, "
    "policy string, stage string"
)

# A sheet of one workbook; the group key of every operator.
SHEET = ["workbook", "sheet"]

# Stages of an issue: an extraction or audit issue leaves no rows, a validation issue keeps
# the candidate rows.
EXTRACT, AUDIT, VALIDATE = "extract", "audit", "validate"


def not_empty(raw: Column) -> Column:
    """The emptiness test: NULL or ``''``; white space is a value."""
    return raw.isNotNull() & (raw != "")


def read_cells(spark: SparkSession, path: str) -> DataFrame:
    """The cell table as stored by :func:`write_cells`."""
    return spark.read.schema(CELLS).parquet(path)


def write_cells(cells: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Store cells clustered by sheet and row band, so that footer statistics prune a read.

    Workbooks are not partition folders: there may be millions of small ones, and one may hold
    a third of all cells.
    """
    from gridspark.operators.banding import band

    (
        cells.withColumn("band", band("row"))
        .repartition(*SHEET, "band")
        .sortWithinPartitions(*SHEET, "row", "col")
        .drop("band")
        .write.mode(mode)
        .parquet(path)
    )


def sheet_extents(cells: DataFrame) -> DataFrame:
    """``sheets`` for a cell table that came without one: every sheet visible, in name order."""
    return (
        cells.groupBy(*SHEET)
        .agg(F.max("row").alias("last_row"), F.max("col").alias("last_col"))
        .select(
            *SHEET, F.lit(None).cast("int").alias("ordinal"),
            F.lit("visible").alias("sheet_state"), "last_row", "last_col",
        )
    )


def issue(kind: str | Column, message: str | Column, *, row: Column | None = None,
          col: Column | None = None, policy: str | Column = "reject",
          stage: str = EXTRACT) -> list[Column]:
    """Select list of an issues row."""
    as_column = lambda v: v if isinstance(v, Column) else F.lit(v)
    return [
        F.col("workbook"), F.col("sheet"),
        (F.lit(None) if row is None else row).cast("bigint").alias("row"),
        (F.lit(None) if col is None else col).cast("int").alias("col"),
        as_column(kind).alias("kind"), as_column(message).alias("message"),
        as_column(policy).alias("policy"), F.lit(stage).alias("stage"),
    ]
