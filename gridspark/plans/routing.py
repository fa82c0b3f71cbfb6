"""Rules as tables, and the joins that route sheets to families."""

from __future__ import annotations

import json
from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce
from pathlib import Path
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from gridspark import fixed
from gridspark.functions.coords import col_index
from gridspark.functions.text import sheet_key
from gridspark.model import SHEET, VALIDATE, issue
from gridspark.operators.banding import look_up

FAMILIES = (
    fixed.ACTIVITY, fixed.SUMMARY, fixed.QUARTERLY, fixed.DETAILS,
    fixed.PENETRATION, fixed.CONCESSION, fixed.PIVOT_STAGING, fixed.VARIATION,
)
POLICIES = ("warning", "reject")

OWNERS = "family string, sheet_key string, enabled boolean"
STRUCTURES = "workbook_key string, sheet_key string, structure map<string,string>"
WORKBOOKS = "workbook_key string, inherit_defaults boolean, enabled_families array<string>"


@dataclass(frozen=True)
class Rules:
    """Configuration as three tables.

    ``owners`` says which family owns a sheet name, ``structures`` how a sheet is laid out (a map
    from dotted path to text; lists are JSON), by default or for one workbook, ``workbooks`` which
    families a workbook uses and whether it inherits the defaults.
    """

    owners: DataFrame
    structures: DataFrame
    workbooks: DataFrame
    error_policy: str = "warning"
    missing_cache_policy: str = "warning"


def flatten(structure: Mapping[str, Any], prefix: str = "") -> dict[str, str]:
    """Nested configuration to dotted paths; an empty alias list stays as ``[]``."""
    flat: dict[str, str] = {}
    for key, value in structure.items():
        path = f"{prefix}{key}"
        if isinstance(value, Mapping):
            flat.update(flatten(value, f"{path}."))
        elif isinstance(value, bool) or isinstance(value, (list, tuple)):
            flat[path] = json.dumps(value, ensure_ascii=False)
        elif value is not None:
            flat[path] = str(value)
    return flat


def rules_from_mappings(spark: SparkSession, families: Mapping[str, Any],
                        workbooks: Mapping[str, Any], settings: Mapping[str, Any] | None = None) -> Rules:
    """Rules from parsed configuration mappings: families by name with ``enabled`` and
    ``family_sheets``; ``defaults.sheets`` and a list of ``workbooks`` with ``file_name``,
    ``inherit_defaults``, ``enabled_families`` and ``sheets``."""
    excel = (settings or {}).get("excel", {})
    owners = [
        (name, sheet, bool(family.get("enabled", True)))
        for name, family in families.items() for sheet in family.get("family_sheets") or []
    ]
    structures = [
        (None, sheet, flatten(layout))
        for sheet, layout in (workbooks.get("defaults", {}).get("sheets") or {}).items()
    ]
    books = []
    for book in workbooks.get("workbooks") or []:
        books.append((book["file_name"], bool(book.get("inherit_defaults", True)), book.get("enabled_families")))
        structures += [
            (book["file_name"], sheet, flatten(layout)) for sheet, layout in (book.get("sheets") or {}).items()
        ]
    keyed = lambda rows, schema, *cols: spark.createDataFrame(rows, schema).withColumns(
        {c: sheet_key(F.col(c)) for c in cols})
    return Rules(
        owners=keyed(owners, OWNERS, "sheet_key"),
        structures=keyed(structures, STRUCTURES, "sheet_key").withColumn(
            "workbook_key", F.when(F.col("workbook_key").isNotNull(), sheet_key(F.col("workbook_key")))),
        workbooks=keyed(books, WORKBOOKS, "workbook_key"),
        error_policy=str(excel.get("error_policy", "warning")).lower(),
        missing_cache_policy=str(excel.get("missing_formula_cache_policy", "warning")).lower(),
    )


def rules_from_files(spark: SparkSession, config_dir: str) -> Rules:
    """Rules from ``families``, ``workbooks`` and ``settings`` files, JSON or (with PyYAML) YAML."""
    def load(name: str) -> dict[str, Any]:
        path = Path(config_dir) / f"{name}.json"
        if path.exists():
            return json.loads(path.read_text(encoding="utf-8"))
        try:
            import yaml
        except ImportError as exc:
            raise RuntimeError("YAML rules need PyYAML; JSON rules do not") from exc
        return yaml.safe_load((Path(config_dir) / f"{name}.yml").read_text(encoding="utf-8")) or {}

    return rules_from_mappings(spark, load("families")["families"], load("workbooks"), load("settings"))


# --- reading a structure -----------------------------------------------------------------------

def setting(path: str | Column) -> Column:
    return F.element_at("structure", F.lit(path) if isinstance(path, str) else path)


def setting_int(path: str | Column) -> Column:
    return setting(path).try_cast("int")


def setting_col(path: str | Column) -> Column:
    return col_index(setting(path))


def setting_list(path: str, element: str = "string") -> Column:
    return F.coalesce(F.from_json(setting(path), f"array<{element}>"), F.array().cast(f"array<{element}>"))


def setting_flag(path: str, default: bool) -> Column:
    return F.coalesce(setting(path) == "true", F.lit(default))


def setting_map(prefix: str) -> Column:
    """MAP of the leaves directly below a path."""
    start = len(prefix) + 2
    return F.transform_keys(
        F.map_filter("structure", lambda k, _: F.startswith(k, F.lit(f"{prefix}."))),
        lambda k, _: F.substr(k, F.lit(start)),
    )


def setting_aliases(prefix: str) -> Column:
    """MAP<target, aliases> below a path."""
    return F.transform_values(setting_map(prefix), lambda _, v: F.from_json(v, "array<string>"))


def setting_names(prefix: str) -> Column:
    """Names below a path, in configured order."""
    return F.array_distinct(F.transform(F.map_keys(setting_map(prefix)), lambda k: F.split(k, r"\.")[0]))


def setting_area(path: str) -> Column:
    return F.struct(*[
        setting_int(f"{path}.{edge}").alias(edge)
        for edge in ("first_row", "last_row", "first_column", "last_column")
    ])


# --- routing -----------------------------------------------------------------------------------

def sheet_index(sheets: DataFrame) -> DataFrame:
    """``sheets`` with their key and how many sheets of the workbook share it."""
    keyed = sheets.withColumn("sheet_key", sheet_key(F.col("sheet")))
    # Shared by more than one sheet only: the counts that matter are few.
    shared = (
        keyed.groupBy("workbook", "sheet_key").count().filter("count > 1")
        .select("workbook", "sheet_key", F.col("count").alias("same_key"))
    )
    return keyed.join(shared, ["workbook", "sheet_key"], "left").fillna(1, ["same_key"])


def merge_structures(base: Column, own: Column) -> Column:
    """A workbook's settings laid over the defaults path by path: a default path stays unless
    the workbook sets it or a path above it."""
    empty = F.create_map().cast("map<string,string>")
    base, own = F.coalesce(base, empty), F.coalesce(own, empty)
    set_anew = lambda path: F.exists(
        F.map_keys(own), lambda o: (o == path) | F.startswith(path, F.concat(o, F.lit("."))))
    return F.map_concat(F.map_filter(base, lambda path, _: ~set_anew(path)), own)


def effective_rules(wanted: DataFrame, structures: DataFrame, workbooks: DataFrame) -> DataFrame:
    """``wanted`` (workbook_key, sheet_key, …) with ``structure`` and ``entries``.

    A workbook without an entry uses the defaults; one that inherits gets the defaults with its own
    settings laid over them; one that does not has only its own. More than one entry for a
    workbook (``entries``) is an error. ``structure`` is NULL where nothing applies.
    """
    books = workbooks.groupBy("workbook_key").agg(
        F.bool_and("inherit_defaults").alias("_inherits"), F.count("*").alias("entries"))
    defaults = structures.filter("workbook_key is null").select("sheet_key", F.col("structure").alias("_base"))
    own = structures.filter("workbook_key is not null").select(
        "workbook_key", "sheet_key", F.col("structure").alias("_own"))
    base = F.when(F.coalesce("_inherits", F.lit(True)), F.col("_base"))
    # Names of sheets repeat over workbooks, and a few may stand in nearly all of them.
    with_defaults = look_up(look_up(wanted, books, "workbook_key", ["sheet_key"]), defaults, "sheet_key", ["workbook_key"])
    return (
        with_defaults.join(own, ["workbook_key", "sheet_key"], "left")
        .withColumn("structure", F.when(base.isNotNull() | F.col("_own").isNotNull(),
                                        merge_structures(base, F.col("_own"))))
        .withColumn("entries", F.coalesce("entries", F.lit(1)))
        .drop("_inherits", "_base", "_own")
    )


def route_report(sheets: DataFrame, rules: Rules) -> DataFrame:
    """Outcome per sheet and per configured name: ``routed``, ``hidden``, ``no_structure``,
    ``not_configured``, ``not_found``, and the errors ``family_mismatch``, ``routed_twice``,
    ``ambiguous_name``, ``ambiguous_workbook``.

    Rules are configuration; Spark broadcasts them when their measured size allows.
    """
    books = rules.workbooks.groupBy("workbook_key").agg(F.first("enabled_families").alias("enabled_families"))
    owners = (
        rules.owners.filter("enabled").groupBy("sheet_key")
        .agg(F.array_sort(F.collect_set("family")).alias("owner_families"), F.count("*").alias("_owned"))
    )
    keyed = sheet_index(sheets).withColumn("workbook_key", sheet_key(F.col("workbook")))
    indexed = look_up(look_up(keyed, books, "workbook_key", SHEET), owners, "sheet_key", SHEET)
    allowed = F.filter("owner_families", lambda f: F.coalesce(
        F.array_contains("enabled_families", f), F.lit(True)))
    indexed = indexed.withColumn("families", F.when(F.col("owner_families").isNotNull(), allowed))
    joined = effective_rules(indexed, rules.structures, rules.workbooks)
    configured = F.coalesce(F.size("families"), F.lit(0)) > 0
    outcome = (
        F.when(F.col("same_key") > 1, "ambiguous_name")
        .when(F.col("entries") > 1, "ambiguous_workbook")
        .when(~configured, "not_configured")
        .when(F.col("sheet_state") != "visible", "hidden")
        .when((F.size("families") > 1) | (F.col("_owned") > F.size("owner_families")), "routed_twice")
        .when(F.col("structure").isNull() | (F.size("structure") == 0), "no_structure")
        .when(~F.col("structure")["family"].eqNullSafe(F.col("families")[0]), "family_mismatch")
        .otherwise("routed")
    )
    known = joined.select(
        *SHEET, "ordinal", "sheet_state", "last_row", "last_col", "sheet_key",
        F.when(configured, F.col("families")[0]).alias("family"), "structure", outcome.alias("outcome"))
    return known.unionByName(_not_found(known, rules, books), allowMissingColumns=True)


def _not_found(known: DataFrame, rules: Rules, books: DataFrame) -> DataFrame:
    """Configured names that a workbook lacks: its enabled families' names without its sheets."""
    every = F.array(*[F.lit(f) for f in FAMILIES])
    named = known.select("workbook").distinct().withColumn("workbook_key", sheet_key(F.col("workbook")))
    enabled = look_up(named, books, "workbook_key", ["workbook"]).select(
        "workbook", F.explode(F.coalesce("enabled_families", every)).alias("family"))
    # A family is of nearly every workbook.
    expected = look_up(enabled, rules.owners.filter("enabled").select("family", "sheet_key").distinct(), "family", ["workbook"], "inner")
    return expected.join(known.select("workbook", "sheet_key"), ["workbook", "sheet_key"], "left_anti").select(
        "workbook", "sheet_key", "family", F.lit("not_found").alias("outcome"))


def route(sheets: DataFrame, rules: Rules) -> DataFrame:
    """(workbook, sheet, ordinal, last_row, last_col, family, structure) of the sheets to extract."""
    return route_report(sheets, rules).filter("outcome = 'routed'").select(
        *SHEET, "ordinal", "last_row", "last_col", "family", "structure")


def routing_issues(report: DataFrame) -> DataFrame:
    """Errors of :func:`route_report` as issues."""
    wrong = ("family_mismatch", "routed_twice", "ambiguous_name", "ambiguous_workbook")
    return report.filter(F.col("outcome").isin(*wrong)).select(
        *issue("routing", F.concat(F.lit("Sheet not routed: "), F.col("outcome")), stage=VALIDATE))


def check_rules(rules: Rules) -> DataFrame:
    """Faults of the rules: (check, subject, message)."""
    spark = rules.owners.sparkSession
    fault = lambda df, check, subject, message: df.select(
        F.lit(check).alias("check"), subject.cast("string").alias("subject"), message.alias("message"))
    policies = spark.createDataFrame(
        [("error_policy", rules.error_policy), ("missing_formula_cache_policy", rules.missing_cache_policy)],
        "name string, policy string")
    owners, structures = rules.owners, rules.structures
    declared = structures.join(owners.select("sheet_key", F.col("family").alias("owner")), "sheet_key", "left")
    limits, key = setting_area("limits"), F.col("sheet_key")
    tables = setting_list(
        "tables", "struct<header_row:int,data_start_row:int,data_end_row:int,ville_column:string,"
                  "variation_column:string,value_columns:array<string>>")
    variation = structures.filter(setting("family") == fixed.VARIATION)
    table = variation.select("sheet_key", F.explode(tables).alias("t"))
    default_only = structures.filter("workbook_key is null")
    faults = [
        fault(policies.filter(~F.col("policy").isin(*POLICIES)), "policy", F.col("name"),
              F.lit("must be warning or reject")),
        fault(owners.filter(key == ""), "empty_sheet", F.col("family"), F.lit("empty sheet name")),
        fault(owners.filter(~F.col("family").isin(*FAMILIES)).select("family").distinct(),
              "unknown_family", F.col("family"), F.lit("no such family")),
        fault(owners.groupBy("sheet_key").agg(F.count("*").alias("n")).filter("n > 1"),
              "two_owners", key, F.lit("sheet owned more than once")),
        fault(declared.filter("owner is null"), "unowned_sheet", key, F.lit("structure of an unowned sheet")),
        fault(declared.filter(F.col("owner").isNotNull() & ~setting("family").eqNullSafe(F.col("owner"))),
              "family_mismatch", key, F.lit("structure declares another family")),
        fault(structures.filter((limits["first_row"] > limits["last_row"])
                                | (limits["first_column"] > limits["last_column"])),
              "limits", key, F.lit("first limit beyond the last")),
        fault(structures.filter(setting("label_column").isNotNull() & setting_col("label_column").isNull()),
              "column", key, F.lit("label_column is no column")),
        fault(default_only.filter((setting("family") == fixed.VARIATION) & (F.size(tables) == 0)),
              "tables", key, F.lit("tables required")),
        fault(table.filter(F.coalesce(F.size("t.value_columns"), F.lit(0)) != 2),
              "period_columns", key, F.lit("two period columns required")),
        fault(table.filter(F.col("t.header_row").isNull() | F.col("t.data_start_row").isNull()
                           | F.col("t.data_end_row").isNull()),
              "table_rows", key, F.lit("header_row, data_start_row and data_end_row required")),
        fault(table.filter("t.data_start_row > t.data_end_row"), "table_rows", key, F.lit("first row beyond the last")),
        fault(table.filter(col_index(F.col("t.ville_column")).isNull()
                           | col_index(F.col("t.variation_column")).isNull()
                           | F.exists("t.value_columns", lambda c: col_index(c).isNull())),
              "column", key, F.lit("table names no valid column")),
        fault(rules.workbooks.filter(F.coalesce("workbook_key", F.lit("")) == ""),
              "file_name", F.col("workbook_key"), F.lit("file name required")),
        fault(rules.workbooks.filter(F.size("enabled_families") == 0),
              "enabled_families", F.col("workbook_key"), F.lit("must not be empty")),
        fault(rules.workbooks.select("workbook_key", F.explode("enabled_families").alias("f"))
              .join(owners.select(F.col("family").alias("f")).distinct(), "f", "left_anti"),
              "unknown_family", F.col("f"), F.lit("enabled but not defined")),
    ]
    return reduce(DataFrame.unionByName, faults)
