"""Selected items of pivot-table page filters, read from the package by joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from gridspark.functions.coords import a1_col
from gridspark.functions.text import canonical_text
from gridspark.model import SHEET
from gridspark.operators.settling import settle
from gridspark.sources.workbooks import XML_OPTIONS, named_sheets, relationships

_PIVOT = (
    "location struct<_ref:string>, "
    "pivotFields struct<pivotField:array<struct<items:struct<item:array<struct<_h:string,_t:string,_x:int>>>>>>, "
    "pageFields struct<pageField:array<struct<_fld:int>>>"
)
_CACHE = "cacheFields struct<cacheField:array<struct<_name:string>>>"

# A cache field with its shared items; items of all kinds share one numbering, so the order of
# their tags matters and is kept by reading them as text.
_FIELD = r"(?s)(<(?:[\w.-]+:)?cacheField\b(?:[^>]*/>|.*?</(?:[\w.-]+:)?cacheField>))"
_ITEM = r"(<(?:[\w.-]+:)?[nsmbde]\b[^>]*>)"


def _unescape(c: Column) -> Column:
    for entity, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "'"), ("&amp;", "&")):
        c = F.replace(c, F.lit(entity), F.lit(char))
    return c


def _shared_value(tag: Column) -> Column:
    """Text of a shared item, NULL when missing; integral numbers without decimals."""
    kind = F.regexp_extract(tag, r"^<(?:[\w.-]+:)?([nsmbde])", 1)
    value = F.when(tag.rlike(r'\bv="'), _unescape(F.regexp_extract(tag, r'\bv="([^"]*)"', 1)))
    number = value.try_cast("decimal(38,18)")
    whole = F.when(number == F.floor(number), number.cast("decimal(38,0)").cast("string"))
    return F.when(kind == "n", F.coalesce(whole, value)).when(kind != "m", value)


def cache_fields(parts: DataFrame) -> DataFrame:
    """(workbook, cache, fld, field, shared): canonical name and item texts of each cache field."""
    caches = parts.filter(F.col("part").like("%pivotCacheDefinition%.xml"))
    names = F.from_xml("xml", _CACHE, XML_OPTIONS)["cacheFields"]["cacheField"]
    # The list of fields is the first element of that name's plural; each fragment is one field.
    fragments = F.regexp_extract_all("xml", F.lit(_FIELD), 1)
    fields = caches.select(
        "workbook", F.col("part").alias("cache"),
        F.posexplode(F.arrays_zip(names.alias("name"), fragments.alias("fragment"))).alias("fld", "f"))
    return fields.select(
        "workbook", "cache", "fld", canonical_text(F.col("f.name._name")).alias("field"),
        F.transform(F.regexp_extract_all("f.fragment", F.lit(_ITEM), 1), _shared_value).alias("shared"))


def page_filters(parts: DataFrame) -> DataFrame:
    """``page_filters``: the visible items of each page field, in their order.

    Visible means not hidden, not the default entry, and pointing to a shared item with a value.
    When pivots of a sheet share leftmost column and field, the last one counts.
    """
    rels = settle(relationships(parts))
    is_pivot = F.endswith("type", F.lit("/pivotTable"))
    sheets = named_sheets(parts).select(*SHEET, F.col("part").alias("source"))
    on_sheet = sheets.join(rels.filter(is_pivot), ["workbook", "source"]).select(
        *SHEET, "rel_ord", F.col("target").alias("pivot"))
    cache_of = (
        rels.filter(~is_pivot).groupBy("workbook", F.col("source").alias("pivot"))
        .agg(F.min_by("target", "rel_ord").alias("cache"))
    )
    # Only the parts that are pivots of a sheet are parsed as such.
    texts = parts.select("workbook", F.col("part").alias("pivot"), F.col("xml").alias("pivot_xml"))
    pages = (
        on_sheet.join(texts, ["workbook", "pivot"]).join(cache_of, ["workbook", "pivot"])
        .withColumn("p", F.from_xml("pivot_xml", _PIVOT, XML_OPTIONS))
        .filter(F.col("p.location._ref").isNotNull())
        .select(
            *SHEET, "rel_ord", "cache", a1_col(F.split("p.location._ref", ":")[0]).alias("min_col"),
            F.col("p.pivotFields.pivotField").alias("fields"),
            F.posexplode("p.pageFields.pageField").alias("page_ord", "page"))
        .withColumn("fld", F.col("page._fld"))
    )
    items = pages.join(cache_fields(parts), ["workbook", "cache", "fld"]).select(
        *SHEET, "min_col", "field", F.struct("rel_ord", "page_ord").alias("at"), "shared",
        F.posexplode(F.get("fields", F.col("fld"))["items"]["item"]).alias("item_ord", "i"))
    visible = (
        items.filter(~F.coalesce(F.col("i._h") == "1", F.lit(False))
                     & ~F.coalesce(F.col("i._t") == "default", F.lit(False)) & (F.col("i._x") >= 0))
        .withColumn("item", F.get("shared", F.col("i._x")))
        .filter("item is not null")
    )
    key = [*SHEET, "min_col", "field"]
    last = visible.groupBy(*key).agg(F.max("at").alias("at"))
    return visible.join(last, [*key, "at"]).select(*key, "item_ord", "item")

