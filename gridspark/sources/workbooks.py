"""Read workbooks: unzip in tasks, then shred the XML with Spark.

The Python stage only unzips and cuts a sheet into chunks of whole rows, so that no task holds a
whole sheet as one string. A chunk travels with the small parts needed to read it (workbook,
relationships, styles), so that cells are made without a join; only shared strings are joined.
"""

from __future__ import annotations

import io
import json
import re
import zipfile
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from gridspark.functions.binding import let
from gridspark.functions.coords import a1_col, a1_row
from gridspark.functions.numeric import plain_notation
from gridspark.model import SHEET
from gridspark.operators.settling import settle

SUFFIXES = (".xlsx", ".xlsm")
CHUNK_BYTES = 4 << 20

PARTS = (
    "workbook string, part string, chunk int, items_before bigint, xml string, "
    "book_xml string, rels_xml string, styles_xml string, fault string"
)

# Number formats that the file format numbers but does not spell out.
BUILTIN_FORMATS = {
    0: "General", 1: "0", 2: "0.00", 3: "#,##0", 4: "#,##0.00",
    5: '"$"#,##0_);\\("$"#,##0\\)', 6: '"$"#,##0_);[Red]\\("$"#,##0\\)',
    7: '"$"#,##0.00_);\\("$"#,##0.00\\)', 8: '"$"#,##0.00_);[Red]\\("$"#,##0.00\\)',
    9: "0%", 10: "0.00%", 11: "0.00E+00", 12: "# ?/?", 13: "# ??/??",
    14: "mm-dd-yy", 15: "d-mmm-yy", 16: "d-mmm", 17: "mmm-yy",
    18: "h:mm AM/PM", 19: "h:mm:ss AM/PM", 20: "h:mm", 21: "h:mm:ss", 22: "m/d/yy h:mm",
    37: "#,##0_);(#,##0)", 38: "#,##0_);[Red](#,##0)",
    39: "#,##0.00_);(#,##0.00)", 40: "#,##0.00_);[Red](#,##0.00)",
    41: '_(* #,##0_);_(* \\(#,##0\\);_(* "-"_);_(@_)',
    42: '_("$"* #,##0_);_("$"* \\(#,##0\\);_("$"* "-"_);_(@_)',
    43: '_(* #,##0.00_);_(* \\(#,##0.00\\);_(* "-"??_);_(@_)',
    44: '_("$"* #,##0.00_)_("$"* \\(#,##0.00\\)_("$"* "-"??_)_(@_)',
    45: "mm:ss", 46: "[h]:mm:ss", 47: "mmss.0", 48: "##0.0E+0", 49: "@",
}

XML_OPTIONS = {"ignoreNamespace": "true", "ignoreSurroundingSpaces": "false"}
# What cannot be parsed is kept here; without it a malformed chunk would lose its rows silently.
_CORRUPT = "_corrupt"
CHECKED_XML = {**XML_OPTIONS, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT}
FAULT = "fault"  # kind of the cell that stands for a malformed chunk
_TEXT = "t:string,r:array<struct<t:string>>"
_CELL = (
    "struct<_r:string,_t:string,_s:int,v:string,f:struct<_VALUE:string,_t:string,_si:int>,"
    f"is:struct<{_TEXT}>>"
)
_ROWS = f"sheetData struct<row:array<struct<_r:bigint,c:array<{_CELL}>>>>"
_MERGES = "mergeCells struct<mergeCell:array<struct<_ref:string>>>"
_STRINGS = f"si array<struct<{_TEXT}>>"
_BOOK = (
    "workbookPr struct<_date1904:string>, "
    "sheets struct<sheet:array<struct<_name:string,_state:string,_id:string>>>"
)
_RELS = "Relationship array<struct<_Id:string,_Type:string,_Target:string,_TargetMode:string>>"
_STYLES = (
    "numFmts struct<numFmt:array<struct<_numFmtId:int,_formatCode:string>>>, "
    "cellXfs struct<xf:array<struct<_numFmtId:int>>>"
)


def discover(spark: SparkSession, path: str) -> DataFrame:
    """(workbook, content) of one workbook or of those of a folder, lock files left out.

    A path that does not exist, and a file with another suffix, are errors. A content is one value, so a package has
    2 GiB at most and one task; :func:`discover_paths` has neither bound.
    """
    return _found(spark, path).select("workbook", "content")


def discover_paths(spark: SparkSession, path: str) -> DataFrame:
    """(workbook, path) of the same workbooks, for :func:`unzip_parts`; contents are not read."""
    return _found(spark, path).select("workbook", "path")


def _found(spark: SparkSession, path: str) -> DataFrame:
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(hadoop_path):
        raise ValueError(f"Input path does not exist: {path}")
    if files.getFileStatus(hadoop_path).isFile() and not path.lower().endswith(SUFFIXES):
        raise ValueError(f"Unsupported input file: {path}")
    found = spark.read.format("binaryFile").option("pathGlobFilter", "*.[xX][lL][sS][xXmM]").load(path)
    name = F.url_decode(F.replace(F.element_at(F.split("path", "/"), -1), F.lit("+"), F.lit("%2B")))
    return found.withColumn("workbook", name).filter(~F.startswith("workbook", F.lit("~$")))


# --- unzip -------------------------------------------------------------------------------------

_ITEM = {"sheet": re.compile(rb"</(?:[\w.-]+:)?row\s*>|<(?:[\w.-]+:)?row\b[^>]*/>"),
         "strings": re.compile(rb"</(?:[\w.-]+:)?si\s*>|<(?:[\w.-]+:)?si\s*/>")}
_BODY = {"sheet": re.compile(rb"<(?:[\w.-]+:)?sheetData\b[^>]*>"),
         "strings": re.compile(rb"<(?:[\w.-]+:)?sst\b[^>]*>")}
_END = {"sheet": re.compile(rb"</(?:[\w.-]+:)?sheetData\s*>"),
        "strings": re.compile(rb"</(?:[\w.-]+:)?sst\s*>")}


def _chunks(stream, kind: str) -> Iterator[tuple[int, bytes, bytes, bytes]]:
    """Pieces (items before, opening, items, closing) of a part, each with whole items; last comes
    what follows the items with none. Opening and closing make each piece well-formed."""
    data, opening, closing, seen, done = b"", None, b"", 0, False
    while not done:
        block = stream.read(CHUNK_BYTES)
        done = not block
        data += block
        if opening is None:
            start = _BODY[kind].search(data)
            if start is None:
                if done:
                    yield 0, b"", data, b""
                continue
            opening, data = data[:start.end()], data[start.end():]
            opening = opening[opening.index(b"<", opening.find(b"?>") + 1):] if b"<?xml" in opening else opening
            tags = re.findall(rb"<([\w.:-]+)[^>]*(?<!/)>", opening)
            if opening.rstrip().endswith(b"/>"):
                yield 0, b"", opening + data + stream.read(), b""
                return
            own, root = tags[-1], tags[0]
            closing = b"</" + own + b">" + (b"</" + root + b">" if own != root else b"")
        end = _END[kind].search(data)
        body = data if end is None else data[:end.start()]
        cut = 0
        for cut_at in _ITEM[kind].finditer(body):
            cut = cut_at.end()
        if cut:
            yield seen, opening, body[:cut], closing
            seen += sum(1 for _ in _ITEM[kind].finditer(body[:cut]))
        if end is not None:
            yield seen, opening, b"", data[end.start():] + stream.read()
            return
        data = data[cut:]


#: Rows of PARTS that leave a task together: a frame of its own for each would cost more than to unzip it.
_FRAME_ROWS, _FRAME_CHARS = 2000, CHUNK_BYTES


def _frames(rows: Iterator[list]) -> Iterator[pd.DataFrame]:
    """Frames of PARTS rows, small ones together, a large one alone."""
    columns, held, size = [c.split()[0] for c in PARTS.split(", ")], [], 0
    for row in rows:
        held.append(row)
        size += sum(len(text) for text in row[4:8] if text is not None)
        if len(held) >= _FRAME_ROWS or size >= _FRAME_CHARS:
            yield pd.DataFrame(held, columns=columns)
            held, size = [], 0
    if held:
        yield pd.DataFrame(held, columns=columns)


def _unzip(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    def rows() -> Iterator[list]:
        for batch in batches:
            for workbook, content in zip(batch["workbook"], batch["content"]):
                try:
                    for part in _parts_of(workbook, content):
                        yield [*part, None]
                except _FAULTS as fault:
                    yield [workbook, "", 0, 0, None, None, None, None, f"{type(fault).__name__}: {fault}"]

    yield from _frames(rows())


def _parts_of(workbook: str, content: bytes) -> Iterator[list]:
    """The parts of one package, as rows of PARTS without the fault."""
    with zipfile.ZipFile(io.BytesIO(content)) as archive:
        for name in _part_names(archive):
            yield from _rows_of_part(workbook, archive, name)


def _part_names(archive: zipfile.ZipFile) -> list[str]:
    """The parts that are read: XML and relationships, without media and the records of pivot caches."""
    return [n for n in archive.namelist() if n.endswith((".xml", ".rels")) and "/media/" not in n and "pivotCacheRecords" not in n]


def _rows_of_part(workbook: str, archive: zipfile.ZipFile, name: str) -> Iterator[list]:
    """Rows of PARTS of one part; the chunks of a sheet carry the small parts that are needed to read them."""
    text, names = (lambda raw: raw.decode("utf-8-sig")), set(archive.namelist())
    read = lambda n: text(archive.read(n)) if n in names else None
    big = ("sheet" if re.search(r"worksheets/[^/]+\.xml$", name)
           else "strings" if name.lower().endswith("sharedstrings.xml") else None)
    if big is None:
        yield [workbook, name, 0, 0, read(name), None, None, None]
        return
    extra = [None, None, None]
    if big == "sheet":
        extra = [read("xl/workbook.xml"), read("xl/_rels/workbook.xml.rels"), read("xl/styles.xml")]
    with archive.open(name) as stream:
        for i, (seen, start, body, rest) in enumerate(_chunks(stream, big)):
            yield [workbook, name, i, seen, text(start + body + rest), *extra]


_FAULTS = (zipfile.BadZipFile, zlib.error, EOFError, KeyError, RuntimeError, ValueError, OSError)


def _opened(path: str):
    """A stream with positions over a file, in whatever store its path names."""
    from pyarrow import fs

    scheme, rest = re.match(r"(?:([A-Za-z][\w+.-]*):)?(.*)", path, re.DOTALL).groups()
    if scheme in (None, "file"):
        return fs.LocalFileSystem().open_input_file("/" + rest.lstrip("/"))
    authority, _, inside = rest.lstrip("/").partition("/")
    system, root = fs.FileSystem.from_uri(f"{scheme}://{authority}/")
    return system.open_input_file(f"{root.rstrip('/')}/{inside}")


def _list_parts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Only the directory at the end of each package is read."""
    for batch in batches:
        for workbook, path in zip(batch["workbook"], batch["path"]):
            try:
                with _opened(path) as file, zipfile.ZipFile(file) as archive:
                    sizes = {i.filename: i.file_size for i in archive.infolist()}
                    rows = [[workbook, path, n, sizes[n], None] for n in _part_names(archive)]
            except _FAULTS as fault:
                rows = [[workbook, path, "", 0, f"{type(fault).__name__}: {fault}"]]
            yield pd.DataFrame(rows, columns=["workbook", "path", "part", "size", "fault"])


def _read_parts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    def rows() -> Iterator[list]:
        for batch in batches:
            for workbook, path, part, _, fault in batch.itertuples(index=False, name=None):
                if fault is None:
                    try:
                        with _opened(path) as file, zipfile.ZipFile(file) as archive:
                            for row in _rows_of_part(workbook, archive, part):
                                yield [*row, None]
                    except _FAULTS as found:
                        fault = f"{type(found).__name__}: {found}"
                if fault is not None:
                    yield [workbook, part, 0, 0, None, None, None, None, fault]

    yield from _frames(rows())


#: Bytes of unzipped parts that a task reads, about.
TASK_BYTES = 64 << 20


def list_parts(files: DataFrame) -> DataFrame:
    """(workbook, path, part, size, fault): what the packages of :func:`discover_paths` hold."""
    return files.mapInPandas(_list_parts, "workbook string, path string, part string, size bigint, fault string")


def unzip_parts(files: DataFrame) -> DataFrame:
    """The same rows as :func:`unzip`, read part by part: the parts of one package spread over tasks, and each is
    streamed from its place in the file, whatever the size of the package.

    The packages are listed in tasks too, so that a folder of millions of them does not pass through the driver.
    """
    listed = settle(list_parts(files))
    total = listed.agg(F.sum("size")).first()[0] or 0
    tasks = max(files.sparkSession.sparkContext.defaultParallelism, -(-total // TASK_BYTES))
    return listed.repartition(tasks, "path", "part").mapInPandas(_read_parts, PARTS)


def unzip(files: DataFrame) -> DataFrame:
    """The XML parts of each workbook; sheets and shared strings in chunks of whole items. A package that
    cannot be read gives a row with its ``fault``, after the parts that could."""
    return files.mapInPandas(_unzip, PARTS)


def package_faults(parts: DataFrame) -> DataFrame:
    """(workbook, fault) of the packages that cannot be read."""
    return parts.filter("fault is not null").select("workbook", "fault")


def readable(parts: DataFrame, faults: DataFrame) -> DataFrame:
    """The parts of the packages without a fault."""
    return parts if faults.isEmpty() else parts.join(faults.select("workbook").distinct(), "workbook", "left_anti")


# --- shred -------------------------------------------------------------------------------------

def resolve_target(source: Column, target: Column) -> Column:
    """Path of a relationship target inside the package."""
    folder = F.regexp_replace(source, "[^/]*$", "")
    path = F.when(F.startswith(target, F.lit("/")), target).otherwise(F.concat(folder, target))
    steps = F.filter(F.split(path, "/"), lambda p: ~p.isin("", "."))
    walked = F.aggregate(
        steps, F.array().cast("array<string>"),
        lambda acc, p: F.when(p == "..", F.slice(acc, F.lit(1), F.greatest(F.size(acc) - 1, F.lit(0))))
        .otherwise(F.concat(acc, F.array(p))))
    return F.array_join(walked, "/")


def relationships(parts: DataFrame) -> DataFrame:
    """(workbook, source, rel_ord, id, type, target) of every relationship; targets resolved."""
    rels = parts.filter(F.endswith("part", F.lit(".rels"))).select(
        "workbook", F.regexp_replace("part", r"_rels/([^/]*)\.rels$", "$1").alias("source"),
        F.posexplode(F.from_xml("xml", _RELS, XML_OPTIONS)["Relationship"]).alias("rel_ord", "r"))
    return rels.filter(F.col("r._Target").isNotNull()).select(
        "workbook", "source", "rel_ord", F.col("r._Id").alias("id"), F.col("r._Type").alias("type"),
        resolve_target(F.col("source"), F.col("r._Target")).alias("target"))


def _named_sheets(book: Column, rels: Column) -> Column:
    """ARRAY<STRUCT<ordinal, sheet, state, part>> from the workbook part and its relationships."""
    parsed = F.from_xml(book, _BOOK, XML_OPTIONS)["sheets"]["sheet"]
    target = lambda links, s: F.get(F.filter(links, lambda r: r["_Id"] == s["_id"]), F.lit(0))["_Target"]
    # The relationships are parsed once, not for every sheet.
    return let(F.from_xml(rels, _RELS, XML_OPTIONS)["Relationship"], lambda links: F.transform(parsed, lambda s, i: F.struct(
        i.alias("ordinal"), s["_name"].alias("sheet"), F.coalesce(s["_state"], F.lit("visible")).alias("state"),
        resolve_target(F.lit("xl/workbook.xml"), target(links, s)).alias("part"))))


def _formats(styles: Column) -> Column:
    """ARRAY of number formats by cell style."""
    builtin = F.from_json(F.lit(json.dumps(BUILTIN_FORMATS)), "map<string,string>")

    def named(parsed: Column) -> Column:
        custom = F.coalesce(parsed["numFmts"]["numFmt"], F.array().cast("array<struct<_numFmtId:int,_formatCode:string>>"))
        return F.transform(parsed["cellXfs"]["xf"], lambda xf: F.coalesce(
            F.get(F.filter(custom, lambda f: f["_numFmtId"] == xf["_numFmtId"]), F.lit(0))["_formatCode"],
            F.element_at(builtin, xf["_numFmtId"].cast("string")), F.lit("General")))

    # The part is parsed once, not for every style.
    return let(F.from_xml(styles, _STYLES, XML_OPTIONS), named)


def is_date_format(number_format: Column) -> Column:
    """The first section shows a day, month, year or time, outside quotes, brackets and escapes."""
    primary = F.split(number_format, ";")[0]
    bare = F.regexp_replace(primary, r'"[^"]*"|\[(?![hHmMsS]+\])[^\]]*\]|[\\_].|AM/PM|A/P', "")
    return ~bare.isin("General", "@") & bare.rlike("[dmhysDMHYS]")


def _rich(t: Column) -> Column:
    """Plain or rich text."""
    return F.coalesce(t["t"], F.array_join(F.transform(t["r"], lambda r: F.coalesce(r["t"], F.lit(""))), ""))


def shared_strings(parts: DataFrame) -> DataFrame:
    """(workbook, idx, text)."""
    chunks = parts.filter(F.lower("part").like("%sharedstrings.xml"))
    return chunks.select(
        "workbook", "items_before",
        F.posexplode(F.from_xml("xml", _STRINGS, XML_OPTIONS)["si"]).alias("pos", "si"),
    ).select("workbook", (F.col("items_before") + F.col("pos")).alias("idx"), _rich(F.col("si")).alias("text"))


def _sheet_chunks(parts: DataFrame) -> DataFrame:
    """Sheet chunks with their sheet name."""
    here = F.get(F.filter(_named_sheets(F.col("book_xml"), F.col("rels_xml")),
                          lambda s: s["part"] == F.col("part")), F.lit(0))
    return parts.filter("book_xml is not null").withColumn("sheet", here["sheet"]).filter("sheet is not null")


def read_cells_of(parts: DataFrame) -> DataFrame:
    """``cells`` of all sheets, those of malformed chunks left out."""
    return true_cells(checked_cells_of(parts))


def true_cells(cells: DataFrame) -> DataFrame:
    return cells.filter(F.col("kind") != FAULT)


def chunk_faults(cells: DataFrame, parts: DataFrame) -> DataFrame:
    """(workbook, sheet, fault) of malformed chunks: of sheets, from :func:`checked_cells_of`, and of shared strings, whose
    sheet is empty."""
    strings = parts.filter(F.lower("part").like("%sharedstrings.xml")).select(
        "workbook", "part", F.from_xml("xml", f"{_STRINGS}, {_CORRUPT} string", CHECKED_XML)[_CORRUPT].alias("bad"))
    message = lambda part: F.concat(F.lit("malformed XML in "), part)
    return cells.filter(F.col("kind") == FAULT).select(*SHEET, F.col("raw").alias(FAULT)).distinct().unionByName(
        strings.filter("bad is not null").select("workbook", F.lit("").alias("sheet"), message(F.col("part")).alias(FAULT)).distinct())


def checked_cells_of(parts: DataFrame) -> DataFrame:
    """``cells`` of all sheets; a malformed chunk is one cell of the kind ``fault`` that names it."""
    date1904 = F.lower(F.from_xml("book_xml", _BOOK, XML_OPTIONS)["workbookPr"]["_date1904"]).isin("1", "true")
    rows = F.from_xml("xml", f"{_ROWS}, {_CORRUPT} string", CHECKED_XML)
    wrong = F.concat(F.lit("malformed XML in "), F.col("part"), F.lit(", chunk "), F.col("chunk").cast("string"))
    # A malformed chunk is one row with one empty cell.
    empty = F.from_json(F.lit('[{"c":[{}]}]'), f"array<struct<_r:bigint,c:array<{_CELL}>>>")
    # All that a chunk's small parts say is read here, once a chunk; below the lines it would be read for every line.
    parsed = _sheet_chunks(parts).withColumns({
        "rows": rows, "date1904": F.coalesce(date1904, F.lit(False)),
        "formats": F.transform(_formats(F.col("styles_xml")), lambda f: F.struct(f.alias("text"), is_date_format(f).alias("dated"))),
    }).withColumn("fault", F.when(F.col(f"rows.{_CORRUPT}").isNotNull(), wrong))
    lines = parsed.select(
        *SHEET, "items_before", "date1904", "formats", "fault",
        F.posexplode(F.when(F.col("fault").isNotNull(), empty).otherwise(F.col("rows.sheetData.row"))).alias("row_pos", "line"))
    found = lines.select(
        *SHEET, "date1904", "formats", "fault",
        F.coalesce("line._r", F.col("items_before") + F.col("row_pos") + 1).alias("row"),
        F.posexplode("line.c").alias("col_pos", "c"))
    v, kind = F.col("c.v"), F.coalesce("c._t", F.lit("n"))
    typed = found.select(
        *SHEET, "fault", "row", F.coalesce(a1_col(F.col("c._r")), F.col("col_pos") + 1).alias("col"), kind.alias("t"), v.alias("v"),
        _rich(F.col("c.is")).alias("inline"),
        # A follower of a shared formula has an empty element; it is a formula cell all the same.
        F.when(F.col("c.f").isNotNull(), F.coalesce("c.f._VALUE", F.lit(""))).alias("formula"),
        F.get("formats", F.coalesce("c._s", F.lit(0))).alias("format"), "date1904",
        # Cells without a shared string get spread keys that match nothing.
        F.when(kind == "s", v.try_cast("bigint")).otherwise(-1 - F.pmod(F.xxhash64("row", "c._r"), F.lit(1 << 20)))
        .alias("idx"))
    joined = typed.join(shared_strings(parts), ["workbook", "idx"], "left").withColumns({
        "number_format": F.coalesce("format.text", F.lit("General")), "dated": F.coalesce("format.dated", F.lit(False))})

    number = F.col("v").try_cast("double")
    as_date = (F.col("t") == "n") & F.col("dated") & number.isNotNull()
    # The 1900 calendar counts a 29 February that never was.
    days = number + F.when(~F.col("date1904") & (number > 0) & (number < 60), 1).otherwise(0)
    epoch = F.when(F.col("date1904"), F.lit("1904-01-01")).otherwise(F.lit("1899-12-30")).cast("timestamp_ntz")
    moment = F.timestamp_add("SECOND", F.round(days * 86400).cast("bigint"), epoch)
    has_day = (number < 0) | (number >= 1)
    iso = F.replace(F.rtrim(F.lit("Z"), F.col("v")), F.lit("T"), F.lit(" ")).try_cast("timestamp_ntz")
    ts = F.when(as_date & has_day, moment).when(F.col("t") == "d", iso)
    plain_number = F.when(F.col("v").rlike("[.eE]"), plain_notation(number.cast("string"))).otherwise(F.trim("v"))
    raw = (
        F.when(ts.isNotNull(), F.date_format(ts, "yyyy-MM-dd HH:mm:ss"))
        .when(as_date, F.date_format(moment, "HH:mm:ss"))
        .when(F.col("t") == "s", F.col("text"))
        .when(F.col("t") == "inlineStr", F.col("inline"))
        .when(F.col("t") == "b", F.when(F.col("v") == "1", "True").when(F.col("v") == "0", "False"))
        .when(F.col("t") == "n", plain_number)
        .otherwise(F.col("v"))
    )
    kinds = (
        F.when(ts.isNotNull(), "d").when(as_date, "s").when(F.col("t").isin("b", "e", "n"), F.col("t")).otherwise("s"))
    return joined.select(
        *SHEET, "row", "col", F.coalesce("fault", F.nullif(raw, F.lit(""))).alias("raw"),
        F.when(F.col("fault").isNotNull(), FAULT).otherwise(kinds).alias("kind"), ts.alias("ts"), "formula", "number_format",
    ).filter(F.col("raw").isNotNull() | F.col("formula").isNotNull())


def named_sheets(parts: DataFrame) -> DataFrame:
    """(workbook, sheet, ordinal, sheet_state, part) of every sheet."""
    text = lambda name: parts.filter(F.col("part") == name).select("workbook", F.col("xml").alias(name.split("/")[-1]))
    both = text("xl/workbook.xml").join(text("xl/_rels/workbook.xml.rels"), "workbook", "left")
    listed = both.select("workbook", F.explode(_named_sheets(
        F.col("`workbook.xml`"), F.col("`workbook.xml.rels`"))).alias("s"))
    return listed.select(
        "workbook", F.col("s.sheet").alias("sheet"), F.col("s.ordinal").alias("ordinal"),
        F.col("s.state").alias("sheet_state"), F.col("s.part").alias("part"))


def read_sheets_of(parts: DataFrame, cells: DataFrame) -> DataFrame:
    """``sheets`` with the extent of their cells; an empty sheet is one cell large."""
    extents = cells.groupBy(*SHEET).agg(F.max("row").alias("last_row"), F.max("col").alias("last_col"))
    return named_sheets(parts).drop("part").join(extents, SHEET, "left").withColumns(
        {"last_row": F.coalesce("last_row", F.lit(1).cast("bigint")), "last_col": F.coalesce("last_col", F.lit(1))})


def read_merged_of(parts: DataFrame) -> DataFrame:
    """``merged`` of all sheets; a single cell counts as a range."""
    # Merges stand in the chunk after the rows; no other is parsed for them.
    refs = _sheet_chunks(parts.filter(F.contains("xml", F.lit("mergeCell")))).select(
        *SHEET, F.explode(F.from_xml("xml", _MERGES, XML_OPTIONS)["mergeCells"]["mergeCell"]).alias("m"))
    return refs.select(*SHEET, *range_edges(F.col("m._ref")))


def range_edges(ref: Column) -> list[Column]:
    first, last = F.split(ref, ":")[0], F.element_at(F.split(ref, ":"), -1)
    return [
        a1_row(first).alias("min_row"), a1_row(last).alias("max_row"),
        a1_col(first).alias("min_col"), a1_col(last).alias("max_col")]


@dataclass(frozen=True)
class Ingested:
    """What a set of packages holds, and what could not be read: ``faults`` is (workbook, sheet, fault), the sheet empty
    where the fault is the package's."""

    cells: DataFrame
    sheets: DataFrame
    merged: DataFrame
    faults: DataFrame


def ingest_parts(parts: DataFrame) -> Ingested:
    """Cells, sheets, merged ranges and faults of :func:`unzip` or :func:`unzip_parts`."""
    parts = settle(parts)
    broken = package_faults(parts)
    parts = readable(parts, broken)
    checked = checked_cells_of(parts)
    cells = true_cells(checked)
    faults = broken.select("workbook", F.lit("").alias("sheet"), "fault").unionByName(chunk_faults(checked, parts))
    return Ingested(cells, read_sheets_of(parts, cells), read_merged_of(parts), faults)


def ingest(files: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(cells, sheets, merged) of the workbooks of :func:`discover`; :func:`ingest_parts` gives the faults as well."""
    found = ingest_parts(unzip(files))
    return found.cells, found.sheets, found.merged
