"""Write small workbooks inside tasks, as input for the ingestion reports and tests."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterable, Mapping
from xml.sax.saxutils import escape, quoteattr

_MAIN = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
_REL = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
_HEAD = '<?xml version="1.0" encoding="UTF-8" standalone="yes"?>\n'

# Cell styles of the written workbooks, by index.
FORMATS = ("General", "0.0%", "#,##0,", "mmm-yy", 'dd/mm/yyyy "à" hh:mm')


def relationships(entries: Iterable[tuple[str, str, str]]) -> str:
    body = "".join(f'<Relationship Id="{i}" Type="{_REL}/{kind}" Target="{target}"/>' for i, kind, target in entries)
    return f'{_HEAD}<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">{body}</Relationships>'


def sheet_xml(cells: Iterable[tuple[int, str, str]], merges: Iterable[str] = ()) -> str:
    """``cells`` are (row, A1, cell XML), by row."""
    rows: dict[int, list[str]] = {}
    for row, _, xml in cells:
        rows.setdefault(row, []).append(xml)
    body = "".join(f'<row r="{r}" x14ac:dyDescent="0.25">{"".join(c)}</row>' for r, c in sorted(rows.items()))
    ranges = "".join(f'<mergeCell ref="{m}"/>' for m in merges)
    tail = f"<mergeCells>{ranges}</mergeCells>" if ranges else ""
    return (f'{_HEAD}<worksheet {_MAIN} xmlns:x14ac="http://schemas.microsoft.com/office/spreadsheetml/2009/9/ac">'
            f'<dimension ref="A1"/><sheetData>{body}</sheetData>{tail}</worksheet>')


def cell_xml(a1: str, value: str | None, kind: str = "n", style: int = 0, formula: str | None = None) -> str:
    f = "" if formula is None else f"<f>{escape(formula)}</f>" if formula else '<f t="shared" si="0"/>'
    if kind == "inlineStr":
        return f'<c r="{a1}" t="inlineStr"><is><t xml:space="preserve">{escape(value)}</t></is></c>'
    v = "" if value is None else f"<v>{escape(value)}</v>"
    return f'<c r="{a1}" s="{style}" t="{kind}">{f}{v}</c>'


def pack(sheets: Mapping[str, str], strings: Iterable[str], states: Mapping[str, str] | None = None,
         extra: Mapping[str, str] | None = None, date1904: bool = False) -> bytes:
    """Bytes of a workbook with these sheet parts and shared strings."""
    states = states or {}
    names = list(sheets)
    listed = "".join(
        f'<sheet name={quoteattr(n)} sheetId="{i}" r:id="rId{i}"'
        + (f' state="{states[n]}"' if n in states else "") + "/>" for i, n in enumerate(names, 1))
    flag = '<workbookPr date1904="1"/>' if date1904 else "<workbookPr/>"
    custom = "".join(f'<numFmt numFmtId="{200 + i}" formatCode={quoteattr(f)}/>' for i, f in enumerate(FORMATS))
    xfs = "".join(f'<xf numFmtId="{0 if i == 0 else 17 if f == "mmm-yy" else 200 + i}"/>' for i, f in enumerate(FORMATS))
    parts = {
        "xl/workbook.xml": f'{_HEAD}<workbook {_MAIN} xmlns:r="{_REL}">{flag}<sheets>{listed}</sheets></workbook>',
        "xl/_rels/workbook.xml.rels": relationships(
            [(f"rId{i}", "worksheet", f"worksheets/sheet{i}.xml") for i in range(1, len(names) + 1)]
            + [("rId900", "styles", "/xl/styles.xml"), ("rId901", "sharedStrings", "sharedStrings.xml")]),
        "xl/styles.xml": f"{_HEAD}<styleSheet {_MAIN}><numFmts>{custom}</numFmts><cellXfs>{xfs}</cellXfs></styleSheet>",
        "xl/sharedStrings.xml": f"{_HEAD}<sst {_MAIN}>" + "".join(
            s if s.startswith("<si>") else f'<si><t xml:space="preserve">{escape(s)}</t></si>' for s in strings) + "</sst>",
        **{f"xl/worksheets/sheet{i}.xml": sheets[n] for i, n in enumerate(names, 1)},
        **(extra or {}),
    }
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as archive:
        for name, text in parts.items():
            archive.writestr(name, text)
    return buffer.getvalue()


def pack_orders(key, frame):
    """One workbook from a group of at most 1,000 orders; a pandas function for ``applyInPandas``."""
    import pandas as pd

    strings = sorted({*frame["o_orderpriority"], *frame["o_orderstatus"]})
    index = {s: i for i, s in enumerate(strings)}
    frame = frame.sort_values("o_orderkey")
    days = (frame["o_orderdate"] - pd.Timestamp("1899-12-30")).dt.days
    cells = []
    # A row at a time: an element is written here as cell_xml writes it, without a call for each.
    for number, priority, status, price, day in zip(frame["o_orderkey"].tolist(), frame["o_orderpriority"], frame["o_orderstatus"],
                                                    frame["o_totalprice"].astype(float).tolist(), days.tolist()):
        row = int(number) % 1000 + 2
        last = (f'<c r="E{row}" s="0" t="n"><f>C{row}*2</f></c>' if status == "P"
                else f'<c r="E{row}" s="0" t="e"><f>#REF!+1</f><v>#REF!</v></c>' if priority == "5-LOW"
                else f'<c r="E{row}" t="inlineStr"><is><t xml:space="preserve"> n° {number} &amp; co</t></is></c>')
        cells.append((row, "A", f'<c r="A{row}" s="0" t="s"><v>{index[priority]}</v></c><c r="B{row}" s="0" t="s"><v>{index[status]}</v></c>'
                                f'<c r="C{row}" s="2" t="n"><v>{price!r}</v></c><c r="D{row}" s="3" t="n"><v>{day if day != day else int(day)}</v></c>{last}'))
    content = pack({"Commandes & co": sheet_xml(cells, ["A1:B1"]), "cachée": sheet_xml([])}, strings, {"cachée": "hidden"})
    return pd.DataFrame([[f"orders {int(key[0])}.xlsx", content]], columns=["workbook", "content"])
