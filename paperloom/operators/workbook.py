"""Spreadsheets: one workbook for each document, made and read on executors.

A workbook is a zip of small XML parts. Rows of all sheets of a document meet in one group (a document
is bounded); its bytes are a column, so the file sink writes them, and ``cells`` reads them back.
"""

from __future__ import annotations

import io
import re
import struct
import zipfile
import zlib
from collections.abc import Iterator, Sequence
from functools import lru_cache
from xml.etree import ElementTree
from xml.sax.saxutils import escape, quoteattr

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import output

CELL = "struct<text:string,number:double>"
# Fixed values of the format: the most rows of a sheet, characters of a sheet's name, the widest column, namespaces.
MOST_ROWS, MOST_NAME, MOST_WIDTH = 1_048_576, 31, 50
MAIN = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
RELATIONS = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
PACKAGE = "http://schemas.openxmlformats.org/package/2006"
TYPES = "application/vnd.openxmlformats-officedocument.spreadsheetml"
HEAD = '<?xml version="1.0" encoding="UTF-8" standalone="yes"?>\n'
#: Bold on grey for the first row (style 1).
STYLES = (
    f'{HEAD}<styleSheet xmlns="{MAIN}"><fonts count="2"><font><sz val="11"/><name val="Calibri"/></font><font><b/><sz val="11"/><name val="Calibri"/></font></fonts>'
    '<fills count="3"><fill><patternFill patternType="none"/></fill><fill><patternFill patternType="gray125"/></fill>'
    '<fill><patternFill patternType="solid"><fgColor rgb="FFCCCCCC"/><bgColor rgb="FFCCCCCC"/></patternFill></fill></fills>'
    '<borders count="1"><border><left/><right/><top/><bottom/><diagonal/></border></borders><cellStyleXfs count="1"><xf numFmtId="0" fontId="0" fillId="0" borderId="0"/></cellStyleXfs>'
    '<cellXfs count="2"><xf numFmtId="0" fontId="0" fillId="0" borderId="0" xfId="0"/><xf numFmtId="0" fontId="1" fillId="2" borderId="0" xfId="0" applyFont="1" applyFill="1"/></cellXfs></styleSheet>'
)
_FORBIDDEN = re.compile("[\x00-\x08\x0b\x0c\x0e-\x1f￾￿]|_(?=x[0-9A-Fa-f]{4}_)")
_CODED = re.compile("_x([0-9A-Fa-f]{4})_")
_PLAIN = re.compile("[A-Za-z0-9 .,:;/()%+-]*")
#: Documents that a task makes or reads before it hands them on; bytes from which a file needs longer offsets.
DOCUMENTS_AT_ONCE, LONG_FILE = 256, 1 << 31


@lru_cache(maxsize=1 << 14)
def letters(column: int) -> str:
    """A, B, ..., Z, AA, ... for 1, 2, ..."""
    out = ""
    while column:
        column, rest = divmod(column - 1, 26)
        out = chr(65 + rest) + out
    return out


def column_of(place: str) -> int:
    n = 0
    for c in place.rstrip("0123456789"):
        n = n * 26 + ord(c) - 64
    return n


def coded(text: str) -> str:
    """Text as the format stores it: what XML forbids as _xHHHH_, and so the underscore of what looks like that."""
    return text if _PLAIN.fullmatch(text) else escape(_FORBIDDEN.sub(lambda m: f"_x{ord(m[0]):04X}_", text).replace("\r", "_x000D_"))


def decoded(text: str) -> str:
    return _CODED.sub(lambda m: chr(int(m[1], 16)), text)


def sheet_xml(rows: Sequence[Sequence[tuple[str | None, float | None]]]) -> str:
    """A sheet of rows of (text, number) cells, its first row marked, columns as wide as their longest value plus 2."""
    wide: dict[int, int] = {}
    lines = []
    for y, row in enumerate(rows, 1):
        own = []
        style = ' s="1"' if y == 1 else ""
        for x, (text, number) in enumerate(row, 1):
            if number is not None and number == number and abs(number) != float("inf"):
                shown = f"{number:.15g}" if float(f"{number:.15g}") == number else repr(number)
                own.append(f'<c r="{letters(x)}{y}"{style}><v>{shown}</v></c>')
            else:
                shown = text if text is not None else "" if number is None else str(number)
                if shown or style:
                    own.append(f'<c r="{letters(x)}{y}"{style} t="inlineStr"><is><t xml:space="preserve">{coded(shown)}</t></is></c>')
            wide[x] = max(wide.get(x, 0), len(shown))
        lines.append(f'<row r="{y}">{"".join(own)}</row>')
    columns = "".join(f'<col min="{x}" max="{x}" width="{min(n + 2, MOST_WIDTH)}" customWidth="1"/>' for x, n in sorted(wide.items()))
    return f'{HEAD}<worksheet xmlns="{MAIN}">{f"<cols>{columns}</cols>" if columns else ""}<sheetData>{"".join(lines)}</sheetData></worksheet>'


def _packed(name: str, content: str) -> tuple[bytes, bytes, bytes]:
    """A part of a zip: its local header with the name, its deflated bytes, and the header's fields that the directory repeats."""
    plain = content.encode()
    body = zlib.compress(plain, wbits=-15)
    fields = struct.pack("<2B4H3L2H", 20, 0, 0, 8, 0, 33, zlib.crc32(plain), len(body), len(plain), len(name), 0)  # deflated, 1 January 1980
    return b"PK\3\4" + fields + name.encode(), body, fields


@lru_cache(maxsize=64)
def _frame(names: tuple[str, ...]) -> list[tuple[str, tuple[bytes, bytes, bytes]]]:
    """The parts of a workbook that its sheets' names decide."""
    n = range(1, len(names) + 1)
    part = lambda name, kind: f'<Override PartName="{name}" ContentType="{TYPES}.{kind}+xml"/>'
    link = lambda i, kind, target: f'<Relationship Id="rId{i}" Type="{RELATIONS}/{kind}" Target="{target}"/>'
    files = {
        "[Content_Types].xml": f'{HEAD}<Types xmlns="{PACKAGE}/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Default Extension="xml" ContentType="application/xml"/>'
        + part("/xl/workbook.xml", "sheet.main") + part("/xl/styles.xml", "styles") + "".join(part(f"/xl/worksheets/sheet{i}.xml", "worksheet") for i in n) + "</Types>",
        "_rels/.rels": f'{HEAD}<Relationships xmlns="{PACKAGE}/relationships">{link(1, "officeDocument", "xl/workbook.xml")}</Relationships>',
        "xl/workbook.xml": f'{HEAD}<workbook xmlns="{MAIN}" xmlns:r="{RELATIONS}"><sheets>' + "".join(f'<sheet name={quoteattr(name)} sheetId="{i}" r:id="rId{i}"/>' for i, name in zip(n, names, strict=True)) + "</sheets></workbook>",
        "xl/_rels/workbook.xml.rels": f'{HEAD}<Relationships xmlns="{PACKAGE}/relationships">' + "".join(link(i, "worksheet", f"worksheets/sheet{i}.xml") for i in n) + link(len(names) + 1, "styles", "styles.xml") + "</Relationships>",
        "xl/styles.xml": STYLES,
    }
    return [(name, _packed(name, content)) for name, content in files.items()]


def workbook_bytes(sheets: Sequence[tuple[str, Sequence]]) -> bytes:
    """The file of named sheets. A sheet that has more rows than the format allows goes on in a next one;
    equal input gives equal bytes. Parts that only the names decide are deflated once."""
    named: list[tuple[str, Sequence]] = []
    for name, rows in sheets:
        for k, at in enumerate(range(0, max(1, len(rows)), MOST_ROWS)):
            own = re.sub(r"[\[\]:*?/\\]", " ", name)
            named.append((own[:MOST_NAME] if not k else f"{own[: MOST_NAME - 8]} ({k + 1})", rows[at : at + MOST_ROWS]))
    parts = list(_frame(tuple(name for name, _ in named)))
    parts += [(name := f"xl/worksheets/sheet{i}.xml", _packed(name, sheet_xml(rows))) for i, (_, rows) in enumerate(named, 1)]
    if len(parts) >= 0xFFFF or sum(len(body) + 256 for _, (_, body, _) in parts) >= LONG_FILE:
        return _long_file(parts)
    out, directory, at = [], [], 0
    for name, (head, body, fields) in parts:
        out += [head, body]
        directory.append(b"PK\1\2" + struct.pack("<2B", 20, 3) + fields + struct.pack("<3H2L", 0, 0, 0, 0o600 << 16, at) + name.encode())
        at += len(head) + len(body)
    size = sum(map(len, directory))
    return b"".join([*out, *directory, b"PK\5\6" + struct.pack("<4H2LH", 0, 0, len(parts), len(parts), size, at, 0)])


def _long_file(parts: Sequence[tuple[str, tuple[bytes, bytes, bytes]]]) -> bytes:
    """The same by the standard library, which knows the longer records of large files."""
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for name, (_, body, _) in parts:
            z.writestr(zipfile.ZipInfo(name, (1980, 1, 1, 0, 0, 0)), zlib.decompress(body, wbits=-15), zipfile.ZIP_DEFLATED)
    return out.getvalue()


_TAG = {n: f"{{{MAIN}}}{n}" for n in ("sheet", "si", "t", "c", "v", "is")}


@lru_cache(maxsize=64)
def _sheets_of(book: bytes, links: bytes) -> list[tuple[str, str]]:
    """Name and part of each sheet, from the workbook's part and its links."""
    targets = {r.get("Id"): r.get("Target").lstrip("/") for r in ElementTree.fromstring(links)}
    found = [(s.get("name"), targets[s.get(f"{{{RELATIONS}}}id")]) for s in ElementTree.fromstring(book).iter(_TAG["sheet"])]
    return [(name, t if t.startswith("xl/") else f"xl/{t}") for name, t in found]


@lru_cache(maxsize=1 << 16)
def _place(place: str) -> tuple[int, int]:
    return int(re.sub("[A-Z]", "", place)), column_of(place)


def _text_of(e: ElementTree.Element) -> str:
    text = "".join([t.text or "" for t in e.iter(_TAG["t"])])
    return decoded(text) if "_x" in text else text


def read_cells(content: bytes) -> list[tuple[str, int, int, str | None, float | None]]:
    """(sheet, row, column, text, number) of every cell that holds something, with inline or shared texts."""
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        shared = [_text_of(e) for e in ElementTree.fromstring(z.read("xl/sharedStrings.xml")).iter(_TAG["si"])] if "xl/sharedStrings.xml" in z.NameToInfo else []
        out = []
        for name, part in _sheets_of(z.read("xl/workbook.xml"), z.read("xl/_rels/workbook.xml.rels")):
            for c in ElementTree.fromstring(z.read(part)).iter(_TAG["c"]):
                row, column = _place(c.get("r"))
                kind = c.get("t")
                if kind == "inlineStr":
                    out.append((name, row, column, _text_of(c), None))
                elif (value := c.find(_TAG["v"])) is not None:
                    out.append((name, row, column, shared[int(value.text)], None) if kind == "s" else (name, row, column, value.text, None) if kind == "str" else (name, row, column, None, float(value.text)))
        return out


def cell(df: DataFrame, name: str) -> Column:
    """A column as cells: numbers stay numbers, all else is text."""
    kind = dict(df.dtypes)[name]
    number = kind in ("double", "float", "int", "bigint", "smallint", "tinyint") or kind.startswith("decimal")
    c = F.col(f"`{name}`")
    return F.struct(F.lit(None).cast("string").alias("text"), c.cast("double").alias("number")) if number else F.struct(c.cast("string").alias("text"), F.lit(None).cast("double").alias("number"))


def sheet_rows(df: DataFrame, number: int, columns: Sequence[str], order: str) -> DataFrame:
    """Rows of sheet ``number`` (doc_id, sheet_no, row_no, cells) from ``df``, in the order of a column."""
    return df.select("doc_id", F.lit(number).alias("sheet_no"), F.col(order).cast("long").alias("row_no"), F.array(*[cell(df, c) for c in columns]).alias("cells"))


def workbooks(rows: DataFrame, sheets: Sequence[tuple[str, Sequence[str] | None]]) -> DataFrame:
    """doc_id and content: one workbook for each document with the named sheets, each with its header (if
    it has one) and the document's rows of ``rows`` (doc_id, sheet_no from 0, row_no, cells). A sheet without
    rows has its header alone; rows that repeat stay; a null doc_id is a document of its own."""
    named = [(n, [[(c, None) for c in h]] if h else []) for n, h in sheets]

    def build(batches):
        for docs in _sliced(batches):
            content = [workbook_bytes([(n, head + own) for (n, head), own in zip(named, sheets_of, strict=True)]) for sheets_of in _sheet_rows(docs.column("rows"), len(named))]
            yield pa.RecordBatch.from_arrays([docs.column("doc_id"), pa.array(content, pa.binary())], ["doc_id", "content"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    gathered = rows.groupBy("doc_id").agg(F.collect_list(F.struct("sheet_no", "row_no", "cells")).alias("rows"))
    return gathered.mapInArrow(build, f"doc_id {kind}, content binary")


def _sliced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for i in range(0, b.num_rows, DOCUMENTS_AT_ONCE):
            yield b.slice(i, DOCUMENTS_AT_ONCE)


def _sheet_rows(lists: pa.ListArray, n: int) -> Iterator[list[list]]:
    """Of each document's gathered rows those of its ``n`` sheets, in order, as lists of (text, number)."""
    rows = lists.flatten()
    document = np.repeat(np.arange(len(lists)), pc.fill_null(pc.list_value_length(lists), 0).to_numpy())
    sheet = rows.field("sheet_no").to_numpy()
    number = pc.fill_null(rows.field("row_no"), np.iinfo(np.int64).max).to_numpy()
    cells = rows.field("cells")
    values = cells.flatten()
    both = list(zip(values.field("text").to_pylist(), values.field("number").to_pylist(), strict=True))
    ends = np.cumsum(pc.fill_null(pc.list_value_length(cells), 0).to_numpy()).tolist()
    order = np.lexsort((number, sheet, document))  # stable
    at, sheet, k = np.searchsorted(document, np.arange(len(lists) + 1)).tolist(), sheet.tolist(), order.tolist()
    for a, b in zip(at, at[1:], strict=False):
        own: list[list] = [[] for _ in range(n)]
        for i in k[a:b]:
            own[sheet[i]].append(both[ends[i - 1] if i else 0 : ends[i]])
        yield own


def cells(books: DataFrame) -> DataFrame:
    """doc_id, sheet, row, column (from 1), text, number and error of the cells of workbooks (doc_id, content);
    a file that is none is one row with its error."""
    kind = books.schema["doc_id"].dataType.simpleString()
    columns = {"sheet": pa.string(), "row": pa.int32(), "column": pa.int32(), "text": pa.string(), "number": pa.float64(), "error": pa.string()}

    def read(batches):
        for b in _sliced(batches):
            out, sizes = [], []
            for content in b.column("content").to_pylist():
                try:
                    own = [(*c, None) for c in read_cells(content or b"")]
                except Exception as e:  # whatever a file holds; it is reported
                    own = [(None, None, None, None, None, str(e) or type(e).__name__)]
                out += own
                sizes.append(len(own))
            made = [pa.array(v, t) for v, t in zip(zip(*out, strict=True) if out else [()] * 6, columns.values(), strict=True)]
            yield pa.RecordBatch.from_arrays([b.column("doc_id").take(pa.array(np.repeat(np.arange(len(sizes)), sizes))), *made], ["doc_id", *columns])

    return books.select("doc_id", "content").mapInArrow(read, T.StructType.fromDDL(f"doc_id {kind}, sheet string, row int, column int, text string, number double, error string"))


def invoice_workbooks(documents: DataFrame, checks: DataFrame | None = None) -> DataFrame:
    """doc_id and content: the workbook of each nested document, with its summary, its line items and, with
    ``checks`` (those of ``output.verification_sheet``), its verification."""
    summary = output.summary_sheet(documents)
    number = F.when(F.col("pos").isin(10, 11, 12, 13, 18), F.col("value").try_cast("double"))  # the sums, and the number of pages
    value = F.struct(F.when(number.isNull(), F.col("value")).alias("text"), number.alias("number"))
    rows = summary.select("doc_id", F.lit(0).alias("sheet_no"), F.col("pos").cast("long").alias("row_no"), F.array(cell(summary, "field"), value).alias("cells"))
    items = documents.select("doc_id", F.posexplode("line_items").alias("line_no", "i")).select("doc_id", "line_no", "i.*")
    rows = rows.unionByName(sheet_rows(items, 1, output.ITEM_COLUMNS, "line_no"))
    sheets = [("Invoice Summary", None), ("Line Items", output.ITEM_COLUMNS)]
    if checks is not None:
        score = F.struct(F.when(F.col("value").try_cast("double").isNull(), F.col("value")).alias("text"), F.col("value").try_cast("double").alias("number"))
        rows = rows.unionByName(checks.select("doc_id", F.lit(2).alias("sheet_no"), F.col("pos").cast("long").alias("row_no"), F.array(cell(checks, "item"), cell(checks, "status"), score).alias("cells")))
        sheets.append(("Verification", ("Verification Item", "Status", "Score/Value")))
    return workbooks(rows, sheets)
