"""Spreadsheets (.xlsx) as tables, with the standard library only.

``spark.dataSource.register(XlsxSource)``, then ``spark.read.format("xlsx").option(...).load(path)`` reads local files of one kind.
Options: sheet (name or number from 0; otherwise the first sheet that has cells), includeHidden, headerStyle (plain: repeats
numbered; letter: with ``::`` and the column's letters), dropBlank, unifyDecimal, displayed (numbers as their formats show them). All columns are texts, and ``_row`` is the sheet's
row number. One partition reads one file; rows are streamed from the sheet's XML, so memory does not grow with a sheet.

Columns come from the first file: its header as wide as its widest row, where a column without a header is ``col_n``. Each file
is read by its own header; with several files, what the first doesn't name is in ``_more``, a map, so no cell is left out.

``read_workbooks`` reads files of any layout from any store that Spark reads, as maps from header to text.

Dates are ISO 8601 texts, as cells with a date's format hold serial numbers only; numbers are plain, booleans true or false.
"""

from __future__ import annotations

import datetime
import glob
import io
import os
import re
import zipfile
from collections.abc import Iterator
from typing import BinaryIO
from xml.etree import ElementTree

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import LongType, MapType, StringType, StructField, StructType

from ..functions.cellformat import BUILT_IN, shown_number
from ..operators.naming import lettered_headers, unique_headers

_REL = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"


# Numbers of built-in formats of dates and times.
_DATE_FORMATS = {14, 15, 16, 17, 18, 19, 20, 21, 22, 27, 28, 29, 30, 31, 32, 33, 34, 35, 36, 45, 46, 47, 50, 51, 52, 53, 54, 55, 56, 57, 58}


def local_name(tag: str) -> str:
    return tag.rpartition("}")[2]


def _letters(reference: str) -> int:
    n = 0
    for ch in re.match(r"[A-Z]*", reference)[0]:
        n = n * 26 + ord(ch) - 64
    return n - 1


def _dated(code: str) -> bool:
    """Whether a format's code shows a date or time: it has their letters outside quotes, brackets and escapes."""
    return bool(re.search("[dmyhs]", re.sub(r'"[^"]*"|\\[[^\\]]*\\]|\\\\.|[_*].', "", code.split(";")[0]).lower()))


def _plain(text: str) -> str:
    """A number as it is usually written."""
    x = float(text)
    return str(int(x)) if x.is_integer() and abs(x) < 1e21 else repr(x)


def cell_texts(row, dated: set[str], base: datetime.datetime, formats: dict[str, str] | None = None) -> Iterator[tuple[int, str | None, int | None]]:
    """(column, text, number of the shared string) of a row's cells; one of the two is None. ``dated`` are the styles of dates,
    ``formats`` the number formats of styles, where numbers are wanted as they are shown."""
    col = -1
    for c in row:
        col = _letters(c.get("r")) if c.get("r") else col + 1
        kind, text = c.get("t"), None
        for x in c:
            if local_name(x.tag) == "v":
                text = x.text
            elif local_name(x.tag) == "is":
                text = "".join(t.text or "" for t in x.iter() if local_name(t.tag) == "t")
        if text is None or kind == "e":
            continue
        if kind == "s":
            yield col, None, int(text)
        elif kind == "b":
            yield col, "true" if text == "1" else "false", None
        elif kind in (None, "n") and text.strip():
            if c.get("s") in dated:
                text = _iso(text, base)
            else:
                text = _plain(text) if formats is None else shown_number(text.strip(), formats.get(c.get("s", "0"), "General"))
            yield col, text, None
        elif text.strip():
            yield col, text, None


def _iso(text: str, base: datetime.datetime) -> str:
    """A serial number as an ISO 8601 text."""
    at = base + datetime.timedelta(milliseconds=round(float(text) * 86_400_000))
    return at.isoformat(timespec="milliseconds") + "Z"


class Workbook:
    """``strings`` False leaves the shared strings for ``strings()`` to read one by one; ``displayed`` gives numbers as their formats
    show them (1,234.50 or 12%), else they are plain."""

    def __init__(self, path: str | BinaryIO, strings: bool = True, displayed: bool = False):
        self.zip = zipfile.ZipFile(path)
        names = set(self.zip.namelist())
        self.shared: list[str] | None = list(self.strings()) if strings else None
        targets = {r.get("Id"): r.get("Target") for r in ElementTree.parse(self.zip.open("xl/_rels/workbook.xml.rels")).getroot()}
        codes = self._format_codes() if "xl/styles.xml" in names else {}
        self.dated = {i for i, (n, own) in codes.items() if (_dated(own) if own is not None else n in _DATE_FORMATS)}
        self.formats = {i: own if own is not None else BUILT_IN.get(n, "General") for i, (n, own) in codes.items()} if displayed else None
        self.sheets = []
        self.base = datetime.datetime(1899, 12, 30)
        for s in ElementTree.parse(self.zip.open("xl/workbook.xml")).getroot().iter():
            if local_name(s.tag) == "workbookPr" and s.get("date1904") in ("1", "true"):
                self.base = datetime.datetime(1904, 1, 1)
            if local_name(s.tag) == "sheet":
                target = targets[s.get(_REL)].lstrip("/")
                self.sheets.append((s.get("name"), s.get("state", "visible") != "visible", target if target.startswith("xl/") else f"xl/{target}"))

    def _format_codes(self) -> dict[str, tuple[int, str | None]]:
        """Of each cell style the number of its format, and the format's code if the workbook has one of its own."""
        root = ElementTree.parse(self.zip.open("xl/styles.xml")).getroot()
        own = {x.get("numFmtId"): x.get("formatCode", "") for x in root.iter() if local_name(x.tag) == "numFmt"}
        styles = [x for parent in root if local_name(parent.tag) == "cellXfs" for x in parent]
        return {str(i): (int(x.get("numFmtId", "0")), own.get(x.get("numFmtId", "0"))) for i, x in enumerate(styles)}

    def strings(self) -> Iterator[str]:
        """The shared strings, in order."""
        if "xl/sharedStrings.xml" in set(self.zip.namelist()):
            for _, e in ElementTree.iterparse(self.zip.open("xl/sharedStrings.xml")):
                if local_name(e.tag) == "si":
                    yield "".join(t.text or "" for t in e.iter() if local_name(t.tag) == "t")
                    e.clear()

    def rows(self, part: str) -> Iterator[tuple[int, dict[int, str]]]:
        """(row number, texts by column) of the rows that have cells."""
        at = 0
        for _, e in ElementTree.iterparse(self.zip.open(part)):
            if local_name(e.tag) != "row":
                continue
            at = int(e.get("r") or at + 1)
            found = {}
            for col, text, shared in cell_texts(e, self.dated, self.base, self.formats):
                # Without the strings themselves, a mark is enough to tell whether a sheet has cells.
                text = text if shared is None else self.shared[shared] if self.shared is not None else "?"
                if text.strip():
                    found[col] = text.strip()
            e.clear()
            if found:
                yield at, found

    def pick(self, sheet: str | None, hidden: bool) -> str | None:
        shown = [s for s in self.sheets if hidden or not s[1]]
        if sheet is not None:
            named = [s for s in shown if s[0] == sheet] or ([shown[int(sheet)]] if str(sheet).isdigit() and int(sheet) < len(shown) else [])
            return named[0][2] if named else None
        return next((s[2] for s in shown if next(self.rows(s[2]), None)), None)

    def headers(self, part: str, lettered: bool) -> list[str]:
        """Names of all columns up to the widest row; the first row with cells has them."""
        first, width = None, 0
        for _, found in self.rows(part):
            first = first or found
            width = max(width, max(found) + 1)
        texts = [(first or {}).get(i, "") for i in range(width)]
        return lettered_headers(texts) if lettered else unique_headers(texts)

    def data(self, part: str, drop_blank: bool = True) -> Iterator[tuple[int, dict[int, str]]]:
        """The rows after the header, without blank ones or with those between others."""
        last = None
        for n, found in self.rows(part):
            if last is not None:
                if not drop_blank:
                    yield from ((blank, {}) for blank in range(last + 1, n))
                yield n, found
            last = n


class _File(InputPartition):
    def __init__(self, path: str):
        super().__init__(path)
        self.path = path


def _unified(text: str) -> str:
    """As ``unify_decimal``."""
    return text.replace(",", ".", 1) if "," in text and "." not in text and re.search("[0-9]", text) and not re.search("[A-Za-z]", text) else text


class XlsxReader(DataSourceReader):
    def __init__(self, source: XlsxSource):
        self.source = source
        self.columns = source.headers()
        self.several = len(source.files()) > 1

    def partitions(self) -> list[InputPartition]:
        return [_File(p) for p in self.source.files()]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        book = Workbook(partition.path, displayed=self.source.flag("displayed"))
        part = book.pick(self.source.option("sheet"), self.source.flag("includeHidden"))
        if part is None:
            return
        own = book.headers(part, self.source.option("headerStyle") == "letter")
        place = {h: i for i, h in enumerate(self.columns)}
        clean = _unified if self.source.flag("unifyDecimal") else str
        for n, found in book.data(part, self.source.flag("dropBlank", "true")):
            row, more = [""] * len(self.columns), {}
            for i, text in found.items():
                if own[i] in place:
                    row[place[own[i]]] = clean(text)
                else:
                    more[own[i]] = clean(text)
            yield (n, *row, more) if self.several else (n, *row)


class XlsxSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "xlsx"

    def option(self, name: str, default: str | None = None) -> str | None:
        return self.options.get(name, default)

    def flag(self, name: str, default: str = "false") -> bool:
        return str(self.options.get(name, default)).lower() == "true"

    def files(self) -> list[str]:
        path = self.options["path"].removeprefix("file://")
        if re.match(r"[a-z0-9+.-]+://", path):
            raise ValueError("read_workbooks reads from other stores than the local one")
        found = sorted(glob.glob(os.path.join(path, "*.xlsx")) if os.path.isdir(path) else glob.glob(path))
        if not found:
            raise FileNotFoundError(path)
        return found

    def headers(self) -> list[str]:
        """Names of the first file's columns."""
        book = Workbook(self.files()[0])
        part = book.pick(self.option("sheet"), self.flag("includeHidden"))
        return book.headers(part, self.option("headerStyle") == "letter") if part else []

    def schema(self) -> StructType:
        fields = [StructField("_row", LongType()), *[StructField(h, StringType()) for h in self.headers()]]
        return StructType(fields + [StructField("_more", MapType(StringType(), StringType()))] if len(self.files()) > 1 else fields)

    def reader(self, schema: StructType) -> DataSourceReader:
        return XlsxReader(self)


def read_workbooks(spark: SparkSession, path: str, sheet: str | None = None, hidden: bool = False, drop_blank: bool = True, displayed: bool = False) -> DataFrame:
    """(path, row, cells) of all spreadsheets below a path in any store that Spark reads: cells maps the headers of the row's own
    file to its texts. A file is read by one task, its bytes in memory; files without cells give no rows."""
    return workbook_rows(spark, path, sheet, hidden, drop_blank, displayed).where("row > 0")


def workbook_rows(spark: SparkSession, path: str, sheet: str | None = None, hidden: bool = False, drop_blank: bool = True, displayed: bool = False) -> DataFrame:
    """``read_workbooks``, and for each file a row 0 whose cells map its headers to their positions."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.xlsx").option("recursiveFileLookup", "true").load(path)

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            for name, content in zip(batch.column("path").to_pylist(), batch.column("content").to_pylist(), strict=True):
                book = Workbook(io.BytesIO(content), displayed=displayed)
                part = book.pick(sheet, hidden)
                if part is None:
                    continue
                names = book.headers(part, False)
                rows = [(name, 0, [(h, str(i)) for i, h in enumerate(names)])]
                for n, found in book.data(part, drop_blank):
                    rows.append((name, n, [(names[i], text) for i, text in found.items()]))
                    if len(rows) == 1000:
                        yield _batch(pa, rows)
                        rows = []
                if rows:
                    yield _batch(pa, rows)

    return files.select("path", "content").mapInArrow(run, "path string, row long, cells map<string, string>")


def _batch(pa, rows: list[tuple]):
    kinds = [pa.string(), pa.int64(), pa.map_(pa.string(), pa.string())]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=["path", "row", "cells"])


def unify_decimal(c: Column) -> Column:
    """A number written with commas only gets a point for its first comma."""
    only = c.rlike("[0-9]") & ~c.rlike("[A-Za-z]") & c.contains(",") & ~c.contains(".")
    return F.when(only, F.regexp_replace(c, "^([^,]*),", "$1.")).otherwise(c)
