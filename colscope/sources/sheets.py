"""One large sheet read by many tasks.

A sheet is a compressed stream, so one task has to unpack it; that task does no more than cut it at the borders of rows. Parsing, by
far the larger part, goes on in parallel:

1. One task a file unpacks its sheet and gives out fragments of whole rows of some megabytes, each with the rows before it, and its
   shared strings as rows (index, text). Both are written, so a lost executor costs a fragment.
2. Each fragment is parsed by whichever task gets it, into cells; shared strings stay numbers.
3. Numbers of shared strings meet their texts in a join by file and index. A string that most cells have is shared out by adaptive
   execution, as cells come from a plain shuffle.
"""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.naming import unique_headers
from ..storage import Stored
from .xlsx import Workbook, cell_texts, local_name

#: Bytes of XML of a fragment; a longer row makes a longer one.
FRAGMENT = 4_000_000

_ROW = re.compile(rb"<(?:\w+:)?row[\s>/]")
_DATA = re.compile(rb"<((?:\w+:)?)sheetData(?:\s[^>]*)?>")
_NUMBER = re.compile(rb'<(?:\w+:)?row\s[^>]*?\br="([0-9]+)"')


def fragments(stream, size: int = FRAGMENT) -> Iterator[tuple[int, bytes, bytes]]:
    """(number of the row before, what stands before all rows, rows) of a sheet's XML, cut where a row begins."""
    head, held = b"", b""
    while not (m := _DATA.search(head)):
        block = stream.read(65536)
        if not block:
            return
        head += block
    head, held = head[: m.end()], head[m.end() :]
    before, done = 0, False
    while not done:
        block = stream.read(max(1 << 20, size))
        done = not block
        held += block
        while held and (done or len(held) >= 2 * size):
            starts = [x.start() for x in _ROW.finditer(held)]
            if not starts:
                held = b""
                break
            stop = next((x for x in starts if x >= size), None)
            if stop is None and not done:
                break
            rows = held[starts[0] : stop] if stop is not None else held[starts[0] :].split(b"</" + m[1] + b"sheetData", 1)[0]
            if rows:
                yield before, head, rows
                before = _last_row(before, rows)
            held = held[stop:] if stop is not None else b""


def _last_row(before: int, rows: bytes) -> int:
    """The number of the last row: numbers count on from the last one that is written."""
    for m in _ROW.finditer(rows):
        number = _NUMBER.match(rows, m.start())
        before = int(number[1]) if number else before + 1
    return before


def _document(head: bytes, rows: bytes) -> bytes:
    prefix = _DATA.search(head)[1]
    root = re.search(rb"<((?:\w+:)?worksheet)[\s>]", head)
    return head + rows + b"</" + prefix + b"sheetData></" + root[1] + b">"


def _taken_apart(sheet: str | None, hidden: bool, size: int):
    def run(batches):
        import pyarrow as pa

        row = lambda *x: pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(x, (pa.string(), pa.int32(), pa.int64(), pa.string(), pa.binary(), pa.binary()), strict=True)], names=["path", "kind", "n", "text", "head", "rows"])
        for batch in batches:
            for path, content in zip(batch.column("path").to_pylist(), batch.column("content").to_pylist(), strict=True):
                book = Workbook(io.BytesIO(content), strings=False)
                part = book.pick(sheet, hidden)
                if part is None:
                    continue
                yield row(path, 0, 0, repr((sorted(book.dated), book.base.isoformat())), None, None)
                for before, head, rows in fragments(book.zip.open(part), size):
                    yield row(path, 1, before, None, head, rows)
                held: list[tuple[int, str]] = []
                for i, text in enumerate(book.strings()):
                    held.append((i, text))
                    if len(held) == 10_000:
                        yield _strings(pa, path, held)
                        held = []
                if held:
                    yield _strings(pa, path, held)

    return run


def _strings(pa, path: str, held: list[tuple[int, str]]):
    n = len(held)
    columns = [[path] * n, [2] * n, [x[0] for x in held], [x[1] for x in held], [None] * n, [None] * n]
    kinds = (pa.string(), pa.int32(), pa.int64(), pa.string(), pa.binary(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["path", "kind", "n", "text", "head", "rows"])


def _parsed(batches):
    """(path, row, col, text, shared) of the cells of fragments."""
    import ast
    import datetime

    import pyarrow as pa

    for batch in batches:
        for path, before, head, rows, style in zip(*(batch.column(c).to_pylist() for c in ("path", "n", "head", "rows", "style")), strict=True):
            dated, base = ast.literal_eval(style)
            dated, base = set(dated), datetime.datetime.fromisoformat(base)
            out, at = [], before
            for _, e in ElementTree.iterparse(io.BytesIO(_document(head, rows))):
                if local_name(e.tag) != "row":
                    continue
                at = int(e.get("r") or at + 1)
                for col, text, shared in cell_texts(e, dated, base):
                    out.append((path, at, col, text, shared))
                e.clear()
            if out:
                columns = zip(*out, strict=True)
                kinds = (pa.string(), pa.int64(), pa.int32(), pa.string(), pa.int64())
                yield from pa.Table.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["path", "row", "col", "text", "shared"]).to_batches(50_000)


def read_cells(spark: SparkSession, path: str, sheet: str | None = None, hidden: bool = False, fragment: int = FRAGMENT) -> tuple[DataFrame, DataFrame]:
    """Cells (path, row, col, header, value) of all spreadsheets below a path, and their headers (path, col, header).

    The first row with cells has the headers, which are named as ``Workbook.headers`` names them; columns count from 0. Large sheets
    are parsed by as many tasks as they have fragments. Cells without a text aren't there. Files in any store that Spark reads.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.xlsx").option("recursiveFileLookup", "true").load(path)
    schema = "path string, kind int, n long, text string, head binary, rows binary"
    apart = Stored(files.select("path", "content").mapInArrow(_taken_apart(sheet, hidden, fragment), schema), "sheet-fragments").df
    styles = apart.where("kind = 0").select("path", F.col("text").alias("style"))
    pieces = apart.where("kind = 1").select("path", "n", "head", "rows").join(styles, "path")
    many = max(1, pieces.count())
    parsed = pieces.repartition(many, "path", "n").mapInArrow(_parsed, "path string, row long, col int, text string, shared long")
    strings = apart.where("kind = 2").select("path", F.col("n").alias("shared"), F.col("text").alias("string"))
    cells = parsed.join(strings, ["path", "shared"], "left").select("path", "row", "col", F.trim(F.coalesce("text", "string")).alias("value")).where("value <> ''")
    cells = Stored(cells, "sheet-cells").df
    first = cells.groupBy("path").agg(F.min("row").alias("first"), F.max("col").alias("last"))
    named = cells.join(first, "path").where("row = first").groupBy("path").agg(F.map_from_entries(F.collect_list(F.struct("col", "value"))).alias("texts"), F.first("last").alias("last"))
    listed = named.select("path", F.transform(F.sequence(F.lit(0), F.col("last")), lambda i: F.coalesce(F.try_element_at("texts", i), F.lit(""))).alias("texts"))  # as long as a header

    @F.udf("array<string>")
    def names(texts):
        return unique_headers(texts)

    header = listed.select("path", F.posexplode(names("texts")).alias("col", "header"))
    rows = cells.join(first, "path").where("row > first").join(header, ["path", "col"])
    return rows.select("path", "row", "col", "header", "value"), header
