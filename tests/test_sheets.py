"""One sheet read by many tasks equals the sheet read by one; its texts by number formats."""

import io
import zipfile

import pytest

from colscope.operators.naming import column_letters
from colscope.sources.sheets import fragments, read_cells
from colscope.sources.xlsx import Workbook

REL = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"


def write_book(path, n, prefix="", numbered=True, wide=False):
    """A sheet with shared strings (one of them in most cells), inline texts, numbers, booleans, dates, gaps and blank rows."""
    p = f"{prefix}:" if prefix else ""
    shared = ["hot", "name", "qty", "when", "note"] + [f"text {i} & é" for i in range(200)]
    rows = []
    for i in range(n):
        ref = lambda c: f" r='{column_letters(c)}{i + 1}'" if numbered else ""  # noqa: B023, E731
        cell = lambda c, kind, body: f"<{p}c{ref(c)}{kind}>{body}</{p}c>"  # noqa: B023, E731
        v = lambda x: f"<{p}v>{x}</{p}v>"
        if i == 0:
            cells = [cell(c, " t='s'", v(k)) for c, k in enumerate((1, 2, 3, 1))]
        elif i % 97 == 5:
            cells = []
        else:
            cells = [cell(0, " t='s'", v(0 if i % 3 else 5 + i % 200)), cell(1, "", v(i / 2)), cell(2, " s='1'", v(45000 + i % 300)), cell(3, " t='inlineStr'", f"<{p}is><{p}t> in {i} </{p}t></{p}is>")]
            if numbered and i % 5 == 0:
                cells.append(cell(6, " t='b'", v(i % 2)))
            if i % 7 == 0:
                cells.append(cell(7, " t='e'", v("#N/A")))
        number = f" r='{i + 1}'".replace("'", '"') if numbered and i % 11 else ""
        rows.append(f"<{p}row{number}>{''.join(cells)}</{p}row>" if cells or i % 2 else f"<{p}row{number}/>")
    space = f"xmlns:{prefix}='m'" if prefix else "xmlns='m'"
    sheet = f"<?xml version='1.0'?><{p}worksheet {space}><{p}cols/><{p}sheetData>{''.join(rows)}</{p}sheetData><{p}pageMargins/></{p}worksheet>"
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("xl/workbook.xml", f"<workbook xmlns='m' xmlns:r='{REL}'><sheets><sheet name='S' sheetId='1' r:id='r1'/></sheets></workbook>")
        z.writestr("xl/_rels/workbook.xml.rels", "<Relationships><Relationship Id='r1' Target='worksheets/sheet1.xml'/></Relationships>")
        z.writestr("xl/worksheets/sheet1.xml", sheet)
        z.writestr("xl/sharedStrings.xml", "<sst xmlns='m'>" + "".join(f"<si><t>{s.replace('&', '&amp;')}</t></si>" for s in shared) + "</sst>")
        z.writestr("xl/styles.xml", "<styleSheet xmlns='m'><cellXfs><xf numFmtId='0'/><xf numFmtId='14'/></cellXfs></styleSheet>")


def alone(path):
    book = Workbook(str(path))
    part = book.pick(None, False)
    names = book.headers(part, False)
    return {(path.name, n, i, names[i], text) for n, found in book.data(part) for i, text in found.items()}, names


@pytest.mark.parametrize("size", [200, 5_000, 10**9])
def test_fragments_hold_all_rows_once(tmp_path, size):
    for k, args in enumerate(({}, {"prefix": "x"}, {"numbered": False})):
        write_book(tmp_path / f"{k}.xlsx", 400, **args)
        book = Workbook(str(tmp_path / f"{k}.xlsx"))
        xml = book.zip.read("xl/worksheets/sheet1.xml")
        got = list(fragments(io.BytesIO(xml), size))
        assert b"".join(r for _, _, r in got) == xml.split(b"sheetData>")[1].rsplit(b"</", 1)[0]
        assert got[0][0] == 0 and (size > 10**8) == (len(got) == 1)
    assert list(fragments(io.BytesIO(b"<worksheet><sheetData/></worksheet>"))) == []


def test_sheets_by_many_tasks(spark, tmp_path):
    write_book(tmp_path / "a.xlsx", 20_000)
    write_book(tmp_path / "b.xlsx", 300, prefix="x")
    write_book(tmp_path / "c.xlsx", 1)
    write_book(tmp_path / "d.xlsx", 50, numbered=False)
    rows, header = read_cells(spark, str(tmp_path), fragment=200_000)
    want, names = set(), {}
    for k in "abcd":
        cells, names[f"{k}.xlsx"] = alone(tmp_path / f"{k}.xlsx")
        want |= cells
    got = {(r.path.rsplit("/", 1)[1], r.row, r.col, r.header, r.value) for r in rows.collect()}
    assert got == want
    heads = {}
    for r in header.orderBy("col").collect():
        heads.setdefault(r.path.rsplit("/", 1)[1], []).append(r.header)
    assert heads == names and names["a.xlsx"][:4] == ["name", "qty", "when", "name#2"]
