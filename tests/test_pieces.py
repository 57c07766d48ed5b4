"""Large sheets in pieces: the same cells as in one walk, whatever the pieces."""

import io
import zipfile

import pytest
from celltables import tuples

from refmill.sources import workbook as W

NS = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
REL = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"


def packed(sheet, strings="", method=zipfile.ZIP_DEFLATED):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", method) as z:
        z.writestr("xl/workbook.xml", f'<workbook xmlns="{NS}" xmlns:r="{REL}"><sheets><sheet name="S" sheetId="1" r:id="x"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", '<Relationships><Relationship Id="x" Target="worksheets/sheet1.xml"/></Relationships>')
        z.writestr("xl/worksheets/sheet1.xml", sheet)
        if strings:
            z.writestr("xl/sharedStrings.xml", strings)
    return out.getvalue()


def rows(n):
    for i in range(n):
        kind = i % 9
        number = f' r="{i * 2 + 5}"' if kind in (0, 4) else f" spans='1:2' r = '{i * 2 + 5}'" if kind == 2 else ""
        if kind == 8:
            yield "<row/>"
            continue
        inner = f"<c><v>{i}</v></c><c t='s'><v>{i % 50}</v></c>"
        if kind == 3:
            inner += "<c t='inlineStr'><is><t><![CDATA[</row><row r='9'>]]></t></is></c>"
        if kind == 5:
            inner += "<!-- </row> --><c t='str'><v>é&lt;</v></c>"
        yield f"<row{number}>{inner}</row>"


PLAIN = f'<?xml version="1.0"?><worksheet xmlns="{NS}"><cols><col min="1"/></cols><sheetData>{"".join(rows(400))}</sheetData><mergeCells><mergeCell ref="A1:B2"/></mergeCells></worksheet>'
PREFIXED = f'<x:worksheet xmlns:x="{NS}"><x:sheetData>{"".join(rows(200)).replace("</", "</x:").replace("<row", "<x:row").replace("<c", "<x:c").replace("<v", "<x:v").replace("<is>", "<x:is>").replace("<t>", "<x:t>").replace("CDATA[</x:row><x:row", "CDATA[</row><row").replace("</x:row> -->", "</row> -->")}</x:sheetData></x:worksheet>'
STRINGS = f'<sst xmlns="{NS}">{"".join(f"<si><t>s{i}</t></si>" if i % 3 else f"<si><r><t>r</t></r><r><t>{i}</t></r></si>" for i in range(60))}</sst>'
EMPTY = f'<worksheet xmlns="{NS}"><sheetData/></worksheet>'


def scan(spark, content):
    books = W.parse_workbooks(spark.createDataFrame([("a.xlsx", content)], "path string, content binary"))
    return tuples(books.cells), tuples(books.merges), tuples(books.errors)


@pytest.mark.parametrize("size", [3, 700, 5000])
@pytest.mark.parametrize("sheet", [PLAIN, PREFIXED, EMPTY], ids=["plain", "prefixed", "empty"])
def test_pieces_equal_the_whole(spark, monkeypatch, sheet, size):
    content = packed(sheet, STRINGS, zipfile.ZIP_STORED if size == 700 else zipfile.ZIP_DEFLATED)
    whole = scan(spark, content)
    monkeypatch.setattr(W, "SPLIT_PART", 0)
    monkeypatch.setattr(W, "PIECE", size)
    monkeypatch.setattr(W, "CHUNK", 64)
    assert scan(spark, content) == whole
    assert bool(whole[0]) == (sheet is not EMPTY) and not whole[2]


def test_one_sheet_goes_to_many_tasks(spark):
    body = "".join(f'<row r="{i}"><c r="A{i}"><v>{i * 7919 % 1000003}</v></c><c r="B{i}" t="str"><v>text {i * 31 % 977}</v></c></row>' for i in range(1, 200_001))
    content = packed(f'<worksheet xmlns="{NS}"><sheetData>{body}</sheetData></worksheet>')
    files = spark.createDataFrame([("a.xlsx", content)], "path string, content binary")
    pieces = files.mapInPandas(W._unpack, W.PART_DDL).mapInPandas(W._pieces, W.PIECE_DDL).where("part LIKE '%sheet1%'").select("before", "piece").collect()
    assert len(pieces) > 4 and sorted(pieces, key=lambda r: r.piece) == sorted(pieces, key=lambda r: r.before)
    cells = W.parse_workbooks(files).cells
    assert cells.count() == 400_000 and cells.where("r = 200000 AND c = 2").first().value == f"text {200000 * 31 % 977}"


def test_damage_in_a_large_part_is_an_error_row(spark, monkeypatch):
    monkeypatch.setattr(W, "SPLIT_PART", 0)
    content = bytearray(packed(PLAIN))
    at = content.find(b"sheet1.xml") + 60
    content[at : at + 20] = bytes(20)
    _, _, errors = scan(spark, bytes(content))
    assert len(errors) == 1 and errors[0][0] == "a.xlsx"
