"""Workbook files made from the tables by Spark, scanned back into cells; arriving files."""

from __future__ import annotations

import io
import struct
import zipfile
import zlib
from collections.abc import Iterator
from itertools import chain, groupby

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ...operators import extract as X
from ...operators import merges as M
from ...session import ship_by_value, stage
from ...sources.config import Settings
from ...sources.workbook import parse_workbooks
from .base import chunk_name, query, table

ship_by_value(__name__)

_ROWS = 200
_ALL = 1_000_000_000  # rows of a workbook that holds the whole table
_BOOK_ROWS = 12_800  # of the workbooks that a task packs: their XML lies in one batch
_BLOCK = 256 << 10  # packed bytes in a row of a workbook that comes in blocks
BOOK = chunk_name("/books/parts_", "p_partkey", _ROWS)
_HEAD = '<?xml version="1.0" encoding="UTF-8"?>'
_NS = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
_REL = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"

# --- fixed values: the parts of a minimal workbook file
_PARTS = {
    "xl/workbook.xml": f'{_HEAD}<workbook {_NS} xmlns:r="{_REL}"><sheets><sheet name="Parts" sheetId="1" r:id="rId1"/></sheets></workbook>',
    "xl/_rels/workbook.xml.rels": (
        f'{_HEAD}<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">'
        f'<Relationship Id="rId1" Type="{_REL}/worksheet" Target="worksheets/sheet1.xml"/></Relationships>'
    ),
    "xl/styles.xml": (
        f'{_HEAD}<styleSheet {_NS}><numFmts><numFmt numFmtId="164" formatCode="dd\\/mm\\/yyyy"/></numFmts>'
        '<cellStyleXfs><xf numFmtId="0"/></cellStyleXfs>'
        '<cellXfs><xf numFmtId="0"/><xf numFmtId="164"/><xf numFmtId="14"/></cellXfs></styleSheet>'
    ),
}


def _zip(batches: Iterator) -> Iterator:
    for batch in batches:
        packed = []
        for sheet, strings in zip(batch["sheet_xml"], batch["strings_xml"]):
            out = io.BytesIO()
            with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as archive:
                for name, text in {**_PARTS, "xl/worksheets/sheet1.xml": sheet, "xl/sharedStrings.xml": strings}.items():
                    archive.writestr(name, text)
            packed.append(out.getvalue())
        yield batch[["path"]].assign(content=packed)


_SHEET = (
    f'{_HEAD}<worksheet {_NS}><sheetData><row r="1"><c r="A1" t="inlineStr"><is><t>Item</t></is></c><c r="D1" t="inlineStr"><is><t>Facts</t></is></c></row><row r="2">'
    + "".join(f'<c r="{c}2" t="inlineStr"><is><t>{h}</t></is></c>' for c, h in zip("ABCDEF", ("Key", "Name", "Kind", "Since", "Even", "Amount")))
    + "</row>",
    '</sheetData><mergeCells count="2"><mergeCell ref="A1:C1"/><mergeCell ref="D1:F1"/></mergeCells></worksheet>',
)
_STRINGS = (f"{_HEAD}<sst {_NS}><si><t>unused</t></si>", "</sst>")


def _path(rows_each: int) -> F.Column:
    return F.concat(F.expr(chunk_name("/books/parts_", "p_partkey", rows_each)), F.lit(".xlsx"))


def _row_xml(rows_each: int) -> tuple[F.Column, F.Column]:
    """A part's row in the sheet, and its shared string."""
    r = (F.col("p_partkey") % rows_each + 3).cast("string")

    def cell(col: str, body: str, *values) -> F.Column:
        return F.format_string(f'<c r="{col}%s"{body}</c>', r, *values)

    escaped = F.replace(F.replace("p_name", F.lit("r"), F.lit("&amp;")), F.lit("l"), F.lit("&lt;"))
    row = F.concat(
        F.lit('<row r="'), r, F.lit('">'),
        cell("A", "><v>%s</v>", F.col("p_partkey").cast("string")),
        cell("B", ' t="inlineStr"><is><t>%s</t></is>', escaped),
        cell("C", ' t="s"><v>%s</v>', (F.col("p_partkey") % rows_each + 1).cast("string")),
        cell("D", ' s="1"><v>%s</v>', (F.col("p_partkey") % 5000 + 36526).cast("string")),
        cell("E", ' t="b"><v>%s</v>', (F.col("p_size") % 2).cast("string")),
        cell("F", ' t="str"><v>%s</v>', F.concat(F.col("p_size").cast("string"), F.lit(","), F.lit("500"))),
        F.lit("</row>"),
    )
    shared = F.concat(F.lit("<si><r><t>"), "p_brand", F.lit("</t></r><r><t> / "), "p_type", F.lit("</t></r></si>"))
    return row, shared


def _tasks(part: DataFrame) -> int:
    return max(part.sparkSession.sparkContext.defaultParallelism, -(-part.count() // _BOOK_ROWS))


def book_files(spark, sf_dir, rows_each: int = _ROWS):
    """``(path, content)``: one workbook per 200 parts, or as many as are asked for."""
    part = table(spark, sf_dir, "part").withColumn("path", _path(rows_each))
    row, shared = _row_xml(rows_each)
    grouped = part.repartition(_tasks(part), "path").groupBy("path").agg(
        F.array_sort(F.collect_list(F.struct("p_partkey", row.alias("row"), shared.alias("shared")))).alias("x")
    )
    rows = F.array_join(F.transform("x", lambda v: v["row"]), "")
    strings = F.array_join(F.transform("x", lambda v: v["shared"]), "")
    files = grouped.select(
        "path",
        F.concat(F.lit(_SHEET[0]), rows, F.lit(_SHEET[1])).alias("sheet_xml"),
        F.concat(F.lit(_STRINGS[0]), strings, F.lit(_STRINGS[1])).alias("strings_xml"),
    )
    return files.mapInPandas(_zip, "path string, content binary")


def book_blocks(spark, sf_dir, rows_each: int):
    """``(path, block, content)``: the same workbooks, each packed by many tasks, in blocks of bounded size.

    A task packs the rows and strings of a range of parts. Packed streams that begin anew may follow each other, so only
    the sizes and checks of all blocks are brought together, for the headers and the directory of the file.
    """
    part = table(spark, sf_dir, "part").withColumn("path", _path(rows_each))
    row, shared = _row_xml(rows_each)
    ranges = part.repartitionByRange(_tasks(part), "path", "p_partkey").withColumns({"row": row, "shared": shared})
    ordered = ranges.sortWithinPartitions("path", "p_partkey", "row", "shared").select("path", "row", "shared")
    kind = "path string, kind bigint, n bigint, content binary, packed bigint, size bigint, check bigint"
    block = F.shiftleft("kind", 56) + F.shiftleft(F.spark_partition_id().cast("bigint"), 28) + F.col("n")
    blocks = stage(ordered.mapInArrow(_pack, kind).select("path", block.alias("block"), "content", "packed", "size", "check"))
    sizes = blocks.groupBy("path").agg(F.array_sort(F.collect_list(F.struct("block", "packed", "size", "check"))).alias("blocks"))
    return blocks.select("path", "block", "content").unionByName(sizes.mapInArrow(_bind, "path string, block bigint, content binary"))


class _Stream:
    """Text of one part of a workbook, packed to blocks which those of other tasks precede and follow."""

    def __init__(self, path: str | None, kind: int):
        self.path, self.kind, self.n = path, kind, 0
        self.deflate = zlib.compressobj(wbits=-15)
        self.packed, self.size, self.check = b"", 0, 0

    def add(self, text: str, last: bool = False) -> Iterator[tuple]:
        raw = text.encode()
        self.size, self.check = self.size + len(raw), zlib.crc32(raw, self.check)
        self.packed += self.deflate.compress(raw)
        if last:
            self.packed += self.deflate.flush(zlib.Z_FULL_FLUSH)
        if last or len(self.packed) >= _BLOCK:
            yield self.path, self.kind, self.n, self.packed, len(self.packed), self.size, self.check
            self.n, self.packed, self.size, self.check = self.n + 1, b"", 0, 0


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
    names = ["path", "kind", "n", "content", "packed", "size", "check"]

    def packed() -> Iterator[tuple]:
        streams = []
        for batch in batches:
            for path, run in groupby(zip(*(batch.column(n).to_pylist() for n in ("path", "row", "shared"))), key=lambda r: r[0]):
                if not streams or path != streams[0].path:
                    yield from chain.from_iterable(s.add("", True) for s in streams)
                    streams = [_Stream(path, kind) for kind in (1, 3)]
                _, *texts = zip(*run)
                for stream, some in zip(streams, texts):
                    yield from stream.add("".join(x for x in some if x is not None))
        yield from chain.from_iterable(s.add("", True) for s in streams)

    for block in packed():
        yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(block, kinds)], names)


def _bind(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What stands before, between and after the blocks of a workbook's two large parts."""
    for batch in batches:
        for path, blocks in zip(batch.column("path").to_pylist(), batch.column("blocks").to_pylist()):
            found = [(path, kind << 56, content) for kind, content in zip((0, 2, 4), _bound(blocks))]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found), (pa.string(), pa.int64(), pa.binary()))], ["path", "block", "content"])


def _bound(blocks: list[dict]) -> list[bytes]:
    large = {"xl/worksheets/sheet1.xml": (1, *_SHEET), "xl/sharedStrings.xml": (3, *_STRINGS)}
    out, directory, at = [b""], [], 0
    for name, (kind, opening, ending) in {**{name: (0, text, "") for name, text in _PARTS.items()}, **large}.items():
        first, last = opening.encode(), ending.encode()
        own = [b for b in blocks if b["block"] >> 56 == kind]
        check, size = zlib.crc32(first), len(first)
        for some, n in [*((b["check"], b["size"]) for b in own), (zlib.crc32(last), len(last))]:
            check, size = _check_of_both(check, some, n), size + n
        first, last = _deflated(first, zlib.Z_FULL_FLUSH), _deflated(last, zlib.Z_FINISH)
        packed = len(first) + sum(b["packed"] for b in own) + len(last)
        header, record = _entry(name.encode(), check, packed, size, at)
        out[-1] += header + first
        if kind:
            out.append(b"")  # here lie its blocks
        out[-1] += last
        directory.append(record)
        at += len(header) + packed
    out[-1] += _directory(directory, at)
    return out


def _deflated(text: bytes, end: int) -> bytes:
    deflate = zlib.compressobj(wbits=-15)
    return deflate.compress(text) + deflate.flush(end)


def _times(a: int, b: int) -> int:
    """Product of two polynomials modulo that of CRC-32; the highest bit is x to the power 0."""
    product = 0
    while a:
        if a & 1 << 31:
            product ^= b
        a, b = a << 1 & 0xFFFFFFFF, b >> 1 ^ (0xEDB88320 if b & 1 else 0)
    return product


def _check_of_both(first: int, second: int, n: int) -> int:
    """CRC-32 of two texts in a row, from theirs; the second has ``n`` bytes."""
    power = 1 << 23  # of x: 8 bits, doubled with each bit of n
    while n:
        first, power, n = _times(power, first) if n & 1 else first, _times(power, power), n >> 1
    return first ^ second


_MOST = 0xFFFFFFFF  # stands for numbers that don't fit; they are kept in 64 bits beside


def _wide(*numbers: int) -> bytes:
    return struct.pack(f"<2H{len(numbers)}Q", 1, 8 * len(numbers), *numbers) if numbers else b""


def _entry(name: bytes, check: int, packed: int, size: int, at: int) -> tuple[bytes, bytes]:
    """A part's header in the archive, and its record in the directory."""
    day = 33  # 1980-01-01
    over = max(packed, size) >= _MOST
    extra, sizes = (_wide(size, packed), (_MOST, _MOST)) if over else (b"", (packed, size))
    header = struct.pack("<4s5H3I2H", b"PK\3\4", 45, 0, zipfile.ZIP_DEFLATED, 0, day, check, *sizes, len(name), len(extra))
    more = _wide(*((size, packed) if over else ()), *((at,) if at >= _MOST else ()))
    record = struct.pack("<4s6H3I5H2I", b"PK\1\2", 45, 45, 0, zipfile.ZIP_DEFLATED, 0, day, check, *sizes, len(name), len(more), 0, 0, 0, 0, min(at, _MOST))
    return header + name + extra, record + name + more


def _directory(records: list[bytes], at: int) -> bytes:
    n, size = len(records), sum(map(len, records))
    end = b""
    if at >= _MOST:
        end = struct.pack("<4sQ2H2I4Q", b"PK\6\6", 44, 45, 45, 0, 0, n, n, size, at) + struct.pack("<4sIQI", b"PK\6\7", 0, at + size, 1)
    return b"".join(records) + end + struct.pack("<4s4H2IH", b"PK\5\6", 0, 0, n, n, size, min(at, _MOST), 0)


_NAME = "replace(replace(p_name, 'r', '&'), 'l', '<')"
_SINCE = "strftime(TIMESTAMP '2000-01-01' + to_days(CAST(p_partkey % 5000 AS INT)), '%Y-%m-%d %H:%M:%S')"


def _cells_sql(rows_each: int) -> str:
    return f"""
    WITH p AS (SELECT *, concat({chunk_name("/books/parts_", "p_partkey", rows_each)}, '.xlsx') AS workbook, CAST(p_partkey % {rows_each} + 3 AS INT) AS r FROM part)
    SELECT workbook, 'Parts' AS sheet, r, 1 AS c, CAST(p_partkey AS STRING) AS value, 'number' AS kind FROM p
    UNION ALL SELECT workbook, 'Parts', r, 2, {_NAME}, 'string' FROM p
    UNION ALL SELECT workbook, 'Parts', r, 3, concat(p_brand, ' / ', p_type), 'string' FROM p
    UNION ALL SELECT workbook, 'Parts', r, 4, {_SINCE}, 'date' FROM p
    UNION ALL SELECT workbook, 'Parts', r, 5, CASE WHEN p_size % 2 = 1 THEN 'True' ELSE 'False' END, 'bool' FROM p
    UNION ALL SELECT workbook, 'Parts', r, 6, concat(CAST(p_size AS STRING), ',500'), 'string' FROM p
    """


@query("workbook_scan", _cells_sql(_ROWS))
def workbook_scan(spark, sf_dir):
    """Shared, inline and formula strings, numbers, dates and flags out of zipped XML."""
    cells = parse_workbooks(book_files(spark, sf_dir)).cells
    return cells.where(F.col("r") > 2)


@query("workbook_one_sheet", _cells_sql(_ALL))
def workbook_one_sheet(spark, sf_dir):
    """All parts on one sheet with one table of strings, walked in pieces."""
    cells = parse_workbooks(stage(book_blocks(spark, sf_dir, _ALL))).cells
    return cells.where(F.col("r") > 2)


@query(
    "workbook_merges",
    f"""
    SELECT DISTINCT concat({BOOK}, '.xlsx') AS workbook, 'Parts' AS sheet, 1 AS min_r, x.a AS min_c, 1 AS max_r, x.a + 2 AS max_c
    FROM part, (VALUES (1), (4)) x(a)
    """,
)
def workbook_merges(spark, sf_dir):
    return parse_workbooks(book_files(spark, sf_dir)).merges


@query(
    "workbook_to_table",
    f"""
    SELECT p_partkey AS "Item | Key", {_NAME} AS "Item | Name", concat(p_brand, ' / ', p_type) AS "Item | Kind",
           TIMESTAMP '2000-01-01' + to_days(CAST(p_partkey % 5000 AS INT)) AS "Facts | Since", p_size % 2 = 1 AS "Facts | Even",
           CAST(p_size AS BIGINT) * 1000 + 500 AS "Facts | Amount"
    FROM part
    """,
)
def workbook_to_table(spark, sf_dir):
    """From files to one typed table: scan, merged banner, two header rows, types."""
    books = parse_workbooks(book_files(spark, sf_dir))
    grid = stage(M.fill_merged(books.cells, books.merges))
    sheet = {
        "sheet_name": "Parts", "output_name": "parts", "table_type": "simple", "header_rows": [1, 2],
        "data_start_row": 3, "index_columns": ["Item | Key"],
    }
    return X.extract_table(grid, sheet, Settings()).frame
