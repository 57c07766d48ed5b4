"""Spreadsheet scan: many .xlsx/.xlsm files → cells, merged ranges, sheets, errors.

Python only unpacks the zip and walks the XML; shared strings, styles, dates and
kinds are resolved by Spark joins and expressions. The packed sheets are handed out
one by one, in slices of bounded size. A large sheet, or table of strings, is inflated by one task, which is quick, and cut
between rows into pieces that begin with the sheet's own opening and know the number of the row
before them; so the walk through one sheet is shared by many tasks, each in constant memory.
A workbook too large for a row comes in blocks, which the unpacking task puts on its disk.
"""

from __future__ import annotations

import io
import re
import struct
import tempfile
import zipfile
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import chain, groupby
from typing import TYPE_CHECKING, BinaryIO

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ship_by_value, stage

if TYPE_CHECKING:
    import pandas as pd

ship_by_value(__name__)

SUFFIXES = ("xlsx", "xlsm")
BATCH = 20_000
CHUNK = 1 << 20
PIECE = 2 << 20  # bytes of XML in a piece of a large part; a longer row makes a longer piece
SPLIT_PART = 256 << 10  # packed bytes from which a part is cut
SLICE = 256 << 10  # packed bytes of a part in a row

PART_DDL = "workbook string, part string, method int, data binary, error string, entry int, slice int"
PIECE_DDL = "workbook string, part string, method int, data binary, error string, before int, piece int"
EVENT_DDL = "workbook string, part string, what string, r int, ref string, type string, style int, text string"

# --- fixed values: number formats that show a date or time
DATE_FORMAT_IDS = (14, 15, 16, 17, 18, 19, 20, 21, 22, 45, 46, 47)
_WANTED = re.compile(r"^xl/(workbook\.xml|_rels/workbook\.xml\.rels|sharedStrings\.xml|styles\.xml|worksheets/[^/]+\.xml)$")


@dataclass(frozen=True)
class Workbooks:
    cells: DataFrame  # workbook, sheet, r, c, value, kind
    merges: DataFrame  # workbook, sheet, min_r, min_c, max_r, max_c
    sheets: DataFrame  # workbook, sheet, position
    errors: DataFrame  # workbook, error


def _framed(rows: Iterator[tuple], columns: list[str]) -> Iterator[pd.DataFrame]:
    """Rows in frames of bounded size: a frame for each part would cost more than the part."""
    import pandas as pd

    held, size = [], 0
    for row in rows:
        held.append(row)
        size += len(row[3]) if isinstance(row[3], bytes) else 0
        if len(held) >= BATCH or size >= PIECE:
            yield pd.DataFrame(held, columns=columns, dtype=object)
            held, size = [], 0
    if held:
        yield pd.DataFrame(held, columns=columns, dtype=object)


def _unpack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Still-compressed parts of each workbook, one row per part, or per slice of a large one."""
    whole = ((path, io.BytesIO(content)) for batch in batches for path, content in zip(batch["path"], batch["content"]))
    yield from _framed(_parts(whole), ["workbook", "part", "method", "data", "error", "entry", "slice"])


def _unpack_blocks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The same of workbooks in blocks, which come in order."""
    yield from _framed(_parts(_put_together(batches)), ["workbook", "part", "method", "data", "error", "entry", "slice"])


def _put_together(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[str, BinaryIO]]:
    blocks = ((path, content) for batch in batches for path, content in zip(batch["path"], batch["content"]))
    for path, own in groupby(blocks, key=lambda block: block[0]):
        with tempfile.TemporaryFile() as file:
            for _, content in own:
                file.write(content or b"")
            yield path, file


def _parts(files: Iterator[tuple[str, BinaryIO]]) -> Iterator[tuple]:
    entry = 0  # tells parts of one name apart
    for path, file in files:
        try:
            with zipfile.ZipFile(file) as archive:
                wanted = [(info, _data_start(file, info)) for info in archive.infolist() if _WANTED.match(info.filename)]
            if not any(info.filename == "xl/workbook.xml" for info, _ in wanted):
                raise ValueError("no workbook part in the file")
        except Exception as error:  # a broken file is a row, not a failed job
            yield path, None, None, None, f"{type(error).__name__}: {error}"[:500], entry, 0
            entry += 1
            continue
        for info, start in wanted:
            for n, data in enumerate(_slices(file, start, info.compress_size)):
                yield path, info.filename, info.compress_type, data, None, entry, n
            entry += 1


def _data_start(file: BinaryIO, info: zipfile.ZipInfo) -> int:
    file.seek(info.header_offset + 26)
    name_len, extra_len = struct.unpack("<HH", file.read(4))
    return info.header_offset + 30 + name_len + extra_len


def _slices(file: BinaryIO, start: int, size: int) -> Iterator[bytes]:
    """At least one; a file that ends early has fewer."""
    file.seek(start)
    yield file.read(min(size, SLICE))
    while (size := size - SLICE) > 0 and (some := file.read(min(size, SLICE))):
        yield some


def _inflated(data: Iterable[bytes], method: int) -> Iterator[bytes]:
    inflate = zlib.decompressobj(-15) if method == zipfile.ZIP_DEFLATED else None
    for rest in (some[at : at + CHUNK] for some in data for at in range(0, len(some), CHUNK)):
        if not inflate:
            yield rest
            continue
        while some := inflate.decompress(rest, PIECE):  # what is packed tightly comes out bit by bit
            yield some
            rest = inflate.unconsumed_tail


def _cut(data: Iterable[bytes], method: int, element: str) -> Iterator[tuple[int, bytes]]:
    """``(number of the last element before, XML)`` of a part cut between elements; what precedes the first one opens every piece."""
    opening = re.compile(rf"<((?:[\w.-]+:)?){element}(?=[\s/>])".encode())
    head, close, tag, held, before = None, b"", None, b"", 0
    for some in _inflated(data, method):
        held += some
        if head is None:
            found = opening.search(held)
            if not found:
                continue
            name = found[1] + element.encode()
            close, tag = b"</" + name + b">", re.compile(b"<" + re.escape(name) + rb"(?=[\s/>])([^>]*)>")
            head, held = held[: found.start()], held[found.start() :]
        while len(held) >= PIECE:
            end = _safe_end(held, close)
            if not end:
                break
            yield before, head + held[:end]
            before, held = _last_number(tag, held[:end], before), held[end:]
    yield before, (head or b"") + held


def _safe_end(text: bytes, close: bytes) -> int:
    """The end of the last element that is closed outside comments and literal sections; 0 if there is none."""
    end = text.rfind(close)
    while end >= 0:
        literal = max(text.rfind(b"<![CDATA[", 0, end), text.rfind(b"<!--", 0, end))
        if literal < 0 or max(text.find(b"]]>", literal, end), text.find(b"-->", literal, end)) >= 0:
            return end + len(close)
        end = text.rfind(close, 0, literal)
    return 0


def _last_number(tag: re.Pattern, text: bytes, before: int) -> int:
    """The number of the last element: those without one count on from the element before."""
    found = tag.findall(text)
    for after, attributes in enumerate(reversed(found)):
        own = re.search(rb"""(?:^|\s)r\s*=\s*["'](\d+)["']""", attributes)
        if own:
            return int(own[1]) + after
    return before + len(found)


def _pieces(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Large sheets and string tables in pieces, other parts as they are."""
    yield from _framed(_cut_parts(batches), ["workbook", "part", "method", "data", "error", "before", "piece"])


def _cut_parts(batches: Iterator[pd.DataFrame]) -> Iterator[tuple]:
    for row, data in _by_part(batches):
        element = "row" if (row.part or "").startswith("xl/worksheets/") else "si" if row.part == "xl/sharedStrings.xml" else None
        if row.error is not None:
            yield row.workbook, row.part, row.method, row.data, row.error, 0, 0
            continue
        head = b""
        while (element is None or len(head) < SPLIT_PART) and (some := next(data, b"")):
            head += some
        if element is None or len(head) < SPLIT_PART:
            yield row.workbook, row.part, row.method, head, None, 0, 0
            continue
        n = 0
        try:
            for n, (before, piece) in enumerate(_cut(chain([head], data), int(row.method), element)):
                yield row.workbook, row.part, zipfile.ZIP_STORED, piece, None, before, n
        except Exception as problem:
            error = f"{type(problem).__name__}: {problem}"[:500]
            yield row.workbook, row.part, None, None, error, 0, n + 1


def _by_part(batches: Iterator[pd.DataFrame]) -> Iterator[tuple]:
    """The first row of each part with the data of all its slices; a part's rows come one after the other."""

    def numbered() -> Iterator[tuple]:
        number = 0
        for batch in batches:
            for row in batch.itertuples(index=False):
                number += row.slice == 0
                yield number, row

    for _, rows in groupby(numbered(), key=lambda x: x[0]):
        _, first = next(rows)
        yield first, chain([first.data], (row.data for _, row in rows))


def _walk(data: bytes, method: int, before: int = 0) -> Iterator[tuple]:
    """``(what, r, ref, type, style, text)`` of one XML part or a piece of it, streamed; rows or strings are numbered on from ``before``."""
    from xml.etree.ElementTree import XMLPullParser

    parser = XMLPullParser(["start", "end"])
    row = ordinal = before
    col = 0
    path: list = []
    text: list[str] = []
    for some in chain(_inflated([data], method), [b""]):
        if some:
            parser.feed(some)
        elif hasattr(parser, "flush"):
            parser.flush()  # newer parsers put off what comes in small feeds
        for event, el in parser.read_events():
            tag = el.tag.rpartition("}")[2]
            if event == "start":
                path.append(el)
                if tag == "row":
                    row, col = int(el.get("r") or row + 1), 0
                elif tag in ("si", "is", "cellXfs"):
                    text, ordinal = [], ordinal if tag != "cellXfs" else 0
                continue
            path.pop()
            if tag == "t" and not any(p.tag.endswith("}rPh") for p in path):
                text.append(el.text or "")
            elif tag == "c":
                kind, ref = el.get("t") or "n", el.get("r") or f"#{col + 1}"
                value = "".join(text) if kind == "inlineStr" else next((x.text for x in el if x.tag.endswith("}v")), None)
                col = _column(ref)
                text = []
                if value is not None:
                    yield "cell", row, str(col), kind, int(el.get("s") or 0), value
            elif tag == "si":
                yield "string", ordinal, None, None, 0, "".join(text)
                ordinal += 1
            elif tag == "xf" and path and path[-1].tag.endswith("}cellXfs"):
                yield "style", ordinal, None, None, int(el.get("numFmtId") or 0), None
                ordinal += 1
            elif tag == "numFmt" and path and path[-1].tag.endswith("}numFmts"):
                yield "format", int(el.get("numFmtId")), None, None, 0, el.get("formatCode")
            elif tag == "mergeCell":
                yield "merge", 0, el.get("ref"), None, 0, None
            elif tag == "sheet":
                link = next((v for k, v in el.attrib.items() if k.rpartition("}")[2] == "id"), None)
                yield "sheet", ordinal, link, None, 0, el.get("name")
                ordinal += 1
            elif tag == "workbookPr":
                yield "date1904", int(el.get("date1904") in ("1", "true")), None, None, 0, None
            elif tag == "Relationship":
                yield "link", 0, el.get("Id"), None, 0, el.get("Target")
            if tag in ("row", "si", "mergeCell", "xf"):
                el.clear()
                if path:
                    path[-1].remove(el)


def _column(ref: str) -> int:
    if ref.startswith("#"):
        return int(ref[1:])
    index = 0
    for ch in ref:
        if not ch.isalpha():
            break
        index = index * 26 + ord(ch.upper()) - 64
    return index


def _parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    yield from _framed(_events(batches), ["workbook", "part", "what", "r", "ref", "type", "style", "text"])


def _events(batches: Iterator[pd.DataFrame]) -> Iterator[tuple]:
    for batch in batches:
        for book, part, method, data, error, before, _ in batch.itertuples(index=False):
            if error is not None:
                yield book, part, "error", 0, None, None, 0, error
                continue
            try:
                for event in _walk(data, int(method), int(before)):
                    yield book, part, *event
            except Exception as problem:
                yield book, part, "error", 0, None, None, 0, f"{type(problem).__name__}: {problem}"[:500]


def scan_workbooks(spark: SparkSession, path: str, recursive: bool = True) -> Workbooks:
    """Every workbook below ``path``; .xls and .xlsb are reported, not read."""
    files = (
        spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower()).load(path)
    )
    return parse_workbooks(files.select("path", "content"))


def parse_workbooks(files: DataFrame) -> Workbooks:
    """``files(path, content)`` → relations. The parsed XML is staged once for all of them.

    With a column ``block``, a file's content is that of its rows in the order of their blocks.
    """
    suffix = F.lower(F.regexp_extract("path", r"\.([^./]+)$", 1))
    readable = files.where(suffix.isin(*SUFFIXES))
    spark = files.sparkSession
    if "block" in files.columns:
        parts = readable.repartition("path").sortWithinPartitions("path", "block").mapInPandas(_unpack_blocks, PART_DDL)
        files = files.select("path").distinct()
    else:
        parts = readable.mapInPandas(_unpack, PART_DDL)
    numbered = parts.withColumn("task", F.spark_partition_id())  # files of one path may come from several tasks
    parts = numbered.repartition("workbook", "part").sortWithinPartitions("workbook", "part", "task", "entry", "slice")
    # a number of its own: the pieces of one workbook are few bytes and much work
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    pieces = parts.mapInPandas(_pieces, PIECE_DDL).repartition(tasks, "workbook", "part", "piece")
    events = stage(pieces.mapInPandas(_parse, EVENT_DDL))
    refused = files.where(~suffix.isin(*SUFFIXES)).select(
        F.col("path").alias("workbook"),
        F.concat(F.lit("unsupported file format ."), suffix, F.lit("; only .xlsx and .xlsm are read")).alias("error"),
    )
    broken = events.where("what = 'error'").select("workbook", F.col("text").alias("error"))
    sheets = stage(_sheets(events))  # few next to the cells, of a size the planner then knows
    return Workbooks(stage(_cells(events, sheets)), _merges(events, sheets), sheets.drop("part"), refused.unionByName(broken))


def _sheets(events: DataFrame) -> DataFrame:
    names = events.where("what = 'sheet'").select("workbook", F.col("r").alias("position"), "ref", F.col("text").alias("sheet"))
    target = F.regexp_replace("text", "^/?(xl/)?", "")
    links = events.where("what = 'link'").select("workbook", "ref", F.concat(F.lit("xl/"), target).alias("part"))
    return names.join(links, ["workbook", "ref"]).select("workbook", "part", "sheet", "position")


def _merges(events: DataFrame, sheets: DataFrame) -> DataFrame:
    def row(n: int) -> Column:
        return F.regexp_extract("ref", r"^([A-Z]+)([0-9]+):([A-Z]+)([0-9]+)$", n)

    from ..functions.text import column_index

    found = events.where("what = 'merge' AND ref LIKE '%:%'").join(sheets, ["workbook", "part"])
    return found.select(
        "workbook",
        "sheet",
        row(2).cast("int").alias("min_r"),
        column_index(row(1)).alias("min_c"),
        row(4).cast("int").alias("max_r"),
        column_index(row(3)).alias("max_c"),
    )


def _date_styles(events: DataFrame) -> DataFrame:
    """``(workbook, style)`` of the cell styles that show dates."""
    styles = events.where("what = 'style'").select("workbook", F.col("r").alias("style"), F.col("style").alias("format"))
    codes = events.where("what = 'format'").groupBy("workbook", F.col("r").alias("format")).agg(F.max("text").alias("code"))
    bare = F.regexp_replace("code", r'"[^"]*"|\\.|\[[^\]]*\]|_.', "")
    shows_date = F.col("format").isin(*DATE_FORMAT_IDS) | F.coalesce(F.lower(bare).rlike("[dmhysDMHYS]"), F.lit(False))
    return styles.join(codes, ["workbook", "format"], "left").where(shows_date).select(
        "workbook", "style", F.lit(True).alias("is_date")
    )


def serial_to_text(serial: Column, epoch_1904: Column) -> Column:
    """Spreadsheet day number → ``yyyy-MM-dd HH:mm:ss``; the 1900 system has a day too many before March 1900."""
    shift = F.when(epoch_1904, F.lit(1462)).when(serial < 60, F.lit(1)).otherwise(F.lit(0))
    seconds = F.round((serial + shift - 25569) * 86400).cast("bigint")
    start = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_add("SECOND", seconds, start).cast("string")


def _cells(events: DataFrame, sheets: DataFrame) -> DataFrame:
    raw = events.where("what = 'cell'").join(sheets.select("workbook", "part", "sheet"), ["workbook", "part"])
    strings = events.where("what = 'string'").select(
        "workbook", F.col("r").cast("string").alias("text"), F.col("text").alias("shared")
    )
    epoch = events.where("what = 'date1904' AND r = 1").select("workbook", F.lit(True).alias("epoch_1904")).distinct()
    # Only references to shared strings take part in that join; one string may be
    # referenced by most cells, which the adaptive skew split handles.
    by_reference = raw.where("type = 's'").join(strings, ["workbook", "text"], "left").select(
        "workbook", "sheet", "r", "ref", "type", "style", F.col("shared").alias("text")
    )
    direct = raw.where("type <> 's'").select("workbook", "sheet", "r", "ref", "type", "style", "text")
    full = (
        by_reference.unionByName(direct)
        .join(stage(_date_styles(events)), ["workbook", "style"], "left")
        .join(stage(epoch), "workbook", "left")
    )
    number = F.col("text").try_cast("double")
    is_date = (F.col("type") == "n") & F.coalesce("is_date", F.lit(False)) & number.isNotNull()
    iso = F.col("text").try_cast("timestamp_ntz").cast("string")
    value = (
        F.when(is_date, serial_to_text(number, F.coalesce("epoch_1904", F.lit(False))))
        .when(F.col("type") == "d", F.coalesce(iso, "text"))
        .when(F.col("type") == "b", F.when(F.col("text") == "1", "True").otherwise("False"))
        .otherwise(F.col("text"))
    )
    kind = (
        F.when(is_date | (F.col("type") == "d"), "date")
        .when(F.col("type") == "b", "bool")
        .when(F.col("type") == "n", "number")
        .otherwise("string")
    )
    return full.select(
        "workbook", "sheet", "r", F.col("ref").cast("int").alias("c"), value.alias("value"), kind.alias("kind")
    ).where(F.col("value").isNotNull())
