"""Files of token ids: written in order of documents, compressed block by block, read back and verified.

A file is a row of segments, each ended by a line break. A segment stands for itself: what task wrote it and
as which number, its documents with their lengths, a table of its blocks, and the blocks of the
context-mixing coder. Header, tables and every block have checksums. All numbers are little-endian.

    magic "RMIDS2"  task u32  number u32  documents u64  ids u64  most u64 (all ids are below)  blocks u32
    table bytes u32  header CRC-32 u32 | table, deflated: doc_id i64 × documents, null u8 × documents,
    ids i64 × documents, (ids, words, CRC-32) u32 × blocks; its CRC-32 u32 | blocks

Segments are numbered in the order of their documents, so that reading them gives places in the whole corpus
whatever order files are listed in. Spark writes and reads the files, through its own commit and its own file systems.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path, ship_by_value, stage
from .common import column_list, read_table, released, running_totals, slices
from .mixcoder import CorruptBlock, pack, unpack
from .packing import Words

ship_by_value(__name__)

SEGMENT_IDS = 4 << 20  # a segment closes with the document that reaches this; one document is never cut
SEGMENTS_PER_FILE = 4
_TEXT_CHARS = 1 << 21  # characters of texts tokenised together
_MAGIC = b"RMIDS2"
_HEADER = "<6sIIQQQII"

ToIds = Callable[[list[str]], list[bytes]]


class Segment(NamedTuple):
    task: int
    number: int
    doc_ids: list[int | None]
    sizes: np.ndarray
    ids: np.ndarray


def _checksum(data: bytes) -> bytes:
    return struct.pack("<I", zlib.crc32(data))


def segment_bytes(task: int, number: int, doc_ids: list[int | None], sizes: list[int], ids: np.ndarray) -> bytes:
    most = int(ids.max()) + 1 if len(ids) else 1
    blocks, data = pack(ids, most)
    known = np.array([d is None for d in doc_ids], np.uint8)
    table = b"".join([np.array([d or 0 for d in doc_ids], "<i8").tobytes(), known.tobytes(), np.array(sizes, "<i8").tobytes(), blocks.tobytes()])
    table = zlib.compress(table, 1)
    header = struct.pack(_HEADER, _MAGIC, task, number, len(doc_ids), len(ids), most, len(blocks), len(table))
    return b"".join([header, _checksum(header), table, _checksum(table), data])


def segments_of(content: bytes, name: str = "") -> Iterator[Segment]:
    """The segments of a file; ``ValueError`` tells the file and place of damage."""
    at = 0
    while at < len(content):
        place, body = f"{name} at byte {at}", at + struct.calcsize(_HEADER)
        head = content[at:body]
        if content[body : body + 4] != _checksum(head) or head[:6] != _MAGIC:
            raise ValueError(f"damaged segment header: {place}")
        _, task, number, docs, n, most, blocks, size = struct.unpack(_HEADER, head)
        at = body + 4
        packed = content[at : at + size]
        if content[at + size : at + size + 4] != _checksum(packed):
            raise ValueError(f"damaged table: {place}")
        table, at = zlib.decompress(packed), at + size + 4
        known = np.frombuffer(table, np.uint8, docs, 8 * docs)
        doc_ids = [None if null else d for d, null in zip(np.frombuffer(table, "<i8", docs).tolist(), known.tolist())]
        sizes = np.frombuffer(table, "<i8", docs, 9 * docs)
        rows = np.frombuffer(table, "<u4", 3 * blocks, 17 * docs).reshape(blocks, 3)
        length = 4 * int(rows[:, 1].sum())
        try:
            ids = unpack(rows, content[at : at + length], most)
        except CorruptBlock as damage:
            raise ValueError(f"damaged {damage}: {place}") from damage
        if len(ids) != n or int(sizes.sum()) != n:
            raise ValueError(f"lengths don't fit: {place}")
        at += length + 1
        yield Segment(task, number, doc_ids, sizes, ids)


def _segments(to_ids: Callable[[], ToIds], segment_ids: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        make, task = to_ids(), TaskContext.get().partitionId()
        doc_ids, sizes, parts, number, held = [], [], [], 0, 0

        def close() -> pa.RecordBatch:
            nonlocal doc_ids, sizes, parts, number, held
            made = segment_bytes(task, number, doc_ids, sizes, np.frombuffer(b"".join(parts), "<u4"))
            doc_ids, sizes, parts, number, held = [], [], [], number + 1, 0
            return pa.RecordBatch.from_arrays([pa.array([made], pa.binary())], ["segment"])

        for batch in released(batches):
            rows = zip(column_list(batch, "doc_id"), column_list(batch, "text"))
            for some in slices([(d, t or "") for d, t in rows], lambda r: len(r[1]) + 100, _TEXT_CHARS):
                for (doc_id, _), ids in zip(some, make([t for _, t in some])):
                    doc_ids.append(doc_id)
                    sizes.append(len(ids) // 4)
                    parts.append(ids)
                    held += len(ids) // 4
                    if held >= segment_ids:
                        yield close()
        if doc_ids:
            yield close()

    return run


def write_ids(docs: DataFrame, folder: str, to_ids: Callable[[], ToIds], segment_ids: int = SEGMENT_IDS) -> None:
    """Write the ids of ``(doc_id, text)`` in ascending order of doc_id, nulls first, ties by text.

    ``to_ids()`` makes, in a worker, the function from texts to little-endian 32-bit ids. Null texts are empty;
    repeated rows are written each, and are dealt apart if they are many. A task writes files of its own; a document is held whole.
    """
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    order = ["doc_id", "text_hash", "salt"]
    keyed = rows.withColumns({"text_hash": F.xxhash64("text"), "salt": F.monotonically_increasing_id()})
    dealt = keyed.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")
    made = dealt.mapInArrow(_segments(to_ids, segment_ids), "segment binary")
    # as text, bytes are written as they are, each value followed by a line break
    made.select(F.col("segment").cast("string")).write.option("maxRecordsPerFile", SEGMENTS_PER_FILE).text(folder)


def _documents(digests: bool):
    kind = pa.schema([("task", pa.int32()), ("segment", pa.int32()), ("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()),
                      ("ids", pa.int64() if digests else pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in released(batches):
            for path, content in zip(batch.column(batch.schema.get_field_index("path")), batch.column(batch.schema.get_field_index("content"))):
                for s in segments_of(content.as_py(), path.as_py()):
                    data = memoryview(s.ids.astype("<u4").tobytes())
                    ends = np.cumsum(s.sizes)
                    starts, n = ends - s.sizes, len(s.sizes)
                    parts = [data[4 * a : 4 * b] for a, b in zip(starts.tolist(), ends.tolist())]
                    found = [zlib.crc32(p) for p in parts] if digests else [bytes(p) for p in parts]
                    columns = [[s.task] * n, [s.number] * n, s.doc_ids, starts, s.sizes, found]
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, kind)], schema=kind)

    return run


def read_ids(spark: SparkSession, folder: str, digests: bool = False) -> DataFrame:
    """``doc_id, start, n_tokens, ids`` of all documents in the files of a folder.

    ``start`` counts the ids of all documents before; ``ids`` are little-endian 32-bit, with ``digests`` their CRC-32
    instead. Damage of any kind is an error that names file and place. Files are decoded once; only
    one total per segment is summed to find its place.
    """
    files = spark.read.format("binaryFile").load(folder).select("path", "content")
    kind = f"task int, segment int, doc_id bigint, start bigint, n_tokens bigint, ids {'bigint' if digests else 'binary'}"
    found = stage(files.mapInArrow(_documents(digests), kind))
    totals = found.groupBy("task", "segment").agg(F.sum("n_tokens").alias("total"))
    places = running_totals(totals, [], ["task", "segment"], ["total"]).select("task", "segment", "total_before")
    return found.join(places, ["task", "segment"]).select("doc_id", (F.col("start") + F.col("total_before")).alias("start"), "n_tokens", "ids")


def word_ids(path: str, end_id: int) -> Callable[[], ToIds]:
    """Ids of texts by a vocabulary that drops white space, an end id after each text."""

    def make() -> ToIds:
        words, end = Words.of(path), np.array([end_id], "<u4").tobytes()
        return lambda texts: [ids + end for ids in words.ids(texts)]

    return make


def op11_mixing_range_coder(spark, sf_dir):
    """Ids of all documents, written to files in order of doc_id and read back."""
    import public_tokenizers

    folder = scratch_path(spark, "ids")
    write_ids(read_table(spark, sf_dir, "documents"), folder, word_ids(public_tokenizers.path("word_bpe_49k.json"), 1))
    return read_ids(spark, folder, digests=True).withColumnRenamed("ids", "ids_crc32")
