"""One large CSV file or JSON document read by many tasks, though records hold line breaks and documents nest.

Spark's text reader deals a file by byte ranges, so a range may begin within a quoted value or deep in a document.
Its pieces are gathered to chunks of bounded size, and each is summed up for every state in which it
might begin: whether it ends in quotes, how deep. One row per chunk is then followed along
each file, which tells the state every chunk really begins in. With that, chunks are cut into records
independently of each other; only records that cross chunks are put together from their parts.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path, ship_by_value, stage

ship_by_value(__name__)

CHUNK_BYTES = 4 << 20  # a longer piece (a line, or what lies between two closing braces) makes a chunk of its own
SPLIT_FROM = 64 << 20  # bytes of a drop from which its files are split

_KEY = ["file", "block", "chunk"]
#: how records that cross chunks are named: the chunk they begin in
_OPEN = ["open_block", "open_chunk"]


def _summaries(spark: SparkSession, path: str) -> list:
    pattern = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = pattern.getFileSystem(spark._jsc.hadoopConfiguration())
    return [system.getContentSummary(s.getPath()) for s in system.globStatus(pattern) or []]


def drop_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of all files a path or pattern names, asked of its file system."""
    return sum(s.getLength() for s in _summaries(spark, path))


def drop_files(spark: SparkSession, path: str) -> int:
    """Number of those files, hidden ones too."""
    return sum(s.getFileCount() for s in _summaries(spark, path))


def _gather(separator: str, ending: str, size: int, measure: Callable[[str], tuple]):
    """Consecutive pieces of a range joined to chunks that end in ``ending``, with what ``measure`` says of each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, chunk, held, bytes_ = None, 0, [], 0

        def close() -> pa.RecordBatch:
            nonlocal chunk, held, bytes_
            text = separator.join(held) + ending
            made = [[at[0]], [at[1]], [chunk], [text], *[[m] for m in measure(text)]]
            chunk, held, bytes_ = chunk + 1, [], 0
            kinds = [pa.string(), pa.int64(), pa.int32(), pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.int32()]
            names = [*_KEY, "text", "after_out", "after_in", "low_out", "low_in"]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(made, kinds)], names)

        for batch in batches:
            if not batch.num_rows:
                continue
            files, blocks, values = (batch.column(i) for i in range(3))
            # stretches of one range, and in them as many pieces as make a chunk
            ends = [*_changes(files, blocks), batch.num_rows]
            start = 0
            for end in ends:
                here = (files[start].as_py(), blocks[start].as_py())
                if at is not None and here != at:
                    if held:
                        yield close()
                    chunk = 0
                at = here
                sizes = pc.binary_length(values.slice(start, end - start)).to_numpy(zero_copy_only=False)
                for value, n in zip(values.slice(start, end - start).to_pylist(), sizes.tolist()):
                    held.append(value)
                    bytes_ += n + 1
                    if bytes_ >= size:
                        yield close()
                start = end
        if held:
            yield close()

    return run


def _changes(files: pa.Array, blocks: pa.Array) -> list[int]:
    """Rows at which another range begins."""
    if len(files) < 2:
        return []
    other = pc.or_(pc.not_equal(files.slice(1), files.slice(0, len(files) - 1)), pc.not_equal(blocks.slice(1), blocks.slice(0, len(blocks) - 1)))
    return [i + 1 for i, differs in enumerate(other.to_pylist()) if differs]


def _chunks(spark: SparkSession, path: str | list[str], separator: str, ending: str, size: int, measure: Callable[[str], tuple]) -> DataFrame:
    """``file, block, chunk, text`` and the sums of ``measure`` over a drop, staged."""
    lines = spark.read.option("lineSep", separator).text(path)
    pieces = lines.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value")
    kind = "file string, block bigint, chunk int, text string, after_out int, after_in int, low_out int, low_in int"
    return stage(pieces.mapInArrow(_gather(separator, ending, size, measure), kind))


def _followed(chunks: DataFrame, follow: Callable[[list[dict]], Iterator[tuple]], *head: str) -> DataFrame:
    """The state in which each chunk begins, by going along the chunks of each file: one short row each."""
    entry = F.struct("block", "chunk", "after_out", "after_in", "low_out", "low_in", *head)
    files = chunks.groupBy("file").agg(F.array_sort(F.collect_list(entry)).alias("entries"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.string(), pa.int64(), pa.int32(), pa.bool_(), pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.bool_()]
        names = [*_KEY, "inside", "depth", "base", *_OPEN, "crosses"]
        for batch in batches:
            for file, entries in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                rows = [(file, *r) for r in follow(entries)]
                yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows), kinds)], names)

    kind = "file string, block bigint, chunk int, inside boolean, depth int, base int, open_block bigint, open_chunk int, crosses boolean"
    return files.mapInArrow(run, kind)


def _records(cut: Callable, whole: bool):
    """Whole records of chunks, or the parts of records that cross them, with the chunk the record begins in."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                r = {n: c[i].as_py() for n, c in zip(batch.schema.names, batch.columns)}
                head, records, tail = cut(r["text"], r["inside"], r["depth"], r["base"])
                filled = [n for n, x in enumerate(records) if x.strip("\r\ufeff")]
                begins = r["block"] == 0 and r["chunk"] == 0
                if whole:
                    first = [begins and filled[:1] == [n] for n in range(len(records))]
                    files = pa.array([r["file"]] * len(records), pa.string())
                    yield pa.RecordBatch.from_arrays([files, pa.array(records, pa.string()), pa.array(first, pa.bool_())], ["file", "value", "first"])
                    continue
                parts = []
                if head is not None:
                    parts.append((r["open_block"], r["open_chunk"], head, False))
                if tail is not None:
                    parts.append((r["block"], r["chunk"], tail, begins and not filled))
                rows = [(r["file"], b, c, r["block"], r["chunk"], n, t, f) for n, (b, c, t, f) in enumerate(parts)]
                if rows:
                    kinds = [pa.string(), pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.string(), pa.bool_()]
                    names = ["file", *_OPEN, "block", "chunk", "part", "text", "first"]
                    yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows), kinds)], names)

    return run


def _read_records(chunks: DataFrame, states: DataFrame, cut: Callable, joint: str) -> DataFrame:
    """``file, value, first`` of all records; ``first`` marks the first of a file."""
    placed = chunks.select(*_KEY, "text").join(states, _KEY)
    whole = placed.mapInArrow(_records(cut, True), "file string, value string, first boolean")
    parts = placed.where("crosses").mapInArrow(
        _records(cut, False), "file string, open_block bigint, open_chunk int, block bigint, chunk int, part int, text string, first boolean"
    )
    # at most two parts a chunk, put together by the record they are of
    ordered = F.array_sort(F.collect_list(F.struct("block", "chunk", "part", "text")))
    joined = parts.groupBy("file", *_OPEN).agg(F.array_join(ordered["text"], joint).alias("value"), F.max("first").alias("first"))
    return whole.unionByName(joined.select("file", "value", "first"))


# --------------------------------------------------------------------------- CSV
_OPENING = re.compile('[,\n]"')
_CLOSING = re.compile('(?:[^"]|"")*+"')


def quoted_stretches(text: str, inside: bool) -> Iterator[tuple[int, int | None]]:
    """Where quoted values begin and end; the last end is None if it lies beyond the text.

    A value is quoted only if it begins with a quote; what follows its closing quote up to the next comma belongs to it.
    """
    at, start = 0, 0 if inside or text.startswith('"') else None
    while True:
        if start is None:
            found = _OPENING.search(text, at)
            if not found:
                return
            start = found.start() + 1
        closed = _CLOSING.match(text, 0 if inside and not start else start + 1)
        if not closed:
            yield start, None
            return
        yield start, closed.end()
        at, start, inside = closed.end(), None, False


def _csv_measure(text: str) -> tuple[int, int, int, int]:
    """Whether a chunk ends in quotes, if it begins outside or inside; 2 if it lies in quotes throughout."""
    if '"' not in text:
        return 0, 2, 0, 0
    ends = []
    for inside in (False, True):
        last = None
        for last in quoted_stretches(text, inside):
            pass
        is_open = last is not None and last[1] is None
        ends.append(0 if not is_open else 2 if inside and _csv_cut(text, True)[2] is None else 1)
    return ends[0], ends[1], 0, 0


def _csv_cut(text: str, inside: bool, depth: int = 0, base: int = 0) -> tuple[str | None, list[str], str | None]:
    """The rest of a record begun before, whole records, and the beginning of one that goes on; lines are already parted from the next chunk."""
    if base:
        text = text.replace("\r\n", "\n").removesuffix("\r")
    if '"' not in text:
        return (text, [], None) if inside else (None, text.split("\n"), None)
    cuts, at, open_ = [], 0, False
    for start, end in quoted_stretches(text, inside):
        cuts += _breaks(text, at, start)
        if end is None:
            open_ = True
            at = len(text)
            break
        at = end
    cuts += _breaks(text, at, len(text))
    edges = [-1, *cuts, len(text)]
    records = [text[a + 1 : b] for a, b in zip(edges, edges[1:])]
    if inside and open_ and not cuts:
        return text, [], None
    head = records.pop(0) if inside else None
    tail = records.pop() if open_ else None
    return head, records, tail


def _breaks(text: str, start: int, end: int) -> list[int]:
    found, at = [], text.find("\n", start, end)
    while at >= 0:
        found.append(at)
        at = text.find("\n", at + 1, end)
    return found


def _csv_follow(entries: list[dict]) -> Iterator[tuple]:
    inside, opened, base = False, (0, 0), int(entries[0]["lead"])  # base: line breaks are two characters in this file
    for e in entries:
        after = e["after_in"] if inside else e["after_out"]
        yield e["block"], e["chunk"], inside, 0, base, *opened, inside or after > 0
        if after and (not inside or after == 1):
            opened = (e["block"], e["chunk"])
        inside = after > 0


def csv_records(spark: SparkSession, path: str | list[str], chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """``file, value, first``: every record of the files as it is written, blank ones too; ``first`` marks each file's header."""
    chunks = _chunks(spark, path, "\n", "", chunk_bytes, _csv_measure)
    lead = F.col("text").rlike(r"^[^\r\n]*\r(\n|$)").cast("int")
    states = _followed(chunks.withColumn("lead", lead), _csv_follow, "lead")
    return _read_records(chunks, states, _csv_cut, "\n")


def csv_fields(value, names: list[str], null_value: str = ""):
    """A record's fields under the given names, all text."""
    columns = ", ".join(f"`{c.replace('`', '``')}` string" for c in names)
    return F.from_csv(value, columns, {"escape": '"', "multiLine": "true", "nullValue": null_value})


def read_csv_ranges(spark: SparkSession, path: str, schema: list[str], null_value: str = "", chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Text columns of the given names from files with a header each; lines of a file end as its first one does, in ``\\n`` or ``\\r\\n``.

    Quoted values may hold commas, doubled quotes and line breaks. Equal to Spark's own reader of whole files, to which
    the line break of a file is ``\\n`` in values too.
    """
    kept = csv_records(spark, path, chunk_bytes).where(~F.col("first") & (F.col("value") != ""))
    return kept.select(csv_fields("value", schema, null_value).alias("r")).select("r.*")


# --------------------------------------------------------------------------- JSON
_TOKEN = re.compile(r'"(?:[^"\\]++|\\.)*+(?:"|\Z)|[{}\[\]]', re.S)
_STRING_END = re.compile(r'(?:[^"\\]++|\\.)*+"', re.S)


def _tokens(text: str, inside: bool) -> Iterator[tuple[str, int]]:
    """Brackets outside strings with their places; last ``"`` if the text ends within a string."""
    at = 0
    if inside:
        closed = _STRING_END.match(text)
        if not closed:
            yield '"', len(text)
            return
        at = closed.end()
    for found in _TOKEN.finditer(text, at):
        token = found[0]
        if token[0] != '"':
            yield token, found.start()
        elif len(token) == 1 or not _STRING_END.match(token, 1):
            yield '"', len(text)


def _json_measure(text: str) -> tuple[int, int, int, int]:
    """For beginnings outside and inside a string: change of depth, doubled, plus one if it ends within a string; and the lowest depth on the way."""
    found = []
    for inside in (False, True):
        depth = low = ends = 0
        for token, _ in _tokens(text, inside):
            if token == '"':
                ends = 1
            else:
                depth += 1 if token in "{[" else -1
                low = min(low, depth)
        found.append((2 * depth + ends, low))
    return found[0][0], found[1][0], found[0][1], found[1][1]


def _json_cut(text: str, inside: bool, depth: int, base: int) -> tuple[str | None, list[str], str | None]:
    """Rest of an object begun before, whole objects at ``base`` depth, and the beginning of one that goes on."""
    going = depth > base
    head, records, start = None, [], 0 if going else None
    for token, at in _tokens(text, inside):
        if token == '"':
            break
        if token in "{[":
            if token == "{" and depth == base and start is None:
                start = at
            depth += 1
        elif depth:
            depth -= 1
            if token == "}" and depth == base and start is not None:
                if going:
                    head, going = text[: at + 1], False
                else:
                    records.append(text[start : at + 1])
                start = None
    if going:
        return text, [], None
    return head, records, None if start is None else text[start:]


def _json_follow(entries: list[dict]) -> Iterator[tuple]:
    base = 1 if entries[0]["lead"] == "[" else 0
    inside, depth, opened = False, 0, (0, 0)
    for e in entries:
        change, low = (e["after_in"], e["low_in"]) if inside else (e["after_out"], e["low_out"])
        after = max(0, depth + (change >> 1))
        yield e["block"], e["chunk"], inside, depth, base, *opened, depth > base or after > base
        if after > base and (depth <= base or depth + low <= base):
            opened = (e["block"], e["chunk"])
        inside, depth = bool(change & 1), after


def read_json_ranges(spark: SparkSession, path: str, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Objects of files that are an object or an array of objects each, every primitive as text.

    They are written one to a line first, so that Spark's own reader of lines finds their fields and reads them in parallel.
    A document that is cut off is read up to its last closing brace.
    """
    chunks = _chunks(spark, path, "}", "}", chunk_bytes, _json_measure)
    lead = F.substring(F.regexp_replace(F.substring("text", 1, 100), r"^[\s\ufeff]+", ""), 1, 1)
    states = _followed(chunks.withColumn("lead", lead), _json_follow, "lead")
    objects = _read_records(chunks, states, _json_cut, "")
    lines = scratch_path(spark, "objects")
    objects.select(F.regexp_replace("value", "[\r\n]", " ")).write.text(lines)
    return spark.read.option("primitivesAsString", True).json(lines)
