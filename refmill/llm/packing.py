"""Packing of tokenised documents into windows by best-fit decreasing.

A document longer than a window is first cut into full windows, which fill a sequence
each. What is left of it is placed, longest first, in the tightest open sequence that
still holds it. Tails of one length are interchangeable, so the placing itself needs only
the number of tails of each length, at most one row per length below the window. Spark
tokenises, counts and ranks; the plan says for each run of ranks where it lies.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter, defaultdict, deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import ship_by_value, stage
from .common import MARKS, ChunkCache, column_list, little_endian, load_tokenizer, model_ids, read_table, released, segments, slices, worker_state

ship_by_value(__name__)

#: characters that str.split() takes for white space and vocabularies don't
_SEPARATORS = re.compile("[\x1c-\x1f]")
#: characters with rules of their own for case and composition, and the start of special tokens
_NOT_PLAIN = re.compile(r"[^\x00-\xff]|<\|")
#: what may be one of these, white space beyond ASCII, or both
_WIDE = re.compile(r"[\x85\xa0]|[^\x00-\xff]|<\|")
_WIDE_SPACE = re.compile("[\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
#: words whose groups are one pretoken each and change neither case nor composition
_PLAIN_WORD = re.compile(rf"([a-zà-öø-ÿ]+)?({MARKS}+)?")
_LETTERS = re.compile("[a-zà-öø-ÿ]+")
_MARKS = "".join(re.findall(MARKS, "".join(map(chr, range(128)))))
_TEXT_CHARS = 1 << 18  # characters of texts tokenised together


class OpenSequences:
    """Segment tree over remaining capacities: how many sequences are open at each."""

    def __init__(self, window: int):
        self.size = 1 << window.bit_length()
        self.count = [0] * (2 * self.size)

    def add(self, capacity: int, n: int) -> None:
        at = capacity + self.size
        while at:
            self.count[at] += n
            at //= 2

    def tightest(self, length: int) -> int | None:
        """Smallest capacity of at least ``length`` at which a sequence is open."""
        at = length + self.size
        if self.count[at]:
            return length
        while at > 1:
            if at % 2 == 0 and self.count[at + 1]:
                at += 1
                while at < self.size:
                    at = 2 * at if self.count[2 * at] else 2 * at + 1
                return at - self.size
            at //= 2
        return None


def plan_tails(counts: dict[int, int], window: int) -> tuple[dict[int, np.ndarray], int]:
    """Where best-fit decreasing puts ``counts[length]`` tails of each length.

    Returns for each length an array of ``(first rank, tails per sequence, first sequence,
    offset)``, sorted by rank, and the number of sequences. Equal sequences are handled as
    one run, so the work depends on the window, not on the number of tails.
    """
    tree = OpenSequences(window)
    runs: dict[int, deque] = defaultdict(deque)  # capacity → (first sequence, how many)
    plan: dict[int, np.ndarray] = {}
    opened = 0

    def put_back(capacity: int, first: int, n: int) -> None:
        if capacity and n:
            runs[capacity].append((first, n))
            tree.add(capacity, n)

    for length in sorted(counts, reverse=True):
        left, rank, rows = counts[length], 0, []
        while left:
            capacity = tree.tightest(length)
            if capacity is None:
                capacity = window
                first, n = opened, -(-left // (window // length))
                opened += n
            else:
                first, n = runs[capacity].popleft()
                tree.add(capacity, -n)
            each = capacity // length  # a sequence stays the tightest until nothing more fits
            full = min(n, left // each)
            if full:
                rows.append((rank, each, first, window - capacity))
                put_back(capacity - each * length, first, full)
                rank, left = rank + full * each, left - full * each
            if full < n and left:
                rows.append((rank, each, first + full, window - capacity))
                put_back(capacity - left * length, first + full, 1)
                rank, full, left = rank + left, full + 1, 0
            put_back(capacity, first + full, n - full)
        plan[length] = np.array(rows, np.int64)
    return plan, opened


class Words:
    """Token ids of whole texts for vocabularies that drop white space."""

    def __init__(self, path: str):
        self.tokenizer = load_tokenizer(path)
        self.cache = ChunkCache(self._encode, limit=200_000)
        self.parts = ChunkCache(lambda parts: [little_endian(ids) for ids in model_ids(self.tokenizer, parts, _PLAIN_WORD, any_case=False)])
        self.cache.known[""] = self.parts.known[""] = b""
        # frequent words are kept here, and a cache of rare ones takes the model longer than their ids
        resize = getattr(self.tokenizer.model, "_resize_cache", None)
        if resize:
            resize(0)

    @classmethod
    def of(cls, path: str) -> Words:
        state = worker_state()
        return state.get(("words", path)) or state.setdefault(("words", path), cls(path))

    def _encode(self, words: list[str]) -> list[bytes]:
        """Ids of words. Letters and the marks behind them are one pretoken each, and known where other words have them."""
        bodies = [w.rstrip(_MARKS) for w in words]
        marks = [w[len(b) :] for w, b in zip(words, bodies)]
        heads = list(map(self.parts.known.get, bodies))
        new = list({b for b, ids in zip(bodies, heads) if ids is None and _LETTERS.fullmatch(b)})
        of_letters = dict(zip(new, self.parts.values(new)))
        different = list(set(marks))
        of_marks = dict(zip(different, self.parts.values(different)))
        heads = [of_letters.get(b) if ids is None else ids for b, ids in zip(bodies, heads)]
        rest = [w for w, ids in zip(words, heads) if ids is None]
        other = iter(model_ids(self.tokenizer, rest, _PLAIN_WORD, any_case=False))
        return [little_endian(next(other)) if ids is None else ids + of_marks[m] for ids, m in zip(heads, marks)]

    def ids(self, texts: list[str]) -> list[bytes]:
        """Little-endian 32-bit ids of whole texts. No token crosses white space, so words are encoded one by one."""
        parts = [list(segments(t)) for t in texts]
        if max(map(len, parts), default=0) > 1:  # a long text: one part of it at a time
            return [b"".join(self._ids([p])[0] for p in ps) for ps in parts]
        return self._ids([p for ps in parts for p in ps])

    def _ids(self, texts: list[str]) -> list[bytes]:
        plain = [_plain(t) for t in texts]
        parts = pc.ascii_split_whitespace(pa.array([t or "" for t in plain], pa.large_string()))
        coded = parts.values.dictionary_encode()
        words = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        made = self.cache.values(words)
        sizes = np.fromiter(map(len, made), np.int64, len(made)) // 4
        ids, word = np.frombuffer(b"".join(made), "<u4"), coded.indices.to_numpy()
        size = sizes[word]
        ends = np.append(0, np.cumsum(size))
        data = ids[np.repeat((np.cumsum(sizes) - sizes)[word] - ends[:-1], size) + np.arange(ends[-1])].tobytes()
        bounds = (4 * ends[parts.offsets.to_numpy()]).tolist()
        return [data[a:b] if p is not None else self._joined(_words(t)) for t, p, a, b in zip(texts, plain, bounds, bounds[1:])]

    def _joined(self, words: list[str]) -> bytes:
        return b"".join(map(self.cache.fill([words]).__getitem__, words))


def _plain(text: str) -> str | None:
    """The text with its words as ``_words`` has them, if these lie between ASCII white space."""
    if any(c in text for c in "\x1c\x1d\x1e\x1f"):
        return None
    if text.isascii():
        return text if "<|" in text else text.lower()
    if not _WIDE.search(text):
        return text.lower()
    if _WIDE_SPACE.search(text):
        return None
    return text if _NOT_PLAIN.search(text) else text.lower()


def _words(text: str) -> list[str]:
    """Words of a text, in lower case where any two ways of lowering agree."""
    if _SEPARATORS.search(text):
        return [text]
    return text.split() if _NOT_PLAIN.search(text) else text.lower().split()


def _tokenise(path: str, end_id: int, window: int, digests: bool):
    kind = pa.list_(pa.int64()) if digests else pa.list_(pa.binary())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        words, task = Words.of(path), TaskContext.get().partitionId()
        end = np.array([end_id], "<u4").tobytes()
        seen: Counter = Counter()
        windows = 0
        for batch in released(batches):
            pairs = zip(column_list(batch, "doc_id"), column_list(batch, "text"))
            for part in slices([(d, t or "") for d, t in pairs], lambda p: len(p[1]) + 100, _TEXT_CHARS):
                rows = []
                for (doc_id, _), ids in zip(part, words.ids([t for _, t in part])):
                    ids += end
                    pieces = [ids[i : i + 4 * window] for i in range(0, len(ids), 4 * window)]
                    n = len(ids) // 4
                    tail = n % window
                    rows.append((doc_id, n, tail, seen[tail], windows, [zlib.crc32(p) for p in pieces] if digests else pieces))
                    seen[tail] += 1
                    windows += n // window
                columns = list(zip(*rows))
                arrays = [pa.array(list(c), pa.int64()) for c in columns[:5]] + [pa.array(list(columns[5]), kind)]
                yield pa.RecordBatch.from_arrays(
                    [*arrays, pa.array([task] * len(rows), pa.int32())],
                    ["doc_id", "doc_tokens", "tail", "tail_rank", "window_rank", "pieces", "task"],
                )

    return run


def _place(plan, window: int, sequences: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs = plan.value
        for batch in batches:
            tail, rank, full = (batch.column(batch.schema.get_field_index(c)).to_numpy() for c in ("tail", "rank", "full_rank"))
            sequence, offset = full + sequences, np.zeros(len(tail), np.int64)
            for length in np.unique(tail[tail > 0]):
                at = np.nonzero(tail == length)[0]
                rows = runs[int(length)]
                row = rows[np.searchsorted(rows[:, 0], rank[at], side="right") - 1]
                step = rank[at] - row[:, 0]
                sequence[at] = row[:, 2] + step // row[:, 1]
                offset[at] = row[:, 3] + step % row[:, 1] * length
            names = ["doc_id", "start", "length", "piece", "doc_tokens"]
            columns = [batch.column(batch.schema.get_field_index(c)) for c in names]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(sequence, pa.int64()), pa.array(offset, pa.int64())], [*names, "sequence_id", "offset"]
            )

    return run


def pack_documents(docs: DataFrame, path: str, end_id: int, window: int = 4096, digests: bool = False) -> DataFrame:
    """Pieces of all documents of ``(doc_id, text)`` with their places in sequences.

    Returns ``doc_id, start, length, ids, doc_tokens, sequence_id, offset``; ``ids`` are
    the piece's ids, little-endian 32-bit, with ``digests`` their CRC-32 ``ids_crc32``
    instead. Each document ends with ``end_id``, so a null or empty text is one token;
    repeated rows are packed each. Sequences are gapless and hold at most ``window`` ids.

    The driver sees one count per tail length, fewer than ``window``. The broadcast plan
    has some rows per length; it depends on the window, not on the number of documents.
    """
    spark = docs.sparkSession
    kind = "bigint" if digests else "binary"
    rows = stage(
        docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(
            _tokenise(path, end_id, window, digests),
            "doc_id bigint, doc_tokens bigint, tail bigint, tail_rank bigint, window_rank bigint, "
            f"pieces array<{kind}>, task int",
        )
    )
    per_task = stage(
        rows.groupBy("task", "tail").agg(F.count("*").alias("tails"), F.sum(F.expr(f"doc_tokens div {window}")).alias("windows"))
    )
    counts = {r.tail: r.tails for r in per_task.groupBy("tail").agg(F.sum("tails").alias("tails")).collect()}
    counts.pop(0, None)
    plan, sequences = plan_tails(counts, window)

    earlier = Window.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    by_task = per_task.groupBy("task").agg(F.sum("windows").alias("windows"))
    window_offsets = by_task.select("task", F.coalesce(F.sum("windows").over(earlier), F.lit(0)).alias("window_offset"))
    tail_offsets = per_task.select(
        "task", "tail", F.coalesce(F.sum("tails").over(earlier.partitionBy("tail")), F.lit(0)).alias("tail_offset")
    )
    # offsets grow with the number of tasks, and more in memory than their files say: no broadcast
    ranked = rows.join(tail_offsets.hint("merge"), ["task", "tail"]).join(window_offsets, "task")
    piece = ranked.select("*", F.posexplode("pieces").alias("number", "piece"))
    is_full = (F.col("number") + 1) * window <= F.col("doc_tokens")
    laid = piece.select(
        "doc_id",
        (F.col("number").cast("bigint") * window).alias("start"),
        F.when(is_full, F.lit(window)).otherwise(F.col("tail")).cast("bigint").alias("length"),
        "piece",
        "doc_tokens",
        F.when(is_full, F.lit(0)).otherwise(F.col("tail")).cast("bigint").alias("tail"),
        (F.col("tail_rank") + F.col("tail_offset")).alias("rank"),
        (F.col("window_rank") + F.col("window_offset") + F.col("number")).cast("bigint").alias("full_rank"),
    )
    placed = laid.mapInArrow(
        _place(spark.sparkContext.broadcast(plan), window, sequences),
        f"doc_id bigint, start bigint, length bigint, piece {kind}, doc_tokens bigint, sequence_id bigint, offset bigint",
    )
    return placed.withColumnRenamed("piece", "ids_crc32" if digests else "ids")


def op4_best_fit_packing(spark, sf_dir):
    """All documents in sequences of at most 4096 tokens, an end token after each document."""
    import public_tokenizers

    docs = read_table(spark, sf_dir, "documents")
    return pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=2, digests=True)
