"""Helpers the training-text operators share: inputs, worker-side caches, running totals."""

from __future__ import annotations

import pickle
import re
import sys
from array import array
from collections.abc import Callable, Iterator, Sequence
from types import ModuleType

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import ship_by_value, stage

ship_by_value(__name__)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def worker_state() -> dict:
    """What a Python worker keeps between tasks (loaded tokenizers, encoded words)."""
    return sys.modules.setdefault("refmill_worker_state", ModuleType("refmill_worker_state")).__dict__


def shared(spark: SparkSession, value) -> Callable:
    """A function that gives workers the value, with its classes: they need not have this package."""
    sent = spark.sparkContext.broadcast(cloudpickle.dumps(value))
    return lambda: pickle.loads(sent.value)


def remembered(make: Callable) -> Callable:
    """The function with its values kept, for few different arguments. Unlike those of functools it travels to workers by value."""
    known: dict = {}

    def get(*args):
        if args not in known:
            known[args] = make(*args)
        return known[args]

    return get


def load_tokenizer(path: str):
    """The tokenizer of a vocabulary file, loaded once per worker; one thread, no padding, no truncation."""
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    state = worker_state()
    key = ("tokenizer", path)
    if key not in state:
        tokenizer = Tokenizer.from_file(path)
        tokenizer.no_padding()
        tokenizer.no_truncation()
        state[key] = tokenizer
    return state[key]


def byte_of_symbol() -> dict[str, int]:
    """The printable symbol that stands for each byte in a byte-level vocabulary, inverted."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    hidden = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(hidden)}


#: class of ASCII marks that stand for themselves in byte-level vocabularies and begin no contraction or special token
MARKS = r"[!-&(-/:;=-@\[-`{-~]"
_SYMBOLS = {ord(" "): "\u0120", ord("\n"): "\u010a"}


def model_ids(tokenizer, words: list[str], plain: re.Pattern, any_case: bool) -> list[list[int]]:
    """Ids of words. Those that match ``plain`` need no scan for pretokens: every group of it is one.

    Most are ASCII letters, perhaps behind a space; they are told without the pattern.
    ``any_case`` says whether the vocabulary takes capitals as they are.
    """
    if not tokenizer_symbols:
        symbol = {b: s for s, b in byte_of_symbol().items()}
        tokenizer_symbols.update(_SYMBOLS)
        tokenizer_symbols.update({c: "".join(symbol[b] for b in chr(c).encode()) for c in range(0xC0, 0x100)})
    tokenize, found, rest = tokenizer.model.tokenize, [], []
    for n, word in enumerate(words):
        if word.isascii():
            body = word[1:] if word[0] == " " else word
            if body.isalpha() and (any_case or body.islower()):
                found.append([t.id for t in tokenize(word if body is word else "\u0120" + body)])
                continue
        match = plain.fullmatch(word)
        if match:
            parts = [p if p.isascii() and p.isalnum() else p.translate(tokenizer_symbols) for p in match.groups() if p]
            found.append([t.id for p in parts for t in tokenize(p)])
        else:
            found.append(None)
            rest.append(n)
    for n, made in zip(rest, tokenizer.encode_batch_fast([words[n] for n in rest], add_special_tokens=False)):
        found[n] = made.ids
    return found


tokenizer_symbols: dict[int, str] = {}


def little_endian(ids: list[int]) -> bytes:
    """Ids as 32-bit integers."""
    packed = array("I", ids)
    if sys.byteorder == "big":
        packed.byteswap()
    return packed.tobytes()


class ChunkCache:
    """Value of each distinct chunk of text, made in batches; the first ``limit`` chunks are kept.

    ``make`` maps a list of unseen chunks to their values. Corpora repeat their words and
    the frequent ones come early, so most lookups never reach the tokenizer. Chunks over
    ``longest`` characters aren't kept.
    """

    def __init__(self, make: Callable[[list[str]], list], limit: int = 300_000, longest: int = 32):
        self.make, self.limit, self.longest = make, limit, longest
        self.known: dict = {}
        self.passing: list[str] = []

    def fill(self, texts: list[list[str]]) -> dict:
        """Values of all chunks of the given texts; those beyond the limit go at the next call."""
        known = self.known
        for chunk in self.passing:
            del known[chunk]
        unseen = list(set().union(*texts).difference(known))
        keep = [c for c in unseen if len(c) <= self.longest][: max(0, self.limit - len(known))]
        self.passing = list(set(unseen).difference(keep))
        for at in range(0, len(unseen), 10_000):
            some = unseen[at : at + 10_000]
            known.update(zip(some, self.make(some)))
        return known

    def values(self, chunks: list[str]) -> list:
        """Values of chunks that are all different, in their order; of new ones only those that stay are put in."""
        known, make = self.known, self.make
        found = list(map(known.get, chunks))
        unseen = [n for n, value in enumerate(found) if value is None]
        for at in range(0, len(unseen), 10_000):
            some = unseen[at : at + 10_000]
            new = [chunks[n] for n in some]
            made = make(new)
            for n, value in zip(some, made):
                found[n] = value
            room = max(0, self.limit - len(known))
            known.update([(c, v) for c, v in zip(new, made) if len(c) <= self.longest][:room] if room else ())
        return found


_CUT = re.compile(r"(?<=\S)[ \t\n\r]")


def segments(text: str, size: int = 1 << 20) -> Iterator[str]:
    """A text in parts of about ``size`` characters, cut only where plain white space follows another character."""
    at = 0
    while len(text) - at > size:
        cut = _CUT.search(text, at + size)
        if not cut:
            break
        yield text[at : cut.start()]
        at = cut.start()
    yield text[at:]


def column_list(batch: pa.RecordBatch, name: str) -> list:
    return batch.column(batch.schema.get_field_index(name)).to_pylist()


def in_parts(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """The same rows in batches small enough to hold as Python objects, whatever the size of the texts around them."""
    for batch in released(batches):
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def released(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same batches; after each, memory that Arrow keeps for later goes back, as workers outlive their tasks."""
    for batch in batches:
        yield batch
        del batch
        pa.default_memory_pool().release_unused()


def slices(items: list, size_of: Callable, limit: int) -> Iterator[list]:
    """Consecutive items in lists of at most ``limit`` total size (one item may exceed it)."""
    part: list = []
    total = 0
    for item in items:
        size = size_of(item)
        if part and total + size > limit:
            yield part
            part, total = [], 0
        part.append(item)
        total += size
    if part:
        yield part


def running_totals(df: DataFrame, group: Sequence[str], order: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Adds ``<value>_before``: the sum of ``value`` over earlier rows of the group.

    Works for groups of any size: rows are dealt by range of ``(group, order)``, each task
    sums along its own range, and only one total per (group, task) is summed across tasks.
    ``order`` has to tell rows apart well enough to split a large group; rows that are equal
    in it are taken in an arbitrary order that is fixed by staging. Values may not be null.
    """
    columns = list(df.columns)
    before = [f"{v}_before" for v in values]
    keys = [*group, *order]
    sums = ", ".join(f"{b} bigint" for b in before)
    head = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    dealt = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
    local = stage(dealt.mapInArrow(_local_sums(list(group), list(values)), f"{head}, range_no int, {sums}"))
    totals = local.groupBy(*group, "range_no").agg(*[F.sum(v).alias(f"total_{v}") for v in values])
    earlier = Window.partitionBy(*group).orderBy("range_no").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *[F.col(g).alias(f"offset_{g}") for g in group],
        F.col("range_no").alias("offset_range_no"),
        *[F.coalesce(F.sum(f"total_{v}").over(earlier), F.lit(0)).alias(f"offset_of_{v}") for v in values],
    )
    same = F.col("range_no") == F.col("offset_range_no")
    for g in group:
        same = same & F.col(g).eqNullSafe(F.col(f"offset_{g}"))
    return local.join(offsets, same).select(
        *columns, *[(F.col(b) + F.col(f"offset_of_{v}")).alias(b) for v, b in zip(values, before)]
    )


def _local_sums(group: list[str], values: list[str]):
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task = TaskContext.get().partitionId()
        at: tuple | None = None
        sums = [0] * len(values)
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = list(zip(*[column_list(batch, g) for g in group])) if group else [()] * batch.num_rows
            steps = list(zip(*[column_list(batch, v) for v in values]))
            before = []
            for key, step in zip(keys, steps):
                if key != at:
                    at, sums = key, [0] * len(values)
                before.append(tuple(sums))
                sums = [a + b for a, b in zip(sums, step)]
            arrays = [*batch.columns, pa.array([task] * batch.num_rows, pa.int32())]
            arrays += [pa.array(list(c), pa.int64()) for c in zip(*before)]
            names = [*batch.schema.names, "range_no", *[f"{v}_before" for v in values]]
            yield pa.RecordBatch.from_arrays(arrays, names)

    return add
