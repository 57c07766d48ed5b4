"""SimHash fingerprints, and links between near ones through a Gray-order hierarchical index.

Fingerprints that differ in at most ``d`` of 64 bits agree in at least one way of choosing
``k - d`` of ``k`` bit blocks; for each such choice they are dealt out by the chosen bits, so
every linked pair meets in a shard. In a shard fingerprints stand in Gray order with the chosen bits
first, where neighbours share long bit patterns. Runs of neighbours are leaves; the bits all
of a run agree on are factored out into its node, runs of nodes into upper nodes. Two nodes
are compared on the bits either has factored out. Differences only add up on the way down,
so as soon as they exceed ``d`` the whole pair of groups is dropped.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import ship_by_value, stage
from .common import column_list, read_table, released
from .components import connected_components, forest

ship_by_value(__name__)

BITS = 64
SEED = 42
LEAF = 16  # fingerprints of a leaf, and nodes of an upper node
SHARD_ROWS = 32_768  # fingerprints that one task compares with each other
_SPACE = re.compile(rb"[ \t-\r]")
_PAIRS = 2048  # pairs of nodes compared at a time


def shingle_fingerprint(text: str, words_per_shingle: int = 4) -> int:
    """64 bits, each set if it is set in over half of the shingle hashes; 0 without words."""
    import xxhash

    digest = xxhash.xxh64_intdigest
    k = words_per_shingle
    raw = text.encode().lower()  # bytes: only A-Z and the six ASCII white-space characters count
    total, count, carried, seen = np.zeros(BITS, np.int64), 0, [], 0
    for part in _byte_parts(raw):
        words = part.split()
        seen += len(words)
        words = carried + words
        carried = words[-(k - 1) :] if k > 1 else []
        if len(words) < k:
            continue
        line = b" ".join(words)
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        starts = [0, *(ends[:-k] + 1).tolist()]
        hashes = np.array([digest(line[a:b], SEED) for a, b in zip(starts, ends[k - 1 :].tolist())], "<u8")
        for at in range(0, len(hashes), 65_536):
            bits = np.unpackbits(hashes[at : at + 65_536].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            total += bits.sum(axis=0, dtype=np.int64)
        count += len(hashes)
    if seen < k:
        return digest(b" ".join(carried), SEED) if seen else 0
    return int.from_bytes(np.packbits(2 * total > count, bitorder="little").tobytes(), "little")


def _byte_parts(raw: bytes, size: int = 1 << 22) -> Iterator[bytes]:
    """A text in parts of about ``size`` bytes, cut at white space."""
    at = 0
    while len(raw) - at > size:
        cut = _SPACE.search(raw, at + size)
        if not cut:
            break
        yield raw[at : cut.start()]
        at = cut.start()
    yield raw[at:]


def _fingerprints(words_per_shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in released(batches):
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                prints = [shingle_fingerprint(t or "", words_per_shingle) for t in column_list(part, "text")]
                signed = pa.array(np.array(prints, np.uint64).view(np.int64), pa.int64())
                kept = [n for n in part.schema.names if n != "text"]
                columns = [part.column(part.schema.get_field_index(n)) for n in kept]
                yield pa.RecordBatch.from_arrays([*columns, signed], [*kept, "print"])

    return run


def fingerprints(rows: DataFrame, words_per_shingle: int = 4) -> DataFrame:
    """``text`` of every row replaced by ``print``: 64 bits as a signed long."""
    head = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields if f.name != "text")
    return rows.mapInArrow(_fingerprints(words_per_shingle), f"{head}, print bigint")


# ---- shards


def choices(distinct: int, differ: int) -> list[list[int]]:
    """Bit masks whose bits lead a shard's key, by the number of fingerprints to be dealt.

    Any ``k > differ`` blocks serve; more blocks make longer keys but more copies of each row.
    The count is doubled with every factor that an average shard would otherwise grow beyond 64 rows.
    """
    k = differ + 1
    while k < 2 * differ and distinct > 64 << (BITS * (k - differ) // k):
        k += 1
    edges = [BITS * i // k for i in range(k + 1)]
    blocks = [sum(1 << b for b in range(edges[i], edges[i + 1])) for i in range(k)]
    return [sum(c) for c in combinations(blocks, k - differ)]


def signed(mask: int) -> int:
    return mask - (1 << BITS) if mask >> (BITS - 1) else mask


def lead_with(prints: np.ndarray, mask: int) -> np.ndarray:
    """Bits of the mask moved to the top, the others below, each in order."""
    order = [b for b in range(BITS) if not mask >> b & 1] + [b for b in range(BITS) if mask >> b & 1]
    bits = np.unpackbits(prints.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return np.ascontiguousarray(np.packbits(bits[:, order], axis=1, bitorder="little")).reshape(-1).view("<u8")


def gray_rank(codes: np.ndarray) -> np.ndarray:
    """Position of each code in the reflected Gray sequence."""
    rank = codes.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


class GrayIndex:
    """Hierarchy over fingerprints of one shard in Gray order."""

    def __init__(self, codes: np.ndarray):
        self.codes = codes
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []  # (pattern, mask of the bits all agree on), leaves first
        n = len(codes)
        low, high = codes, codes
        while True:
            at = np.arange(0, n, LEAF)
            low, high = np.bitwise_and.reduceat(low, at), np.bitwise_or.reduceat(high, at)
            self.levels.append((low, ~(low ^ high)))
            n = len(at)
            if n == 1:
                return

    def pairs_below(self, differ: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs of leaves ``a <= b`` that may hold linked fingerprints, in slices."""
        yield from self._descend(len(self.levels) - 1, np.zeros(1, np.int64), np.zeros(1, np.int64), differ)

    def _descend(self, level: int, a: np.ndarray, b: np.ndarray, differ: int):
        pattern, shared = self.levels[level]
        for at in range(0, len(a), _PAIRS):
            x, y = a[at : at + _PAIRS], b[at : at + _PAIRS]
            known = np.bitwise_count((pattern[x] ^ pattern[y]) & shared[x] & shared[y])
            near = known <= differ
            x, y = x[near], y[near]
            if not len(x):
                continue
            if level == 0:
                yield x, y
                continue
            n, step = len(self.levels[level - 1][0]), np.arange(LEAF)
            down_x, down_y = np.broadcast_arrays((x[:, None] * LEAF + step)[:, :, None], (y[:, None] * LEAF + step)[:, None, :])
            down_x, down_y = down_x.ravel(), down_y.ravel()
            real = (down_x < n) & (down_y < n) & (down_x <= down_y)
            yield from self._descend(level - 1, down_x[real], down_y[real], differ)


def links(codes: np.ndarray, differ: int, across: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Edges that connect whatever is linked within ``differ`` bits: each node to its component's first.

    ``codes`` are distinct and in Gray order. With ``across`` (a flag per code) only pairs of
    unequal flags are looked for. Pairs of leaves already in one component are skipped.
    """
    n = len(codes)
    index = GrayIndex(codes)
    leaves = -(-n // LEAF)
    root = np.arange(n)
    for x, y in index.pairs_below(differ):
        for at in range(0, len(x), 2048):
            i, j = _near_in_leaves(codes, x[at : at + 2048], y[at : at + 2048], root, leaves, differ, across)
            if len(i):
                root = _merge(root, i, j)
    other = np.flatnonzero(root != np.arange(n))
    return root[other], other


def _near_in_leaves(codes, x, y, root, leaves, differ, across):
    at = np.arange(0, len(codes), LEAF)
    least, most = np.minimum.reduceat(root, at), np.maximum.reduceat(root, at)
    one = (least[x] == most[x]) & (least[y] == most[y]) & (least[x] == least[y])
    x, y = x[~one], y[~one]
    step = np.arange(LEAF)
    i, j = (x[:, None] * LEAF + step)[:, :, None], (y[:, None] * LEAF + step)[:, None, :]
    i, j = (v.ravel() for v in np.broadcast_arrays(i, j))
    real = (i < len(codes)) & (j < len(codes)) & (i < j)
    i, j = i[real], j[real]
    near = np.bitwise_count(codes[i] ^ codes[j]) <= differ
    if across is not None:
        near &= across[i] != across[j]
    return i[near], j[near]


def _merge(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    root = root.copy()
    while len(a):
        ra, rb = root[a], root[b]
        open_ = ra != rb
        a, b, ra, rb = a[open_], b[open_], ra[open_], rb[open_]
        np.minimum.at(root, np.maximum(ra, rb), np.minimum(ra, rb))
        while not (root[root] == root).all():
            root = root[root]
    return root


# ---- on Spark

_EDGES = "low bigint, high bigint"
_DEALT = "choice int, key bigint, print bigint, rank bigint"


def _edges(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    low, high = np.minimum(a, b), np.maximum(a, b)
    return pa.RecordBatch.from_arrays([pa.array(low, pa.int64()), pa.array(high, pa.int64())], ["low", "high"])


def _deal(masks: list[int]):
    """Each fingerprint once for every choice, with its key and Gray rank (signed, in the same order)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = batch.column(0).to_numpy()
            codes = prints.view(np.uint64)
            for n, mask in enumerate(masks):
                rank = gray_rank(lead_with(codes, mask)) ^ np.uint64(1 << 63)
                arrays = [
                    pa.array(np.full(len(codes), n, np.int32)),
                    pa.array((codes & np.uint64(mask)).view(np.int64), pa.int64()),
                    batch.column(0),
                    pa.array(rank.view(np.int64), pa.int64()),
                ]
                yield pa.RecordBatch.from_arrays(arrays, ["choice", "key", "print", "rank"])

    return run


def _link_shards(differ: int):
    """Edges within the shards of a task, whose rows come sorted by shard and rank."""

    def found(choice, key, prints) -> Iterator[pa.RecordBatch]:
        new = np.ones(len(prints), bool)
        new[1:] = (choice[1:] != choice[:-1]) | (key[1:] != key[:-1])
        starts = np.flatnonzero(new)
        sizes = np.diff(np.append(starts, len(prints)))
        codes = prints.view(np.uint64)
        small = sizes <= 4 * LEAF
        a, b = _compare_near(codes, np.repeat(np.where(small, starts + sizes, starts), sizes), differ)
        for start, size in zip(starts[~small], sizes[~small]):
            i, j = links(codes[start : start + size], differ)
            a, b = np.concatenate([a, i + start]), np.concatenate([b, j + start])
        if len(a):
            yield _edges(*forest(prints[a], prints[b]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = tuple(batch.column(i).to_numpy() for i in range(3))
            cut = 0
            if sum(len(h[0]) for h in held) >= SHARD_ROWS:  # then let go of all but the last shard
                last = (held[-1][0][-1], held[-1][1][-1])
                other = np.flatnonzero((rows[0] != last[0]) | (rows[1] != last[1]))
                cut = int(other[0]) if len(other) else len(rows[0])
                held.append(tuple(c[:cut] for c in rows))
                if len(other):
                    yield from found(*[np.concatenate(c) for c in zip(*held)])
                    held = []
            if cut < len(rows[0]):  # the last key is read from what is held last
                held.append(tuple(c[cut:] for c in rows))
        if held:
            yield from found(*[np.concatenate(c) for c in zip(*held)])

    return run


def _compare_near(codes: np.ndarray, stop: np.ndarray, differ: int) -> tuple[np.ndarray, np.ndarray]:
    """Linked pairs of small shards: every code with the next, the next but one, … up to its ``stop``."""
    a, b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    at, step = np.arange(len(codes)), 1
    while True:
        at = at[at + step < stop[at]]
        if not len(at):
            return np.concatenate(a), np.concatenate(b)
        near = at[np.bitwise_count(codes[at] ^ codes[at + step]) <= differ]
        a.append(near)
        b.append(near + step)
        step += 1


def _link_chunks(differ: int):
    """Edges within a chunk of a large shard, or across two of them."""

    def run(table: pa.Table) -> pa.Table:
        prints, chunk = table["print"].to_numpy(), table["chunk"].to_numpy()
        order = np.argsort(table["rank"].to_numpy(), kind="stable")
        prints, chunk = prints[order], chunk[order]
        one = chunk.min() == chunk.max()
        i, j = links(prints.view(np.uint64), differ, None if one else chunk == chunk.min())
        return pa.Table.from_batches([_edges(*forest(prints[i], prints[j]))])

    return run


def near_edges(distinct: DataFrame, differ: int, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """Edges ``low, high`` that connect all of the distinct ``print`` linked within ``differ`` bits.

    Components are exact; of the links in one, as many are given as connect it. Shards of
    over ``shard_rows`` are cut by Gray rank into chunks, and chunks are compared pairwise
    unless the bits that either shares rule them out.
    """
    masks = choices(distinct.count(), differ)
    dealt = stage(distinct.select("print").mapInArrow(_deal(masks), _DEALT))
    shard = ["choice", "key"]
    large = stage(dealt.groupBy(*shard).count().where(F.col("count") > shard_rows))
    rows = large.agg(F.sum("count")).first()[0] or 0
    plain = dealt.join(large, shard, "left_anti") if rows else dealt
    edges = plain.repartition(*shard).sortWithinPartitions(*shard, "rank").mapInArrow(_link_shards(differ), _EDGES)
    if not rows:
        return edges
    hot = dealt.join(large.select(*shard), shard, "left_semi")
    chunks = stage(hot.repartitionByRange(-(-2 * rows // shard_rows), *shard, "rank").withColumn("chunk", F.spark_partition_id()))
    ends = chunks.groupBy(*shard, "chunk").agg(F.bit_and("print").alias("low"), F.bit_or("print").alias("high"))
    a = ends.select(*shard, F.col("chunk").alias("a"), F.col("low").alias("a_low"), F.col("high").alias("a_high"))
    b = ends.select(*shard, F.col("chunk").alias("b"), F.col("low").alias("b_low"), F.col("high").alias("b_high"))
    apart = F.bit_count(F.expr("(a_low ^ b_low) & ~(a_low ^ a_high) & ~(b_low ^ b_high)"))
    pairs = a.join(b, shard).where((F.col("a") <= F.col("b")) & (apart <= differ)).select(*shard, "a", "b")
    met = chunks.join(pairs, shard).where((F.col("chunk") == F.col("a")) | (F.col("chunk") == F.col("b")))
    return edges.unionByName(met.groupBy(*shard, "a", "b").applyInArrow(_link_chunks(differ), _EDGES))


def print_components(prints: DataFrame, differ: int, shard_rows: int) -> DataFrame:
    """``print, root``: every distinct fingerprint of ``prints`` with one that stands for its component."""
    distinct = stage(prints.select("print").distinct())
    roots = connected_components(near_edges(distinct, differ, shard_rows))
    linked = distinct.join(roots.withColumnRenamed("node", "print"), "print", "left")
    return linked.select("print", F.coalesce("root", "print").alias("root"))


def near_duplicates(docs: DataFrame, differ: int = 4, words_per_shingle: int = 4, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """``doc_id, fingerprint, component_id`` of every row of ``(doc_id, text)``.

    ``component_id`` is the smallest doc_id reachable over links of at most ``differ`` bits;
    it is null only where no row of the component has a doc_id. Null and empty texts have
    fingerprint zero and are linked like any other; repeated rows are linked with each other.
    Equal fingerprints are compared once, whatever the number of rows that share them.
    """
    prints = stage(fingerprints(docs.select(F.col("doc_id").cast("bigint"), "text"), words_per_shingle))
    roots = stage(print_components(prints, differ, shard_rows))
    first = prints.groupBy("print").agg(F.min("doc_id").alias("first_doc"))
    least = roots.join(first, "print").groupBy("root").agg(F.min("first_doc").alias("component_id"))
    named = roots.join(least, "root").select("print", "component_id")
    return prints.join(named, "print").select("doc_id", hexadecimal(F.col("print")).alias("fingerprint"), "component_id")


def first_of_groups(docs: DataFrame, differ: int = 4, words_per_shingle: int = 4, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """The rows of ``docs``, all columns, without near copies: of each component the row of the smallest doc_id stays.

    Of rows repeated under one doc_id one stays. Texts without words are no copies of each other and all stay.
    """
    names = docs.columns
    numbered = stage(docs.select(*names, F.monotonically_increasing_id().alias(_ROW)))
    words = numbered.where(F.col("text").rlike("[^\\x20\\x09-\\x0D]"))
    prints = stage(fingerprints(words.select(F.col("doc_id").cast("bigint"), F.col(_ROW).alias("row_no"), "text"), words_per_shingle))
    order = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "row_no")
    first = stage(prints.groupBy("print").agg(F.min(order).alias("first")))
    roots = print_components(prints, differ, shard_rows)
    kept = roots.join(first, "print").groupBy("root").agg(F.min("first")["row_no"].alias("row_no"))
    dropped = prints.select(F.col("row_no").alias(_ROW)).join(kept.withColumnRenamed("row_no", _ROW), _ROW, "left_anti")
    return numbered.join(dropped, _ROW, "left_anti").select(*names)


_ROW = "row_of_this_table"


def hexadecimal(value: Column) -> Column:
    return F.lower(F.lpad(F.hex(value), 16, "0"))


def op9_gray_simhash(spark, sf_dir):
    """Fingerprint and component of all documents."""
    return near_duplicates(read_table(spark, sf_dir, "documents"))
