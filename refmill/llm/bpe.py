"""Byte-level BPE over a corpus: encode, decode, and exact concatenation of encoded halves.

Short texts are encoded as they are. Long texts are cut into leaves that any task may
encode; the leaves of a text are then concatenated pairwise as a tree. At every join a
window around it is encoded anew and doubled until both sides agree with it:

* on a pretoken boundary, which the scanner reaches from either side, or
* inside one unbroken pretoken, on a whole token. A BPE sequence is the encoding of its
  text if, and only if, every adjacent pair of its tokens is the encoding of the pair's
  text, so two encodings that share a token may be spliced at it.

Either way the result equals encoding the whole text at once. Nulls count as empty text.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ship_by_value
from .common import MARKS, ChunkCache, byte_of_symbol, column_list, little_endian, load_tokenizer, model_ids, read_table, released, slices, worker_state

ship_by_value(__name__)

LEAF_BYTES = 16_384
WINDOW = 64  # first radius around a join, in bytes
_TEXT_CHARS = 1 << 18  # characters of short texts encoded together
UNBROKEN = 512  # radius from which one pretoken over the whole window is spliced inside

#: words as texts are cut for encoding, with their leading white space; any other white space;
#: words of which every group is one pretoken
_WORDS = re.compile(r"[ \t\n\r]*[^ \t\n\r]+|[ \t\n\r]+")
_OTHER_SPACE = re.compile(r"[^\S \t\n\r]")
_PLAIN_WORD = re.compile(rf"(\n?)( ?[A-Za-zÀ-ÖØ-öø-ÿ]+)?( ?{MARKS}+)?")


class Encoded(NamedTuple):
    """A text with its tokens: ids, first byte of each, and whether a pretoken begins there."""

    text: bytes
    ids: np.ndarray
    starts: np.ndarray
    opens: np.ndarray


class Codec:
    """Encoder and decoder of one vocabulary file."""

    def __init__(self, path: str):
        self.tokenizer = load_tokenizer(path)
        symbols = byte_of_symbol()
        self.special = {i: t.content.encode() for i, t in self.tokenizer.get_added_tokens_decoder().items()}
        size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        tokens = [self.tokenizer.id_to_token(i) or "" for i in range(size)]
        self.piece = [self.special.get(i) or bytes(map(symbols.__getitem__, t)) for i, t in enumerate(tokens)]
        self.width = np.array([len(p) for p in self.piece], np.int64)
        self.guard = max([len(s) for s in self.special.values()], default=0) + 8
        self.words = ChunkCache(self._encode_words)

    @classmethod
    def of(cls, path: str) -> Codec:
        state = worker_state()
        return state.get(("codec", path)) or state.setdefault(("codec", path), cls(path))

    def _encode_words(self, words: list[str]) -> list[tuple[bytes, bytes]]:
        coded = model_ids(self.tokenizer, words, _PLAIN_WORD, any_case=True)
        return [(little_endian(ids), self.decode(ids)) for ids in coded]

    def decode(self, ids) -> bytes:
        """Bytes of the tokens, special ones included; not yet checked to be UTF-8."""
        return b"".join(map(self.piece.__getitem__, ids))

    def encode_texts(self, texts: list[str]) -> list[tuple[bytes, bytes]]:
        """Ids as little-endian 32-bit integers, and the decoded bytes, of whole texts.

        Where plain white space follows another character, a pretoken ends whatever
        stands around it, so words with their leading white space are encoded one by one.
        """
        words = [[] if _OTHER_SPACE.search(t) else _WORDS.findall(t) for t in texts]
        known = self.words.fill(words)
        found = []
        for text, parts in zip(texts, words):
            if text and not parts:
                found += self._encode_words([text])
            else:
                pairs = [known[w] for w in parts]
                found.append((b"".join([p[0] for p in pairs]), b"".join([p[1] for p in pairs])))
        return found

    def encode(self, text: bytes) -> Encoded:
        made = self.tokenizer.encode(text.decode(), add_special_tokens=False)
        ids = np.array(made.ids, np.uint32)
        words = np.array([-1 if w is None else w for w in made.word_ids], np.int64)
        opens = np.ones(len(ids), bool)
        opens[1:] = (words[1:] != words[:-1]) | (words[1:] < 0)
        return self.placed(text, ids, opens)

    def placed(self, text: bytes, ids: np.ndarray, opens: np.ndarray) -> Encoded:
        return Encoded(text, ids, np.cumsum(self.width[ids]) - self.width[ids], opens)

    def concatenate(self, left: Encoded, right: Encoded) -> Encoded:
        """The encoding of both texts in one, from the encodings of either."""
        if not left.text or not right.text:
            return left if left.text else right
        text, cut, radius = left.text + right.text, len(left.text), WINDOW
        while True:
            splice = self._agree(text, cut, radius, left, right)
            if splice is not None:
                ids, opens = splice
                return self.placed(text, ids, opens)
            radius *= 2

    def _agree(self, text: bytes, cut: int, radius: int, left: Encoded, right: Encoded):
        """Ids and openings of the whole, or None if this window is too small to tell."""
        whole = cut <= radius and len(text) - cut <= radius
        end = min(len(text), cut + radius)
        while end < len(text) and text[end] & 0xC0 == 0x80:
            end += 1
        last = left.starts <= cut - self.guard
        anchors = left.starts[left.opens & last & (left.starts >= cut - radius)]
        if len(anchors):
            begin = int(anchors[-1])
        elif cut <= radius:
            begin = 0
        else:
            return self._agree_inside(text, cut, radius, end, left, right) if radius >= UNBROKEN else None
        window = self.encode(text[begin:end])
        keep = left.starts < begin
        if end == len(text):
            return np.concatenate([left.ids[keep], window.ids]), np.concatenate([left.opens[keep], window.opens])
        meet = np.intersect1d(window.starts[window.opens] + begin, right.starts[right.opens] + cut)
        meet = meet[(meet >= cut) & (meet <= end - self.guard)]
        if not len(meet):
            if radius >= UNBROKEN and not whole:
                return self._agree_inside(text, cut, radius, end, left, right)
            return None
        middle, tail = window.starts + begin < meet[0], right.starts + cut >= meet[0]
        return (
            np.concatenate([left.ids[keep], window.ids[middle], right.ids[tail]]),
            np.concatenate([left.opens[keep], window.opens[middle], right.opens[tail]]),
        )

    def _agree_inside(self, text: bytes, cut: int, radius: int, end: int, left: Encoded, right: Encoded):
        """Splice at shared tokens where one pretoken covers the whole window on both sides."""
        if left.starts[left.opens][-1] > cut - radius or cut <= radius:
            return None
        opened = right.starts[right.opens]
        if len(opened) > 1 and opened[1] + cut < end:
            return None
        starts = left.starts[left.starts >= cut - radius]
        starts = [int(s) for s in starts[:8] if text[s] & 0xC0 != 0x80 and text[s] not in b" \t\n\r'"]
        if not starts or text[cut] & 0xC0 == 0x80:
            return None
        begin = starts[0]
        window = self.encode(text[begin:end])
        if window.opens.sum() != 1:
            return None
        ends = window.starts + self.width[window.ids] + begin
        at, i, j = np.intersect1d(left.starts, window.starts + begin, return_indices=True)
        same = (left.ids[i] == window.ids[j]) & (ends[j] <= cut)
        after, k, m = np.intersect1d(window.starts + begin, right.starts + cut, return_indices=True)
        also = (window.ids[k] == right.ids[m]) & (after >= cut) & (ends[k] < end)
        if not same.any() or not also.any():
            return None
        from_left, from_right = int(at[same][-1]), int(after[also][0])
        keep, tail = left.starts <= from_left, right.starts + cut >= from_right
        middle = (window.starts + begin > from_left) & (window.starts + begin < from_right)
        closed = right.opens[tail] & (right.starts[tail] > 0)
        return (
            np.concatenate([left.ids[keep], window.ids[middle], right.ids[tail]]),
            np.concatenate([left.opens[keep], np.zeros(middle.sum(), bool), closed]),
        )

    def tree(self, leaves: list[Encoded]) -> Encoded:
        """All leaves in one, joined pairwise level by level."""
        while len(leaves) > 1:
            pairs = [self.concatenate(*leaves[i : i + 2]) for i in range(0, len(leaves) - 1, 2)]
            leaves = pairs + leaves[len(pairs) * 2 :]
        return leaves[0]


def cut_leaves(text: bytes, size: int) -> list[bytes]:
    """Halves of halves of a text, each of ``size`` bytes at most, cut between characters."""
    if len(text) <= max(size, 8):
        return [text]
    middle = len(text) // 2
    while text[middle] & 0xC0 == 0x80:
        middle -= 1
    return cut_leaves(text[:middle], size) + cut_leaves(text[middle:], size)


_ENCODED = "doc_id bigint, ids binary, decoded string"
_DIGESTS = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"


def _result(rows: list[tuple], digests: bool) -> pa.RecordBatch:
    """``(doc_id, ids, decoded bytes)`` as they are or as digests."""
    docs = pa.array([r[0] for r in rows], pa.int64())
    texts = [r[2].decode("utf-8", "replace") for r in rows]
    if not digests:
        return pa.RecordBatch.from_arrays(
            [docs, pa.array([r[1] for r in rows], pa.binary()), pa.array(texts, pa.string())], ["doc_id", "ids", "decoded"]
        )
    arrays = [
        docs,
        pa.array([len(r[1]) // 4 for r in rows], pa.int64()),
        pa.array([hashlib.sha256(r[1]).hexdigest() for r in rows], pa.string()),
        pa.array([hashlib.sha256(t.encode()).hexdigest() for t in texts], pa.string()),
    ]
    return pa.RecordBatch.from_arrays(arrays, ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])


def _encode_short(path: str, digests: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec.of(path)
        for batch in released(batches):
            pairs = zip(column_list(batch, "doc_id"), column_list(batch, "text"))
            for part in slices([(d, t or "") for d, t in pairs], lambda p: len(p[1]) + 100, _TEXT_CHARS):
                coded = codec.encode_texts([t for _, t in part])
                yield _result([(d, *c) for (d, _), c in zip(part, coded)], digests)

    return run


def _cut_long(leaf_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for doc_id, text in zip(column_list(batch, "doc_id"), column_list(batch, "text")):
                raw = text.encode()
                leaves = cut_leaves(raw, leaf_bytes)
                n = len(leaves)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([doc_id] * n, pa.int64()),
                        pa.array([hashlib.sha256(raw).digest()] * n, pa.binary()),
                        pa.array(range(n), pa.int32()),
                        pa.array(leaves, pa.binary()),
                    ],
                    ["doc_id", "text_key", "leaf", "text"],
                )

    return run


def _encode_leaves(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec.of(path)
        for batch in batches:
            made = [codec.encode(t) for t in column_list(batch, "text")]
            ids = pa.array([e.ids.tobytes() for e in made], pa.binary())
            opens = pa.array([np.packbits(e.opens).tobytes() for e in made], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns, ids, opens], [*batch.schema.names, "ids", "opens"])

    return run


def _join_leaves(path: str, digests: bool):
    def run(table: pa.Table) -> pa.Table:
        codec = Codec.of(path)
        first = table.slice(0, 1).to_pylist()[0]
        by_leaf: dict[int, Encoded] = {}
        for leaf, text, ids, opens in zip(*[table[c].to_pylist() for c in ("leaf", "text", "ids", "opens")]):
            ids = np.frombuffer(ids, "<u4")
            by_leaf[leaf] = codec.placed(text, ids, np.unpackbits(np.frombuffer(opens, np.uint8), count=len(ids)).astype(bool))
        whole = codec.tree([by_leaf[i] for i in sorted(by_leaf)])
        row = (first["doc_id"], whole.ids.astype("<u4").tobytes(), codec.decode(whole.ids))
        return pa.Table.from_batches([_result([row], digests)]).append_column("copies", table["copies"].slice(0, 1))

    return run


def encode_corpus(docs: DataFrame, path: str, digests: bool = False, leaf_bytes: int = LEAF_BYTES) -> DataFrame:
    """Encode and decode every text of ``(doc_id, text)``.

    Returns ``doc_id, ids`` (little-endian 32-bit) and ``decoded``; with ``digests`` their
    count and SHA-256 instead. One row per row of input: repeated rows are encoded each,
    a null text as an empty one, a null doc_id like any other. Texts of over twice
    ``leaf_bytes`` go the way of the tree; a text is at most one row, 2 GB.
    """
    schema = _DIGESTS if digests else _ENCODED
    docs = docs.select(F.col("doc_id").cast("bigint"), "text")
    long = F.coalesce(F.octet_length("text"), F.lit(0)) > 2 * leaf_bytes
    short = docs.where(~long).mapInArrow(_encode_short(path, digests), schema)
    leaves = docs.where(long).mapInArrow(_cut_long(leaf_bytes), "doc_id bigint, text_key binary, leaf int, text binary")
    # a row repeated as a whole is encoded once, and counted
    distinct = leaves.groupBy("doc_id", "text_key", "leaf").agg(F.first("text").alias("text"), F.count("*").alias("copies"))
    encoded = distinct.mapInArrow(
        _encode_leaves(path), "doc_id bigint, text_key binary, leaf int, text binary, copies bigint, ids binary, opens binary"
    )
    joined = encoded.groupBy("doc_id", "text_key").applyInArrow(_join_leaves(path, digests), f"{schema}, copies bigint")
    every = joined.select("*", F.explode(F.sequence(F.lit(1), F.col("copies")))).select(*short.columns)
    return short.unionByName(every)


def op2_bpe_tree_concatenation(spark, sf_dir):
    """Token counts and digests of ids and decoded text of all documents."""
    import public_tokenizers

    docs = read_table(spark, sf_dir, "documents")
    return encode_corpus(docs, public_tokenizers.path("byte_bpe_50k.json"), digests=True)
