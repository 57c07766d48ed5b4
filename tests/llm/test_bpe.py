"""BPE of whole texts against the library, by the tree and by words."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest

from refmill.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.json")
CODEC = bpe.Codec.of(PATH)
PIECES = ["a", "ab", "é", "漢", " ", "  ", "\n", "'s", "'ll", "'", "12", "!", "?!", ",", ".", "<|endoftext|>", "<|end", "\x1c", "\x0b", "\xa0", "😀", "the", "ing", "==", "\t"]


def library(text):
    return CODEC.tokenizer.encode(text, add_special_tokens=False).ids


def texts(seed, n):
    rnd = random.Random(seed)
    for _ in range(n):
        some = rnd.sample(PIECES, rnd.choice([1, 2, 3, len(PIECES)]))
        yield "".join(rnd.choice(some) for _ in range(rnd.choice([1, 5, 60, 400])))


@pytest.mark.parametrize("size", [8, 50, 300])
def test_tree_equals_encoding_at_once(size):
    for text in texts(size, 150):
        leaves = [CODEC.encode(x) for x in bpe.cut_leaves(text.encode(), size)]
        assert CODEC.tree(leaves).ids.tolist() == library(text)


@pytest.mark.parametrize("text", ["a" * 30_000, "ab" * 20_000, "é" * 9_000, "=-" * 9_000, " " * 9_000, "x " * 9_000, "q7f" * 9_000])
def test_long_unsplit_texts(text):
    assert CODEC.tree([CODEC.encode(x) for x in bpe.cut_leaves(text.encode(), 2048)]).ids.tolist() == library(text)


def test_words_equal_whole_text_and_round_trip():
    for text in texts(7, 400):
        [(ids, decoded)] = CODEC.encode_texts([text])
        assert np.frombuffer(ids, "<u4").tolist() == library(text)
        assert decoded.decode("utf-8", "replace") == CODEC.tokenizer.decode(library(text), skip_special_tokens=False) == text


def test_corpus_with_nulls_repeats_and_long_texts(docs):
    rnd = random.Random(3)
    long = "".join(rnd.choice("abc é") for _ in range(5000))
    rows = [(1, "Hello world's end."), (2, None), (3, ""), (4, long), (4, long), (None, long), (5, "z" * 3000), (5, "other")]
    got = bpe.encode_corpus(docs(rows), PATH, digests=True, leaf_bytes=256).collect()
    want = []
    for doc_id, text in rows:
        ids = library(text or "")
        want.append((doc_id, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()))
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    real = bpe.encode_corpus(docs(rows[:1]), PATH).first()
    assert (np.frombuffer(real.ids, "<u4").tolist(), real.decoded) == (library(rows[0][1]), rows[0][1])


def test_empty_table(docs):
    assert bpe.encode_corpus(docs([]), PATH, digests=True).count() == 0
