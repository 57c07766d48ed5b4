"""Packing: tokens as the library's, places gapless, the placing that of plain best-fit decreasing."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest

from refmill.llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")
WORDS = packing.Words.of(PATH)
PIECES = ["a", "Ab", "é", "é", "̈", "漢", " ", "\n", "'s", "'LL", "12", "!", "<|endoftext|>", "<|end", "\x1c", "\x0b", "\x0c", "\x85", "\xa0", " ", "​", "😀", "The", "\t", "Σ", "ΟΔΟΣ", "İ", "ß", "\r"]


def library(text):
    return WORDS.tokenizer.encode(text, add_special_tokens=False).ids


def test_words_equal_whole_text():
    rnd = random.Random(1)
    for _ in range(600):
        text = "".join(rnd.choice(PIECES) for _ in range(rnd.choice([1, 4, 60])))
        assert np.frombuffer(WORDS.ids([text])[0], "<u4").tolist() == library(text)


@pytest.mark.parametrize("seed", range(40))
def test_plan_equals_best_fit_decreasing(seed):
    rnd = random.Random(seed)
    window = rnd.choice([8, 16, 37, 64])
    lengths = [rnd.randint(1, window - 1) for _ in range(rnd.randint(0, 80))]
    free = []
    for n in sorted(lengths, reverse=True):
        fits = [i for i, c in enumerate(free) if c >= n]
        if fits:
            free[min(fits, key=lambda i: free[i])] -= n
        else:
            free.append(window - n)
    plan, sequences = packing.plan_tails(Counter(lengths), window)
    placed = defaultdict(list)
    for n, count in Counter(lengths).items():
        for rank in range(count):
            first, each, sequence, offset = plan[n][np.searchsorted(plan[n][:, 0], rank, side="right") - 1]
            placed[sequence + (rank - first) // each].append((offset + (rank - first) % each * n, n))
    for pieces in placed.values():
        at = 0
        for offset, n in sorted(pieces):
            assert offset == at
            at += n
    assert sorted(window - sum(n for _, n in p) for p in placed.values()) == sorted(free)
    assert sorted(placed) == list(range(sequences))


def test_corpus_with_nulls_repeats_and_long_texts(docs):
    rnd = random.Random(2)
    long = " ".join(rnd.choice(["one", "two", "three"]) for _ in range(100))
    rows = [(1, "Hello World"), (2, None), (3, ""), (4, long), (4, long), (None, "x")] + [(10 + i, "a b c d") for i in range(30)]
    got = packing.pack_documents(docs(rows), PATH, 2, window=16).collect()
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in got:
        assert r.length == len(r.ids) // 4
        by_doc[r.doc_id].append((r.start, r.ids, r.doc_tokens))
        by_sequence[r.sequence_id].append((r.offset, r.length))
    for pieces in by_sequence.values():
        at = 0
        for offset, n in sorted(pieces):
            assert offset == at
            at += n
        assert at <= 16
    want = defaultdict(list)
    for doc_id, text in rows:
        ids = np.array([*library(text or ""), 2], "<u4")
        want[doc_id] += [(i, ids[i : i + 16].tobytes(), len(ids)) for i in range(0, len(ids), 16)]
    assert {k: sorted(v) for k, v in by_doc.items()} == {k: sorted(v) for k, v in want.items()}
    crc = packing.pack_documents(docs(rows[:1]), PATH, 2, digests=True).first()
    assert crc.ids_crc32 == zlib.crc32(np.array([*library(rows[0][1]), 2], "<u4").tobytes())


def test_empty_table(docs):
    assert packing.pack_documents(docs([]), PATH, 2).count() == 0


def test_parts_of_long_texts_join_exactly():
    rnd = random.Random(9)
    text = "".join(rnd.choice(PIECES) for _ in range(20_000))
    parts = list(packing.segments(text, 500))
    assert "".join(parts) == text and len(parts) > 5
    assert np.frombuffer(b"".join(WORDS.ids(parts)), "<u4").tolist() == library(text)


def test_letters_are_encoded_once_whatever_marks_follow(monkeypatch):
    asked, model_ids = [], packing.model_ids
    monkeypatch.setattr(packing, "model_ids", lambda tokenizer, words, *rest, **kind: asked.extend(words) or model_ids(tokenizer, words, *rest, **kind))
    text = "Brightwaterly, brightwaterly. (brightwaterly) brightwaterly;! don't. été! ÉTÉ ...,"
    (ids,) = packing.Words(PATH).ids([text])
    assert np.frombuffer(ids, "<u4").tolist() == WORDS.tokenizer.encode(text, add_special_tokens=False).ids
    assert sum(w.startswith("brightwaterly") for w in asked) == 1 and sum(w.startswith("été") for w in asked) == 1


def test_texts_of_all_kinds_of_space_together():
    texts = ["", " ", " a  b\x0b\x0cc\r\n", "a\x1cb c", "x\xa0y\u2003z", "n\x85m", "Ünder Über", "日本 Tokyo", "<|endoftext|> A <| b", "ﬁx ÅNGSTRÖM\u3000É", "last"]
    expected = [WORDS.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    assert [np.frombuffer(ids, "<u4").tolist() for ids in WORDS.ids(texts)] == expected
    assert [np.frombuffer(ids, "<u4").tolist() for t in texts for ids in WORDS.ids([t])] == expected
