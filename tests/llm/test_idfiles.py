"""Token-id files: the coder's round trip, damage, and the tables against plain counting."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from refmill.llm import idfiles, mixcoder

rng = np.random.default_rng(1)
STREAMS = {
    "empty": [],
    "one": [7],
    "equal": [3] * 5000,
    "counting": range(3000),
    "random": rng.integers(0, 49408, 9000),
    "two in turn": [1, 2] * 3000,
    "skewed": rng.zipf(1.3, 20000) % 50000,
    "phrases": [x for _ in range(4000) for x in ([5, 9, 2, 70], [8, 8, 1], [5, 9, 4])[rng.integers(3)]],
    "wide": rng.integers(0, mixcoder.MOST_IDS, 3000),
    "top of 16 bits": [65535, 0] * 700 + [65535] * 99,
    "just beyond 16 bits": [65536, 0, 65535] * 700,
    "beyond 17 bits": rng.integers(0, 1 << 18, 5000),
}


@pytest.mark.parametrize("name", STREAMS)
@pytest.mark.parametrize("block", [1, 17, 700, 4096, 60000])
def test_round_trip(name, block):
    ids = np.array(list(STREAMS[name])[: 300 if block == 1 else None], np.uint32)
    most = int(ids.max(initial=0)) + 1
    table, data = mixcoder.pack(ids, most, block)
    assert mixcoder.unpack(table, data, most).tolist() == ids.tolist()
    assert table[:, 0].sum() == len(ids) and 4 * table[:, 1].sum() == len(data)


def test_blocks_stand_alone():
    ids = np.array(STREAMS["phrases"], np.uint32)
    table, data = mixcoder.pack(ids, 100, 1000)
    ends = 4 * np.cumsum(table[:, 1])
    at = np.cumsum(table[:, 0])
    for n in range(len(table)):
        part = data[int(ends[n] - 4 * table[n, 1]) : int(ends[n])]
        assert mixcoder.unpack(table[n : n + 1], part, 100).tolist() == ids[at[n] - table[n, 0] : at[n]].tolist()


def test_contexts_compress():
    bits, entropy = {}, {}
    for name, ids in STREAMS.items():
        if len(ids) > 5000:
            bits[name] = 8 * len(mixcoder.pack(np.array(list(ids), np.uint32), int(max(ids)) + 1)[1]) / len(ids)
            share = np.unique(list(ids), return_counts=True)[1] / len(ids)
            entropy[name] = -(share * np.log2(share)).sum()
    assert bits["two in turn"] < 0.4 * entropy["two in turn"] and bits["phrases"] < 0.7 * entropy["phrases"]
    # noise costs about its raw size, and blocks of 512 ids little more than half again what all counts known would
    assert bits["random"] < 16.6 and bits["skewed"] < 1.6 * entropy["skewed"]


def test_model_learns_epoch_by_epoch(monkeypatch):
    ids, learnt, learn = np.array(STREAMS["skewed"], np.uint32), [], mixcoder.Mixer.learn
    monkeypatch.setattr(mixcoder.Mixer, "learn", lambda model, *taken: learnt.append(1) or learn(model, *taken))
    table, data = mixcoder.pack(ids, 50000)
    assert mixcoder.unpack(table, data, 50000).tolist() == ids.tolist()
    assert 2 < len(learnt) < int(table[:, 0].max()) / 4  # not once a position


@pytest.mark.parametrize("length", [1, 2, 15, 16, 17, 32, 33, 511])
def test_one_block(length):
    for ids in (rng.integers(0, 40, length), np.arange(length) % 3 + 70000):
        table, data = mixcoder.pack(ids.astype(np.uint32), 70003)
        assert len(table) == 1 and mixcoder.unpack(table, data, 70003).tolist() == ids.tolist()


def test_damage_is_found():
    ids = np.array(STREAMS["skewed"], np.uint32)
    whole = idfiles.segment_bytes(3, 1, [4, None, 9], [5, 0, len(ids) - 5], ids) + b"\n"
    (s,) = idfiles.segments_of(whole)
    assert (s.task, s.number, s.doc_ids, s.sizes.tolist()) == (3, 1, [4, None, 9], [5, 0, len(ids) - 5]) and (s.ids == ids).all()
    rnd = random.Random(2)
    for at in [0, 7, 20, 45, 60, *[rnd.randrange(len(whole) - 1) for _ in range(60)]]:
        spoilt = bytearray(whole)
        spoilt[at] ^= 1 << rnd.randrange(8)
        with pytest.raises(ValueError, match="damaged"):
            list(idfiles.segments_of(bytes(spoilt), "f"))
    for cut in (3, 50, len(whole) // 2):
        with pytest.raises(ValueError, match="damaged"):
            list(idfiles.segments_of(whole[:cut], "f"))


def plain(rows, path, end):
    """Ids of rows in order of doc_id."""
    tokenizer = Tokenizer.from_file(path)
    found, start = [], 0
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, end], "<u4")
        found.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return sorted(found, key=repr)


def test_table_round_trip(spark, docs, tmp_path):
    rnd = random.Random(5)
    words = ["river", "Stone", "été", "paper,", "!!", "\n", "x" * 50, "42", "\x1c", "日本"]
    rows = [(i * 3 - 50, " ".join(rnd.choice(words) for _ in range(rnd.randint(0, 300)))) for i in range(150)]
    rows += [(1001, None), (1002, ""), (None, "no id"), (1003, "long " * 200_000)]
    frame = docs(rows)
    frame.write.parquet(f"{tmp_path}/documents.parquet")
    got = idfiles.op11_mixing_range_coder(spark, str(tmp_path)).select("doc_id", "start", "n_tokens", "ids_crc32").collect()
    path = public_tokenizers.path("word_bpe_49k.json")
    assert sorted(map(tuple, got), key=repr) == plain(rows, path, 1)
    small = f"{tmp_path}/small"
    idfiles.write_ids(frame, small, idfiles.word_ids(path, 2), segment_ids=500)
    back = idfiles.read_ids(spark, small).collect()
    assert sorted(((r.doc_id, r.start, r.n_tokens, zlib.crc32(r.ids)) for r in back), key=repr) == plain(rows, path, 2)


def test_repeated_rows_tile_the_corpus(spark, docs, tmp_path):
    rows = [(7, "same words")] * 400 + [(7, "other"), (None, "x"), (None, "x"), (8, None)]
    idfiles.write_ids(docs(rows), f"{tmp_path}/f", idfiles.word_ids(public_tokenizers.path("word_bpe_49k.json"), 1), segment_ids=20)
    got = sorted((r.start, r.n_tokens, r.doc_id) for r in idfiles.read_ids(spark, f"{tmp_path}/f").collect())
    assert len(got) == len(rows) and got[0][0] == 0 and all(a[0] + a[1] == b[0] for a, b in zip(got, got[1:]))
    assert [d for _, _, d in got] == [None, None, *[7] * 401, 8]


def test_empty_table(spark, docs, tmp_path):
    idfiles.write_ids(docs([]), f"{tmp_path}/f", idfiles.word_ids(public_tokenizers.path("word_bpe_49k.json"), 1))
    assert idfiles.read_ids(spark, f"{tmp_path}/f").count() == 0


def test_damaged_file_is_named(spark, docs, tmp_path):
    idfiles.write_ids(docs([(i, f"text {i}") for i in range(50)]).coalesce(1), f"{tmp_path}/f", idfiles.word_ids(public_tokenizers.path("word_bpe_49k.json"), 1))
    file = next(tmp_path.glob("f/part*"))
    content = bytearray(file.read_bytes())
    content[-9] ^= 4
    (tmp_path / "g").mkdir()
    (tmp_path / "g" / "spoilt").write_bytes(content)
    with pytest.raises(Exception, match="damaged block 0: .*spoilt"):
        idfiles.read_ids(spark, f"{tmp_path}/g").count()
