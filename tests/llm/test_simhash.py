"""Fingerprints, links and components against brute force."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest
import xxhash

from refmill.llm import components, simhash


def slow_fingerprint(text):
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall("[^\x20\x09-\x0d]+", text)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_components(prints, differ):
    label = list(range(len(prints)))
    for i in range(len(prints)):
        for j in range(i):
            if bin(prints[i] ^ prints[j]).count("1") <= differ:
                a, b = label[i], label[j]
                label = [min(a, b) if x in (a, b) else x for x in label]
    return label


def near_prints(seed, n, groups=6, random_part=0.4):
    rnd = random.Random(seed)
    centres = [rnd.getrandbits(64) for _ in range(groups)]
    found = set()
    while len(found) < n:
        p = rnd.getrandbits(64) if rnd.random() < random_part else rnd.choice(centres)
        for _ in range(rnd.randint(0, 6)):
            p ^= 1 << rnd.randrange(64)
        found.add(p)
    return sorted(found)


def as_signed(prints):
    return np.array(prints, np.uint64).view(np.int64)


@pytest.mark.parametrize("text", ["", " \t\n", "One", "one TWO three", "a b c d", "É b É x\x1cy c d e " * 50, "x " * 70_000, "\x0b\x0ca\x0db"])
def test_fingerprint(text):
    assert simhash.shingle_fingerprint(text) == slow_fingerprint(text)


def test_parts_of_long_texts_join_exactly(monkeypatch):
    rnd = random.Random(8)
    text = " ".join(rnd.choice(["a", "bb", "CCC", "d\te", "é\n"]) for _ in range(500))
    whole = slow_fingerprint(text)
    parts = simhash._byte_parts
    for size in (1, 7, 100):
        monkeypatch.setattr(simhash, "_byte_parts", lambda raw, size=size: parts(raw, size))
        assert simhash.shingle_fingerprint(text) == whole


def test_gray_rank_puts_neighbours_one_bit_apart():
    ranks = simhash.gray_rank(np.arange(256, dtype=np.uint64))
    ordered = np.argsort(ranks)
    assert all(bin(int(a) ^ int(b)).count("1") == 1 for a, b in zip(ordered, ordered[1:]))


def test_choices_cover_every_way_to_differ():
    for distinct in (10, 10**6, 10**9, 10**12):
        masks = simhash.choices(distinct, 4)
        rnd = random.Random(distinct)
        for _ in range(300):
            flips = sum(1 << b for b in rnd.sample(range(64), 4))
            assert any(not m & flips for m in masks)


@pytest.mark.parametrize("seed", range(6))
def test_index_links_equal_brute_force(seed):
    prints = near_prints(seed, 500)
    codes = np.array(prints, np.uint64)
    codes = codes[np.argsort(simhash.gray_rank(codes))]
    root, other = simhash.links(codes, 4)
    label = np.arange(len(codes))
    label[other] = root
    assert label.tolist() == slow_components([int(c) for c in codes], 4)


@pytest.mark.parametrize("shard_rows", [20, 32_768])
def test_edges_connect_as_brute_force(spark, shard_rows):
    prints = near_prints(11, 400, groups=3, random_part=0.2)
    signed = as_signed(prints).tolist()
    frame = spark.createDataFrame([(p,) for p in signed], "print bigint")
    roots = dict(map(tuple, components.connected_components(simhash.near_edges(frame, 4, shard_rows)).collect()))
    got = [roots.get(p, p) for p in signed]
    want = slow_components(prints, 4)
    assert len(set(zip(got, want))) == len(set(got)) == len(set(want))


@pytest.mark.parametrize("batch_rows", [1, 10, 64])
def test_shards_over_many_batches(monkeypatch, batch_rows):
    monkeypatch.setattr(simhash, "SHARD_ROWS", 30)
    rows = []  # the second shard spans batches after as many rows as are held at least
    for key, n in enumerate((25, 200, 1, 90, 3)):
        codes = np.array(near_prints(key, n, groups=2, random_part=0.2), np.uint64)
        rows += [(0, key, int(c)) for c in codes[np.argsort(simhash.gray_rank(codes))]]
    table = [np.array([r[0] for r in rows], np.int32), np.array([r[1] for r in rows]), as_signed([r[2] for r in rows])]
    whole = pa.RecordBatch.from_arrays([pa.array(c) for c in table], ["choice", "key", "print"])
    batches = [whole.slice(at, batch_rows) for at in range(0, len(rows), batch_rows)]
    edges = [e for b in simhash._link_shards(4)(iter(batches)) for e in zip(b["low"].to_pylist(), b["high"].to_pylist())]
    for key in range(5):
        prints = [c for _, k, c in rows if k == key]
        at = {p: i for i, p in enumerate(as_signed(prints).tolist())}
        label = list(range(len(prints)))
        for low, high in edges:
            if low in at and high in at:
                a, b = label[at[low]], label[at[high]]
                label = [min(a, b) if x in (a, b) else x for x in label]
        want = slow_components(prints, 4)
        assert len(set(zip(label, want))) == len(set(label)) == len(set(want))


def test_components_of_a_chain_and_a_hub(spark):
    edges = [(i, i + 1) for i in range(100)] + [(200, 200 + i) for i in range(1, 300)] + [(600, 601), (600, 601)]
    random.Random(1).shuffle(edges)
    got = dict(map(tuple, components.connected_components(spark.createDataFrame(edges, "low bigint, high bigint")).collect()))
    assert {got[i] for i in range(101)} == {0} and {got[i] for i in range(200, 500)} == {200} and got[601] == got[600] == 600
    assert len(got) == 101 + 300 + 2


def test_documents_with_nulls_repeats_and_copies(docs):
    rnd = random.Random(4)
    base = [rnd.choice(["red", "green", "blue", "black"]) + str(rnd.randrange(50)) for _ in range(600)]
    near = base[:300] + ["changed"] + base[301:]
    rows = [(5, " ".join(base)), (9, " ".join(near)), (9, " ".join(near)), (3, " ".join(reversed(base))), (7, None), (8, ""), (6, " "), (None, " ".join(base)), (2, "word")]
    got = simhash.near_duplicates(docs(rows)).collect()
    prints = [slow_fingerprint(t) for _, t in rows]
    label = slow_components(prints, 4)
    least = {c: min((r[0] for r, x in zip(rows, label) if x == c and r[0] is not None), default=None) for c in label}
    want = [(r[0], f"{p:016x}", least[c]) for r, p, c in zip(rows, prints, label)]
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)


def test_empty_table(docs):
    assert simhash.near_duplicates(docs([])).count() == 0
