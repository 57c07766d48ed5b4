"""Fixity audit against comparing every record."""

import hashlib
import random

import pytest

from refmill.llm import warc

SCHEMA = "file string, offset bigint, record_id bigint, length bigint, sha256 string, node bigint, hash string"


def table(spark, rows):
    return spark.createDataFrame([(*r, 7, "h") for r in rows], SCHEMA)


def replica(seed, files=3, records=200, big=40_000):
    rnd, rows, n = random.Random(seed), [], 0
    for f in range(files):
        at = 0
        for _ in range(records * (1 + 3 * f)):
            length = rnd.randint(100, big)
            rows.append((f"f{f}", at, n, length, hashlib.sha256(str((seed, n)).encode()).hexdigest()))
            at += length
            n += 1
    return rows


def damage(rows, seed, share):
    rnd, out = random.Random(seed), []
    for r in rows:
        x = rnd.random()
        if x < share:
            out.append((*r[:4], "bad"))
        elif x >= 2 * share:
            out.append(r)
        if 2 * share <= x < 2.5 * share:
            out.append((r[0], r[1] + 1, 10**6 + r[2], 5, "stray"))
    return out


def brute(mine, other):
    a, b = ({r[:3]: r for r in x} for x in (mine, other))
    out = []
    for key in a.keys() | b.keys():
        left, right = a.get(key), b.get(key)
        if left and right and left[4] == right[4]:
            continue
        status = "missing" if not right else "extra" if not left else "changed"
        out.append((*key, (left or right)[3], status, left and left[4], right and right[4]))
    return sorted(out)


@pytest.mark.parametrize("share", [0.0, 0.003, 0.3])
def test_audit_equals_comparing_all(spark, share):
    mine = replica(1)
    other = damage(mine, 2, share)
    got = warc.audit(table(spark, mine), table(spark, other)).collect()
    assert sorted(map(tuple, got)) == brute(mine, other)


def test_replicas_of_different_size(spark):
    mine = replica(1)
    for other in ([r for r in mine if r[0] == "f0" and r[1] < 60_000], [r for r in mine if r[0] != "f1"], mine + [("f9", 0, 1, 5, "x")], []):
        assert sorted(map(tuple, warc.audit(table(spark, mine), table(spark, other)).collect())) == brute(mine, other)
        assert sorted(map(tuple, warc.audit(table(spark, other), table(spark, mine)).collect())) == brute(other, mine)


def test_only_differing_branches_are_read(spark):
    mine = replica(1)
    a, b = warc.hash_tree(table(spark, mine)), warc.hash_tree(table(spark, mine[:-1] + [(*mine[-1][:4], "bad")]))
    assert len(a) == len(b) >= 3
    assert [warc._differing(x, y).count() for x, y in zip(a, b)] == [1] * len(a)


def test_offsets_are_running_totals_of_lengths(spark):
    rows = [("a", i, 10 + i % 3, f"{i:03d}") for i in range(200)] + [("b", 1, 5, "x"), ("b", 1, 5, "x"), (None, 1, 4, "y")]
    frame = spark.createDataFrame(rows, "file string, record_id bigint, length bigint, sha256 string")
    got = sorted(map(tuple, warc.lay_out(frame).select("file", "record_id", "offset").collect()), key=repr)
    want, at = [], {}
    for f, i, length, _ in rows:
        want.append((f, i, at.get(f, 0)))
        at[f] = at.get(f, 0) + length
    assert got == sorted(want, key=repr)


def test_empty_replicas(spark):
    assert warc.audit(table(spark, []), table(spark, [])).count() == 0


def test_query_on_odd_pages(spark, tmp_path):
    """Pages without an id are in no replica; null texts, repeated ids and rows are records like others."""
    rows = [(i, f"http://x/{i}", f"<p>{i}</p>") for i in range(1, 160)] + [(None, "http://x", "y"), (53, None, None), (106, "u", ""), (106, "u", ""), (54, "v", None)]
    spark.createDataFrame([(*r, "z") for r in rows], "page_id bigint, url string, html string, sha256 string").write.parquet(f"{tmp_path}/pages.parquet")
    got = [(r.page_id, r.status) for r in warc.op5_merkle_fixity(spark, str(tmp_path)).collect()]
    want = [(i, "changed") for i in (53, 53, 106, 106, 106, 159)] + [(i, "missing") for i in (1, 54, 54, 107)]
    assert sorted(got) == sorted(want)
