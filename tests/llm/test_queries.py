"""The registered queries over whole small tables: against SQL where there is some, else against brute force."""

import hashlib
import re
import zlib
from collections import defaultdict

import duckdb
import numpy as np
import public_tokenizers
import pytest
from compare import compare, duck
from test_idfiles import plain as plain_ids
from test_repair import COLUMNS, plain
from test_search import brute, in_order, whole
from test_simhash import slow_components, slow_fingerprint
from test_urls import parts, rule_of
from tokenizers import Tokenizer

import __spark_entry__ as entry_point

SF = "/root/testdata/sf0.001"
QUERIES, ORACLES = entry_point.queries(), entry_point.oracle_sql()


def rows(table, columns):
    return duckdb.sql(f"SELECT {columns} FROM '{SF}/{table}.parquet'").fetchall()


def run(spark, name):
    return QUERIES[name](spark, SF)


def test_every_operator_has_one_query():
    numbers = [int(m[1]) for n in QUERIES if (m := re.match(r"op(\d+)_", n))]
    assert sorted(numbers) == list(range(1, 14)) and "pipeline" in QUERIES


@pytest.mark.parametrize("name", sorted(n for n in ORACLES if n.startswith("op")))
def test_sql(spark, name):
    assert compare(run(spark, name), duck(SF), ORACLES[name]) is None


def test_op1_against_labels(spark):
    got = {r.doc_id: r for r in run(spark, "op1_weak_label_quality").collect()}
    assert len(got) == len(rows("documents", "doc_id"))
    labelled = rows("labels", "doc_id, quality")
    assert np.mean([got[i].keep == bool(q) for i, q in labelled]) > 0.9
    assert np.mean([got[i].keep for i, q in labelled if q]) > 0.97


def test_op2_against_the_library(spark):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = []
    for doc_id, text in rows("documents", "doc_id, text"):
        ids = tokenizer.encode(text, add_special_tokens=False).ids
        decoded = tokenizer.decode(ids, skip_special_tokens=False)
        want.append((doc_id, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()))
    assert sorted(map(tuple, run(spark, "op2_bpe_tree_concatenation").collect())) == sorted(want)


def test_op3_against_plain_python(spark):
    got = {r.page_id: r for r in run(spark, "op3_path_template_tree").collect()}
    for page_id, url in rows("pages", "page_id, url"):
        host, path = parts(url)
        rule, action = rule_of(host, path)
        r = got.pop(page_id)
        assert (r.host, r.path, r.rule) == (host, path, rule) and (r.verdict == action if rule else r.verdict in ("allow", "block"))
    assert not got


def test_op4_against_the_library(spark):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    ids = {d: np.array([*tokenizer.encode(t, add_special_tokens=False).ids, 2], "<u4") for d, t in rows("documents", "doc_id, text")}
    covered, filled = defaultdict(int), defaultdict(list)
    for r in run(spark, "op4_best_fit_packing").collect():
        piece = ids[r.doc_id][r.start : r.start + r.length]
        assert (len(piece), zlib.crc32(piece.tobytes()), len(ids[r.doc_id])) == (r.length, r.ids_crc32, r.doc_tokens)
        covered[r.doc_id] += r.length
        filled[r.sequence_id].append((r.offset, r.length))
    assert covered == {d: len(x) for d, x in ids.items()}
    for pieces in filled.values():
        ends = np.cumsum([n for _, n in sorted(pieces)])
        assert [o for o, _ in sorted(pieces)] == [0, *ends[:-1]] and ends[-1] <= 4096
    assert len(filled) <= sum(covered.values()) / 4096 * 1.02 + 1


def test_op7_and_op8_against_brute_force(spark):
    vectors = rows("embeddings", "vec_id, embedding")
    near = run(spark, "op7_block_matrix_join").select("query_id", "rank", "vec_id", "score")
    assert sorted(map(tuple, near.collect())) == brute(vectors, 20, 20, in_order, False)
    high = run(spark, "op8_pivot_distance").select("query_id", "rank", "vec_id", "score")
    assert sorted(map(tuple, high.collect())) == brute(vectors, 100, 10, whole, True)


def test_op9_against_brute_force(spark):
    docs = sorted(rows("documents", "doc_id, text"))
    prints = [slow_fingerprint(t) for _, t in docs]
    label = slow_components(prints, 4)
    want = [(d, f"{p:016x}", docs[c][0]) for (d, _), p, c in zip(docs, prints, label)]
    assert sorted(map(tuple, run(spark, "op9_gray_simhash").collect())) == want


def test_op10_held_out_accuracy(spark):
    got = {r.doc_id: r for r in run(spark, "op10_ftrl_language").collect()}
    truth = dict(rows("documents", "doc_id, lang"))
    assert {d: zlib.crc32(str(d).encode()) % 4 == 2 for d in truth} == {d: r.held_out for d, r in got.items()}
    assert np.mean([r.lang_pred == truth[d] for d, r in got.items() if r.held_out]) > 0.95


def test_op11_against_the_library(spark):
    got = run(spark, "op11_mixing_range_coder").select("doc_id", "start", "n_tokens", "ids_crc32").collect()
    assert sorted(map(tuple, got), key=repr) == plain_ids(rows("documents", "doc_id, text"), public_tokenizers.path("word_bpe_49k.json"), 1)


def test_op13_against_plain_python(spark):
    got = run(spark, "op13_run_length_repair").select(*COLUMNS).collect()
    assert sorted(map(tuple, got), key=repr) == plain(rows("conversations", "conv_id, turn, role, text"))


def test_pipeline_keeps_good_documents_once(spark):
    packed = {r.doc_id for r in run(spark, "pipeline").collect()}
    quality = {r.doc_id: r.keep for r in run(spark, "op1_weak_label_quality").collect()}
    groups = defaultdict(set)
    for r in run(spark, "op9_gray_simhash").collect():
        groups[r.component_id].add(r.doc_id)
    for members in groups.values():
        good = {d for d in members if quality[d]}
        assert len(packed & members) <= max(1, len(good)) and (not good or packed & members)
    assert len(packed & {d for d, k in quality.items() if not k}) <= 0.02 * len(quality)
