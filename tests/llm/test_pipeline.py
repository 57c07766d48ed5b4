"""The stages of the corpus pipeline, alone and together, against brute force."""

import random

import public_tokenizers
from test_simhash import slow_components, slow_fingerprint

import corpus_pipeline
from refmill.llm import packing, simhash


def texts(seed, n):
    rnd = random.Random(seed)
    words = ["the", "of", "and", "river", "stone", "paper", "green", "window", "small", "house", "they", "were"]
    return [" ".join(rnd.choice(words) + rnd.choice(["", "", ".", ","]) for _ in range(rnd.randint(30, 120))) for _ in range(n)]


def table(docs):
    plain = texts(1, 60)
    rows = [(i, t, "en") for i, t in enumerate(plain)]
    rows += [(100 + i, plain[i], "en") for i in range(10)] + [(5, plain[5], "en")]
    rows += [(200 + i, t.upper().replace(" ", "!! "), "en") for i, t in enumerate(texts(2, 15))]
    return rows + [(300, None, "en"), (301, "", None), (302, "12 34", "en"), (None, plain[7], "en")]


def test_one_of_each_group_stays(docs):
    rows = table(docs)
    frame = docs(rows)
    kept = simhash.first_of_groups(frame)
    assert kept.columns == frame.columns
    prints = [slow_fingerprint(t) for _, t, _ in rows]
    label = slow_components(prints, 4)
    want = []
    for component in set(label):
        group = [r for r, x in zip(rows, label) if x == component]
        named = sorted(r[0] for r in group if r[0] is not None)
        want += [named[0] if named else None]
    wordless = [i for i, t, _ in rows if not (t or "").split()]
    want = [w for w in want if w not in wordless] + wordless
    assert sorted((r.doc_id for r in kept.collect()), key=repr) == sorted(want, key=repr)


def test_stages_follow_each_other(spark, docs, monkeypatch, tmp_path):
    rows = table(docs)
    docs(rows).write.parquet(f"{tmp_path}/documents.parquet")
    frame, seen = spark.read.parquet(f"{tmp_path}/documents.parquet"), []
    for name, step in corpus_pipeline.STAGES[:-1]:
        frame = step(spark, frame, str(tmp_path))
        frame.write.parquet(f"{tmp_path}/{name}")
        frame = spark.read.parquet(f"{tmp_path}/{name}")
        seen.append({r.doc_id for r in frame.collect()})
    assert not seen[0] & {300, 301, 302} and set(range(60)) <= seen[0]
    assert not seen[1] & set(range(200, 215)) and set(range(60)) <= seen[1]
    assert seen[2] == set(range(60))
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    words = packing.Words.of(public_tokenizers.path("word_bpe_49k.json"))
    tokens = {r.doc_id: r.doc_tokens for r in got}
    assert tokens == {i: len(words.ids([t])[0]) // 4 + 1 for i, t, _ in rows[:60]}
    assert len({r.sequence_id for r in got}) == -(-sum(tokens.values()) // 4096)


def test_empty_documents(spark, docs):
    frame = docs([])
    for _, step in corpus_pipeline.STAGES:
        assert step(spark, frame, "").count() == 0
