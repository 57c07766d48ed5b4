"""Language identification: accuracy on held-out texts, and what has no language."""

import math
import random

import numpy as np

from refmill.llm import langid

WORDS = {
    "en": "the of and to in is that with for was this from have not are".split(),
    "fr": "le la de et les des une que pour dans est pas sur au avec".split(),
    "de": "der die und das nicht mit ist ein eine auf von sich dem zu den".split(),
}


def corpus(n, seed=1):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        lang = rnd.choice(list(WORDS))
        rows.append((i, " ".join(rnd.choice(WORDS[lang]) for _ in range(rnd.randint(8, 60))).capitalize() + ".", lang))
    return rows


def test_held_out_accuracy_and_edge_cases(docs):
    rows = corpus(600)
    odd = [(1001, None, "en"), (1002, "", None), (1003, "123 ?! ²", "fr"), (1004, "der die das und nicht", None), (None, "the of and to in", None), (rows[0])]
    got = langid.identify_languages(docs(rows + odd)).collect()
    assert len(got) == len(rows) + len(odd)
    truth = {i: lang for i, _, lang in rows}
    tested = [r for r in got if r.held_out and r.doc_id in truth]
    assert len(tested) > 100
    assert np.mean([r.lang_pred == truth[r.doc_id] for r in tested]) > 0.97
    by_id = {r.doc_id: r for r in got}
    assert all((by_id[i].lang_pred, by_id[i].score) == ("und", 0.0) for i in (1001, 1002, 1003))
    assert by_id[1004].lang_pred == "de" and by_id[None].lang_pred == "en" and by_id[None].held_out is False
    assert all(0 <= r.score <= 1 for r in got)


def test_filter_keeps_rows_and_columns(docs):
    rows = corpus(200)
    table = docs(rows + [(999, "12 34", "en"), (1000, None, None), rows[0]])
    kept = langid.confident(table)
    assert kept.columns == table.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted([r[0] for r in rows] + [rows[0][0]])


def test_without_labels_or_rows(docs):
    got = langid.identify_languages(docs([(1, "some text"), (2, None)])).collect()
    assert [(r.lang_pred, r.score) for r in got] == [("und", 0.0)] * 2
    assert langid.identify_languages(docs([])).count() == 0


def test_unlearned_languages_go(docs):
    rows = corpus(900, 3)
    strange = [(5000 + i, t, None) for i, (_, t, lang) in enumerate(rows) if lang == "de"]
    known = [(i, t, lang) for i, t, lang in rows if lang != "de"]
    kept = {r.doc_id for r in langid.confident(docs(known + strange)).collect()}
    assert len(kept & {i for i, _, _ in known}) > 0.995 * len(known)
    assert len(kept & {i for i, _, _ in strange}) < 0.02 * len(strange)


def test_rare_languages_are_learned(docs):
    rows = [(i, t, "en") for i, (_, t, lang) in enumerate(corpus(3000, 4)) if lang == "en"]
    rare = [(9000 + i, t, "fr") for i, (_, t, lang) in enumerate(corpus(60, 5)) if lang == "fr"]
    got = {r.doc_id: r.lang_pred for r in langid.identify_languages(docs(rows + rare), train_rows=100).collect()}
    assert all(got[i] == lang for i, _, lang in rare) and np.mean([got[i] == "en" for i, _, _ in rows]) > 0.99


def test_quotas_fill_up_from_the_smallest():
    assert langid.quotas({"a": 1000, "b": 10, "c": 3}, 100) == {"c": 1.0, "b": 1.0, "a": 87 / 1000}
    assert langid.quotas({"a": 10, "b": 10}, 100) == {"a": 1.0, "b": 1.0}


def test_sample_is_bounded_whatever_one_id_holds(docs):
    rows = [(1, f"the of and {i}", "en") for i in range(6000)] + [(i, f"le la de {i}", "fr") for i in range(2, 1000)]
    for hot in (1, 3, None):
        moved = [(hot if i == 1 else i, t, lang) for i, t, lang in rows]
        drawn = langid.drawn(docs(moved), langid.quotas({"en": 6000, "fr": 998}, 1000)).groupBy("lang").count().collect()
        assert all(abs(r["count"] - 500) < 120 for r in drawn)


def test_most_frequent_languages_only(docs):
    rows = corpus(300, 6) + [(5000 + i, f"zz{i} qq", f"x{i}") for i in range(50)]
    model = langid.train(docs(rows), max_languages=3)
    assert model.languages == ["de", "en", "fr"] and model.weights.shape[1] == 3


def test_leader_equals_dense_steps(monkeypatch):
    monkeypatch.setattr(langid, "BUCKETS", 12)
    rng, s = np.random.default_rng(7), langid.Settings()
    rows = [(np.array(sorted(rng.choice(12, 4, replace=False))), rng.random(4), int(rng.integers(3))) for _ in range(60)]
    z, n = [[0.0] * 3 for _ in range(13)], [[0.0] * 3 for _ in range(13)]

    def weight(i, k):
        if abs(z[i][k]) <= s.l1:
            return 0.0
        return -(z[i][k] - math.copysign(s.l1, z[i][k])) / ((s.beta + math.sqrt(n[i][k])) / s.alpha + s.l2)

    for _ in range(s.epochs):
        for buckets, values, language in rows:
            x = [0.0] * 12 + [1.0]
            for b, v in zip(buckets, values):
                x[b] = v
            w = [[weight(i, k) for k in range(3)] for i in range(13)]
            logits = [sum(x[i] * w[i][k] for i in range(13)) for k in range(3)]
            total = sum(math.exp(v) for v in logits)
            for i in range(13):
                for k in range(3):
                    g = x[i] * (math.exp(logits[k]) / total - (k == language))
                    z[i][k] += g - (math.sqrt(n[i][k] + g * g) - math.sqrt(n[i][k])) / s.alpha * w[i][k]
                    n[i][k] += g * g
    weights, bias = langid.fit(rows, 3, s)
    assert np.allclose(weights, [[weight(i, k) for k in range(3)] for i in range(12)]) and np.allclose(bias, [weight(12, k) for k in range(3)])


def test_temperature_calibrates():
    rng = np.random.default_rng(1)
    p = rng.uniform(0.5, 1, 100_000)
    labels = (rng.uniform(size=len(p)) > p).astype(int)
    logits = 3 * np.stack([np.log(p), np.log(1 - p)], axis=1)
    assert abs(langid.fit_temperature(logits, labels) - 3) < 0.1


def test_penalty_makes_weights_sparse():
    rng = np.random.default_rng(2)
    rows = [(np.array([i % 2, 10 + rng.integers(1000)]), np.array([1.0, 0.1]), i % 2) for i in range(500)]
    weights, _ = langid.fit(rows, 2, langid.Settings(l1=0.5))
    assert weights[0, 0] > 0 > weights[0, 1] and (weights[10:] != 0).mean() < 0.05


def test_parts_of_long_texts_count_the_same(monkeypatch):
    text = "The house by the river, été größer " * 40
    whole = [x.tolist() for x in langid.ngram_counts(text)]
    for size in (2, 3, 50):
        monkeypatch.setattr(langid, "_PART", size)
        assert [x.tolist() for x in langid.ngram_counts(text)] == whole
