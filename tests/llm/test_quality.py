"""Weak labels: estimated accuracies, the scorer on texts of known kind, and odd rows."""

import math
import random

import numpy as np
import pytest

from refmill.llm import quality

SYLLABLES = "an er in ou th re st en de la que ion".split()


def prose(rnd, words):
    sentences, left = [], words
    while left > 0:
        n = min(left, rnd.randint(4, 12))
        sentences.append(" ".join("".join(rnd.choices(SYLLABLES, k=rnd.randint(1, 3))) for _ in range(n)).capitalize() + ".")
        left -= n
    return " ".join(sentences)


def junk(rnd, words):
    text = prose(rnd, words)
    kind = rnd.randrange(4)
    if kind == 0:
        return " ".join(w + rnd.choice(["%%%", "$$$", "###"]) for w in text.split())
    if kind == 1:
        return text.upper().replace(" ", "!! ")
    if kind == 2:
        return " ".join(w for w in text.split() for _ in range(8))
    return text.replace(" ", " | ")


def corpus(n, seed=1):
    rnd = random.Random(seed)
    return [(i, junk(rnd, rnd.randint(50, 300)) if i % 7 == 0 else prose(rnd, rnd.randint(3, 300))) for i in range(n)]


def test_scorer_tells_junk_from_prose(docs):
    rows = corpus(700)
    got = {r.doc_id: r for r in quality.classify(docs(rows)).collect()}
    assert len(got) == 700
    assert np.mean([got[i].keep == bool(i % 7) for i, _ in rows]) > 0.98
    assert np.mean([got[i].keep for i, _ in rows if i % 7]) > 0.99


def test_accuracies_are_recovered():
    rng = np.random.default_rng(1)
    n, k = 20_000, len(quality.LABELLERS)
    truth = rng.uniform(size=n) < 0.8
    right = np.linspace(0.7, 0.95, k)
    votes = np.where(rng.uniform(size=(n, k)) < right, truth[:, None], ~truth[:, None]) * quality.GOOD
    votes[rng.uniform(size=(n, k)) < 0.2] = quality.SILENT
    patterns, counts = np.unique([quality.pattern(v.tolist()) for v in votes], return_counts=True)
    found = quality.estimate(patterns, counts.astype(float))
    assert abs(found.good - 0.8) < 0.02
    assert np.abs(found.cast[:, 1, quality.GOOD] - right).max() < 0.03
    assert np.abs(found.cast[:, 0, quality.BAD] - right).max() < 0.05


def test_odd_rows(docs):
    rows = corpus(100) + [(500, None), (501, ""), (502, "  "), (None, "A short text."), (1, corpus(2)[1][1])]
    got = quality.classify(docs(rows)).collect()
    assert len(got) == len(rows)
    by_id = {r.doc_id: r for r in got}
    assert not any(by_id[i].keep for i in (500, 501, 502))
    assert by_id[None].votes is not None and 0 <= by_id[None].score <= 1
    assert len({(r.score, r.keep) for r in got if r.doc_id == 1}) == 1


def test_sample_is_bounded_whatever_share_an_id_holds(docs, monkeypatch):
    rows = [(None if i % 3 == 0 else 7 if i % 3 == 1 else i, f"text {i}") for i in range(6000)]
    for part in (rows, rows[::3], rows[1::3]):
        picked = quality.sampled(docs(part), 300 / len(part)).select("pick").collect()
        assert 200 < len(picked) < 400 and len({r.pick for r in picked}) > 190
    rows, sizes = [(None, t) for _, t in corpus(400)], []
    made = quality.sampled
    monkeypatch.setattr(quality, "sampled", lambda d, share: sizes.append(made(d, share).count()) or made(d, share))
    assert quality.train(docs(rows), 100) is not None and 60 < sizes[0] < 140


def test_filter_keeps_rows_and_columns(docs):
    table = docs(corpus(200))
    kept = quality.keep_good(table)
    assert kept.columns == table.columns
    keep = {r.doc_id for r in quality.classify(table).where("keep").collect()}
    assert {r.doc_id for r in kept.collect()} == keep


def test_empty_table(docs):
    assert quality.classify(docs([])).count() == 0
    assert quality.keep_good(docs([])).count() == 0


def test_parts_of_long_texts_measure_the_same(monkeypatch):
    text = prose(random.Random(3), 200) + " 🙂 | x"
    found = quality.measures(text)
    whole = [x.tolist() for x in quality.features(text, found)]
    monkeypatch.setattr(quality, "_PART", 7)
    assert quality.measures(text) == found and [x.tolist() for x in quality.features(text, found)] == whole


def test_estimate_equals_enumeration():
    """Expectation-maximisation text by text in plain Python."""
    rnd = random.Random(4)
    k = len(quality.LABELLERS)
    ballots = []
    for _ in range(60):
        good = rnd.random() < 0.7
        ballots.append([rnd.choice([quality.SILENT, quality.UNSURE, quality.GOOD if good else quality.BAD, quality.GOOD if good else quality.BAD]) for _ in range(k)])
    p = [0.1 if quality.BAD in b else 0.9 for b in ballots]
    for _ in range(200):
        prior = (sum(p) + 1) / (len(p) + 2)
        cast = {}
        for i in range(k):
            for c in (0, 1):
                said = [sum((q if c else 1 - q) for q, b in zip(p, ballots) if b[i] == v) + 0.5 for v in range(3)]
                cast[i, c] = [x / sum(said) for x in said] + [1.0]
        new = []
        for b in ballots:
            odds = math.log(prior / (1 - prior)) + sum(math.log(cast[i, 1][v] / cast[i, 0][v]) for i, v in enumerate(b))
            new.append(1 / (1 + math.exp(-odds)))
        moved, p = max(abs(x - y) for x, y in zip(p, new)), new if max(abs(x - y) for x, y in zip(p, new)) >= 1e-6 else p
        if moved < 1e-6:
            break
    patterns, counts = np.unique([quality.pattern(b) for b in ballots], return_counts=True)
    found = quality.estimate(patterns, counts.astype(float))
    assert abs(found.good - prior) < 1e-9
    assert np.allclose(found.posterior(np.array(ballots)), new, atol=1e-9)


def test_scorer_equals_plain_steps():
    rnd = random.Random(5)
    rows = [(np.array(rnd.sample(range(50), 4)), np.array([rnd.random() for _ in range(4)]), rnd.random()) for _ in range(40)]
    w, seen, decay = {}, {}, 1e-5
    for _ in range(3):
        for buckets, values, label in rows:
            x = dict(zip(buckets.tolist(), values.tolist())) | {-1: 1.0}
            p = 1 / (1 + math.exp(-sum(w.get(i, 0.0) * v for i, v in x.items())))
            steps = {i: (p - label) * v + decay * w.get(i, 0.0) for i, v in x.items()}
            for i, g in steps.items():
                seen[i] = seen.get(i, 1e-3) + g * g
                w[i] = w.get(i, 0.0) - 0.2 * g / math.sqrt(seen[i])
    weights, bias = quality.fit(rows)
    assert np.allclose(weights[:50], [w.get(i, 0.0) for i in range(50)]) and abs(bias - w[-1]) < 1e-9


def test_variety_does_not_depend_on_length():
    rnd = random.Random(6)
    few, many = ([f"{c}{i}" for i in range(n)] for c, n in (("a", 110), ("b", 4000)))
    for words, low, high in ((few, 0.3, 0.4), (many, 0.9, 1.0)):
        shares = [quality.measures(" ".join(rnd.choice(words) for _ in range(n)))["distinct"] for n in (300, 1000, 20_000)]
        assert low < min(shares) and max(shares) < high
    labeller = next(x for x in quality.LABELLERS if x.measure == "distinct")
    assert shares and min(shares) > labeller.good
    assert all(quality.votes(quality.measures(" ".join(rnd.choice(few) for _ in range(n))))[quality.LABELLERS.index(labeller)] == quality.UNSURE for n in (300, 20_000))


def test_parts_of_long_texts_measure_the_same(monkeypatch):
    rnd = random.Random(7)
    text = " ".join(rnd.choice(["alpha", "beta.", "x\n", "line\n\n", "Été!", "  "]) + str(rnd.randint(0, 99)) for _ in range(3000))
    whole = quality.measures(text), *[sorted(x.tolist()) for x in quality.features(text, {})]
    for size in (7, 100, 5000):
        monkeypatch.setattr(quality, "_PART", size)
        found, buckets, values = quality.measures(text), *[sorted(x.tolist()) for x in quality.features(text, {})]
        assert found == pytest.approx(whole[0]) and buckets == whole[1] and values == pytest.approx(whole[2])
