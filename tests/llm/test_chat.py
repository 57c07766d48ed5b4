"""Collapse of snapshots and rendering against plain Python."""

import random

from refmill.llm import chat

SCHEMA = "conv_id bigint, turn bigint, role string, text string, size int, one int"


def table(spark, rows):
    return spark.createDataFrame([(*r, 1, 2) for r in rows], SCHEMA)


def nulls_first(x):
    return (x is not None, x if x is not None else 0)


def brute(rows):
    talks = {}
    for conv, turn, role, text in set(rows):
        talks.setdefault(conv, []).append((turn, role, text))
    order = lambda t: (nulls_first(t[0]), (t[1] is not None, t[1] or ""), (t[2] is not None, t[2] or ""))
    talks = {c: sorted(t, key=order) for c, t in talks.items()}
    out = []
    for conv, said in talks.items():
        longer = any(len(o) > len(said) and o[: len(said)] == said for o in talks.values())
        twin = any(o == said and (c is None, c or 0) < (conv is None, conv or 0) for c, o in talks.items())
        if longer or twin:
            continue
        at = 0
        for i, (_, role, text) in enumerate(said):
            part = f"<|{(role or '').replace('<|', '< |')}|>\n{(text or '').replace('<|', '< |')}<|end|>\n"
            out.append((conv, i, at, part, len(said)))
            at += len(part)
    return sorted(out, key=repr)


def logs(seed):
    rnd = random.Random(seed)
    rows, n = [], 0
    for _ in range(25):
        said = [(t, rnd.choice(["user", "assistant"]), rnd.choice(["hi", "yes", "no", "<|end|> é", "", None])) for t in range(rnd.randint(1, 9))]
        for _ in range(rnd.randint(1, 4)):
            rows += [(n, *x) for x in said[: rnd.randint(1, len(said))]]
            n += 1
    return rows


def test_collapse_equals_plain_python(spark):
    for seed in range(3):
        rows = logs(seed)
        got = chat.render(table(spark, rows)).select("conv_id", "position", "start", "segment", "turns").collect()
        assert sorted(map(tuple, got), key=repr) == brute(rows)


def test_odd_rows(spark):
    rows = [(1, 0, "user", "a"), (1, 0, "user", "a"), (2, 0, "user", "a"), (2, 1, None, "b"), (None, 0, "user", "a"), (None, 1, "x", None), (3, None, "user", "z"), (3, 0, "user", "y"), (4, 0, None, None)]
    got = chat.render(table(spark, rows)).collect()
    assert sorted(map(tuple, got), key=repr) == brute(rows)


def test_one_conversation_of_many_turns(spark):
    rows = [(7, i, "user", f"turn {i}") for i in range(3000)] + [(8, i, "user", f"turn {i}") for i in range(2000)]
    got = chat.render(table(spark, rows)).collect()
    assert sorted(map(tuple, got), key=repr) == brute(rows)


def test_empty_table(spark):
    assert chat.render(table(spark, [])).count() == 0
