"""Conversation repair: the programme against a search over all edits, the table against plain Python."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from refmill.llm import repair

SCHEMA = "conv_id bigint, turn bigint, role string, text string, conv string, task int, block int, symbols string"
LEGAL = re.compile(r"(s?(ua)+)?")


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, 2, "y") for r in rows], SCHEMA)


def faults(rows):
    """Faults of (role, text) rows in order."""
    seen, found = set(), []
    for role, text in rows:
        ink = re.findall("[^\x20\x09-\x0d]", text)
        found.append("blank" if not ink else "duplicate" if (role, text) in seen else "truncated" if ink[-1] not in ".!?" else "")
        seen.add((role, text))
    return found


def search(rows):
    """Cheapest, ASCII-least audit with its repaired rows: Dijkstra's order over (cost, audit) of all prefixes."""
    import heapq

    kinds, heap, done = faults(rows), [(0, "", 0, "", ())], set()
    while heap:
        cost, audit, at, state, made = heapq.heappop(heap)
        if (at, state) in done:
            continue
        done.add((at, state))
        if at == len(rows) and state in ("", "a"):
            return cost, audit, list(made)
        forced = "assistant" if state == "u" else "user"

        def put(letter, price, to, row=None, step=1):
            # equal cost: the smaller audit comes first, as both are extended alike from here on
            heapq.heappush(heap, (cost + price, audit + letter, at + step, to, (*made, row) if row else made))  # noqa: B023

        put("I", 5, forced[0], (forced, ""), 0)
        if at < len(rows):
            role, text = rows[at]
            put("D", 2, state)
            if kinds[at] not in ("blank", "duplicate"):
                more = 5 if kinds[at] == "truncated" else 0
                put("R", 1 + more, forced[0], (forced, text))
                initial = role[:1]
                if initial in {"": "su", "s": "u", "u": "a", "a": "u"}[state] and initial:
                    put("K", more, initial, (role, text))
    raise AssertionError


def want_of(conv_id, rows):
    """rows: (turn, role, text) after damage, in order."""
    pairs = [(r, t) for _, r, t in rows]
    kinds = faults(pairs)
    cost, audit, made = search(pairs)
    assert LEGAL.fullmatch("".join(r[0] for r, _ in made))
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(pairs, pairs[1:]))
    text = "\n".join(f"{r}:{t}" for r, t in made)
    counts = [kinds.count(k) for k in ("blank", "duplicate", "truncated")]
    return (conv_id, gaps, *counts, illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest())


def damage(rows):
    for conv_id, turn, role, text in rows:
        key = f"{' ' if conv_id is None else conv_id}:{' ' if turn is None else turn}"
        hit = zlib.crc32(key.encode()) % 20
        role, text = (" " if x is None else x for x in (role, text))
        if hit:
            text = "" if hit == 1 else re.sub("[.!?]", "", text) if hit == 2 else text
            role = "user" if hit == 4 else role
            yield from [(conv_id, turn, role, text)] * (2 if hit == 3 else 1)


def plain(rows, spoil=True):
    by_conv = {r[0]: [] for r in rows}
    for conv_id, *row in damage(rows) if spoil else [(c, n, " " if r is None else r, " " if t is None else t) for c, n, r, t in rows]:
        by_conv[conv_id].append(tuple(row))
    out = []
    for conv_id, turns in by_conv.items():
        turns.sort(key=lambda t: (t[0] is not None, t[0] or 0, t[1], t[2]))
        out.append(want_of(conv_id, turns))
    return sorted(out, key=repr)


def talk(seed, conversations, longest=14):
    rnd, rows = random.Random(seed), []
    roles = ["user", "assistant", "user", "assistant", "system", "tool", "", None, "ux"]
    texts = ["Yes.", "No", "Why?", "  ", "", None, "so be it! \n", "…", "a.b", "Go on.\x1f"]
    for c in range(conversations):
        for turn in range(rnd.randint(1, longest)):
            rows.append((c, turn + (turn > 4) * rnd.randint(0, 3), rnd.choice(roles), rnd.choice(texts) if rnd.random() < 0.5 else f"{turn}."))
    return rows


def test_programme_equals_search():
    rnd = random.Random(3)
    for _ in range(400):
        rows = [(rnd.choice(["system", "user", "assistant", "tool"]), rnd.choice(["", "a.", "b.", "c"]) + rnd.choice(["", str(rnd.random()) + "."])) for _ in range(rnd.randint(0, 9))]
        names = ["", "blank", "duplicate", "truncated"]
        symbols = np.array([repair.symbol_of(r, names.index(f)) for (r, _), f in zip(rows, faults(rows))], np.uint8)
        runs, costs = repair.costs_behind_runs(symbols, repair.tail())
        made, state = repair.unroll(runs, repair.NOTHING)
        made.append(repair._to_end(state))
        cost, audit, turns = search(rows)
        assert (int(costs[0]), "".join(made)) == (cost, audit)
        edited, _ = repair.apply_edits(repair.NOTHING, made, *([list(c) for c in zip(*rows)] or [[], []]))
        assert [(r, t) for e, r, t in edited if e != "D"] == turns


def test_powers_equal_single_steps():
    rnd = random.Random(5)
    for symbol in range(16):
        n = rnd.randint(1, 200)
        costs = repair.tail()
        for _ in range(n):
            costs = repair.times(repair.power(symbol, 0), costs)
        assert (repair.advance(symbol, n, repair.tail()) == costs).all()
        assert (repair.times(repair.chunk_matrix(np.full(n, symbol, np.uint8)), repair.tail()) == costs).all()


def test_chunks_join_to_the_whole():
    rnd = random.Random(6)
    symbols = np.array([rnd.choice([0, 4, 8, 8, 4, 12, 7, 6]) for _ in range(300)], np.uint8)
    whole, costs = repair.costs_behind_runs(symbols, repair.tail())
    letters, _ = repair.unroll(whole, repair.NOTHING)
    a, b = symbols[:117], symbols[117:]
    ends = repair.times(repair.chunk_matrix(b), repair.tail())
    assert (repair.times(repair.chunk_matrix(a), ends) == costs).all()
    first, state = repair.unroll(repair.costs_behind_runs(a, ends)[0], repair.NOTHING)
    assert first + repair.unroll(repair.costs_behind_runs(b, repair.tail())[0], state)[0] == letters


@pytest.fixture
def uncoalesced(spark):
    """Small ranges stay apart, so that conversations lie in several tasks."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


COLUMNS = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def query(spark, rows, tmp_path):
    table(spark, rows).write.parquet(f"{tmp_path}/conversations.parquet")
    return sorted((tuple(r) for r in repair.op13_run_length_repair(spark, str(tmp_path)).select(*COLUMNS).collect()), key=repr)


def test_query_equals_plain_python(spark, tmp_path):
    rows = talk(1, 120)
    rows += [(None, 1, "user", "Hi."), (None, None, "assistant", "Ho."), (500, None, "user", "a."), (500, None, "user", "a."), (501, 2, None, None)]
    rows += [rows[3], rows[3], rows[20]]
    gone = next(i for i in range(600, 1000) if zlib.crc32(f"{i}:1".encode()) % 20 == 0)
    rows.append((gone, 1, "user", "gone."))
    got = query(spark, rows, tmp_path)
    assert got == plain(rows)
    assert (gone, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()) in got


@pytest.mark.parametrize("block_rows", [1, 7, 1024])
def test_one_conversation_over_all_tasks(spark, tmp_path, monkeypatch, uncoalesced, block_rows):
    monkeypatch.setattr(repair, "BLOCK_ROWS", block_rows)
    rnd, rows = random.Random(9), talk(2, 10)
    for turn in range(400):
        role = rnd.choice(["user", "assistant"]) if turn % 60 else "system"
        rows.append((77, turn * 2 if turn < 300 else None, role, rnd.choice(["again.", "cut off", "", f"{turn}.", f"{turn}."])))
    assert query(spark, rows, tmp_path) == plain(rows)


def test_repeated_rows_are_dealt_apart_and_repaired(spark, uncoalesced):
    rows = [(1, 1, "user", "same.")] * 300 + [(1, 2, "assistant", "Fine.")]
    got = repair.repaired_turns(table(spark, rows)).collect()
    assert len(got) == 301 and len({r.task for r in got}) > 1
    kept = [(r.edit, r.role, r.text) for r in sorted(got, key=lambda r: (r.task, r.block, r.position)) if r.edit != "D"]
    assert kept == [("K", "user", "same."), ("K", "assistant", "Fine.")]


def test_long_texts_and_empty_table(spark, tmp_path):
    rows = [(1, 0, "user", "word " * 500_000 + "."), (1, 1, "assistant", "x" * 1_500_000), (1, 2, "assistant", "Ok.")]
    assert [tuple(r) for r in repair.report(table(spark, rows)).select(*COLUMNS).collect()] == plain(rows, spoil=False)
    assert query(spark, [], tmp_path) == []
