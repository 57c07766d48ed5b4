"""Conversations mended to a legal order of roles by the cheapest edits, as a run-length dynamic programme.

A turn is one symbol: what its role begins with, and its fault. Reading a symbol moves a
conversation between four states (nothing, system, user or assistant kept last), so its edits
are a 4 × 4 matrix of costs, and reading several symbols the min-plus product of their
matrices. Equal consecutive symbols are collapsed to runs; a run is advanced through cached
binary powers of its matrix. From the costs to go at the ends of runs the choices are unrolled.

Products are associative, so a conversation of any length is dealt over tasks in order: each
takes the matrix of its chunk, one short chain per conversation joins the chunks, and each
unrolls its own. Texts travel in blocks of bounded size.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from hashlib import blake2b, sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import ship_by_value, stage
from .common import column_list, in_parts, read_table, remembered

ship_by_value(__name__)

BLOCK_ROWS = 1024
BLOCK_CHARS = 1 << 20  # of texts in a block; one longer text has a block of its own

#: what was kept last
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
STATES = 4
#: the only role that may be inserted or given next, as the state it leads to
FORCED = (USER, USER, ASSISTANT, USER)
NAMES = {USER: "user", ASSISTANT: "assistant"}
#: faults, and what a role begins with
SOUND, BLANK, DUPLICATE, TRUNCATED = range(4)
INITIALS = "sua"  # any other is one more class
LEGAL_PAIRS = ((0, 1), (1, 2), (2, 1))
NEVER = 1 << 40

#: costs of edits; an undeleted truncated turn costs more
RETITLE, DELETE, INSERT, LEFT_TRUNCATED = 1, 2, 5, 5

_INK = re.compile("[^\x20\x09-\x0d]")
_LAST_INK = re.compile("[^\x20\x09-\x0d](?=[\x20\x09-\x0d]*\\Z)")

TURNS = "conv_id bigint, task int, block int"


def symbol_of(role: str, fault: int) -> int:
    at = INITIALS.find(role[0]) if role else -1
    return (at if at >= 0 else len(INITIALS)) * 4 + fault


def own_fault(text: str) -> int:
    last = _LAST_INK.search(text) if _INK.search(text) else None
    if last is None:
        return BLANK
    return SOUND if last[0] in ".!?" else TRUNCATED


# ---- the programme


@remembered
def row_edits(symbol: int) -> list[list[tuple[str, int, int]]]:
    """For each state the edits of a turn: initial, cost, state after, in ASCII order of initials."""
    kind, fault = divmod(symbol, 4)
    kept = ({NOTHING: SYSTEM}, {NOTHING: USER, SYSTEM: USER, ASSISTANT: USER}, {USER: ASSISTANT}, {})[kind]
    extra = LEFT_TRUNCATED if fault == TRUNCATED else 0
    found = []
    for state in range(STATES):
        edits = [("D", DELETE, state)]
        if fault not in (BLANK, DUPLICATE):
            if state in kept:
                edits.append(("K", extra, kept[state]))
            edits.append(("R", RETITLE + extra, FORCED[state]))
        found.append(edits)
    return found


def times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Min-plus product of a matrix with a matrix or a vector."""
    summed = a[:, :, None] + b[None] if b.ndim == 2 else a + b[None]
    return np.minimum(summed.min(axis=1), NEVER)


@remembered
def insertions() -> np.ndarray:
    """Costs of any number of insertions between states."""
    costs = np.full((STATES, STATES), NEVER, np.int64)
    for state in range(STATES):
        at, total = state, 0
        for _ in range(STATES):
            costs[state, at] = min(costs[state, at], total)
            at, total = FORCED[at], total + INSERT
    return costs


@remembered
def tail() -> np.ndarray:
    """Costs to go behind the last turn."""
    ends = np.array([0, NEVER, NEVER, 0], np.int64)
    return times(insertions(), ends)


@remembered
def power(symbol: int, n: int) -> np.ndarray:
    """The matrix of 2**n equal symbols, insertions before each of them included."""
    if n:
        half = power(symbol, n - 1)
        return times(half, half)
    costs = np.full((STATES, STATES), NEVER, np.int64)
    for state, edits in enumerate(row_edits(symbol)):
        for _, cost, after in edits:
            costs[state, after] = min(costs[state, after], cost)
    return times(insertions(), costs)


def runs_of(symbols: np.ndarray) -> list[tuple[int, int]]:
    """Symbols and lengths of the runs."""
    starts = np.flatnonzero(np.r_[True, symbols[1:] != symbols[:-1]]) if len(symbols) else np.zeros(0, int)
    return list(zip(symbols[starts].tolist(), np.diff(np.r_[starts, len(symbols)]).tolist()))


def advance(symbol: int, n: int, costs: np.ndarray) -> np.ndarray:
    """Costs to go before a run, from those behind it."""
    bit = 0
    while n:
        if n & 1:
            costs = times(power(symbol, bit), costs)
        n, bit = n >> 1, bit + 1
    return costs


def chunk_matrix(symbols: np.ndarray) -> np.ndarray:
    """The costs of a whole chunk between states."""
    found = np.where(np.eye(STATES, dtype=bool), 0, NEVER).astype(np.int64)
    for symbol, n in runs_of(symbols):
        bit = 0
        while n:
            if n & 1:
                found = times(found, power(symbol, bit))
            n, bit = n >> 1, bit + 1
    return found


@remembered
def _level(symbol: int, behind: tuple[int, ...]) -> tuple[int, ...]:
    """Costs to go before a symbol, less their least."""
    costs = times(power(symbol, 0), np.array(behind, np.int64))
    return tuple((costs - costs.min()).tolist())


@remembered
def _choice(symbol: int, behind: tuple[int, ...], state: int) -> tuple[str, int]:
    """Initials of the ASCII-least cheapest edits up to a turn's own, and the state after."""
    costs = times(power(symbol, 0), np.array(behind, np.int64)).tolist()
    options = [(letter, cost + behind[after], after) for letter, cost, after in row_edits(symbol)[state]]
    options.append(("I", INSERT + costs[FORCED[state]], FORCED[state]))
    letter, _, after = min((o for o in options if o[1] == costs[state]), key=lambda o: o[0])
    if letter != "I":
        return letter, after
    rest, end = _choice(symbol, behind, after)
    return letter + rest, end


def _to_end(state: int) -> str:
    """Insertions behind the last turn."""
    made = ""
    while tail()[state]:
        made, state = made + "I", FORCED[state]
    return made


def costs_behind_runs(symbols: np.ndarray, ends: np.ndarray) -> tuple[list[tuple[int, int, np.ndarray]], np.ndarray]:
    """``(symbol, length, costs to go behind)`` of every run in order, and the costs before the first."""
    found = []
    for symbol, n in reversed(runs_of(symbols)):
        found.append((symbol, n, ends))
        ends = advance(symbol, n, ends)
    return found[::-1], ends


def unroll(runs: list[tuple[int, int, np.ndarray]], state: int) -> tuple[list[str], int]:
    """For every turn the initials of its edits, insertions before it first; and the last state."""
    made = []
    for symbol, n, behind in runs:
        levels = [tuple((behind - behind.min()).tolist())]
        for _ in range(n - 1):
            levels.append(_level(symbol, levels[-1]))
        for level in reversed(levels):
            letters, state = _choice(symbol, level, state)
            made.append(letters)
    return made, state


def apply_edits(state: int, edits: list[str], roles: list[str], texts: list[str]) -> tuple[list[tuple[str, str, str]], int]:
    """``(initial, role, text)`` of every edit, deleted turns with their own role; and the last state.

    ``edits`` may be one longer than the turns: insertions behind the last one.
    """
    made = []
    for letters, role, text in zip(edits, [*roles, ""], [*texts, ""]):
        for letter in letters:
            if letter == "I":
                state = FORCED[state]
                made.append((letter, NAMES[state], ""))
            elif letter == "R":
                state = FORCED[state]
                made.append((letter, NAMES[state], text))
            else:
                made.append((letter, role, text))
                if letter == "K":
                    state = {"s": SYSTEM, "u": USER, "a": ASSISTANT}[role[0]]
    return made, state


# ---- over tables


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Turns that are sorted by conversation, as blocks; turns that repeat one of the same task are duplicates."""
    from pyspark import TaskContext

    task = TaskContext.get().partitionId()
    kind = pa.schema([("conv", pa.string()), ("conv_id", pa.int64()), ("task", pa.int32()), ("block", pa.int32()), ("roles", pa.list_(pa.string())),
                      ("texts", pa.list_(pa.string())), ("symbols", pa.binary()), ("fresh", pa.list_(pa.binary()))])
    at, block, chars, seen = None, 0, 0, set()
    roles, texts, symbols, fresh, ready = [], [], bytearray(), [], []

    def close() -> None:
        nonlocal block, chars, roles, texts, symbols, fresh
        if roles:
            ready.append((*at, task, block, roles, texts, bytes(symbols), fresh))
        block, chars = block + 1, 0
        roles, texts, symbols, fresh = [], [], bytearray(), []

    def out() -> pa.RecordBatch:
        made = pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*ready), kind)], schema=kind)
        ready.clear()
        return made

    for batch in in_parts(batches):
        for conv, conv_id, role, text in zip(*[column_list(batch, c) for c in ("conv", "conv_id", "role", "text")]):
            if (conv, conv_id) != at:
                close()
                at, block, seen = (conv, conv_id), 0, set()
            elif len(roles) >= BLOCK_ROWS or chars + len(text) > BLOCK_CHARS:
                close()
            fault, digest = own_fault(text), None
            if fault != BLANK:
                digest = blake2b(f"{len(role)}:{role}{text}".encode("utf-8", "surrogatepass"), digest_size=16).digest()
                if digest in seen:
                    fault, digest = DUPLICATE, None
                else:
                    seen.add(digest)
            roles.append(role)
            texts.append(text)
            symbols.append(symbol_of(role, fault))
            fresh.append(digest)
            chars += len(text)
        if ready:
            yield out()
    close()
    if ready:
        yield out()


def _symbols(parts: list[dict]) -> tuple[np.ndarray, list[int]]:
    """Symbols of a chunk, with duplicates of earlier chunks, and the turns of its blocks."""
    found = []
    for part in parts:
        symbols = np.frombuffer(part["symbols"], np.uint8).copy()
        late = part["late"] or []
        symbols[late] = symbols[late] // 4 * 4 + DUPLICATE
        found.append(symbols)
    return np.concatenate(found), [len(s) for s in found]


def _matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in in_parts(batches):
        made = [chunk_matrix(_symbols(p)[0]).ravel().tolist() for p in column_list(batch, "parts")]
        kept = [batch.column(batch.schema.get_field_index(c)) for c in ("conv", "task")]
        yield pa.RecordBatch.from_arrays([*kept, pa.array(made, pa.list_(pa.int64()))], ["conv", "task", "matrix"])


def _chain_back(table: pa.Table) -> pa.Table:
    """Costs to go behind every chunk of a conversation; one row per task it lies in."""
    rows = sorted(table.to_pylist(), key=lambda r: r["task"], reverse=True)
    ends, made = tail(), []
    for r in rows:
        made.append((r["conv"], r["task"], ends.tolist(), not made))
        ends = times(np.array(r["matrix"], np.int64).reshape(STATES, STATES), ends)
    columns = list(zip(*made))
    kinds = (pa.string(), pa.int32(), pa.list_(pa.int64()), pa.bool_())
    return pa.table([pa.array(list(c), t) for c, t in zip(columns, kinds)], names=["conv", "task", "ends", "last"])


_UNROLLED = (
    "conv string, task int, entry int, exit int, cost bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, "
    "first int, final int, blocks array<struct<block:int,entry:int,edits:array<string>>>"
)


def _unrolled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edits of every chunk, for each state it may be entered in: that is one for conversations within a task."""
    edits = pa.list_(pa.struct([("block", pa.int32()), ("entry", pa.int32()), ("edits", pa.list_(pa.string()))]))
    kinds = [("conv", pa.string()), ("task", pa.int32()), ("entry", pa.int32()), ("exit", pa.int32())]
    kinds += [(n, pa.int64()) for n in ("cost", "blank", "duplicate", "truncated", "illegal")]
    kind = pa.schema([*kinds, ("first", pa.int32()), ("final", pa.int32()), ("blocks", edits)])
    for batch in in_parts(batches):
        rows = []
        for r in batch.to_pylist():
            symbols, sizes = _symbols(r["parts"])
            spans = r["ends"] is not None
            runs, costs = costs_behind_runs(symbols, np.array(r["ends"], np.int64) if spans else tail())
            faults, roles = np.bincount(symbols % 4, minlength=4).tolist(), symbols // 4
            illegal = len(roles) - 1 - sum(int(np.sum((roles[:-1] == a) & (roles[1:] == b))) for a, b in LEGAL_PAIRS)
            for entry in range(STATES) if spans else (NOTHING,):
                made, state = unroll(runs, entry)
                if not spans or r["last"]:
                    made.append(_to_end(state))
                at, before, blocks = 0, entry, []
                for n, part in enumerate(r["parts"]):
                    size = sizes[n] + (n + 1 == len(sizes))
                    blocks.append({"block": part["block"], "entry": before, "edits": made[at : at + size]})
                    before = _state_after(before, made[at : at + size], roles[at : at + sizes[n]])
                    at += size
                rows.append((r["conv"], r["task"], entry, state, int(costs[NOTHING]), *faults[1:], illegal, int(roles[0]), int(roles[-1]), blocks))
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*rows), kind)], schema=kind)


def _state_after(state: int, edits: list[str], roles: np.ndarray) -> int:
    for letters, role in zip(edits, roles.tolist()):
        for letter in letters:
            if letter in "IR":
                state = FORCED[state]
            elif letter == "K":
                state = (SYSTEM, USER, ASSISTANT)[role]
    return state


def _chain_on(table: pa.Table) -> pa.Table:
    """The state in which every chunk of a conversation is entered, and whether its first turn may follow the one before."""
    rows: dict[int, dict[int, dict]] = {}
    for r in table.to_pylist():
        rows.setdefault(r["task"], {})[r["entry"]] = r
    state, before, made = NOTHING, None, []
    for task in sorted(rows):
        r = rows[task][state]
        made.append((r["conv"], task, state, int(before is not None and (before, r["first"]) not in LEGAL_PAIRS)))
        state, before = r["exit"], r["final"]
    kinds = (pa.string(), pa.int32(), pa.int32(), pa.int64())
    return pa.table([pa.array(list(c), t) for c, t in zip(zip(*made), kinds)], names=["conv", "task", "entered", "joint"])


def _key(conv_id: Column) -> Column:
    return F.coalesce(conv_id.cast("string"), F.lit(" "))


def _dealt(turns: DataFrame) -> DataFrame:
    """Blocks of all turns in order, staged."""
    blank = F.lit(" ")
    rows = turns.select(
        _key(F.col("conv_id").cast("bigint")).alias("conv"),
        F.col("conv_id").cast("bigint").alias("conv_id"),
        F.col("turn").cast("bigint").alias("turn"),
        F.coalesce("role", blank).alias("role"),
        F.coalesce("text", blank).alias("text"),
    )
    # ties by role and text, long texts by their hash; rows equal in all may be dealt apart
    order = ["conv", "turn", "role", "text_head", "text_hash", "salt"]
    keyed = rows.withColumns({"text_head": F.substring("text", 1, 100), "text_hash": F.xxhash64("text"), "salt": F.monotonically_increasing_id()})
    sorted_ = keyed.repartitionByRange(*order).sortWithinPartitions(*order).select("conv", "conv_id", "role", "text")
    kind = "conv string, conv_id bigint, task int, block int, roles array<string>, texts array<string>, symbols binary, fresh array<binary>"
    return stage(sorted_.mapInArrow(_blocks, kind))


def _chunks(blocks: DataFrame) -> DataFrame:
    """One row per conversation and task: its blocks' symbols in order, ``spans`` if it lies in several tasks; staged."""
    spanning = blocks.groupBy("conv").agg(F.min("task").alias("a"), F.max("task").alias("b")).where("a < b").select("conv")
    shared = blocks.join(spanning, "conv", "left_semi")
    turns = shared.select("conv", "task", "block", F.posexplode("fresh").alias("at", "digest")).where("digest IS NOT NULL")
    first = turns.groupBy("conv", "digest").agg(F.min("task").alias("first_task"))
    late = turns.join(first, ["conv", "digest"]).where("task > first_task").groupBy("conv", "task", "block").agg(F.collect_list("at").alias("late"))
    part = F.struct("block", "symbols", "late")
    return stage(
        blocks.select("conv", "task", "block", "symbols")
        .join(late, ["conv", "task", "block"], "left")
        .groupBy("conv", "task")
        .agg(F.array_sort(F.collect_list(part)).alias("parts"))
        .join(spanning.withColumn("spans", F.lit(True)), "conv", "left")
    )


def plan_edits(blocks: DataFrame) -> DataFrame:
    """Edits of every chunk of ``_dealt`` blocks, one row per conversation and task; staged.

    ``entry`` is the state before, ``blocks`` holds for each block the initials of the edits of each turn, ``cost`` the
    costs to go from a conversation's start (right in its first task), ``blank``, ``duplicate``, ``truncated`` and
    ``illegal`` are counts.
    """
    chunks = _chunks(blocks)
    spanning = chunks.where("spans")
    ends = spanning.mapInArrow(_matrices, "conv string, task int, matrix array<bigint>").groupBy("conv")
    ends = ends.applyInArrow(_chain_back, "conv string, task int, ends array<bigint>, last boolean")
    made = stage(chunks.join(ends, ["conv", "task"], "left").select("conv", "task", "parts", "ends", "last").mapInArrow(_unrolled, _UNROLLED))
    links = made.join(spanning.select("conv").distinct(), "conv", "left_semi").select("conv", "task", "entry", "exit", "first", "final")
    entered = links.groupBy("conv").applyInArrow(_chain_on, "conv string, task int, entered int, joint bigint")
    chosen = made.join(entered, ["conv", "task"], "left").where(F.col("entry") == F.coalesce("entered", F.lit(NOTHING)))
    return stage(chosen.withColumn("illegal", F.col("illegal") + F.coalesce("joint", F.lit(0))).drop("entered", "joint"))


def _apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(pa.struct([("edit", pa.string()), ("role", pa.string()), ("text", pa.string())]))
    for batch in in_parts(batches, 64):
        made = []
        for entry, edits, roles, texts in zip(*[column_list(batch, c) for c in ("entry", "edits", "roles", "texts")]):
            made.append([{"edit": e, "role": r, "text": t} for e, r, t in apply_edits(entry, edits, roles, texts)[0]])
        kept = [batch.column(batch.schema.get_field_index(c)) for c in ("conv", "conv_id", "task", "block")]
        yield pa.RecordBatch.from_arrays([*kept, pa.array(made, kind)], ["conv", "conv_id", "task", "block", "turns"])


def edited_blocks(blocks: DataFrame, plan: DataFrame) -> DataFrame:
    """``conv, conv_id, task, block, turns``: every edit of a block as ``edit, role, text``, in order."""
    planned = plan.select("conv", "task", F.explode("blocks").alias("b")).select("conv", "task", "b.block", "b.entry", "b.edits")
    joined = blocks.select("conv", "conv_id", "task", "block", "roles", "texts").join(planned, ["conv", "task", "block"])
    kind = "conv string, conv_id bigint, task int, block int, turns array<struct<edit:string,role:string,text:string>>"
    return joined.mapInArrow(_apply, kind)


def repaired_turns(turns: DataFrame) -> DataFrame:
    """``conv_id, task, block, position, edit, role, text`` of the mended conversations of ``(conv_id, turn, role, text)``.

    ``edit`` is K (kept), R (given another role), I (inserted, empty) or D (deleted, with what was deleted);
    order is by ``task, block, position``. Turns are taken in order of ``turn``, nulls first, ties by role and text; a null role or
    text is one space; a null conv_id names a conversation like any other id. Repeated rows are duplicates.
    """
    blocks = _dealt(turns)
    made = edited_blocks(blocks, plan_edits(blocks))
    return made.select("conv_id", "task", "block", F.posexplode("turns").alias("position", "t")).select(
        "conv_id", "task", "block", "position", "t.edit", "t.role", "t.text"
    )


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Audit and hash of the conversations, whose pieces pass by in order; no text is kept."""
    at, audit, digest, any_ = None, [], None, False
    ready: list[tuple] = []
    kind = pa.schema([("conv", pa.string()), ("audit", pa.string()), ("repaired_sha256", pa.string())])

    def out() -> pa.RecordBatch:
        made = pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*ready), kind)], schema=kind)
        ready.clear()
        return made

    for batch in in_parts(batches, 64):
        for conv, letters, text, filled in zip(*[column_list(batch, c) for c in ("conv", "audit", "text", "filled")]):
            if conv != at:
                if at is not None:
                    ready.append((at, "".join(audit), digest.hexdigest()))
                at, audit, digest, any_ = conv, [], sha256(), False
            audit.append(letters)
            if filled:
                digest.update((("\n" if any_ else "") + text).encode())
                any_ = True
        if ready:
            yield out()
    if at is not None:
        ready.append((at, "".join(audit), digest.hexdigest()))
        yield out()


def report(turns: DataFrame) -> DataFrame:
    """``conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256`` of every conversation with turns.

    A hash runs over all of a conversation and its audit is one value: both pass in pieces, in order, through one task.
    """
    blocks = _dealt(turns)
    plan = plan_edits(blocks)
    kept = F.filter("turns", lambda t: t["edit"] != "D")
    lines = F.array_join(F.transform(kept, lambda t: F.concat(t["role"], F.lit(":"), t["text"])), "\n")
    pieces = edited_blocks(blocks, plan).select(
        "conv", "task", "block", F.array_join("turns.edit", "").alias("audit"), lines.alias("text"), (F.size(kept) > 0).alias("filled")
    )
    ordered = pieces.repartition("conv").sortWithinPartitions("conv", "task", "block").select("conv", "audit", "text", "filled")
    digests = ordered.mapInArrow(_digest, "conv string, audit string, repaired_sha256 string")
    sums = [F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated", "illegal")]
    counts = plan.groupBy("conv").agg(*sums, F.min_by("cost", "task").alias("cost"))
    conv = _key(F.col("conv_id").cast("bigint")).alias("conv")
    numbers = turns.select(conv, F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn")).distinct()
    wide = [f(F.col("turn").cast("decimal(38,0)")) for f in (F.max, F.min)]
    gaps = F.coalesce(wide[0] - wide[1] + 1 - F.count("turn"), F.lit(0)).try_cast("bigint")
    spread = numbers.groupBy("conv").agg(F.first("conv_id").alias("conv_id"), gaps.alias("gaps"))
    return spread.join(counts, "conv").join(digests, "conv").drop("conv")


# ---- the query


def damaged(turns: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text`` as the query's damage leaves them."""
    blank = F.lit(" ")
    kept = turns.select(F.col("conv_id").cast("bigint"), F.col("turn").cast("bigint"), F.coalesce("role", blank).alias("role"), F.coalesce("text", blank).alias("text"))
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), blank), F.lit(":"), F.coalesce(F.col("turn").cast("string"), blank))
    hit = (F.crc32(key.cast("binary")) % 20).cast("int")
    text = F.when(hit == 1, "").when(hit == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    copies = F.array_repeat(F.lit(1), F.when(hit == 0, 0).when(hit == 3, 2).otherwise(1))
    return kept.select("conv_id", "turn", F.when(hit == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), F.explode(copies).alias("copy")).drop("copy")


def op13_run_length_repair(spark, sf_dir):
    """Structure of all conversations after damage, and their cheapest repair.

    One row per original conv_id, null included; a conversation that lost all turns has zeros, an empty audit and the
    hash of nothing.
    """
    turns = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    ids = turns.select(F.col("conv_id").cast("bigint").alias("original")).distinct()
    found = report(damaged(turns))
    numbers = [F.coalesce(c, F.lit(0).cast("bigint")).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    none = F.sha2(F.lit("").cast("binary"), 256)
    return ids.join(found, F.col("original").eqNullSafe(F.col("conv_id")), "left").select(
        F.col("original").alias("conv_id"), *numbers, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", none).alias("repaired_sha256")
    )
