"""Chat logs: snapshots that a longer conversation begins with are dropped, the rest is rendered.

A logger that stores a conversation after every turn leaves all its beginnings behind. Every
turn is hashed with its number, and running sums of these hashes name each beginning
of a conversation. A conversation is dropped if its whole hash is that of a proper beginning
of another; of equal conversations the one with the smallest id stays.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import stage
from .common import read_table, running_totals

#: lanes of 32 bits whose running sums can't overflow a long
LANES = ["lane0", "lane1", "lane2", "lane3"]


def segment(role: Column, text: Column) -> Column:
    """A turn as it is rendered; the opening of a control token inside is taken apart."""

    def plain(x: Column) -> Column:
        return F.replace(F.coalesce(x, F.lit("")), F.lit("<|"), F.lit("< |"))

    return F.concat(F.lit("<|"), plain(role), F.lit("|>\n"), plain(text), F.lit("<|end|>\n"))


def _lanes(turn: Column, role: Column, text: Column) -> list[Column]:
    mark = F.lit("\x1f")  # lengths in front keep parts apart whatever they hold
    role, text = (F.coalesce(F.concat(F.length(x).cast("string"), F.lit(":"), x), F.lit("null")) for x in (role, text))
    digest = F.md5(F.concat(F.coalesce(turn.cast("string"), F.lit("null")), mark, role, mark, text).cast("binary"))
    return [F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("bigint").alias(n) for i, n in enumerate(LANES)]


def maximal_turns(turns: DataFrame) -> DataFrame:
    """Turns of the conversations that are no beginning of another, ``conv_id, turn, role, text`` and
    ``position`` (from 0), ``start`` (of the rendered segment) and ``turns``.

    Turns are ordered by number, then role and text, nulls first; a row repeated as a whole is
    one turn. A null conv_id names a conversation like any other id. A conversation of any
    length is dealt over several tasks; hashes meet after being counted once per distinct value.
    """
    rows = turns.select(F.col("conv_id").cast("bigint"), F.col("turn").cast("bigint"), "role", "text").distinct()
    size = F.length(segment(F.col("role"), F.col("text"))).cast("bigint").alias("size")
    hashed = rows.select("*", *_lanes(F.col("turn"), F.col("role"), F.col("text")), size, F.lit(1).cast("bigint").alias("one"))
    placed = stage(running_totals(hashed, ["conv_id"], ["turn", "role", *LANES], [*LANES, "size", "one"]))
    whole = placed.groupBy("conv_id").agg(F.count("*").alias("turns"), *[F.sum(x).alias(x) for x in LANES])
    begun = [(F.col(f"{x}_before")).alias(x) for x in LANES]
    # what comes before a turn is a proper beginning
    beginnings = placed.where(F.col("one_before") > 0).select(F.col("one_before").alias("turns"), *begun).distinct()
    kept = whole.groupBy("turns", *LANES).agg(F.min(F.struct(F.col("conv_id").isNull(), "conv_id"))["conv_id"].alias("kept_id"))
    maximal = kept.join(beginnings, ["turns", *LANES], "left_anti").select("kept_id", "turns")
    found = placed.join(maximal, F.col("conv_id").eqNullSafe(F.col("kept_id")))
    return found.select("conv_id", "turn", "role", "text", F.col("one_before").alias("position"), F.col("size_before").alias("start"), "turns")


def render(turns: DataFrame) -> DataFrame:
    """``conv_id, position, start, segment, turns`` of the maximal conversations.

    Segments in order of ``position`` make the rendered conversation; ``start`` is each one's
    first character in it, so that writers and later joins need not gather a conversation.
    """
    kept = maximal_turns(turns)
    return kept.select("conv_id", "position", "start", segment(F.col("role"), F.col("text")).alias("segment"), "turns")


def op6_snapshot_collapse(spark, sf_dir):
    """All maximal conversations, rendered."""
    return render(read_table(spark, sf_dir, "conversations"))


OP6_SQL = """
    WITH t AS (SELECT DISTINCT conv_id, turn, role, text FROM conversations),
    o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) - 1 AS position,
                 concat('<|', replace(role, '<|', '< |'), '|>', chr(10), replace(text, '<|', '< |'), '<|end|>', chr(10)) AS segment FROM t),
    c AS (SELECT conv_id, count(*) AS turns, list(concat(turn, ' ', role, ' ', text) ORDER BY position) AS said FROM o GROUP BY conv_id),
    f AS (SELECT min(conv_id) AS conv_id, turns, said FROM c GROUP BY turns, said),
    b AS (SELECT DISTINCT k AS turns, said[1:k] AS said FROM (SELECT said, unnest(range(1, turns)) AS k FROM c)),
    m AS (SELECT conv_id, turns FROM f WHERE NOT EXISTS (SELECT 1 FROM b WHERE b.turns = f.turns AND b.said = f.said))
    SELECT conv_id, CAST(position AS BIGINT) AS position,
           CAST(coalesce(sum(length(segment)) OVER (PARTITION BY conv_id ORDER BY position ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start,
           segment, CAST(turns AS BIGINT) AS turns
    FROM o JOIN m USING (conv_id)
"""
