"""Fixity audit of WARC replicas with hash trees.

Every record is hashed. The records whose offsets lie in one range of a file are hashed
together, in order, into a node; ranges grow by a fixed factor from level to level up to
one root per file. To compare two replicas only roots are joined at first, and below them
only what lies under nodes that differ, down to the records.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import stage
from .common import read_table, running_totals

RANGE_BYTES = 65_536  # of the lowest nodes; a record belongs to the range it begins in
FANOUT = 16
RECORDS_PER_FILE = 512


def record_text(record_id: Column, url: Column, body: Column) -> Column:
    """One WARC record: headers and payload. A null url or body is an empty one."""
    body = F.coalesce(body, F.lit(""))
    return F.concat(
        F.lit("WARC/1.0\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:page:"), record_id.cast("string"),
        F.lit(">\r\nWARC-Target-URI: "), F.coalesce(url, F.lit("")),
        F.lit("\r\nContent-Type: text/html\r\nContent-Length: "), F.octet_length(body).cast("string"),
        F.lit("\r\n\r\n"), body, F.lit("\r\n\r\n"),
    )


def lay_out(records: DataFrame) -> DataFrame:
    """Adds ``offset`` to ``file, record_id, length, …``: where each record begins in its file.

    Records of a file are ordered by id and hash; a file may hold any share of all records.
    """
    placed = running_totals(records, ["file"], ["record_id", "sha256"], ["length"])
    return placed.withColumnRenamed("length_before", "offset")


def hash_tree(records: DataFrame) -> list[DataFrame]:
    """Levels of the tree over ``file, offset, record_id, length, sha256``, roots last.

    Each level has ``file, node, hash``; ``node`` counts ranges from the start of the file.
    A node gathers the records that begin in 64 KiB, or ``FANOUT`` nodes, whatever the file's size.
    """
    entry = F.concat_ws(" ", F.col("offset").cast("string"), F.col("record_id").cast("string"), "sha256")
    node = F.floor(F.col("offset") / RANGE_BYTES).alias("node")
    level = stage(
        records.select("file", node, F.struct("offset", entry.alias("text")).alias("entry")).groupBy("file", "node").agg(_joined("entry"))
    )
    levels = [level]
    highest = level.agg(F.max("node")).first()[0] or 0
    while highest:
        up = F.floor(F.col("node") / FANOUT)
        entry = F.concat_ws(" ", F.col("node").cast("string"), "hash")
        parts = levels[-1].select("file", up.alias("node"), F.struct(F.col("node").alias("offset"), entry.alias("text")).alias("entry"))
        levels.append(stage(parts.groupBy("file", "node").agg(_joined("entry"))))
        highest //= FANOUT
    return levels


def _joined(entry: str) -> Column:
    ordered = F.transform(F.array_sort(F.collect_list(entry)), lambda x: x["text"])
    return F.sha2(F.array_join(ordered, "\n").cast("binary"), 256).alias("hash")


def _differing(mine: DataFrame, other: DataFrame) -> DataFrame:
    """``file, node`` of nodes that aren't the same on both sides."""
    both = mine.withColumnRenamed("hash", "mine").join(other.withColumnRenamed("hash", "other"), ["file", "node"], "full")
    return both.where(~F.col("mine").eqNullSafe(F.col("other"))).select("file", "node")


def audit(mine: DataFrame, other: DataFrame) -> DataFrame:
    """Records that differ between two replicas of ``file, offset, record_id, length, sha256``.

    Returns ``file, offset, record_id, length, status, sha256, other_sha256``: ``changed``,
    ``missing`` in the other or ``extra`` there. Records are the same if file, offset and id are;
    of repeated ones each counts by its own offset. Null files or offsets can't be read and are
    not expected; empty replicas have nothing in common and nothing to compare.
    """
    a, b = hash_tree(mine), hash_tree(other)
    # a replica that ends early has fewer levels: what is above them holds one node per file
    depth = max(len(a), len(b))
    a, b = (x + [_raised(x[-1], n) for n in range(1, depth - len(x) + 1)] for x in (a, b))
    bad = _differing(a[-1], b[-1])
    for level in range(depth - 2, -1, -1):
        under = bad.select("file", F.col("node").alias("parent"))

        def below(nodes: DataFrame, under: DataFrame = under) -> DataFrame:
            up = F.floor(F.col("node") / FANOUT)
            return nodes.withColumn("parent", up).join(under, ["file", "parent"], "left_semi").drop("parent")

        bad = stage(_differing(below(a[level]), below(b[level])))

    def suspects(records: DataFrame) -> DataFrame:
        node = F.floor(F.col("offset") / RANGE_BYTES)
        return records.withColumn("node", node).join(bad, ["file", "node"], "left_semi").drop("node")

    key = ["file", "offset", "record_id"]
    left = suspects(mine).select(*key, "length", "sha256")
    right = suspects(other).select(*key, F.col("length").alias("other_length"), F.col("sha256").alias("other_sha256"))
    status = F.when(F.col("other_sha256").isNull(), "missing").when(F.col("sha256").isNull(), "extra").otherwise("changed")
    found = left.join(right, key, "full").where(~F.col("sha256").eqNullSafe(F.col("other_sha256")))
    return found.select(*key, F.coalesce("length", "other_length").alias("length"), status.alias("status"), "sha256", "other_sha256")


def _raised(roots: DataFrame, levels: int) -> DataFrame:
    """A root level seen from further up, where its node number is 0 and its hash its own."""
    entry = F.concat_ws(" ", F.lit("0"), "hash")
    for _ in range(levels):
        roots = roots.select("file", "node", F.sha2(entry.cast("binary"), 256).alias("hash"))
    return roots


def op5_merkle_fixity(spark, sf_dir):
    """Audit of two replicas of all pages as WARC files.

    The second replica has lost the records of pages whose id leaves 1 divided by 53, and in
    those that leave 0 the first character of the page reads differently. Pages without a page_id have no record id and
    are in neither replica.
    """
    pages = read_table(spark, sf_dir, "pages")
    whole = record_text(F.col("page_id"), F.col("url"), F.col("html"))
    spoilt = record_text(F.col("page_id"), F.col("url"), F.overlay(F.coalesce("html", F.lit("")), F.lit("#"), F.lit(1)))
    hit = F.col("page_id") % 53
    records = pages.select(
        F.format_string("pages-%06d.warc", F.floor(F.col("page_id") / RECORDS_PER_FILE)).alias("file"),
        F.col("page_id").alias("record_id"),
        F.octet_length(whole).cast("bigint").alias("length"),
        F.sha2(whole.cast("binary"), 256).alias("sha256"),
        F.when(hit == 0, F.sha2(spoilt.cast("binary"), 256)).alias("spoilt"),
    ).where(F.col("record_id").isNotNull())
    first = stage(lay_out(records))
    second = first.where(F.col("record_id") % 53 != 1).withColumn("sha256", F.coalesce("spoilt", "sha256"))
    return audit(first, second).withColumnRenamed("record_id", "page_id")


_RECORD = (
    "concat('WARC/1.0', chr(13), chr(10), 'WARC-Type: resource', chr(13), chr(10), 'WARC-Record-ID: <urn:page:', page_id, '>', chr(13), chr(10), "
    "'WARC-Target-URI: ', coalesce(url, ''), chr(13), chr(10), 'Content-Type: text/html', chr(13), chr(10), 'Content-Length: ', "
    "octet_length(encode({body})), chr(13), chr(10), chr(13), chr(10), {body}, chr(13), chr(10), chr(13), chr(10))"
)

OP5_SQL = f"""
    WITH r AS (
        SELECT page_id, printf('pages-%06d.warc', page_id // {RECORDS_PER_FILE}) AS file,
               {_RECORD.format(body="coalesce(html, '')")} AS mine,
               {_RECORD.format(body="concat('#', substr(coalesce(html, ''), 2))")} AS spoilt
        FROM pages),
    l AS (
        SELECT page_id, file, CAST(octet_length(encode(mine)) AS BIGINT) AS length, sha256(mine) AS sha256, sha256(spoilt) AS spoilt FROM r),
    p AS (
        SELECT *, CAST(coalesce(sum(length) OVER (PARTITION BY file ORDER BY page_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS "offset"
        FROM l)
    SELECT file, "offset", page_id, length, CASE page_id % 53 WHEN 1 THEN 'missing' ELSE 'changed' END AS status, sha256,
           CASE page_id % 53 WHEN 0 THEN spoilt END AS other_sha256
    FROM p WHERE page_id % 53 IN (0, 1)
"""
