"""Listings, native readers and file hashes."""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from itertools import accumulate

import pandas as pd
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..session import discard, scratch_path, ship_by_value
from . import ranges

# Largest file whose bytes are taken as one row; larger ones are read in pieces, so a task needs little memory.
MAX_CONTENT = 16 << 20
_PIECE = 8 << 20
# JSON files of a drop from which its documents are put together first: Spark's reader of whole files finds the fields
# in one task, and goes back into the file for each number it keeps as text.
MANY_DOCUMENTS = 32
_RECORD_SEPARATOR = "\x1e"  # legal nowhere in JSON

ship_by_value(__name__)

FILES_DDL = "path string, modificationTime timestamp, length bigint, content binary"


def listing(spark: SparkSession, path: str, recursive: bool = True) -> DataFrame:
    """``files(path, folder, name, bytes, modified_at)``; file contents are never read."""
    raw = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower()).load(path)
    return shape_listing(raw)


def shape_listing(raw: DataFrame) -> DataFrame:
    folder = F.regexp_replace("path", "/[^/]*$", "")
    return raw.select(
        "path",
        folder.alias("folder"),
        F.element_at(F.split("path", "/"), -1).alias("name"),
        F.col("length").alias("bytes"),
        F.col("modificationTime").alias("modified_at"),
    )


def content_hash(content: Column) -> Column:
    return F.sha2(content, 256)


def _hash_in_pieces(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Hashes of files read piece by piece in constant memory, from any file system Arrow knows."""
    import hashlib

    from pyarrow import fs

    for batch in batches:
        found = []
        for path in batch["path"]:
            system, place = fs.FileSystem.from_uri(re.sub("^file:/+", "file:///", path))
            digest = hashlib.sha256()
            with system.open_input_stream(place) as stream:
                while piece := stream.read(_PIECE):
                    digest.update(piece)
            found.append(digest.hexdigest())
        yield batch.assign(sha256=found)


def hash_files(spark: SparkSession, path: str | list[str], max_content: int = MAX_CONTENT) -> DataFrame:
    """``(path, name, bytes, sha256)`` of all files below ``path``, of any size.

    One task reads one file at a time, so hashing spreads over the files. Files of over
    ``max_content`` bytes are streamed through the digest, from any file system Arrow knows.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    name = F.element_at(F.split("path", "/"), -1).alias("name")
    small = files.where(F.col("length") <= max_content).select(
        "path", name, F.col("length").alias("bytes"), content_hash(F.col("content")).alias("sha256")
    )
    large = files.where(F.col("length") > max_content).select("path", name, F.col("length").alias("bytes"))
    return small.unionByName(large.mapInPandas(_hash_in_pieces, "path string, name string, bytes bigint, sha256 string"))


def _place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Copies each part to its place in the whole; a task that runs again writes the same bytes."""
    import shutil

    for batch in batches:
        for part, whole, start in zip(batch["part"], batch["whole"], batch["start"]):
            with open(part, "rb") as source, open(whole, "r+b") as target:
                target.seek(int(start))
                shutil.copyfileobj(source, target, _PIECE)
        yield batch


def join_parts(spark: SparkSession, folder: str, path: str) -> None:
    """One file of the part files a write left in ``folder``, in their order, without a task that holds or reads them all.

    On a mounted file system tasks copy the parts to their places side by side; others are asked to join them (``concat``).
    """
    place = spark._jvm.org.apache.hadoop.fs.Path(folder)
    system = place.getFileSystem(spark._jsc.hadoopConfiguration())
    listed = [(s.getPath(), s.getLen()) for s in system.listStatus(place) if s.getLen() and s.getPath().getName().startswith("part-")]
    listed.sort(key=lambda p: int(p[0].getName().split("-")[1]))
    if system.getUri().getScheme() != "file":
        first, *rest = [p for p, _ in listed]
        if rest:
            parts = spark._sc._gateway.new_array(spark._jvm.org.apache.hadoop.fs.Path, len(rest))
            for i, p in enumerate(rest):
                parts[i] = p
            system.concat(first, parts)
        target = spark._jvm.org.apache.hadoop.fs.Path(path)
        system.mkdirs(target.getParent())
        system.rename(first, target)
        return
    whole = spark._jvm.org.apache.hadoop.fs.Path(path).toUri().getPath()
    os.makedirs(os.path.dirname(whole), exist_ok=True)
    open(whole, "wb").close()
    starts = [0, *accumulate(n for _, n in listed)]
    rows = [(p.toUri().getPath(), whole, start) for (p, _), start in zip(listed, starts)]
    if rows:
        kind = "part string, whole string, start bigint"
        spark.createDataFrame(rows, kind).repartition(len(rows)).mapInPandas(_place, kind).count()


def read_csv(spark: SparkSession, path: str, split_from: int = ranges.SPLIT_FROM, null_value: str = "") -> DataFrame:
    """Header row, every column text; types come later, from the contract.

    Quoted values may hold line breaks and doubled quotes. Nothing between commas is null; a quoted empty value is null too,
    unless ``null_value`` names another mark for null. Drops of ``split_from`` bytes or more are read by as many
    tasks as they have ranges, smaller ones a file a task, with the same result.
    """
    reader = spark.read.option("header", True).option("inferSchema", False).option("multiLine", True)
    whole = reader.option("escape", '"').option("nullValue", null_value).csv(path)
    return ranges.read_csv_ranges(spark, path, whole.columns, null_value) if _splits(spark, path, split_from) else whole


def read_json(spark: SparkSession, path: str, split_from: int = ranges.SPLIT_FROM, many_from: int = MANY_DOCUMENTS) -> DataFrame:
    """Multi-line documents, every primitive as text; fields arrive sorted by name.

    Drops of ``many_from`` files or more, none large, have their documents put together first; other large drops are split as in ``read_csv``.
    """
    reader = spark.read.option("primitivesAsString", True)
    together = _documents_together(spark, path) if ranges.drop_files(spark, path) >= many_from else None
    if together:
        return reader.option("lineSep", _RECORD_SEPARATOR).json(together)
    if _splits(spark, path, split_from):
        return ranges.read_json_ranges(spark, path)
    return reader.option("multiLine", True).json(path)


def _documents_together(spark: SparkSession, path: str) -> str | None:
    """The drop's documents as they are, each opened once, in as many text files as tasks read them.

    None for drops that need another reader: in folders that stand for columns, with a file beyond ``MAX_CONTENT``, or with
    one that isn't plain UTF-8 (packed files, other encodings, a separator within).
    """
    files = spark.read.format("binaryFile").load(path)
    if set(files.columns) != {"path", "modificationTime", "length", "content"}:
        return None
    if (files.agg(F.max("length")).first()[0] or MAX_CONTENT + 1) > MAX_CONTENT:
        return None
    value, seen, together = F.col("value"), Observation(), scratch_path(spark, "documents")
    # JSON in UTF-16 or UTF-32 has a zero among its first four bytes
    plain = F.is_valid_utf8(value) & ~F.substring(value, 1, 4).contains("\0") & ~value.contains(_RECORD_SEPARATOR)
    unmarked = F.when(value.startswith("\ufeff"), F.expr("substring(value, 2)")).otherwise(value)
    texts = files.select(F.col("content").cast("string").alias("value")).observe(seen, F.count_if(~plain).alias("other"))
    texts.select(unmarked.alias("value")).write.option("lineSep", _RECORD_SEPARATOR).text(together)
    if seen.get["other"]:
        discard(spark, together)
        return None
    return together


def _splits(spark: SparkSession, path: str, split_from: int) -> bool:
    """Whether a drop is large enough; folders that stand for columns are left to Spark's reader of whole files."""
    return ranges.drop_bytes(spark, path) >= split_from and spark.read.text(path).columns == ["value"]


def read_native(spark: SparkSession, source_format: str, path: str) -> DataFrame:
    """Readers by registry format; an unknown one is an extract failure for the caller to record."""
    if source_format == "csv":
        return read_csv(spark, path)
    if source_format == "json":
        return read_json(spark, path)
    if source_format == "parquet":
        return spark.read.parquet(path)
    raise ValueError(f"unsupported source_format {source_format!r}")
