"""Versioned live tables, snapshots and publications under one store folder.

    <root>/live/<table>/v=<n>/          immutable versions of a live table
    <root>/snapshots/<table>_history/version_effective_from=<label>/
    <root>/snapshots/<table>_<label>/   dated-table policy
    <root>/publications/                one row per published version; the last one is live
    <root>/history/, <root>/outbox/     load attempts, messages

Readers resolve the live version through ``publications``, so a half-written version
is never seen; the pointer row is written last.
"""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .audit import APPENDING, append_rows, expired_versions, file_system, live_versions

PUBLICATIONS_DDL = """
  dataset_id string, version bigint, label string, path string, `rows` bigint, sha256 string,
  contract_version int, run_id string, published_at timestamp
"""
HISTORY_PARTITION = "history_partition"
LABEL = "version_effective_from"


class Store:
    """Paths and small append-only tables of one store."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def path(self, *parts: str) -> str:
        return "/".join([self.root, *parts])

    def exists(self, path: str) -> bool:
        fs, target = file_system(self.spark, path)
        return fs.exists(target)

    def read_or_empty(self, name: str, ddl: str) -> DataFrame:
        path = self.path(name)
        if not self.exists(path):
            return self.spark.createDataFrame([], ddl)
        return self.spark.read.schema(ddl).parquet(path)

    def remove(self, path: str) -> None:
        """A folder of this store's own, with all in it, if it is there."""
        if not path.startswith(self.root + "/"):
            raise ValueError(f"{path} is not in the store")
        fs, target = file_system(self.spark, path)
        fs.delete(target, True)

    def append(self, name: str, rows: DataFrame) -> None:
        with APPENDING:
            rows.coalesce(1).write.mode("append").parquet(self.path(name))

    # ------------------------------------------------------------------ versions
    def publications(self, dataset_id: str | None = None) -> DataFrame:
        found = self.read_or_empty("publications", PUBLICATIONS_DDL)
        return found if dataset_id is None else found.where(F.col("dataset_id") == dataset_id)

    def latest(self, dataset_id: str) -> dict[str, Any] | None:
        rows = self.publications(dataset_id).orderBy(F.desc("version")).limit(1).collect()
        return rows[0].asDict() if rows else None

    def read_live(self, dataset_id: str) -> DataFrame:
        return self._read(dataset_id, None)

    def read_version(self, dataset_id: str, version: int) -> DataFrame:
        """An earlier version, for rollback or comparison."""
        return self._read(dataset_id, version)

    def _read(self, dataset_id: str, version: int | None) -> DataFrame:
        found = self.publications(dataset_id)
        if version is not None:
            found = found.where(F.col("version") == version)
        rows = found.orderBy(F.desc("version")).limit(1).collect()
        if not rows:
            raise LookupError(f"nothing published for {dataset_id!r}" + (f" v{version}" if version is not None else ""))
        return self.spark.read.parquet(rows[0]["path"])

    def roll_back(self, dataset_id: str, version: int, at: datetime) -> int:
        """Make an earlier version live again by pointing a new publication at its files."""
        old = self.publications(dataset_id).where(F.col("version") == version).limit(1).collect()
        if not old:
            raise LookupError(f"no version {version} of {dataset_id!r}")
        newest = self.latest(dataset_id)
        row = {**old[0].asDict(), "version": newest["version"] + 1, "published_at": at}
        self.publish_pointer(row)
        return row["version"]

    def live(self) -> DataFrame:
        return live_versions(self.publications())

    def expired(self, registry: DataFrame, as_of: Column) -> DataFrame:
        """Versions past retention whose files no live or retained version uses."""
        pubs = self.publications()
        old = expired_versions(pubs, registry.select("dataset_id", "timetravel_retention_days"), as_of)
        gone = old.join(pubs.select("dataset_id", "version", "path"), ["dataset_id", "version"])
        kept = pubs.join(old, ["dataset_id", "version"], "left_anti").select("path").distinct()
        return gone.join(kept, "path", "left_anti")

    # ------------------------------------------------------------------ writes
    def version_path(self, table: str, version: int) -> str:
        return self.path("live", table, f"v={version}")

    def write_versions(self, table: str, df: DataFrame, number: str) -> None:
        """Several versions in one write, each in its folder; folders left by a broken run are replaced, others stay."""
        df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(number).parquet(self.path("live", table))

    def write_version(self, table: str, version: int, df: DataFrame) -> str:
        path = self.version_path(table, version)
        df.write.mode("overwrite").parquet(path)
        return path

    def write_snapshot(self, cfg: Mapping[str, Any], label: str, df: DataFrame) -> str:
        """Snapshot of one label; publishing a label again replaces it, other labels stay."""
        if cfg["snapshot_policy"] == HISTORY_PARTITION:
            writer = df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(LABEL)
            writer.parquet(self.path("snapshots", cfg["history_table"]))
            return f"{cfg['history_table']}::{label}"
        dated = f"{cfg['target_table']}_{label}"
        df.write.mode("overwrite").parquet(self.path("snapshots", dated))
        return dated

    def read_snapshot(self, cfg: Mapping[str, Any], label: str) -> DataFrame:
        if cfg["snapshot_policy"] == HISTORY_PARTITION:
            # A filter on the partition column: only this label's folder is listed.
            return self.spark.read.parquet(self.path("snapshots", cfg["history_table"])).where(F.col(LABEL) == label)
        return self.spark.read.parquet(self.path("snapshots", f"{cfg['target_table']}_{label}"))

    def publish_pointer(self, *rows: Mapping[str, Any]) -> None:
        """Publications lie in folders by dataset, so that finding a dataset's live version reads that folder alone."""
        made = self.spark.createDataFrame([dict(r) for r in rows], PUBLICATIONS_DDL)
        append_rows(self.spark, self.path("publications"), made, "dataset_id")

    def move(self, source: str, target: str) -> None:
        fs, src = file_system(self.spark, source)
        _, dst = file_system(self.spark, target)
        fs.mkdirs(dst.getParent())
        if not fs.rename(src, dst):
            raise OSError(f"could not move {source} to {target}")
