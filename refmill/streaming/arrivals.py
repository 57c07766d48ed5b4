"""A file lands, a load runs: file-source streams over the landing folders."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..plans import audit as A
from ..plans.load import LoadRules, load_files
from ..plans.publish import Store
from ..sources.files import FILES_DDL, shape_listing
from ..sources.registry import effective_registry

MAX_FILES = 100
ARRIVALS_DDL = "path string, bytes bigint, modified_at timestamp"


def arriving_files(spark: SparkSession, path: str, max_files: int = MAX_FILES, pattern: str = "*") -> DataFrame:
    """Stream of file listings; contents are pruned away unless a consumer selects them."""
    return (
        spark.readStream.format("binaryFile")
        .schema(FILES_DDL)
        .option("maxFilesPerTrigger", max_files)
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", "true")
        .load(path)
    )


def watch_inventory(spark: SparkSession, path: str, table_path: str, checkpoint: str) -> StreamingQuery:
    """Append every arriving file to an inventory table, exactly once."""
    return (
        shape_listing(arriving_files(spark, path))
        .writeStream.format("parquet")
        .outputMode("append")
        .option("path", table_path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def pending(files: DataFrame, registry: DataFrame, history: DataFrame) -> DataFrame:
    """``(dataset_id, path, run_id)`` of files that belong to a dataset and have no finished load.

    The run id is derived from dataset, path, size and modification time, so a batch
    that is replayed after a failure finds the loads it already made. Files below any
    dataset's folder of rejected files are left alone.
    """

    datasets = effective_registry(registry)

    def folders(column: str) -> DataFrame:
        home = F.rtrim(F.regexp_replace(column, "^file:/+", "/"), F.lit("/"))
        return datasets.select("dataset_id", home.alias("home")).where("home <> ''")

    plain = F.regexp_replace("path", "^file:/+", "/")
    # A file belongs to the dataset whose folder is one of its ancestors: an equi-join
    # on each ancestor, not a prefix comparison of every file with every dataset.
    depth = F.size(F.split("plain", "/"))
    placed = (
        files.withColumn("plain", plain)
        .select("*", F.explode(F.sequence(F.lit(1), depth - 1)).alias("level"))
        .withColumn("home", F.expr("substring_index(plain, '/', level)"))
    )
    refused = placed.join(folders("rejected_path").select("home"), "home").select("plain").distinct()
    owned = placed.join(folders("quarantine_path"), "home").join(refused, "plain", "left_anti")
    run_id = F.sha2(F.concat_ws("|", "dataset_id", "plain", "bytes", F.unix_micros("modified_at")), 256)
    done = history.where(F.col("status").isin("SUCCESS", "REJECTED")).select("run_id")
    found = owned.withColumn("run_id", run_id).join(done, "run_id", "left_anti")
    return found.select("dataset_id", F.col("plain").alias("path"), "run_id", "modified_at").distinct()


def load_open(
    store: Store,
    registry: DataFrame,
    rules: Mapping[str, LoadRules],
    on_result: Callable[[dict], None] | None = None,
    at_once: int = 4,
) -> None:
    """Load what has arrived and isn't loaded: new files, failed loads, files whose dataset or rules came later.

    Files of one dataset are loaded in the order they arrived, those in order together; ``at_once`` datasets are
    worked on side by side. A failed load is recorded as ERROR and stays open.
    """
    arrived = store.read_or_empty("arrivals", ARRIVALS_DDL)
    history = A.read_history(store.spark, store.path("history"))
    open_files = pending(arrived, registry, history).where(F.col("dataset_id").isin(list(rules)))
    by_dataset: dict[str, list] = {}
    for item in open_files.orderBy("modified_at", "path").collect():
        by_dataset.setdefault(item["dataset_id"], []).append(item)

    def load(dataset: str) -> None:
        files = [(item["path"], item["run_id"]) for item in by_dataset[dataset]]
        for row in load_files(store, registry, dataset, files, rules[dataset]):
            if on_result:
                on_result(row)

    with ThreadPoolExecutor(at_once) as pool:
        list(pool.map(load, by_dataset))


def watch_landing(
    store: Store,
    registry: DataFrame,
    rules: Mapping[str, LoadRules],
    path: str,
    checkpoint: str,
    max_files: int = MAX_FILES,
    on_result: Callable[[dict], None] | None = None,
) -> StreamingQuery:
    """Load every arriving file; rejects and errors are recorded and do not stop the stream.

    Each micro-batch is first added to the store's arrivals, which loads start from, so
    a file that can't be loaded yet is tried again with later batches, and at the start
    of the next run. The driver sees the paths of open files; the loads run on the cluster.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        store.append("arrivals", batch.select("path", "bytes", "modified_at"))
        load_open(store, registry, rules, on_result)

    load_open(store, registry, rules, on_result)
    return (
        shape_listing(arriving_files(store.spark, path, max_files))
        .writeStream.foreachBatch(run)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
