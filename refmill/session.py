"""Session settings and staging helpers shared by every job."""

from __future__ import annotations

import sys
import tempfile
import uuid

from pyspark import StorageLevel
from pyspark.cloudpickle import register_pickle_by_value
from pyspark.sql import DataFrame, SparkSession

# Defaults for a session this package builds itself; a cluster's own values win.
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # Call sites of every column expression cost more than planning does on wide tables.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(app: str, master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SESSION_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str | None:
    """The shared folder the cluster names for checkpoints, or None."""
    return spark.conf.get("spark.checkpoint.dir", None)


def ship_by_value(module_name: str) -> None:
    """Send the functions of a module to Python workers whole, not as an import.

    Executors need not have this package installed, and the driver may run anywhere.
    """
    register_pickle_by_value(sys.modules[module_name])


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder.

    A machine-local folder would be invisible to the other executors, so it is used
    only where none is set and everything runs in one process, as in tests.
    """
    root = shared_dir(spark)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir is not set; a shared folder is needed to stage data")
        root = tempfile.mkdtemp(prefix="refmill-")
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def spread(df: DataFrame) -> DataFrame:
    """Use all cores where a small unsplittable file would be read and worked on by few.

    A scan that already keeps half of the cores busy, as any large table does, is left alone.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() * 2 < cores else df


def stage(df: DataFrame, rows_per_file: int = 0) -> DataFrame:
    """Materialise a frame that several later actions read.

    With a shared folder it becomes a written table there: the lineage is cut, the
    loss of executors costs nothing, and later steps read only the columns and row
    groups they need, with real sizes for the planner. Without one, in one process as in
    tests, the blocks are persisted; a cluster is refused. ``rows_per_file`` keeps a reader's
    tasks small where rows pack so tightly that a split by bytes would hold tens of millions.
    """
    spark = df.sparkSession
    if not shared_dir(spark):
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir is not set; blocks recomputed after a loss may differ, so data is not staged in them")
        return df.persist(StorageLevel.MEMORY_AND_DISK)
    path = scratch_path(spark, "stage")
    df.write.option("maxRecordsPerFile", rows_per_file).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(spark: SparkSession, path: str) -> None:
    """Delete a folder made under ``scratch_path`` that nothing reads any more."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop, True)
