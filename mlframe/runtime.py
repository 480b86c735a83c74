"""Shared run-time helpers: durable intermediate tables and bounded collects."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Models (centres, weights) travel to tasks in blocks of at most this many doubles (32 MB).
MODEL_BLOCK_VALUES = 4_000_000
# k * d (or d) up to this size is unrolled into one generated expression.  Larger
# models are applied to Arrow batches: at k=10, d=64 that ran 8x faster than
# higher-order functions, and an unrolled form outgrew the JVM's method size.
UNROLL_TERMS = 32
# Whether a query's shuffle files go at its end (Spark 4.1; no effect before).
RELEASE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_local_dirs: dict[str, str] = {}
_paths: dict[int, tuple[DataFrame, str]] = {}


def scratch_dir(spark: SparkSession) -> str:
    """Shared folder for intermediate tables: ``spark.checkpoint.dir`` of the session.

    Only a local session may go without the setting; it then gets a fresh
    temporary folder, because driver and tasks share one machine; it goes with the process.
    """
    sc = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if base:
        return base
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    if sc.applicationId not in _local_dirs:
        _local_dirs[sc.applicationId] = folder = tempfile.mkdtemp(prefix="mlframe-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return _local_dirs[sc.applicationId]


def durable(df: DataFrame, *partition_by: str, release: bool = False) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts the lineage of iterative jobs, survives lost executors, and gives
    Catalyst the true size of the table for its next join decision.  With ``release`` the shuffle files of
    the write go as soon as it ends, not when the driver happens to collect its garbage.
    """
    spark = df.sparkSession
    before = spark.conf.get(RELEASE, None)
    if release:
        spark.conf.set(RELEASE, "true")
    path = f"{scratch_dir(spark).rstrip('/')}/mlframe-{uuid.uuid4().hex}"
    writer = df.write.mode("errorifexists")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    try:
        writer.parquet(path)
    finally:
        if release and before is None:
            spark.conf.unset(RELEASE)
        elif release:
            spark.conf.set(RELEASE, before)
    out = spark.read.schema(df.schema).parquet(path)
    _paths[id(out)] = (out, path)
    return out


def discard(df: DataFrame | None) -> None:
    """Drop the table behind a ``durable`` DataFrame that a later round replaced."""
    if df is None or id(df) not in _paths:
        return
    _, path = _paths.pop(id(df))
    jvm = df.sparkSession._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
    conf = df.sparkSession._jsc.hadoopConfiguration()
    hadoop_path.getFileSystem(conf).delete(hadoop_path, True)


def spread(df: DataFrame) -> DataFrame:
    """Use all cores when the input has fewer partitions than the cluster has slots."""
    slots = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(slots) if df.rdd.getNumPartitions() < slots else df
