"""Session settings the operators rely on, and the shared checkpoint folder.

On a cluster the session is created by the launcher; ``configure`` only sets
SQL options that are safe to change at runtime.  ``local_session`` is for tests
and the benchmark.
"""

from __future__ import annotations

import contextlib
import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Runtime SQL options every job assumes.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # No broadcast from file-size estimates: a side is broadcast only when a
    # probe has measured it (operators.joins.bounded_broadcast) or when AQE
    # has measured the materialised shuffle output at runtime.
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "16MB",
    # Facts that a filtered dimension lacks are dropped before their shuffle, by
    # a Bloom filter of its keys (bounded by maxNumBits); worth it on large scans.
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": "4GB",
    # Folders of a table with thousands of partitions are listed by a few tasks,
    # not by one each.
    "spark.sql.sources.parallelPartitionDiscovery.parallelism": "48",
    # Keep partition values (dates as 'YYYY-MM-DD') typed as STRING on path reads.
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
}


def configure(spark: SparkSession) -> SparkSession:
    for k, v in RUNTIME_CONF.items():
        spark.conf.set(k, v)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by ``spark.checkpoint.dir``.

    The cluster's setting always wins.  Only when it is unset (local tests) is
    a scratch folder created and registered.
    """
    conf = spark.sparkContext.getConf()
    path = conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if path:
        spark.sparkContext.setCheckpointDir(path)
        return path
    if spark.sparkContext.master.startswith("local"):
        path = tempfile.mkdtemp(prefix="cargomart-ckpt-")
        spark.conf.set("spark.checkpoint.dir", path)
        spark.sparkContext.setCheckpointDir(path)
        return path
    raise RuntimeError("spark.checkpoint.dir is not set on this cluster")


def materialize(df):
    """Cut lineage: write ``df`` as Parquet under the shared checkpoint folder
    and continue from the written copy (used where one intermediate feeds
    several branches; later scans prune columns and survive lost executors).
    Without a checkpoint folder on a cluster this raises."""
    spark = df.sparkSession
    base = checkpoint_dir(spark)
    path = f"{base.rstrip('/')}/cargomart-{uuid.uuid4().hex}"
    df.write.mode("error").parquet(path)
    return spark.read.parquet(path)


def scanned_bytes(df) -> int:
    """Bytes of the tables that ``df`` reads, as Spark knows them from listing their files."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    return sum(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))


@contextlib.contextmanager
def shuffles_removed(spark: SparkSession):
    """Within, a query's shuffle files go when it ends, not when the driver
    happens to collect its garbage: for several large writes after each other."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before) if before is not None else spark.conf.unset(name)


def local_session(
    cores: int | str = "*",
    shuffle_partitions: int = 8,
    warehouse: str | None = None,
    app_name: str = "cargomart",
) -> SparkSession:
    """A local session for tests and benchmarks (UI off, UTC, AQE on)."""
    scratch = tempfile.mkdtemp(prefix="cargomart-")
    warehouse = warehouse or os.path.join(scratch, "warehouse")
    b = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.warehouse.dir", warehouse)
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for k, v in RUNTIME_CONF.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)
