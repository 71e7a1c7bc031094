"""Where intermediate tables go: a folder that every executor can reach."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import ExitStack, contextmanager

from pyspark.sql import DataFrame, SparkSession


# Names the folder where a running session has no ``spark.checkpoint.dir``, which can't be set any more.
OWN_SETTING = "lamina.shared.dir"
# Rows of a shuffle partition whose wide rows a task sorts: some 100 MB.
TASK_ROWS = 1 << 17


def shared_root(spark: SparkSession) -> str | None:
    given = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    return given or spark.conf.get(OWN_SETTING, None)


def default_to_warehouse(spark: SparkSession) -> SparkSession:
    """Where no folder is set, intermediate tables go beside the session's warehouse tables.

    The warehouse is shared by definition, so this holds on a cluster too.
    """
    if not shared_root(spark):
        warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
        spark.conf.set(OWN_SETTING, f"{warehouse}/_intermediate")
    return spark


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the cluster's ``spark.checkpoint.dir``, which must be set."""
    root = shared_root(spark)
    if not root:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


@contextmanager
def _set(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    given = spark.conf.get(key)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.set(key, given)


@contextmanager
def finer_tasks(spark: SparkSession, size: str = "16m", rows: int = 0) -> Iterator[None]:
    """Shuffles and files are read meanwhile in parts of ``size`` at most, unless the session wants smaller ones.

    For jobs that make wide rows of narrow ones: Spark judges a task by what it reads, and
    64 MB of compressed keys and numbers become gigabytes of text in its sorts.

    Spark puts small partitions together but never splits one for a window or a bucket.  So where ``rows``
    are to be shuffled, there is a partition for each ``TASK_ROWS`` of them at least, and tasks don't grow with the table.
    Beyond 200 partitions Spark keeps what a task shuffles in memory, hence the smaller parts of files.
    """
    as_bytes = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes
    partitions = "spark.sql.shuffle.partitions"
    wanted = max(int(spark.conf.get(partitions)), -(-rows // TASK_ROWS))
    with ExitStack() as settings:
        for key in ("spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.files.maxPartitionBytes"):
            settings.enter_context(_set(spark, key, min(size, spark.conf.get(key), key=as_bytes)))
        settings.enter_context(_set(spark, partitions, str(wanted)))
        yield


def materialise_by_key(df: DataFrame, name: str, key: str, folder: str | None = None) -> DataFrame:
    """As ``materialise``, in as many buckets of ``key`` as the session has shuffle partitions (see ``finer_tasks``).

    Joins on ``key`` then find the rows where they lie.  Spark keeps buckets in its catalog
    only, which holds the table while it is written; files and the returned rows outlast that.
    """
    spark = df.sparkSession
    path = shared_path(spark, name) if folder is None else f"{folder}/{name}"
    entry = f"lamina_{uuid.uuid4().hex}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    df.write.mode("overwrite").option("path", path).bucketBy(buckets, key).format("parquet").saveAsTable(entry)
    try:
        return spark.table(entry)
    finally:
        spark.sql(f"drop table {entry}")


def materialise(df: DataFrame, name: str, folder: str | None = None, **options: str) -> DataFrame:
    """Writes ``df`` once, with the Parquet ``options``, and reads it back, from ``folder`` or from a fresh shared path.

    Cuts the lineage: what follows neither recomputes ``df`` nor depends on executors
    that computed it, and the optimizer knows the real size.  In a folder of its own a
    run replaces what the last one left.
    """
    path = shared_path(df.sparkSession, name) if folder is None else f"{folder}/{name}"
    df.write.mode("overwrite").options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
