"""Session settings shared by the entry points, and the shared folder that long jobs write to."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import AbstractContextManager, contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"
#: Asks Spark to remove what a query has shuffled as soon as it ends, as a written table needs no shuffle files behind
#: it. Where Spark does not act on it, they go when the driver collects its garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Off, rows that lie by some of a join's keys meet where they lie, as by name for a join on name and date.
ALL_KEYS = "spark.sql.requireAllClusterKeysForCoPartition"
#: Off, operators hand rows on one by one. Code made for a whole stage of rows this wide has methods too long to be
#: compiled well.
WHOLE_STAGE = "spark.sql.codegen.wholeStage"
#: Files that a task may write at a time. Rows go to the buckets and folders they belong to as they come; only where a
#: task has rows of more of these are they sorted by them first.
WRITERS = {"spark.sql.maxConcurrentOutputFileWriters": "24"}
#: How settled tables are compressed: in less space than by default, for a little more time.
SMALL = {"compression": "zstd"}
#: Paths and tables settled in each open block of ``settled_for_now``.
_FOR_NOW: list[list[tuple[str, str | None]]] = []


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach, named by the cluster in ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder; a cluster without it is
    an error, since a folder on one machine is lost with that machine.
    """
    named = spark.conf.get(CHECKPOINT_SETTING, None)
    if named:
        return named
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_SETTING} to a folder that every executor can reach")
    folder = tempfile.mkdtemp(prefix="lapledger-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder  # getCheckpointDir names it from now on


def new_path(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that no other run uses."""
    return f"{shared_folder(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def remove(spark: SparkSession, path: str) -> None:
    """Delete what a job has written there."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Values of Spark's settings for the queries that run in this block."""
    before = {name: spark.conf.get(name, None) for name in values}
    for name, value in values.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def shuffles_removed(spark: SparkSession) -> AbstractContextManager[None]:
    """Queries that end in this block, which write tables or files, need to leave no shuffle files."""
    return settings(spark, {CLEANUP: "true"})


def wide_rows_written(spark: SparkSession) -> AbstractContextManager[None]:
    """For queries that end in this block with tables of many columns."""
    return settings(spark, {CLEANUP: "true", ALL_KEYS: "false", WHOLE_STAGE: "false", **WRITERS})


@contextmanager
def settled_for_now(spark: SparkSession) -> Iterator[None]:
    """Tables that are settled in this block go at its end: nothing that is left after it may read them.

    A block may end before one that began later; what is settled then belongs to the latest that is open.
    """
    mine: list[tuple[str, str | None]] = []
    _FOR_NOW.append(mine)
    try:
        yield
    finally:
        _FOR_NOW[:] = [block for block in _FOR_NOW if block is not mine]
        for path, table in mine:
            if table is not None:
                spark.sql(f"drop table if exists {table}")
            remove(spark, path)


def save_buckets(df: DataFrame, path: str, buckets: int, by: str, partition: str | None = None) -> str:
    """Write the rows so that later steps find equal values of ``by`` together, without a shuffle; the table's name.

    Rows that lie by this column in as many tasks are written from where they are. Spark knows of buckets from its
    catalog only, so the files at ``path`` are a table there as long as the session lasts.
    """
    spark = df.sparkSession
    table = f"lapledger_{uuid.uuid4().hex}"
    writer = df.write.format("parquet").options(**SMALL).option("path", path).bucketBy(buckets, by)
    with wide_rows_written(spark):
        (writer if partition is None else writer.partitionBy(partition)).saveAsTable(table)
    return table


def settle(df: DataFrame, buckets: int | None = None, by: str = "name") -> DataFrame:
    """Cut the lineage: the rows are written to the shared folder once and later steps read them there.

    Parquet lets each later step read only its columns and tells Spark the size for its joins. What
    Spark inferred about the columns on the way is cut as well, which a checkpoint would keep and the
    optimizer would work through again at every step. With ``buckets`` the rows lie by a column.
    """
    spark = df.sparkSession
    path, table = new_path(spark, "settled"), None
    if buckets is None:
        with wide_rows_written(spark):
            df.write.options(**SMALL).parquet(path)
    else:
        table = save_buckets(df, path, buckets, by)
    if _FOR_NOW:
        _FOR_NOW[-1].append((path, table))
    return spark.read.schema(df.schema).parquet(path) if table is None else spark.table(table)
