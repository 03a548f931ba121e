"""Tables in the shared folder, names that clash with nothing, and texts in chunks of bounded size."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import AbstractContextManager

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from lapledger.session import new_path, remove, settings, shuffles_removed

BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
#: Rows that Spark reads from a file at a time; by default 4,096, however large they are.
READ_ROWS = "spark.sql.parquet.columnarReaderBatchSize"
#: How tables with rows of about a megabyte are written: by default a page and a group of rows are looked at after a
#: hundred rows only, and each is in memory as a whole when it is written and read.
LARGE_ROWS = {
    "parquet.block.size": str(1 << 23),
    "parquet.block.size.row.check.min": "1",
    "parquet.page.size.row.check.min": "1",
}
#: Bytes of a table that a task reads to add up its rows in memory, and about the same of what is shuffled then.
SPLIT_BYTES = 1 << 24
SPLITS = ("spark.sql.files.maxPartitionBytes", "spark.sql.adaptive.advisoryPartitionSizeInBytes")
PARTITIONS = "spark.sql.shuffle.partitions"


def rows_per_batch(spark: SparkSession, most: int, read: bool = False) -> AbstractContextManager[None]:
    """Queries that run in this block send their tasks so many rows at a time: for tables with large rows.

    With ``read`` they read no more from a file at a time either.
    """
    rows = {READ_ROWS: str(min(most, int(spark.conf.get(READ_ROWS))))} if read else {}
    return settings(spark, rows | {BATCH_ROWS: str(most)})


def small_tasks(spark: SparkSession, partitions: int) -> AbstractContextManager[None]:
    """Queries that run in this block read and shuffle in tasks of bounded size, ``partitions`` of them at least."""
    in_bytes = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes
    sizes = {name: f"{min(SPLIT_BYTES, in_bytes(spark.conf.get(name)))}b" for name in SPLITS}
    return settings(spark, sizes | {PARTITIONS: str(max(partitions, int(spark.conf.get(PARTITIONS))))})


class Shelf:
    """Tables written on the way, each of which can be removed as soon as nothing reads it any more."""

    def __init__(self, spark: SparkSession, label: str):
        self.spark, self.label, self.paths = spark, label, {}

    def put(self, df: DataFrame, name: str, large: bool = False) -> DataFrame:
        """Write the rows, which may be ``large`` ones, to the shared folder and read them from there: the lineage ends here."""
        path = new_path(self.spark, f"{self.label}-{name}")
        with shuffles_removed(self.spark):
            df.write.options(**(LARGE_ROWS if large else {})).parquet(path)
        self.paths.setdefault(name, []).append(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        """Remove the tables of these names, of all names if none is given."""
        for name in names or list(self.paths):
            for path in self.paths.pop(name, []):
                remove(self.spark, path)

    def drop_older(self, name: str) -> None:
        """Of the tables of this name keep the last one."""
        *old, last = self.paths[name]
        self.paths[name] = old
        self.drop(name)
        self.paths[name] = [last]


#: Bytes of text that a task works on at a time; a longer text is a chunk of its own.
CHUNK_BYTES = 2_000_000


def chunks(batch: pa.RecordBatch, text: str, most: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows with at most ``most`` bytes of text each (or one row)."""
    column = batch.column(batch.schema.get_field_index(text))
    sizes = pa.compute.binary_length(column).fill_null(0).to_pylist()
    start = total = 0
    for row, size in enumerate(sizes):
        if total and total + size > most:
            yield batch.slice(start, row - start)
            start, total = row, 0
        total += size
    if start < batch.num_rows:
        yield batch.slice(start)
