"""Tables that cut lineage: written once to shared storage and read again."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A batch is held several times over, by the JVM, by Arrow and by Python, for each core of an executor.
BATCH_CONF = "spark.sql.execution.arrow.maxBytesPerBatch"
BATCH_BYTES = 2 << 20
#: A table has at most so many files for each core, or one for so many documents if that makes more.
CORE_FILES, FILE_ROWS = 4, 2000


class Folder(str):
    """A folder's path, and how many files a table there has at most."""

    files: int | None = None


def shared_folder(spark: SparkSession) -> Folder:
    """A fresh folder below ``spark.checkpoint.dir``, the storage that driver and executors share."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    return Folder(f"{base.rstrip('/')}/callsheet-{uuid.uuid4().hex}")


def folder_for(docs: DataFrame, folder: str) -> Folder:
    """``folder`` for what is made of ``docs``, a stored table (so that its rows are counted by its files).

    A file on a local disk costs an executor a few forks (Hadoop runs chmod for it, its checksum and its
    task's folder), and at each fork the executor stands twice in the books for a moment.  Few rows in
    many partitions therefore go to fewer files: tasks take some partitions one after another, nothing
    is shuffled for it.  The number grows with the rows and the cores, so large tables are written as they are dealt.
    """
    sized = Folder(folder)
    sized.files = max(CORE_FILES * docs.sparkSession.sparkContext.defaultParallelism, docs.count() // FILE_ROWS)
    return sized


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Arrow batches of at most ``BATCH_BYTES`` for the jobs run inside; the
    session's own setting holds again afterwards."""
    own = spark.conf.get(BATCH_CONF)
    spark.conf.set(BATCH_CONF, str(BATCH_BYTES))
    try:
        yield
    finally:
        spark.conf.set(BATCH_CONF, own)


def keep_small_batches(spark: SparkSession) -> None:
    """Arrow batches of at most ``BATCH_BYTES`` from now on, for rows that are
    computed only when the caller writes them."""
    spark.conf.set(BATCH_CONF, str(BATCH_BYTES))


def stored(df: DataFrame, name: str = "table", folder: str | None = None) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: later reads do not
    recompute it, and see the same rows even after executors were lost."""
    spark = df.sparkSession
    folder = folder or shared_folder(spark)
    path = f"{folder}/{name}"
    files = getattr(folder, "files", None)
    with small_batches(spark):
        (df.coalesce(files) if files else df).write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def row_key(id_column: str = "doc_id", text_column: str = "text") -> Column:
    """Names a row by its id and text: repeated rows share a key (and so a
    result), rows that share only the id do not, and a null id is an id."""
    return F.xxhash64(F.coalesce(F.col(id_column).cast("string"), F.lit("\x00null")),
                      F.coalesce(F.col(text_column), F.lit("")))
