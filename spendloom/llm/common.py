"""What several operators of this subpackage need."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spendloom.session import scratch_folder

ROWS_PER_BATCH = 256  # rows handed to Python at once; texts may be long
BYTES_PER_BATCH = 16 << 20  # a batch ends after the row that reaches this
FREED_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def small_batches(spark: SparkSession) -> None:
    """Hand texts to Python in batches that stay small when texts are long; the session keeps both settings."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BYTES_PER_BATCH))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ROWS_PER_BATCH))


def table(spark: SparkSession, folder: str, name: str, *columns: str) -> DataFrame:
    """The named columns of one of the tables, read whole."""
    return spark.read.parquet(f"{folder}/{name}.parquet").select(*columns)


def written(df: DataFrame, *parts: str) -> DataFrame:
    """The rows, written once to the folder all executors share and read back.

    The job's shuffle files are removed when it ends: later jobs read the table.
    """
    return written_to(scratch_folder(df.sparkSession), df, *parts)


def written_to(path: str, df: DataFrame, *parts: str) -> DataFrame:
    """As ``written``, to a named folder, which can go before the others."""
    spark = df.sparkSession
    before = spark.conf.get(FREED_SHUFFLES)
    spark.conf.set(FREED_SHUFFLES, "true")
    try:
        df.write.option("compression", "zstd").partitionBy(*parts).parquet(path)
    finally:
        spark.conf.set(FREED_SHUFFLES, before)
    return spark.read.schema(df.schema).parquet(path)


def discard(spark: SparkSession, path: str) -> None:
    """Remove a written folder that no later job reads."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def shared_file(spark: SparkSession, content: bytes, name: str) -> str:
    """Hand a small file to every executor; returns the name ``SparkFiles.get`` takes."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{scratch_folder(spark)}-{name}")
    out = path.getFileSystem(spark._jsc.hadoopConfiguration()).create(path)
    for start in range(0, len(content), 1 << 20):
        out.write(bytearray(content[start : start + (1 << 20)]))
    out.close()
    spark.sparkContext.addFile(path.toString())
    return path.getName()


def fold(crc_of: str, modulus: int) -> F.Column:
    """crc32 of a column's text, modulo a number."""
    return F.crc32(F.col(crc_of).cast("string").cast("binary")) % modulus


def texts(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    """A batch's texts; null reads as empty."""
    return [text or "" for text in batch.column(column).to_pylist()]


def runs(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[tuple[object, pa.Table]]:
    """The tables of equal neighbouring keys, in order, from batches sorted by the key."""
    held: list[pa.RecordBatch] = []
    current: object = None
    for batch in batches:
        keys = batch.column(key).to_pylist()
        start = 0
        for i in range(1, len(keys) + 1):
            if i < len(keys) and keys[i] == keys[start]:
                continue
            if held and keys[start] != current:
                yield current, pa.Table.from_batches(held)
                held = []
            current = keys[start]
            held.append(batch.slice(start, i - start))
            start = i
    if held:
        yield current, pa.Table.from_batches(held)
