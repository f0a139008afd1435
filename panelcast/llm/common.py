"""Shared helpers: normalised document input, scratch tables, Arrow plumbing.

Input rules that every operator of this subpackage follows:

* only the named key and text columns are read, so extra columns, also with names that
  an operator gives to its results, never clash;
* a null text counts as the empty text;
* a null doc_id counts as the largest id (``NULL_ID`` inside an operator) and comes out
  as null again;
* repeated rows and repeated ids stay separate rows.
"""
from __future__ import annotations

import ctypes
import gc
import os
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint_dir, ship_package

NULL_ID = 2**63 - 1

#: Texts handed to a Python worker at once; with maxBytesPerBatch this bounds a batch.
ARROW_ROWS = 512


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def prepare(spark: SparkSession) -> None:
    """Bound the Arrow batches of this session (rows; Spark itself bounds the bytes) and
    make this package known to the Python workers."""
    ship_package(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))


def id_in(col: str = "doc_id") -> Column:
    return F.coalesce(F.col(col).cast("long"), F.lit(NULL_ID))


def id_out(col: str = "doc_id") -> Column:
    return F.when(F.col(col) != F.lit(NULL_ID), F.col(col))


def texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id long, text string) without nulls."""
    prepare(docs.sparkSession)
    return docs.select(id_in(id_col).alias("doc_id"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))


def blocks(spark: SparkSession, per_partition: int = 4) -> int:
    """Number of hash blocks: a few per shuffle partition, so that it follows the data
    size the session is set up for."""
    return max(8, per_partition * int(spark.conf.get("spark.sql.shuffle.partitions")))


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder of ``spark.checkpoint.dir``."""
    return os.path.join(checkpoint_dir(spark), f"llm-{name}-{uuid.uuid4().hex[:12]}")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared folder and read back: cuts the lineage, survives lost executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(*tables: DataFrame) -> None:
    """Delete the files of tables from ``stored`` that nothing reads any more."""
    for df in tables:
        spark = df.sparkSession
        for folder in {os.path.dirname(f) for f in df.inputFiles()}:
            path = spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(folder))
            path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def release(spark: SparkSession) -> None:
    """Let Spark drop the shuffle files of finished phases: its cleaner acts when the
    driver's JVM collects the plans that nothing refers to any more. Memory that the driver's
    Python has freed goes back too, where the C library can return it."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)
    spark.sparkContext._jvm.System.gc()


def strings(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a string column, without decoding."""
    return column.cast(pa.binary()).to_pylist()


def grouped(batches: Iterable[pa.RecordBatch], size: int, text: str = "text",
            rows: int = 1 << 30) -> Iterator[pa.Table]:
    """Join or cut incoming batches to tables of about ``size`` text bytes."""
    held: list[pa.RecordBatch] = []
    n = count = 0
    for batch in batches:
        at = 0
        lengths = np.asarray(pc.binary_length(batch.column(text)).fill_null(0))
        ends = np.cumsum(lengths)
        while at < batch.num_rows:
            done = ends[at - 1] if at else 0
            to = int(np.searchsorted(ends, done + max(1, size - n), "left")) + 1
            to = min(to, batch.num_rows, at + rows - count)
            held.append(batch.slice(at, to - at))
            n += int(ends[to - 1] - done)
            count += to - at
            at = to
            if n >= size or count >= rows:
                yield pa.Table.from_batches(held)
                held, n, count = [], 0, 0
    if held:
        yield pa.Table.from_batches(held)
