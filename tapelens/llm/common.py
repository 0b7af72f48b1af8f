"""What the operators of this subpackage share: durable intermediate tables and text blocks."""

from __future__ import annotations

import ctypes
import gc
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The characters that end a word; bytes.split() splits at exactly these.
WHITESPACE = b" \t\n\x0b\x0c\r"
BATCH = 4 << 20
WORD = r"[^\x20\x09-\x0D]+"
#: A key is hot with more than a SHARE-th of the rows, and LEAST_HOT at least.
SHARE, LEAST_HOT = 1_000, 1_000


def durable(df: DataFrame) -> DataFrame:
    """Cut the lineage with a checkpoint in the session's shared folder.

    Only a local session without spark.checkpoint.dir (a test) gets a folder made here. Spark deletes a checkpoint
    once its DataFrame is gone where spark.cleaner.referenceTracking.cleanCheckpoints is true.
    """
    spark = df.sparkSession
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(spark))
    return df.checkpoint()


def reclaim(spark: SparkSession) -> None:
    """Have Spark delete shuffles and checkpoints that nothing uses any more.

    It deletes them once the driver has collected their plans as garbage, which can take until its heap is full.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share; a new local one in a local session that names none."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder and not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return folder or tempfile.mkdtemp(prefix="spark-shared-")


def shuffle_partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def blocks(batches: Iterator[pa.RecordBatch], column: str, limit: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Row slices with about `limit` bytes of text each; a longer text is a block of its own."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes, dtype=np.int64)
        start = 0
        while start < batch.num_rows:
            before = int(ends[start - 1]) if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + limit, "right")))
            yield batch.slice(start, stop - start)
            start = stop
    release()


def release() -> None:
    """Give freed memory back to the system: a Python worker stays for other stages, and its memory with it.

    Numpy's arrays come from the C library, which keeps what is freed in the middle of its heap until it is asked.
    """
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):  # glibc only
        trim(0)


def utf8(batch: pa.RecordBatch, column: str) -> list[bytes]:
    """The texts as UTF-8; a null is empty."""
    return [x or b"" for x in batch.column(column).cast(pa.binary()).to_pylist()]


def remainder(id_column: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo `modulus`; null for a null id."""
    return F.crc32(F.col(id_column).cast("string").cast("binary")) % modulus


def small_batches(spark: SparkSession) -> None:
    """Hand texts to Python in batches of BATCH bytes, unless the session has a limit of its own.

    Spark's default lets a batch grow to 64 MB, which it holds several times over for each task. The setting is read
    when a plan runs, after an operator has returned it, so it stays for the session.
    """
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(key) in ("64MB", "67108864", "67108864b"):
        spark.conf.set(key, str(BATCH))


def slim(docs: DataFrame, *columns: str) -> DataFrame:
    """Only these columns, so that others cannot clash with what an operator adds."""
    small_batches(docs.sparkSession)
    return docs.select(*[docs[c] for c in columns])


def schema_of(docs: DataFrame, column: str, name: str | None = None) -> str:
    """The DDL of a column, for the schema of a Python stage."""
    return f"`{name or column}` {docs.schema[column].dataType.simpleString()}"


def bounded(table: DataFrame, rows: int = 500_000) -> DataFrame:
    """A durable table of narrow rows, to be broadcast if it has at most so many rows; else Spark shuffles it."""
    return F.broadcast(table) if table.limit(rows + 1).count() <= rows else table


def lookup(rows: DataFrame, table: DataFrame, on: list[str], n_col: str, total: int, how: str = "inner") -> DataFrame:
    """Join rows with a table of one row a key (inner or left), whose n_col says how many of the `total` rows have the key.

    Keys of more than a SHARE-th of the rows would each fill a task. There are fewer than SHARE of them, so their part
    of the table is broadcast and their rows stay where they are; the other rows are shuffled. Keys are not null.
    n_col is left out. Both sides are read twice, so they should be durable.
    """
    hot = F.col(n_col) > max(LEAST_HOT, total // SHARE)
    few = table.where(hot).drop(n_col)
    rest = rows.join(F.broadcast(few.select(*on)), on, "left_anti")
    return rows.join(F.broadcast(few), on).unionByName(rest.join(table.where(~hot).drop(n_col), on, how))


def free(df: DataFrame, name: str) -> str:
    """`name`, with underscores before it until no column is called so."""
    while name in df.columns:
        name = f"_{name}"
    return name


def by_id(docs: DataFrame, id_col: str, ids: DataFrame, how: str) -> DataFrame:
    """The documents whose id is (left_semi) or is not (left_anti) in a durable table of ids; nulls are equal."""
    key = free(docs, "id_wanted")
    return docs.join(bounded(ids.toDF(key)), docs[id_col].eqNullSafe(F.col(key)), how)


def frequent(counts: DataFrame, most: int) -> DataFrame:
    """The rows of the highest counts `n`, at most so many; rows of nearly equal counts stay or go together.

    Counts are first summed in classes an eighth of an octave wide, a few hundred rows, to find from
    which class on the rows are few enough, so that a driver-side top-k is not needed.
    """
    octave = F.floor(F.log2("n") * 8).cast("int")
    least, total = None, 0
    for row in counts.groupBy(octave.alias("octave")).count().orderBy(F.desc("octave")).collect():
        total += row["count"]
        if total > most:
            break
        least = row["octave"]
    return counts.where(F.lit(False) if least is None else octave >= least)
