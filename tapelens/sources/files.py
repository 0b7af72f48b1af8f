"""Scans and sinks of plain files: listings, seeds, code lists, partitions, manifests."""

from __future__ import annotations

import posixpath
import re
import tempfile
import uuid
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tapelens.contracts import SEED_NULL_TOKENS
from tapelens.functions.columns import null_tokens, zero_pad


def listing(spark: SparkSession, root: str) -> DataFrame:
    """(path, length, modificationTime) of all files below a folder; contents are not read.

    Lists on the driver with the folder's own file system, as Spark does before a scan. Spark's scans
    leave out empty files, which an inventory must count.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    found, rows = path.getFileSystem(spark._jsc.hadoopConfiguration()).listFiles(path, True), []
    while found.hasNext():
        f = found.next()
        rows.append((f.getPath().toString(), f.getLen(), f.getModificationTime()))
    files = spark.createDataFrame(rows, "path string, length bigint, millis bigint")
    return files.select("path", "length", F.timestamp_millis("millis").alias("modificationTime"))


def tree(spark: SparkSession, root: str) -> DataFrame:
    """(path, length, modificationTime) of all files below a folder, empty ones too; contents are not read.

    The driver asks for the folder's own entries and holds a row for each folder among them; each is listed, with all
    below it, in a task, and so are the folder's own files. root: a URI of any file system that pyarrow opens, else a path
    that all executors see; paths are named as root is. A folder that is not there is an error.
    """
    system, inside = fs.FileSystem.from_uri(root if re.match(r"[a-z0-9+.-]+:", root) else str(Path(root).absolute()))
    folders = [f.path for f in system.get_file_info(fs.FileSelector(inside)) if f.type == fs.FileType.Directory]
    jobs = spark.createDataFrame([(inside, False), *[(f, True) for f in folders]], "folder string, below boolean").repartition(min(1 + len(folders), 10_000))
    prefix, bare = root.rstrip("/"), inside.rstrip("/")

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here = fs.FileSystem.from_uri(root if re.match(r"[a-z0-9+.-]+:", root) else bare)[0]
        for batch in batches:
            for job in batch.to_pylist():
                found = [f for f in here.get_file_info(fs.FileSelector(job["folder"], recursive=job["below"])) if f.type == fs.FileType.File]
                times = pa.array([(f.mtime_ns or 0) // 1000 for f in found], pa.timestamp("us", "UTC"))
                yield pa.RecordBatch.from_arrays([pa.array([prefix + f.path.removeprefix(bare) for f in found], pa.string()), pa.array([f.size for f in found], pa.int64()), times], names=["path", "length", "modificationTime"])

    return jobs.mapInArrow(listed, "path string, length bigint, modificationTime timestamp")


def exists(spark: SparkSession, path: str) -> bool:
    """Whether there is such a file or folder, in the path's own file system."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder's name in the folder that driver and executors share; a local one in a local session that names none."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder and not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return posixpath.join(folder or tempfile.mkdtemp(prefix="spark-shared-"), f"{name}-{uuid.uuid4().hex}")


def text_csv(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """CSV with all cells as text and null tokens as nulls. Without a stable row number; the zip source has one."""
    reader = spark.read.option("header", True).option("inferSchema", False)
    if columns:
        reader = reader.schema(StructType([StructField(c, StringType()) for c in columns]))
    rows = reader.csv(path)
    return rows.select(*[null_tokens(F.col(f"`{c}`"), SEED_NULL_TOKENS).alias(c) for c in rows.columns])


def code_list(lines: DataFrame, column: str = "value") -> DataFrame:
    """(code): the first comma field of each line; digits get four places."""
    first = F.trim(F.element_at(F.split(column, ","), 1))
    code = F.when(first.rlike("^[0-9]+$"), zero_pad(first, 4)).otherwise(first)
    return lines.select(code.alias("code")).where("code <> ''").distinct()


def select_dates(df: DataFrame, dates: list[str] | None = None, between: tuple[str, str] | None = None, first: int | None = None, latest: int | None = None, batch: tuple[int, int] | None = None, column: str = "date") -> DataFrame:
    """Rows of chosen dates: a list, a range, the first or latest n, or batch i (from 1) of n dates. Dates are numbered over their distinct values.

    The n dates of a number come to the driver first, so that a table partitioned by date is read in those partitions only. Null
    dates are never chosen.
    """
    rows = df
    if dates:
        rows = rows.where(F.col(column).isin([F.lit(d).cast("date") for d in dates]))
    if between:
        rows = rows.where(F.col(column).between(*[F.lit(d).cast("date") for d in between]))
    if not (first or latest or batch):
        return rows
    days = rows.where(F.col(column).isNotNull()).select(column).distinct()
    if batch:
        number, size = batch
        days = days.orderBy(column).offset((number - 1) * size).limit(size)
    else:
        days = days.orderBy(F.asc(column) if first else F.desc(column)).limit(first or latest)
    return rows.where(F.col(column).isin([r[0] for r in days.collect()]))  # at most as many dates as asked for


def common_dates(left: DataFrame, right: DataFrame, column: str = "date") -> DataFrame:
    return left.select(column).intersect(right.select(column))


def file_totals(rows: DataFrame, by: list[str]) -> DataFrame:
    """(by, output_rows, output_files, output_bytes) of rows as they are read from files; only the columns of `by` are read."""
    files = rows.groupBy(*by, F.col("_metadata.file_path").alias("file")).agg(F.max("_metadata.file_size").alias("bytes"), F.count("*").alias("n"))
    return files.groupBy(*by).agg(F.sum("n").alias("output_rows"), F.count("*").alias("output_files"), F.sum("bytes").alias("output_bytes"))


def write_partitions(df: DataFrame, path: str, by: list[str]) -> None:
    """Replace the partitions that df has; others stay. Spark commits a write as a whole.

    Rows are rebalanced by partition: small ones share a task, a heavy one is split over tasks and files.
    """
    df.hint("rebalance", *by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "zstd").partitionBy(*by).parquet(path)


def append_manifest(df: DataFrame, path: str) -> None:
    df.write.mode("append").json(path)


def read_manifest(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).json(path)


def manifest_to_parquet(spark: SparkSession, source: str, schema: str, target: str) -> None:
    """Make a Parquet table of JSON lines."""
    read_manifest(spark, source, schema).write.mode("overwrite").option("compression", "zstd").parquet(target)
