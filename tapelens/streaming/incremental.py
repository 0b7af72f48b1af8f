"""Incremental staging: by manifest in batch, and by a file stream that runs until it has caught up."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapelens.sources.files import append_manifest, write_partitions


def open_tasks(tasks: DataFrame, manifest: DataFrame, key: list[str]) -> DataFrame:
    """Tasks that no manifest row has finished."""
    done = manifest.where(F.col("status").startswith("completed"))
    return tasks.join(done.select(*key).distinct(), key, "left_anti")


def refuse_mismatch(tasks: DataFrame, manifest: DataFrame, key: list[str], version: str) -> None:
    """Raise if rows were made by other code, or if tasks that are not selected now did not finish; finished ones may be followed by others."""
    other = manifest.where(F.col("version") != version).limit(1).count()
    unfinished = manifest.where(~F.col("status").startswith("completed")).join(tasks.select(*key).distinct(), key, "left_anti").limit(1).count()
    if other or unfinished:
        raise ValueError("the manifest is of another run: " + ("its version differs" if other else "it has unfinished tasks that are not selected"))


def stage_batch(rows: DataFrame, manifest: DataFrame | None, data_path: str, manifest_path: str, by: list[str], version: str) -> int:
    """Write the partitions that are not finished, then their manifest rows; returns how many.

    Data goes first: a partition without a manifest row is an orphan, and the next run replaces it.
    """
    tasks = rows.select(*by).distinct()
    todo = open_tasks(tasks, manifest, by) if manifest is not None else tasks
    if not (n := todo.count()):
        return 0
    chosen = rows.join(todo, by, "left_semi")
    write_partitions(chosen, data_path, by)
    append_manifest(chosen.groupBy(*by).agg(F.count("*").alias("row_count")).withColumns({"status": F.lit("completed"), "version": F.lit(version)}), manifest_path)
    return n


def stage_stream(spark: SparkSession, source: str, schema: str, transform: Callable[[DataFrame], DataFrame], data_path: str, checkpoint: str, by: list[str], file_format: str = "parquet", files_per_batch: int = 1000) -> None:
    """Stage the files that have come since the last run, then stop.

    The checkpoint remembers which files are done. A batch writes under its own number, so one that is
    repeated after a failure replaces its own files and no row is doubled.
    """

    def write(batch: DataFrame, number: int) -> None:
        staged = transform(batch).withColumn("batch", F.lit(number))
        write_partitions(staged, data_path, [*by, "batch"])

    stream = spark.readStream.schema(schema).format(file_format).option("maxFilesPerTrigger", files_per_batch).load(source)
    stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
