"""Archives to stage tables, with a manifest of what was written: in batch by dates, or as a stream.

A batch is one write, partitioned by outcome (kept, rejected, failed), date and batch number. Its manifest
rows are made of the written files, few columns and file sizes only, so that archives are read once.
Both writes replace their own batch's partitions and no others, so a batch that is repeated after a
failure doubles neither rows nor manifest rows.

A stage table is what the manifest names: rows of a date's batches since the last one that replaces those
before it. Partitions that no manifest row names, as of a run that was killed, are never read.

    root/<table>/outcome=/date=/batch=   rows, with raw text and reasons where rejected, the error where failed
    root/manifest/table_name=/batch=     STAGE_MANIFEST
    root/runs/table_name=/run=           STAGE_RUNS

Defined results: members without a row leave no trace; archives without a date in their name are left out. A date of
which all members failed, or that has none for the table, is `failed` and stays open. Rows of one batch may come from
several archives of a date.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tapelens.contracts import MEMBER_FAILURES, STAGE_MANIFEST, STAGE_RUNS, Contract
from tapelens.operators.staging import reasons_of, text_columns, typed, with_reasons
from tapelens.sources import zip_csv
from tapelens.sources.files import exists, file_totals, write_partitions

KEPT, REJECTED, FAILED = "kept", "rejected", "failed"
EXAMPLES = 10


def source_schema(contract: Contract) -> str:
    """What the zip source is asked for: a table's columns as text, and what tells where a row is from."""
    cells = ", ".join(f"`{c}` string" for c in text_columns(contract))
    return f"trade_date date, source_file string, raw_group string, row_num_in_file bigint, header array<string>, error string, {cells}"


def stored_schema(contract: Contract) -> StructType:
    return StructType.fromDDL(f"{', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in contract.schema)}, raw string, reasons array<string>, error string, outcome string, batch bigint")


def groups(contract: Contract) -> list[str]:
    return sorted({g for names in contract.groups.values() for g in names})


def judged(rows: DataFrame, contract: Contract) -> DataFrame:
    """Rows of the zip source in stored form: contract columns, raw text and reasons of rejected rows, the error of failed members."""
    mapped = F.lit(False)
    for year, names in contract.groups.items():
        mapped = mapped | (F.year("trade_date") == int(year)) & F.col("raw_group").isin(*names)
    own = rows.where(mapped).withColumnRenamed("trade_date", "date")
    held = with_reasons(typed(own, contract, text_columns(contract), keep=("header", "error")), contract, "header")
    failed, rejected = F.col("error").isNotNull(), F.size("reasons") > 0
    return held.select(
        *[F.col(n) for n in contract.schema.names],
        F.when(~failed & rejected, F.to_json("raw")).alias("raw"),
        F.when(~failed & rejected, F.col("reasons")).alias("reasons"),
        "error",
        F.when(failed, FAILED).when(rejected, REJECTED).otherwise(KEPT).alias("outcome"),
    )


def stored(spark: SparkSession, root: str, contract: Contract) -> DataFrame:
    """All partitions of a table, named or not."""
    path, form = f"{root}/{contract.name}", stored_schema(contract)
    return spark.read.schema(form).parquet(path) if exists(spark, path) else spark.createDataFrame([], form)


def read_manifest(spark: SparkSession, root: str, form: str = STAGE_MANIFEST, name: str = "manifest") -> DataFrame:
    if not exists(spark, f"{root}/{name}"):
        return spark.createDataFrame([], form)
    return spark.read.schema(form).parquet(f"{root}/{name}").select(*StructType.fromDDL(form).names)


def counts_of(rows: DataFrame, contract: Contract) -> DataFrame:
    """Per (date, table_name): rows by outcome, members, failures with examples, null and reason counts, ranges of times. rows: in stored form."""
    kept, rejected = F.col("outcome") == KEPT, F.col("outcome") == REJECTED
    reasons = [r for c in contract.required for r in reasons_of(c).values()]
    at = ["date", "table_name"]
    counted = lambda names, of: F.map_from_arrays(F.array(*map(F.lit, names)), F.array(*[F.count_if(of(n)) for n in names]))
    # Numbers only, which Spark keeps in a hash table of a row a day; for minima of texts it would sort all rows of a task.
    time = F.when(kept, F.col("Time").cast("int"))
    digits = lambda c: F.lpad(c.cast("string"), 6, "0")
    days = rows.groupBy(*at).agg(
        F.count_if(kept | rejected).alias("raw_row_count"),
        F.count_if(kept).alias("row_count"),
        F.count_if(rejected).alias("rejected_row_count"),
        F.count_if((F.col("outcome") != FAILED) & F.col("SendTimeRaw").isNotNull() & F.col("SendTime").isNull()).alias("send_time_parse_failure_count"),
        counted(contract.required, lambda c: rejected & F.col(c).isNull()).alias("required_null_counts"),
        F.map_filter(counted(reasons, lambda r: F.array_contains("reasons", r)), lambda _, n: n > 0).alias("rejection_reason_counts"),
        *[g(F.when(kept, F.col("SendTime"))).alias(c) for c, g in (("min_send_time", F.min), ("max_send_time", F.max))],
        *[digits(g(time)).alias(c) for c, g in (("min_time", F.min), ("max_time", F.max))],
    )
    failed = F.col("outcome") == FAILED
    members = rows.groupBy(*at, "source_file").agg(F.max(failed.cast("int")).alias("failed"))
    members = members.groupBy(*at).agg(F.count_if(F.col("failed") == 0).alias("source_member_count"), F.sum("failed").alias("failed_member_count"))
    # The window's places are limited before its shuffle.
    place = F.dense_rank().over(Window.partitionBy(*at).orderBy("source_file"))
    first = rows.where(failed).select(*at, "source_file", "error").distinct().withColumn("place", place).where(F.col("place") <= EXAMPLES)
    first = first.groupBy(*at, "source_file").agg(F.min("error").alias("error"))
    first = first.groupBy(*at).agg(F.sort_array(F.collect_list(F.struct("source_file", "error"))).alias("failed_member_examples"))
    out = days.join(members, at).join(first, at, "left")
    out = out.withColumn("failed_member_examples", F.coalesce("failed_member_examples", F.array().cast(MEMBER_FAILURES)))
    none = (F.col("row_count") == 0) & (F.col("failed_member_count") > 0)
    status = F.when(none, "failed").when(F.col("failed_member_count") > 0, "completed_with_member_errors").otherwise("completed")
    return out.withColumns({"status": status, "error": F.when(none, F.concat(F.lit("all source members failed; first: "), F.get("failed_member_examples", 0)["error"]))})


def write_batch(rows: DataFrame, contract: Contract, root: str, batch: int, version: str, replaces: bool = False, days: list[dt.date] | None = None) -> DataFrame:
    """Stage rows of the zip source as one batch and record it; returns the batch's manifest rows.

    days: dates that were asked for; one without any member gets a row too.
    """
    spark = rows.sparkSession
    write_partitions(judged(rows, contract).withColumn("batch", F.lit(batch).cast("bigint")), f"{root}/{contract.name}", ["outcome", "date", "batch"])
    mine = stored(spark, root, contract).where(F.col("batch") == batch)
    found = counts_of(mine, contract).join(file_totals(mine, ["date"]), "date", "left")
    if days is not None:
        asked = spark.createDataFrame([(d,) for d in days], "date date")
        found = asked.join(found, "date", "left").withColumns({"error": F.when(F.col("status").isNull(), "no source members").otherwise(F.col("error")), "status": F.coalesce("status", F.lit("failed"))})
    known = {"year": F.year("date"), "table_name": F.lit(contract.name), "batch": F.lit(batch), "replaces": F.lit(replaces), "version": F.lit(version), "generated_at": F.current_timestamp()}
    made = found.withColumns(known).select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in StructType.fromDDL(STAGE_MANIFEST)])
    # One row a date: a file is enough. Its task only gathers them; coalesce would put all work since the last shuffle into it.
    made.repartition(1).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("table_name", "batch").parquet(f"{root}/manifest")
    return read_manifest(spark, root).where((F.col("table_name") == contract.name) & (F.col("batch") == batch))


def current(manifest: DataFrame) -> DataFrame:
    """Manifest rows that count: of each table and date, the last one that replaces those before it, and all after it."""
    since = F.max(F.when(F.col("replaces"), F.col("batch"))).over(Window.partitionBy("table_name", "date"))
    return manifest.withColumn("since", since).where(F.col("since").isNull() | (F.col("batch") >= F.col("since"))).drop("since")


def day_states(manifest: DataFrame) -> DataFrame:
    """Per table and date: rows over its batches, status, and whether a later archive has reopened it."""
    total = ("raw_row_count", "row_count", "rejected_row_count", "source_member_count", "failed_member_count", "output_bytes")
    out = current(manifest).groupBy("table_name", "date").agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in total], F.count("*").alias("batches"), F.count_if(F.col("status") != "failed").alias("good"))
    status = F.when(F.col("good") == 0, "failed").when((F.col("failed_member_count") > 0) | (F.col("good") < F.col("batches")), "completed_with_member_errors").otherwise("completed")
    return out.select("table_name", "date", *total, "batches", (F.col("batches") > 1).alias("reopened"), status.alias("status"))


def named(spark: SparkSession, root: str, contract: Contract, outcome: str) -> DataFrame:
    """Stored rows of the partitions that the manifest names; Spark prunes the others by date and batch when it runs."""
    parts = current(read_manifest(spark, root)).where(F.col("table_name") == contract.name)
    rows = stored(spark, root, contract).where(F.col("outcome") == outcome)
    return rows.join(F.broadcast(parts.select("date", "batch")), ["date", "batch"], "left_semi")  # a row a date and batch


def stage_table(spark: SparkSession, root: str, contract: Contract) -> DataFrame:
    return named(spark, root, contract, KEPT).select(*contract.schema.names)


def quarantine_table(spark: SparkSession, root: str, contract: Contract) -> DataFrame:
    """(date, source_file, row_num_in_file, raw, reasons) of rejected rows."""
    return named(spark, root, contract, REJECTED).select("date", "source_file", "row_num_in_file", "raw", "reasons")


def partition_states(spark: SparkSession, root: str, contract: Contract) -> DataFrame:
    """(date, batch, state) of partitions: named, replaced, stale (its rows are not those recorded) or orphan (no manifest row)."""
    outputs = stored(spark, root, contract).where(F.col("outcome") == KEPT).groupBy("date", "batch").agg(F.count("*").alias("output_rows"))
    rows = read_manifest(spark, root).where(F.col("table_name") == contract.name)
    counts = current(rows).select("date", "batch", F.lit(True).alias("counts"))
    both = rows.select("date", "batch", "row_count", F.lit(True).alias("recorded")).join(counts, ["date", "batch"], "left").join(outputs, ["date", "batch"], "full_outer")
    same = F.coalesce("row_count", F.lit(0)) == F.coalesce("output_rows", F.lit(0))
    state = F.when(F.col("recorded").isNull(), "orphan").when(F.col("counts").isNull(), "replaced").when(same, "named").otherwise("stale")
    return both.select("date", "batch", state.alias("state"))


def _record(spark: SparkSession, root: str, contract: Contract, run: int, dates: list[dt.date], version: str, status: str) -> None:
    row = spark.createDataFrame([(run, contract.name, dates, version, status, dt.datetime.now(dt.UTC).replace(tzinfo=None))], STAGE_RUNS)
    row.coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("table_name", "run").parquet(f"{root}/runs")


def stage_dates(spark: SparkSession, source: str, contract: Contract, root: str, version: str, dates: list[dt.date] | None = None, overwrite: bool = False) -> DataFrame:
    """Stage archives of dates (all, if none are named) that are not finished; returns the manifest rows of this run.

    A finished run may be followed by one of other dates. Raises where a run that did not finish had other
    dates, where finished rows are of another version, or where outputs have no manifest row; not with
    overwrite, which stages all dates anew. A run that did not finish is taken up under its own number. Dates whose
    outputs are gone, or not as recorded, and failed ones are staged anew.
    """
    found = {zip_csv.archive_date(p) for p, _ in zip_csv.archives(source)} - {None}
    chosen = sorted(found if dates is None else set(dates))
    if missing := [str(d) for d in chosen if d not in found]:
        raise ValueError(f"no archive for {', '.join(missing)}")
    last = read_manifest(spark, root, STAGE_RUNS, "runs").where(F.col("table_name") == contract.name).orderBy(F.desc("run")).first()
    resumed = last is not None and last.status == "running"
    if not overwrite and last is not None:
        if resumed and sorted(last.selected_dates) != chosen:
            raise ValueError("a run of other dates did not finish: run it again, or finish it first")
        if last.version != version:
            raise ValueError(f"the last run was of version {last.version}: overwrite, or use another root")
    run = 1 if last is None else last.run if resumed else last.run + 1
    states = partition_states(spark, root, contract).where("state IN ('orphan', 'stale')").collect()  # a row a partition that is not as recorded
    orphans = [f"{s.date}, batch {s.batch}" for s in states if s.state == "orphan" and s.batch != run]
    if orphans and not overwrite:
        raise ValueError(f"outputs without a manifest row: {'; '.join(sorted(orphans)[:10])}")
    stale = {s.date for s in states if s.state == "stale"}
    done = {r.date for r in day_states(read_manifest(spark, root)).where((F.col("table_name") == contract.name) & (F.col("status") != "failed")).select("date").collect()}
    todo = [d for d in chosen if overwrite or d not in done or d in stale]
    _record(spark, root, contract, run, chosen, version, "running")
    rows = zip_csv.scan(spark, source, source_schema(contract), todo, groups(contract))
    made = write_batch(rows, contract, root, run, version, True, todo) if todo else read_manifest(spark, root).limit(0)
    failed = made.where("status = 'failed'").limit(1).count() if todo else 0
    _record(spark, root, contract, run, chosen, version, "completed_with_failures" if failed else "completed")
    return made


def stage_stream(spark: SparkSession, source: str, contract: Contract, root: str, version: str, checkpoint: str) -> None:
    """Stage the archives that have come since the last call, then stop; a batch is the stream's batch, numbered from 1.

    An archive of a date that was staged before adds to it. Use another root than for stage_dates, which numbers its own.
    """
    zip_csv.register(spark)
    rows = spark.readStream.format("zipcsv").schema(source_schema(contract)).option("log", f"{checkpoint}/archives").option("groups", ",".join(groups(contract))).load(source)

    def write(some: DataFrame, number: int) -> None:
        write_batch(some, contract, root, number + 1, version)

    rows.writeStream.foreachBatch(write).option("checkpointLocation", f"{checkpoint}/stream").trigger(availableNow=True).start().awaitTermination()
