"""Inventories and reconciliation of raw, kept and rejected rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tapelens.functions.columns import path_date


def file_inventory(listing: DataFrame) -> DataFrame:
    """(path, size_bytes, modified_at, suffix, trade_date) of listed files. listing: path, length, modificationTime."""
    suffix = F.coalesce(F.regexp_substr("path", F.lit(r"\.[^./]+$")), F.lit(""))
    return listing.select("path", F.col("length").alias("size_bytes"), F.col("modificationTime").alias("modified_at"), suffix.alias("suffix"), path_date(F.col("path")).alias("trade_date"))


def inventory_rollup(files: DataFrame) -> DataFrame:
    """Files and bytes per date, and in total (is_total); undated files are a row with a null date."""
    out = files.rollup("trade_date").agg(F.grouping("trade_date").alias("g"), F.count("*").alias("file_count"), F.sum("size_bytes").alias("total_bytes"), F.count_if(F.col("size_bytes") == 0).alias("zero_byte_files"), F.count_if(F.col("trade_date").isNull()).alias("undated_files"), F.count_distinct("suffix").alias("suffixes"))
    return out.select("trade_date", (F.col("g") == 1).alias("is_total"), "file_count", "total_bytes", "zero_byte_files", "undated_files", "suffixes")


def inventory_summary(files: DataFrame) -> DataFrame:
    """One row: files and bytes scanned, empty and undated files, the first and last date and how many, files by suffix."""
    whole = files.agg(
        F.count("*").alias("files_scanned"),
        F.coalesce(F.sum("size_bytes"), F.lit(0)).alias("bytes_scanned"),
        F.count_if(F.col("size_bytes") == 0).alias("zero_byte_files"),
        F.count_if(F.col("trade_date").isNull()).alias("unknown_date_files"),
        F.min("trade_date").alias("date_coverage_start"),
        F.max("trade_date").alias("date_coverage_end"),
        F.count_distinct("trade_date").alias("distinct_trade_dates"),
    )
    suffixes = files.groupBy("suffix").agg(F.count("*").alias("n")).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("suffix", "n")))).alias("suffix_counts"))
    return whole.crossJoin(F.broadcast(suffixes))  # one row each


def reconciliation_status(diff: Column, failed: Column, unmapped: Column, rejected: Column) -> Column:
    return F.when((diff != 0) | (failed > 0) | (unmapped > 0), "fail").when(rejected > 0, "warn").otherwise("pass")


def reconcile(partitions: DataFrame, failures: DataFrame, unmapped: DataFrame) -> DataFrame:
    """Raw rows against kept and rejected ones per (year, date, table).

    partitions: raw_row_count, row_count, rejected_row_count, failed_member_count. A failed task
    counts as one failed member. Unmapped members count for every table of their date.
    """
    key = ["year", "date", "table_name"]
    zero = F.lit(0).cast("bigint")
    rows = partitions.select(*key, *[F.col(c).cast("bigint").alias(c) for c in ("raw_row_count", "row_count", "rejected_row_count", "failed_member_count")])
    rows = rows.unionByName(failures.select(*key, zero.alias("raw_row_count"), zero.alias("row_count"), zero.alias("rejected_row_count"), F.lit(1).cast("bigint").alias("failed_member_count")))
    out = rows.groupBy(*key).agg(F.sum("raw_row_count").alias("raw_rows_total"), F.sum("row_count").alias("stage_rows_total"), F.sum("rejected_row_count").alias("rejected_rows_total"), F.sum("failed_member_count").alias("failed_member_count"))
    out = out.join(unmapped.groupBy("date").agg(F.count("*").alias("unmapped_member_count")), "date", "left").withColumn("unmapped_member_count", F.coalesce("unmapped_member_count", zero))
    diff = F.col("raw_rows_total") - F.col("stage_rows_total") - F.col("rejected_rows_total")
    out = out.withColumns({"row_diff": diff, "unmapped_scope": F.when(F.col("unmapped_member_count") > 0, "date_level")})
    return out.withColumn("reconciliation_status", reconciliation_status(F.col("row_diff"), F.col("failed_member_count"), F.col("unmapped_member_count"), F.col("rejected_rows_total")))


def partition_audit(manifest: DataFrame, inventory: DataFrame) -> DataFrame:
    """The manifest with the groups that fed each partition, sorted."""
    groups = inventory.select("date", F.explode("mapped_tables").alias("table_name"), "raw_group")
    return manifest.join(groups.groupBy("date", "table_name").agg(F.sort_array(F.collect_set("raw_group")).alias("source_groups")), ["date", "table_name"], "left")


def flatten_groups(inventory: DataFrame) -> DataFrame:
    """A row for each group and table it feeds, or one unmapped row."""
    out = inventory.withColumn("table_name", F.explode_outer("mapped_tables"))
    return out.select("year", "date", "table_name", F.col("raw_group").alias("source_group"), F.col("csv_member_count").alias("member_count"), F.when(F.col("table_name").isNull(), "unmapped").otherwise("mapped").alias("mapped_status"), "example_member", "skip_reason")


def failure_type(reason: Column) -> Column:
    return F.when(reason.rlike("^(missing_required_column|null_required_input):"), "required_missing").when(reason.rlike("^(cast_failed_required|invalid_required_format):"), "cast_failed").otherwise("unknown")


def failure_ledger(rejections: DataFrame, parse_failures: DataFrame, member_failures: DataFrame, task_failures: DataFrame, unmapped: DataFrame) -> DataFrame:
    """All that went wrong, in one form.

    rejections: date, table_name, reason, n. parse_failures: date, table_name, n. member_failures:
    date, table_name, source_file, error. task_failures: date, table_name, error. unmapped: date,
    source_file, raw_group.
    """
    none = F.lit(None).cast("string")

    def form(df: DataFrame, kind: Column, n: Column, table: Column, file: Column, sample: Column, notes: Column) -> DataFrame:
        return df.select("date", table.alias("table_name"), file.alias("source_file"), kind.alias("failure_type"), n.cast("bigint").alias("failure_count"), sample.alias("sample_value"), notes.alias("notes"))

    col, one = F.col, F.lit(1)
    parts = [
        form(rejections, failure_type(col("reason")), col("n"), col("table_name"), none, none, col("reason")),
        form(parse_failures.where("n > 0"), F.lit("sendtime_parse_failed"), col("n"), col("table_name"), none, none, none),
        form(member_failures, F.lit("member_failed"), one, col("table_name"), col("source_file"), col("error"), none),
        form(task_failures, F.lit("task_failed"), one, col("table_name"), none, col("error"), none),
        form(unmapped, F.lit("unmapped_source_member"), one, none, col("source_file"), col("raw_group"), none),
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def members_of(rows: DataFrame) -> DataFrame:
    """(date, raw_group, source_file, columns, row_count, min_time, max_time) of members read by the zip source.

    A member's rows have the same header, so the first row's is taken; failed members have none.
    """
    good = rows.where("error IS NULL")
    header = F.min_by(F.sort_array(F.map_keys("cells")), "row_num_in_file")
    time = F.try_element_at("cells", F.lit("Time"))
    return good.groupBy(F.col("trade_date").alias("date"), "raw_group", "source_file").agg(header.alias("columns"), F.count("*").alias("row_count"), F.min(time).alias("min_time"), F.max(time).alias("max_time"))


def member_profile(members: DataFrame) -> DataFrame:
    """Per member: rows, columns, a hash of them, which table they are like, time range. members: date, raw_group, source_file, columns, row_count, min_time, max_time."""
    from tapelens.contracts import ORDERS, TRADES

    only = lambda a, b: F.array(*[F.lit(n) for n, _ in a.columns if n not in dict(b.columns)])
    like = lambda marks: F.size(F.array_intersect("columns", marks))
    as_orders, as_trades = like(only(ORDERS, TRADES)), like(only(TRADES, ORDERS))
    hint = F.when(as_orders > as_trades, "orders").when(as_trades > as_orders, "trades").otherwise("unknown")
    return members.withColumns({"schema_hash": F.sha1(F.array_join("columns", ",")), "table_hint": hint, "column_count": F.size("columns"), "has_time": F.array_contains("columns", "Time"), "has_sendtime": F.array_contains("columns", "SendTime")})


def group_profile(profiles: DataFrame, by: list[str]) -> DataFrame:
    """Per group of members: members, rows, schema variants, hints, time range, first ten examples."""
    place = F.dense_rank().over(Window.partitionBy(*by).orderBy("source_file"))
    first = profiles.select(*by, "source_file").withColumn("place", place).where("place <= 10").groupBy(*by).agg(F.sort_array(F.collect_set("source_file")).alias("examples"))
    out = profiles.groupBy(*by).agg(
        F.count("*").alias("member_count"),
        F.sum("row_count").alias("row_count"),
        F.count_distinct("schema_hash").alias("schema_count"),
        F.array_join(F.sort_array(F.collect_set("table_hint")), ",").alias("table_hints"),
        F.min("min_time").alias("min_time"),
        F.max("max_time").alias("max_time"),
    )
    return out.join(first, by, "left")


def schema_totals(profiles: DataFrame) -> DataFrame:
    """Per schema, over all groups: its table hint, members, rows and groups."""
    return profiles.groupBy("schema_hash", "table_hint", "column_count").agg(F.count("*").alias("member_count"), F.sum("row_count").alias("row_count"), F.count_distinct("raw_group").alias("group_count"))
