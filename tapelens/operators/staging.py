"""Typed staging of all-text rows: projection, rejection and the partition manifest."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapelens.contracts import CONTRACTS, Contract
from tapelens.functions.columns import epoch_ns, ns_timestamp, null_tokens, stage_time

DERIVED = {"SendTimeRaw": "SendTime", "SendTimeNs": "SendTime"}


def _source(contract_column: str) -> str:
    return DERIVED.get(contract_column, contract_column)


def _typed(name: str, kind: str, present: set[str]) -> Column:
    source = _source(name)
    if source not in present:
        return F.lit(None).cast(kind)
    raw = F.col(f"raw.{source}")
    if name == "Time":
        return stage_time(raw)
    if name == "SendTimeRaw":
        return null_tokens(raw)
    if name == "SendTimeNs":
        return epoch_ns(raw)
    if name == "SendTime":
        return ns_timestamp(epoch_ns(raw))
    return null_tokens(raw).try_cast(kind)


def text_columns(contract: Contract) -> list[str]:
    """The columns of a member that the contract is made of."""
    return list(dict.fromkeys(_source(n) for n, _ in contract.columns))


def typed(rows: DataFrame, contract: Contract, present: list[str] | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """All contract columns, leniently cast from text; columns that rows lack are typed nulls.

    The text columns stay together in `raw`, for rejection reasons. Rows bring date, source_file and
    row_num_in_file; columns to keep come last, as they are.
    """
    present = present if present is not None else [c for c in rows.columns if c not in ("date", "source_file", "row_num_in_file", "raw_group")]
    have = set(present)
    raw = F.struct(*[F.col(c).cast("string").alias(c) for c in present]) if present else F.struct(F.lit(None).alias("none"))
    held = rows.select(raw.alias("raw"), "date", "source_file", "row_num_in_file", *keep)
    technical = [F.col("date").cast("date").alias("date"), F.lit(contract.name).alias("table_name"), "source_file", F.current_timestamp().alias("ingest_ts"), F.col("row_num_in_file").cast("bigint").alias("row_num_in_file")]
    return held.select("raw", *[_typed(n, t, have).cast(t).alias(n) for n, t in contract.columns], *technical, *keep)


def reasons_of(name: str) -> dict[str, str]:
    """Why a required column may be null: it is not in the member, it has no value, its value is no such thing."""
    return {"missing": f"missing_required_column:{name}", "null": f"null_required_input:{name}", "bad": f"invalid_required_format:{name}" if name == "Time" else f"cast_failed_required:{name}"}


def with_reasons(rows: DataFrame, contract: Contract, header: str | None = None) -> DataFrame:
    """Adds `reasons`: one for each required column that is null; a row may have several.

    header: a column with the column names of the row's member, where members differ.
    """
    raw_columns = set(rows.schema["raw"].dataType.names)
    reasons = []
    for name in contract.required:
        why = reasons_of(name)
        if name not in raw_columns:
            reasons.append(F.when(F.col(name).isNull(), F.lit(why["missing"])))
            continue
        empty = null_tokens(F.col(f"raw.{name}")).isNull()
        absent = ~F.array_contains(header, name) if header else F.lit(False)
        reasons.append(F.when(F.col(name).isNull(), F.when(absent, F.lit(why["missing"])).when(empty, F.lit(why["null"])).otherwise(F.lit(why["bad"]))))
    return rows.withColumn("reasons", F.array_compact(F.array(*reasons)))


def accepted(rows: DataFrame) -> DataFrame:
    """Rows without a reason, in contract form."""
    return rows.where(F.size("reasons") == 0).drop("raw", "reasons")


def quarantine(rows: DataFrame) -> DataFrame:
    """Rejected rows with their text and reasons."""
    return rows.where(F.size("reasons") > 0)


def rejection_counts(rows: DataFrame) -> DataFrame:
    """(date, table_name, reason, n); a row with several bad columns counts under each."""
    return rows.select("date", "table_name", F.explode("reasons").alias("reason")).groupBy("date", "table_name", "reason").agg(F.count("*").alias("n"))


def sendtime_failures(rows: DataFrame) -> Column:
    """An aggregate: raw time present, parsed time null."""
    return F.count_if(F.col("SendTimeRaw").isNotNull() & F.col("SendTime").isNull())


def null_counts(rows: DataFrame, contract: Contract) -> DataFrame:
    """Per date and required column, how many rows are null there; in one pass."""
    wide = rows.groupBy("date", "table_name").agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in contract.required])
    return wide.unpivot(["date", "table_name"], list(contract.required), "field", "n_null")


def partition_manifest(rows: DataFrame) -> DataFrame:
    """A row for each (date, table): raw, kept and rejected rows, ranges of times, parse failures, status."""
    kept = F.size("reasons") == 0
    out = rows.groupBy("date", "table_name").agg(
        F.count("*").alias("raw_row_count"),
        F.count_if(kept).alias("row_count"),
        F.count_if(~kept).alias("rejected_row_count"),
        F.count_distinct("source_file").alias("member_count"),
        F.min(F.when(kept, F.col("Time"))).alias("min_time"),
        F.max(F.when(kept, F.col("Time"))).alias("max_time"),
        F.min(F.when(kept, F.col("SendTime"))).alias("min_sendtime"),
        F.max(F.when(kept, F.col("SendTime"))).alias("max_sendtime"),
        sendtime_failures(rows).alias("send_time_parse_failure_count"),
    )
    return out.withColumn("status", F.when(F.col("row_count") > 0, "completed").otherwise("empty"))


def raw_group(source_file: Column, year: Column) -> Column:
    """The member's group folder: the second part of its path in 2025, else the first; null for a file that is in no such folder."""
    parts = F.split(F.regexp_replace(source_file, r"\\", "/"), "/")
    at = F.when(year == 2025, 2).otherwise(1)
    return F.when(F.size(parts) > at, F.try_element_at(parts, at))


def group_map(df: DataFrame) -> DataFrame:
    """(year, raw_group, table_name): which groups feed which tables; a fixed small table."""
    rows = [(int(year), group, c.name) for c in CONTRACTS.values() for year, groups in c.groups.items() for group in groups]
    return df.sparkSession.createDataFrame(rows, "year int, raw_group string, table_name string")


def route(members: DataFrame, groups: DataFrame) -> DataFrame:
    """Members (or rows) with the tables their group feeds; null where no table takes it. groups: a small fixed table."""
    return members.join(F.broadcast(groups), ["year", "raw_group"], "left")


def source_inventory(members: DataFrame, groups: DataFrame) -> DataFrame:
    """(year, date, raw_group): member count, mapped tables, why it is skipped, first member."""
    counted = members.groupBy("year", "date", "raw_group").agg(F.count("*").alias("csv_member_count"), F.min("source_file").alias("example_member"))
    tables = groups.groupBy("year", "raw_group").agg(F.sort_array(F.collect_set("table_name")).alias("mapped_tables"))
    out = counted.join(F.broadcast(tables), ["year", "raw_group"], "left")
    mapped = F.coalesce("mapped_tables", F.array().cast("array<string>"))
    return out.withColumn("mapped_tables", mapped).withColumn("skip_reason", F.when(F.size(mapped) == 0, "unmapped_source_group"))


def unmapped_members(members: DataFrame, groups: DataFrame) -> DataFrame:
    return members.join(F.broadcast(groups), ["year", "raw_group"], "left_anti")


def require_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    """The table itself; raises if a column is absent."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df
