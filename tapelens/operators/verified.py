"""Policy-gated projection of stage tables into verified ones."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tapelens.contracts import FINE_YEARS, POLICY_VERSION, SOURCE_LAYER, VERIFIED_MANIFEST
from tapelens.functions.columns import instrument_key, order_side
from tapelens.operators.staging import require_columns
from tapelens.sources.files import exists, file_totals

BUCKETS = ("admit_now", "admit_with_explicit_caveat_only", "keep_out_for_now")
#: What the columns that a policy may derive are made of.
DERIVED_FROM = {"instrument_key": "source_file", "OrderSideVendor": "Ext"}


def derived(name: str) -> Column:
    return instrument_key(F.col("source_file")) if name == "instrument_key" else order_side(F.col("Ext"))


def resolve(policy: list[dict], table: str, year: int, caveats: tuple[str, ...] = ()) -> dict:
    """Which fields of a table a year admits, which need a caveat asked for, which stay out.

    policy rows: table, field, bucket, admit_years, exclude_years. Raises on an unknown bucket, a
    repeated field, or a caveat the policy does not offer for any table.
    """
    rows = [p for p in policy if p["table"] == table]
    if bad := [p for p in policy if p["bucket"] not in BUCKETS]:
        raise ValueError(f"unknown bucket: {bad[0]['bucket']}")
    names = [p["field"] for p in rows]
    if len(names) != len(set(names)):
        raise ValueError(f"{table}: a field has several policies")
    offered = {p["field"] for p in policy if p["bucket"] == BUCKETS[1]}
    if unknown := set(caveats) - offered:
        raise ValueError(f"not offered with a caveat: {', '.join(sorted(unknown))}")
    in_year = lambda p: (not p.get("admit_years") or year in p["admit_years"]) and year not in (p.get("exclude_years") or ())
    used = [p["field"] for p in rows if p["bucket"] == BUCKETS[1] and p["field"] in caveats and in_year(p)]
    outputs = [p["field"] for p in rows if in_year(p) and (p["bucket"] == BUCKETS[0] or p["field"] in used)]
    inputs = list(dict.fromkeys(DERIVED_FROM.get(f, f) for f in outputs))
    variant = f"verified_{table}" + (f"__caveat_{'_'.join(sorted(used))}" if used else "")
    return {"inputs": inputs, "outputs": outputs, "excluded": [n for n in names if n not in outputs], "caveats": used, "variant": variant, "skip": bool(caveats) and not used}


def unlisted(df: DataFrame, policy: list[dict], table: str) -> list[str]:
    """Columns of which the policy says nothing."""
    return sorted(set(df.columns) - {p["field"] for p in policy if p["table"] == table} - {"date", "year"})


def project(stage: DataFrame, plan: dict, keys: tuple[str, ...] = ("date",)) -> DataFrame:
    """The admitted columns, derived where the policy says so."""
    require_columns(stage, [*plan["inputs"], *keys])
    return stage.select(*keys, *[(derived(f) if f in DERIVED_FROM else F.col(f)).alias(f) for f in plan["outputs"] if f not in keys])


def write_verified(df: DataFrame, root: str, variant: str) -> None:
    """One folder a day; days that the table holds are replaced, others stay. A heavy day is split over tasks and files."""
    out = df.withColumn("year", F.year("date"))
    out.hint("rebalance", "year", "date").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "zstd").partitionBy("year", "date").parquet(f"{root}/{variant}")


def time_grade(year: Column) -> Column:
    """What a year's times are good for."""
    return F.when(year.isin(*FINE_YEARS), "fine_ok").otherwise("coarse_only")


def metadata(counts: DataFrame, plan: dict, table: str, version: str = POLICY_VERSION) -> DataFrame:
    """VERIFIED_MANIFEST rows of partitions. counts: date, batch, input_row_count, output_rows, output_files, output_bytes."""
    names = lambda some: F.array(*map(F.lit, some)).cast("array<string>")
    known = {
        "year": F.year("date"),
        "table_name": F.lit(table),
        "verified_table_name": F.lit(plan["variant"]),
        "output_row_count": F.col("output_rows"),
        "included_columns": names(plan["outputs"]),
        "included_caveat_columns": names(plan["caveats"]),
        "excluded_columns": names(plan["excluded"]),
        "verified_policy_version": F.lit(version),
        "source_layer": F.lit(SOURCE_LAYER),
        "admission_rule": F.lit("admit_now_plus_caveat_only" if plan["caveats"] else "admit_now_only"),
        "contains_caveat_fields": F.lit(bool(plan["caveats"])),
        "reference_join_applied": F.lit(False),
        "research_time_grade": time_grade(F.year("date")),
        "generated_at": F.current_timestamp(),
    }
    return counts.withColumns(known).select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in StructType.fromDDL(VERIFIED_MANIFEST)])


def read_manifest(spark: SparkSession, root: str) -> DataFrame:
    """Metadata of the last batch of each table and date."""
    path = f"{root}/manifest"
    if not exists(spark, path):
        return spark.createDataFrame([], VERIFIED_MANIFEST)
    rows = spark.read.schema(VERIFIED_MANIFEST).parquet(path).select(*StructType.fromDDL(VERIFIED_MANIFEST).names)
    last = F.max("batch").over(Window.partitionBy("verified_table_name", "date"))
    return rows.withColumn("last", last).where("batch = last").drop("last")


def output_states(spark: SparkSession, root: str, variant: str) -> DataFrame:
    """(date, state) of a verified table's days: done, stale (outputs gone, or not as recorded) or orphan (no metadata row)."""
    path, rows = f"{root}/{variant}", read_manifest(spark, root).where(F.col("verified_table_name") == variant).select("date", "output_row_count")
    out = file_totals(spark.read.parquet(path), ["date"]) if exists(spark, path) else spark.createDataFrame([], "date date, output_rows bigint")
    both = rows.withColumn("recorded", F.lit(True)).join(out.select("date", "output_rows"), "date", "full_outer")
    same = F.coalesce("output_row_count", F.lit(0)) == F.coalesce("output_rows", F.lit(0))
    return both.select("date", F.when(F.col("recorded").isNull(), "orphan").when(same, "done").otherwise("stale").alias("state"))


def publish(stage: DataFrame, root: str, table: str, plan: dict, days: list[dt.date] | None = None, overwrite: bool = False, version: str = POLICY_VERSION) -> DataFrame:
    """Project days of a stage table (all, if none are named) that are not published yet, and record them; returns their metadata.

    Metadata are made of the written files; the input's rows are counted by date alone. Raises where days have outputs
    but no metadata row, as a run that was killed leaves them; not with overwrite, which publishes all days anew. Days
    whose outputs are gone, or not as recorded, are published anew.
    """
    spark = stage.sparkSession
    chosen = stage if days is None else stage.where(F.col("date").isin(days))
    inputs = {r["date"]: r["n"] for r in chosen.where("date IS NOT NULL").groupBy("date").agg(F.count("*").alias("n")).collect()}  # a row a day
    states = {r["date"]: r["state"] for r in output_states(spark, root, plan["variant"]).collect()}
    if not overwrite and (orphans := sorted(str(d) for d in inputs if states.get(d) == "orphan")):
        raise ValueError(f"outputs without a metadata row: {', '.join(orphans[:10])}")
    todo = sorted(d for d in inputs if overwrite or states.get(d) != "done")
    if not todo:
        return read_manifest(spark, root).limit(0)
    batch = (read_manifest(spark, root).agg(F.max("batch")).first()[0] or 0) + 1
    write_verified(project(chosen.where(F.col("date").isin(todo)), plan), root, plan["variant"])
    counts = spark.createDataFrame([(d, inputs[d], batch) for d in todo], "date date, input_row_count bigint, batch bigint")
    written = file_totals(spark.read.parquet(f"{root}/{plan['variant']}").where(F.col("date").isin(todo)), ["date"])
    made = metadata(counts.join(written, "date", "left"), plan, table, version)
    made.coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("verified_table_name", "batch").parquet(f"{root}/manifest")
    return read_manifest(spark, root).where((F.col("batch") == batch) & (F.col("verified_table_name") == plan["variant"]))


def totals(manifest: DataFrame) -> DataFrame:
    """Per verified table: days, rows, bytes, first and last day."""
    return manifest.groupBy("verified_table_name").agg(F.count("*").alias("partition_count"), F.sum("output_row_count").alias("output_row_count"), F.sum("output_bytes").alias("output_bytes"), F.min("date").alias("min_date"), F.max("date").alias("max_date"))


def summary(verified: DataFrame, by: list[str]) -> DataFrame:
    """Measured rows and dates of verified tables."""
    return verified.groupBy(*by).agg(F.count("*").alias("output_row_count"), F.count_distinct("date").alias("partition_count"), F.min("date").alias("min_date"), F.max("date").alias("max_date"))


def published(df: DataFrame, layer: str, table: str, year: int, grade: str) -> DataFrame:
    """A slice with the labels that published queries carry."""
    return df.withColumns({"source_layer": F.lit(layer), "table_name": F.lit(table), "year": F.lit(year), "research_time_grade": F.lit(grade), "query_generated_at": F.current_timestamp(), "readonly": F.lit(True)})


def lookup_labels(df: DataFrame, reference: DataFrame, on: str, label: str = "reference_lookup") -> DataFrame:
    """Left join to a reference table, labelled: a lookup, not a fact of the row."""
    return df.join(reference, on, "left").withColumn("enrichment", F.lit(label))
