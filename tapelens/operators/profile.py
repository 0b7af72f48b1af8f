"""Profiles of stage tables: nulls, value rules, hours, order of time, schemas."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tapelens.contracts import Contract, Rule
from tapelens.functions.columns import rate

#: Chunks that one window looks through; a power of two.
FAN = 4096


def field_profile(df: DataFrame, by: list[str], fields: list[str]) -> DataFrame:
    """A row for each group and field: nulls, blanks, least and greatest value, status; one pass over the rows."""
    kinds = dict(df.dtypes)
    aggregates = [F.count("*").alias("row_count")]
    for f in fields:
        text = F.col(f).cast("string")
        blank = F.count_if(F.trim(text) == "") if kinds[f] == "string" else F.lit(0).cast("bigint")
        aggregates.append(F.struct(F.lit(f).alias("field"), F.count_if(F.col(f).isNull()).alias("null_count"), blank.alias("blank_count"), F.min(f).cast("string").alias("min_value"), F.max(f).cast("string").alias("max_value")).alias(f"of_{f}"))
    wide = df.groupBy(*by).agg(*aggregates)
    out = wide.select(*by, "row_count", F.explode(F.array(*[f"of_{f}" for f in fields])).alias("p")).select(*by, "row_count", "p.*")
    null_rate = rate(F.col("null_count"), F.col("row_count"))
    status = F.when(F.col("row_count") == 0, "empty").when(null_rate > 0.5, "warn").otherwise("pass")
    return out.withColumns({"null_rate": null_rate, "blank_rate": rate(F.col("blank_count"), F.col("row_count")), "status": status})


def rule_profile(df: DataFrame, by: list[str], rules: tuple[Rule, ...], year: Column | None = None) -> DataFrame:
    """A row for each group and rule: tested and violating counts and status; all rules in one aggregate."""
    applies = {r.name: F.lit(True) if r.years is None else (year.isin(*r.years) if year is not None else F.lit(False)) for r in rules}
    aggregates = [F.count("*").alias("row_count")]
    for r in rules:
        tested = F.expr(r.tested) & applies[r.name]
        violating = F.coalesce(tested & F.expr(r.violating), F.lit(False))
        aggregates.append(F.struct(F.lit(r.name).alias("rule_name"), F.bool_or(applies[r.name]).alias("applicable"), F.count_if(tested).alias("tested_count"), F.count_if(violating).alias("violating_count")).alias(f"of_{r.name}"))
    wide = df.groupBy(*by).agg(*aggregates)
    out = wide.select(*by, "row_count", F.explode(F.array(*[f"of_{r.name}" for r in rules])).alias("r")).select(*by, "row_count", "r.*")
    status = F.when(F.col("row_count") == 0, "empty").when(~F.col("applicable") | (F.col("tested_count") == 0), "not_applicable").when(F.col("violating_count") > 0, "fail").otherwise("pass")
    return out.withColumns({"violation_rate": rate(F.col("violating_count"), F.col("tested_count")), "status": status})


def violation_samples(df: DataFrame, by: list[str], rules: tuple[Rule, ...], order: list[str], columns: list[str], most: int = 5) -> DataFrame:
    """The first rows that violate each rule, as JSON text. The window ranks violating rows only, and Spark limits it before the shuffle."""
    hit = F.array_compact(F.array(*[F.when(F.expr(f"({r.tested}) AND ({r.violating})"), F.lit(r.name)) for r in rules]))
    rows = df.select(*by, *dict.fromkeys([*order, *columns]), F.explode(hit).alias("rule_name"))
    place = F.row_number().over(Window.partitionBy(*by, "rule_name").orderBy(*order))
    first = rows.withColumn("place", place).where(F.col("place") <= most)
    listed = F.transform(F.array_sort(F.collect_list(F.struct("place", F.struct(*columns).alias("row")))), lambda x: x["row"])
    return first.groupBy(*by, "rule_name").agg(F.to_json(listed).alias("samples"))


def hour_histogram(df: DataFrame, by: list[str], zone: str = "Asia/Hong_Kong") -> DataFrame:
    """(by, hour, n) in local time: of SendTime where there is one, else of Time."""
    hour = F.coalesce(F.hour(F.from_utc_timestamp("SendTime", zone)), F.substring("Time", 1, 2).try_cast("int"))
    return df.groupBy(*by, hour.alias("hour")).agg(F.count("*").alias("n"))


def hour_map(histogram: DataFrame, by: list[str]) -> DataFrame:
    """The histogram of each group as JSON; at most 25 entries."""
    entries = F.array_sort(F.collect_list(F.struct(F.lpad(F.col("hour").cast("string"), 2, "0").alias("h"), "n")))
    return histogram.where("hour IS NOT NULL").groupBy(*by).agg(F.to_json(F.map_from_entries(entries)).alias("hour_bucket_profile"))


def _on(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Left join on keys that may be null; nulls are equal."""
    other = right.withColumnsRenamed({k: f"{k}__of" for k in keys})
    same = reduce(lambda x, y: x & y, [left[k].eqNullSafe(other[f"{k}__of"]) for k in keys])
    return left.join(other, same, "left").drop(*[f"{k}__of" for k in keys])


def _chunk_before(ends: DataFrame, by: list[str], chunk: str, widest: int | None) -> DataFrame:
    """Adds `before__`: `at_end__` of the group's chunk before; a row for each chunk.

    Integer chunks are gathered FAN to one and look back among themselves; the first of them takes from the last chunk
    of the gathering before, found the same way one level up. So no window holds more than FAN chunks.
    """
    if widest is None or widest < FAN:
        return ends.withColumn("before__", F.lag("at_end__").over(Window.partitionBy(*by).orderBy(chunk)))
    shift, up = FAN.bit_length() - 1, f"{chunk}__up"
    inside = Window.partitionBy(*by, up).orderBy(chunk)
    rows = ends.withColumn(up, F.shiftright(chunk, shift))
    above = _chunk_before(rows.groupBy(*by, up).agg(F.max_by("at_end__", F.struct(chunk)).alias("at_end__")), by, up, widest >> shift)
    rows = rows.withColumns({"before__": F.lag("at_end__").over(inside), "first__": F.row_number().over(inside) == 1})
    joined = _on(rows, above.select(*by, up, F.col("before__").alias("above__")), [*by, up])
    return joined.select(*by, chunk, "at_end__", F.when(F.col("first__"), F.col("above__")).otherwise(F.col("before__")).alias("before__"))


def chunked_lag(df: DataFrame, by: list[str], chunk: str, order: list[str], columns: list[str]) -> DataFrame:
    """Adds prev_<column>: the value in the row before, in (chunk, order), without one task for a whole group.

    chunk must not fall as the order rises; a null chunk comes first. Rows lag within their chunk; a chunk's first row
    takes from the last row of the chunk before. Chunks may be as many as order ids: integers, whose greatest is asked
    of the table first, are looked through level by level, others in one window over a row for each chunk. Null groups are
    groups. Columns whose names end in two underscores are the operator's own.
    """
    widest = None
    if dict(df.dtypes)[chunk] in ("tinyint", "smallint", "int", "bigint"):
        low, high = df.agg(F.min(chunk), F.max(chunk)).first()
        widest = max(high or 0, -1 - (low or 0))
    inside = Window.partitionBy(*by, chunk).orderBy(*order)
    rows = df.withColumns({"first_in_chunk__": F.row_number().over(inside) == 1, **{f"prev_{c}": F.lag(c).over(inside) for c in columns}})
    ends = df.groupBy(*by, chunk).agg(F.max_by(F.struct(*columns), F.struct(*order)).alias("at_end__"))
    out = _on(rows, _chunk_before(ends, by, chunk, widest).drop("at_end__"), [*by, chunk])
    seams = {f"prev_{c}": F.when(F.col("first_in_chunk__"), F.col(f"before__.{c}")).otherwise(F.col(f"prev_{c}")) for c in columns}
    return out.withColumns(seams).drop("before__", "first_in_chunk__")


def time_inversions(df: DataFrame, by: list[str], chunk: str, order: list[str]) -> DataFrame:
    """Rates of rows whose SendTime is below the row before's, and of those among them whose SeqNum rises."""
    lagged = chunked_lag(df, by, chunk, order, ["SendTime", "SeqNum"])
    comparable = F.col("SendTime").isNotNull() & F.col("prev_SendTime").isNotNull()
    back = F.col("SendTime") < F.col("prev_SendTime")
    both = comparable & F.col("SeqNum").isNotNull() & F.col("prev_SeqNum").isNotNull()
    out = lagged.groupBy(*by).agg(
        F.count_if(comparable).alias("comparable_count"),
        F.count_if(comparable & back).alias("inversion_count"),
        F.count_if(both).alias("seq_comparable_count"),
        F.count_if(both & back & (F.col("SeqNum") > F.col("prev_SeqNum"))).alias("seq_time_disagreement_count"),
    )
    return out.withColumns({"inversion_rate": rate(F.col("inversion_count"), F.col("comparable_count")), "seq_time_disagreement_rate": rate(F.col("seq_time_disagreement_count"), F.col("seq_comparable_count"))})


def time_profile(df: DataFrame, by: list[str], chunk: str, order: list[str]) -> DataFrame:
    """Rows, nulls and ranges of the times of each group, with its hour map and inversion rates."""
    base = df.groupBy(*by).agg(
        F.count("*").alias("row_count"),
        F.count_if(F.col("SendTime").isNull()).alias("sendtime_null_count"),
        F.count_if(F.col("Time").isNull()).alias("time_null_count"),
        F.min("SendTime").alias("min_sendtime"),
        F.max("SendTime").alias("max_sendtime"),
        F.min("Time").alias("min_time"),
        F.max("Time").alias("max_time"),
    )
    return base.join(hour_map(hour_histogram(df, by), by), by, "left").join(time_inversions(df, by, chunk, order), by, "left")


def schema_fingerprints(spark: SparkSession, files: DataFrame) -> DataFrame:
    """(path, columns, types, fingerprint) of Parquet files, from their footers alone.

    files: a DataFrame with a `path` column. The footer is the file's tail, which Spark's own reader
    of binary files would load whole, so each task opens its files with the file system of the path.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import hashlib
        import json

        import pyarrow.parquet as pq
        from pyarrow import fs

        for batch in batches:
            out = []
            for path in batch.column("path").to_pylist():
                system, place = fs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{path}")
                with system.open_input_file(place) as f:
                    schema = pq.ParquetFile(f).schema_arrow
                names, kinds = schema.names, [str(schema.field(n).type) for n in schema.names]
                text = json.dumps([[n, k, schema.field(n).nullable] for n, k in zip(names, kinds, strict=True)])
                out.append((path, names, kinds, hashlib.sha256(text.encode()).hexdigest()[:16]))
            paths, names, kinds, prints = zip(*out, strict=True) if out else ([], [], [], [])
            yield pa.RecordBatch.from_arrays([pa.array(paths, pa.string()), pa.array(names, pa.list_(pa.string())), pa.array(kinds, pa.list_(pa.string())), pa.array(prints, pa.string())], names=["path", "columns", "types", "fingerprint"])

    return files.select("path").mapInArrow(read, "path string, columns array<string>, types array<string>, fingerprint string")


#: Arrow names of the contract types.
ARROW_TYPES = {"string": "string", "bigint": "int64", "int": "int32", "smallint": "int16", "tinyint": "int8", "double": "double", "boolean": "bool", "date": "date32[day]"}


def schema_drift(prints: DataFrame, contract: Contract, group: str) -> DataFrame:
    """Per group of files: variants, columns the contract misses or does not know, mismatched types, status."""
    want = [(n, ARROW_TYPES.get(t, t)) for n, t in contract.columns if t != "timestamp"]
    names = F.array(*[F.lit(n) for n, _ in contract.columns])
    wanted = F.array(*[F.concat(F.lit(f"{n}:"), F.lit(t)) for n, t in want])
    checked = F.array(*[F.lit(n) for n, _ in want])
    known = F.filter(F.arrays_zip("columns", "types"), lambda x: F.array_contains(checked, x["columns"]))
    have = F.transform(known, lambda x: F.concat(x["columns"], F.lit(":"), x["types"]))
    rows = prints.select(group, "fingerprint", F.array_except(names, F.col("columns")).alias("missing"), F.array_except(F.col("columns"), names).alias("extra"), F.array_except(have, wanted).alias("mismatched"))
    each = lambda c: F.sort_array(F.array_distinct(F.flatten(F.collect_set(c)))).alias(f"{c}_columns")
    out = rows.groupBy(group).agg(F.count("*").alias("n_files"), F.count_distinct("fingerprint").alias("n_variants"), each("missing"), each("extra"), each("mismatched"))
    ok = (F.size("missing_columns") == 0) & (F.size("mismatched_columns") == 0) & (F.col("n_variants") == 1)
    return out.withColumn("status", F.when(ok, "pass").otherwise("fail"))
