"""Exact deduplication by a tree merge of sorted digest runs.

Every partition of the documents makes a run: its digests in order, each with the row that stays and
the number of rows. A run is cut into the same slices of the digest space as all others, and a slice
of a run travels as one row of packed arrays. Runs meet in binomial rounds: in round k those whose
numbers agree after division by fan_in**k come together, slice by slice, and are merged as the
sorted runs they are, by searching one run's keys in the other's. Of equal digests (and lengths) the
row that stays is kept at every level, so a digest with copies everywhere is one entry per run, and
no task sees more than fan_in entries of it. Slices are as many as keep one of about SLICE entries.

Defined results: a null text is the empty text; empty texts are equal to each other. Of equal texts
the one with the most code points stays, then the smallest id; a null id comes after all others. Of
rows that agree in both, one stays, the same in every rerun on the same files. An empty table gives
an empty result. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tapelens.llm.common import WHITESPACE, blocks, by_id, durable, free, lookup, release, schema_of, slim, utf8

#: SHA-256 of the text without white space, then its length in bytes, so that keys sort as bytes do.
KEY = 40
SLICE = 250_000


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, row, key, n_chars): a number for the row, KEY bytes that equal texts share, code points of the text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 40
        for block in blocks(batches, text_col):
            texts = utf8(block, text_col)
            bare = [t.translate(None, WHITESPACE) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [
                    block.column(id_col),
                    pa.array(np.arange(row, row + len(texts))),
                    pa.array([hashlib.sha256(t).digest() + len(t).to_bytes(8, "big") for t in bare], pa.binary()),
                    pa.array([len(t.decode("utf-8", "replace")) for t in texts], pa.int64()),
                ],
                names=[id_col, "row", "key", "n_chars"],
            )
            row += len(texts)

    return slim(docs, id_col, text_col).mapInArrow(run, f"{schema_of(docs, id_col)}, row long, key binary, n_chars long")


def _keys(table: pa.Table) -> np.ndarray:
    """The keys as fixed strings, which numpy compares byte by byte."""
    return np.frombuffer(b"".join(table.column("key").to_pylist()), f"S{KEY}")


def _first(table: pa.Table, keys: np.ndarray, ids: str) -> pa.Table:
    """Of a table in key order, whose equal keys are in any order: the best row of each key, with the sum of n."""
    starts = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, np.int64)
    sizes = np.diff(np.append(starts, len(keys)))
    place = np.repeat(np.arange(len(starts)), sizes)
    shared = np.flatnonzero(np.repeat(sizes, sizes) > 1)
    best = starts.copy()
    if len(shared):
        part = table.take(pa.array(shared)).append_column("place", pa.array(place[shared])).append_column("at", pa.array(shared))
        part = part.append_column("no_id", pc.is_null(part.column(ids)))
        part = part.sort_by([("place", "ascending"), ("n_chars", "descending"), ("no_id", "ascending"), (ids, "ascending"), ("row", "ascending")])
        which, at = np.unique(part.column("place").to_numpy(), return_index=True)
        best[which] = part.column("at").to_numpy()[at]
    total = np.add.reduceat(table.column("n").to_numpy(), starts) if len(starts) else np.zeros(0, np.int64)
    out = table.take(pa.array(best))
    return out.set_column(out.schema.get_field_index("n"), "n", pa.array(total, pa.int64()))


def merge_two(a: pa.Table, b: pa.Table, ids: str) -> pa.Table:
    """Two runs, each sorted by key and without equal keys, as one."""
    left, right = _keys(a), _keys(b)
    # Where b's entries go in the merged order; a's take the places between.
    at = np.searchsorted(left, right, "right") + np.arange(len(right))
    order = np.zeros(len(left) + len(right), np.int64)
    from_b = np.zeros(len(order), bool)
    from_b[at] = True
    order[from_b], order[~from_b] = np.arange(len(right)) + len(left), np.arange(len(left))
    return _first(pa.concat_tables([a, b]).take(pa.array(order)), np.concatenate([left, right])[order], ids)


def merge_runs(rows: DataFrame, id_col: str = "doc_id", fan_in: int = 8, slice_size: int = SLICE) -> DataFrame:
    """(id, row, key, n) for each key of a durable `digests` table: the row that stays, and how many there are."""
    runs, slices = rows.rdd.getNumPartitions(), max(1, -(-rows.count() // slice_size))
    ids = schema_of(rows, id_col)
    entry = f"array<struct<{ids.replace('` ', '`:', 1)},row:bigint,key:binary,n_chars:bigint,n:bigint>>"
    form = f"slice int, run int, entries {entry}"

    def packed(table: pa.Table, number: int, run: int) -> pa.RecordBatch:
        columns = [table.column(c).combine_chunks() for c in (id_col, "row", "key", "n_chars", "n")]
        struct = pa.StructArray.from_arrays(columns, names=[id_col, "row", "key", "n_chars", "n"])
        return pa.RecordBatch.from_arrays([pa.array([number], pa.int32()), pa.array([run], pa.int32()), pa.ListArray.from_arrays([0, len(struct)], struct)], names=["slice", "run", "entries"])

    def opened(entries: pa.ListArray) -> pa.Table:
        struct = entries.flatten()
        return pa.table({f.name: struct.field(f.name) for f in struct.type})

    def first_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Slices of a partition arrive in order, as rows in key order; a slice is closed by the next.
        held: list[pa.Table] = []
        of, run = None, TaskContext.get().partitionId()

        def close() -> pa.RecordBatch:
            table = pa.concat_tables(held).combine_chunks()
            return packed(_first(table, _keys(table), id_col), of, run)

        for batch in batches:
            numbers = batch.column("slice").to_numpy()
            for number in np.unique(numbers).tolist():
                here = np.flatnonzero(numbers == number)
                part = pa.Table.from_batches([batch.slice(here[0], len(here))]).drop_columns(["slice"])
                if held and number != of:
                    yield close()
                    held = []
                of = number
                held.append(part)
        if held:
            yield close()
        del held
        release()

    def merge(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = [opened(batch.column("entries").slice(i, 1)) for batch in batches for i in range(batch.num_rows)]
        while len(tables) > 1:
            pairs = [tables[i : i + 2] for i in range(0, len(tables), 2)]
            tables = [reduce(lambda a, b: merge_two(a, b, id_col), pair) for pair in pairs]
        yield packed(tables[0], key[0].as_py(), key[1].as_py())

    #: The first 32 bits of the digest, spread evenly over the slices.
    number = F.floor(F.conv(F.hex(F.substring("key", 1, 4)), 16, 10).cast("long") * slices / (1 << 32)).cast("int")
    level = rows.select(id_col, "row", "key", "n_chars", F.lit(1).cast("long").alias("n"), number.alias("slice"))
    level = level.sortWithinPartitions("key").mapInArrow(first_runs, form)
    while runs > 1:
        runs = -(-runs // fan_in)
        level = level.withColumn("run", F.expr(f"cast(run div {fan_in} as int)")).groupBy("slice", "run").applyInArrow(merge, form)
    return level.select(F.inline("entries")).select(id_col, "row", "key", "n")


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", fan_in: int = 8, slice_size: int = SLICE) -> DataFrame:
    """One row per document: id, digest, keep_id, group_size, kept.

    Unique texts are not joined: the other side holds groups of two or more only, the largest of them broadcast.
    """
    rows = durable(digests(docs, id_col, text_col))
    groups = merge_runs(rows, id_col, fan_in, slice_size).where("n > 1")
    groups = durable(groups.select("key", F.col(id_col).alias("keep_id"), F.col("row").alias("keep_row"), F.col("n").alias("group_size"), F.col("n").alias("n_rows")))
    joined = lookup(rows, groups, ["key"], "n_rows", rows.count(), "left")
    alone = F.col("keep_row").isNull()
    return joined.select(
        id_col,
        F.substring("key", 1, 32).alias("digest"),
        F.when(alone, F.col(id_col)).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        (alone | (F.col("row") == F.col("keep_row"))).alias("kept"),
    )


def drop_exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents that stay, with all their columns.

    The ids to drop leave by an anti join. Ids that occur in several rows take a way of their own,
    by (id, digest, code points), and of equal such rows one stays.
    """
    groups = durable(exact_groups(docs, id_col, text_col))
    per_id = groups.groupBy(F.col(id_col).alias("id")).agg(F.count("*").alias("n_rows"), F.bool_and("kept").alias("stays"))
    out = durable(per_id.where("not stays or n_rows > 1"))
    plain = by_id(docs, id_col, out.select("id"), "left_anti")
    twice = durable(out.where("n_rows > 1").select("id"))
    digest, place, key, stays = (free(docs, x) for x in ("own_digest", "own_place", "id_kept", "digest_kept"))
    bare = F.regexp_replace(F.coalesce(text_col, F.lit("")), r"[\x20\x09-\x0D]", "")
    again = by_id(docs, id_col, twice, "left_semi").withColumn(digest, F.unhex(F.sha2(bare, 256)))
    left = by_id(groups.where("kept"), id_col, twice, "left_semi").select(F.col(id_col).alias(key), F.col("digest").alias(stays))
    again = again.join(left, again[id_col].eqNullSafe(F.col(key)) & (F.col(digest) == F.col(stays)), "left_semi")
    again = again.withColumn(place, F.row_number().over(Window.partitionBy(id_col, digest).orderBy(F.length(text_col).desc_nulls_last())))
    return plain.unionByName(again.where(F.col(place) == 1).drop(digest, place))
