"""Mixing sources to target weights by pivotal dependent rounding.

A source's target over its size is the expected number of copies of each of its documents. The
whole part is taken; the fraction is a probability that pivotal rounding settles: two documents'
fractional masses (fraction times size) meet, and mass moves from one to the other, in a random
direction with the odds that keep both expectations, until one is 0 or full. The sum of a source's
masses never changes, so what it contributes stays at its target until one document is left.

Documents of over LARGE of their source, at most 1 / LARGE of them, are settled first, from the
largest size class down, and the rest of each class is spread over the smaller documents. The others
are settled bucket by bucket, and each bucket's one open document goes up a reduction tree.

Defined results: a null text has size 0; documents of size 0 are taken 0 words. A null source is a
source of its own, last in order. Rows that repeat an id are rounded separately. A null id is an id
like any other. An empty table gives an empty result. Other columns are not read. All draws come
from hashes of the rows, so reruns agree.
"""

from __future__ import annotations

import random
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tapelens.llm.common import WORD, bounded, by_id, durable, free, lookup, schema_of

WEIGHTS = (5.0, 2.0, 1.0)
MOST = 3
LARGE = 0.002
PER_BUCKET, FAN_IN = 2_000, 64


def numbered(table: DataFrame, column: str) -> DataFrame:
    """The table with `place`, the number of each row in the order of the column, nulls last.

    Ranges are sorted each by itself; only how many rows each range has comes to the driver.
    """
    dealt = durable(table.repartitionByRange(F.col(column).asc_nulls_last()).withColumn("range", F.spark_partition_id()))
    before, total = [], 0
    for row in dealt.groupBy("range").count().orderBy("range").collect():
        before += [F.lit(row["range"]), F.lit(total)]
        total += row["count"]
    inner = F.row_number().over(Window.partitionBy("range").orderBy(F.col(column).asc_nulls_last())) - 1
    first = F.create_map(*before)[F.col("range")] if before else F.lit(0)
    return dealt.withColumn("place", inner + first).drop("range")


def targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: float = MOST) -> DataFrame:
    """(source, source_size, target): shares of the whole by weight, no more than `most` times the source's size.

    sizes: (source, source_size), a row for each source. What a source cannot take is shared anew by
    weight until all fit; every round settles a source at least, and usually all that will be.
    """
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("place") % len(weights) + 1).cast("int"))
    table = numbered(sizes.select("source", "source_size"), "source")
    table = durable(table.select("source", "source_size", weight.alias("weight"), (most * F.col("source_size")).cast("double").alias("cap")))
    level, full = None, 0
    while True:
        over = F.lit(False) if level is None else F.col("cap") <= level * F.col("weight")
        total, capped, weight_left, now = table.agg(F.sum("source_size"), F.sum(F.when(over, F.col("cap")).otherwise(0.0)), F.sum(F.when(over, 0.0).otherwise(F.col("weight"))), F.count_if(over)).first()
        if level is not None and now == full or not weight_left:
            break
        level, full = ((total or 0) - capped) / weight_left, now
    share = F.col("cap") if level is None else F.least("cap", F.lit(float(level)) * F.col("weight"))
    return table.select("source", "source_size", share.alias("target"))


def pivot(sizes: list[float], masses: list[float], draw: random.Random) -> tuple[list[float], int | None]:
    """Settle all but one: masses of 0 or the full size, with the same sum; the number of the one left open."""
    masses, held = list(masses), None
    for i, size in enumerate(sizes):
        if not 0 < masses[i] < size:
            continue
        if held is None:
            held = i
            continue
        up, down = min(sizes[held] - masses[held], masses[i]), min(masses[held], size - masses[i])
        if draw.random() * (up + down) < down:  # held gains
            full = up == sizes[held] - masses[held]
            left = masses[i] - up
            masses[held], masses[i] = (sizes[held], left) if full else (masses[held] + up, 0.0)
        else:
            empty = down == masses[held]
            gained = masses[i] + down
            masses[held], masses[i] = (0.0, gained) if empty else (masses[held] - down, size)
        held = next((k for k in (held, i) if 0 < masses[k] < sizes[k]), None)
    return masses, held


def _table(table: pa.Table, **columns: object) -> pa.Table:
    for name, values in columns.items():
        kind = pa.bool_() if name == "up" else pa.float64()
        column = pa.array(values, kind)
        at = table.schema.get_field_index(name)
        table = table.set_column(at, name, column) if at >= 0 else table.append_column(name, column)
    return table


def _ordered(table: pa.Table) -> pa.Table:
    return table.sort_by([("draw", "ascending"), ("size", "ascending")])


def _settle_large(table: pa.Table, seed: int) -> pa.Table:
    """All large documents of a source; shift: the change of the fraction that its other documents get for what could not be met here."""
    table = _ordered(table)
    size, fraction = table.column("size").to_numpy().astype(float), table.column("fraction").to_numpy().astype(float)
    draw, rest = random.Random(f"{seed} {table.column('source')[0].as_py()!r}"), float(table.column("small")[0].as_py())
    order = np.argsort(-size, kind="stable")
    mass = size * fraction
    classes = np.floor(np.log2(np.maximum(size, 1)))
    owed = 0.0
    for c in sorted(set(classes.tolist()), reverse=True):
        rows = [i for i in order if classes[i] == c]
        settled, left = pivot(size[rows].tolist(), mass[rows].tolist(), draw)
        if left is not None:
            up = draw.random() * size[rows[left]] < settled[left]
            owed += settled[left] - size[rows[left]] * up
            settled[left] = size[rows[left]] * up
        mass[rows] = settled
        later = [i for i in order if classes[i] < c]
        room = rest + size[later].sum()
        if owed and room > 0 and later:
            shift = owed / room
            moved = np.clip(mass[later] + shift * size[later], 0, size[later]) - mass[later]
            mass[later] += moved
            owed -= moved.sum()
    shift = owed / rest if rest > 0 else 0.0
    return _table(table, up=(mass > 0).tolist(), shift=[shift] * len(size))


def _settle(table: pa.Table, seed: int, last: bool) -> pa.Table:
    """All but one of a bucket; of the last bucket of a source, all."""
    table = _ordered(table)
    size = table.column("size").to_numpy().astype(float).tolist()
    mass = table.column("mass").to_numpy().astype(float).tolist()
    draw = random.Random(f"{seed} {table.column('source')[0].as_py()!r} {table.column('draw')[0].as_py()}")
    mass, left = pivot(size, mass, draw)
    up: list[bool | None] = [m > 0 for m in mass]
    if left is not None:
        up[left] = draw.random() * size[left] < mass[left] if last else None
    return _table(table, mass=mass, up=up)


def _settler(seed: int, last: bool) -> Callable[[pa.Table], pa.Table]:
    return lambda table: _settle(table, seed, last)


def drawn(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", seed: int = 0) -> DataFrame:
    """(id, source, size, draw) of every document. The draw depends on the text too, so that rows without an id of their own are dealt over all buckets."""
    size = F.coalesce(F.regexp_count(text_col, F.lit(WORD)), F.lit(0)).cast("long")
    rows = docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"), size.alias("size"), F.xxhash64(text_col).alias("said"))
    return rows.select("id", "source", "size", F.xxhash64("id", "size", "said", F.lit(seed)).alias("draw"))


def mix(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", weights: tuple[float, ...] = WEIGHTS, most: int = MOST, seed: int = 0) -> DataFrame:
    """(id, source, size, source_size, target, copies, taken) of every document."""
    # A null source is looked up by a mark of its own: sources get a letter before them.
    key = F.coalesce(F.concat(F.lit("s"), F.col("source").cast("string")), F.lit("-")).alias("_source")
    slim = durable(drawn(docs, id_col, source_col, text_col, seed))
    n_docs = slim.count()
    per_source = durable(slim.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n")))
    large = F.col("size") > LARGE * F.col("source_size")
    goals = targets(per_source.select("source", "source_size"), weights, most)
    goals = goals.select(key, "target").join(per_source.select(key, "source_size", "n"), "_source")
    copies = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    goals = durable(goals.select("_source", "source_size", "target", "n", copies.alias("copies"), F.ceil(F.col("n") / PER_BUCKET).cast("int").alias("buckets")))
    # Large sources are broadcast, the rows of the others shuffled to theirs.
    rows = lookup(slim.select(key, "*"), goals.withColumn("n_rows", F.col("n")), ["_source"], "n_rows", n_docs)
    rows = durable(rows.withColumn("fraction", F.col("copies") - F.floor("copies")).withColumn("large", large))
    # From here on a row carries all it needs of its source.
    base_columns = ["id", "source", "size", "draw", "source_size", "target", "copies"]

    parts = rows.groupBy("source").agg(F.sum(F.when(large, 0).otherwise(F.col("size"))).alias("small"))
    big = rows.where("large").join(parts.select(F.col("source").alias("_s"), "small"), F.col("source").eqNullSafe(F.col("_s")))
    kind = schema_of(docs, id_col, "id")
    base = f"{kind}, source {docs.schema[source_col].dataType.simpleString()}, size long, draw long, source_size long, target double, copies double"
    big = big.select(*base_columns, "_source", "n", "fraction", "small").groupBy("source")
    big = durable(big.applyInArrow(lambda t: _settle_large(t, seed), f"{base}, _source string, n long, fraction double, small long, up boolean, shift double"))
    shifts = big.groupBy("_source", "n").agg(F.first("shift").alias("shift"))
    small = lookup(rows.where("not large").drop("n"), shifts, ["_source"], "n", n_docs, "left")
    chance = F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.col("fraction") + F.coalesce("shift", F.lit(0.0))))
    small = small.select(*base_columns, (chance * F.col("size")).alias("mass"), F.pmod("draw", "buckets").cast("int").alias("bucket"))
    kept = ["id", "source", "size", "source_size", "target", "copies", "up"]
    most_buckets = goals.agg(F.max("buckets")).first()[0] or 1
    form = f"{base}, mass double, bucket int, up boolean"
    level = durable(small.groupBy("source", "bucket").applyInArrow(_settler(seed, False), form))
    settled, still = [big.select(*kept), level.where("up is not null").select(*kept)], level.where("up is null").drop("up")
    while True:
        last, most_buckets = most_buckets <= FAN_IN, -(-most_buckets // FAN_IN)
        merged = still.withColumn("bucket", F.expr(f"cast(bucket div {FAN_IN} as int)")).groupBy("source", "bucket")
        level = durable(merged.applyInArrow(_settler(seed, last), form))
        settled.append(level.where("up is not null").select(*kept))
        if last:
            break
        still = level.where("up is null").drop("up")
    every = settled[0]
    for part in settled[1:]:
        every = every.unionByName(part)
    copies = (F.floor("copies") + F.col("up").cast("int")).cast("int")
    return every.select(F.col("id").alias(id_col), F.col("source").alias(source_col), "size", "source_size", "target", copies.alias("n_copies"), (copies * F.col("size")).cast("long").alias("taken"))


def copies(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", seed: int = 0) -> DataFrame:
    """The documents as often as the mix takes them, with all columns.

    Ids that occur once are looked up by id; rows of other ids by (id, source, size), and rows that
    agree in these share their copies in turn.
    """
    chosen = durable(mix(docs, id_col, source_col, text_col, seed=seed).select(F.col(id_col).alias("id"), F.col(source_col).alias("from"), "size", "n_copies"))
    ids = durable(chosen.groupBy("id").agg(F.count("*").alias("n_rows"), F.sum("n_copies").alias("n_copies")))
    key, of, size, n, rows, place, copy = (free(docs, x) for x in ("own_id", "own_source", "own_size", "own_copies", "own_rows", "own_place", "own_copy"))
    times = lambda df, count: df.where(count > 0).withColumn(copy, F.explode(F.sequence(F.lit(1), count.cast("int")))).select(*docs.columns)
    once = bounded(durable(ids.where("n_rows = 1").select(F.col("id").alias(key), F.col("n_copies").alias(n))))
    plain = times(docs.join(once, docs[id_col].eqNullSafe(F.col(key))), F.col(n))
    again = by_id(docs, id_col, durable(ids.where("n_rows > 1").select("id")), "left_semi")
    again = again.withColumn(size, F.coalesce(F.regexp_count(text_col, F.lit(WORD)), F.lit(0)).cast("long"))
    again = again.withColumn(place, F.row_number().over(Window.partitionBy(id_col, source_col, size).orderBy(F.col(text_col).asc_nulls_last())))
    keyed = chosen.groupBy("id", "from", "size").agg(F.count("*"), F.sum("n_copies")).toDF(key, of, f"_{size}", rows, n)
    again = again.join(keyed, again[id_col].eqNullSafe(F.col(key)) & again[source_col].eqNullSafe(F.col(of)) & (F.col(size) == F.col(f"_{size}")))
    share = F.floor(F.col(n) / F.col(rows)) + (F.col(place) <= F.col(n) % F.col(rows)).cast("int")
    return plain.unionByName(times(again, share))
