import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tapelens.llm import mixing, queries


def level(sizes):
    """Targets by reshared weights, for {source: size}."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    out, total = {}, sum(sizes.values())
    while len(out) < len(sizes):
        rest = total - sum(out.values())
        share = {s: rest * weight[s] / sum(weight[x] for x in sizes if x not in out) for s in sizes if s not in out}
        over = [s for s in share if share[s] > 3 * sizes[s]]
        if not over:
            return out | share
        out |= {s: 3 * sizes[s] for s in over}
    return out


def test_targets(spark):
    sizes = {"a": 10, "b": 1000, "c": 5, None: 700, "Z": 1, "é": 900}
    table = spark.createDataFrame([(k, v) for k, v in sizes.items()], "source string, source_size long")
    got = {r.source: r.target for r in mixing.targets(table).collect()}
    assert got == pytest.approx(level(sizes))


def test_pivot_keeps_sum_and_chances():
    counts, n = Counter(), 4000
    sizes, masses = [3.0, 5.0, 2.0, 8.0], [1.0, 2.5, 1.0, 3.5]
    for seed in range(n):
        draw = random.Random(seed)
        out, left = mixing.pivot(sizes, masses, draw)
        assert sum(out) == pytest.approx(8.0)
        assert all(m in (0, s) for i, (m, s) in enumerate(zip(out, sizes, strict=True)) if i != left)
        for i, m in enumerate(out):
            counts[i] += m / n
    assert [counts[i] for i in range(4)] == pytest.approx(masses, abs=0.15)


@pytest.mark.parametrize("bucket", [50, 20_000])
def test_documents(spark, bucket, monkeypatch):
    monkeypatch.setattr(mixing, "PER_BUCKET", bucket)
    monkeypatch.setattr(mixing, "FAN_IN", 2)
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = mixing.mix(docs).toPandas()
    assert sorted(rows.doc_id) == list(range(1000))
    assert rows.set_index("doc_id")["size"].to_dict() == {r.doc_id: len(r.text.split()) for r in docs.collect()}
    goal = level(rows.groupby("source")["size"].sum().to_dict())
    for source, part in rows.groupby("source"):
        assert part.target.iloc[0] == pytest.approx(goal[source])
        assert abs(part.taken.sum() - goal[source]) <= 0.03 * goal[source]
    assert (rows.taken <= 3 * rows["size"]).all() and (rows.taken >= 0).all()
    again = mixing.mix(docs.repartition(7)).toPandas()
    key = ["doc_id", "taken"]
    assert rows[key].sort_values(key).values.tolist() == again[key].sort_values(key).values.tolist()


def test_odd_rows(odd, none):
    got = mixing.mix(odd).collect()
    assert len(got) == odd.count() and all(0 <= r.taken <= 3 * r.size for r in got)
    assert mixing.mix(none).count() == 0
    mixed = mixing.copies(odd)
    assert mixed.columns == odd.columns and mixed.count() == sum(r.n_copies for r in got)


def test_rows_without_ids_spread(spark):
    """Null ids of one size lie in all buckets alike, in every order of the rows."""
    docs = spark.range(30_000).select(F.lit(None).cast("long").alias("doc_id"), F.concat(F.lit("two w"), F.col("id").cast("string")).alias("text"), F.lit("a").alias("source"))
    buckets = {r.b: r["count"] for r in mixing.drawn(docs).groupBy(F.pmod("draw", F.lit(15)).alias("b")).count().collect()}
    assert len(buckets) == 15 and max(buckets.values()) < 2_300
    got, again = (sorted((r.taken, r["count"]) for r in mixing.mix(df).groupBy("taken").count().collect()) for df in (docs, docs.repartition(5)))
    assert got == again and sum(n for _, n in got) == 30_000


def test_query(spark, sf):
    assert queries.op4_mixing(spark, sf).columns == ["doc_id", "size", "source_size", "target", "taken"]
