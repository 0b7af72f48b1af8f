import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tapelens.llm import queries, whitening


def dense(rows):
    """(n, sums, covariance of the integers) by brute force."""
    x = [[math.floor(64 * float(c)) + 1_000_000 for c in r] for r in rows]
    n, sums = len(x), [sum(c) for c in zip(*x, strict=True)]
    y = np.array([[(n * c - s) / n for c, s in zip(r, sums, strict=True)] for r in x])
    return x, n, sums, y.T @ y / n, y


@pytest.mark.parametrize(("d", "wanted", "kind"), [(1, 1, "any"), (6, 6, "any"), (64, 32, "any"), (200, 32, "any"), (200, 32, "close"), (48, 32, "equal"), (64, 32, "low rank")])
def test_leading_pairs(d, wanted, kind):
    r = np.random.default_rng(d)
    q = np.linalg.qr(r.standard_normal((d, d)))[0]
    values = {"any": r.random(d) * 50 + 1, "close": 60 + 0.01 * np.arange(d), "equal": np.repeat(np.arange(1.0, d // 4 + 1), 4), "low rank": np.where(np.arange(d) < 7, 1.0 + np.arange(d), 0)}[kind]
    values = np.sort(values)[::-1]
    a = q * values @ q.T
    a = (a + a.T) / 2
    found, vectors = whitening.jacobi_davidson(lambda w: a @ w, d, wanted)
    assert np.abs(found - values[:wanted]).max() < 1e-11 * values[0]
    assert np.linalg.norm(a @ vectors - vectors * found, axis=0).max() < 1e-11 * values[0]
    assert np.abs(vectors.T @ vectors - np.eye(wanted)).max() < 1e-12


def test_minres_solves_each_column():
    r = np.random.default_rng(1)
    a = r.standard_normal((12, 12))
    a = a + a.T  # indefinite
    b = np.hstack([r.standard_normal((12, 3)), np.zeros((12, 1)), np.linalg.eigh(a)[1][:, :1]])
    assert np.abs(a @ whitening.minres(lambda v: a @ v, b, 30) - b).max() < 1e-8


def test_query_by_brute_force(spark, sf):
    table = spark.read.parquet(f"{sf}/embeddings.parquet").orderBy("vec_id").collect()
    x, n, sums, v, y = dense([r.embedding for r in table])
    values, vectors = np.linalg.eigh(v)
    values, vectors = values[::-1], vectors[:, ::-1]
    got = queries.op11_embedding_whitening(spark, sf).orderBy("vec_id", "component").collect()
    assert len(got) == len(table) * 32 and {(r.n, r.component) for r in got} == {(n, c) for c in range(1, 33)}
    assert [r.deviation for r in got[::32]] == [sum((n * c - s) ** 2 for c, s in zip(row, sums, strict=True)) for row in x]
    white = np.array([r.whitened for r in got]).reshape(-1, 32)
    want = y @ vectors[:, :32] / np.sqrt(values[:32])
    assert np.abs(white * np.sign((white * want).sum(0)) - want).max() < 1e-8
    assert np.allclose([r.explained for r in got[:32]], values[:32] / np.trace(v), rtol=1e-10)
    assert len({r.identity_error for r in got}) == 1 and got[0].identity_error < 1e-9
    assert np.abs(white.T @ white / n - np.eye(32)).max() < 1e-9


def test_sums_meet_in_a_tree(spark, monkeypatch):
    vectors = spark.range(999).select("id", F.array(*[(F.col("id") * k % 17).cast("long") for k in (1, 3, 5)]).alias("x")).repartition(11)
    blocks = whitening.packed(vectors, 3)
    plain = whitening.total(blocks, 3, lambda x: x.sum(0), (3,), "<i8")
    monkeypatch.setattr(whitening, "REDUCE_BYTES", 1)  # two at a time
    assert whitening.total(blocks, 3, lambda x: x.sum(0), (3,), "<i8").tolist() == plain.tolist() == [sum(i * k % 17 for i in range(999)) for k in (1, 3, 5)]


NAN, INF = float("nan"), float("inf")
VECTORS = [(1, [1.0, 2.0, 0.5]), (2, [0.25, -1.0, 3.0]), (2, [0.25, -1.0, 3.0]), (None, [4.0, 1.5, -2.0]), (3, None), (4, [1.0, None, 2.0]), (5, [1.0, NAN, 2.0]), (6, [INF, 0.0, 0.0]), (7, []), (8, [1.0, 2.0]), (9, [-3.0, 0.1, 1e30])]


def test_odd_vectors(spark):
    form = "vec_id long, embedding array<float>, x string, n string, whitened string, component string"
    table = spark.createDataFrame([(i, v, "clash", "clash", "clash", "clash") for i, v in VECTORS], form)
    got = whitening.whiten(table).collect()
    kept = [(1, [1.0, 2.0, 0.5]), (2, [0.25, -1.0, 3.0]), (2, [0.25, -1.0, 3.0]), (None, [4.0, 1.5, -2.0]), (9, [-3.0, 0.1, float(1 << 24)])]
    x, n, sums, v, _ = dense([k[1] for k in kept])
    # The third direction has under 1e-9 of the largest variance, and so is not spanned.
    found = np.linalg.eigvalsh(v)
    spanned = int((found > 1e-9 * found[-1]).sum())
    assert sorted((str(r.vec_id), r.component) for r in got) == sorted((str(i), c) for i, _ in kept for c in range(1, spanned + 1))
    exact = [sum((n * c - s) ** 2 for c, s in zip(row, sums, strict=True)) for row in x]
    assert {r.deviation for r in got} == {v if v < 1 << 63 else None for v in exact} and max(exact) >= 1 << 63
    small = whitening.whiten(table.where("vec_id < 3 OR vec_id IS NULL"), 2)
    assert small.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"] and small.count() == 8
    assert sum({r.component: r.explained for r in whitening.whiten(table.where("vec_id < 3 OR vec_id IS NULL")).collect()}.values()) == pytest.approx(1)


def test_nothing_to_whiten(spark):
    table = spark.createDataFrame(VECTORS, "vec_id long, embedding array<float>")
    assert whitening.whiten(table.limit(0)).count() == 0
    assert whitening.whiten(table.where("vec_id = 1")).count() == 0  # one vector
    assert whitening.whiten(table.where("vec_id = 2")).count() == 0  # equal ones
    assert whitening.whiten(table.where("vec_id IN (3, 4, 7)")).count() == 0


def test_deviations_beyond_long():
    n, x = 10**6, np.array([[1 << 30], [-(1 << 30)], [5]], np.int64)
    sums = [7 * 10**6]
    want = [(n * int(v) - sums[0]) ** 2 for v in x.ravel()]
    assert whitening.deviations(x, n, sums) == [w if w < 1 << 63 else None for w in want] and want[2] < 1 << 63 < want[0]
