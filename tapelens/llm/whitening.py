"""Embedding whitening: the leading eigenvectors of a covariance that is never formed, by block Jacobi-Davidson.

Vectors are packed once into blocks of integers in the shared folder. The covariance is known only by
its products with a few columns: each task multiplies its centred blocks, twice, and the tasks' sums
meet in a tree of bounded fan-in, so that the driver holds matrices of dimension by columns and never
a row of the table. Around that product runs a Jacobi-Davidson iteration for all wanted pairs at once:

* Rayleigh-Ritz in a subspace gives approximate pairs and their residuals;
* pairs whose residuals are at rounding level are locked, in order, and projected out of all that follows;
* for each other pair the projected correction equation is solved by some steps of MINRES, all pairs in
  step, so that a step is one distributed product;
* the corrections widen the subspace, which restarts from its best vectors beyond a stated width.

It ends when all wanted pairs are locked. The start is a fixed seed and sums are added in a fixed order, so reruns on the
same files agree.

Defined results: an entry c becomes floor(64 * c) + 1000000, for c held within 2**24. Rows whose vector
is null, or has a null, NaN or infinite entry, have no result; nor do vectors of another length than most
(ties: the shorter; an empty vector never counts). Null and repeated ids are rows like any other. Components
whose eigenvalue is under 1e-9 of the largest have no rows: the data do not span them. A single vector, or
only equal ones, therefore give an empty result, and so does an empty table. Among equal eigenvalues any
orthonormal choice may be returned. A deviation over 2**63 - 1 is null. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapelens.llm.common import durable, schema_of, slim

SCALE, OFFSET, LARGEST = 64, 1_000_000, 1 << 24
BLOCK_BYTES, REDUCE_BYTES = 4 << 20, 64 << 20
#: Rank: eigenvalues under this part of the largest are taken as zero.
LEAST_PART = 1e-9
#: Columns beside the wanted ones in the subspace, MINRES steps for each correction.
GUARD, INNER_STEPS = 8, 8


def integers(rows: DataFrame, id_col: str, vec_col: str) -> tuple[DataFrame, int]:
    """(id, x array<long>) of the valid vectors of the most frequent length, and that length (0: none)."""
    vector = F.col("vector")
    entry = lambda v: v.cast("double")
    bad = lambda v: v.isNull() | F.isnan(entry(v)) | (F.abs(entry(v)) == float("inf"))
    scaled = lambda v: F.floor(F.least(F.greatest(entry(v), F.lit(-float(LARGEST))), F.lit(float(LARGEST))) * SCALE).cast("long") + OFFSET
    source = slim(rows, id_col, vec_col).toDF("id", "vector")
    valid = source.where(vector.isNotNull() & (F.size(vector) > 0) & ~F.coalesce(F.exists(vector, bad), F.lit(True)))
    most = valid.groupBy(F.size(vector).alias("d")).count().orderBy(F.desc("count"), "d").limit(1).collect()
    d = most[0]["d"] if most else 0
    return valid.where(F.size(vector) == d).select("id", F.transform(vector, scaled).alias("x")), d


def _matrix(column: pa.Array, d: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, d)


def packed(vectors: DataFrame, d: int) -> DataFrame:
    """(data): blocks of vectors as 32-bit integers, row by row, in the shared folder."""
    most = max(1, BLOCK_BYTES // (4 * d))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def block() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([np.concatenate(held).astype("<i4").tobytes()], pa.binary())], names=["data"])

        for batch in batches:
            x = _matrix(batch.column("x"), d)
            while len(x):
                room = most - sum(map(len, held))
                held.append(x[:room])
                x = x[room:]
                if sum(map(len, held)) == most:
                    yield block()
                    held = []
        if held:
            yield block()

    return durable(vectors.select("x").mapInArrow(run, "data binary"))


def total(blocks: DataFrame, d: int, part: Callable[[np.ndarray], np.ndarray], shape: tuple[int, ...], dtype: str = "<f8") -> np.ndarray:
    """The sum of part(x) over all blocks x. A task adds its own; tasks' sums meet in a tree, in the order of the tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = None
        for batch in batches:
            for data in batch.column("data").to_pylist():
                y = part(np.frombuffer(data, "<i4").reshape(-1, d).astype(np.int64))
                out = y if out is None else out + y
        if out is not None:
            yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int64()), pa.array([out.astype(dtype).tobytes()], pa.binary())], names=["task", "data"])

    def added(key: tuple, table: pa.Table) -> pa.Table:
        rows = table.sort_by("task").column("data").to_pylist()
        out = sum((np.frombuffer(r, dtype) for r in rows[1:]), np.frombuffer(rows[0], dtype))
        return pa.table({"task": [key[0].as_py()], "data": [out.tobytes()]}, schema=pa.schema([("task", pa.int64()), ("data", pa.binary())]))

    sums, tasks = blocks.mapInArrow(run, "task long, data binary"), blocks.rdd.getNumPartitions()
    fan_in = max(2, min(512, REDUCE_BYTES // (8 * int(np.prod(shape)))))
    while tasks > fan_in:
        sums = sums.groupBy(F.floor(F.col("task") / fan_in).alias("group")).applyInArrow(added, "task long, data binary")
        tasks = -(-tasks // fan_in)
    out = np.zeros(int(np.prod(shape)), dtype)
    for row in sorted(sums.collect(), key=lambda r: r["task"]):
        out = out + np.frombuffer(row["data"], dtype)
    return out.reshape(shape)


@dataclass
class Fit:
    """What the fit list says: its size, the sums of each dimension, unit eigenvectors as columns, eigenvalues, the trace."""

    n: int
    sums: list[int]
    vectors: np.ndarray
    values: np.ndarray
    trace: float
    identity_error: float

    def centred(self, x: np.ndarray) -> np.ndarray:
        return _centred(self.n, self.sums)(x)

    def whiten(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ self.vectors / np.sqrt(self.values)


def _centred(n: int, sums: list[int]) -> Callable[[np.ndarray], np.ndarray]:
    """x - sums / n: the whole part is taken off as an integer, so that only the fraction is rounded."""
    whole, rest = np.array([s // n for s in sums], np.int64), np.array([s % n / n for s in sums])
    return lambda x: (x - whole) - rest


def _orthonormal(new: np.ndarray, *others: np.ndarray) -> np.ndarray:
    """An orthonormal basis of what the columns of `new` add to the others; columns that add nothing go."""
    new = new / np.maximum(np.linalg.norm(new, axis=0), np.finfo(float).tiny)
    for _ in range(3):
        for q in others:
            new = new - q @ (q.T @ new)
        length = np.linalg.norm(new, axis=0)
        new = new[:, length > 1e-10]
        u, s, _ = np.linalg.svd(new / length[length > 1e-10], full_matrices=False)
        new = u[:, s > 1e-10 * max(1.0, s[:1].sum())] if s.size else new[:, :0]
    return new


def minres(apply: Callable[[np.ndarray], np.ndarray], b: np.ndarray, steps: int) -> np.ndarray:
    """Some steps of MINRES for each column of b, all columns in step; a column that has reached its solution stays."""
    x, w, w_before, v_before = (np.zeros_like(b) for _ in range(4))
    gamma = np.linalg.norm(b, axis=0)
    eta, v = gamma.copy(), b.copy()
    floor = 1e-15 * gamma
    s, s_before = np.zeros_like(gamma), np.zeros_like(gamma)
    c, c_before = np.ones_like(gamma), np.ones_like(gamma)
    live = gamma > 0
    for _ in range(steps):
        if not live.any():
            break
        v = v / np.where(live, gamma, 1)
        av = apply(v)
        delta = (av * v).sum(0)
        after = av - delta * v - gamma * v_before
        gamma_after = np.linalg.norm(after, axis=0)
        a0 = c * delta - c_before * s * gamma
        a1 = np.hypot(a0, gamma_after)
        a2, a3 = s * delta + c_before * c * gamma, s_before * gamma
        live = live & (a1 > 0)
        safe = np.where(live, a1, 1)
        c_before, c, s_before, s = c, a0 / safe, s, gamma_after / safe
        w_before, w = w, (v - a3 * w_before - a2 * w) / safe
        x = x + np.where(live, c * eta, 0) * w
        eta = -s * eta
        v_before, v, gamma = v, after, gamma_after
        live = live & (gamma_after > 1e-14 * np.abs(delta)) & (np.abs(eta) > floor)
    return x


def jacobi_davidson(product: Callable[[np.ndarray], np.ndarray], d: int, wanted: int, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """The `wanted` largest eigenvalues, falling, and unit eigenvectors as columns, of a symmetric product.

    A pair is locked when its residual is at the rounding level of the product, or has not fallen for three rounds in the
    last four digits above it. The subspace has at most 3 * (wanted + GUARD) columns.
    """
    width = min(d, wanted + GUARD)
    basis = _orthonormal(np.random.default_rng(seed).standard_normal((d, width)))
    image = product(basis)
    locked, values = np.zeros((d, 0)), np.zeros(0)
    best, stuck = np.inf, 0
    while True:
        small = basis.T @ image
        theta, s = np.linalg.eigh((small + small.T) / 2)
        theta, s = theta[::-1], s[:, ::-1]
        ritz, images = basis @ s, image @ s
        need = min(wanted - len(values), ritz.shape[1])
        size = max(np.abs(theta).max(initial=0), np.abs(values).max(initial=0), np.finfo(float).tiny)
        residual = images[:, :need] - ritz[:, :need] * theta[:need]
        residual -= locked @ (locked.T @ residual)
        norms = np.linalg.norm(residual, axis=0)
        rounding = 8 * np.finfo(float).eps * np.sqrt(d) * size
        stuck = stuck + 1 if norms.sum() > 0.5 * best else 0
        best = min(best, norms.sum())
        good = norms <= (rounding if stuck < 3 else 1e4 * rounding)
        first = int(np.argmin(good)) if not good.all() else need
        if first:  # in order, so that none larger is passed over
            locked, values = np.hstack([locked, ritz[:, :first]]), np.append(values, theta[:first])
            best, stuck = np.inf, 0
        ritz, images, theta = ritz[:, first:], images[:, first:], theta[first:]
        residual = residual[:, first:]
        if len(values) == wanted or locked.shape[1] == d:
            order = np.argsort(-values, kind="stable")
            return values[order], locked[:, order]
        open_ = residual.shape[1]
        near = np.hstack([locked, ritz[:, :open_]])
        near = np.linalg.qr(near)[0]
        out = lambda t, q=near: t - q @ (q.T @ t)
        shift = theta[:open_]
        step = minres(lambda t: out(product(out(t)) - shift * t), -out(residual), INNER_STEPS) if near.shape[1] < d else residual
        if ritz.shape[1] + open_ > 3 * width:  # restart from the best
            ritz, images = ritz[:, :width], images[:, :width]
        more = _orthonormal(np.hstack([step, residual]) if open_ <= GUARD else step, locked, ritz)
        if not more.shape[1]:  # the subspace is all there is: products anew, without what sums of images lose
            basis = _orthonormal(ritz, locked)
            image = product(basis)
            continue
        basis, image = np.hstack([ritz, more]), np.hstack([images, product(more)])


def fit(vectors: DataFrame, d: int, components: int = 32) -> Fit | None:
    """The leading components of the covariance (divisor n) of all vectors; None where they span nothing."""
    if not d:
        return None
    blocks = packed(vectors, d)
    first = total(blocks, d, lambda x: np.append(x.sum(0), len(x)), (d + 1,), "<i8")
    n, sums = int(first[-1]), [int(s) for s in first[:-1]]
    centred = _centred(n, sums)
    trace = float(total(blocks, d, lambda x: np.array([np.square(centred(x)).sum()]), (1,))[0]) / n
    if not trace:
        return None

    def product(w: np.ndarray) -> np.ndarray:
        def part(x: np.ndarray) -> np.ndarray:
            y = centred(x)
            return y.T @ (y @ w)

        return total(blocks, d, part, w.shape) / n

    values, found = jacobi_davidson(product, d, min(components, d))
    spanned = values > LEAST_PART * values[0]
    values, found = values[spanned], found[:, spanned]
    found = found * np.sign(found[np.abs(found).argmax(0), np.arange(found.shape[1])])
    made, k = Fit(n, sums, found, values, trace, 0.0), found.shape[1]
    mean = total(blocks, d, lambda x: made.whiten(x).sum(0), (k,)) / n

    def spread(x: np.ndarray) -> np.ndarray:
        y = made.whiten(x) - mean
        return y.T @ y

    made.identity_error = float(np.abs(total(blocks, d, spread, (k, k)) / n - np.eye(k)).max())
    return made


def deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """For each row the sum of (n * x - sums) ** 2, in integers."""
    whole, rest = np.array([s // n for s in sums], np.int64), np.array([s % n for s in sums], np.int64)
    off = x - whole
    largest = n * (int(np.abs(off).max(initial=0)) + 1)
    if largest * largest * x.shape[1] >= 1 << 63:
        off, rest = off.astype(object), rest.astype(object)
    found = np.square(n * off - rest).sum(1).tolist()
    return [v if v < 1 << 63 else None for v in found]


def whiten(rows: DataFrame, components: int = 32, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(id, component, n, deviation, whitened, explained, identity_error) of each valid row and component."""
    vectors, d = integers(rows, id_col, vec_col)
    made = fit(vectors, d, components)
    form = f"{schema_of(rows, id_col)}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    if made is None:
        return rows.sparkSession.createDataFrame([], form)
    k = len(made.values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in count(0, 2048):
                some = batch.slice(at, 2048)
                if not some.num_rows:
                    break
                x = _matrix(some.column("x"), d)
                m = len(x)
                each = pa.array(np.repeat(np.arange(m), k))
                yield pa.RecordBatch.from_arrays(
                    [
                        some.column("id").take(each),
                        pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                        pa.array(np.full(m * k, made.n, np.int64)),
                        pa.array(deviations(x, made.n, made.sums), pa.int64()).take(each),
                        pa.array(made.whiten(x).ravel()),
                        pa.array(np.tile(made.values / made.trace, m)),
                        pa.array(np.full(m * k, made.identity_error)),
                    ],
                    names=[id_col, "component", "n", "deviation", "whitened", "explained", "identity_error"],
                )

    return vectors.mapInArrow(run, form)
