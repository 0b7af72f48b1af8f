"""Language-model scores from a hidden Markov model over words.

Hidden states emit word classes: each of the CLASSES most frequent training words is a class of its
own, all other words are in one of TAILS classes by their last bytes, and the end of a text is a
class. A word of a tail class then has its add-one share of that class, from exact counts over all
training texts, so every word, known or not, has emissions that depend on the state. Baum-Welch
counts are summed over partitions in Spark, STEPS times, and only the table of states by classes, of
a fixed size, comes to the driver. Training and scoring read whole texts: the scaled recursions run
over a text's whole length. Stretches of PIECE tokens of long texts run side by side; how each
carries a state distribution from its first to its last token is a product of matrices, which gives
the exact distributions at all stretches' ends first. Memory is a few bytes a token.

Counts of the FREQUENT most frequent words travel to the tasks (that number bounds them). All other
words are joined with the full counts by a shuffle, so the vocabulary may have any size.

Defined results: a null text is the empty text, whose only token is the end. A null id is never in
training and not held out. Without training texts all counts are 0 and the score is that of the first
model, whose emissions are nearly even over classes. Repeated rows each get their row. Other columns are not read.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapelens.llm.common import blocks, durable, frequent, schema_of, small_batches, utf8

STATES, STEPS = 8, 5
CLASSES, TAILS, FREQUENT = 8192, 2048, 1 << 17
#: Tokens of a stretch of both recursions, and stretches that run side by side.
PIECE, LANES = 256, 1024
#: Tokens from one scaling of probabilities to the next: doubles hold the product of far more.
SCALED = 4
#: Bytes of a word's end that choose its tail class.
TAIL_BYTES = 3
#: Words counted in a task before they are handed on.
HELD = 300_000


def word_counts(docs: DataFrame, learn: Column, text_col: str = "text") -> tuple[DataFrame, int]:
    """(word, n) over the lower-cased words of training texts; how many texts there are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[bytes] = Counter()
        for block in blocks(batches, "t"):
            for text in utf8(block, "t"):
                held.update(text.lower().split())
            if len(held) >= HELD:
                yield pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.binary()), pa.array(held.values(), pa.int64())], names=["word", "n"])
                held = Counter()
        yield pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.binary()), pa.array(held.values(), pa.int64())], names=["word", "n"])

    rows = docs.where(learn)
    counted = rows.select(F.col(text_col).alias("t")).mapInArrow(run, "word binary, n long")
    return durable(counted.groupBy("word").agg(F.sum("n").alias("n"))), rows.count()


def frequent_words(counts: DataFrame, most: int) -> pd.DataFrame:
    """The words of the highest counts, sorted by count and word, at most so many."""
    found = frequent(counts, most).toArrow().to_pandas()
    return found.sort_values(["n", "word"], ascending=[False, True], ignore_index=True)


def tail_class(word: bytes, n_tails: int) -> int:
    return zlib.crc32(word[-TAIL_BYTES:]) % n_tails


@dataclass
class Model:
    """Start (states), trans (states, states) and emit (classes, states) probabilities."""

    start: np.ndarray
    trans: np.ndarray
    emit: np.ndarray


def first_model(class_counts: np.ndarray, states: int = STATES, seed: int = 1) -> Model:
    """States that tend to stay, with emissions around the class shares."""
    share = (class_counts + 1) / (class_counts + 1).sum()
    emit = share[:, None] * np.exp(np.random.default_rng(seed).normal(size=(len(share), states)))
    trans = np.full((states, states), 0.1 / states) + 0.9 * np.eye(states)
    return Model(np.full(states, 1 / states), trans, emit / emit.sum(0))


class Stretches:
    """Sequences cut into stretches of PIECE tokens, with the exact state distributions where they meet.

    ahead: for each stretch the states' distribution at the token before it (unused in the first of a sequence).
    behind: for each stretch the probability of what follows it, by state, up to a factor.
    """

    def __init__(self, model: Model, seqs: list[np.ndarray], both: bool):
        piece = PIECE if both else 4 * PIECE  # forward alone more sequences run at once, and fewer need be cut
        lengths = np.array([len(s) for s in seqs])
        counts = -(-lengths // piece)
        self.flat = np.concatenate(seqs) if seqs else np.zeros(0, "<u2")
        self.of = np.repeat(np.arange(len(seqs)), counts)
        place = np.arange(len(self.of)) - np.repeat(np.cumsum(counts) - counts, counts)
        self.begin = np.repeat(np.cumsum(lengths) - lengths, counts) + place * piece
        self.size = np.minimum(piece, lengths[self.of] - place * piece)
        self.first, n = place == 0, len(model.start)
        self.ahead, self.behind = np.zeros((len(self.of), n)), np.ones((len(self.of), n))
        if (counts > 1).any():
            self._meet(model, counts, both)

    def _meet(self, model: Model, counts: np.ndarray, both: bool) -> None:
        long = np.flatnonzero(counts[self.of] > 1)
        n = len(model.start)
        carry = np.zeros((len(self.of), n, n))
        for some in np.array_split(long, max(1, len(long) // LANES)):
            # Row s of a stretch: from state s before it (or from s as its first state) to the states at its end.
            # Stretches come last here, side by side in memory: products over the few states would be slow.
            for lanes, t, seen in self._steps(model, some):
                seen = np.ascontiguousarray(seen.T)
                if t:
                    going = held[:, :, : len(lanes)]
                    np.multiply(model.trans.T @ going, seen, out=going)
                else:
                    of = lanes
                    held = np.where(self.first[lanes], np.eye(n)[:, :, None], model.trans[:, :, None]) * seen
                    going = held
                if t % SCALED == SCALED - 1:
                    going /= going.sum((0, 1))
            carry[of] = np.moveaxis(held / held.sum((0, 1)), 2, 0)
        now = np.zeros(n)
        for s in long.tolist():
            if self.first[s]:
                now = model.start
            else:
                self.ahead[s] = now
            now = now @ carry[s]
            now = now / now.sum()
        for s in long[::-1].tolist() if both else ():
            if s + 1 == len(self.of) or self.of[s + 1] != self.of[s]:
                now = np.ones(n)
            else:
                now = carry[s + 1] @ now
                now = now / now.sum()
                self.behind[s] = now

    def _steps(self, model: Model, some: np.ndarray) -> Iterator[tuple[np.ndarray, int, np.ndarray]]:
        """(stretches still going, step, emissions of their tokens), the longest stretches first."""
        some = some[np.argsort(-self.size[some], kind="stable")]
        begin, size = self.begin[some], self.size[some]
        goings = np.searchsorted(-size, -np.arange(size[0]), "left").tolist()
        for t, going in enumerate(goings):
            yield some[:going], t, model.emit.take(self.flat.take(begin[:going] + t), axis=0)

    def forward(self, model: Model, some: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray | None, np.ndarray]]:
        """(stretches, state probabilities since the last scaling, scales where it is a step to scale, emissions) of each step."""
        alpha, ones = np.zeros((0, len(model.start))), np.ones((len(model.start), 1))
        for lanes, t, seen in self._steps(model, some):
            into = alpha[: len(lanes)] @ model.trans if t else np.where(self.first[lanes, None], model.start, self.ahead[lanes] @ model.trans)
            alpha, scale = into * seen, None
            if t % SCALED == SCALED - 1:
                scale = alpha @ ones
                alpha = alpha / scale
            yield lanes, alpha, scale, seen

    def groups(self) -> list[np.ndarray]:
        """All stretches, LANES at a time."""
        return np.array_split(np.arange(len(self.of)), max(1, -(-len(self.of) // LANES))) if len(self.of) else []


def log_likelihoods(model: Model, seqs: list[np.ndarray]) -> np.ndarray:
    """Natural log of each sequence's probability by the scaled forward recursion; sequences are not empty."""
    runs = Stretches(model, seqs, both=False)
    total = np.zeros(len(runs.of))
    for some in runs.groups():
        before, last = some[:0], np.zeros((0, len(model.start)))
        for lanes, alpha, scale, _ in runs.forward(model, some):
            total[before[len(lanes) :]] += np.log(last[len(lanes) :].sum(1))
            if scale is not None:
                total[lanes] += np.log(scale[:, 0])
            before, last = lanes, alpha
        total[before] += np.log(last.sum(1))
    return np.bincount(runs.of, weights=total, minlength=len(seqs))


def expected_counts(model: Model, seqs: list[np.ndarray], start: np.ndarray, trans: np.ndarray, emit: np.ndarray) -> None:
    """Add the expected counts of the sequences, by forward and backward recursions."""
    runs = Stretches(model, seqs, both=True)
    for some in runs.groups():
        kept = list(runs.forward(model, some))
        change, gammas = np.zeros_like(trans), []
        last = np.zeros((len(runs.of), len(start)))  # the states' probabilities at each stretch's last token
        for (lanes, alpha, _, _), going in zip(kept, [*(len(x[0]) for x in kept[1:]), 0], strict=True):
            last[lanes[going:]] = alpha[going:]
        after = runs.behind[some] / (last[some] * runs.behind[some]).sum(1, keepdims=True)
        tail = np.zeros_like(last)
        tail[some] = after
        beta = np.zeros((0, len(start)))
        for t in range(len(kept) - 1, -1, -1):
            lanes, alpha, scale, seen = kept[t]
            # Stretches that end here come in with what follows them.
            beta = np.concatenate([beta, tail[lanes[len(beta) :]]])
            gammas.append(alpha * beta)
            ahead = seen * beta if scale is None else seen * beta / scale
            if t:
                change += kept[t - 1][1][: len(lanes)].T @ ahead
            else:
                change += (runs.ahead[lanes] * ~runs.first[lanes, None]).T @ ahead
            beta = ahead @ model.trans.T
        start += gammas[-1][runs.first[kept[0][0]]].sum(0)
        trans += change * model.trans
        gamma = np.concatenate(gammas)
        classes = np.concatenate([runs.flat[runs.begin[lanes] + t] for t, (lanes, *_) in reversed(list(enumerate(kept)))])
        for k in range(emit.shape[1]):
            emit[:, k] += np.bincount(classes, weights=gamma[:, k], minlength=len(emit))


def _unpack(batch: pa.RecordBatch) -> list[np.ndarray]:
    return [np.frombuffer(x, "<u2") for x in batch.column("classes").to_pylist()]


def step(encoded: DataFrame, model: Model, share: np.ndarray) -> Model:
    """One Baum-Welch step over all training rows; share: class shares that smooth the emissions."""
    shared = encoded.sparkSession.sparkContext.broadcast(model)
    states, n_classes = len(model.start), len(model.emit)
    columns = [f"g{k}" for k in range(states)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now = shared.value
        start, trans, emit = np.zeros(states), np.zeros((states, states)), np.zeros((n_classes, states))
        for block in blocks(batches, "classes", 1 << 20):
            expected_counts(now, _unpack(block), start, trans, emit)
        table = np.vstack([emit, trans, start])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(table)), pa.int32()), *[pa.array(table[:, k]) for k in range(states)]], names=["row", *columns])

    summed = encoded.where("learn").select("classes").mapInArrow(run, "row int, " + ", ".join(f"{c} double" for c in columns))
    found = summed.groupBy("row").agg(*[F.sum(c).alias(c) for c in columns]).orderBy("row").toPandas()  # classes + states + 1 rows
    table = found[columns].to_numpy() if len(found) else np.zeros((n_classes + states + 1, states))
    emit, trans, start = table[:n_classes] + share[:, None], table[n_classes:-1] + 0.01, table[-1] + 0.01
    return Model(start / start.sum(), trans / trans.sum(1, keepdims=True), emit / emit.sum(0))


def score(docs: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text", states: int = STATES, steps: int = STEPS, n_classes: int = CLASSES, n_tails: int = TAILS, most_frequent: int = FREQUENT) -> DataFrame:
    """(id, n_tokens, n_known, train_tokens, base_score, score) of every document; scores are log10."""
    spark = docs.sparkSession
    small_batches(spark)
    rows = docs.select(docs[id_col], F.col(text_col).alias("t"), F.coalesce(learn, F.lit(False)).alias("learn"))
    counts, n_texts = word_counts(rows, F.col("learn"), "t")
    n_words, n_distinct = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    train, distinct = n_words + n_texts, n_distinct + (n_texts > 0)
    top = frequent_words(counts, most_frequent)
    n_own = min(n_classes, len(top))
    end = n_own + n_tails
    own = spark.createDataFrame(pd.DataFrame({"word": top["word"].iloc[:n_own]}), "word binary")
    tails = counts.join(F.broadcast(own), "word", "left_anti").groupBy((F.crc32(F.substring("word", -TAIL_BYTES, TAIL_BYTES)) % n_tails).cast("int").alias("tail"))
    tails = tails.agg(F.sum("n"), F.count("*")).toArrow()  # n_tails rows at most
    tail_n, tail_words = np.zeros(n_tails), np.zeros(n_tails)
    tail_n[tails[0].to_numpy()], tail_words[tails[0].to_numpy()] = tails[1].to_numpy(), tails[2].to_numpy()
    #: Of each tail class: its training tokens and distinct words, plus one for those never seen.
    rest_scale = np.log10(tail_n + tail_words + 1)
    number = {w: i for i, w in enumerate(top["word"])}
    class_of = np.array([*range(n_own), *(n_own + tail_class(w, n_tails) for w in top["word"].iloc[n_own:])], np.uint16)
    known = spark.sparkContext.broadcast((number, top["n"].to_numpy(np.int64), class_of))
    base_scale = np.log10(train + distinct + 1)
    end_base = float(np.log10(n_texts + 1) - base_scale)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, n, class_of = known.value
        find = number.get
        base, rest = np.log10(n + 1) - base_scale, np.log10(n + 1)
        key = TaskContext.get().partitionId() << 40
        for block in blocks(batches, "t", 1 << 20):
            out = []
            for text in utf8(block, "t"):
                words = text.lower().split()
                ids = np.fromiter(map(find, words, repeat(-1)), np.int64, len(words))
                lost_at = np.flatnonzero(ids < 0).tolist()
                seen = ids[ids >= 0]
                packed = np.full(len(ids) + 1, end, "<u2")
                packed[:-1][ids >= 0] = class_of[seen]
                packed[lost_at] = [n_own + tail_class(words[i], n_tails) for i in lost_at]
                lost = Counter([words[i] for i in lost_at])
                tail = packed[packed >= n_own][:-1] - n_own  # all but the end
                share = float(rest[seen[seen >= n_own]].sum() - rest_scale[tail].sum())
                out.append((key, len(words) + 1, len(seen) + (n_texts > 0), float(base[seen].sum()) + end_base, share, packed.tobytes(), [{"word": w, "k": k} for w, k in lost.items()]))
                key += 1
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.binary(), pa.list_(pa.struct([("word", pa.binary()), ("k", pa.int32())]))]
            names = ["key", "n_tokens", "n_seen", "base", "rest", "classes", "lost"]
            yield pa.RecordBatch.from_arrays([block.column(id_col), block.column("learn"), *[pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)]], names=[id_col, "learn", *names])

    form = f"{schema_of(docs, id_col)}, learn boolean, key long, n_tokens long, n_seen long, base double, rest double, classes binary, lost array<struct<word:binary,k:int>>"
    encoded = durable(rows.mapInArrow(encode, form))

    shares = np.concatenate([top["n"].iloc[:n_own], tail_n, [n_texts]]).astype(float)
    model = first_model(shares, states)
    smooth = (shares + 1) / (shares + 1).sum()
    for _ in range(steps if n_texts else 0):
        model = step(encoded, model, smooth)
    final = spark.sparkContext.broadcast(model)

    def forward(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, "classes", 1 << 22):
            likelihood = log_likelihoods(final.value, _unpack(block)) / np.log(10)
            keep = [block.column(c) for c in (id_col, "key", "n_tokens", "n_seen", "base", "rest")]
            yield pa.RecordBatch.from_arrays([*keep, pa.array(likelihood)], names=[id_col, "key", "n_tokens", "n_seen", "base", "rest", "hmm"])

    scored = encoded.select(id_col, "key", "n_tokens", "n_seen", "base", "rest", "classes")
    scored = scored.mapInArrow(forward, f"{schema_of(docs, id_col)}, key long, n_tokens long, n_seen long, base double, rest double, hmm double")
    lost = encoded.select("key", F.inline("lost")).join(counts.withColumnRenamed("n", "c"), "word", "left").withColumn("c", F.coalesce("c", F.lit(0)))
    plus = F.col("k") * F.log10(F.col("c") + 1)
    lost = lost.groupBy(F.col("key").alias("of")).agg(F.sum("k").alias("k"), F.sum(F.when(F.col("c") > 0, F.col("k")).otherwise(0)).alias("k_seen"), F.sum(plus).alias("plus"))
    out = scored.join(lost, F.col("key") == F.col("of"), "left")
    get = lambda c: F.coalesce(F.col(c), F.lit(0))
    return out.select(
        id_col,
        "n_tokens",
        (F.col("n_seen") + get("k_seen")).alias("n_known"),
        F.lit(train).cast("long").alias("train_tokens"),
        (F.col("base") + get("plus") - get("k") * float(base_scale)).alias("base_score"),
        (F.col("hmm") + F.col("rest") + get("plus")).alias("score"),
    )
