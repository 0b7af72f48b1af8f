import itertools
import math
import re
from collections import Counter

import numpy as np
import pytest

from tapelens.llm import hmm, queries
from tapelens.llm.common import remainder


def tokens(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def model(states=3, classes=5, seed=0):
    draw = np.random.default_rng(seed)
    norm = lambda x, axis: x / x.sum(axis, keepdims=True)
    return hmm.Model(norm(draw.random(states), 0), norm(draw.random((states, states)), 1), norm(draw.random((classes, states)), 0))


def paths(m, seq):
    """(path, probability) of every way to produce the sequence."""
    for path in itertools.product(range(len(m.start)), repeat=len(seq)):
        p = m.start[path[0]] * m.emit[seq[0], path[0]]
        for a, b, x in zip(path, path[1:], seq[1:], strict=False):
            p *= m.trans[a, b] * m.emit[x, b]
        yield path, p


@pytest.mark.parametrize(("piece", "lanes"), [(256, 1024), (2, 3), (1, 1), (3, 100)])
def test_likelihood_and_counts_by_enumeration(monkeypatch, piece, lanes):
    """Also where texts are cut into stretches that meet."""
    monkeypatch.setattr(hmm, "PIECE", piece)
    monkeypatch.setattr(hmm, "LANES", lanes)
    m, seqs = model(), [np.array(s) for s in ([1, 0, 4, 2], [3], [2, 2, 2, 1, 0], [0, 4])]
    got = hmm.log_likelihoods(m, seqs)
    assert got == pytest.approx([math.log(sum(p for _, p in paths(m, s))) for s in seqs])
    start, trans, emit = np.zeros(3), np.zeros((3, 3)), np.zeros((5, 3))
    hmm.expected_counts(m, seqs, start, trans, emit)
    want = [np.zeros(3), np.zeros((3, 3)), np.zeros((5, 3))]
    for s in seqs:
        total = sum(p for _, p in paths(m, s))
        for path, p in paths(m, s):
            want[0][path[0]] += p / total
            for a, b in zip(path, path[1:], strict=False):
                want[1][a, b] += p / total
            for x, k in zip(s, path, strict=True):
                want[2][x, k] += p / total
    for a, b in zip((start, trans, emit), want, strict=True):
        assert a == pytest.approx(b)


def test_scaled_now_and_then_it_is_the_plain_recursion():
    """Lengths about the steps to scale, and about the cuts; tokens that are very unlikely do not vanish in between."""
    m, draw = model(8, 40), np.random.default_rng(3)
    m.emit[30:] *= 1e-20
    lengths = [*range(1, 2 * hmm.SCALED + 2), hmm.PIECE - 1, hmm.PIECE, hmm.PIECE + 1, 4 * hmm.PIECE, 4 * hmm.PIECE + 1, 3_000]
    seqs = [draw.integers(0, 40, n) for n in lengths] + [np.full(2_500, 35)]
    runs = hmm.Stretches(m, seqs, both=False)
    scales = [scale is not None for some in runs.groups() for *_, scale, _ in runs.forward(m, some)]
    assert sum(scales) == len(scales) // hmm.SCALED  # not in every step
    want = []
    for seq in seqs:
        alpha, total = m.start * m.emit[seq[0]], 0.0
        for x in [None, *seq[1:]]:
            alpha = alpha if x is None else (alpha @ m.trans) * m.emit[x]
            total += math.log(alpha.sum())
            alpha = alpha / alpha.sum()
        want.append(total)
    assert hmm.log_likelihoods(m, seqs) == pytest.approx(want, rel=1e-12)
    counts = np.zeros(8), np.zeros((8, 8)), np.zeros((40, 8))
    hmm.expected_counts(m, seqs, *counts)
    assert counts[0].sum() == pytest.approx(len(seqs)) and counts[1].sum() == pytest.approx(sum(len(x) - 1 for x in seqs))
    assert counts[2].sum(1) == pytest.approx(np.bincount(np.concatenate(seqs), minlength=40))


def test_probabilities_sum_to_one():
    m = model()
    assert sum(math.exp(hmm.log_likelihoods(m, [np.array(s)])[0]) for s in itertools.product(range(5), repeat=3)) == pytest.approx(1)


def test_a_text_of_millions_of_tokens():
    """Memory for a token stays a few bytes, and its likelihood is that of the plain recursion."""
    import tracemalloc

    m, seq = model(8, 300), np.random.default_rng(2).integers(0, 300, 3_000_000).astype("<u2")
    tracemalloc.start()
    got = hmm.log_likelihoods(m, [seq])
    counts = np.zeros(8), np.zeros((8, 8)), np.zeros((300, 8))
    hmm.expected_counts(m, [seq], *counts)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 250e6 and counts[2].sum() == pytest.approx(len(seq)) and counts[1].sum() == pytest.approx(len(seq) - 1)
    short, alpha, total = seq[:20_000], m.start * m.emit[seq[0]], 0.0
    for x in [None, *short[1:]]:
        alpha = alpha if x is None else (alpha @ m.trans) * m.emit[x]
        total += math.log(alpha.sum())
        alpha = alpha / alpha.sum()
    assert hmm.log_likelihoods(m, [short, seq[:5]])[0] == pytest.approx(total) and got[0] < total


def test_tail_classes_agree(spark):
    """Spark and Python put a word in the same class."""
    from pyspark.sql import functions as F

    words = ["a", "ab", "abc", "abcd", "\u00fc\u00df", "x" * 50, "e\u0301t"]
    df = spark.createDataFrame([(w.encode(),) for w in words], "word binary")
    rows = df.select("word", (F.crc32(F.substring("word", -hmm.TAIL_BYTES, hmm.TAIL_BYTES)) % 97).alias("c")).collect()
    assert all(hmm.tail_class(bytes(r.word), 97) == r.c for r in rows)


def check_base(docs, got, learn):
    seen = Counter()
    for i, text in docs:
        if learn(i):
            seen.update([*tokens(text), None])
    n, v = sum(seen.values()), len(seen)
    want = []
    for i, text in docs:
        own = [*tokens(text), None]
        want.append((-1 if i is None else i, len(own), sum(seen[t] > 0 for t in own), n, sum(math.log10((seen[t] + 1) / (n + v + 1)) for t in own)))
    rows = sorted((-1 if r.doc_id is None else r.doc_id, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in got)
    for a, b in zip(rows, sorted(want), strict=True):
        assert a[:4] == b[:4] and a[4] == pytest.approx(b[4], rel=1e-9)


def test_documents(spark, sf):
    import zlib

    docs = spark.read.parquet(f"{sf}/documents.parquet")
    got = hmm.score(docs, remainder("doc_id", 7) != 2, n_classes=50, n_tails=7, most_frequent=300, steps=2).collect()
    learn = lambda i: i is not None and zlib.crc32(str(i).encode()) % 7 != 2
    check_base([(r.doc_id, r.text) for r in docs.collect()], got, learn)


def test_odd_rows(spark, odd, none):
    got = hmm.score(odd, odd["doc_id"] < 5, n_classes=4, most_frequent=8, steps=2).collect()
    check_base([(r.doc_id, r.text) for r in odd.collect()], got, lambda i: i is not None and i < 5)
    assert all(math.isfinite(r.score) and r.score < 0 for r in got)
    assert hmm.score(none, none["doc_id"] < 5).count() == 0
    untrained = hmm.score(odd, odd["doc_id"] < 0).collect()
    assert {(r.n_known, r.train_tokens) for r in untrained} == {(0, 0)} and all(r.base_score == 0 for r in untrained)


def test_words_given_their_class_sum_to_one(spark):
    """All texts of two words over a closed vocabulary and one unseen word, with their ends, have a total of at most one."""
    rows = [(1, "a b a c"), (2, "b a d e"), (3, "a f")]
    words = ["a", "b", "c", "d", "e", "f", "unseen"]
    more = [(100 + i, f"{x} {y}") for i, (x, y) in enumerate(itertools.product(words, words))]
    df = spark.createDataFrame(rows + more, "doc_id long, text string")
    got = hmm.score(df, df["doc_id"] < 10, n_classes=2, n_tails=2, most_frequent=3, steps=3)
    assert 0 < sum(10**r.score for r in got.where("doc_id >= 100").collect()) <= 1


def test_scores_from_counts_alone(spark):
    """One state: the score is each class's smoothed share and each tail word's add-one share of its class, by hand."""
    rows = [(1, "a a a b b c dd"), (2, "a b eé"), (3, "a zz c c")]
    df = spark.createDataFrame([*rows, (9, "a b zz dd new"), (10, None)], "doc_id long, text string")
    got = {r.doc_id: r.score for r in hmm.score(df, df["doc_id"] < 9, states=1, steps=3, n_classes=2, n_tails=3, most_frequent=4).collect()}
    seen = Counter(w for _, t in rows for w in t.encode().split())
    own = sorted(seen, key=lambda w: (-seen[w], w))[:2]
    cls = lambda w: own.index(w) if w in own else 2 + hmm.tail_class(w, 3)
    shares = np.zeros(6)
    for w, n in seen.items():
        shares[cls(w)] += n
    shares[5] = len(rows)
    emit = shares + (shares + 1) / (shares + 1).sum()  # the counts, smoothed by the classes' shares
    emit /= emit.sum()
    for i, text in [*rows, (9, "a b zz dd new"), (10, "")]:
        want = math.log10(emit[5])
        for w in text.encode().split():
            want += math.log10(emit[cls(w)])
            if w not in own:
                mates = [x for x in seen if x not in own and cls(x) == cls(w)]
                want += math.log10((seen[w] + 1) / (sum(seen[x] for x in mates) + len(mates) + 1))
        assert got[i] == pytest.approx(want), i


def test_held_out_texts_score_above_the_base(spark):
    got = queries.op8_hmm_score(spark, "/root/testdata/sf0.01").where("held_out").toPandas()
    assert got.score.sum() > got.base_score.sum() and (got.score > got.base_score).mean() > 0.8
