"""Quality rules with risk-controlled thresholds.

Statistics of every text are compared with cutoffs. A cutoff is learned for each stratum and
statistic from labelled documents: of all cutoffs, from the laxest on, those are certified for which
an exact binomial test rejects "more than the allowed share of good documents falls": P(X <= k) for
k of n good ones, at a level divided by the number of strata and statistics (Bonferroni), in fixed
sequence until the first that fails. The allowed share is divided by the number of statistics, so of
the good documents of a stratum that pass the base rules no more than RISK fall to the cutoffs, with
confidence 1 - DELTA over all strata at once; base rules are fixed and promise nothing. Of the certified cutoffs the one that pays best is used (bad documents caught less
GOOD_WEIGHT times good ones lost); where none is certified or pays, nothing is rejected.

Defined results: a null text has no words. Documents without a stratum value share one stratum.
A labelled text is one trial of the test in its stratum, however many rows and ids it has, as its
copies say nothing new. Labels that contradict each other for an id or for a text, and null labels, are
not used. Repeated rows each get their row; columns other than id, text and stratum are not read. An empty
table gives an empty result; without labels only base rules reject.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapelens.llm.common import WHITESPACE, blocks, bounded, durable, schema_of, small_batches, utf8

SYMBOLS, CAPITALS = b"#*$%&|<>", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
WINDOW, MIN_WORDS, MOST_REPEATED = 8, 20, 30
RISK, DELTA, GOOD_WEIGHT, BINS = 0.1, 0.05, 4, 256
#: Statistics between 0 and 1, as SQL over the counts.
STATISTICS = {
    "symbol_share": "n_symbols / greatest(1, word_chars)",
    "capital_share": "n_capitals / greatest(1, word_chars)",
    "stutter_share": "n_stutters / greatest(1, n_words)",
    "dup_line_share": "n_dup_lines / greatest(1, n_lines)",
}


def numbered(words: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """A number for each word of the texts, equal for equal words, and the text it is in."""
    number: dict[bytes, int] = {}
    ids = np.array([number.setdefault(w, len(number)) for text in words for w in text], np.int64)
    return ids, np.repeat(np.arange(len(words)), [len(text) for text in words])


def stuttered_words(ids: np.ndarray, of: np.ndarray, n_texts: int) -> np.ndarray:
    """How many words of each text equal the word before."""
    again = np.flatnonzero((ids[1:] == ids[:-1]) & (of[1:] == of[:-1])) + 1
    return np.bincount(of[again], minlength=n_texts)


def repeated_words(ids: np.ndarray, of: np.ndarray, n_texts: int) -> np.ndarray:
    """How many words of each text are in a window of WINDOW words that the text has twice or more."""
    n = len(ids) - WINDOW + 1
    if n < 1:
        return np.zeros(n_texts, np.int64)
    draw = np.random.default_rng(8)
    code = draw.integers(1, 1 << 63, int(ids.max()) + 1, dtype=np.uint64)[ids]
    odd = draw.integers(1, 1 << 63, WINDOW, dtype=np.uint64) | np.uint64(1)
    key = of[:n].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for k in range(WINDOW):
        key += code[k : k + n] * odd[k]
    inside = np.flatnonzero(of[:n] == of[WINDOW - 1 :])
    order = inside[np.argsort(key[inside], kind="stable")]
    same = np.flatnonzero(key[order[1:]] == key[order[:-1]])
    a, b = order[same], order[same + 1]
    true = of[a] == of[b]  # equal keys are compared word by word
    for k in range(WINDOW):
        true &= ids[a + k] == ids[b + k]
    cover = np.zeros(len(ids) + 1, np.int64)
    hit = np.union1d(a[true], b[true])
    np.add.at(cover, hit, 1)
    np.add.at(cover, hit + WINDOW, -1)
    return np.bincount(of, weights=np.cumsum(cover[:-1]) > 0, minlength=n_texts).astype(np.int64)


def counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", stratum_col: str = "lang") -> DataFrame:
    """(id, stratum, digest, n_words, word_chars, n_symbols, n_capitals, n_lines, n_dup_lines, n_repeat_words, n_stutters) of every whole text."""
    names = ["n_words", "word_chars", "n_symbols", "n_capitals", "n_lines", "n_dup_lines", "n_repeat_words", "n_stutters"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, text_col, 1 << 20):
            texts = utf8(block, text_col)
            words = [t.split() for t in texts]
            ids, of = numbered(words)
            chars = pc.fill_null(pc.utf8_length(block.column(text_col)), 0).to_pylist()
            less = lambda t, drop: len(t) - len(t.translate(None, drop))
            lines = [[x for x in t.split(b"\n") if x.strip()] for t in texts]
            values = [
                [len(w) for w in words],
                [c - less(t, WHITESPACE) for c, t in zip(chars, texts, strict=True)],
                [less(t, SYMBOLS) for t in texts],
                [less(t, CAPITALS) for t in texts],
                [len(x) for x in lines],
                [len(x) - len(set(x)) for x in lines],
                repeated_words(ids, of, len(texts)),
                stuttered_words(ids, of, len(texts)),
            ]
            yield pa.RecordBatch.from_arrays([block.column(id_col), block.column("stratum"), block.column("digest"), *[pa.array(v, pa.int64()) for v in values]], names=[id_col, "stratum", "digest", *names])

    small_batches(docs.sparkSession)
    form = f"{schema_of(docs, id_col)}, stratum string, digest long, " + ", ".join(f"{n} long" for n in names)
    stratum = F.coalesce(F.col(stratum_col).cast("string"), F.lit("")).alias("stratum")
    return docs.select(docs[id_col], docs[text_col], stratum, F.xxhash64(docs[text_col]).alias("digest")).mapInArrow(run, form)


def log_chance(i: int, n: int, p: float) -> float:
    """The logarithm of P(X = i) of a binomial distribution."""
    return math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(p) + (n - i) * math.log1p(-p)


def at_most(k: int, n: int, p: float) -> float:
    """P(X <= k) of a binomial distribution, exactly summed."""
    return math.fsum(math.exp(log_chance(i, n, p)) for i in range(k + 1))


def certified_cutoff(good: np.ndarray, bad: np.ndarray, risk: float, level: float) -> int | None:
    """The bin from which on documents are rejected; good and bad: labelled documents in each bin."""
    n, best, cutoff = int(good.sum()), 0.0, None
    lost = caught = 0
    below, summed = 0.0, -1  # P(X <= summed): terms are added as losses grow, and no more once the level is passed
    for b in range(len(good) - 1, -1, -1):
        lost, caught = lost + int(good[b]), caught + int(bad[b])
        while summed < lost and below <= level:
            summed += 1
            below += math.exp(log_chance(summed, n, risk))
        if below > level:
            break
        if caught - GOOD_WEIGHT * lost > best:
            best, cutoff = caught - GOOD_WEIGHT * lost, b
    return cutoff


def cutoffs(counted: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality") -> DataFrame:
    """(stratum, a bin for each statistic): learned cutoffs; null where none is certified."""
    agreed = labels.where(F.col(label_col).isNotNull()).groupBy(F.col(id_col).alias("labelled")).agg(F.min(label_col).alias("low"), F.max(label_col).alias("high"))
    rows = counted.where("not base_failed").join(agreed.where("low = high"), counted[id_col] == F.col("labelled"))
    # A text and its copies are one trial; equal texts have equal bins.
    rows = rows.groupBy("stratum", "digest", "n_words", "word_chars", *STATISTICS).agg(F.min("low").alias("low"), F.max("low").alias("high")).where("low = high")
    long = rows.select("stratum", F.col("low").alias("good"), F.explode(F.map_from_arrays(F.array(*map(F.lit, STATISTICS)), F.array(*[F.col(s) for s in STATISTICS]))).alias("statistic", "bin"))
    bins = long.groupBy("stratum", "statistic", "bin").agg(F.count_if(F.col("good") > 0).alias("n_good"), F.count_if(F.col("good") <= 0).alias("n_bad"))
    bins = durable(bins)
    tests = max(1, bins.select("stratum", "statistic").distinct().count())

    def choose(key: tuple, table: pd.DataFrame) -> pd.DataFrame:
        good, bad = np.zeros(BINS + 1, np.int64), np.zeros(BINS + 1, np.int64)
        good[table["bin"]], bad[table["bin"]] = table["n_good"], table["n_bad"]
        cutoff = certified_cutoff(good, bad, RISK / len(STATISTICS), DELTA / tests)
        return pd.DataFrame({"stratum": [key[0]], "statistic": [key[1]], "cutoff": pd.array([cutoff], "Int32")})

    chosen = bins.groupBy("stratum", "statistic").applyInPandas(choose, "stratum string, statistic string, cutoff int")
    return chosen.groupBy("stratum").pivot("statistic", list(STATISTICS)).agg(F.first("cutoff"))


def judge(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", stratum_col: str = "lang", label_col: str = "quality") -> DataFrame:
    """(id, counts..., base_failed, kept) of every document."""
    counted = counts(docs, id_col, text_col, stratum_col)
    base = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    counted = counted.withColumn("base_failed", base)
    for name, share in STATISTICS.items():
        counted = counted.withColumn(name, F.least(F.lit(BINS), F.floor(F.expr(share) * BINS)).cast("int"))
    counted = durable(counted)
    limits = bounded(durable(cutoffs(counted, labels, id_col, label_col).select(F.col("stratum").alias("of"), *[F.col(s).alias(f"cut_{s}") for s in STATISTICS])))
    over = F.lit(False)
    for s in STATISTICS:
        over = over | F.coalesce(F.col(s) >= F.col(f"cut_{s}"), F.lit(False))
    out = counted.join(limits, counted["stratum"] == limits["of"], "left")
    return out.select(id_col, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", (~F.col("base_failed") & ~over).alias("kept"))
