"""Language identification by prediction by partial matching.

Each language has a context tree over the bytes of lower-cased text, to a depth of ORDER bytes. A
byte seen in its longest known context has probability c / (n + d) there (n: bytes seen in the
context, d: different ones); else the context's escape d / (n + d) is paid and the next shorter one
asked, down to a uniform 1/256. The statistics are frozen after training, so a text's code length
is exact and does not depend on other texts. The language with the shortest code wins; the score is
its posterior probability with equal priors.

Training fits on a bounded sample of the labelled rows: whole texts of each language, chosen by a
hash of the id and text, in number about ROWS_PER_LANGUAGE at most and in size about TRAIN_BYTES
divided by the number of languages, but the text of the least hash at least, so that no language is
lost. A language below both bounds is learned from all its texts, a row that repeats counts once, and
no statistics of the sample are dropped. The tree holds only what each language has seen, sorted by
string with the languages beside it, so its size follows the sample, not strings times languages.

A text is rejected (fits is false) if its stretches of STRETCH bytes, each in the language that codes it
best, take over MARGIN bits more than its bytes cost by themselves, under the shares that bytes have
over all languages together: knowing languages then misleads rather than helps to predict it. A text
of several learned languages fits.

Defined results: null text, or text without a letter: `und` with score 0, and it does not fit.
Without training rows all texts are `und`, and those with a letter fit, as nothing is known against
them. Ties go to the language that sorts first. Null languages teach nothing. Repeated rows each get
their row. Other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapelens.llm.common import blocks, free, schema_of, slim, small_batches

ORDER = 4
ROWS_PER_LANGUAGE, TRAIN_BYTES = 2000, 32 << 20
UNKNOWN = "und"
#: Bits by which the languages' codes must be longer than that of the bytes alone; a text of a few letters pays as much to begin.
MARGIN, STRETCH = 32, 64
#: Bytes whose strings are made at once (2**20 at most), and entries of (string, language) looked at once.
PIECE, HELD = 1 << 18, 1 << 21
_LATIN = re.compile("[A-Za-z]")


def has_letter(text: str) -> bool:
    return bool(_LATIN.search(text)) or any(map(str.isalpha, text))


def encoded(texts: list[str]) -> list[bytes]:
    """The bytes of the texts; newlines stand before each."""
    return [b"\n" * ORDER + t.lower().encode("utf-8", "replace") for t in texts]


def pieces(raw: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """ORDER context bytes and the byte after them as one number, for each byte of `encoded` texts, PIECE at a time; the texts they are of, and where."""
    line, lengths = np.frombuffer(b"".join(raw), np.uint8), np.array([len(r) for r in raw])
    ends = np.cumsum(lengths)
    for i in range(ORDER, len(line), PIECE):
        part = line[i - ORDER : i + PIECE].astype(np.uint64)
        out = np.zeros(len(part) - ORDER, np.uint64)
        for k in range(ORDER + 1):
            out = out << np.uint64(8) | part[k : k + len(out)]
        first, last = np.searchsorted(ends, [i, i + len(out) - 1], "right")
        of = np.repeat(np.arange(first, last + 1), np.diff(np.clip(ends[first : last + 1], i, i + len(out)), prepend=i))
        at = np.arange(i, i + len(out)) - (ends - lengths)[of] - ORDER
        inside = at >= 0  # not the strings that reach from one text into the next
        yield out[inside], of[inside], at[inside]


class Sparse:
    """Values of (string, language), for the languages that have the string."""

    def __init__(self, string: np.ndarray, language: np.ndarray, value: np.ndarray):
        """Sorted by string."""
        self.own, starts = np.unique(string, return_index=True)
        self.starts, self.language, self.value = np.append(starts, len(string)).astype(np.int64), language.astype(np.uint16), value.astype(np.float32)

    def find(self, strings: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(place in `strings`, language, value) of all entries of these strings."""
        at = np.searchsorted(self.own, strings).clip(max=max(0, len(self.own) - 1))
        known = np.flatnonzero(self.own[at] == strings) if len(self.own) else np.zeros(0, np.int64)
        first = self.starts[at[known]]
        counts = self.starts[at[known] + 1] - first
        entry = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts) + np.repeat(first, counts)
        return np.repeat(known, counts), self.language[entry], self.value[entry]


class Tree:
    """All languages' context trees: by depth, code lengths of strings in their longest context and escapes of contexts."""

    def __init__(self, languages: list[str], keys: np.ndarray, language: np.ndarray, counts: np.ndarray):
        """keys: strings of ORDER + 1 bytes; language: number of each one's language."""
        self.languages = languages
        self.bits: list[Sparse] = []
        self.escapes: list[Sparse] = []
        share = np.bincount((keys & np.uint64(255)).astype(np.int64), weights=counts, minlength=256) + 1
        self.alone = -np.log2(share / share.sum())
        for k in range(ORDER, -1, -1):
            # One entry for each string and language: of the strings of k + 1 bytes, then of their contexts.
            keys = keys & np.uint64((1 << 8 * (k + 1)) - 1)
            string, of, seen = self._sum(keys, language, counts)
            context, speaks, total = self._sum(string >> np.uint64(8), of, seen)
            different = self._sum(string >> np.uint64(8), of, np.ones(len(seen)))[2]
            # The context of each string, by its place among (context, language).
            both = lambda c, n: c * np.uint64(len(languages)) + n.astype(np.uint64)
            at = np.searchsorted(both(context, speaks), both(string >> np.uint64(8), of))
            self.bits.append(Sparse(string, of, -np.log2(seen / (total + different)[at])))
            self.escapes.append(Sparse(context, speaks, -np.log2(different / (total + different))))
            keys, language, counts = string, of, seen

    @staticmethod
    def _sum(strings: np.ndarray, language: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        order = np.lexsort((language, strings))
        strings, language, n = strings[order], language[order], n[order]
        new = np.flatnonzero(np.append(True, (strings[1:] != strings[:-1]) | (language[1:] != language[:-1]))) if len(order) else order
        return strings[new], language[new], np.add.reduceat(n, new) if len(new) else n

    def code_bits(self, keys: np.ndarray) -> np.ndarray:
        """Bits that each language spends on the last byte of each key: from the longest context down, until it has seen the byte there."""
        out = np.zeros((len(keys), len(self.languages)), np.float32)
        left = np.ones(out.shape, bool)
        for k, (bits, escapes) in zip(range(ORDER, -1, -1), zip(self.bits, self.escapes, strict=True), strict=True):
            open_ = np.flatnonzero(left.any(1))
            string = keys[open_] & np.uint64((1 << 8 * (k + 1)) - 1)
            for found, ends in ((bits.find(string), True), (escapes.find(string >> np.uint64(8)), False)):
                at, language, value = open_[found[0]], found[1], found[2]
                use = left[at, language]
                out[at[use], language[use]] += value[use]
                if ends:
                    left[at[use], language[use]] = False
        out[left] += 8.0
        return out

    def lengths(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The code length in bits of each text in each language, with each stretch in its best language, and by its bytes alone."""
        n, raw = len(self.languages), encoded(texts)
        stretches = -(-np.array([len(r) - ORDER for r in raw], np.int64) // STRETCH)
        first = np.cumsum(stretches) - stretches
        out, alone = np.zeros((int(stretches.sum()), n)), np.zeros(len(texts))
        step = max(1, HELD // n)
        for keys, of, at in pieces(raw):
            alone += np.bincount(of, weights=self.alone[(keys & np.uint64(255)).astype(np.int64)], minlength=len(texts))
            # Strings have 40 bits, places in a piece 20: one number sorts both.
            both = np.sort(keys << np.uint64(20) | np.arange(len(keys), dtype=np.uint64))
            order, sorted_ = (both & np.uint64((1 << 20) - 1)).astype(np.int64), both >> np.uint64(20)
            new = np.append(True, sorted_[1:] != sorted_[:-1])
            different = sorted_[new]
            number = np.empty(len(keys), np.int64)
            number[order] = np.cumsum(new) - 1
            for i in range(0, len(different), step):
                codes = self.code_bits(different[i : i + step])
                mine = slice(None) if step >= len(different) else np.flatnonzero((number >= i) & (number < i + step))
                row, text = number[mine] - i, (first[of] + at // STRETCH)[mine]
                for j in range(0, len(row), step):
                    starts = np.flatnonzero(np.append(True, text[j + 1 : j + step] != text[j : j + step - 1][: len(text[j + 1 : j + step])]))
                    out[text[j : j + step][starts]] += np.add.reduceat(codes[row[j : j + step]], starts, axis=0, dtype=np.float64)
        owner = np.repeat(np.arange(len(texts)), stretches)
        whole = np.stack([np.bincount(owner, weights=out[:, k], minlength=len(texts)) for k in range(n)], 1)
        return whole, np.bincount(owner, weights=out.min(1), minlength=len(texts)), alone


def train(docs: DataFrame, learn: Column, lang_col: str = "lang", id_col: str = "doc_id", text_col: str = "text", rows_per_language: int = ROWS_PER_LANGUAGE, train_bytes: int = TRAIN_BYTES) -> Tree | None:
    """A tree from rows where `learn` holds; None if there are none.

    Rows and bytes of each language are counted over all rows, and a hash picks about as many rows as the bounds
    allow. The counts of strings are summed in Spark and arrive here, at most a string for each byte of the sample.
    The languages themselves, a row each, are collected, too.
    """
    small_batches(docs.sparkSession)
    rows = docs.where(learn & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(F.col(lang_col).alias("l"), F.col(text_col).alias("t"), F.col(id_col).alias("i"))
    rows = rows.withColumn("h", F.xxhash64("i", "t"))
    sizes = rows.groupBy("l").agg(F.count("*").alias("n"), F.sum(F.octet_length("t")).alias("size"), F.min("h").alias("least")).toArrow().to_pandas()
    languages = sorted(sizes["l"])
    if not languages:
        return None
    number = {name: i for i, name in enumerate(languages)}
    most = train_bytes / len(languages)
    share = {r.l: min(1.0, rows_per_language / r.n, most / max(1, r.size)) for r in sizes.itertuples()}
    shares = docs.sparkSession.createDataFrame([(r.l, number[r.l], share[r.l], r.least) for r in sizes.itertuples()], f"{schema_of(docs, lang_col, 'l')}, number int, share double, least long")
    picked = (F.pmod("h", F.lit(1 << 20)) < F.col("share") * (1 << 20)) | (F.col("h") == F.col("least"))
    chosen = rows.join(F.broadcast(shares), "l").where(picked).dropDuplicates(["l", "h"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, "t"):
            table = block.to_pandas()
            for language, part in table.groupby("number"):
                for strings, _, _ in pieces(encoded(part["t"].tolist())):
                    keys, n = np.unique(strings, return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(keys), language), pa.int32()), pa.array(keys.view(np.int64)), pa.array(n)], names=["l", "g", "n"])

    strings = chosen.select("number", "t").mapInArrow(count, "l int, g long, n long").groupBy("l", "g").agg(F.sum("n").alias("n"))
    found = strings.toArrow()
    return Tree(languages, found["g"].to_numpy().astype(np.uint64), found["l"].to_numpy(), found["n"].to_numpy().astype(float))


def predict(docs: DataFrame, tree: Tree | None, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = (), carry_text: bool = False, out: tuple[str, str, str] = ("lang_pred", "score", "fits")) -> DataFrame:
    """(id, keep..., lang_pred, score, fits) for every row, with the text if asked; reads only the text for its prediction. out: names for the last three."""
    shared = docs.sparkSession.sparkContext.broadcast(tree)
    names = [id_col, *keep, *[text_col] * carry_text]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for block in blocks(batches, text_col, 1 << 20):
            texts = [t or "" for t in block.column(text_col).to_pylist()]
            said, score, fits = [UNKNOWN] * len(texts), np.zeros(len(texts)), np.array([has_letter(t) for t in texts])
            some = np.flatnonzero(fits).tolist() if known else []
            if some:
                bits, mixed, alone = known.lengths([texts[i] for i in some])
                score[some] = 1 / np.exp2(np.minimum(bits.min(1, keepdims=True) - bits, 0)).sum(1)
                fits[some] = mixed <= alone + MARGIN
                for i, b in zip(some, bits.argmin(1).tolist(), strict=True):
                    said[i] = known.languages[b]
            yield pa.RecordBatch.from_arrays([*[block.column(c) for c in names], pa.array(said, pa.string()), pa.array(score), pa.array(fits)], names=[*names, *out])

    kept = ", ".join(schema_of(docs, c) for c in names)
    return slim(docs, *dict.fromkeys([*names, text_col])).mapInArrow(run, f"{kept}, `{out[0]}` string, `{out[1]}` double, `{out[2]}` boolean")


def drop_unknown(docs: DataFrame, tree: Tree | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents that fit a learned language, with all columns."""
    said, score, fits = (free(docs, x) for x in ("lang_pred", "score", "fits"))
    keep = tuple(c for c in docs.columns if c not in (id_col, text_col))
    found = predict(docs, tree, id_col, text_col, keep, carry_text=True, out=(said, score, fits))
    return found.where(fits).select(*docs.columns)
