"""License scans by patience alignment.

A text is compared with each template word by word. Words that occur once in both are anchors; the
longest increasing subsequence of their places keeps those that agree in order; the gaps between
them are aligned in the same way, and a gap without anchors by the words its ends share. Of what is
aligned, the stretch of the text is taken that scores best. Its coverage is the number of matched
words over those of the template and the unmatched ones inside the stretch, so words put in count
against it. A template of fewer than SHORT words must be there word for word.

Words that tell licences apart (families, versions, restrictions: DECIDING, and version numbers)
must agree: the template's are all matched, and the stretch has no other. The nearest licence is
therefore never named in place of one that the templates lack.

A text is aligned only where it can reach the coverage c. Of n template words at most (1 - c) n are
missed, so one of any few more than that must be in the text: the longest words are looked for. And
with at most (1/c - 1) m unmatched words on both sides beside m matched ones, at least
(2 - 1/c) c n - 1 pairs of words in a row are common to a stretch of n/c words: windows with fewer are
passed by. Neither bound loses a stretch that reaches the coverage. All other windows are aligned, so
that the hits are those of every template at every place.

Defined results: a null or empty text holds no licence. A notice that occurs twice has two rows.
Where one place suits several templates, those with the most matched words win and the others that
overlap it go. Repeated rows each get their rows. An empty table gives an empty result. Other
columns are not read.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections import Counter, defaultdict
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tapelens.llm.common import blocks, schema_of, slim
from tapelens.llm.license_texts import DECIDING, TEMPLATES

COVERAGE, SHORT = 0.8, 12
VERSION = re.compile(r"v?\d+(\.\d+)+|\S+-\d+\.\d+")
TOKEN = re.compile(r"[a-z0-9]+(?:[.\-][a-z0-9]+)*")


def tokens(text: str) -> list[str]:
    return TOKEN.findall(text.lower())


def longest_increasing(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Of pairs in order of their first numbers, the most whose second numbers rise too, by patience sorting."""
    tops: list[int] = []
    last: list[int] = []
    back: list[int | None] = []
    for i, (_, b) in enumerate(pairs):
        pile = bisect_left(tops, b)
        back.append(last[pile - 1] if pile else None)
        tops[pile : pile + 1], last[pile : pile + 1] = [b], [i]
    out, i = [], last[-1] if last else None
    while i is not None:
        out.append(pairs[i])
        i = back[i]
    return out[::-1]


def align(a: list[str], b: list[str]) -> list[tuple[int, int]]:
    """Matched places of two word lists, in order."""
    out: list[tuple[int, int]] = []
    todo = [(0, len(a), 0, len(b))]
    while todo:
        a0, a1, b0, b1 = todo.pop()
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
            out.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            out.append((a1, b1))
        if a0 == a1 or b0 == b1:
            continue
        once_a, once_b = Counter(a[a0:a1]), Counter(b[b0:b1])
        place = {w: j for j, w in enumerate(b[b0:b1], b0) if once_b[w] == 1}
        anchors = longest_increasing([(i, place[w]) for i, w in enumerate(a[a0:a1], a0) if once_a[w] == 1 and w in place])
        for i, j in anchors:
            out.append((i, j))
            todo.append((a0, i, b0, j))
            a0, b0 = i + 1, j + 1
        if anchors:
            todo.append((a0, a1, b0, b1))
    return sorted(out)


def deciding(words: list[str]) -> list[bool]:
    """Which words tell licences apart; a plain number does after the word version."""
    return [w in DECIDING or w.startswith("attribution") or bool(VERSION.fullmatch(w)) or w.isdigit() and i > 0 and words[i - 1] in ("version", "v") for i, w in enumerate(words)]


def best_stretch(pairs: list[tuple[int, int]], coverage: float) -> tuple[float, int, int]:
    """Of aligned pairs in order, the run whose matched words less coverage times the unmatched ones inside is most: (that, first, last)."""
    best, here, first = (-math.inf, 0, 0), 0.0, 0
    for k, (_, at) in enumerate(pairs):
        if k:
            here -= coverage * (at - pairs[k - 1][1] - 1)
        if here <= 0:
            here, first = 0.0, k
        here += 1
        if here > best[0]:
            best = (here, first, k)
    return best


class Template:
    """A licence's words, and what of them must be there."""

    def __init__(self, name: str, text: str, coverage: float):
        self.name, self.words = name, tokens(text)
        self.exact = len(self.words) < SHORT
        self.coverage = 1.0 if self.exact else coverage
        self.decides = deciding(self.words)
        self.window = math.floor(len(self.words) / self.coverage + 1e-9)
        self.least_pairs = max(1, math.ceil((2 - 1 / self.coverage) * self.coverage * len(self.words) - 1 - 1e-9))

    def triggers(self) -> list[str]:
        """So many of the longest words that one of them must be in a text that reaches the coverage."""
        missable = len(self.words) - math.ceil(self.coverage * len(self.words) - 1e-9)
        return sorted(self.words, key=len)[-missable - 1 :]

    def hit(self, words: list[str], decides: list[bool], start: int) -> tuple[str, float, int, int, int] | None:
        """(name, coverage, matched words, first word, last word) in the window from this place on, if it suits."""
        if self.exact:
            stop = start + len(self.words)
            return (self.name, 1.0, len(self.words), start, stop - 1) if words[start:stop] == self.words else None
        pairs = align(self.words, words[start : start + self.window])
        score, a, b = best_stretch(pairs, self.coverage)
        if score < self.coverage * len(self.words) - 1e-9:
            return None
        kept = pairs[a : b + 1]
        first, last = start + kept[0][1], start + kept[-1][1]
        own, there = {i for i, _ in kept}, {start + j for _, j in kept}
        if any(d and i not in own for i, d in enumerate(self.decides)) or any(decides[j] and j not in there for j in range(first, last + 1)):
            return None
        return self.name, len(kept) / (len(self.words) + last - first + 1 - len(kept)), len(kept), first, last


def select(hits: set[tuple[str, float, int, int, int]]) -> list[tuple[str, float, int, int, int]]:
    """Of hits that overlap, those with the most matched words, in order of place."""
    out: list[tuple[str, float, int, int, int]] = []
    for hit in sorted(hits, key=lambda h: (-h[2], -h[1], h[0], h[3])):
        if all(hit[4] < x[3] or x[4] < hit[3] for x in out):
            out.append(hit)
    return sorted(out, key=lambda x: x[3])


class Scanner:
    """Templates, and what finds the places worth an alignment."""

    def __init__(self, templates: dict[str, str] = TEMPLATES, coverage: float = COVERAGE):
        self.templates = [Template(name, text, coverage) for name, text in templates.items()]
        self.pairs: dict[tuple[str, str], list[int]] = defaultdict(list)
        self.triggers = ahocorasick.Automaton()
        for number, template in enumerate(self.templates):
            for pair in set(zip(template.words, template.words[1:], strict=False)):
                self.pairs[pair].append(number)
            for word in template.triggers():
                self.triggers.add_word(word, word)
        self.triggers.make_automaton()

    def starts(self, words: list[str]) -> Iterator[tuple[Template, int]]:
        """All windows that hold enough of a template's word pairs to reach the coverage."""
        found: dict[int, list[int]] = defaultdict(list)
        for i, pair in enumerate(zip(words, words[1:], strict=False)):
            for number in self.pairs.get(pair, ()):
                found[number].append(i)
        for number, places in found.items():
            template = self.templates[number]
            if len(places) < template.least_pairs:
                continue
            if template.exact:
                first = (template.words[0], template.words[1])
                yield from ((template, i) for i in places if (words[i], words[i + 1]) == first)
                continue
            at = np.array(places)
            near = np.arange(max(0, at[0] - template.window + 1), at[-1] + 1)
            held = np.searchsorted(at, near + template.window - 1) - np.searchsorted(at, near)
            yield from ((template, i) for i in near[held >= template.least_pairs].tolist())

    def scan(self, text: str) -> list[tuple[str, float, int, int, int]]:
        """(template, coverage, matched words, first word, last word), of places that do not overlap."""
        lower = text.lower()
        if next(self.triggers.iter(lower), None) is None:
            return []
        words = TOKEN.findall(lower)
        decides = deciding(words)
        return select({hit for template, start in self.starts(words) if (hit := template.hit(words, decides, start))})


def find_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates: dict[str, str] = TEMPLATES, coverage: float = COVERAGE) -> DataFrame:
    """(id, license_id, coverage, n_matched, first_word, last_word): a row for each notice or licence text found."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(templates, coverage)
        for block in blocks(batches, text_col):
            rows, hits = [], []
            for i, text in enumerate(block.column(text_col).to_pylist()):
                for hit in scanner.scan(text or ""):
                    rows.append(i)
                    hits.append(hit)
            kinds = [pa.string(), pa.float64(), pa.int64(), pa.int64(), pa.int64()]
            columns = [pa.array([h[k] for h in hits], kind) for k, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([block.column(id_col).take(pa.array(rows, pa.int64())), *columns], names=[id_col, "license_id", "coverage", "n_matched", "first_word", "last_word"])

    return slim(docs, id_col, text_col).mapInArrow(run, f"{schema_of(docs, id_col)}, license_id string, coverage double, n_matched long, first_word long, last_word long")
