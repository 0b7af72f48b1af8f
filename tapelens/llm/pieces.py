"""SentencePiece BPE encoding by a prefix table, and decoding.

For each prefix of a text the BPE encoding has one last token. It is found from the left: an
automaton gives the vocabulary strings that end at a position, and the right one is the only one
that is compatible with the last token of the prefix it leaves, that is, BPE merges keep the border
between the two. The ids are then read backwards from the end. Compatibility is a property of two
tokens and is remembered. Nothing crosses the start of a run of spaces or a line feed in these
vocabularies (checked when one is loaded), so texts are cut there and frequent pieces are remembered,
in a cache of bounded size.

Characters outside the vocabulary merge with nothing and become their UTF-8 bytes' tokens.

Defined results: a null text is the empty text: begin and end ids only, and an empty decoded text.
Repeated rows each get their row. An empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
import struct
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from sentencepiece import sentencepiece_model_pb2

from tapelens.llm.common import blocks, release, schema_of, slim

SPACE = "▁"
NORMAL, UNKNOWN, BYTE = 1, 2, 6
CACHED, LONGEST_CACHED, PAIRS = 200_000, 64, 1 << 19
#: Stands for a character outside the vocabulary in the prefix table.
OUTSIDE = -1


class Encoder:
    """Encodes texts with the vocabulary of a BPE model file with byte fallback."""

    def __init__(self, model: str):
        proto = sentencepiece_model_pb2.ModelProto()
        with open(model, "rb") as f:
            proto.ParseFromString(f.read())
        kinds = {p.type for p in proto.pieces}
        spec = proto.normalizer_spec
        if proto.trainer_spec.model_type != 2 or spec.precompiled_charsmap or spec.remove_extra_whitespaces or not spec.add_dummy_prefix or kinds - {1, 2, 3, 6}:
            raise ValueError(f"{model}: only BPE models with identity normalisation, a dummy prefix and no user-defined pieces")
        self.text = [p.piece for p in proto.pieces]
        self.rank = {p.piece: (-p.score, i) for i, p in enumerate(proto.pieces) if p.type == NORMAL}
        self.id = {p.piece: i for i, p in enumerate(proto.pieces) if p.type == NORMAL}
        self.byte = {int(p.piece[3:5], 16): i for i, p in enumerate(proto.pieces) if p.type == BYTE}
        self.unknown = next(i for i, p in enumerate(proto.pieces) if p.type == UNKNOWN)
        crossing = any(re.search(f"[^{SPACE}]{SPACE}", p) for p in self.id)
        feeds = any("\n" in p for p in self.id)
        self.cut = re.compile(f"{SPACE}*[^{SPACE}\n]+|{SPACE}+|\n" if not feeds else f"{SPACE}*[^{SPACE}]+|{SPACE}+") if not crossing else re.compile(r"[\s\S]+")
        self.split: dict[str, tuple[str, str]] = {}
        self.automaton = ahocorasick.Automaton()
        self.monotone = True
        for piece, i in self.id.items():
            if self.merge(piece, self.split) == [piece]:  # others never come out of merges
                self.automaton.add_word(piece, (i, len(piece)))
        self.automaton.make_automaton()
        self.monotone = all(self.rank[x] <= self.rank[whole] for whole, parts in self.split.items() for x in parts if x in self.split)
        self.compatible: dict[int, bool] = {}
        self.cache: dict[str, bytes] = {}

    def merge(self, text: str, split: dict[str, tuple[str, str]] | None = None) -> list[str]:
        """BPE as defined, for short strings: the best-ranked, leftmost pair merges until none can. split: gets the last merge of a text that becomes one."""
        parts = list(text)
        while True:
            pairs = [(self.rank[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False)) if a + b in self.rank]
            if not pairs:
                return parts
            i = min(pairs)[1]
            if split is not None and len(parts) == 2:
                split[text] = parts[0], parts[1]
            parts[i : i + 2] = [parts[i] + parts[i + 1]]

    def apart(self, x: str, y: str) -> bool:
        """Whether merges of x + y, two tokens that come out of merges, keep the border between them.

        Until a merge crosses the border, both sides merge as they do alone, and, as tokens come after their parts, in order
        of rank, the left side first. So both are undone from the last merge on, and for each pair of parts that met at the
        border it is asked whether it ranks before the merge that ended it.
        """
        rank, split, x_end, y_end = self.rank, self.split, None, None
        while True:
            crossing = rank.get(x + y)
            if crossing is not None and (x_end is None or crossing < x_end) and (y_end is None or crossing <= y_end):
                return False
            x_parts, y_parts = split.get(x), split.get(y)
            if y_parts is not None and (x_parts is None or rank[y] >= rank[x]):
                y_end, y = rank[y], y_parts[0]
            elif x_parts is not None:
                x_end, x = rank[x], x_parts[1]
            else:
                return True

    def fits(self, left: int, right: int) -> bool:
        if len(self.compatible) >= PAIRS:
            self.compatible.clear()
        a, b = self.text[left], self.text[right]
        known = self.compatible[left << 20 | right] = self.apart(a, b) if self.monotone else self.merge(a + b) == [a, b]
        return known

    def ids(self, text: str) -> list[int]:
        """Ids of a text in which spaces are already marked."""
        # The last token of each prefix, by its length.
        last = [OUTSIDE] * (len(text) + 1)
        known, fits = self.compatible.get, self.fits
        for end, (token, length) in self.automaton.iter(text):
            end += 1
            if last[end] == OUTSIDE:
                left = last[end - length]
                if left != OUTSIDE:
                    good = known(left << 20 | token)
                    if not (fits(left, token) if good is None else good):
                        continue
                last[end] = token
        out, at, pieces = [], len(text), self.text
        while at:
            token = last[at]
            if token != OUTSIDE:
                out.append(token)
                at -= len(pieces[token])
            else:
                at -= 1
                raw = text[at].encode("utf-8", "replace")
                out += [self.byte[b] for b in reversed(raw)] if self.byte else [self.unknown]
        out.reverse()
        return out

    def encode(self, text: str) -> bytes:
        """The ids of a text as little-endian unsigned 32-bit integers."""
        if not text:
            return b""
        cache, out = self.cache, []
        for piece in self.cut.findall(SPACE + text.replace(" ", SPACE)):
            packed = cache.get(piece)
            if packed is None:
                made = self.ids(piece)
                packed = struct.pack(f"<{len(made)}I", *made)
                if len(piece) <= LONGEST_CACHED:
                    if len(cache) >= CACHED:
                        cache.clear()
                    cache[piece] = packed
            out.append(packed)
        return b"".join(out)


    def forget(self) -> None:
        """Empty what is remembered of texts, after a task: the worker stays for other stages."""
        self.compatible.clear()
        self.cache.clear()
        release()


_loaded: dict[str, tuple[Encoder, sentencepiece.SentencePieceProcessor]] = {}


def loaded(model: str) -> tuple[Encoder, sentencepiece.SentencePieceProcessor]:
    """The model, once for each Python worker."""
    if model not in _loaded:
        _loaded[model] = Encoder(model), sentencepiece.SentencePieceProcessor(model_file=model)
    return _loaded[model]


def tokenize(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, token_ids): begin id, ids of the text, end id, as array<int>."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, library = loaded(model)
        begin, end = np.array([library.bos_id()], "<u4").tobytes(), np.array([library.eos_id()], "<u4").tobytes()
        for block in blocks(batches, text_col):
            packed = [begin + encoder.encode(t or "") + end for t in block.column(text_col).to_pylist()]
            yield pa.RecordBatch.from_arrays([block.column(id_col), _lists(packed)], names=[id_col, "token_ids"])
        encoder.forget()

    return slim(docs, id_col, text_col).mapInArrow(run, f"{schema_of(docs, id_col)}, token_ids array<int>")


def _lists(packed: list[bytes]) -> pa.ListArray:
    ends = np.cumsum([0, *[len(p) // 4 for p in packed]]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(packed), "<u4").astype(np.int32)))


def round_trip(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256) of every document, encoded and decoded in one pass; token_ids if asked."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, library = loaded(model)
        begin, end = np.array([library.bos_id()], "<u4").tobytes(), np.array([library.eos_id()], "<u4").tobytes()
        for block in blocks(batches, text_col, 1 << 20):
            packed = [begin + encoder.encode(t or "") + end for t in block.column(text_col).to_pylist()]
            decoded = [library.decode(np.frombuffer(p, "<u4").tolist()) for p in packed]
            yield pa.RecordBatch.from_arrays(
                [
                    block.column(id_col),
                    pa.array([len(p) // 4 for p in packed], pa.int64()),
                    pa.array([hashlib.sha256(p).hexdigest() for p in packed]),
                    pa.array([hashlib.sha256(t.encode("utf-8", "replace")).hexdigest() for t in decoded]),
                    *[_lists(packed)] * with_ids,
                ],
                names=[id_col, "n_tokens", "ids_sha256", "decoded_sha256", *["token_ids"] * with_ids],
            )
        encoder.forget()

    form = f"{schema_of(docs, id_col)}, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", token_ids array<int>" * with_ids
    return slim(docs, id_col, text_col).mapInArrow(run, form)
