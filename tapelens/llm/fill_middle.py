"""Fill-in-middle documents from texts stored as seekable compressed frames.

A stored text is a row of independent zstandard frames of at most FRAME bytes, cut between code points,
each with the number of units and code points that begin before it. A unit is a run of A-Z and a-z, or
any other code point. To cut a text at a unit, the last frame that begins no later is decompressed, and
no other. The rearranged text is again a row of frames: whole frames move as they are, compressed; only
the two cut ones are compressed anew, in parts; markers are frames of their own. Frames in their order
are one zstandard stream, which any reader of the format can decompress. Digests come from a stream over
the frames in order, so that no text is held whole; the original is rebuilt from the rearranged frames and
the form alone, by finding the markers in that stream.

Defined results: a null text is empty. A text that has a marker itself stays plain, so that markers found are markers set.
The draw is a function of the id: rows of equal id and length are cut alike; a null id counts as an empty
string in it. Repeated rows each have a result. A run of letters may span frames. An empty table gives an
empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from typing import Any

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

from tapelens.llm.common import blocks, durable, schema_of, slim, utf8

FRAME = 64 << 10
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
MARKERS = (PREFIX, SUFFIX, MIDDLE)
PLAIN_FROM, SPM_BELOW = 90, 20

#: units, chars: how many begin in the text before the frame; letter: the byte before the frame is one of a run.
STORED = pa.list_(pa.struct([("units", pa.int64()), ("chars", pa.int64()), ("bytes", pa.int64()), ("letter", pa.bool_()), ("data", pa.binary())]))
STORED_DDL = "array<struct<units:bigint,chars:bigint,bytes:bigint,letter:boolean,data:binary>>"
OUT = pa.list_(pa.struct([("bytes", pa.int64()), ("data", pa.binary())]))
OUT_DDL = "array<struct<bytes:bigint,data:binary>>"
Frame = dict[str, Any]


def _begins(data: np.ndarray, letter: bool) -> tuple[np.ndarray, np.ndarray]:
    """Where units and where code points begin in UTF-8 bytes; letter: a run of letters goes on into them."""
    letters = ((data | 32) >= 97) & ((data | 32) <= 122)
    chars = (data & 0xC0) != 0x80
    before = np.append(letter, letters[:-1])[: len(data)]
    return (chars & ~letters) | (letters & ~before), chars


def stored(text: bytes, pack: Callable[[bytes], bytes], size: int = FRAME) -> tuple[int, int, list[Frame]]:
    """(units, code points, frames) of a text."""
    frames, units, chars, at, letter = [], 0, 0, 0, False
    while at < len(text):
        end = min(at + size, len(text))
        while end < len(text) and end - at > size - 4 and text[end] & 0xC0 == 0x80:
            end -= 1
        piece = text[at:end]
        begins, points = _begins(np.frombuffer(piece, np.uint8), letter)
        frames.append({"units": units, "chars": chars, "bytes": end - at, "letter": letter, "data": pack(piece)})
        units, chars, at = units + int(begins.sum()), chars + int(points.sum()), end
        letter = bytes([piece[-1] | 32]).isalpha() and piece[-1] < 128
    return units, chars, frames


def store(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n, n_chars, marked, frames) of every text; marked: it has a marker of its own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(write_content_size=True).compress
        for block in blocks(batches, text_col, 1 << 20):
            texts = utf8(block, text_col)
            made = [stored(t, pack) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [
                    block.column(id_col),
                    pa.array([m[0] for m in made], pa.int64()),
                    pa.array([m[1] for m in made], pa.int64()),
                    pa.array([any(k in t for k in MARKERS) for t in texts], pa.bool_()),
                    pa.array([m[2] for m in made], STORED),
                ],
                names=[id_col, "n", "n_chars", "marked", "frames"],
            )

    return durable(slim(docs, id_col, text_col).mapInArrow(run, f"{schema_of(docs, id_col)}, n long, n_chars long, marked boolean, frames {STORED_DDL}"))


def draw(doc_id: object, n: int, marked: bool) -> tuple[str, int, int]:
    """(form, units before the middle, units before the suffix) of a document of n units."""
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode("utf-8", "replace")).digest()
    h = [int.from_bytes(digest[i : i + 4], "big") for i in range(0, 16, 4)]
    first, second = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    if not n or marked or h[2] % 100 >= PLAIN_FROM:
        return "plain", first, second
    return ("spm" if h[3] % 100 < SPM_BELOW else "psm"), first, second


def seek(frames: list[Frame], unit: int, n: int, n_chars: int, unpack: Callable[[bytes], bytes]) -> tuple[int, int, int]:
    """(frame, byte in it, code points before) of where a unit begins; the end of the text for unit n. Opens one frame."""
    if unit >= n:
        return len(frames), 0, n_chars
    low, high = 0, len(frames) - 1
    while low < high:  # the last frame before which no more than `unit` units begin
        middle = (low + high + 1) // 2
        low, high = (middle, high) if frames[middle]["units"] <= unit else (low, middle - 1)
    begins, points = _begins(np.frombuffer(unpack(frames[low]["data"]), np.uint8), frames[low]["letter"])
    at = int(np.flatnonzero(begins)[unit - frames[low]["units"]])
    return low, at, frames[low]["chars"] + int(points[:at].sum())


def between(frames: list[Frame], start: tuple[int, int], end: tuple[int, int], pack: Callable[[bytes], bytes], unpack: Callable[[bytes], bytes]) -> list[Frame]:
    """Frames of the text from one place to another; whole frames are taken as they are."""
    out = []
    for i in range(start[0], min(end[0] + 1, len(frames))):
        low, high = (start[1] if i == start[0] else 0), (end[1] if i == end[0] else frames[i]["bytes"])
        if low == 0 and high == frames[i]["bytes"]:
            out.append({"bytes": high, "data": frames[i]["data"]})
        elif low < high:
            out.append({"bytes": high - low, "data": pack(unpack(frames[i]["data"])[low:high])})
    return out


def _rearranged(batches: Iterator[pa.RecordBatch], id_col: str) -> Iterator[pa.RecordBatch]:
    pack, unpack = zstandard.ZstdCompressor(write_content_size=True).compress, zstandard.ZstdDecompressor().decompress
    marker = {m: {"bytes": len(m), "data": pack(m)} for m in MARKERS}
    for batch in batches:
        made = []
        for row in batch.to_pylist():
            frames = row["frames"]
            form, first, second = draw(row[id_col], row["n"], row["marked"])
            if form == "plain":
                made.append((form, None, None, [{"bytes": f["bytes"], "data": f["data"]} for f in frames]))
                continue
            *a, before = seek(frames, first, row["n"], row["n_chars"], unpack)
            *b, upto = seek(frames, second, row["n"], row["n_chars"], unpack)
            prefix, middle, suffix = (between(frames, x, y, pack, unpack) for x, y in (((0, 0), tuple(a)), (tuple(a), tuple(b)), (tuple(b), (len(frames), 0))))
            parts = [marker[PREFIX], *prefix, marker[SUFFIX], *suffix] if form == "psm" else [marker[SUFFIX], *suffix, marker[PREFIX], *prefix]
            made.append((form, before, upto - before, [*parts, marker[MIDDLE], *middle]))
        columns = list(zip(*made, strict=True)) or [()] * 4
        kinds = (pa.string(), pa.int64(), pa.int64(), OUT)
        yield pa.RecordBatch.from_arrays([batch.column(id_col), batch.column("n"), *[pa.array(c, t) for c, t in zip(columns, kinds, strict=True)]], names=[id_col, "n", "form", "prefix_chars", "middle_chars", "frames"])


def rearrange(texts: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(id, n, form, prefix_chars, middle_chars, frames) of a store: the transformed documents, as frames in order."""
    return texts.mapInArrow(lambda batches: _rearranged(batches, id_col), f"{schema_of(texts, id_col)}, n long, form string, prefix_chars long, middle_chars long, frames {OUT_DDL}")


def pieces(frames: list[Frame], start: int = 0, end: int | None = None) -> Iterator[bytes]:
    """The bytes from start to end, a piece for each frame that has some of them; no other frame is opened."""
    unpack, at = zstandard.ZstdDecompressor().decompress, 0
    for f in frames:
        low, high = max(start - at, 0), f["bytes"] if end is None else min(end - at, f["bytes"])
        if low < high:
            yield unpack(f["data"])[low:high]
        at += f["bytes"]


def markers(stream: Iterator[bytes]) -> tuple[str, dict[bytes, int]]:
    """(SHA-256 of a stream, where in it each marker is first), in one pass; a marker may lie across pieces."""
    digest, at, tail, found = hashlib.sha256(), 0, b"", {}
    for piece in stream:
        digest.update(piece)
        seen = tail + piece
        for m in MARKERS:
            if m not in found and (i := seen.find(m)) >= 0:
                found[m] = at - len(tail) + i
        at, tail = at + len(piece), seen[-2:]
    return digest.hexdigest(), found


def restored(frames: list[Frame], form: str, found: dict[bytes, int]) -> Iterator[bytes]:
    """The original text, in pieces, from the rearranged frames, their form and the places of the markers."""
    if form == "plain":
        yield from pieces(frames)
        return
    prefix, suffix, middle = (found[m] for m in MARKERS)
    yield from pieces(frames, prefix + 3, suffix if form == "psm" else middle)
    yield from pieces(frames, middle + 3)
    yield from pieces(frames, suffix + 3, middle if form == "psm" else prefix)


def _digested(batches: Iterator[pa.RecordBatch], id_col: str) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        outputs, originals = [], []
        for form, frames in zip(batch.column("form").to_pylist(), batch.column("frames").to_pylist(), strict=True):
            digest, found = markers(pieces(frames))
            outputs.append(digest)
            again = hashlib.sha256()
            for piece in restored(frames, form, found):
                again.update(piece)
            originals.append(again.hexdigest())
        names = [id_col, "n", "form", "prefix_chars", "middle_chars"]
        yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in names], pa.array(outputs, pa.string()), pa.array(originals, pa.string())], names=[*names, "output_sha256", "restored_sha256"])


def digests(texts: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(id, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256) of a store.

    Rearranges and reads back in one task, so that rearranged frames do not travel.
    """
    form = f"{schema_of(texts, id_col)}, n long, form string, prefix_chars long, middle_chars long, output_sha256 string, restored_sha256 string"
    return texts.mapInArrow(lambda batches: _digested(_rearranged(batches, id_col), id_col), form)


def texts_of(rearranged: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(id, output, restored): the transformed documents and the originals rebuilt from them, as text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):  # texts may be long: one at a time
                row = batch.slice(i, 1)
                frames = row.column("frames").to_pylist()[0]
                output = b"".join(pieces(frames))
                back = b"".join(restored(frames, row.column("form")[0].as_py(), markers(pieces(frames))[1]))
                yield pa.RecordBatch.from_arrays([row.column(id_col), *[pa.array([x.decode("utf-8", "replace")]) for x in (output, back)]], names=[id_col, "output", "restored"])

    return rearranged.mapInArrow(run, f"{schema_of(rearranged, id_col)}, output string, restored string")
