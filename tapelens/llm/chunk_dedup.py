"""Repeated passages by content-defined chunking.

A gear rolling hash over the last WINDOW bytes cuts texts where its upper bits are zero (not within
LEAST bytes of another such place), so the cuts depend on nearby bytes only and an insertion moves
them with the text. A chunk of over LONG bytes is cut again where the hash is least among NEAR bytes
on both sides, ties included, so that a stretch that repeats a phrase is cut once a phrase (or once
in as many as make LEAST bytes), whatever its length. Chunks are hashed; each task first folds equal
chunks of a block of texts into one row with a packed list of places, so a chunk that is everywhere
is a row per block. The first and last document of each chunk are aggregated, and chunks of two or
more documents are repeated; their rows then meet that answer in a join where those of a chunk with
very many rows are dealt over tasks. Repeated chunks that follow each other make a span, and spans
of MIN_WORDS words or more are reported: a repeated passage of over 50 words holds such a span, its
ends being lost to the chunks they are cut in.

Of the places of a chunk the first, by (hash of the document, position), stays; other places
can be removed from the texts.

Defined results: a null or empty text has no chunks. Repeats inside one document alone are not
reported. Rows that repeat an id and its text are one document. Documents without a repeated
passage have no row. The chunks of a span may each be shared with another document; so a text that
says one word over and over can have a row for the sake of one that says it less often. Other
columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapelens.llm.common import LEAST_HOT, SHARE, blocks, durable, free, shuffle_partitions, small_batches, utf8

WINDOW, CUT_BITS, LEAST, LONG, NEAR, MOST = 16, 4, 8, 96, 40, 1 << 15
MIN_WORDS = 30
#: A place of a chunk: document hash (offset by 2**63), position and length in bytes, words that start in it; big-endian, so that bytes sort as numbers do.
PLACE = np.dtype([("key", ">u8"), ("pos", ">u4"), ("size", ">u2"), ("words", ">u2")])
SPACES = np.isin(np.arange(256), list(b" \t\n\x0b\x0c\r"))


def gear() -> np.ndarray:
    return np.random.default_rng(2).integers(0, 1 << 32, 256, dtype=np.uint32)


def cuts(line: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Where chunks start in texts laid end to end: at texts' starts and after the bytes where the hash says so."""
    h = gear()[line]
    for k in (1, 2, 4, 8):  # h[i] becomes the sum of the last 2k bytes' values, each shifted by its age
        older = np.zeros_like(h)
        older[k:] = h[:-k] << np.uint32(k)
        h += older
    hit = (h >> np.uint32(WINDOW - 1) & np.uint32((1 << CUT_BITS) - 1)) == 0
    whole = np.append(line[1:] & 0xC0 != 0x80, False)  # a cut after this byte is not inside a character
    hit &= whole
    at = np.flatnonzero(hit) + 1
    own = starts[np.searchsorted(starts, at, "right") - 1]
    at, own = at[at - own >= WINDOW], own[at - own >= WINDOW]
    lone = np.ones(len(at), bool)
    lone[1:] = np.diff(at) >= LEAST
    edges = np.union1d(starts, at[lone])
    more = []
    for i in np.flatnonzero(np.diff(edges, append=len(line)) > LONG).tolist():
        a, b = int(edges[i]), int(edges[i + 1]) if i + 1 < len(edges) else len(line)
        text = int(starts[np.searchsorted(starts, a, "right") - 1])
        more += least_places(np.where(whole[a:b], h[a:b], np.uint32(0xFFFFFFFF)), max(0, text + WINDOW - a), a)
    edges = np.union1d(edges, np.array(more, np.int64))
    far = np.flatnonzero(np.diff(edges, append=len(line)) > MOST)
    fixed = [np.arange(edges[i] + MOST, edges[i + 1] if i + 1 < len(edges) else len(line), MOST) for i in far]
    return np.union1d(edges, np.concatenate(fixed)) if fixed else edges


def least_places(h: np.ndarray, skip: int, start: int) -> list[int]:
    """Cuts in a long chunk whose hashes are h: after the bytes, from `skip` on, that have the least hash within NEAR bytes; LEAST apart."""
    low = np.concatenate([np.full(NEAR, 0xFFFFFFFF, np.uint32), h, np.full(NEAR, 0xFFFFFFFF, np.uint32)])
    wide = 1
    while wide < 2 * NEAR + 1:  # low[i] becomes the least of `wide` hashes from i on
        step = min(wide, 2 * NEAR + 1 - wide)
        low = np.minimum(low[:-step], low[step:])
        wide += step
    found = np.flatnonzero((h == low) & (h != np.uint32(0xFFFFFFFF)))
    out, last = [], -LEAST
    for at in (found[found + 1 >= skip] + 1).tolist():
        if at - last >= LEAST and LEAST <= at <= len(h) - LEAST:
            out.append(start + at)
            last = at
    return out


def places(texts: list[bytes], keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The digest and place of every chunk of the texts, sorted by digest and place."""
    keep = [i for i, t in enumerate(texts) if t]
    if not keep:
        return np.zeros(0, np.uint64), np.zeros(0, PLACE)
    raw = b"".join([texts[i] for i in keep])
    line = np.frombuffer(raw, np.uint8)
    lengths = np.array([len(texts[i]) for i in keep])
    starts = np.cumsum(lengths) - lengths
    edges = cuts(line, starts)
    ends = np.append(edges[1:], len(line))
    of = np.searchsorted(starts, edges, "right") - 1
    space = SPACES[line]
    word = ~space
    word[1:] &= space[:-1] | np.isin(np.arange(1, len(line)), starts)
    seen = np.concatenate([[0], np.cumsum(word)])
    out = np.zeros(len(edges), PLACE)
    out["key"] = keys[keep][of].view(np.uint64) ^ np.uint64(1 << 63)
    out["pos"], out["size"], out["words"] = edges - starts[of], ends - edges, seen[ends] - seen[edges]
    digest = xxhash.xxh64_intdigest
    digests = np.array([digest(raw[i:j]) for i, j in zip(edges.tolist(), ends.tolist(), strict=True)], np.uint64)
    order = np.lexsort((out["pos"], out["key"], digests))
    return digests[order], out[order]


def _signed_key(key: np.ndarray) -> np.ndarray:
    return (key.astype(np.uint64) ^ np.uint64(1 << 63)).view(np.int64)


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, key, t): the key is a hash of the id and the text."""
    small_batches(docs.sparkSession)
    return docs.select(docs[id_col], F.xxhash64(id_col, text_col).alias("key"), F.col(text_col).alias("t"))


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """(key, start, stop, words, spare): byte spans of repeated passages; spare: the parts [start, stop) of which an earlier place exists."""

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, "t"):
            digests, found = places(utf8(block, "t"), block.column("key").to_numpy())
            first = np.flatnonzero(np.append(True, digests[1:] != digests[:-1])) if len(digests) else np.zeros(0, np.int64)
            raw, bounds = found.tobytes(), (np.append(first, len(found)) * PLACE.itemsize).astype(np.int32)
            packed = pa.BinaryArray.from_buffers(pa.binary(), len(first), [None, pa.py_buffer(bounds.tobytes()), pa.py_buffer(raw)])
            ends = [pa.array(_signed_key(found["key"][i])) for i in (first, np.append(first, len(found))[1:] - 1)]
            yield pa.RecordBatch.from_arrays([pa.array(digests[first].view(np.int64)), *ends, packed], names=["digest", "low", "high", "places"])

    rows = keyed(docs, id_col, text_col).select("key", "t").mapInArrow(fold, "digest long, low long, high long, places binary")
    met = rows.groupBy("digest").agg(F.min("low").alias("low"), F.max("high").alias("high"), F.count("*").alias("n")).where("low <> high")
    met = durable(met.select("digest", F.col("low").alias("head"), "n"))
    # A chunk of over a SHARE-th of the repeated rows is dealt over tasks; there are at most SHARE of them.
    limit = max(LEAST_HOT, (met.agg(F.sum("n")).first()[0] or 0) // SHARE)
    met = met.withColumn("parts", F.ceil(F.col("n") / limit).cast("int"))
    hot = F.broadcast(met.where("parts > 1").select("digest", "parts"))
    rows = rows.select("digest", "places").join(hot, "digest", "left")
    rows = rows.withColumn("part", F.when(F.col("parts").isNull(), 0).otherwise(F.pmod(F.xxhash64("places"), "parts")).cast("int")).drop("parts")
    heads = met.select("digest", "head", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    rows = rows.join(heads, ["digest", "part"]).select("places", "head")

    def open_(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches, "places", 1 << 20):
            packed = batch.column("places").to_pylist()
            out = np.frombuffer(b"".join(packed), PLACE)
            counts = np.array([len(p) // PLACE.itemsize for p in packed])
            head, key = np.repeat(batch.column("head").to_numpy(), counts), _signed_key(out["key"])
            # The first place of the first document stays; all places of a document are in one row, in order.
            spare = key != head
            spare[1:] |= (key[1:] == key[:-1]) & ~np.isin(np.arange(1, len(key)), np.cumsum(counts))
            columns = [key, out["pos"].astype(np.int64), out["size"].astype(np.int32), out["words"].astype(np.int32), spare]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["key", "pos", "size", "words", "spare"])

    chunks = rows.mapInArrow(open_, "key long, pos long, size int, words int, spare boolean")
    chunks = chunks.repartition(shuffle_partitions(docs), "key").sortWithinPartitions("key", "pos")

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        span: list | None = None  # key, start, stop, words, spare parts; stays open over batches
        for batch in batches:
            done = []
            for key, pos, size, words, spare in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if span and key == span[0] and pos < span[2]:
                    continue  # a row that repeats id and text
                if not (span and key == span[0] and pos == span[2]):
                    if span and span[3] >= min_words:
                        done.append(span)
                    span = [key, pos, pos, 0, []]
                span[2], span[3] = pos + size, span[3] + words
                if spare:
                    if span[4] and span[4][-1]["stop"] == pos:
                        span[4][-1]["stop"] = pos + size
                    else:
                        span[4].append({"start": pos, "stop": pos + size})
            yield _spans(done)
        yield _spans([span] if span and span[3] >= min_words else [])

    return chunks.mapInArrow(join, "key long, start long, stop long, words long, spare array<struct<start:long,stop:long>>")


def _spans(rows: list[list]) -> pa.RecordBatch:
    kinds = [pa.int64()] * 4 + [pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=["key", "start", "stop", "words", "spare"])


def repeated_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """(id, n_passages, repeat_words, repeat_bytes, spare_bytes) of the documents that have repeated passages."""
    spare = F.aggregate("spare", F.lit(0).cast("long"), lambda a, x: a + x["stop"] - x["start"])
    spans = repeated_spans(docs, id_col, text_col, min_words).groupBy("key")
    found = spans.agg(F.count("*").alias("n_passages"), F.sum("words").alias("repeat_words"), F.sum(F.col("stop") - F.col("start")).alias("repeat_bytes"), F.sum(spare).alias("spare_bytes"))
    ids = keyed(docs, id_col, text_col).select(id_col, F.col("key").alias("own_key")).distinct()
    return ids.join(found, F.col("own_key") == F.col("key")).drop("own_key", "key")


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """All documents and columns; texts lose the parts of repeated passages of which an earlier place exists."""
    key, of, parts = (free(docs, x) for x in ("own_key", "key_cut", "parts_cut"))
    spans = repeated_spans(docs, id_col, text_col, min_words).groupBy("key").agg(F.flatten(F.collect_list("spare")).alias("parts"))
    table = spans.select(F.col("key").alias(of), F.col("parts").alias(parts))
    joined = docs.withColumn(key, F.xxhash64(id_col, text_col)).join(table, F.col(key) == F.col(of), "left").drop(key, of)
    form, at = joined.schema, joined.columns.index(text_col)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for text, cut_out in zip(batch.column(text_col).to_pylist(), batch.column(parts).to_pylist(), strict=True):
                if cut_out:
                    raw, kept, done = text.encode(), [], 0
                    for part in sorted(cut_out, key=lambda p: p["start"]):
                        kept.append(raw[done : part["start"]])
                        done = max(done, part["stop"])
                    text = b"".join([*kept, raw[done:]]).decode("utf-8", "replace")
                texts.append(text)
            yield batch.set_column(at, text_col, pa.array(texts, pa.string()))

    return joined.mapInArrow(cut, form).drop(parts)
