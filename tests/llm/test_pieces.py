import hashlib
import re
from pathlib import Path

import numpy as np
import pyarrow as pa
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tapelens.llm import pieces, queries
from tapelens.llm.common import release

LIBRARY = sentencepiece.SentencePieceProcessor(model_file=queries.MODEL)
ENCODER = pieces.Encoder(queries.MODEL)


def same(text):
    assert np.frombuffer(ENCODER.encode(text), "<u4").tolist() == LIBRARY.encode(text), text


@settings(max_examples=400, deadline=None)
@given(st.one_of(st.text(st.characters(exclude_categories=["Cs"])), st.text("ab thein ▁\n\t é0<>x", max_size=60)))
def test_encodes_as_the_library(text):
    same(text)


def test_a_border_holds_as_merges_say():
    """Tokens that met in texts, and any two; the walk back over their merges is far cheaper than to merge them anew."""
    rng = np.random.default_rng(5)
    come_out = [ENCODER.text[i] for _, (i, _) in ENCODER.automaton.items()]
    short = [t for t in come_out if len(set(t)) == 1] + [a + b for a in "ab" for b in "ab" if a + b in ENCODER.id]
    pairs = [(come_out[i], come_out[j]) for i, j in rng.integers(0, len(come_out), (5_000, 2))] + [(a, b) for a in short[:80] for b in short[:80]]
    pairs += [(w[:k], w[k:]) for w in come_out[::7] for k in range(1, len(w)) if w[:k] in ENCODER.split and w[k:] in ENCODER.split]
    wrong = [(a, b) for a, b in pairs if ENCODER.apart(a, b) != (ENCODER.merge(a + b) == [a, b])]
    assert ENCODER.monotone and not wrong
    assert {ENCODER.apart(a, b) for a, b in pairs} == {True, False}


def test_pairs_are_told_without_merging(monkeypatch):
    met = []
    monkeypatch.setattr(ENCODER, "merge", lambda *text: met.append(text))
    ENCODER.forget()
    same("Pairs of tokens that meet for the first time are not merged, however many there are: 1234567890.")
    assert ENCODER.compatible and not met


def test_odd_rows(odd, none):
    rows = {(r.doc_id, r.text) for r in odd.collect()}
    want = sorted(
        (
            (i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(LIBRARY.decode(ids).encode()).hexdigest())
            for i, t in rows
            for ids in [LIBRARY.encode(t or "", add_bos=True, add_eos=True)]
        ),
        key=repr,
    )
    got = pieces.round_trip(odd, queries.MODEL)
    assert got.count() == odd.count()
    assert sorted({tuple(r) for r in got.collect()}, key=repr) == want
    assert pieces.round_trip(none, queries.MODEL).count() == 0
    ids = {(r.doc_id, len(r.token_ids)) for r in pieces.tokenize(odd, queries.MODEL).collect()}
    assert ids == {(w[0], w[1]) for w in want}


def test_documents(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for r in docs.collect():
        same(r.text)
    assert queries.op3_sentencepiece(spark, sf).count() == docs.count()


def test_a_worker_keeps_nothing_of_the_texts(spark):
    """Workers stay for other stages, so what they remember of texts goes with the task."""

    def held(batches):
        list(batches)
        yield pa.RecordBatch.from_pydict({"n": [sum(len(e.cache) + len(e.compatible) for e, _ in pieces._loaded.values())]})

    docs = spark.range(2000).select(F.col("id").alias("doc_id"), F.concat(F.lit("some words of text "), F.sha2(F.col("id").cast("string"), 256)).alias("text"))
    assert pieces.round_trip(docs, queries.MODEL).count() == 2000
    assert spark.range(0, 64, 1, 64).mapInArrow(held, "n long").agg(F.max("n")).first()[0] == 0


def test_freed_memory_goes_back():
    def held() -> int:
        return sum(map(int, re.findall(r"\nAnonymous:\s+(\d+)", Path("/proc/self/smaps_rollup").read_text())))

    blocks = [np.ones(8_000) for _ in range(3_000)]  # 192 MB in blocks too small for a mapping of their own
    top, blocks = np.ones(8_000), None
    before = held()
    release()
    assert len(top) and before - held() > 100_000
