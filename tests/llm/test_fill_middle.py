import hashlib
import re

import numpy as np
import pytest
import zstandard
from hypothesis import given, settings
from hypothesis import strategies as st

from tapelens.llm import fill_middle, queries

PACK, UNPACK = zstandard.ZstdCompressor(write_content_size=True).compress, zstandard.ZstdDecompressor().decompress
UNIT = re.compile(r"[A-Za-z]+|[^A-Za-z]")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain(doc_id, text):
    """What the contract says, by Python strings: (n, form, prefix_chars, middle_chars, output)."""
    text = text or ""
    units = UNIT.findall(text)
    h = [int(sha(f"1:{'' if doc_id is None else doc_id}")[i : i + 8], 16) for i in range(0, 32, 8)]
    a, b = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
    prefix, middle, suffix = ("".join(units[i:j]) for i, j in ((0, a), (a, b), (b, len(units))))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return len(units), "plain", None, None, text
    if h[3] % 100 < 20:
        return len(units), "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return len(units), "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


TEXT = st.one_of(st.text(st.characters(exclude_categories=["Cs"])), st.text("ab <>PSM é\U0001f600\n", max_size=90))


@settings(max_examples=300, deadline=None)
@given(TEXT, st.integers(4, 9))
def test_places_in_frames(text, size):
    """Every unit is found in the one frame opened for it, whatever the frames; whole frames move as they are."""
    n, chars, frames = fill_middle.stored(text.encode(), PACK, size)
    units = UNIT.findall(text)
    assert (n, chars) == (len(units), len(text)) and b"".join(UNPACK(f["data"]) for f in frames).decode() == text
    assert all(f["bytes"] <= size for f in frames)
    opened = []
    for k in range(n + 1):
        opened.clear()
        i, at, before = fill_middle.seek(frames, k, n, chars, lambda d: opened.append(d) or UNPACK(d))
        assert len(opened) <= 1 and before == len("".join(units[:k]))
        made = [fill_middle.between(frames, *x, PACK, UNPACK) for x in (((0, 0), (i, at)), ((i, at), (len(frames), 0)))]
        assert [b"".join(fill_middle.pieces(m)).decode() for m in made] == ["".join(units[:k]), "".join(units[k:])]
        assert sum(a is b for m in made for f in m for a, b in [(f["data"], g["data"]) for g in frames]) >= len(frames) - 1


@settings(max_examples=200, deadline=None)
@given(st.lists(st.binary(max_size=5)))
def test_markers_across_pieces(parts):
    whole = b"".join(parts)
    digest, found = fill_middle.markers(iter(parts))
    assert digest == hashlib.sha256(whole).hexdigest() and found == {m: whole.find(m) for m in fill_middle.MARKERS if m in whole}


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_odd_rows(spark, odd, none, monkeypatch):
    more = spark.createDataFrame([(20, "a<P>b"), (21, "x <S> y"), (22, "no<M>"), (23, "<P"), (24, "<" * 200 + ">" * 200), (25, "a" * 300_000 + " b")], "doc_id long, text string")
    table = odd.unionByName(more, allowMissingColumns=True)
    want = sorted(((i, *plain(i, t)[:4], sha(plain(i, t)[4]), sha(t or "")) for i, t in ((r.doc_id, r.text) for r in table.collect())), key=repr)
    assert rows(fill_middle.digests(fill_middle.store(table))) == want
    assert fill_middle.digests(fill_middle.store(none)).count() == 0


def test_outputs_are_zstandard_streams(spark, sf):
    """The operator's own outputs: frames that any reader decompresses, and texts."""
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    made = fill_middle.rearrange(fill_middle.store(docs))
    for r in made.collect():
        stream = b"".join(f.data for f in r.frames)
        whole = zstandard.ZstdDecompressor().stream_reader(stream, read_across_frames=True).read().decode() if stream else ""
        assert whole == plain(r.doc_id, texts[r.doc_id])[4]
    assert {(r.doc_id, r.output, r.restored) for r in fill_middle.texts_of(made).collect()} == {(i, plain(i, t)[4], t or "") for i, t in texts.items()}


def test_query(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    want = sorted(((r.doc_id, *plain(r.doc_id, r.text)[:4], sha(plain(r.doc_id, r.text)[4]), sha(r.text or "")) for r in docs), key=repr)
    got = queries.op12_fill_in_middle(spark, sf)
    assert rows(got) == want and {r.form for r in got.collect()} == {"plain", "psm", "spm"}


def test_long_texts_open_two_frames():
    text = ("word " * 100_000).encode()
    n, chars, frames = fill_middle.stored(text, PACK)
    assert len(frames) == -(-len(text) // fill_middle.FRAME)
    for k in np.linspace(0, n, 9).astype(int):
        i, at, before = fill_middle.seek(frames, int(k), n, chars, UNPACK)
        assert before == sum(map(len, UNIT.findall(text.decode())[:k])) and (i == len(frames) or at < frames[i]["bytes"])


@pytest.mark.parametrize("h", range(40))
def test_draw(h):
    form, a, b = fill_middle.draw(h, 1000, False)
    n, want, prefix, middle, _ = plain(h, "- " * 500)
    assert (n, form) == (1000, want) and (want == "plain" or (a, b - a) == (prefix, middle))
