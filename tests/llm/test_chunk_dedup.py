import random
from collections import defaultdict

import numpy as np

from tapelens.llm import chunk_dedup, queries


def words(draw, n):
    return ["".join(draw.choices("abcdefghé", k=draw.randint(1, 9))) for _ in range(n)]


def test_gear_hash_by_definition():
    line, table = np.frombuffer(np.random.default_rng(0).bytes(5000), np.uint8) & 0x7F, chunk_dedup.gear()
    got = chunk_dedup.cuts(line, np.array([0]))
    want, before = [0], -chunk_dedup.LEAST
    for i in range(chunk_dedup.WINDOW, len(line)):
        h = 0
        for b in line[i - chunk_dedup.WINDOW : i]:
            h = (h << 1) + int(table[b])
        if h >> 15 & 15 == 0:
            want += [i] * (i - before >= chunk_dedup.LEAST)
            before = i
    assert set(want) <= set(got.tolist()) and len(got) < 1.1 * len(want)
    assert set(got.tolist()) - set(want) == set(chunk_cuts(line, want))


def chunk_cuts(line, edges):
    """The further cuts in long chunks, by definition."""
    out, table, near = [], chunk_dedup.gear(), chunk_dedup.NEAR
    value = [sum(int(table[b]) << (chunk_dedup.WINDOW - 1 - k) for k, b in enumerate(line[max(0, i - 15) : i + 1])) % (1 << 32) for i in range(len(line))]
    for a, b in zip(edges, [*edges[1:], len(line)], strict=True):
        last = a - chunk_dedup.LEAST
        for i in range(a, b) if b - a > chunk_dedup.LONG else ():
            if value[i] == min(value[max(a, i - near) : min(b, i + near + 1)]) and i + 1 >= chunk_dedup.WINDOW and i + 1 - last >= chunk_dedup.LEAST and a + chunk_dedup.LEAST <= i + 1 <= b - chunk_dedup.LEAST:
                out.append(i + 1)
                last = i + 1
    return out


def test_periodic_stretches_meet(spark):
    """Stretches that repeat a phrase of one to ten words, of different lengths and among different texts, are found."""
    draw, rows, texts = random.Random(9), [], []
    for n in (1, 1, 1, 2, 3, 5, 8, 10):
        phrase = words(draw, n)
        for _ in range(2):
            rows.append((len(rows), " ".join([*words(draw, draw.randint(5, 40)), *(phrase * 80)[: draw.randint(70, 75)], *words(draw, draw.randint(5, 40))])))
    found = {r.doc_id for r in chunk_dedup.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found == set(range(len(rows)))


def test_a_chunk_that_is_everywhere(spark, monkeypatch):
    """Hot chunks are dealt over tasks with the same result."""
    draw = random.Random(11)
    line = " ".join(words(draw, 60))
    rows = [(i, " ".join([*words(draw, 20), line, *words(draw, 20)])) for i in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(40)
    want = sorted(map(tuple, chunk_dedup.repeated_passages(df).collect()))
    monkeypatch.setattr(chunk_dedup, "LEAST_HOT", 3)
    assert sorted(map(tuple, chunk_dedup.repeated_passages(df).collect())) == want and len(want) == 200
    assert sum(r[4] > 0 for r in want) == 199


def test_chunks_cover_texts_and_resist_shifts():
    draw = random.Random(1)
    text = " ".join(words(draw, 3000)).encode()
    texts = [text, b"", b"x" + text[:50] + b" inserted " + text[50:], b"y" * 100_000]
    digests, found = chunk_dedup.places(texts, np.array([1, 2, 3, 4]))
    by = defaultdict(list)
    for d, p in zip(digests.tolist(), found, strict=True):
        by[int(p["key"]) - (1 << 63)].append((int(p["pos"]), int(p["size"]), int(p["words"]), d))
    for key, chunks in by.items():
        chunks.sort()
        at = 0
        for pos, size, _, _ in chunks:
            assert pos == at
            at += size
        assert at == len(texts[key - 1]) and sum(c[2] for c in chunks) == len(texts[key - 1].split())
    same = {c[3] for c in by[1]} & {c[3] for c in by[3]}
    assert len(same) > 0.97 * len(by[1])


def windows(text, n):
    w = text.split()
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)}


def sharing(docs, n):
    """Ids of documents that share n words in a row with another."""
    of = defaultdict(set)
    for i, t in docs:
        for w in windows(t or "", n):
            of[w].add(i)
    return {i for ids in of.values() if len(ids) > 1 for i in ids}


def test_planted_passages(spark):
    draw = random.Random(7)
    passages = [" ".join(words(draw, 55)) for _ in range(60)]
    docs = []
    for i in range(400):
        w = words(draw, draw.randint(30, 200))
        if i < 240:
            at = draw.randint(0, len(w))
            w = [*w[:at], passages[i % 60], *w[at:]]
        docs.append((i, " ".join(w)))
    docs += [(400 + i, " ".join([*words(draw, 40), "a shared line of eight words in all", *words(draw, 40)])) for i in range(30)]
    found = {r.doc_id: r for r in chunk_dedup.repeated_passages(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert set(found) <= set(range(240)) and len(found) >= 235
    spare = sum(r.spare_bytes > 0 for r in found.values())
    assert 170 <= spare <= 180  # all but the first of each four
    left = {r.doc_id: r.text for r in chunk_dedup.remove_repeats(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    before = dict(docs)
    assert all(len(left[i].encode()) == len(before[i].encode()) - (found[i].spare_bytes if i in found else 0) for i in before)
    assert not sharing(left.items(), 30)


def test_documents(spark):
    sf = "/root/testdata/sf0.01"
    docs = [(r.doc_id, r.text) for r in queries.documents(spark, sf).collect()]
    found = {r.doc_id for r in queries.op9_chunk_dedup(spark, sf).collect()}
    must, may = sharing(docs, 50), sharing(docs, 15)
    assert len(must - found) <= 0.01 * len(must) and len(found - may) <= 0.01 * len(found)


def test_odd_rows(odd, none):
    found = {r.doc_id for r in chunk_dedup.repeated_passages(odd, min_words=5).collect()}
    assert {10, 11} <= found and not found & {None, 3, 4, 5, 6, 7, 8, 9}
    left = chunk_dedup.remove_repeats(odd, min_words=5)
    assert left.columns == odd.columns and left.count() == odd.count()
    assert chunk_dedup.repeated_passages(none).count() == 0 and chunk_dedup.remove_repeats(none).count() == 0
