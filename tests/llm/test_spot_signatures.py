import hashlib
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tapelens.llm import queries, spot_signatures
from tapelens.llm.spot_signatures import ANCHORS, CHAIN, GAP, SHORT


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def spots(text):
    """The multiset of (anchor, chain) of a text, word by word."""
    words = [w for w in re.split(r"[\W_]+", (text or "").lower()) if w]
    content = [i for i, w in enumerate(words) if len(w) > SHORT and w not in ANCHORS]
    after = lambda i: tuple(words[j] for j in content if j > i)[:CHAIN]
    found = [("", *after(-1))] if words else []
    for i, w in enumerate(words):
        if i not in content or i >= GAP and all(j in content for j in range(i - GAP, i)):
            found.append((w, *after(i)))
    return Counter(found)


def jaccard(a, b):
    return (a & b).total() / (a | b).total() if a or b else 1.0


def edited(rows):
    """(text, next text) of each (id, text), in the order of ids."""
    out = []
    for k, (i, t) in enumerate(rows):
        after = rows[(k + 1) % len(rows)][1]
        q = len(t) // 4
        out.append((i, t, t[: len(t) - q] + after[:q], after))
    return out


def check(got, rows):
    assert len(got) == len(rows)
    by_id = {r.doc_id: r for r in got}
    for i, t, e, after in edited(rows):
        r = by_id[i]
        assert (r.n_chars, r.edited_sha256) == (len(t), sha(e))
        assert r.near_edited == pytest.approx(jaccard(spots(t), spots(e))) and r.near_next == pytest.approx(jaccard(spots(t), spots(after)))
        assert len(r.fingerprint.split()) == spots(t).total() and len(r.edited_fingerprint.split()) == spots(e).total()


def test_query(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").orderBy("doc_id").collect()
    got = queries.op13_spot_signatures(spark, sf).collect()
    check(got, [(r.doc_id, r.text or "") for r in docs])
    texts = {r.doc_id: r.text or "" for r in docs}
    prints = {}
    for r in got:
        prints.setdefault(texts[r.doc_id], set()).add(r.fingerprint)
    assert all(len(p) == 1 for p in prints.values())
    long = [r for r in got if r.n_chars > 300]
    assert sum(r.near_edited > 0.4 for r in long) > 0.97 * len(long) and sum(r.near_next < 0.1 for r in long) > 0.97 * len(long)


TEXTS = [
    "", " \n", "one", "the", "The End", "the the the the the the the the", "Of a kind: über-große Wörter, und der Rest des Textes; être où ça va bien",
    "alpha bravo charlie delta echoes foxtrot golfing hotels indigo juliet", "spam eggs " * 50, "a " * 300 + "tail end words here", "naïvé 1234 56 x_y z\x00w", "\U0001f600 emoji only \U0001f600 text", "12 34 56",
]


@pytest.mark.parametrize("n", [1, 2, len(TEXTS)])
def test_texts_by_brute_force(spark, n):
    rows = list(enumerate(TEXTS[-n:]))
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    check(spot_signatures.compare_next(table).collect(), rows)


def test_odd_rows(odd, none):
    """Rows of one id and text are one document; nulls are last; equal ids are by digest of text."""
    rows = {(r.doc_id, r.text or "") for r in odd.collect()}
    key = lambda i, t: hashlib.md5((f"={i}" if i is not None else "").encode() + b"\n" + t.encode()).digest()
    order = sorted(rows, key=lambda x: (x[0] is None, x[0] or 0, key(*x)))
    got = spot_signatures.compare_next(odd)
    assert got.count() == odd.count()
    want = {(i, len(t), sha(e), round(jaccard(spots(t), spots(e)), 9), round(jaccard(spots(t), spots(after)), 9)) for i, t, e, after in edited(order)}
    assert {(r.doc_id, r.n_chars, r.edited_sha256, round(r.near_edited, 9), round(r.near_next, 9)) for r in got.collect()} == want
    assert spot_signatures.compare_next(none).count() == 0
    assert spot_signatures.compare_next(none).columns == got.columns


def test_order_over_ranges(spark):
    rows = spark.range(5_000).select(F.hex("id").cast("binary").alias("key"), (F.col("id") * 7919 % 5_003).alias("id"), F.lit(1).alias("n_chars"))
    found = {bytes(r.key): bytes(r.next_key) for r in spot_signatures.following(rows).collect()}
    ids = {bytes(r.key): r.id for r in rows.collect()}
    order = sorted(ids, key=ids.get)
    assert found == dict(zip(order, order[1:] + order[:1], strict=True))


def test_whole_texts_move_once_and_no_python(spark, sf):
    plan = spot_signatures.compare_next(spark.read.parquet(f"{sf}/documents.parquet"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
