import random
import re

import numpy as np
import xxhash
from pyspark.sql import functions as F

from tapelens.llm import queries, simhash


def fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(len(words) - 3)] or [" ".join(words)]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def reach(fps):
    """The smallest number each fingerprint reaches by links of at most four bits."""
    a = np.array(fps, np.uint64)
    root = list(range(len(a)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(a)):
        for j in np.flatnonzero(np.bitwise_count(a[i + 1 :] ^ a[i]) <= 4) + i + 1:
            x, y = find(i), find(int(j))
            root[max(x, y)] = min(x, y)
    return [find(i) for i in range(len(a))]


def check(rows, got):
    rows = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0))
    fps = [fingerprint(t) for _, t in rows]
    want = sorted(((i, f, rows[c][0]) for (i, _), f, c in zip(rows, fps, reach(fps), strict=True)), key=repr)
    assert sorted(((r.doc_id, r.fp % (1 << 64), r.component_id) for r in got.collect()), key=repr) == want


def test_odd_rows(odd):
    check([(r.doc_id, r.text) for r in odd.collect()], simhash.near_duplicates(odd))


def test_documents(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    check([(r.doc_id, r.text) for r in docs.collect()], simhash.near_duplicates(docs))


def test_query_columns(spark, sf):
    got = queries.op1_simhash_near_dedup(spark, sf)
    assert got.columns[:3] == ["doc_id", "fingerprint", "component_id"]
    assert all(re.fullmatch("[0-9a-f]{16}", r.fingerprint) for r in got.collect())


def test_links_of_a_cluster(spark, monkeypatch):
    """Chains and balls around a centre, over few and many prefixes, with hot prefixes dealt out."""
    draw = random.Random(5)
    flip = lambda f, k: f ^ sum(1 << b for b in draw.sample(range(64), k))
    centre = draw.getrandbits(64)
    fps = [flip(centre, draw.randint(0, 6)) for _ in range(300)]
    for _ in range(20):
        f = draw.getrandbits(64)
        for _ in range(10):
            f = flip(f, draw.choice([3, 4, 5]))
            fps.append(f)
    fps = sorted(set(fps))
    root = reach(fps)
    signed = [f - (1 << 64) if f >= 1 << 63 else f for f in fps]
    for per, dealt, most in ((20, 40, 1 << 20), (1 << 17, 1 << 18, 1 << 20), (200, 400, 450), (1, 1 << 20, 100)):
        monkeypatch.setattr(simhash, "PER_PLACE", per)
        monkeypatch.setattr(simhash, "DEALT", dealt)
        monkeypatch.setattr(simhash, "MOST", most)
        monkeypatch.setattr(simhash, "HELD", 50_000 if per < 100 else 3_000_000)
        edges = simhash.links(spark.createDataFrame([(s,) for s in signed], "fp long"), len(fps))
        group = {r.node: r.root for r in simhash.components(edges).collect()}
        label = [group.get(s, s) for s in signed]
        first = {}
        assert [first.setdefault(x, i) for i, x in enumerate(label)] == root


def test_copies_of_a_fingerprint_stay_few():
    """How often a fingerprint travels: fewer times than it has variants at any size, and a place stays small."""
    for n, copies in ((10**6, 79), (10**8, 211), (10**10, 407)):
        b = simhash.prefix_bits(n, simhash.PER_PLACE, 32)
        own = 1 + b + b * (b - 1) // 2
        assert own <= copies < 2081 and n * own >> b <= simhash.PER_PLACE


def test_a_fingerprint_travels_as_often_in_a_larger_table(spark, monkeypatch):
    sent = []
    places = simhash._places
    monkeypatch.setattr(simhash, "_places", lambda rows, columns, per: sent.append(rows.count()) or places(rows, columns, per))
    for n in (2_000, 40_000):
        simhash.links(spark.range(n).select(F.xxhash64("id").alias("fp")), n)
    assert sent[1] == 20 * sent[0]
    assert {simhash.prefix_bits(n, simhash.PER_PLACE, 32, simhash.LEAST_PREFIX) for n in (1, 47_280, 235_748, 14_000_000)} == {simhash.LEAST_PREFIX}


def test_hot_centre(spark):
    """A star of 5,000 and chains keep their smallest node, with the centre looked up apart."""
    edges = [(i, 7) for i in range(10, 5000)] + [(i, i + 1) for i in range(6000, 6050)] + [(7, 3), (3, 4999)]
    got = {r.node: r.root for r in simhash.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {7: 3} | {i: 3 for i in range(10, 5000)} | {i: 6000 for i in range(6001, 6051)}


def test_drop(odd, none):
    left = simhash.drop_near_copies(odd)
    assert left.columns == odd.columns
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    found = {r.component_id for r in simhash.near_duplicates(odd).collect()}
    assert len(rows) > left.count() and sorted(r.doc_id for r in left.collect() if r.doc_id is not None) == sorted(x for x in found if x is not None)
    assert simhash.near_duplicates(none).count() == 0 and simhash.drop_near_copies(none).count() == 0


def test_drop_judges_rows_not_ids(spark):
    """Rows without an id, and rows that share one, go by their own texts."""
    words = lambda tag: " ".join(f"{tag}{i}" for i in range(40))
    rows = [(1, words("a")), (None, words("a")), (None, words("b")), (None, words("c")), (None, words("c")), (None, None), (3, ""), (4, words("d")), (4, words("a")), (4, words("e")), (5, words("e")), (5, words("f"))]
    left = simhash.drop_near_copies(spark.createDataFrame(rows, "doc_id long, text string"))
    want = [(1, words("a")), (None, words("b")), (None, words("c")), (3, ""), (4, words("d")), (4, words("e")), (5, words("f"))]
    assert sorted(map(tuple, left.collect()), key=repr) == sorted(want, key=repr)


def shingles(text):
    words = text.lower().split()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def test_stage_recall_of_similar_texts(spark):
    """Pairs of five-word similarity 0.8 to 0.95 go in the pipeline's stage, unlike ones all stay."""
    draw, texts, pairs = random.Random(8), [], []
    while len(pairs) < 300:
        words = [f"w{draw.randrange(5000)}" for _ in range(draw.randint(60, 400))]
        other = [w if draw.random() > 0.02 else "other" + w for w in words]
        x, y = shingles(" ".join(words)), shingles(" ".join(other))
        alike = len(x & y) / len(x | y)
        if 0.8 <= alike <= 0.95 or 0.55 < alike < 0.79:
            pairs.append((len(texts), len(texts) + 1, alike))
            texts += [" ".join(words), " ".join(other)]
    left = {r.doc_id for r in simhash.drop_near_copies(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    alike = [v not in left for _, v, j in pairs if j >= 0.8]
    assert len(alike) > 100 and sum(alike) / len(alike) > 0.9
    assert all(u in left for u, _, _ in pairs) and all(v in left for _, v, j in pairs if j < 0.79) and any(j < 0.79 for *_, j in pairs)


def test_stage_follows_a_large_cluster(spark):
    """Many copies of one text, each with a changed word: one stays; a text that shares half of it stays, too."""
    words = [f"w{i}" for i in range(200)]
    rows = [(i, " ".join([*words[:i], "new", *words[i + 1 :]])) for i in range(200)] + [(500, " ".join(words[:100] + [f"v{i}" for i in range(100)]))]
    assert sorted(r.doc_id for r in simhash.drop_near_copies(spark.createDataFrame(rows, "doc_id long, text string")).collect()) == [0, 500]


def test_stage_loses_no_pair_in_a_family(spark):
    """Planted pairs among 1,500 texts of one template: the stage's components are those of all pairs."""
    draw = random.Random(11)
    base = [f"w{i}" for i in range(120)]
    vary = lambda words, k: [w if i not in k else f"{w}x{draw.randrange(10**6)}" for i, w in enumerate(words)]
    texts = [vary(base, set(draw.sample(range(120), 6))) for _ in range(1_500)]
    texts += [vary(t, set(draw.sample(range(120), 2))) for t in texts[:100]]
    sets = [shingles(" ".join(t)) for t in texts]
    ids = {x: k for k, x in enumerate(set().union(*sets))}
    dense = np.zeros((len(sets), len(ids)), np.float32)
    for i, own in enumerate(sets):
        dense[i, [ids[x] for x in own]] = 1
    both = dense @ dense.T
    size = dense.sum(1)
    u, v = np.nonzero(np.triu(both >= 0.8 * (size[:, None] + size - both) - 1e-6, 1))
    root = simhash._roots(len(sets), u, v)
    assert 80 < len(u)
    left = [r.doc_id for r in simhash.drop_near_copies(spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")).collect()]
    assert sorted(left) == sorted(set(root.tolist()))


def test_sketches_and_places_lose_no_similar_pair(spark):
    """Sketches of similar sets pass at the first shingle that the sets share; unlike sets that share rare ones do not."""
    draw, rows = np.random.default_rng(3), []
    for k in range(400):
        n = int(draw.integers(5, 600))
        x = np.unique(draw.integers(0, 1 << 63, n).astype(np.uint64))
        keep = draw.random(len(x)) < draw.uniform(0.7, 1)
        y = np.unique(np.concatenate([x[keep], draw.integers(0, 1 << 63, int(draw.integers(0, n // 10 + 2))).astype(np.uint64)]))
        both = np.intersect1d(x, y)
        if len(both):
            first = [int(np.searchsorted(s, both[0])) for s in (x, y)]
            rows.append((len(both) / (len(x) + len(y) - len(both)), len(x), len(y), *first, simhash.sketch(x).tolist(), simhash.sketch(y).tolist()))
    df = spark.createDataFrame(rows, "j double, n_x long, n_y long, place_x long, place_y long, bits_x array<long>, bits_y array<long>")
    got = df.select("j", (simhash.first_may_be_shared() & simhash.sketches_are_near()).alias("passes")).collect()
    assert sum(r.j >= 0.8 for r in got) > 50 and all(r.passes for r in got if r.j >= 0.8)
    assert sum(not r.passes for r in got if r.j < 0.7) > 0.8 * sum(r.j < 0.7 for r in got) > 20


def test_stage_makes_few_rows_of_a_family_that_is_not_similar(spark, monkeypatch):
    """400 texts that share 70 % of their shingles, none of them similar to another: pairs of them are not verified, and all texts stay."""
    draw = random.Random(5)
    base = [f"w{i}" for i in range(400)]
    rows = [(i, " ".join(w if k not in own else f"{w}x{i}" for k, w in enumerate(base))) for i in range(400) for own in [set(draw.sample(range(400), 16))]]
    pairs, links = [], simhash.true_links
    monkeypatch.setattr(simhash, "true_links", lambda docs, some, text: pairs.append(some.count()) or links(docs, some, text))
    assert simhash.drop_near_copies(spark.createDataFrame(rows, "doc_id long, text string")).count() == 400
    assert sum(pairs) < 4_000


def test_stars_take_no_step(spark, monkeypatch):
    steps, lookup = [], simhash.lookup
    monkeypatch.setattr(simhash, "lookup", lambda *a, **k: steps.append(1) or lookup(*a, **k))
    edges = spark.createDataFrame([(5, 1), (6, 1), (1, 7), (9, 8)], "u long, v long")
    assert {r.node: r.root for r in simhash.components(edges).collect()} == {5: 1, 6: 1, 7: 1, 9: 8} and not steps


def test_shingle_sets_of_pairs_move_once(spark, monkeypatch):
    """They are in no checkpoint, and both ends of the pairs read one shuffle; links are the same where tables are too large to broadcast."""
    draw, stored = random.Random(8), []
    words = lambda n: [f"w{draw.randrange(10_000)}" for _ in range(n)]
    families = [(base, [*base[:-2], *words(2)], [*base[:40], *words(60)]) for base in (words(100) for _ in range(20))]
    docs = spark.createDataFrame([(i, " ".join(x)) for i, x in enumerate(x for f in families for x in f)] * 2, "doc_id long, text string")
    nodes = {r.doc_id: r.node for r in simhash.shingle_sets(docs, ["doc_id"], names=("node",)).collect()}
    pairs = spark.createDataFrame([(nodes[3 * f], nodes[3 * f + k]) for f in range(20) for k in (1, 2)], "u long, v long")
    want = {tuple(sorted((nodes[3 * f], nodes[3 * f + 1]))) for f in range(20)}
    durable = simhash.durable
    monkeypatch.setattr(simhash, "durable", lambda df: stored.append(df) or durable(df))
    assert {tuple(r) for r in simhash.true_links(docs, pairs, "text").collect()} == want
    assert not [c for df in stored for c in df.columns if "shingles" in c]
    plan = stored[-1]._jdf.queryExecution().executedPlan().toString()
    assert "ReusedExchange" in plan
    monkeypatch.setattr(simhash, "bounded", lambda table, rows=0: table.hint("shuffle_hash"))
    assert {tuple(r) for r in simhash.true_links(docs, pairs, "text").collect()} == want


def test_shingles_of_a_family_do_not_move_with_each_pair(spark, monkeypatch):
    """All pairs of a family are verified with each set sent once to each two blocks; links are those of all pairs, at any size of a block."""
    draw, sent, verified = random.Random(4), [], simhash.verified
    base = [f"w{i}" for i in range(300)]
    texts = [" ".join(w if draw.random() > 0.02 else f"{w}x{draw.randrange(10**6)}" for w in base) for _ in range(60)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    nodes = [r.node for r in simhash.shingle_sets(docs, ["doc_id"], names=("node",)).orderBy("doc_id").collect()]
    sets = [shingles(x) for x in texts]
    alike = {(u, v): len(sets[u] & sets[v]) / len(sets[u] | sets[v]) for u in range(60) for v in range(u)}
    want = {tuple(sorted((nodes[u], nodes[v]))) for (u, v), j in alike.items() if j >= 0.8}
    assert 100 < len(want) < len(alike) - 100
    monkeypatch.setattr(simhash, "verified", lambda pairs, sets: sent.append(sets.count()) or verified(pairs, sets))
    for most in (1_024, 20):
        monkeypatch.setattr(simhash, "BLOCK_SETS", most)
        for n in (0, 300):
            pairs = spark.createDataFrame([(nodes[u], nodes[v], n, n) for u, v in alike], "u long, v long, n_u long, n_v long")
            assert {tuple(r) for r in simhash.true_links(docs, pairs, "text").collect()} == want
    assert sent[:2] == [60, 60] and all(60 < n <= 60 * 6 for n in sent[2:])


def test_wide_sketches_tell_large_sets_apart(spark):
    """No similar pair is lost, of sets of equal or other size; large sets that are not similar do not pass."""
    draw, rows, own = np.random.default_rng(5), [], {}
    new = lambda n: draw.integers(0, 1 << 63, n).astype(np.uint64)
    for k in range(200):
        n, keep = int(draw.integers(200, 6_000)), draw.uniform(0.3, 1)
        x = np.unique(new(n))
        y = np.unique(np.concatenate([x[draw.random(len(x)) < keep], new(int(draw.integers(0, n // 8)))]))
        both = len(np.intersect1d(x, y))
        rows.append((2 * k, 2 * k + 1, len(x), len(y), both / (len(x) + len(y) - both)))
        own |= {2 * k: simhash.wide_sketch(x), 2 * k + 1: simhash.wide_sketch(y)}
    pairs = spark.createDataFrame([r[:4] for r in rows], "u long, v long, n_u long, n_v long")
    wide = spark.createDataFrame([(k, bytearray(x)) for k, x in own.items() if x] * 2, "node long, wide binary")
    got = sorted(tuple(r) for r in simhash.by_wide_sketches(pairs, wide).collect())
    good = {r[:4] for r in rows if r[4] >= 0.8}
    assert len(good) > 40 and good <= set(got) and len(got) == len(set(got))
    assert sum(r[4] < 0.7 for r in rows) > 80 and not [r for r in rows if r[4] < 0.7 and min(r[2:4]) > 256 and r[:4] in set(got)]


def test_large_texts_that_are_not_similar_are_not_verified(spark, monkeypatch):
    """40 texts of 2,500 words share over half of their shingles, which no order tells from others; few pairs of them have their shingles compared."""
    draw, pairs, links = random.Random(6), [], simhash.true_links
    base = [f"w{i}" for i in range(2_500)]
    rows = [(i, " ".join(w if draw.random() > 0.03 else f"{w}x{i}" for w in base)) for i in range(40)]
    monkeypatch.setattr(simhash, "COMMON", 0)
    monkeypatch.setattr(simhash, "true_links", lambda docs, some, text: pairs.append(some.count()) or links(docs, some, text))
    assert simhash.drop_near_copies(spark.createDataFrame(rows, "doc_id long, text string")).count() == 40
    assert sum(pairs) < 400
