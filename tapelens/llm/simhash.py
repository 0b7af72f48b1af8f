"""Near duplicates by SimHash and meet-in-the-middle ball hashing.

Two fingerprints at most four bits apart have a middle: a variant within two bits of both. Every
distinct fingerprint therefore emits all variants within two bits, and fingerprints that share a
variant are linked; as both are within two bits of it, every such pair is a true one, and it is
verified. Variants are shuffled by their leading bits: for a prefix of b bits a fingerprint travels
once for each of the 1 + b + b(b-1)/2 prefixes its variants have, with the number of flips that are
left, and the variants themselves are made where they meet. The prefix has LEAST_PREFIX bits at
least, so that a fingerprint travels as often in a small table as in one of 18 million, and grows
with the number n of fingerprints beyond, so that a place has about PER_PLACE of them. A place with
many more than the average is dealt over tasks by a parity code of the variant, which spreads the
variants of any cluster evenly; inside a task the same code bounds how many variants exist at once. Fingerprints of a place with
more than MOST are shuffled on their variants themselves, of which no one has more than 2,081
fingerprints. Each meeting returns a spanning forest, not pairs, and min-label contraction over the
forests gives components.

The pipeline's stage has a rule of its own: texts whose sets of five-word shingles have a Jaccard
similarity of SIMILAR or more are near copies. Such pairs differ in about ten of 64 bits, too many
for a ball of 64. Links of fingerprints therefore only come first. All other pairs that can be similar
share one of either text's rarest shingles, a fifth of them, and meet there; pairs that links have
joined already are left out, and so are pairs that differ in more bits of SKETCH than similar ones can.
Each pair left is verified by its shingles, so that no similar pair is lost. Pairs grow with the square of a
family of texts, their shingles must not: pairs must pass sketches as wide as their sets first, texts that
pairs connect are put into blocks of bounded size, and a set of shingles travels once to each two blocks
that it has a pair in, not once a pair.

Defined results: a text without words (or null) has fingerprint zero and links like any other.
Repeated rows each get their row. A null id never names a component unless all its members are null.
An empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import cache, reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tapelens.llm.common import blocks, bounded, by_id, durable, free, lookup, reclaim, schema_of, slim, utf8

BITS, RADIUS = 64, 4
HALF = RADIUS // 2
#: Least bits of a prefix; fingerprints that travel to a place; those beyond which a place is dealt out, if they are twice the average too, and beyond which variants are shuffled; variants held at once in a task.
LEAST_PREFIX, PER_PLACE, DEALT, MOST, HELD = 10, 1_000_000, 65_536, 16_000_000, 1_000_000
#: The stage: words to a shingle, least similarity, texts of which common shingles are counted, and most of these shingles.
STAGE_WORDS, SIMILAR, SAMPLE, COMMON = 5, 0.8, 20_000, 1 << 17
#: Bits of a shingle set's sketch; bits a shingle that a wide sketch has at least; orders in which texts of a shingle are linked to the next one.
SKETCH, WIDE, ORDERS = 512, 2, 4
#: Hashes of texts that are broadcast, at most, each with a place: two longs.
WANTED = 2_000_000
#: Sets of a block whose pairs are verified at once, and bytes of their shingles, at most (a larger set is a block of its own).
BLOCK_SETS, BLOCK_BYTES = 1_024, 4 << 20


def shingle_hashes(text: bytes, words_per_shingle: int, seed: int) -> list[int]:
    """XXH64 of each shingle of the lower-cased words, repeats included."""
    words = text.lower().split()
    if not words:
        return []
    if len(words) <= words_per_shingle:
        return [xxhash.xxh64_intdigest(b" ".join(words), seed)]
    line = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = [0, *ends[:-words_per_shingle].tolist()]
    digest = xxhash.xxh64_intdigest
    return [digest(line[i : j - 1], seed) for i, j in zip(starts, ends[words_per_shingle - 1 :].tolist(), strict=True)]


def simhash(hashes: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A fingerprint for each run hashes[ends[i-1]:ends[i]]; a bit is 1 if set in over half of them."""
    out = np.zeros(len(ends), np.uint64)
    counts = np.diff(ends, prepend=0)
    some = np.flatnonzero(counts)
    if len(some):
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones = np.add.reduceat(bits, (ends - counts)[some], axis=0, dtype=np.int32)
        major = (2 * ones > counts[some, None]).astype(np.uint8)
        out[some] = np.packbits(major, axis=1, bitorder="little").view(np.uint64).ravel()
    return out


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 4, seed: int = 42) -> DataFrame:
    """(id, fp): the SimHash of each document as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, text_col, 1 << 20):
            parts = [np.array(shingle_hashes(t, words, seed), np.uint64) for t in utf8(block, text_col)]
            ends = np.cumsum([len(p) for p in parts])
            fp = simhash(np.concatenate(parts), ends)
            yield pa.RecordBatch.from_arrays([block.column(id_col), pa.array(fp.view(np.int64))], names=[id_col, "fp"])

    return slim(docs, id_col, text_col).mapInArrow(run, f"{schema_of(docs, id_col)}, fp long")


def _flips(bits: range, most: int) -> list[tuple[int, int]]:
    """(mask, number of bits) of all ways to flip at most `most` (0 to 2) of the bits."""
    out = [(0, 0)]
    if most >= 1:
        out += [(1 << i, 1) for i in bits]
    if most >= 2:
        out += [(1 << i | 1 << j, 2) for i in bits for j in bits if i < j]
    return out


@cache
def _columns() -> np.ndarray:
    """A parity code: each bit's syndrome, of 16 bits. Fixed by its seed, so that every task has the same."""
    return np.random.default_rng(64).integers(1, 1 << 16, BITS, dtype=np.uint64)


def _syndrome(values: np.ndarray) -> np.ndarray:
    out = np.zeros(len(values), np.uint64)
    for i, column in enumerate(_columns()):
        out ^= (values >> np.uint64(i) & np.uint64(1)) * column
    return out


@cache
def _patterns(prefix: int, most: int, parity: int) -> tuple[np.ndarray, np.ndarray]:
    """Masks that flip at most `most` bits below the prefix, ordered by the low `parity` bits of their syndrome; where each syndrome starts."""
    masks = np.array([m for m, _ in _flips(range(BITS - prefix), most)], np.uint64)
    low = (_syndrome(masks) & np.uint64((1 << parity) - 1)).astype(np.int64)
    order = np.argsort(low, kind="stable")
    return masks[order], np.searchsorted(low[order], np.arange((1 << parity) + 1))


def _roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest number each of n nodes is connected with by the edges a-b."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[a], root[b])
        np.minimum.at(root, root[a], low)
        np.minimum.at(root, root[b], low)
        while True:
            up = root[root]
            if (up == root).all():
                break
            root = up
        if (root[a] == root[b]).all():
            return root


def meet(fps: np.ndarray, left: np.ndarray, home: np.ndarray, prefix: int, parity: int, part: int) -> tuple[np.ndarray, np.ndarray]:
    """Links among fingerprints by the variants they have in one place.

    home: each fingerprint with the flips made that put it under this prefix; left: flips it may yet
    make. Only variants with syndrome `part` in the low `parity` bits are looked at. Returns forest
    edges (fingerprint, root).
    """
    inner = max(parity, math.ceil(math.log2(max(1, len(fps) * len(_flips(range(BITS - prefix), HALF)) / HELD))))
    inner = min(inner, 16)
    own = (_syndrome(home) & np.uint64((1 << inner) - 1)).astype(np.int64)
    nodes, at = np.unique(fps, return_inverse=True)
    found_a, found_b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for high in range(1 << (inner - parity)):
        wanted = high << parity | part
        values, owners = [], []
        for budget in range(HALF + 1):
            masks, starts = _patterns(prefix, budget, inner)
            rows = np.flatnonzero(left == budget)
            syndromes = own[rows] ^ wanted
            counts = starts[syndromes + 1] - starts[syndromes]
            ends = np.cumsum(counts)
            if len(rows) and ends[-1]:
                step = np.arange(ends[-1]) - np.repeat(ends - counts, counts) + np.repeat(starts[syndromes], counts)
                values.append(np.repeat(home[rows], counts) ^ masks[step])
                owners.append(np.repeat(at[rows], counts))
        if not values:
            continue
        value, owner = np.concatenate(values), np.concatenate(owners)
        order = np.argsort(value)
        value, owner = value[order], owner[order]
        same = np.flatnonzero(value[1:] == value[:-1])
        pairs = np.unique(np.minimum(owner[same], owner[same + 1]) * len(nodes) + np.maximum(owner[same], owner[same + 1]))
        a, b = pairs // len(nodes), pairs % len(nodes)
        true = (a != b) & (np.bitwise_count(nodes[a] ^ nodes[b]) <= RADIUS)
        root = _roots(len(nodes), np.concatenate([*found_a, a[true]]), np.concatenate([*found_b, b[true]]))
        linked = np.flatnonzero(root != np.arange(len(nodes)))
        found_a, found_b = [linked], [root[linked]]
    return nodes[found_a[0]], nodes[found_b[0]]


def prefix_bits(n: int, per_place: int, most: int, least: int = 4) -> int:
    """The shortest prefix with which n fingerprints, each sent to all prefixes of its variants, come to per_place a place on average."""
    return next((b for b in range(least, most) if n * len(_flips(range(b), HALF)) <= per_place << b), most)


def _signed(value: int) -> int:
    return value - (1 << BITS) if value >= 1 << (BITS - 1) else value


def _places(sent: DataFrame, columns: list[str], per_place: int) -> DataFrame:
    """The columns and a `place` for each row of `sent`, and for each part of a hot prefix.

    Hot prefixes are counted, not assumed: their table is broadcast if it is small and else shuffled.
    """
    hot = sent.groupBy("prefix").count().where(F.col("count") > 2 * per_place)
    hot = bounded(durable(hot.select("prefix", F.least(F.lit(16), F.ceil(F.log2(F.col("count") / per_place))).cast("int").alias("parity"))))
    dealt = sent.join(hot, "prefix", "left").withColumn("parity", F.coalesce("parity", F.lit(0)))
    return dealt.select(*columns, F.explode(F.expr("transform(sequence(0, shiftleft(1, parity) - 1), part -> shiftleft(prefix, 24) + shiftleft(parity, 18) + part)")).alias("place"))


def _place(code: int) -> tuple[int, int, int]:
    """(prefix, parity, part) of a place."""
    return code >> 24, code >> 18 & 0x3F, code & 0x3FFFF


def _by_variant(distinct: DataFrame) -> DataFrame:
    """(u, v): links of fingerprints through each of their variants, shuffled on the variants; no variant has over 2,081 fingerprints."""
    masks = np.array([m for m, _ in _flips(range(BITS), HALF)], np.uint64)

    def variants(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = batch.column("fp").to_numpy()
            for i in range(0, len(fps), 256):
                some = fps[i : i + 256].view(np.uint64)
                made = (some[:, None] ^ masks).ravel()
                yield pa.RecordBatch.from_arrays([pa.array(np.repeat(some, len(masks)).view(np.int64)), pa.array(made.view(np.int64))], names=["fp", "variant"])

    met = distinct.mapInArrow(variants, "fp long, variant long")
    first = met.groupBy("variant").agg(F.min("fp").alias("v"), F.collect_set("fp").alias("all")).where(F.size("all") > 1)
    pairs = first.select(F.explode("all").alias("u"), "v").where("u <> v")
    return pairs.where(F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= RADIUS)


def links(distinct: DataFrame, n: int) -> DataFrame:
    """(u, v): a spanning forest of the components, from every place where variants meet.

    distinct: the distinct fingerprints, n of them; durable.
    """
    prefix = prefix_bits(n, PER_PLACE, 32, LEAST_PREFIX)
    masks = [F.lit(_signed(m << (BITS - prefix))).cast("long") for m, _ in _flips(range(prefix), HALF)]
    sent = distinct.select("fp", F.explode(F.array(*masks)).alias("mask"))
    sent = sent.select("fp", F.shiftrightunsigned(F.col("fp").bitwiseXOR(F.col("mask")), BITS - prefix).alias("prefix"))

    def run(table: pa.Table) -> pa.Table:
        (under, parity, part), fps = _place(table.column("place")[0].as_py()), table.column("fp").to_numpy().view(np.uint64)
        low = np.uint64(BITS - prefix)
        left = HALF - np.bitwise_count(fps >> low ^ np.uint64(under)).astype(np.int64)
        home = np.uint64(under) << low | fps & np.uint64((1 << (BITS - prefix)) - 1)
        u, v = meet(fps, left, home, prefix, parity, part)
        return pa.table({"u": u.view(np.int64), "v": v.view(np.int64)})

    per_place = max(DEALT // 2, n * len(masks) >> prefix)
    if n <= MOST:
        return _places(sent, ["fp"], per_place).groupBy("place").applyInArrow(run, "u long, v long").distinct()
    vast = bounded(durable(sent.groupBy("prefix").count().where(F.col("count") > MOST).select("prefix")))
    crowd = durable(sent.join(vast, "prefix", "left_semi").select("fp").distinct())
    met = _places(sent.join(vast, "prefix", "left_anti"), ["fp"], per_place).groupBy("place").applyInArrow(run, "u long, v long")
    return met.unionByName(_by_variant(crowd)).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node that each node of the edges reaches.

    Alternates the large-star and small-star steps until the edges stay as they are. A step needs the least neighbour
    of each node only. It is looked up with the node's degree, so that the centre of a large star is no task's alone.
    It ends where all edges are stars, so that edges that come as stars take no step.
    """
    edges = durable(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    least = lambda some: some.groupBy("u").agg(F.min("v").alias("low"), F.count("*").alias("degree"))
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        ends = edges.select("u", F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(edges.select(F.col("v").alias("u"), F.lit(0).alias("up"), F.lit(1).alias("down")))
        ends = ends.groupBy("u").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
        n, odd = ends.agg(F.coalesce(F.sum("up"), F.lit(0)), F.count_if((F.col("up") > 1) | (F.col("up") > 0) & (F.col("down") > 0))).first()
        if not odd:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        large = lookup(both, least(both), ["u"], "degree", 2 * n).where("v > u").select(F.col("v").alias("u"), F.least("u", "low").alias("v"))
        large = durable(large.distinct())
        small = lookup(large, least(large), ["u"], "degree", n)
        small = small.select(F.when(F.col("v") == F.col("low"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("low").alias("v"))
        edges = durable(small.where("u <> v").distinct())


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 4, seed: int = 42) -> DataFrame:
    """(id, fp, component_id): the smallest id that each document reaches by links of at most four bits."""
    rows = durable(fingerprints(docs, id_col, text_col, words, seed))
    distinct = durable(rows.groupBy("fp").agg(F.min(id_col).alias("least"), F.count("*").alias("n_rows")))
    n = distinct.count()
    roots = components(links(distinct.select("fp"), n))
    named = distinct.join(roots, distinct["fp"] == roots["node"], "left").select("fp", "least", "n_rows", F.coalesce("root", "fp").alias("root"))
    named = durable(named)
    groups = named.groupBy("root").agg(F.min("least").alias("component_id"), F.sum("n_rows").alias("members"), F.count("*").alias("n_fps"))
    of = lookup(named, groups, ["root"], "n_fps", n).where("members > 1")
    of = durable(of.select("fp", "component_id", F.lit(True).alias("shared"), "n_rows"))
    # A document alone is its own component and is not joined.
    out = lookup(rows, of, ["fp"], "n_rows", rows.count(), "left")
    return out.select(id_col, "fp", F.when(F.col("shared"), F.col("component_id")).otherwise(F.col(id_col)).alias("component_id"))


def sketch(own: np.ndarray, bits: int = SKETCH) -> np.ndarray:
    """So many bits of a set, as longs: bit i tells whether an odd number of its hashes fall on i.

    Sketches of two sets differ in no more bits than there are hashes in one set only.
    """
    odd = np.bincount((own % np.uint64(bits)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.int64)


def wide_sketch(own: np.ndarray) -> bytes | None:
    """A sketch of WIDE bits a hash at least, a power of two, so that it tells large sets apart as well; None if that is SKETCH or less."""
    bits = 1 << math.ceil(math.log2(max(1, WIDE * len(own))))
    return sketch(own, bits).tobytes() if bits > SKETCH else None


def differing(x: np.ndarray, y: np.ndarray) -> int:
    """In how many bits two sketches differ; the longer one is folded to the other's length first."""
    few = min(len(x), len(y))
    x, y = (np.bitwise_xor.reduce(z.reshape(-1, few), axis=0) for z in (x, y))
    return int(np.bitwise_count(x ^ y).sum())


def shingle_sets(docs: DataFrame, carry: list[str], text_col: str = "text", names: tuple[str, ...] = ("node", "a", "shingles"), sketched: bool = False, once: bool = False) -> DataFrame:
    """The columns to carry, the hash of each text's shingle set, its fingerprint, and the set's sorted hashes.

    names: which of the three to make, by place, and what they are called. sketched: add the set's sketch, `bits`,
    its size, `n`, and its wide sketch, `wide`. once: a task gives a set only once.
    """
    kinds = ["long", "long", "binary"][: len(names)]
    made_of = len(names)
    if sketched:
        names, kinds = (*names, "bits", "n", "wide"), [*kinds, "array<long>", "long", "binary"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        given: set[int] = set()
        for block in blocks(batches, text_col, 1 << 20):
            sets = [np.unique(np.array(shingle_hashes(t, STAGE_WORDS, 42), np.uint64)) for t in utf8(block, text_col)]
            nodes = [xxhash.xxh64_intdigest(x.tobytes()) for x in sets]
            if once:
                new = [i for i, x in enumerate(nodes) if not (x in given or given.add(x))]
                block, sets, nodes = block.take(pa.array(new, pa.int64())), [sets[i] for i in new], [nodes[i] for i in new]
                if not new:
                    continue
            made = [pa.array(nodes, pa.uint64()).view(pa.int64())]
            if made_of > 1:
                made.append(pa.array(simhash(np.concatenate(sets), np.cumsum([len(x) for x in sets])).view(np.int64)))
            if made_of > 2:
                made.append(pa.array([x.tobytes() for x in sets], pa.binary()))
            if sketched:
                made += [pa.array([sketch(x) for x in sets], pa.list_(pa.int64())), pa.array([len(x) for x in sets], pa.int64()), pa.array([wide_sketch(x) for x in sets], pa.binary())]
            yield pa.RecordBatch.from_arrays([*(block.column(c) for c in carry), *made], names=[*carry, *names])

    kept = [schema_of(docs, c) for c in carry]
    return slim(docs, *dict.fromkeys([*carry, text_col])).mapInArrow(run, ", ".join([*kept, *(f"`{n}` {k}" for n, k in zip(names, kinds, strict=True))]))


def common_shingles(docs: DataFrame, text_col: str = "text") -> tuple[np.ndarray, np.ndarray]:
    """(hashes, sorted; how frequent each is) of shingles that many texts share, from about SAMPLE texts by their hash.

    They only order shingles, so that a text's rarest ones are looked up: any order gives the same pairs.
    """
    n = docs.count()
    some = docs.where(F.pmod(F.xxhash64(text_col), F.lit(1_000_000)) < math.ceil(1_000_000 * min(1, SAMPLE / max(1, n))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, text_col, 1 << 20):
            sets = [np.unique(np.array(shingle_hashes(t, STAGE_WORDS, 42), np.uint64)) for t in utf8(block, text_col)]
            hashes, counts = np.unique(np.concatenate(sets), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(hashes.view(np.int64)), pa.array(counts)], names=["shingle", "n"])

    counts = slim(some, text_col).mapInArrow(run, "shingle long, n long").groupBy("shingle").agg(F.sum("n").alias("n")).where("n > 1")
    found = counts.orderBy(F.desc("n"), "shingle").limit(COMMON).toArrow()  # COMMON rows of two numbers at most
    hashes, n_of = found.column("shingle").to_numpy().view(np.uint64), found.column("n").to_numpy()
    order = np.argsort(hashes)
    return hashes[order], n_of[order]


def prefixes(docs: DataFrame, similar: float = SIMILAR, text_col: str = "text") -> DataFrame:
    """(shingle, node, n, place): of each set of n shingles, ordered from rare to common, the first, of which similar sets share one.

    Sets that are similar share at least similar * n shingles of either, so that they share one of the first n - similar * n + 1.
    """
    common, n_of = common_shingles(docs, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, text_col, 1 << 20):
            out: list[list[np.ndarray]] = [[], [], [], []]
            for text in utf8(block, text_col):
                own = np.unique(np.array(shingle_hashes(text, STAGE_WORDS, 42), np.uint64))
                if not len(own):
                    continue
                node = np.uint64(xxhash.xxh64_intdigest(own.tobytes()))
                rank = np.zeros(len(own), np.int64)
                if len(common):
                    at = np.minimum(np.searchsorted(common, own), len(common) - 1)
                    rank = np.where(common[at] == own, n_of[at], 0)
                first = np.lexsort((own, rank))[: len(own) - math.ceil(similar * len(own) - 1e-9) + 1]
                for x, made in zip(out, (own[first].view(np.int64), np.full(len(first), node).view(np.int64), np.full(len(first), len(own)), np.arange(len(first))), strict=True):
                    x.append(made)
            if out[0]:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x), pa.int64()) for x in out], names=["shingle", "node", "n", "place"])

    return slim(docs, text_col).mapInArrow(run, "shingle long, node long, n long, place long")


def tiles(pairs: DataFrame, each: float) -> tuple[DataFrame, DataFrame]:
    """The pairs (u, v, n_u, n_v) with a `tile`, and the (node, tile) that the tiles want, durable. each: bytes of a shingle.

    Nodes lie in blocks of BLOCK_SETS of them and BLOCK_BYTES on average, at most, and pairs of two blocks make a tile. Each
    node points to the least of its neighbours, if it is less, and to what that one points to; nodes that point to one are
    a group. Most pairs of a family of texts are in one group. Any grouping gives the same links: it only decides how
    often a node is wanted. A large group is dealt over blocks, small ones share a block.
    """
    ends = pairs.select("u", "v", F.col("n_u").alias("n")).unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v"), F.col("n_v").alias("n")))
    nodes = durable(ends.groupBy(F.col("u").alias("node")).agg(F.least("u", F.min("v")).alias("up"), F.max("n").alias("n")))
    for _ in range(2):
        above = bounded(nodes.select(F.col("node").alias("up"), F.col("up").alias("top")))
        nodes = durable(nodes.join(above, "up").select("node", F.col("top").alias("up"), "n"))
    blocks_of = lambda sets, hashes: F.greatest(F.ceil(sets / BLOCK_SETS), F.ceil(hashes * each / BLOCK_BYTES), F.lit(1))
    shared = nodes.agg(blocks_of(F.count("*"), F.coalesce(F.sum("n"), F.lit(0)))).first()[0]
    groups = bounded(nodes.groupBy("up").agg(blocks_of(F.count("*"), F.sum("n")).alias("dealt")))
    alone = F.xxhash64("up", F.pmod(F.xxhash64("node"), "dealt"))
    places = nodes.join(groups, "up").select("node", F.when(F.col("dealt") > 1, alone).otherwise(F.pmod(F.xxhash64("up"), F.lit(shared))).alias("place"))
    places = bounded(durable(places))
    for side in "uv":
        pairs = pairs.join(places.select(F.col("node").alias(side), F.col("place").alias(f"at_{side}")), side)
    pairs = pairs.select(F.xxhash64(F.least("at_u", "at_v"), F.greatest("at_u", "at_v")).alias("tile"), "u", "v", "n_u", "n_v")
    return pairs, durable(pairs.select(F.explode(F.array("u", "v")).alias("node"), "tile").distinct())


def by_wide_sketches(pairs: DataFrame, wide: DataFrame) -> DataFrame:
    """The pairs (u, v, n_u, n_v) that can be similar by their wide sketches. wide: (node, wide), of sets that have one."""

    def run(sketches: pa.Table, pairs: pa.Table) -> pa.Table:
        own = {k: np.frombuffer(x.as_buffer(), np.uint64) for k, x in zip(sketches.column("node").to_pylist(), sketches.column("wide"), strict=True)}
        good = []
        for u, v, n_u, n_v in zip(*(pairs.column(c).to_pylist() for c in ("u", "v", "n_u", "n_v")), strict=True):
            x, y = own.get(u), own.get(v)
            good.append(x is None or y is None or (1 + SIMILAR) * differing(x, y) <= (1 - SIMILAR) * (n_u + n_v) + 1e-6)
        return pairs.select(["u", "v", "n_u", "n_v"]).filter(pa.array(good, pa.bool_()))

    tiled, wanted = tiles(durable(pairs.distinct()), WIDE / 4)
    sketches = wide.join(bounded(wanted, WANTED), "node").dropDuplicates(["tile", "node"]).select("tile", "node", "wide")
    return sketches.groupBy("tile").cogroup(tiled.groupBy("tile")).applyInArrow(run, "u long, v long, n_u long, n_v long")


def verified(pairs: DataFrame, sets: DataFrame, similar: float = SIMILAR) -> DataFrame:
    """The pairs (tile, u, v) whose shingle sets have at least this Jaccard similarity, as (u, v). sets: (tile, node, shingles)."""

    def run(sets: pa.Table, pairs: pa.Table) -> pa.Table:
        own = {k: np.frombuffer(x.as_buffer(), np.uint64) for k, x in zip(sets.column("node").to_pylist(), sets.column("shingles"), strict=True)}
        good = []
        for u, v in zip(pairs.column("u").to_pylist(), pairs.column("v").to_pylist(), strict=True):
            x, y = own[u], own[v]
            few, many = sorted((len(x), len(y)))
            both = len(np.intersect1d(x, y, assume_unique=True)) if few >= similar * many - 1e-9 else 0
            good.append(both >= similar * (few + many - both) - 1e-9)
        return pairs.select(["u", "v"]).filter(pa.array(good, pa.bool_()))

    return sets.groupBy("tile").cogroup(pairs.groupBy("tile")).applyInArrow(run, "u long, v long")


def true_links(docs: DataFrame, pairs: DataFrame, text_col: str) -> DataFrame:
    """The pairs (u, v) that their shingles verify; durable. Pairs may say how many shingles their sets have (n_u, n_v).

    Shingles are made anew for texts of the pairs, so that those of all texts are never stored or shuffled where
    the hashes of these texts are few enough to be broadcast. One shuffle serves both ends of the pairs: pairs of two blocks
    make a tile, and the sets that they need are sent there, so that a set does not travel again for each pair.
    """
    n_u, n_v = (F.col(c) if c in pairs.columns else F.lit(0).cast("long") for c in ("n_u", "n_v"))
    turn = F.col("u") > F.col("v")
    pairs = pairs.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v"), F.when(turn, n_v).otherwise(n_u).alias("n_u"), F.when(turn, n_u).otherwise(n_v).alias("n_v"))
    tiled, wanted = tiles(durable(pairs.where("u < v").distinct()), 8)
    sets = shingle_sets(docs, [], text_col, once=True).select("node", "shingles").join(bounded(wanted, WANTED), "node")
    return durable(verified(tiled.select("tile", "u", "v"), sets.select("tile", "node", "shingles")))


def nearest(distinct: DataFrame) -> DataFrame:
    """(u, v, n_u, n_v): pairs of nodes whose fingerprints are linked, or equal. distinct: (node, a, n), one row a node."""
    firsts = durable(distinct.groupBy("a").agg(F.min(F.struct("node", "n")).alias("first")).select("a", F.col("first.node").alias("first"), F.col("first.n").alias("n_first")))
    met = links(firsts.select(F.col("a").alias("fp")), firsts.count())
    u, v = (firsts.select(F.col("a").alias(x), F.col("first").alias(f"{x}_first"), F.col("n_first").alias(f"n_{x}")) for x in ("u", "v"))
    apart = met.join(u, "u").join(v, "v").select(F.col("u_first").alias("u"), F.col("v_first").alias("v"), "n_u", "n_v")
    equal = distinct.join(firsts, "a").where("node <> first")
    return apart.unionByName(equal.select(F.col("node").alias("u"), F.col("first").alias("v"), F.col("n").alias("n_u"), F.col("n_first").alias("n_v")))


def first_may_be_shared() -> Column:
    """Whether a shingle that sets x and y share, at these places, can be the first that they share, if they are similar.

    Similar sets share SIMILAR / (1 + SIMILAR) of n_x + n_y hashes at least: none before the first, and no more than the
    rest of either set from there on.
    """
    rest = F.least(F.col("n_x") - F.col("place_x"), F.col("n_y") - F.col("place_y"))
    return (1 + SIMILAR) * rest >= SIMILAR * (F.col("n_x") + F.col("n_y")) - 1e-6


def sketches_are_near() -> Column:
    """Whether sets x and y can be similar by their sketches, which differ in no more bits than there are hashes in one set only."""
    differ = reduce(Column.__add__, [F.bit_count(F.col("bits_x")[i].bitwiseXOR(F.col("bits_y")[i])) for i in range(SKETCH // 64)])
    return (1 + SIMILAR) * differ <= (1 - SIMILAR) * (F.col("n_x") + F.col("n_y")) + 1e-6


def similar_roots(docs: DataFrame, distinct: DataFrame, wide: DataFrame, text_col: str = "text") -> DataFrame:
    """(node, root) of nodes that verified pairs link: the components of all pairs that are similar.

    distinct: (node, a, bits, n), one row a node; wide: (node, wide), of sets that have a wide sketch. First the links of fingerprints, and of each text with the next one that
    shares a rare shingle, in a few orders, which make up most of a component. Then every other pair that can be similar and
    is not in one component already; a pair is met at the first shingle it shares, at least.
    """
    of_shingle = Window.partitionBy("shingle")
    bits = distinct.select("node", "bits")
    named = lambda df, side: df.select(*[F.col(c).alias(c if c == "shingle" else f"{c}_{side}") for c in df.columns])
    rare = prefixes(docs, SIMILAR, text_col).repartition("shingle").distinct().withColumn("texts", F.count("*").over(of_shingle))
    shared = durable(rare.where("texts > 1").drop("texts"))
    del rare
    reclaim(docs.sparkSession)
    mixed = F.xxhash64("node", F.pmod("shingle", F.lit(ORDERS)))
    before = lambda c: F.lag(c).over(of_shingle.orderBy(mixed, "node"))
    chains = shared.select(*[F.col(c).alias(f"{c}_x") for c in ("node", "n", "place")], *[before(c).alias(f"{c}_y") for c in ("node", "n", "place")])
    chains = chains.where(F.col("node_y").isNotNull() & first_may_be_shared()).select("node_x", "node_y", "n_x", "n_y").distinct()
    chains = chains.join(named(bits, "x"), "node_x").join(named(bits, "y"), "node_y").where(sketches_are_near())
    pair = [F.col(f"{c}_{x}").alias(name) for c, x, name in (("node", "x", "u"), ("node", "y", "v"), ("n", "x", "n_u"), ("n", "y", "n_v"))]
    first = true_links(docs, nearest(distinct).unionByName(chains.select(*pair)), text_col)
    del chains
    reclaim(docs.sparkSession)
    roots = durable(components(first))
    split = shared.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    split = split.withColumns({"least": F.min("root").over(of_shingle), "most": F.max("root").over(of_shingle)}).where("least < most").drop("least", "most")
    split = durable(split.join(bits, "node"))
    reclaim(docs.sparkSession)
    x, y = named(split, "x"), named(split, "y")
    apart = (F.col("node_x") < F.col("node_y")) & (F.col("root_x") != F.col("root_y"))
    others = x.join(y, (x["shingle"] == y["shingle"]) & apart & first_may_be_shared() & sketches_are_near()).select(*pair)
    more = true_links(docs, by_wide_sketches(others, wide), text_col)
    reclaim(docs.sparkSession)
    if more.isEmpty():
        return roots
    # The new links join components, each by its root; roots of roots are then those of all their nodes.
    for side in "uv":
        of = roots.select(F.col("node").alias(side), F.col("root").alias("of"))
        more = more.join(of, side, "left").withColumn(side, F.coalesce("of", side)).drop("of")
    above = durable(components(more))
    joined = roots.join(above.select(F.col("node").alias("root"), F.col("root").alias("top")), "root", "left").select("node", F.coalesce("top", "root").alias("root"))
    return joined.unionByName(above)


def keepers(distinct: DataFrame, roots: DataFrame) -> DataFrame:
    """(id, node): the row that stays of each component. Smallest id first, null ids last, then the smallest node.

    distinct: (node, no_id, id), one row a node with its first id; roots: (node, root) of linked nodes but the roots.
    """
    linked = roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())
    named = durable(distinct.join(linked, "node"))
    best = named.groupBy("root").agg(F.min(F.struct("no_id", "id", "node")).alias("best"))
    lost = named.select("node").join(best.select(F.col("best.node").alias("node")), "node", "left_anti")
    return distinct.join(lost, "node", "left_anti").select("id", "node")


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One document of each component, that with the smallest id, with all columns; of rows that repeat it, one.

    Judged by (id, shingle set): rows that share an id, or have none, each go by their own component.
    """
    rows = durable(shingle_sets(docs, [id_col], text_col, ("node", "a"), sketched=True)).withColumnRenamed(id_col, "id")
    first = F.min(F.struct(F.col("id").isNull().alias("no_id"), "id")).alias("first")
    distinct = durable(rows.groupBy("node", "a").agg(first, F.first("bits").alias("bits"), F.first("n").alias("n")).select("node", "a", "bits", "n", "first.*"))
    roots = similar_roots(docs, distinct.select("node", "a", "bits", "n"), rows.select("node", "wide").where("wide IS NOT NULL"), text_col)
    kept = durable(keepers(distinct.drop("bits", "n"), roots))
    counted = rows.select("id", F.lit(0).alias("kept")).unionByName(kept.select("id", F.lit(1).alias("kept")))
    per_id = counted.groupBy("id").agg(F.sum(1 - F.col("kept")).alias("n_rows"), F.sum("kept").alias("n_kept"))
    out = durable(per_id.where("n_kept = 0 or n_rows > 1"))
    plain = by_id(docs, id_col, out.select("id"), "left_anti")
    # Rows of repeated and null ids take a way of their own.
    place, node, kept_id, kept_node = (free(docs, x) for x in ("own_place", "own_node", "id_kept", "node_kept"))
    again = shingle_sets(by_id(docs, id_col, durable(out.where("n_kept > 0").select("id")), "left_semi"), docs.columns, text_col, (node,))
    again = again.join(kept.toDF(kept_id, kept_node), again[id_col].eqNullSafe(F.col(kept_id)) & (F.col(node) == F.col(kept_node)), "left_semi")
    again = again.withColumn(place, F.row_number().over(Window.partitionBy(id_col, node).orderBy(F.col(text_col).asc_nulls_last())))
    return plain.unionByName(again.where(F.col(place) == 1).drop(place, node))
