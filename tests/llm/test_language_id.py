import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tapelens.llm import language_id, queries
from tapelens.llm.common import remainder


def brute_length(text, training):
    """The code length of a text under one language's context tree, from the definition."""
    seen = defaultdict(Counter)
    for t in training:
        raw = b"\n" * 4 + t.lower().encode()
        for i in range(4, len(raw)):
            for k in range(5):
                seen[raw[i - k : i]][raw[i]] += 1
    bits, raw = 0.0, b"\n" * 4 + text.lower().encode()
    for i in range(4, len(raw)):
        for k in range(4, -1, -1):
            here = seen.get(raw[i - k : i])
            if here:
                n, d = sum(here.values()), len(here)
                if raw[i] in here:
                    bits -= math.log2(here[raw[i]] / (n + d))
                    break
                bits -= math.log2(d / (n + d))
        else:
            bits += 8
    return bits


def tree_of(samples):
    languages, keys, numbers, counts = sorted(samples), [], [], []
    for i, name in enumerate(languages):
        k, n = np.unique(np.concatenate([np.zeros(0, np.uint64), *[x for x, _, _ in language_id.pieces(language_id.encoded(samples[name]))]]), return_counts=True)
        keys.append(k)
        numbers.append(np.full(len(k), i))
        counts.append(n)
    return language_id.Tree(languages, np.concatenate(keys), np.concatenate(numbers), np.concatenate(counts).astype(float))


@pytest.mark.parametrize(("piece", "held"), [(1 << 20, 1 << 23), (7, 6), (64, 1 << 23), (1 << 20, 40)])
def test_code_lengths_by_definition(monkeypatch, piece, held):
    draw = random.Random(1)
    make = lambda letters, n: "".join(draw.choice(letters) for _ in range(n))
    samples = {"x": [make("abc de", 200) for _ in range(3)], "y": [make("bcdé f", 200), "", "b"]}
    tree = tree_of(samples)
    monkeypatch.setattr(language_id, "PIECE", piece)
    monkeypatch.setattr(language_id, "HELD", held)
    texts = ["", "abc", make("abc", 40), make("abcdéfz ", 300), "ZZZ", "\n\n", make("qrst", 50)]
    got, mixed, alone = tree.lengths(texts)
    assert alone[0] == 0 and all(alone[1:] > 0) and all(mixed <= got.min(1) + 1e-3)
    for i, t in enumerate(texts):
        for j, name in enumerate(("x", "y")):
            assert abs(got[i, j] - brute_length(t, samples[name])) < 1e-3 * (1 + got[i, j])


def test_odd_rows(odd, none):
    tree = language_id.train(odd, F.lit(True))
    rows = language_id.predict(odd, tree).collect()
    assert len(rows) == odd.count()
    said = {(r.doc_id, r.lang_pred) for r in rows}
    assert {(3, "und"), (4, "und"), (5, "und"), (6, "und"), (7, "fr"), (1, "en")} <= said
    assert all(0 <= r.score <= 1 for r in rows)
    assert language_id.predict(none, tree).count() == 0
    assert language_id.train(none, F.lit(True)) is None
    assert {r.lang_pred for r in language_id.predict(odd, None).collect()} == {"und"}


def test_train_keeps_all_of_a_small_language(spark):
    """One language of 1,500 texts and one of five: code lengths through train() are those of the definition, and both are predicted."""
    draw = random.Random(3)
    word = lambda letters: "".join(draw.choice(letters) for _ in range(draw.randint(2, 9)))
    text = lambda letters: " ".join(word(letters) for _ in range(40))
    latin, cyrillic = "abcdefghijklmnopqrstuvwxyz", "абвгдежзиклмнопрстуфхцчшщыьэюя"
    rows = [(i, text(latin), "en") for i in range(1500)] + [(2000 + i, text(cyrillic), "ru") for i in range(5)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    tree = language_id.train(df, F.lit(True))
    assert tree.languages == ["en", "ru"]
    tries = [text(cyrillic), text(latin), "да нет", "mixed да text"]
    got, _, _ = tree.lengths(tries)
    for i, t in enumerate(tries):
        assert abs(got[i, 1] - brute_length(t, [r[1] for r in rows if r[2] == "ru"])) < 1e-3 * (1 + got[i, 1])
        assert abs(got[i, 0] - brute_length(t, [r[1] for r in rows if r[2] == "en"])) < 1e-3 * (1 + got[i, 0])
    said = {r.doc_id: r.lang_pred for r in language_id.predict(df, tree).collect()}
    assert all(said[i] == lang for i, _, lang in rows)
    bounded = language_id.train(df, F.lit(True), rows_per_language=100)
    assert bounded.languages == ["en", "ru"] and len(bounded.bits[0].own) < len(tree.bits[0].own)


def test_many_languages_stay_sparse():
    """200 languages of own scripts: entries follow what each has seen."""
    draw = random.Random(4)
    samples = {f"l{i:03}": ["".join(draw.choice([chr(0x4E00 + 10 * i + k) for k in range(10)]) for _ in range(60))] for i in range(200)}
    tree = tree_of(samples)
    assert sum(len(s.value) for s in [*tree.bits, *tree.escapes]) < 10 * 200 * 180
    got, _, _ = tree.lengths([samples["l007"][0], samples["l150"][0]])
    assert got.argmin(1).tolist() == [7, 150]


def test_texts_that_no_language_helps_to_predict_do_not_fit(spark):
    draw = random.Random(5)
    make = lambda: " ".join(draw.choice(["the", "cat", "sat", "on", "a", "mat", "and", "dog"]) for _ in range(60))
    noise = "".join(draw.choice("etaonshdcg mi") for _ in range(400))
    rows = [(i, make(), "en") for i in range(50)] + [(100, noise, None), (101, make(), None), (102, "123 !!", "en"), (103, None, "en"), (104, "der hund und die katze auf dem haus " * 8, "de")]
    rows += [(110, "the cat sat on a mat and the dog sat on the cat and a dog. der hund und die katze auf dem haus und der hund auf dem haus. " * 5, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    left = {r.doc_id for r in language_id.drop_unknown(df, language_id.train(df, F.lit(True))).collect()}
    assert left == {*range(50), 101, 104, 110}
    assert {r.doc_id for r in language_id.drop_unknown(df, language_id.train(df.withColumn("lang", F.lit(None).cast("string")), F.lit(True))).collect()} == {*range(50), 100, 101, 104, 110}


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    got = queries.op5_language_id(spark, sf).join(docs.select("doc_id", "lang", (remainder("doc_id", 3) == 1).alias("out")), "doc_id").toPandas()
    assert (got.held_out == got.out).all()
    assert (got.lang_pred == got.lang)[got.held_out].mean() > 0.98


def test_no_language_is_lost(spark):
    """A language of one text beyond its share of the sample is learned, whatever its id; repeats count once."""
    small = [(i, "der die und das ist nicht mit sich " * 3, "de") for i in range(20)]
    for i in range(6):
        table = spark.createDataFrame([*small, (1000 + i, "le chat est sur la table et il dort " * 2000, "fr")], "doc_id long, text string, lang string")
        tree = language_id.train(table, F.lit(True), train_bytes=4096)
        assert {r.lang_pred for r in language_id.predict(table.where("lang = 'fr'"), tree).collect()} == {"fr"}
    again = spark.createDataFrame([*small, *small, *small], "doc_id long, text string, lang string")
    one, many = (language_id.train(spark.createDataFrame(small, again.schema) if df is None else df, F.lit(True)) for df in (None, again))
    assert one.lengths(["der hund"])[0].tolist() == many.lengths(["der hund"])[0].tolist()
