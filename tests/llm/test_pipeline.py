import posixpath
from collections import Counter

from pyspark.sql import functions as F
from tests.llm.test_simhash import shingles

import corpus_pipeline
from tapelens.llm import exact_dedup, language_id

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def bare(text):
    return "".join(c for c in text or "" if c not in " \t\n\x0b\x0c\r")


def test_stages(spark, tmp_path):
    """Each stage is held against what it was given."""
    sf = "/root/testdata/sf0.01"
    docs, seen = spark.read.parquet(f"{sf}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs.collect()
        stage(spark, docs, sf).write.parquet(posixpath.join(str(tmp_path), name))
        docs = spark.read.parquet(posixpath.join(str(tmp_path), name))
        seen[name] = before, docs.collect()
        if name != "sentencepiece":
            assert docs.columns == COLUMNS
    given, left = seen["language_id"]
    table = spark.createDataFrame(given, "doc_id long, text string, lang string, source string, n_chars long")
    tree = language_id.train(table, F.lit(True))
    _, mixed, alone = tree.lengths([r.text or "" for r in given])
    fits = [language_id.has_letter(r.text or "") and b <= a + language_id.MARGIN for r, b, a in zip(given, mixed, alone, strict=True)]
    assert sorted(left) == sorted(r for r, f in zip(given, fits, strict=True) if f)
    given, left = seen["exact_dedup"]
    best = {}
    for r in given:
        best.setdefault(bare(r.text), []).append((-len(r.text or ""), r.doc_id))
    assert sorted(r.doc_id for r in left) == sorted(min(g)[1] for g in best.values())
    given, left = seen["simhash_near_dedup"]
    sets = {r.doc_id: shingles(r.text) for r in given}
    stays = {r.doc_id for r in left}
    holders = {}
    for i, found in sets.items():
        for x in found:
            holders.setdefault(x, []).append(i)
    alike = {(a, b) for ids in holders.values() if len(ids) < 200 for a in ids for b in ids if a < b and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])}
    linked = {i for pair in alike for i in pair}
    assert stays <= set(sets) and all(i in stays for i in sets if i not in linked and len(sets[i]) > 0)
    assert sum(a in stays and b in stays for a, b in alike) <= 0.1 * len(alike)
    given, left = seen["mixing"]
    times = Counter(r.doc_id for r in left)
    assert set(left) <= set(given) and max(times.values()) <= 3 and abs(sum(len(r.text.split()) for r in left) - sum(len(r.text.split()) for r in given)) < 0.05 * sum(len(r.text.split()) for r in given)
    given, left = seen["sentencepiece"]
    assert sorted(r.doc_id for r in given) == sorted(r.doc_id for r in left) and all(len(r.token_ids) == r.n_tokens for r in left)


def test_run_and_odd_rows(spark, odd):
    assert corpus_pipeline.run(spark, "/root/testdata/sf0.001").count() > 0
    assert list(corpus_pipeline.queries()) == ["pipeline"] and 4 <= len(corpus_pipeline.STAGES) <= 5
    docs = odd
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = spark.createDataFrame(stage(spark, docs, "").collect(), odd.schema)
        assert docs.columns == odd.columns, name
    assert exact_dedup.exact_groups(docs).count() == docs.count()


def test_language_stage_follows_the_prediction(spark):
    """Noise in known letters goes; known languages, rows without a language, and a corpus without any language stay."""
    noise = "xqz jvw kkq zzx qvj wxz " * 20
    rows = [(i, f"the cat and the dog sat on the mat number {'abcdefghij'[i % 10]}" * 3, "en", "a", 1) for i in range(60)]
    rows += [(100, noise, None, "a", 1), (101, "the dog sat on the cat and the mat", None, "a", 1), (102, None, "en", "a", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    stay = lambda d: {r.doc_id for r in corpus_pipeline.identify_language(spark, d, "").collect()}
    assert stay(df) == {*range(60), 101}
    assert stay(df.withColumn("lang", F.lit(None).cast("string"))) == {*range(60), 100, 101}


def test_empty(spark, none):
    docs = none
    for _, stage in corpus_pipeline.STAGES:
        docs = spark.createDataFrame(stage(spark, docs, "").collect(), stage(spark, docs, "").schema)
    assert docs.count() == 0
