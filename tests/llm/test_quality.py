import math
import re

import numpy as np

from tapelens.llm import quality, queries


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    twice = {w for w in windows if windows.count(w) > 1} if len(windows) < 3000 else {w for w in set(windows) if windows.count(w) > 1}
    covered = {j for i, w in enumerate(windows) if w in twice for j in range(i, i + 8)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered)


def same(docs, rows):
    want = sorted((r.doc_id if r.doc_id is not None else -1, *(b := brute(r.text)), b[0] < 20 or 100 * b[4] > 30 * b[0]) for r in docs)
    assert sorted((r.doc_id if r.doc_id is not None else -1, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in rows) == want


def test_base_counts(spark, sf):
    same(spark.read.parquet(f"{sf}/documents.parquet").collect(), queries.op10_quality_rules(spark, sf).collect())


def test_odd_rows(spark, odd, none):
    labels = spark.createDataFrame([(1, 1), (1, 0), (None, 1), (2, None), (8, 1), (99, 0)], "doc_id long, quality int")
    rows = quality.judge(odd, labels).collect()
    same(odd.collect(), rows)
    assert all(r.kept != r.base_failed for r in rows)
    assert quality.judge(none, labels).count() == 0
    assert quality.judge(odd, labels.limit(0)).count() == odd.count()


def test_binomial_bound():
    for n, k, p in [(5, 0, 0.1), (20, 3, 0.2), (100, 7, 0.03)]:
        assert math.isclose(quality.at_most(k, n, p), sum(math.comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1)))


def test_false_rejections_stay_under_the_risk():
    """Draw holdouts from a known law: cutoffs that lose more than the risk are rarely certified."""
    draw, risk, level, broken = np.random.default_rng(3), 0.05, 0.1, 0
    shares = np.linspace(2, 0.1, 40)
    shares /= shares.sum()
    for _ in range(400):
        good = draw.multinomial(300, shares)
        cutoff = quality.certified_cutoff(good, np.full(40, 10**6), risk, level)
        broken += cutoff is not None and shares[cutoff:].sum() > risk
    assert broken / 400 <= level + 0.04
    assert quality.certified_cutoff(np.array([20, 0, 0]), np.array([0, 0, 9]), 0.01, 0.05) is None
    assert quality.certified_cutoff(np.array([2000, 0, 0, 0]), np.array([0, 0, 9, 1]), 0.01, 0.05) == 2


def test_repeats_change_no_cutoff(spark):
    """Rows and copies of labelled texts are no further trials."""
    prose = [f"w{i} is one of the plain words that a text about thing {i} may have in it , said here in a row of twenty or more words today" for i in range(400)]
    junk = [f"{t} $$$$$$$$$$$$$$$$$$ ### %%%" for t in prose[:60]]
    form = "doc_id long, text string, lang string"
    few = [(i, t, "en") for i, t in enumerate(prose[:60] + junk[:30])]
    label = [(i, int(i < 60)) for i in range(90)]
    kept = lambda rows, labels: {(r.doc_id, r.kept) for r in quality.judge(spark.createDataFrame(rows, form), spark.createDataFrame(labels, "doc_id long, quality int")).collect()}
    plain = kept(few, label)
    assert all(k for _, k in plain)  # sixty good texts certify nothing
    assert kept(few * 20, label * 3) == plain
    copies = [(i + 1000 * k, t, lang) for k in range(20) for i, t, lang in few]
    assert all(k for _, k in kept(copies, [(i + 1000 * k, q) for k in range(20) for i, q in label]))
    many = [(i, t, "en") for i, t in enumerate(prose + junk)]
    verdicts = dict(kept(many, [(i, int(i < 400)) for i in range(460)]))
    assert all(verdicts[i] for i in range(400)) and not any(verdicts[i] for i in range(400, 460))


def test_tails_stop_at_the_level():
    good = np.zeros(257, np.int64)
    good[:200], good[200:] = 10**4, 10**3
    assert quality.at_most(50 * 10**3, int(good.sum()), 0.025) <= 0.001 < quality.at_most(51 * 10**3, int(good.sum()), 0.025)
    assert quality.certified_cutoff(good, np.full(257, 10**5), 0.025, 0.001) == 257 - 50


def test_verdicts_on_labels(spark):
    sf = "/root/testdata/sf0.1"
    got = queries.op10_quality_rules(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("not base_failed").toPandas()
    assert 1 - got[got.quality == 1].kept.mean() <= quality.RISK
    assert got[got.quality == 0].kept.mean() < 0.2


def shares(text):
    """The bins of the four statistics, from the words and lines themselves."""
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    chars = max(1, sum(map(len, words)))
    stutters = sum(a == b for a, b in zip(words, words[1:], strict=False))
    of = [len(re.findall(r"[#*$%&|<>]", text)) / chars, len(re.findall("[A-Z]", text)) / chars, stutters / max(1, len(words)), (len(lines) - len(set(lines))) / max(1, len(lines))]
    return [min(quality.BINS, math.floor(x * quality.BINS)) for x in of]


def test_kept_by_brute_force(spark):
    """The verdict of every document, with cutoffs found by trying all of them under the exact binomial law."""
    sf = "/root/testdata/sf0.01"
    docs = {r.doc_id: r for r in queries.documents(spark, sf).collect()}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    base = {i: (b := brute(r.text))[0] < 20 or 100 * b[4] > 30 * b[0] for i, r in docs.items()}
    bins = {i: shares(r.text) for i, r in docs.items()}
    held = [i for i in docs if i in labels and not base[i]]
    strata = sorted({docs[i].lang or "" for i in held})
    cut, said = {}, {}
    for i in held:  # a text and its copies are one trial
        said.setdefault((docs[i].lang or "", docs[i].text), []).append(i)
    for lang in strata:
        for k in range(4):
            own = [(bins[ids[0]][k], labels[ids[0]]) for (of, _), ids in said.items() if of == lang and len({labels[i] for i in ids}) == 1]
            n, best = sum(q > 0 for _, q in own), 0
            for c in range(quality.BINS, -1, -1):
                lost, caught = sum(b >= c and q > 0 for b, q in own), sum(b >= c and q <= 0 for b, q in own)
                p = quality.RISK / 4
                if sum(math.comb(n, j) * p**j * (1 - p) ** (n - j) for j in range(lost + 1)) > quality.DELTA / (4 * len(strata)):
                    break
                if caught - quality.GOOD_WEIGHT * lost > best:
                    best, cut[lang, k] = caught - quality.GOOD_WEIGHT * lost, c
    want = {i: not base[i] and all(bins[i][k] < cut.get((r.lang or "", k), math.inf) for k in range(4)) for i, r in docs.items()}
    assert {r.doc_id: r.kept for r in queries.op10_quality_rules(spark, sf).collect()} == want
