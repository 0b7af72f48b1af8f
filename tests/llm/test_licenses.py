import itertools
import random

from tapelens.llm import licenses, queries
from tapelens.llm.license_texts import TEMPLATES


def test_longest_increasing_by_enumeration():
    draw = random.Random(2)
    for _ in range(60):
        n = draw.randint(0, 8)
        pairs = list(zip(range(n), draw.sample(range(n), n), strict=True))
        best = max((len(c) for k in range(n + 1) for c in itertools.combinations(pairs, k) if all(x[1] < y[1] for x, y in itertools.pairwise(c))), default=0)
        got = licenses.longest_increasing(pairs)
        assert len(got) == best and all(x[1] < y[1] for x, y in itertools.pairwise(got)) and set(got) <= set(pairs)


def test_alignment_is_ordered_and_exact_where_words_are_unique():
    a = "w0 w1 w2 w3 w4 w5 w6 w7".split()
    assert licenses.align(a, ["x", *a[:3], "y", "z", *a[3:6], a[7], "v"]) == [(0, 1), (1, 2), (2, 3), (3, 6), (4, 7), (5, 8), (7, 9)]
    draw = random.Random(3)
    for _ in range(200):
        a, b = ([draw.choice("abcdefg") for _ in range(draw.randint(0, 12))] for _ in range(2))
        got = licenses.align(a, b)
        assert all(a[i] == b[j] for i, j in got)
        assert all(x[0] < y[0] and x[1] < y[1] for x, y in itertools.pairwise(got))
    assert licenses.align([], []) == [] and licenses.align(list("abc"), list("abc")) == [(0, 0), (1, 1), (2, 2)]


def noise(draw, n):
    return " ".join("".join(draw.choices("qwzx", k=4)) for _ in range(n))


def test_every_template_is_found_in_noise():
    draw, scanner = random.Random(4), licenses.Scanner()
    for name, text in TEMPLATES.items():
        found = scanner.scan(f"{noise(draw, 50)}\n{text.upper()}\n{noise(draw, 30)}\n{text.replace(' ', '  ')} {noise(draw, 5)}")
        assert [h[0] for h in found] == [name, name] and all(h[1] == 1 for h in found), (name, found)
        if len(licenses.tokens(text)) >= licenses.SHORT:
            assert [h[0] for h in scanner.scan(f"{text} {text} {text}")] == [name] * 3
    for name in ("MIT", "ISC", "BSD-3-Clause", "Apache-2.0-header"):  # one word in twelve lost, one in twelve added
        words = TEMPLATES[name].split()
        changed = [x for i, w in enumerate(words) for x in ([] if i % 12 == 5 and not licenses.deciding(licenses.tokens(w))[:1] == [True] else [w, "zzz"] if i % 12 == 9 else [w])]
        assert [h[0] for h in scanner.scan(noise(draw, 20) + " " + " ".join(changed))] == [name]
    assert scanner.scan("A licensed version of the public software.") == []


def test_the_nearest_licence_is_not_named_for_another():
    scanner = licenses.Scanner()
    names = lambda text: [h[0] for h in scanner.scan(text)]
    assert names("Licensed under CC BY 4.0.") == ["CC-BY-4.0-notice"] and names("Licensed under CC BY-NC 4.0.") == ["CC-BY-NC-4.0-notice"]
    assert names("Licensed under CC BY-NC 2.0.") == []
    assert names("Released under the BSD License.") == ["BSD-notice"] and names("Released under the Apache License") == ["Apache-notice"]
    assert names("Offered under the MIT License.") == names("Released under the MIT License.") == ["MIT-notice"]
    assert names("This work is licensed under the GNU Lesser General Public License, version 3.") == ["LGPL-3.0-notice"]
    assert names("This work is licensed under the GNU Affero General Public License, version 3.") == ["AGPL-3.0-notice"]
    assert names("This work is licensed under the GNU General Public License, version 2.") == ["GPL-2.0-notice"]
    assert names("This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.") == ["CC-BY-NC-4.0-notice-long"]
    gpl = TEMPLATES["GPL-3.0-header"]
    assert names(gpl.replace("version 3", "version 2")) == ["GPL-2.0-header"] and names(gpl.replace("version 3", "version 4")) == []
    assert names(gpl.replace("General Public", "Lesser General Public")) == ["LGPL-3.0-header"]
    assert names(gpl.replace("General Public", "Library General Public")) == []
    only = licenses.Scanner({"GPL-3.0-header": gpl, "BSD-2-Clause": TEMPLATES["BSD-2-Clause"]})
    assert [h[0] for h in only.scan(TEMPLATES["AGPL-3.0-header"] + " " + TEMPLATES["BSD-2-Clause"])] == ["BSD-2-Clause"]
    diluted = " ".join(f"{w} zzz" for w in TEMPLATES["MIT"].split())
    assert names(diluted) == []  # as many foreign words as own ones


def brute(scanner, text):
    """The names that suit a text: every template aligned at every place."""
    words = licenses.tokens(text)
    decides = licenses.deciding(words)
    return {t.name for t in scanner.templates for start in range(len(words)) if t.hit(words, decides, start)}


def test_no_hit_is_lost_by_looking_at_likely_places_only():
    """Changed texts against the alignment of every template at every place."""
    chosen = {k: TEMPLATES[k] for k in ("MIT-notice", "Apache-2.0-header", "GPL-3.0-header", "LGPL-3.0-header", "ISC", "CC-BY-4.0-notice-long")}
    scanner, found = licenses.Scanner(chosen), 0
    for seed in range(60):
        draw = random.Random(seed)
        name = draw.choice(list(chosen))
        rate, out = draw.choice([0.02, 0.06, 0.1, 0.15]), []
        for w in chosen[name].split():
            x = draw.random()
            out += [] if x < rate / 2 else [w, noise(draw, 1)] if x < rate else [w]
        text = f"{noise(draw, draw.randint(0, 30))} {' '.join(out)} {noise(draw, draw.randint(0, 30))}"
        want, got = brute(scanner, text), {h[0] for h in scanner.scan(text)}
        assert got <= want and bool(got) == bool(want), (seed, name, want, got)
        found += bool(got)
    assert 20 < found < 60


def test_several_changed_notices_in_a_text_are_those_of_every_place():
    """Names and spans of one to three changed notices with loose template words between them."""
    chosen = {k: TEMPLATES[k] for k in ("MIT-notice", "Apache-2.0-header", "GPL-3.0-header", "LGPL-3.0-header", "ISC", "CC-BY-4.0-notice-long")}
    scanner, found = licenses.Scanner(chosen), 0
    for seed in range(40):
        draw = random.Random(seed)
        parts = [noise(draw, draw.randint(0, 20))]
        for _ in range(draw.randint(1, 3)):
            rate, own = draw.choice([0.02, 0.06, 0.1, 0.15]), chosen[draw.choice(list(chosen))].split()
            for w in own:
                x = draw.random()
                parts += [] if x < rate / 2 else [w, noise(draw, 1)] if x < rate else [w]
            parts += draw.choices(own, k=draw.randint(0, 25))
        text = " ".join(parts)
        words = licenses.tokens(text)
        decides = licenses.deciding(words)
        hits = {h for t in scanner.templates for start in range(len(words)) if (h := t.hit(words, decides, start))}
        want = licenses.select(hits)
        assert scanner.scan(text) == want, (seed, want, scanner.scan(text))
        found += len(want)
    assert found > 40


def test_odd_rows(spark, odd, none):
    assert licenses.find_licenses(odd).count() == 0 and licenses.find_licenses(none).count() == 0
    rows = [(1, "Released under the MIT License."), (1, "Released under the MIT License."), (None, "x " * 50000 + "Licensed under CC BY-NC 4.0."), (2, "Licensed under CC BY-NC 4.0. Licensed under CC BY-NC 4.0."), (3, None)]
    got = licenses.find_licenses(spark.createDataFrame([(*r, "c") for r in rows], "doc_id long, text string, license_id string")).collect()
    assert sorted((r.doc_id or 0, r.license_id, r.coverage) for r in got) == [(0, "CC-BY-NC-4.0-notice", 1.0), (1, "MIT-notice", 1.0), (1, "MIT-notice", 1.0), (2, "CC-BY-NC-4.0-notice", 1.0), (2, "CC-BY-NC-4.0-notice", 1.0)]


def test_documents(spark):
    sf = "/root/testdata/sf0.01"
    notices = {"MIT License": "MIT-notice", "Apache License": "Apache-2.0-notice", "General Public License": "GPL-3.0-notice", "CC BY-NC": "CC-BY-NC-4.0-notice"}
    want = sorted((r.doc_id, name) for r in queries.documents(spark, sf).collect() for words, name in notices.items() for _ in range(r.text.count(words)))
    assert sorted((r.doc_id, r.license_id) for r in queries.op2_license_scan(spark, sf).collect()) == want
