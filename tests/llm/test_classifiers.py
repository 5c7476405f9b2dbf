"""Quality, toxicity, licences and page extraction."""

import pickle
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from barloom.llm import extract, licences, quality, toxicity

WORDS = [a + b + c for a in ("th", "er", "on", "in") for b in ("a", "e", "is") for c in ("nd", "r", "st", "ly")]


def prose(rng, n):
    out = [rng.choice(WORDS) for _ in range(n)]
    return " ".join([out[0].title(), *out[1:]]) + "."


def corpus(n=240, seed=1):
    """Documents, their quality and whether they are toxic."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        text, good, toxic = prose(rng, rng.randrange(20, 120)), 1, 0
        if i % 4 == 1:
            text, good = (text.upper().replace(" ", "!! ") if i % 8 == 1 else " ".join([text.split()[0]] * 60)), 0
        elif i % 4 == 2:
            words = text.split()
            for _ in range(2):
                words.insert(rng.randrange(len(words)), "vilemoron" + rng.choice(["", "s", "ity"]))
            text, toxic = " ".join(words), 1
        rows.append((i, text, good, toxic))
    return rows


@pytest.fixture(scope="module")
def labelled(spark):
    rows = corpus()
    docs = spark.createDataFrame([(i, t, "en") for i, t, _, _ in rows], "doc_id long, text string, score string")
    labels = spark.createDataFrame([(i, q, x) for i, _, q, x in rows] + [(None, 1, 1), (10**6, 1, 0), (1, None, None)], "doc_id long, quality int, toxic int")
    return rows, docs, labels


def edge_rows(spark, docs):
    more = spark.createDataFrame([(None, None, None), (900, "", "x"), (901, " \n", "x"), (902, "é" * 50_000, "x"), (0, "again", "x"), (0, "again", "x")], docs.schema)
    return docs.union(more)


def test_quality(spark, labelled):
    rows, docs, labels = labelled
    model = quality.fit_quality(docs, labels, F.col("doc_id") % 3 != 0)
    every = edge_rows(spark, docs)
    got = quality.score_quality(every, model).collect()
    assert len(got) == len(rows) + 6 and all(0 <= r.score <= 1 for r in got)
    by_text = {r.text: r.score for r in got}
    right = [(by_text[t] >= 0.7) == (q == 1) for i, t, q, _ in rows if i % 3 == 0]
    assert np.mean(right) >= 0.95
    assert {r.score for r in got if r.text == "again"} == {by_text["again"]}
    assert quality.score_quality(docs.limit(0), model).count() == 0
    untrained = quality.fit_quality(docs, labels.limit(0), F.lit(True))
    assert all(0 <= r.score <= 1 for r in quality.score_quality(docs.limit(5), untrained).collect())


def test_word_shapes():
    shown = {"The": "Aa", "the": "a", "THE!!": "A!", "the,": "a,", "Thre***": "Aa*", "12.5": "0.0", "|": "|", "tHe": "aA", "é.": "a."}
    assert {w: quality.shape(w) for w in shown} == shown


def test_toxicity(spark, labelled):
    rows, docs, labels = labelled
    every = edge_rows(spark, docs)
    got = toxicity.score_toxicity(every, labels, F.col("doc_id") % 5 != 0, with_text=True).collect()
    assert len(got) == len(rows) + 6 and all(0 <= r.score <= 1 for r in got)
    by_text = {r.text: r for r in got}
    right = [(by_text[t].score >= 0.5) == (x == 1) for i, t, _, x in rows if i % 5 == 0]
    assert np.mean(right) >= 0.95
    assert by_text[None].neighbours == [] and by_text[""].score == by_text[None].score
    toxic = by_text[rows[2][1]]
    assert toxic.cosines == sorted(toxic.cosines, reverse=True) and len(toxic.neighbours) == len(toxic.cosines)
    none = toxicity.score_toxicity(docs.limit(3), labels.limit(0), F.lit(True)).collect()
    assert [r.score for r in none] == [0.0] * 3
    assert toxicity.score_toxicity(docs.limit(0), labels, F.lit(True)).count() == 0


def test_toxicity_cuts_texts_once(spark, labelled):
    """Verdicts are read from the written terms, with and without the text."""
    _, docs, labels = labelled
    for with_text in (False, True):
        scored = toxicity.score_toxicity(docs.withColumn("terms_", F.lit(1)), labels, F.lit(True), with_text=with_text)
        files = scored.inputFiles()
        assert files and all("/terms" in f for f in files)
        assert set(scored.columns) == {*docs.columns, "terms_", "score", "neighbours", "cosines"} - ({"text"} if not with_text else set())


@pytest.mark.parametrize("terms, counts", [([], []), ([0], [1]), ([0, 1, 70_000, 70_001], [255, 1, 2, 3]), ([5, 9], [256, 70_000])])
def test_packed_terms(terms, counts):
    got = toxicity._unpacked(toxicity._packed(np.array(terms, np.int32), np.array(counts, np.int64)))
    assert [g.tolist() for g in got] == [terms, counts]


@pytest.mark.parametrize("text", ["", "Ab c1d_e", "ÀÉ ß÷ ÿ²½ªµ º×x", "İstanbul Ǆ", "日本 é🙂b", "a\x00b\x85c\xa0d"])
def test_words_of_latin_and_other_texts(text):
    assert toxicity.words_of(text) == toxicity._WORD.findall(text.lower())


def test_fitted_index_holds_no_blocks():
    """The driver keeps the examples only; blocks are made where texts are judged."""
    index = toxicity.build_index(np.arange(3), np.array([0, 1, 1]), [np.arange(2)] * 3, [np.ones(2)] * 3, np.ones(2), 0.5)
    assert not hasattr(index, "common")
    assert len(index.judge([np.arange(2)], [np.ones(2)])[0][1]) == 3 and hasattr(index, "common")


@pytest.mark.parametrize("n, m, most", [(150, 40, 6), (1, 3, 3), (8, 5, 3), (600, 400, 25)])
def test_nearest_is_exact(monkeypatch, n, m, most):
    """Blocks whose bound is too low are skipped, and the neighbours are those of all cosines."""
    monkeypatch.setattr(toxicity, "BLOCK", 8)
    rng = np.random.RandomState(0)
    # Four groups that mostly use terms of their own, as languages do.
    group = rng.randint(0, 4, n)
    own = [np.flatnonzero((np.arange(m) % 5 == g) | (np.arange(m) % 5 == 4)) for g in range(4)]
    terms = [np.sort(rng.choice(own[g], min(len(own[g]), rng.randint(0, most)), replace=False)) for g in group]
    counts = [rng.randint(1, 5, len(t)).astype(float) for t in terms]
    index = toxicity.build_index(np.arange(n) + 7, rng.randint(0, 2, n), terms, counts, rng.rand(m) + 0.5, 0.3)
    index.skipped = index.compared = 0
    dense = np.zeros((n, m))
    for i in range(n):
        dense[i, terms[i]] = index.vector(terms[i], counts[i])
    for i in range(n):
        if len(terms[i]):
            at, cosines = index.nearest(terms[i], index.vector(terms[i], counts[i]), leave_out=i)
            all_cosines = dense @ dense[i]
            all_cosines[i] = 0
            want = np.lexsort((np.arange(n), -np.round(all_cosines, 12)))[: toxicity.NEIGHBOURS]
            want = want[all_cosines[want] > 0]
            assert at.tolist() == want.tolist() and np.allclose(cosines, all_cosines[want])
    assert (np.diff(index.value) >= 0).all()
    if n > 500:
        assert index.skipped > 0.05 * (index.skipped + index.compared)
    again = pickle.loads(pickle.dumps(index))  # as workers get it
    got, want = again.judge(terms, counts), index.judge(terms, counts)
    assert all(a[0] == b[0] and a[1].tolist() == b[1].tolist() for a, b in zip(got, want, strict=True))


LINES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "MIT": "Released under the MIT License.",
    "GPL": "This work is licensed under the GNU General Public License, version 3.",
    "CC-BY-NC": "Licensed under CC BY-NC 4.0.",
}


def test_licences(spark):
    rng = random.Random(3)
    rows = [(i, "\n".join([prose(rng, 30), prose(rng, 25)]), "f") for i in range(60)]
    want = set()
    for k, (family, line) in enumerate(LINES.items()):
        rows.append((100 + k, f"{prose(rng, 20)}\n{line}\n{prose(rng, 9)}", "f"))
        rows.append((200 + k, f"{line} {prose(rng, 4)}", "f"))
        want |= {(100 + k, 1, family), (200 + k, 0, family)}
    rows += [(300, None, "f"), (301, "", "f"), (302, "The general public likes the new version of it\nA license", "f"), (100, rows[60][1], "f"), (None, LINES["MIT"], "f")]
    want |= {(None, 0, "MIT")}
    docs = spark.createDataFrame(rows, "doc_id long, text string, family string")
    model = licences.fit_licences(docs)
    found = licences.scan(docs, model, with_text=True)
    got = found.collect()
    assert {(r.doc_id, r.paragraph, r.family) for r in got if r.confirmed} == want
    assert len([r for r in got if r.doc_id == 100]) == 2
    assert 302 not in {r.doc_id for r in got if r.confirmed}
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))
    assert licences.scan(docs.limit(0), model).count() == 0


PAGE = """<html><head><title>t</title><script>var a = "<p>no</p>";</script></head><body class="has-sidebar">
<header><h1>Site</h1></header><nav><a href=/>home</a></nav><div class="cookie-notice">We use cookies</div>
<div id="main-{n}" class="content post-{n}"><h2>Title &amp; more</h2><p>First   text {n} is here
and goes on<br>to the end.<p>Second <a href=x>link</a> text, &eacute;.</p><div class="ad">Buy</div>
<form><p>Your mail</p></form><ul><li>one<li>two</ul><section class="comments"><p>{noise}</p></section></div>
<aside><p>Other news and more of it</p></aside><footer>&copy; me</footer><!-- <p>x</p> --></body></html>"""


def test_extraction(spark):
    long = "A comment that is far longer than the article itself. " * 40
    rows = [(i, f"https://a.example/{i}", PAGE.format(n=i, noise=long if i % 3 else "x"), "old") for i in range(9)]
    bare = '<div class="content post-7"><p>Short.</p></div><div class="box"><p>' + "Many words of a box that one page has. " * 9 + "</p></div>"
    rows += [(50, "https://a.example/50", f"<html><body>{bare}</body></html>", "old"), (51, None, None, "old"), (52, "", "", "old"), (53, "x", "plain text", "old"), (54, "x", "<p>a<b", "old"), (54, "x", "<p>a<b", "old")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = {r.page_id: r.text for r in extract.extract(pages).collect()}
    for i in range(9):
        assert got[i] == f"Title & more\n\nFirst text {i} is here and goes on to the end.\n\nSecond link text, é.\n\none\n\ntwo"
    assert got[51] == got[52] == "" and got[53] == "plain text"
    assert extract.extract(pages).count() == len(rows)
    assert extract.extract(pages.limit(0)).count() == 0


def test_host_path_overrules_a_pages_own_choice():
    page = '<html><body><article><p>Short text.</p></article><div class="wide"><p>' + "Not the article at all. " * 30 + "</p></div></body></html>"
    assert extract.main_text(page, []).startswith("Not the article")
    assert extract.main_text(page, [">html>body>article"]) == "Short text."
    assert extract.main_text(page, [">html>body>main", ">html>body>article"]) == "Short text."


def test_toxicity_sees_every_term(spark):
    """Words too rare to single out by themselves, copies of labelled examples, and texts of words without preference."""
    rng = random.Random(5)
    rows = []
    for i in range(330):
        words = [f"{rng.choice(WORDS)}{rng.choice('aeiou')}{rng.choice('lmnrst')}" for _ in range(rng.randrange(30, 90))]
        if i % 8 == 1:  # each telling word stands in about two examples
            words.insert(rng.randrange(len(words)), f"{'bcdfghjklmnpqrstvwxz'[i // 8 % 20]}uvile")
        rows.append((i, " ".join(words), int(i % 8 == 1)))
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows] + [(i + 1000, t) for i, t, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, x) for i, _, x in rows], "doc_id long, toxic int")
    got = {r.doc_id: r for r in toxicity.score_toxicity(docs, labels, F.lit(True)).collect()}
    assert all(len(r.neighbours) == toxicity.NEIGHBOURS for r in got.values())
    assert all(abs(got[i + 1000].cosines[0] - 1) < 1e-9 and got[i + 1000].neighbours[0] == i for i, _, _ in rows)
    assert np.mean([got[i + 1000].score >= 0.5 for i, _, x in rows if x]) >= 0.95
    assert np.mean([got[i + 1000].score >= 0.5 for i, _, x in rows if not x]) <= 0.05


def test_title_and_lead_outside_the_body_container_stay(spark):
    body = "Many words of the body, and more of them. " * 60
    head = "<html><body><nav><p><a href=/>home and other links</a></p></nav>"
    title = f"{head}<article><h1>A title of the page</h1><div class='content'><p>{body}</p></div></article></body></html>"
    lead = f"{head}<div class='post'><div class='lead'><p>The lead.</p></div><div class='text'><p>{body}</p></div></div></body></html>"
    linked = f"{head}<div class='outer'><div class='text'><p>{body}</p></div><div class='more'><a href=x>{'Other pages. ' * 9}</a></div></div></body></html>"
    bare = f"<html><body><h1>A title</h1><div class='text'><p>{body}</p></div></body></html>"
    assert extract.main_text(title, []) == f"A title of the page\n\n{body.strip()}"
    assert extract.main_text(lead, []) == f"The lead.\n\n{body.strip()}"
    assert extract.main_text(linked, []) == body.strip()
    assert extract.main_text(bare, []) == f"A title\n\n{body.strip()}"
    short = title.replace(body, "Short.")
    rows = [(i, f"https://t.example/{i}", short if i == 3 else title) for i in range(4)]
    got = {r.page_id: r.text for r in extract.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got[0].startswith("A title of the page\n\nMany") and got[3] == "A title of the page\n\nShort."


def test_article_text_is_not_dropped_by_tag_or_id():
    parts = {
        '<section id="discussion"><h2 id="search">Discussion</h2><p>It holds.</p></section>': ["Discussion", "It holds."],
        '<div class="section" id="related-work"><h2 class="related">Related work</h2></div>': ["Related work"],
        '<p class="alert">Mind this.</p>': ["Mind this."],
        "<figure><img src=a><figcaption>A figure.</figcaption></figure>": ["A figure."],
        "<p>Let <math><mi>x</mi><mo>=</mo><mn>1</mn><annotation>x = 1</annotation></math> be.</p>": ["Let x=1 be."],
        "<object data=a><p>The fallback.</p></object>": ["The fallback."],
        '<div class="related"><p>Other news.</p></div><div id="comments"><p>Nice.</p></div><ul class="menu"><li>Home</ul>': [],
    }
    page = f"<html><body><article><p>Start of it.</p>{''.join(parts)}</article></body></html>"
    want = ["Start of it.", *(t for texts in parts.values() for t in texts)]
    assert extract.main_text(page, [">html>body>article"]).split("\n\n") == want


def test_licence_words_of_one_large_source_stay_telling_elsewhere(spark):
    rng = random.Random(8)
    hot = "License: MIT. Licensed under CC BY, version 2.0 or 4.0, released by the Apache group"
    rows = [(i, f"{prose(rng, 20)}\n{hot}\n{prose(rng, 9)}") for i in range(100)] + [(500 + i, prose(rng, 30)) for i in range(100)]
    rows += [(200 + k, f"{prose(rng, 20)}\n{line}\n{prose(rng, 9)}") for k, line in enumerate(LINES.values())]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r.doc_id, r.paragraph): r for r in licences.scan(docs, licences.fit_licences(docs)).collect()}
    assert [got[200 + k, 1].family if (200 + k, 1) in got else None for k in range(len(LINES))] == list(LINES)


#: Wordings that are no templates, with the family they grant.
WORDINGS = [
    ("Apache-2.0", "The library is licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Our tools are licensed under the Apache License 2.0"),
    ("MIT", "Our code is released under the MIT license."),
    ("MIT", "Licensed under the MIT License"),
    ("MIT", "This project is MIT licensed, have fun"),
    ("MIT", "// SPDX-License-Identifier: MIT"),
    ("MIT", "the above copyright notice and this permission notice shall be included in all copies of the Software"),
    ("BSD", "Released under the BSD 2-Clause License"),
    ("BSD", "Redistributions of source code must retain the above copyright notice, this list of conditions and the disclaimer"),
    ("GPL", "License: GPL-3.0-or-later"),
    ("GPL", "# SPDX-License-Identifier: GPL-2.0-only"),
    ("GPL", "You can redistribute it and/or modify it under the terms of the GNU General Public License, version 2"),
    ("LGPL", "Licensed under the GNU Lesser General Public License v3"),
    ("AGPL", "This server is licensed under the GNU Affero General Public License, version 3"),
    ("ISC", "Distributed under the ISC license"),
    ("CC0", "This dataset is dedicated to the public domain under CC0 1.0."),
    ("CC-BY", "Licensed under CC BY 3.0"),
    ("CC-BY-SA", "All pictures are licensed under CC BY-SA 4.0"),
    ("CC-BY-NC", "Texts licensed under CC BY-NC 4.0 unless noted"),
    ("CC-BY-ND", "Licensed under CC BY-ND 3.0"),
]
NO_LICENCES = [
    "The driver lost his license on the road", "Version 2.0 of the public library software", "The general public is free to use this road",
    "A copy of the letter was included in the file", "She works at MIT in the general office", "The warranty ends in May",
]


def brute_scores(model, line):
    """Family and probability by plain Python from the fitted weights."""
    import re

    w = re.findall("[a-z0-9]+(?:[.+-][a-z0-9]+)*", line.lower())
    grams = {" ".join(w[i : i + n]) for n in (1, 2, 3) for i in range(len(w) - n + 1)}
    at = [i for i, g in enumerate(model.vectors.vocabulary) if g in grams]
    z = model.regression.coefficientMatrix.toArray()[:, at] @ np.array(model.scale)[at] if at else 0.0
    z = (z + model.regression.interceptVector.toArray() + model.shifts) / model.temperature
    p = np.exp(z - z.max())
    return model.families[int(z.argmax())], float((p / p.sum()).max())


def test_licence_wordings_and_scores(spark):
    rng = random.Random(5)
    corpus = spark.createDataFrame([(i, "\n".join(prose(rng, 20) for _ in range(3))) for i in range(80)], "doc_id long, text string")
    model = licences.fit_licences(corpus)
    lines = [t for _, t in WORDINGS] + NO_LICENCES + [prose(rng, 30) for _ in range(10)]
    docs = spark.createDataFrame([(7, "\n".join(lines), 1, 2)], "doc_id long, text string, grams_ int, raw_ int")
    got = {r.paragraph: r for r in licences.scan(docs, model).collect()}
    assert [got[i].family if i in got and got[i].confirmed else None for i in range(len(WORDINGS))] == [f for f, _ in WORDINGS]
    assert not any(i in got and got[i].confirmed for i in range(len(WORDINGS), len(lines)))
    for i, line in enumerate(lines):
        family, probability = brute_scores(model, line)
        if family != licences.UNKNOWN and probability >= licences.LEAST_PROBABILITY:
            assert got[i].family == family and abs(got[i].probability - probability) < 1e-9
        else:
            assert i not in got


def test_licence_lines_are_cut_into_words_once_and_none_is_dropped(spark):
    rng = random.Random(11)
    corpus = spark.createDataFrame([(i, "\n".join(prose(rng, 20) for _ in range(3))) for i in range(80)], "doc_id long, text string")
    model = licences.fit_licences(corpus)
    parts = [t.split(" ") for _, t in licences.all_templates()]
    lines = []
    for _ in range(400):  # pieces and shuffled words of templates, most of them close to the decision
        cuts = [(p, rng.randrange(len(p))) for p in rng.sample(parts, rng.randint(1, 3))]
        words = [w for p, a in cuts for w in p[a : a + rng.randint(1, 5)]]
        lines.append(" ".join(words if rng.random() < 0.5 else rng.sample(words, len(words))))
    docs = spark.createDataFrame([(7, "\n".join(lines))], "doc_id long, text string")
    found = licences.scan(docs, model)
    want = {i for i, t in enumerate(lines) if (s := brute_scores(model, t))[0] != licences.UNKNOWN and s[1] >= licences.LEAST_PROBABILITY}
    assert {r.paragraph for r in found.collect()} == want and 50 < len(want) < 350
    plain = corpus.select(F.explode(F.split("text", "\n")).alias("t"))
    assert plain.where(licences.may_be_licence(licences.words(F.col("t")), model)).count() == 0
    assert found._jdf.queryExecution().optimizedPlan().toString().count("regexp_extract_all(") == 1
