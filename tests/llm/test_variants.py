"""Spelling variants against brute force over all pairs of words."""

import random
import re
import zlib
from collections import Counter

import pytest

from barloom.llm import variants

RUN = re.compile("[A-Za-zÀ-ÿ]+")


def brute_words(rows, slip, length=5, count=3):
    total = Counter()
    for i, text in rows:
        for run in RUN.findall(text or ""):
            w = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{w}".encode())
            if slip and h % slip == 0:
                w = w[: h % len(w)] + w[h % len(w) + 1 :]
            total[w] += 1
    return {w: n for w, n in total.items() if len(w) >= length and n >= count}


def one_change(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute_variants(words):
    near = {w: [x for x in words if one_change(w, x)] for w in words}
    best = {w: min(xs, key=lambda x: (-words[x], x)) if xs else None for w, xs in near.items()}
    form = {w: b if b and words[b] >= 2 * words[w] else None for w, b in best.items()}
    out = {}
    for w in words:
        root = w
        while form[root]:
            root = form[root]
        out[w] = (form[w], root, words[w], len(near[w]), words[form[w]] if form[w] else None)
    return out


def found(df):
    rows = df.collect()
    out = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in rows}
    assert len(out) == len(rows)
    return out


def texts():
    rng = random.Random(6)
    base = ["".join(rng.choice("abcdeéß") for _ in range(rng.randrange(4, 9))) for _ in range(60)]
    rows = []
    for i in range(80):
        words = []
        for _ in range(40):
            w = rng.choice(base[: 1 + int(59 * rng.random() ** 2)])
            at, c = rng.randrange(len(w)), rng.choice("abcÉ×")
            words.append(rng.choice([w, w, w.upper(), w[:at] + w[at + 1 :], w[:at] + c + w[at + 1 :], w[:at] + c + w[at:]]))
        rows.append((i, "".join(w + rng.choice(" .1\n—中") for w in words)))
    long_ = "".join(rng.choice("abcdefgh") for _ in range(70_000))
    rows += [(100 + k, f"{long_} {long_[:-1]} {long_[:5]}x{long_[5:]}") for k in range(3)]
    rows += [(None, "nothing here hides"), (None, "nothing here hides"), (3, None), (4, ""), (5, " \t"), (7, rows[7][1]), (8, "中中中 123")]
    rows.append((300, " ".join(["chained"] * 40 + ["chainex"] * 20 + ["chainey"] * 10 + ["chxiney"] * 5 + ["chzzney"] * 3)))
    return rows


@pytest.mark.parametrize("cell", [1 << 13, 5])
def test_variants(spark, monkeypatch, cell):
    """Also with cells of five words, so that the trie is opened down to full vectors and slices."""
    monkeypatch.setattr(variants, "CELL", cell)
    rows = texts()
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, word string, n int")
    for slip in (0, 3):
        words = brute_words(rows, slip)
        counted = variants.corpus_words(docs, slip=slip)
        assert {r.word: r.n for r in counted.collect()} == words
        assert found(variants.spelling_variants(counted)) == brute_variants(words)


def test_many_words_of_one_vector(spark, monkeypatch):
    """Anagrams share all letter counts: one leaf, dealt to slices."""
    monkeypatch.setattr(variants, "CELL", 16)
    rng = random.Random(1)
    words = {"".join(rng.sample("aaabbbcc", 8)): n + 3 for n in range(120)}
    words |= {w[:-1] + "d": n for n, w in enumerate(list(words)[:30], 3)}
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    top = variants.trie_top(df)
    assert max(top.slices(p) for p in top.sizes if not top.open(p)) > 1
    assert found(variants.spelling_variants(df)) == brute_variants(words)


def test_without_words(spark):
    docs = spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")
    for rows in (docs, docs.limit(0)):
        assert variants.spelling_variants(variants.corpus_words(rows)).count() == 0


def test_branches_end_with_the_budget():
    """The search visits far fewer pairs of vectors than there are."""
    rng = random.Random(2)
    words = sorted({"".join(rng.choice("etaoinshrdlu") for _ in range(9)) for _ in range(3000)})
    counts = variants.Words(words).counts
    order = counts[variants._sorted_by(counts, list(range(len(words))))]
    assert sum(len(q) for q, _ in variants.reached(counts, order)) < 0.02 * len(words) ** 2
