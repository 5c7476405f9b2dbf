"""Exact copies, near copies, components and top-k against brute force."""

import random
import re

import numpy as np
from pyspark.sql import functions as F

from barloom.llm import exact, neardup, topk
from barloom.llm.components import components

SPACE = "[\x20\x09-\x0d]+"


def brute_exact(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(re.sub(SPACE, " ", t or ""), []).append(i)
    return groups


def test_exact_groups(spark):
    rng = random.Random(3)
    base = ["".join(rng.choice("ab \n") for _ in range(n)) for n in (3, 63, 64, 65, 575, 576, 577, 5000, 40_000)]
    rows = [(i, t) for i, t in enumerate(base * 3)]
    rows += [(100 + i, t[:-1] + "z") for i, t in enumerate(base)] + [(200, None), (201, ""), (202, " "), (203, "\t\n"), (None, "a"), (None, "a")]
    rows += [(7, base[2]), (7, base[2]), (300, "é" * 40), (301, "é" * 40), (302, "é" * 41)]
    rng.shuffle(rows)
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, kept string")
    got = exact.exact_groups(docs, with_text=True).collect()
    want = brute_exact(rows)
    assert len(got) == len(rows)
    for r in got:
        own = want[re.sub(SPACE, " ", r.text or "")]
        ids = [i for i in own if i is not None]
        assert r.group_size == len(own) and r.keep_id == (min(ids) if ids else None)
    assert sum(r.kept for r in got) == len(want)
    assert all(r.doc_id == r.keep_id for r in got if r.kept)
    assert exact.exact_groups(docs.limit(0)).count() == 0
    kept = exact.drop_exact_copies(docs)
    assert kept.columns == docs.columns and kept.count() == len(want)


def brute_near(rows):
    sets = [neardup.shingle_set(t or "") for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= 75 * len(a | b):
                parent[find(i)] = find(j)
    groups = {}
    for i in range(len(rows)):
        groups.setdefault(find(i), []).append(i)
    out = {}
    for g in groups.values():
        low = min(rows[i][0] for i in g)
        out.update({i: (low, len(sets[i])) for i in g})
    return out


def mutated(words, rng, n):
    words = list(words)
    for _ in range(n):
        words[rng.randrange(len(words))] = f"new{rng.randrange(10**6)}"
    return words


def test_near_groups(spark):
    rng = random.Random(5)
    rows = []
    for size in (6, 9, 30, 120, 600):
        for _ in range(6):
            base = [f"w{rng.randrange(10**6)}" for _ in range(size)]
            rows.append(" ".join(base))
            rows += [" ".join(mutated(base, rng, n)) for n in (0, 1, 1, 2, 3, max(1, size // 40), size // 60 + 1)]
            rows.append(" ".join(base).upper() + "\n")
            chain = base
            for _ in range(4):  # each near the one before, the ends far apart
                chain = mutated(chain, rng, max(1, size // 50))
                rows.append("\t".join(chain))
    rows += ["", None, " \n", "one two", "One  two", "four words are here", "x y z"]
    common = [f"c{i}" for i in range(60)]
    rows += [" ".join(common + [f"u{k}x{i}" for i in range(25)]) for k in range(40)]  # one passage in all, no links
    rng.shuffle(rows)
    rows = list(enumerate(rows, 10))
    docs = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, row int")
    got = neardup.near_groups(docs).collect()
    assert len(got) == len(rows)
    want = {rows[i][0]: w for i, w in brute_near(rows).items()}
    assert {r.doc_id: (r.component_id, r.n_shingles) for r in got} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)
    assert neardup.near_groups(docs.limit(0)).count() == 0


def test_near_groups_with_repeated_and_missing_ids(spark):
    text = " ".join(f"w{i}" for i in range(50))
    rows = [(None, text), (None, text), (4, text), (4, text), (None, ""), (None, "alone in the whole world today"), (9, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = neardup.near_groups(docs).collect()
    assert sum(r.kept for r in got) == 4  # one copy, both empty texts, the text alone
    assert {r.component_id for r in got if r.text == text} == {4}
    kept = neardup.drop_near_copies(docs)
    assert kept.columns == docs.columns and kept.count() == 4


def test_cells_find_links_that_stars_miss(spark, monkeypatch):
    """Cells of two rows: outsiders meet every member of another component."""
    rng = random.Random(8)
    monkeypatch.setattr(neardup, "CELL", 2)
    base = [f"w{i}" for i in range(40)]
    family = [" ".join(mutated(base, rng, k % 5)) for k in range(60)]
    rows = list(enumerate(family))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = {rows[i][0]: w for i, w in brute_near(rows).items()}
    assert {r.doc_id: (r.component_id, r.n_shingles) for r in neardup.near_groups(docs).collect()} == want


def test_cells_of_large_buckets_grow_with_their_rows(spark, monkeypatch):
    """Rows in cells: a family beside one passage in many unlike texts, and a family with few outsiders."""
    rng = random.Random(3)
    monkeypatch.setattr(neardup, "CELL", 8)
    dealt, real = [], neardup._cells

    def cells(rows):
        out = real(rows)
        dealt.append(out.count())
        return out

    monkeypatch.setattr(neardup, "_cells", cells)

    def counted(texts):
        rows = list(enumerate(texts))
        dealt.clear()
        got = neardup.near_groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()
        want = {rows[i][0]: w for i, w in brute_near(rows).items()}
        assert {r.doc_id: (r.component_id, r.n_shingles) for r in got} == want
        return sum(dealt)

    def passage(n):
        return [" ".join([f"c{i}" for i in range(90)] + [f"u{k}x{i}" for i in range(50)]) for k in range(n)]

    base = [f"w{i}" for i in range(120)]

    def family(n):  # every text but the first eight is near the one before
        return [" ".join(mutated(base, rng, 8)) for _ in range(8)] + [" ".join(mutated(base, rng, k % 3)) for k in range(n)]

    for texts in (passage, family):
        few, many = counted(texts(100)), counted(texts(400))
        assert many <= 5 * few


def test_signature_agreement_estimates_similarity():
    rng = random.Random(2)
    base = [f"w{rng.randrange(10**6)}" for _ in range(400)]
    other = mutated(base, rng, 10)
    a, b = (neardup.shingle_hashes(" ".join(w)) for w in (base, other))
    true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
    assert abs((neardup.signature(a) == neardup.signature(b)).mean() - true) < 0.15
    one = neardup.signature(a[:1])
    assert len(set(one.tolist())) == 1  # every empty bin borrowed


def test_components(spark):
    rng = random.Random(1)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(i, i + 1) for i in range(1000, 1200)] + [(5, 5)]
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in links:
        if a != b:
            a, b = sorted((find(a), find(b)))
            parent[b] = a
    assert got == {x: find(x) for x in list(parent)}


def brute_top(rows, k):
    ok = [(n, i, np.floor(64 * np.array(v, np.float64)).astype(int)) for n, (i, v) in enumerate(rows) if i is not None and v and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for n, i, q in ok:
        if i % 3 == 0:
            near = sorted((-int(q @ v), j, m) for m, j, v in ok if m != n and len(v) == len(q))[:k]
            out += [(i, r, j, -s) for r, (s, j, _) in enumerate(near, 1)]
    return sorted(out)


def test_top_k(spark, monkeypatch):
    monkeypatch.setattr(topk, "CANDIDATE_BLOCK", 16)
    monkeypatch.setattr(topk, "QUERY_BLOCK", 8)
    rng = np.random.RandomState(4)
    rows = [(i, rng.normal(0, 1, 6).round(2).tolist()) for i in range(70)]
    rows += [(100 + i, rows[0][1]) for i in range(30)] + [(3, rows[1][1]), (6, [0.0] * 6), (None, [1.0] * 6)]
    rows += [(201, None), (204, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (207, [float("nan")] * 6), (210, [float("inf")] * 6), (213, [1.0, 2.0]), (216, [3.0, 4.0])]
    df = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<double>, rank int")
    for k in (5, 90):
        got = topk.exact_top_k(df, F.col("vec_id") % 3 == 0, k=k).collect()
        assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in got) == brute_top(rows, k)
    assert topk.exact_top_k(df.limit(0), F.col("vec_id") % 3 == 0).count() == 0
