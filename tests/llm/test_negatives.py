"""Hard negatives against brute force, and the bounds of the trees."""

import numpy as np
from pyspark.sql import functions as F

from barloom.llm import negatives


def usable(v):
    return v is not None and all(x is not None and np.isfinite(x) for x in v)


def brute(rows, of, scale=256, positives=5, take=3, low=50, high=95):
    ok = [(n, i, np.floor(scale * np.array(v, np.float64)).astype(int), y) for n, (i, v, y) in enumerate(rows) if i is not None and y is not None and usable(v)]
    out = []
    for n, i, q, y in ok:
        if i % of:
            continue
        others = sorted((-int(q @ v), j, m, z) for m, j, v, z in ok if m != n and len(v) == len(q))
        for s, j, _, z in [o for o in others if o[3] == y][:positives]:
            window = [o for o in others if o[3] != y and low * -s <= 100 * -o[0] <= high * -s]
            out += [(i, j, r, o[1], -s, -o[0]) for r, o in enumerate(window[:take], 1)]
    return sorted(out)


def clustered(rng, n, dim=8):
    centres = rng.normal(0, 1, (6, dim))
    return [(centres[rng.randint(6)] + rng.normal(0, 0.3, dim)).round(3).tolist() for _ in range(n)]


def frame(spark, rows):
    return spark.createDataFrame([(i, v, y, 1, 2) for i, v, y in rows], "vec_id long, embedding array<double>, label int, rid int, score int")


def test_hard_negatives(spark, monkeypatch):
    monkeypatch.setattr(negatives, "ANCHORS", 8)
    rng = np.random.RandomState(3)
    rows = [(i, v, int(rng.randint(3))) for i, v in enumerate(clustered(rng, 300))]
    rows += [(400 + i, rows[0][1], i % 3) for i in range(60)]  # one common vector, ties by id
    rows += [(3, rows[1][1], 0), (6, [0.0] * 8, 1), (None, [1.0] * 8, 0), (9, [1.0] * 8, None), (700, None, 1), (12, [], 1), (15, [], 2)]
    rows += [(600, [1.0] * 7 + [None], 1), (603, [float("nan")] * 8, 1), (606, [float("inf")] * 8, 1), (609, [1.0, 2.0], 0), (612, [2.0, 1.0], 0), (615, [1.0, 1.0], 1)]
    rows += [(-9, [-3.0] * 8, 7), (-12, [3.0] * 8, 7)]  # the only positive has a negative score: an empty window
    df = frame(spark, rows)
    got = negatives.hard_negatives(df, F.col("vec_id") % 3 == 0).collect()
    assert sorted(tuple(r) for r in got) == brute(rows, 3)
    assert negatives.hard_negatives(df.limit(0), F.col("vec_id") % 3 == 0).count() == 0
    assert negatives.hard_negatives(df, F.col("vec_id") == 5000).count() == 0


def test_large_components_stay_exact(spark):
    rng = np.random.RandomState(5)
    rows = [(i, (rng.normal(0, 1, 4) * 10**6).round().tolist(), i % 2) for i in range(60)]
    got = negatives.hard_negatives(frame(spark, rows), F.col("vec_id") % 10 == 0).collect()
    assert sorted(tuple(r) for r in got) == brute(rows, 10)


def test_tree_covers_and_bounds():
    rng = np.random.RandomState(1)
    mat = np.floor(256 * np.array(clustered(rng, 2000))).astype(np.int64)
    mat[:300] = mat[0]
    order, nodes = negatives.Tree.grown(mat)
    assert sorted(order) == list(range(2000))
    tree = negatives.Tree(mat[order], nodes)
    query = np.floor(256 * np.array(clustered(rng, 20))).astype(np.int64)
    search = negatives.Search(range(20), [0] * 20, query, [[0]] * 20, [[0]] * 20, 8, 3, True)
    upper, lower = search.bounds(tree, np.arange(len(nodes)), np.arange(20))
    true = query @ mat[order].T
    leaves = []
    for n, (lo, hi, child, children, centre, _) in enumerate(nodes):
        lo, hi, child, children = int(lo), int(hi), int(child), int(children)
        assert lo <= centre < hi and (true[:, lo:hi] <= upper[:, n : n + 1]).all() and (true[:, lo:hi] >= lower[:, n : n + 1]).all()
        below = nodes[child : child + children]
        if children:
            assert below[0, 0] == lo and below[-1, 1] == hi and (below[1:, 0] == below[:-1, 1]).all() and centre in below[:, 4]
        else:
            leaves.append((lo, hi))
            assert hi - lo <= negatives.LEAF or (mat[order[lo:hi]] == mat[order[lo]]).all()
    assert sorted(leaves)[0][0] == 0 and sum(b - a for a, b in leaves) == 2000


def test_search_skips_what_cannot_count():
    rng = np.random.RandomState(2)
    mat = np.floor(256 * np.array(clustered(rng, 4000))).astype(np.int64)
    order, nodes = negatives.Tree.grown(mat)
    tree = negatives.Tree(mat[order], nodes)
    whole = [[negatives.LOWEST]] * 30, [[negatives.HIGHEST]] * 30
    search = negatives.Search(range(-30, 0), [1] * 30, mat[:30], *whole, 8, 5, True)
    search.run(tree, order, order, np.ones(4000, np.int64))
    true = -np.sort(-(mat[:30] @ mat.T), 1)[:, :5]
    assert (search.score == true).all() and search.scored < 0.5 * 30 * 4000
