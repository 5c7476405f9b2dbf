"""Links of vectors against brute force, their recall, and the bounds the search relies on."""

import numpy as np
import pyarrow as pa
import pytest

from barloom.llm import veclinks


def usable(v):
    return v is not None and all(x is not None and np.isfinite(x) for x in v) and any(v)


def brute(rows, least=0.9):
    """(links of each row, least id reached)."""
    links = {i: set() for i in range(len(rows))}
    ok = [i for i, (_, v) in enumerate(rows) if usable(v)]
    for i in ok:
        for j in ok:
            a, b = rows[i][1], rows[j][1]
            if i != j and len(a) == len(b):
                a, b = np.array(a, np.float64), np.array(b, np.float64)
                a, b = a / np.abs(a).max(), b / np.abs(b).max()
                if a @ b / np.sqrt((a @ a) * (b @ b)) >= least:
                    links[i].add(j)
    out = []
    for i in links:
        seen, todo = {i}, [i]
        while todo:
            new = links[todo.pop()] - seen
            seen |= new
            todo += new
        out.append((len(links[i]), min((rows[j][0] for j in seen if rows[j][0] is not None), default=None)))
    return out


def near(rng, v, cos):
    """A vector at the given cosine of ``v``."""
    v = np.array(v) / np.linalg.norm(v)
    r = rng.normal(0, 1, len(v))
    r -= (r @ v) * v
    return cos * v + np.sqrt(1 - cos**2) * r / np.linalg.norm(r)


def planted(rng, n, dim=16):
    rows = [rng.normal(0, 1, dim) for _ in range(10 * n)]
    for i in range(2 * n):
        rows += [near(rng, rows[i], c) * rng.uniform(0.1, 9) for c in (0.999, 0.95, 0.905, 0.895)]
    rows += [near(rng, rows[-1], c) for c in rng.uniform(0.88, 1, 7 * n)]  # a wide crowd
    rows += [near(rng, rows[5], 0.9999) for _ in range(6 * n)] + [rows[6]] * (4 * n)  # close crowds
    rows += [near(rng, rows[5], 0.9001) for _ in range(n)]
    chain = rows[7]
    for _ in range(n):
        chain = near(rng, chain, 0.92)
        rows.append(chain)
    return [r.tolist() for r in rows]


@pytest.mark.parametrize("small", [False, True])
def test_links(spark, monkeypatch, small):
    """Also with lists and codes cut to a few rows."""
    if small:
        monkeypatch.setattr(veclinks, "LIST_PART", 7)
        monkeypatch.setattr(veclinks, "SAME_CODE", 9)
    rng = np.random.RandomState(4)
    vectors = planted(rng, 6)
    ids = rng.permutation(len(vectors)).tolist()
    rows = list(zip(ids, vectors, strict=True))
    assert len(rows) < 256  # as many lists as are probed at least, so nothing escapes
    rows += [(7, vectors[0]), (9000, None), (9001, [0.0] * 16), (9002, vectors[0][:15] + [None]), (9003, vectors[0][:15] + [float("nan")]), (9004, [float("inf")] * 16)]
    rows += [(9005, []), (None, vectors[1]), (None, [1e-200] * 3), (9006, [1e200] * 3), (9007, [1.0, 1.0]), (None, [5.0])]
    df = spark.createDataFrame([(i, v, 1, 2, n) for n, (i, v) in enumerate(rows)], "vec_id long, embedding array<double>, list int, node int, rid int")
    got = [tuple(r) for r in veclinks.vector_links(df).collect()]
    want = [(i, n, c, i == c) for (i, _), (n, c) in zip(rows, brute(rows), strict=True)]
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted(got, key=key) == sorted(want, key=key)
    assert veclinks.vector_links(df.limit(0)).count() == 0


def test_most_links_of_more_rows(spark):
    """More lists than are probed, a crowd across them, and many pairs at the threshold: links found are links."""
    vectors = planted(np.random.RandomState(9), 60)
    rows = list(enumerate(vectors))
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {r.vec_id: r.n_links for r in veclinks.vector_links(df).collect()}
    y = veclinks._unit(np.array(vectors))
    true = (y @ y.T >= 0.9).sum(1) - 1
    assert all(got[i] <= true[i] for i in got) and sum(got.values()) >= 0.99 * true.sum()


def test_recall_at_the_threshold():
    """Pairs just above it, without any structure: the lists probed hold nearly all."""
    rng = np.random.RandomState(7)
    x = rng.normal(0, 1, (20_000, 64))
    pairs = np.array([near(rng, v, c) for v, c in zip(x[:3000], rng.uniform(0.9, 0.92, 3000), strict=True)])
    model = veclinks.Quantiser.fitted(veclinks._unit(x[: 64 * 150]), 150)
    a, b = (model.coded(veclinks._unit(y))[0] for y in (x[:3000], pairs))
    swap = a[:, 0] > b[:, 0]
    asks, home = np.where(swap[:, None], b, a), np.where(swap, a[:, 0], b[:, 0])
    recall = (asks == home[:, None]).any(1).mean()
    print("recall at cosines of 0.90 to 0.92:", recall)
    assert recall >= 0.93


def test_table_distances_bound_true_ones():
    rng = np.random.RandomState(1)
    y = veclinks._unit(rng.normal(0, 1, (500, 20)))
    model = veclinks.Quantiser.fitted(y[:300], 5)
    probes, code, error = model.coded(y)
    for k in range(5):
        rows = np.flatnonzero(probes[:, 0] == k)
        true = np.sqrt(((y[:, None] - y[None, rows]) ** 2).sum(2))
        table = model.distances(y, k, code[rows])
        assert (true >= table - error[rows] - 1e-6).all() and (true <= table + error[rows] + 1e-6).all()


def test_balls_and_skipping(monkeypatch):
    """Members of a ball are all linked; most pairs are never reranked."""
    monkeypatch.setattr(veclinks, "BALL", 32)
    rng = np.random.RandomState(2)
    x = [near(rng, [1.0] * 8, c) for c in rng.uniform(0.97, 1, 100)]
    batch = pa.RecordBatch.from_arrays(
        [pa.array(range(100)), pa.array(range(100)), pa.array([8] * 100, pa.int32()), pa.array([0] * 100, pa.int32()), pa.array([b"1"] * 100), pa.array([0.1] * 100)]
        + [pa.array([[0]] * 100, pa.list_(pa.int32())), pa.array(x), pa.array([0] * 100)],
        ["rid", "vec_id", "dim", "list", "code", "error", "probes", "vec", "salt"],
    )
    balls = [b for part in veclinks._balls(0.9)(iter(batch.slice(i, 10) for i in range(0, 100, 10))) for b in part.to_pylist()]
    assert sorted(r for b in balls for r in b["rids"]) == list(range(100)) and len(balls) < 60
    for b in balls:
        y = veclinks._unit(np.frombuffer(b["mat"]).reshape(-1, 8))
        assert len(y) <= 32 and (y @ y.T).min() >= 0.9 and np.arccos(min(1, (y @ y[0]).min())) <= b["radius"] + 1e-7
    y = rng.normal(0, 1, (3000, 32))
    model = veclinks.Quantiser.fitted(veclinks._unit(y), 1)
    _, code, error = model.coded(veclinks._unit(y))
    n = np.arange(3000)
    nodes = veclinks.Nodes(n, code, error, np.zeros(3000), [n[i : i + 1] for i in n], [v.tobytes() for v in y], 32, np.float64)
    cell = veclinks.Cell(model, 0, nodes, 0.9)
    cell.meet(nodes, True, True)
    assert cell.reranked < 0.05 * cell.met
