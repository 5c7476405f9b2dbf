"""Decision trees, forests and boosted stumps, one model per symbol.

A symbol has at most 121 samples, a proven bound, so its samples travel as one row and its trees
grow in one Arrow-batched pass: one shuffle by symbol, whatever the depth and the number of trees.
Every cut of every feature of a node is tried at once, from sums over its samples in the order of
each feature.

A model row holds the tree as a map from node number to its cut or its share of label 1;
node k has the children 2k (value at most the threshold) and 2k+1.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import md5

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.schema import CODE, DATE, FEATURE_LENGTH
from barloom.session import spread

TREE = "tree"
DEPTH = 5
NODES = "map<bigint,struct<f:int,cut:double,share:double>>"
#: Mean shares of a forest are compared with one half up to the last bits of their sum.
EVEN = 0.5 + 1e-12


def grown(x: np.ndarray, y: np.ndarray, w: np.ndarray, depth: int, draw=None) -> dict[int, tuple]:
    """Nodes ``(feature, cut, share)`` of one tree; a leaf has a share only.

    The best cut leaves the purest sides; of equal ones the first feature's lowest counts. With
    ``draw``, a node looks at the features in the order ``draw(node)``, and at the next one only
    while those before allow no cut.
    """
    nodes: dict[int, tuple] = {}
    keep = np.flatnonzero(w > 0)
    todo = [(1, keep)] if len(keep) else []
    while todo:
        node, rows = todo.pop()
        wy = w[rows] * y[rows]
        tn, tp = w[rows].sum(), wy.sum()
        best = None
        if node < 2**depth and 0 < tp < tn:
            here = w[rows]
            for looked in [range(x.shape[1])] if draw is None else ([f] for f in draw(node)):
                v, gain = _gains(x[rows] if draw is None else x[rows, looked[0]][:, None], here, wy, tn, tp)
                k = int(gain.max(axis=0).argmax())
                at = int(gain[:, k].argmax())
                if gain[at, k] > -np.inf:
                    best = looked[k], (v[at, k] + v[at + 1, k]) / 2.0
                    break
        if best is None:
            nodes[node] = (None, None, float(tp / tn))
            continue
        nodes[node] = (*best, None)
        right = x[rows, best[0]] > best[1]
        todo += [(2 * node, rows[~right]), (2 * node + 1, rows[right])]
    return nodes


def _gains(x: np.ndarray, w: np.ndarray, wy: np.ndarray, tn: float, tp: float) -> tuple[np.ndarray, np.ndarray]:
    """Each column's values in order, and the gain of a cut after each but the last; -inf between equal ones."""
    order = np.argsort(x, axis=0, kind="stable")
    v = np.take_along_axis(x, order, axis=0)
    n, p = np.cumsum(w[order], axis=0)[:-1], np.cumsum(wy[order], axis=0)[:-1]
    rn, rp = tn - n, tp - p
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = (p * p + (n - p) * (n - p)) / n + (rp * rp + (rn - rp) * (rn - rp)) / rn
    return v, np.where(v[1:] > v[:-1], gain, -np.inf)


def drawn_order(code: str, tree: int, node: int, seed: int) -> list[int]:
    """Features in the order of two digits each of a digest, the larger first."""
    digits = md5(f"{code}|{tree}|{node}|{seed}".encode()).hexdigest()
    return sorted(range(FEATURE_LENGTH), key=lambda f: (digits[2 * f : 2 * f + 2], f), reverse=True)


def _grow(depth: int, seed: int | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes, trees, models = [], [], []
            for k, code in enumerate(batch.column(CODE).to_pylist()):
                y = batch.column("y")[k].values.to_numpy().astype(np.float64)
                # Single precision values, as cuts are commonly searched on.
                x = batch.column("x")[k].values.to_numpy().astype(np.float32).astype(np.float64).reshape(len(y), -1)
                w = batch.column("w")[k].values.to_numpy().astype(np.float64).reshape(len(y), -1)
                for tree in range(w.shape[1]):
                    draw = None if seed is None else (lambda node, t=tree, c=code: drawn_order(c, t, node, seed))
                    nodes = grown(x, y, w[:, tree], depth, draw)
                    if nodes:
                        codes.append(code)
                        trees.append(tree)
                        models.append([(n, {"f": f, "cut": c, "share": s}) for n, (f, c, s) in sorted(nodes.items())])
            kind = pa.map_(pa.int64(), pa.struct([("f", pa.int32()), ("cut", pa.float64()), ("share", pa.float64())]))
            columns = [pa.array(codes, pa.string()), pa.array(trees, pa.int32()), pa.array(models, kind)]
            yield pa.RecordBatch.from_arrays(columns, [CODE, TREE, "nodes"])

    return run


def grow(samples: DataFrame, depth: int = DEPTH, one_feature_seed: int | None = None) -> DataFrame:
    """Model table ``(code, tree, nodes)`` from ``(code, weights, label, features)``, one weight for each tree.

    With ``one_feature_seed`` every node looks at one feature drawn at random, and at the
    next ones of its draw only while those so far allow no cut.
    """
    one = F.struct(F.col("label").cast("double").alias("y"), F.col("features").alias("x"), F.col("weights").alias("w"))
    packed = samples.groupBy(CODE).agg(F.collect_list(one).alias("s"))
    packed = packed.select(CODE, F.flatten("s.x").alias("x"), F.col("s.y").alias("y"), F.flatten("s.w").alias("w"))
    # Few bytes become much work, which merged partitions would leave to few tasks.
    return spread(packed, CODE).mapInArrow(_grow(depth, one_feature_seed), f"{CODE} string, {TREE} int, nodes {NODES}")


def tree_share(depth: int = DEPTH) -> Column:
    """Share of label 1 in the leaf a window falls into; needs ``nodes`` and ``features``."""
    x = F.transform("features", lambda v: v.cast("float").cast("double"))

    def descend(node: Column, _: Column) -> Column:
        at = F.element_at("nodes", node)
        right = (F.element_at(x, at["f"] + 1) > at["cut"]).cast("long")
        return F.when(at["f"].isNull(), node).otherwise(node * 2 + right)

    leaf = F.aggregate(F.sequence(F.lit(1), F.lit(depth)), F.lit(1).cast("long"), descend)
    return F.element_at("nodes", leaf)["share"]


def fit_tree(samples: DataFrame, depth: int = DEPTH) -> DataFrame:
    return grow(samples.withColumn("weights", F.array(F.lit(1.0))), depth)


def poisson_steps() -> list[str]:
    """The first eight digits of a digest beyond which a Poisson(1) draw is above 0, 1, 2, ..."""
    total, term, out = 0.0, float(np.exp(-1.0)), []
    for k in range(12):
        total += term
        out.append(f"{min(int(total * 2**32), 2**32 - 1):08x}")
        term /= k + 1
    return out


def fit_forest(samples: DataFrame, trees: int = 10, depth: int = DEPTH, seed: int = 7) -> DataFrame:
    """Bagged trees with one random feature per node.

    A sample's weight in a tree is a Poisson(1) draw, the distributed form of sampling with
    replacement. Draws are digests of key, tree and seed: the same on every retry.
    """

    def drawn(tree: int) -> Column:
        name = F.concat_ws("|", CODE, F.date_format(DATE, "yyyy-MM-dd"), F.lit(str(tree)), F.lit(str(seed)))
        return F.substring(F.md5(name.cast("binary")), 1, 8)

    def weight(digits: Column) -> Column:
        return sum(((digits > step).cast("double") for step in poisson_steps()), F.lit(0.0))

    # The digests are an array of their own: inside the steps each would be made again for every one.
    weights = F.transform(F.array(*[drawn(t) for t in range(trees)]), weight)
    return grow(samples.withColumn("weights", weights), depth, one_feature_seed=seed)


def classify_trees(model: DataFrame, windows: DataFrame) -> DataFrame:
    """Mean leaf share over the trees of a symbol; label 1 above one half."""
    scored = windows.join(model, CODE).withColumn("_share", tree_share())
    return scored.groupBy(CODE).agg(
        F.max(DATE).alias(DATE), (F.avg("_share") > EVEN).cast("int").alias("prediction")
    )


GAIN_DIGITS = 11
STUMPS = "array<struct<f:int,cut:double,below:double,above:double>>"


def _boost(rounds: int):
    eps = np.finfo(float).eps

    def fit(rows: pd.DataFrame) -> pd.DataFrame:
        x = np.stack(rows["features"].to_numpy()).astype(np.float32).astype(float)
        y = rows["label"].to_numpy(float)
        order = np.argsort(x, axis=0, kind="stable")
        ranked = np.take_along_axis(x, order, axis=0)
        gap = np.diff(ranked, axis=0) > 0
        w = np.full(len(y), 1.0 / len(y))
        stumps = []
        for _ in range(rounds):
            # Both sides are summed from their own end, as late weights differ by many powers.
            ws, ps = w[order], (w * y)[order]
            ln, lp = np.cumsum(ws, axis=0)[:-1], np.cumsum(ps, axis=0)[:-1]
            rn, rp = np.cumsum(ws[::-1], axis=0)[::-1][1:], np.cumsum(ps[::-1], axis=0)[::-1][1:]
            tn, tp = w.sum(), (w * y).sum()
            f, cut, below, above = 0, np.inf, tp / tn, tp / tn
            if gap.any() and 0 < tp < tn:
                gain = (lp**2 + (ln - lp) ** 2) / ln + (rp**2 + (rn - rp) ** 2) / rn
                # Equal cuts differ in their last bits; of these the first feature's lowest counts.
                gain = np.where(gap, np.round(gain, GAIN_DIGITS), -np.inf)
                f = int(gain.max(axis=0).argmax())
                at = int(gain[:, f].argmax())
                cut = (ranked[at, f] + ranked[at + 1, f]) / 2.0
                below, above = lp[at, f] / ln[at, f], rp[at, f] / rn[at, f]
            share = np.where(x[:, f] > cut, above, below)
            stumps.append((int(f), float(cut), float(below), float(above)))
            if w[(share > 0.5) != (y > 0.5)].sum() <= 0:
                break
            share = np.clip(share, eps, 1.0 - eps)
            w = w * np.exp(np.where(y > 0.5, -0.5, 0.5) * np.log(share / (1.0 - share)))
            w = w / w.sum()
        return pd.DataFrame({CODE: [rows[CODE].iloc[0]], "stumps": [stumps]})

    return fit


def fit_boosted(samples: DataFrame, rounds: int = 50) -> DataFrame:
    """Boosted one-cut trees with probability weights (the SAMME.R update), one row per symbol.

    The rounds depend on each other and reweight at most 121 samples of a symbol, a proven
    bound, so each symbol is one small grouped task rather than fifty shuffles.
    """
    rows = samples.select(CODE, "features", "label")
    return rows.groupBy(CODE).applyInPandas(_boost(rounds), f"{CODE} string, stumps {STUMPS}")


def classify_boosted(model: DataFrame, windows: DataFrame) -> DataFrame:
    eps = float(np.finfo(float).eps)

    def vote(total: Column, s: Column) -> Column:
        at = F.element_at("features", s["f"] + 1).cast("float").cast("double")
        share = F.greatest(F.least(F.when(at > s["cut"], s["above"]).otherwise(s["below"]), F.lit(1.0 - eps)), F.lit(eps))
        return total + F.log(share / (1.0 - share))

    score = F.aggregate("stumps", F.lit(0.0), vote)
    return windows.join(model, CODE).select(CODE, DATE, (score > 0).cast("int").alias("prediction"))
