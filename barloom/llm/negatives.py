"""Hard negatives by best-first search in cover trees.

Candidates are cut into blocks, and a tree is grown over each. A vector gets one more component,
so that all vectors of a block have the same norm; a larger inner product with an anchor, which
has a zero there, is then a smaller distance. A node keeps a centre, which is one of its points,
and the covering radius of its points around it; its children are centres far apart from each
other, the first being its own, until they cover the points at a fraction of the radius. From the
distance of a centre and the radius follow bounds of all inner products below a node.

A block of anchors goes down a tree together. The node with the highest bound comes first; an
anchor goes on only where the bounds of the node meet its window of scores and can beat the
worst result it holds. What is reached in the leaves is scored exactly, in integers. Positives
are such a search for the same label and an open window, negatives one for other labels and the
windows that the positives set. Each task hands on its best few for each anchor.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barloom.llm.common import parallelism, written

BLOCK, LEAF, FANOUT, SHRINK = 4096, 48, 16, 1.5
ANCHORS, CELLS_PER_TASK, MATRIX = 2048, 3, 1 << 21
LOWEST, HIGHEST = -(2**62), 2**62


def usable(vectors: DataFrame, scale: int, id_col: str, vec_col: str, label_col: str) -> DataFrame:
    """Rows ``(rid, vec_id, label, vec, dim)`` with integer components."""
    v = F.col(vec_col)
    whole = v.isNotNull() & ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == F.lit(float("inf"))))
    return (
        vectors.select(
            F.monotonically_increasing_id().alias("rid"),
            F.col(id_col).cast("long").alias("vec_id"),
            F.col(label_col).cast("long").alias("label"),
            F.when(whole, F.transform(v, lambda x: F.floor(x.cast("double") * scale))).alias("vec"),
        )
        .filter("vec is not null and vec_id is not null and label is not null")
        .withColumn("dim", F.size("vec"))
    )


class Tree:
    """A cover tree over the rows of an integer matrix. Points of a node are ``lo`` to ``hi``."""

    def __init__(self, mat: np.ndarray, nodes: np.ndarray):
        self.mat, self.nodes = mat, nodes
        self.points = mat.astype(np.float64)
        self.norm2 = float((self.points**2).sum(1).max(initial=0.0))
        self.size = float(np.abs(self.points).max(initial=0.0)) * mat.shape[1]

    @staticmethod
    def grown(mat: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The order of the points, and the nodes ``lo, hi, first child, children, centre, radius``."""
        x = mat.astype(np.float64)
        norm2 = (x**2).sum(1)
        x = np.hstack([x, np.sqrt(norm2.max(initial=0.0) - norm2)[:, None]])

        def away(rows: np.ndarray, c: int) -> np.ndarray:
            return np.sqrt(((x[rows] - x[c]) ** 2).sum(1))

        order = np.arange(len(x))
        root = int(((x - x.mean(0)) ** 2).sum(1).argmin())
        dist = away(order, root)
        nodes, todo = [[0, len(x), 0, 0, root, dist.max(initial=0.0)]], [(0, dist)]
        while todo:
            n, dist = todo.pop()
            lo, hi, _, _, centre, radius = nodes[n]
            if hi - lo <= LEAF or radius == 0:
                continue
            rows, nearest, centres = order[lo:hi].copy(), np.zeros(hi - lo, np.int64), [centre]
            while len(centres) < FANOUT and dist.max() > radius / SHRINK:
                c = int(rows[dist.argmax()])
                to_c = away(rows, c)
                closer = to_c < dist
                nearest[closer], dist = len(centres), np.minimum(dist, to_c)
                centres.append(c)
            by_centre = np.argsort(nearest, kind="stable")
            order[lo:hi], dist = rows[by_centre], dist[by_centre]
            ends = lo + np.searchsorted(nearest[by_centre], np.arange(len(centres) + 1))
            nodes[n][2:4] = len(nodes), len(centres)
            for c, a, b in zip(centres, ends[:-1], ends[1:], strict=True):
                todo.append((len(nodes), dist[a - lo : b - lo]))
                nodes.append([int(a), int(b), 0, 0, c, float(dist[a - lo : b - lo].max())])
        place = np.empty(len(x), np.int64)
        place[order] = np.arange(len(x))
        nodes = np.array(nodes, np.float64)
        nodes[:, 4] = place[nodes[:, 4].astype(np.int64)]
        return order, nodes


class Search:
    """The best ``k`` rows found so far for every seeker: an anchor with a window of scores."""

    def __init__(self, rid: list, label: list, vec: list, lo: list, hi: list, dim: int, k: int, same: bool):
        self.rid, self.label = np.array(rid, np.int64), np.array(label, np.int64)
        self.whole = np.array(vec, np.int64).reshape(len(rid), dim)
        self.query = self.whole.astype(np.float64)
        self.norm2 = (self.query**2).sum(1)
        self.size = float(np.abs(self.query).max(initial=0.0))
        each = [len(x) for x in lo]
        self.of = np.repeat(np.arange(len(rid)), each)
        self.nth = np.concatenate([np.arange(n) for n in each]) if each else np.zeros(0, np.int64)
        self.lo, self.hi = (np.array([y for x in w for y in x], np.int64) for w in (lo, hi))
        self.k, self.same, self.scored = k, same, 0
        shape = (len(self.of), k)
        self.score, self.ids, self.rows = np.full(shape, LOWEST), np.zeros(shape, np.int64), np.zeros(shape, np.int64)

    def least(self, s: np.ndarray) -> np.ndarray:
        """What a score must reach to count: the window, or the worst of ``k`` results."""
        return np.maximum(self.lo[s], self.score[s, -1])

    def bounds(self, tree: Tree, nodes: np.ndarray, a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bounds of the inner products of anchors with all points below each node."""
        whole = (self.norm2[a] + tree.norm2)[:, None]
        dist = np.sqrt(np.maximum(whole - 2 * (self.query[a] @ tree.points[tree.nodes[nodes, 4].astype(np.int64)].T), 0))
        slack = 4e-6 * whole + 1e-6  # a distance near zero is right to the root of the precision only
        radius = tree.nodes[nodes, 5]
        return (whole - np.maximum(dist - radius, 0) ** 2) / 2 + slack, (whole - (dist + radius) ** 2) / 2 - slack

    def run(self, tree: Tree, rids: np.ndarray, ids: np.ndarray, labels: np.ndarray) -> None:
        for start in range(0, len(self.of), MATRIX // 64):
            self._descend(tree, rids, ids, labels, np.arange(start, min(len(self.of), start + MATRIX // 64)))

    def _descend(self, tree: Tree, rids: np.ndarray, ids: np.ndarray, labels: np.ndarray, seekers: np.ndarray) -> None:
        heap, pushed = [(0.0, 0, 0, seekers, np.full(len(seekers), np.inf))], 0
        while heap:
            _, _, n, s, most = heapq.heappop(heap)
            s = s[most >= self.least(s)]
            if not len(s):
                continue
            lo, hi, child, children = tree.nodes[n, :4].astype(np.int64)
            if not children:
                step = max(1, MATRIX // max(1, hi - lo))
                for k in range(0, len(s), step):
                    self._verify(tree, s[k : k + step], rids[lo:hi], ids[lo:hi], labels[lo:hi], slice(lo, hi))
                continue
            below = np.arange(child, child + children)
            a, at = np.unique(self.of[s], return_inverse=True)
            upper, lower = self.bounds(tree, below, a)
            wanted = (upper[at] >= self.least(s)[:, None]) & (lower[at] <= self.hi[s][:, None])
            for j, c in enumerate(below):
                own = np.flatnonzero(wanted[:, j])
                if len(own):
                    pushed += 1
                    most = upper[at[own], j]
                    heapq.heappush(heap, (-float(most.max()), pushed, int(c), s[own], most))

    def _verify(self, tree: Tree, s: np.ndarray, rids: np.ndarray, ids: np.ndarray, labels: np.ndarray, at: slice) -> None:
        a, of = np.unique(self.of[s], return_inverse=True)
        if self.size * tree.size < 2**52:
            score = (self.query[a] @ tree.points[at].T).astype(np.int64)
        else:
            score = self.whole[a] @ tree.mat[at].T.astype(np.int64)
        self.scored += score.size
        allowed = (self.label[a][:, None] == labels) == self.same
        allowed &= self.rid[a][:, None] != rids
        score = score[of]
        hit, j = np.nonzero(allowed[of] & (score >= self.least(s)[:, None]) & (score <= self.hi[s][:, None]))
        if not len(hit):
            return
        who = np.unique(hit)
        held = np.repeat(who, self.k)
        seeker = np.concatenate([held, hit])
        found = np.concatenate([self.score[s[who]].ravel(), score[hit, j]])
        vec_id = np.concatenate([self.ids[s[who]].ravel(), ids[j]])
        row = np.concatenate([self.rows[s[who]].ravel(), rids[j]])
        order = np.lexsort((row, vec_id, -found, seeker))
        starts = np.searchsorted(seeker[order], who)
        best = order[starts[:, None] + np.arange(self.k)]
        self.score[s[who]], self.ids[s[who]], self.rows[s[who]] = found[best], vec_id[best], row[best]

    def results(self) -> pa.RecordBatch:
        s, k = np.nonzero(self.score > LOWEST)
        columns = [self.rid[self.of[s]], self.nth[s].astype(np.int64), self.rows[s, k], self.ids[s, k], self.score[s, k]]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["anchor", "nth", "rid", "vec_id", "score"])


TREE = "rids binary, ids binary, labels binary, mat binary, nodes binary"


def _grown(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of rows of one length, each with its tree; components in two bytes where that is enough."""
    held: dict[int, list] = {}

    def block(dim: int) -> pa.RecordBatch:
        rid, vid, label, vec = (np.concatenate(x) for x in zip(*held.pop(dim), strict=True))
        order, nodes = Tree.grown(vec)
        small = np.abs(vec).max(initial=0) < 2**15
        mat = vec[order].astype(np.int16 if small else np.int64)
        blobs = [x.tobytes() for x in (rid[order], vid[order], label[order], mat, nodes)]
        names = ["dim", "part", *(f.split()[0] for f in TREE.split(", "))]
        types = [pa.int32(), pa.int64(), *[pa.binary()] * 5]
        return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip([dim, int(rid[0]), *blobs], types, strict=True)], names)

    for batch in batches:
        vec = batch.column("vec")
        lengths = np.diff(vec.offsets.to_numpy())
        flat, ends = vec.flatten().to_numpy(), np.concatenate([[0], np.cumsum(lengths)])
        rid, vid, label = (batch.column(c).to_numpy() for c in ("rid", "vec_id", "label"))
        for dim in np.unique(lengths):
            rows = np.flatnonzero(lengths == dim)
            for part in np.array_split(rows, -(-len(rows) // BLOCK)):
                at = (ends[part][:, None] + np.arange(dim)[None, :]).astype(np.int64)
                held.setdefault(int(dim), []).append((rid[part], vid[part], label[part], flat[at].reshape(len(part), dim)))
                if sum(len(x[0]) for x in held[int(dim)]) >= BLOCK:
                    yield block(int(dim))
    for dim in list(held):
        yield block(dim)


def _searched(k: int, same: bool):
    """In every cell the anchors come first, then the trees that they go down."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, anchors, search = None, [], None
        for batch in batches:
            for row in range(batch.num_rows):
                here = (batch.column("cell")[row].as_py(), batch.column("dim")[row].as_py())
                if here != key:
                    if search:
                        yield search.results()
                    key, anchors, search = here, [], None
                if batch.column("kind")[row].as_py() == 0:
                    anchors.append([batch.column(c)[row].as_py() for c in ("rid", "label", "vec", "lo", "hi")])
                    continue
                if search is None:
                    if not anchors:
                        continue
                    search = Search(*(list(x) for x in zip(*anchors, strict=True)), here[1], k, same)
                rids, ids, labels = (np.frombuffer(batch.column(c)[row].as_buffer(), np.int64) for c in ("rids", "ids", "labels"))
                blob = batch.column("mat")[row].as_buffer()
                kind = np.int16 if blob.size == 2 * len(rids) * here[1] else np.int64
                mat = np.frombuffer(blob, kind).reshape(len(rids), here[1])
                nodes = np.frombuffer(batch.column("nodes")[row].as_buffer(), np.float64).reshape(-1, 6)
                search.run(Tree(mat, nodes), rids, ids, labels)
        if search:
            yield search.results()

    return run


def _best(trees: DataFrame, anchors: DataFrame, blocks: int, k: int, same: bool) -> DataFrame:
    """``(anchor, nth, rid, vec_id, score, rank)``: the best ``k`` of each anchor's ``nth`` window."""
    n = parallelism(trees.sparkSession)
    shares = max(1, -(-CELLS_PER_TASK * n // blocks))

    def over(times: int) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("long"), F.lit(times - 1).cast("long")))

    asked = anchors.withColumn("share", over(shares)).select(
        (F.col("block") * shares + F.col("share")).alias("cell"), "dim", F.lit(0).alias("kind"), "rid", "label", "vec", "lo", "hi"
    )
    grid = trees.withColumn("block", over(blocks)).select(
        (F.col("block") * shares + F.pmod(F.xxhash64("part"), F.lit(shares))).alias("cell"), "dim", F.lit(1).alias("kind"), *(f.split()[0] for f in TREE.split(", "))
    )
    met = asked.unionByName(grid, allowMissingColumns=True).repartition(min(n, blocks * shares), "cell", "dim")
    found = met.sortWithinPartitions("cell", "dim", "kind").mapInArrow(
        _searched(k, same), "anchor long, nth long, rid long, vec_id long, score long"
    )
    order = Window.partitionBy("anchor", "nth").orderBy(F.col("score").desc(), "vec_id", "rid")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def hard_negatives(
    vectors: DataFrame,
    is_anchor: Column,
    positives: int = 5,
    negatives: int = 3,
    low: int = 50,
    high: int = 95,
    scale: int = 256,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    label_col: str = "label",
) -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)``.

    Components become ``floor(scale * x)``; a score is the integer inner product with the anchor,
    higher first, ties by the smaller id. ``is_anchor`` picks the anchors by the column ``vec_id``.
    An anchor's positives are its first ``positives`` other rows of its label; for each of them
    come the first ``negatives`` rows of other labels whose score is between ``low`` and ``high``
    percent of the positive's. Fewer are returned where there are no more.

    Rows with a null id or label, a null vector or any null or non-finite component take no part;
    vectors of different lengths do not meet. Rows that repeat an id are rows of their own. An
    empty table gives an empty result. Other columns are ignored.
    """
    rows = written(usable(vectors, scale, id_col, vec_col, label_col), "vectors")
    chosen = rows.filter(is_anchor)
    blocks = max(1, -(-chosen.count() // ANCHORS))
    trees = written(rows.mapInArrow(_grown, f"dim int, part long, {TREE}"), "trees")
    anchors = chosen.withColumn("block", F.pmod(F.xxhash64("rid"), F.lit(blocks)))
    ends = [F.array(F.lit(x).cast("long")).alias(c) for c, x in (("lo", LOWEST), ("hi", HIGHEST))]
    first = _best(trees, anchors.select("*", *ends), blocks, positives, True)
    near = written(first.select("anchor", (F.col("rank") - 1).cast("long").alias("nth"), F.col("vec_id").alias("positive_id"), "score"), "positives")

    score = F.col("score")
    window = [F.expr(f"-floor(cast(score as decimal(20,0)) * -{low} / 100)").alias("lo"), F.expr(f"floor(cast(score as decimal(20,0)) * {high} / 100)").alias("hi")]
    windows = (
        near.select("anchor", "nth", *(w.cast("long").alias(c) for w, c in zip(window, ("lo", "hi"), strict=True)))
        .groupBy(F.col("anchor").alias("rid"))
        .agg(F.sort_array(F.collect_list(F.struct("nth", "lo", "hi"))).alias("w"))
        .select("rid", F.col("w.lo").alias("lo"), F.col("w.hi").alias("hi"))
    )
    found = _best(trees, anchors.join(windows, "rid"), blocks, negatives, False)
    ids = chosen.select(F.col("rid").alias("anchor"), F.col("vec_id").alias("anchor_id"))
    return (
        found.select("anchor", "nth", "rank", F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"))
        .join(near.select("anchor", "nth", "positive_id", score.alias("positive_score")), ["anchor", "nth"])
        .join(ids, "anchor")
        .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    )
