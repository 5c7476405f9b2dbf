"""Near-duplicate vectors by product quantisation.

Unit vectors go to the nearest of a number of coarse centroids, and what is left of them is coded
in subspaces, 256 code words each. A query reads, in every list that it probes, its distances to
all coded vectors from one small table for each subspace. A vector lies no farther from its code
than the error noted when it was coded, so a candidate whose table distance exceeds the threshold
by more than this error cannot be a link; all others are reranked by their exact cosine in
double precision. What decides recall is only which lists are probed: a vector asks the lists of
its ``PROBES`` nearest centroids that come at or after its own, so each pair of lists meets once.

Copies would make every pair of a large group. Vectors of one code are therefore gathered into
balls: a first vector and others within half the threshold's angle of it, which are all linked
with each other without being compared. Two balls are compared by their first vectors, and the
angles decide for all their members at once; only where these leave it open are the members
compared, as a block. Tasks return counts of links and a spanning forest of them, never the pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType

from barloom.llm.common import parallelism, written
from barloom.llm.components import components

#: Lists are the root of the number of vectors, up to MOST_LISTS; they are fitted on PER_LIST vectors each, SAMPLE at most.
MOST_LISTS, PER_LIST, SAMPLE = 16384, 64, 65_536
SUBSPACES, WORDS, PROBES, ROUNDS, SEED = 8, 256, 16, 8, 5
#: Most members of a ball, of one code in one task, and of a list in one task; entries of a matrix at once.
BALL, SAME_CODE, LIST_PART, MATRIX = 512, 4096, 32_768, 1 << 20
MARGIN = 1e-7


def _means(x: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray:
    """Centroids of ``x`` by Lloyd's rounds; a centroid without points stays where it is."""
    c = x[rng.permutation(len(x))[: min(k, len(x))]].copy()
    for _ in range(ROUNDS):
        near = _nearest(x, c, 1)[:, 0]
        n, total = np.bincount(near, minlength=len(c)), np.zeros_like(c)
        np.add.at(total, near, x)
        c[n > 0] = total[n > 0] / n[n > 0, None]
    return c


def _nearest(x: np.ndarray, c: np.ndarray, k: int) -> np.ndarray:
    """The ``k`` nearest centroids of every row, nearest first."""
    out, k = np.empty((len(x), min(k, len(c))), np.int64), min(k, len(c))
    step = max(1, 4 * MATRIX // len(c))
    for i in range(0, len(x), step):
        far = (c**2).sum(1) - 2 * (x[i : i + step] @ c.T)
        if k == 1:
            out[i : i + step, 0] = far.argmin(1)
        else:
            at = np.argpartition(far, k - 1, axis=1)[:, :k]
            out[i : i + step] = np.take_along_axis(at, np.take_along_axis(far, at, 1).argsort(1, kind="stable"), 1)
    return out


@dataclass
class Quantiser:
    """Coarse centroids and the code words of each subspace of what they leave."""

    coarse: np.ndarray
    words: list[np.ndarray]

    @staticmethod
    def fitted(sample: np.ndarray, lists: int) -> Quantiser:
        rng = np.random.default_rng(SEED)
        coarse = _means(sample, lists, rng)
        rest = sample - coarse[_nearest(sample, coarse, 1)[:, 0]]
        return Quantiser(coarse, [_means(s, WORDS, rng) for s in np.array_split(rest, min(SUBSPACES, rest.shape[1]), axis=1)])

    def coded(self, y: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The lists a vector probes (its own first), its code, and the distance from what the code stands for."""
        probes = _nearest(y, self.coarse, PROBES)
        rest = y - self.coarse[probes[:, 0]]
        code, error = np.empty((len(y), len(self.words)), np.uint8), np.zeros(len(y))
        for m, sub in enumerate(np.array_split(rest, len(self.words), axis=1)):
            code[:, m] = _nearest(sub, self.words[m], 1)[:, 0]
            error += ((sub - self.words[m][code[:, m]]) ** 2).sum(1)
        return probes, code, np.sqrt(error)

    def distances(self, y: np.ndarray, in_list: int, code: np.ndarray) -> np.ndarray:
        """From every query to every code of a list, by one table for each subspace."""
        out = np.zeros((len(y), len(code)))
        for m, sub in enumerate(np.array_split(y - self.coarse[in_list], len(self.words), axis=1)):
            w = self.words[m]
            table = (sub**2).sum(1)[:, None] + (w**2).sum(1) - 2 * (sub @ w.T)
            out += table[:, code[:, m]]
        return np.sqrt(np.maximum(out, 0))


def _unit(raw: np.ndarray) -> np.ndarray:
    raw = raw.astype(np.float64)
    raw = raw / np.abs(raw).max(1, keepdims=True)  # so that squares neither vanish nor overflow
    return raw / np.sqrt((raw**2).sum(1, keepdims=True))


def _by_length(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Rows of a batch by the length of their vector."""
    vec = batch.column("vec")
    lengths = np.diff(vec.offsets.to_numpy())
    flat, ends = vec.flatten().to_numpy(zero_copy_only=False), np.concatenate([[0], np.cumsum(lengths)])
    for dim in np.unique(lengths):
        rows = np.flatnonzero(lengths == dim)
        yield int(dim), rows, flat[(ends[rows][:, None] + np.arange(dim)).astype(np.int64)].reshape(len(rows), dim)


CODED = "rid long, vec_id long, dim int, list int, code binary, error double, probes array<int>, vec {}"


def _coded(models: dict[int, Quantiser]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for dim, rows, raw in _by_length(batch):
                # A length that the sample does not hold has one list and no codes: its vectors are all compared.
                model = models.get(dim) or Quantiser(np.zeros((1, dim)), [np.zeros((1, dim))])
                probes, code, error = model.coded(_unit(raw))
                own = batch.take(pa.array(rows))
                columns = [
                    own.column("rid"),
                    own.column("vec_id"),
                    pa.array(np.full(len(rows), dim, np.int32)),
                    pa.array(probes[:, 0].astype(np.int32)),
                    pa.array([c.tobytes() for c in code], pa.binary()),
                    pa.array(error),
                    pa.array(list(probes.astype(np.int32)), pa.list_(pa.int32())),
                    own.column("vec"),
                ]
                yield pa.RecordBatch.from_arrays(columns, [f.split()[0] for f in CODED.split(", ")])

    return run


NODES = "node long, dim int, list int, code binary, error double, probes array<int>, radius double, rids array<long>, least long, mat binary"


def _balls(least_cos: float):
    """Vectors of one code, which follow each other, gathered into balls."""
    half = float(np.cos(np.arccos(least_cos) / 2)) + MARGIN

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            table = pa.Table.from_batches(held)
            key = [table.column(c).to_pylist() for c in ("dim", "list", "code", "salt")]
            key = list(zip(*key, strict=True))
            cut = len(key) - 1
            while cut and key[cut - 1] == key[-1]:
                cut -= 1
            if len(key) - cut >= BALL:  # the last code is long enough to be cut here
                cut = len(key)
            if cut:
                yield from gathered(table.slice(0, cut), key[:cut])
            held = table.slice(cut).to_batches() if cut < len(key) else []
        if held:
            table = pa.Table.from_batches(held)
            yield from gathered(table, list(zip(*(table.column(c).to_pylist() for c in ("dim", "list", "code", "salt")), strict=True)))

    def gathered(table: pa.Table, key: list) -> Iterator[pa.RecordBatch]:
        table = table.combine_chunks()
        batch = table.to_batches()[0]
        starts = [i for i in range(len(key)) if not i or key[i] != key[i - 1]]
        first, members, radius = [], [], []
        units = {int(r): (dim, raw) for dim, rows, raw in _by_length(batch) for r, raw in zip(rows, raw, strict=True)}
        for a, b in zip(starts, [*starts[1:], len(key)], strict=True):
            for lo in range(a, b, BALL):
                rows = np.arange(lo, min(b, lo + BALL))
                y = _unit(np.stack([units[r][1] for r in rows])) if len(rows) > 1 else None
                while len(rows):
                    if y is None or len(rows) == 1:
                        near, cos = np.ones(1, bool), np.ones(1)
                    else:
                        cos = y @ y[0]
                        near = cos >= half
                        near[0] = True
                    first.append(int(rows[0]))
                    members.append(rows[near])
                    radius.append(float(np.arccos(np.clip(cos[near].min(), -1, 1))) if near.sum() > 1 else 0.0)
                    rows, y = rows[~near], y[~near] if y is not None else None
        rids = batch.column("rid").to_numpy()
        ids = batch.column("vec_id").to_pylist()
        at = pa.array(first)
        own = [batch.column(c).take(at) for c in ("rid", "dim", "list", "code", "error", "probes")]
        least = [min((ids[r] for r in m if ids[r] is not None), default=None) for m in members]
        mats = [np.stack([units[r][1] for r in m]).tobytes() for m in members]
        columns = [*own, pa.array(radius), pa.array([rids[m] for m in members], pa.list_(pa.int64())), pa.array(least, pa.int64()), pa.array(mats, pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, [f.split()[0] for f in NODES.split(", ")])

    return run


@dataclass
class Nodes:
    """Balls as arrays, with the first vector of each and the members' vectors behind it."""

    node: np.ndarray
    code: np.ndarray
    error: np.ndarray
    radius: np.ndarray
    rids: list
    mats: list
    dim: int
    kind: type
    size: np.ndarray = field(init=False)
    first: np.ndarray = field(init=False)

    def __post_init__(self):
        self.size = np.array([len(r) for r in self.rids], np.int64)
        raw = np.stack([np.frombuffer(m, self.kind, self.dim) for m in self.mats]) if self.mats else np.zeros((0, self.dim))
        self.first = _unit(raw) if len(raw) else raw

    @staticmethod
    def of(batch: pa.RecordBatch, dim: int, kind: type) -> Nodes:
        code = np.frombuffer(b"".join(batch.column("code").to_pylist()), np.uint8).reshape(batch.num_rows, -1)
        rids = [r.values.to_numpy() for r in batch.column("rids")]
        mats = [m.as_buffer() for m in batch.column("mat")]
        n, e, r = (batch.column(c).to_numpy() for c in ("node", "error", "radius"))
        return Nodes(n, code, e, r, rids, mats, dim, kind)

    def members(self, i: int) -> np.ndarray:
        return _unit(np.frombuffer(self.mats[i], self.kind).reshape(-1, self.dim))


class Cell:
    """Part of a list, met by the nodes that probe it."""

    def __init__(self, model: Quantiser, in_list: int, data: Nodes, least_cos: float):
        self.model, self.in_list, self.data = model, in_list, data
        self.cos, self.angle = least_cos, float(np.arccos(least_cos))
        self.count, self.group = np.zeros(len(data.node), np.int64), np.arange(len(data.node))
        self.counts, self.edges, self.reranked, self.met = [], [], 0, 0

    def meet(self, q: Nodes, same_list: bool, same: bool = False) -> None:
        """Compare nodes with those of the cell; in its own list a node meets only those of larger id."""
        step = max(1, MATRIX // max(1, len(self.data.node)))
        for i in range(0, len(q.node), step):
            rows = np.arange(i, min(len(q.node), i + step))
            reach = np.sqrt(2 - 2 * self.cos) + self.data.error + 2 * np.sin(self.data.radius / 2) + 1e-6
            own = 2 * np.sin(q.radius[rows] / 2)
            maybe = self.model.distances(q.first[rows], self.in_list, self.data.code) <= reach + own[:, None]
            if same_list:
                maybe &= q.node[rows][:, None] < self.data.node
            self.met += maybe.size
            a, x = np.nonzero(maybe)
            for k in range(0, len(a), MATRIX // 16):
                self._rerank(q, rows[a[k : k + MATRIX // 16]], x[k : k + MATRIX // 16], same)

    def _rerank(self, q: Nodes, a: np.ndarray, x: np.ndarray, same: bool) -> None:
        d = self.data
        self.reranked += len(a)
        cos = (q.first[a] * d.first[x]).sum(1)
        wide = q.radius[a] + d.radius[x]
        single = (q.size[a] == 1) & (d.size[x] == 1)
        angle = np.arccos(np.clip(cos, -1, 1))
        linked = np.where(single, cos >= self.cos, angle + wide <= self.angle - MARGIN)
        open_ = ~single & ~linked & (angle - wide <= self.angle + MARGIN)
        asked = np.zeros(len(q.node), np.int64)
        np.add.at(asked, a[linked], d.size[x[linked]])
        np.add.at(self.count, x[linked], q.size[a[linked]])
        at = np.flatnonzero(asked)
        self.counts += zip(q.node[at].tolist(), [0] * len(at), asked[at].tolist(), strict=True)
        for i in np.flatnonzero(open_):
            both = q.members(a[i]) @ d.members(x[i]).T >= self.cos
            for rids, n in ((q.rids[a[i]], both.sum(1)), (d.rids[x[i]], both.sum(0))):
                some = np.flatnonzero(n)
                self.counts += zip(rids[some].tolist(), [1] * len(some), n[some].tolist(), strict=True)
            linked[i] = both.any()
        a, x = a[linked], x[linked]
        if not len(a):
            return
        starts = np.flatnonzero(np.concatenate([[True], a[1:] != a[:-1]]))
        for i, j in zip(starts, [*starts[1:], len(a)], strict=True):
            groups = np.unique(self.group[x[i:j]])
            to = int(d.node[groups[0]])
            if same:
                groups = np.unique(np.append(groups, self.group[a[i]]))
                to = int(d.node[groups[0]])
            else:
                self.edges.append((int(q.node[a[i]]), to))
            if len(groups) > 1:
                self.edges += [(int(d.node[g]), to) for g in groups[1:]]
                self.group[np.isin(self.group, groups)] = groups[0]

    def results(self) -> Iterator[pa.RecordBatch]:
        at = np.flatnonzero(self.count)
        counts = [*self.counts, *zip(self.data.node[at].tolist(), [0] * len(at), self.count[at].tolist(), strict=True)]
        rows = [(k, a, n) for a, k, n in counts] + [(2, a, b) for a, b in self.edges]
        self.counts, self.edges, self.count = [], [], np.zeros_like(self.count)
        columns = list(zip(*rows, strict=True)) if rows else [[], [], []]
        yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int32()), *(pa.array(c, pa.int64()) for c in columns[1:])], ["kind", "a", "b"])


def _linked(models: dict[int, Quantiser], least_cos: float, kind: type):
    """In every cell the nodes of the list come first, then those that probe it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, data, cell = None, [], None

        def opened() -> Cell | None:
            if not data:
                return None
            dim, in_list, _ = key
            model = models.get(dim) or Quantiser(np.zeros((1, dim)), [np.zeros((1, dim))])
            nodes = Nodes.of(pa.Table.from_batches(data).combine_chunks().to_batches()[0], dim, kind)
            new = Cell(model, in_list, nodes, least_cos)
            new.meet(nodes, True, True)
            return new

        for batch in batches:
            keys = list(zip(*(batch.column(c).to_pylist() for c in ("dim", "in_list", "part")), strict=True))
            asks = batch.column("asks").to_numpy(zero_copy_only=False)
            cuts = [i for i in range(len(keys)) if not i or keys[i] != keys[i - 1] or asks[i] != asks[i - 1]]
            for a, b in zip(cuts, [*cuts[1:], len(keys)], strict=True):
                if keys[a] != key:
                    if cell or data:
                        cell = cell or opened()
                        yield from cell.results()
                    key, data, cell = keys[a], [], None
                piece = batch.slice(a, b - a)
                if not asks[a]:
                    data.append(piece)
                    continue
                cell = cell or opened()
                if cell:
                    own = piece.column("list").to_numpy() == key[1]
                    for at, same_list in ((np.flatnonzero(own), True), (np.flatnonzero(~own), False)):
                        if len(at):
                            cell.meet(Nodes.of(piece.take(pa.array(at)), key[0], kind), same_list)
                    yield from cell.results()
        if cell or data:
            yield from (cell or opened()).results()

    return run


def usable(vec: Column) -> Column:
    """Not null, without null or non-finite components, and not zero."""
    bad = F.exists(vec, lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == F.lit(float("inf"))))
    return vec.isNotNull() & ~bad & F.exists(vec, lambda x: x != 0)


def fitted(rows: DataFrame, total: int) -> dict[int, Quantiser]:
    """A quantiser for each length of vector, from the first rows in the order of a hash of their number."""
    lists = int(min(max(round(total**0.5), 1), MOST_LISTS))
    sample = rows.select("rid", "vec").orderBy(F.xxhash64("rid"), "rid").limit(min(SAMPLE, PER_LIST * lists)).toArrow()
    if not sample.num_rows:
        return {}
    batch = sample.combine_chunks().to_batches()[0]
    return {dim: Quantiser.fitted(_unit(raw), max(1, lists * len(at) // batch.num_rows)) for dim, at, raw in _by_length(batch)}


def vector_links(vectors: DataFrame, least_cos: float = 0.9, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """``(vec_id, n_links, component_id, kept)``, one row for each row of ``vectors``.

    Links are pairs found with a cosine, in double precision, of at least ``least_cos`` (above 0);
    ``n_links`` counts the other rows linked directly, ``component_id`` is the least id that can
    be reached, the row's own included, and ``kept`` says whether it is the row's own. Vectors
    that are null, zero or hold null or non-finite components link with nothing, nor do vectors
    of different lengths. Rows that repeat an id or a vector are rows of their own; a null id is
    never the least, and is the component's only where no other is. An empty table gives an
    empty result. Other columns are ignored.
    """
    spark = vectors.sparkSession
    n = parallelism(spark)
    element = vectors.schema[vec_col].dataType
    kind = np.float32 if isinstance(element, ArrayType) and isinstance(element.elementType, FloatType) else np.float64
    type_ = "array<float>" if kind is np.float32 else "array<double>"
    vec = F.col(vec_col).cast(type_)
    rows = written(
        vectors.select(F.monotonically_increasing_id().alias("rid"), F.col(id_col).cast("long").alias("vec_id"), F.when(usable(vec), vec).alias("vec")),
        "vectors",
    )
    whole = rows.filter("vec is not null")
    models = fitted(whole, whole.count())

    coded = written(whole.mapInArrow(_coded(models), CODED.format(type_)), "codes")
    code = ["dim", "list", "code"]
    common = coded.groupBy(*code).count().filter(F.col("count") > SAME_CODE)
    parts = F.coalesce(F.ceil(F.col("count") / SAME_CODE), F.lit(1))
    salted = coded.join(common, code, "left").withColumn("salt", F.pmod(F.xxhash64("rid"), parts)).drop("count")
    ordered = salted.repartition(n, *code, "salt").sortWithinPartitions(*code, "salt", "rid")
    nodes = written(ordered.mapInArrow(_balls(least_cos), NODES), "balls")

    sizes = {(r["dim"], r["list"]): r["count"] for r in nodes.groupBy("dim", "list").count().collect()}  # at most MOST_LISTS
    large = [(d, k, -(-s // LIST_PART)) for (d, k), s in sizes.items() if s > LIST_PART]
    cut = spark.createDataFrame(large, "dim int, in_list int, parts int")
    own = ["dim", "list", "node", "code", "error", "radius", "rids", "mat"]
    listed = nodes.withColumn("in_list", F.col("list")).join(F.broadcast(cut), ["dim", "in_list"], "left")
    listed = listed.withColumn("part", F.pmod(F.xxhash64("node"), F.coalesce("parts", F.lit(1))).cast("int"))
    asking = (
        listed.withColumnRenamed("part", "home")
        .drop("parts")
        .withColumn("in_list", F.explode(F.filter("probes", lambda p: p >= F.col("list"))))
        .join(F.broadcast(cut), ["dim", "in_list"], "left")
        .withColumn("part", F.explode(F.sequence(F.lit(0), F.coalesce("parts", F.lit(1)) - 1)))
        .filter("in_list <> list or part <> home")
    )
    met = listed.select(*own, "in_list", "part", F.lit(False).alias("asks")).unionByName(asking.select(*own, "in_list", "part", F.lit(True).alias("asks")))
    cells = met.repartition(n, "dim", "in_list", "part").sortWithinPartitions("dim", "in_list", "part", "asks")
    found = written(cells.mapInArrow(_linked(models, least_cos, kind), "kind int, a long, b long"), "found")

    by_node = found.filter("kind = 0").groupBy(F.col("a").alias("node")).agg(F.sum("b").alias("of_node"))
    by_row = found.filter("kind = 1").groupBy(F.col("a").alias("rid")).agg(F.sum("b").alias("of_row"))
    reached = components(found.filter("kind = 2").select("a", "b"))
    least = reached.join(nodes.select("node", "least"), "node").groupBy("component").agg(F.min("least").alias("reached"))
    ends = nodes.select("node", "least", (F.size("rids") - 1).alias("others"), F.explode("rids").alias("rid"))
    ends = ends.join(by_node, "node", "left").join(reached.join(least, "component").select("node", "reached"), "node", "left")
    joined = rows.select("rid", "vec_id").join(ends, "rid", "left").join(by_row, "rid", "left")
    links = F.coalesce("others", F.lit(0)) + F.coalesce("of_node", F.lit(0)) + F.coalesce("of_row", F.lit(0))
    return joined.select("vec_id", links.cast("long").alias("n_links"), F.coalesce("reached", "least", "vec_id").alias("component_id")).withColumn(
        "kept", F.col("vec_id").eqNullSafe(F.col("component_id"))
    )
