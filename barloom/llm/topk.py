"""Exact top-k inner-product search by selection on distributed histograms.

Every query block meets every block of candidates, and all pairs are scored. No scores are
shipped: the first passes only count them in buckets, and each pass narrows the bucket that
holds a query's k-th highest score until it is one integer wide. The last pass keeps what is
above that score, and of the ties at it the smallest ids.

A task reports only the buckets from its own k-th highest score upwards, since the global one
cannot be lower, so counts per query and task are few. Candidates travel in packed blocks, the
stated queries in blocks of bounded size; both are spread over a grid of (query block, share of
candidates), so no join key is hot.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barloom.llm.common import parallelism, written
from barloom.session import checkpoint

QUERY_BLOCK, CANDIDATE_BLOCK, BUCKETS = 512, 2048, 256


def quantised(vectors: DataFrame, id_col: str, vec_col: str, scale: int) -> DataFrame:
    """Rows ``(rid, vec_id, vec)`` with integer components; unusable vectors are left out."""
    v = F.col(vec_col)
    usable = v.isNotNull() & ~F.exists(
        v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == F.lit(float("inf")))
    )
    return vectors.select(
        F.monotonically_increasing_id().alias("rid"),
        F.col(id_col).cast("long").alias("vec_id"),
        F.when(usable, F.transform(v, lambda x: F.floor(x.cast("double") * scale))).alias("vec"),
    ).filter("vec is not null and vec_id is not null")


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[int, list] = {}

    def block(dim: int) -> pa.RecordBatch:
        rows = held.pop(dim)
        rid, vid, vec = (np.concatenate([r[i] for r in rows]) for i in range(3))
        columns = [[dim], [int(rid[0])], [rid.tobytes()], [vid.tobytes()], [vec.tobytes()]]
        types = [pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary()]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["dim", "first", "rids", "ids", "mat"]
        )

    for batch in batches:
        vec = batch.column("vec")
        lengths = np.diff(vec.offsets.to_numpy())
        flat, ends = vec.flatten().to_numpy(), np.concatenate([[0], np.cumsum(lengths)])
        rid, vid = batch.column("rid").to_numpy(), batch.column("vec_id").to_numpy()
        for dim in np.unique(lengths):
            rows = np.flatnonzero(lengths == dim)
            for part in np.array_split(rows, -(-len(rows) // CANDIDATE_BLOCK)):
                at = (ends[part][:, None] + np.arange(dim)[None, :]).astype(np.int64)
                held.setdefault(int(dim), []).append((rid[part], vid[part], flat[at].astype(np.int64)))
                if sum(len(r[0]) for r in held[int(dim)]) >= CANDIDATE_BLOCK:
                    yield block(int(dim))
    for dim in list(held):
        yield block(dim)


PACKED = "dim int, first long, rids binary, ids binary, mat binary"


def _scored(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, ...]]:
    """Scores of query blocks against candidate blocks, with each query's own row marked."""
    for i in range(batch.num_rows):
        dim = batch.column("dim")[i].as_py()
        crid, cid, cand = (np.frombuffer(batch.column(c)[i].as_buffer(), np.int64) for c in ("rids", "ids", "mat"))
        cand = cand.reshape(len(crid), dim)
        qrid, vec, lo, need = batch.column("queries")[i].values.flatten()
        qrid, lo, need = qrid.to_numpy(), lo.to_numpy(), need.to_numpy()
        query = vec.flatten().to_numpy().reshape(len(qrid), dim)
        most = float(np.abs(cand).max(initial=0)) * float(np.abs(query).max(initial=0)) * dim
        if most < 2**52:
            score = (query.astype(np.float64) @ cand.astype(np.float64).T).astype(np.int64)
        else:
            score = query @ cand.T
        yield qrid, crid, cid, score, qrid[:, None] == crid[None, :], lo, need


def _histograms(width: int, span: int):
    """Counts of the scores in ``[lo, lo + span)`` by buckets of ``width`` above ``lo``."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for qrid, _, _, score, own, lo, need in _scored(batch):
                above = score - lo[:, None]
                inside = (above >= 0) & (above < span) & ~own
                n = -(-span // width)
                cell = np.arange(len(qrid))[:, None] * n + above // width
                hist = np.bincount(cell[inside], minlength=len(qrid) * n).reshape(len(qrid), n)
                higher = np.cumsum(hist[:, ::-1], axis=1)[:, ::-1] - hist
                at = np.nonzero((hist > 0) & (higher < need[:, None]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(qrid[at[0]]), pa.array(at[1].astype(np.int64)), pa.array(hist[at].astype(np.int64))],
                    ["rid", "bucket", "n"],
                )

    return count


def _chosen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All scores above ``lo``, and as many ties at ``lo`` as are still needed, by id."""
    for batch in batches:
        for qrid, crid, cid, score, own, lo, need in _scored(batch):
            q, c = np.nonzero((score > lo[:, None]) & ~own)
            tq, tc = np.nonzero((score == lo[:, None]) & ~own)
            order = np.lexsort((crid[tc], cid[tc], tq))
            tq, tc = tq[order], tc[order]
            nth = np.arange(len(tq)) - np.searchsorted(tq, tq)
            tq, tc = tq[nth < need[tq]], tc[nth < need[tq]]
            q, c = np.concatenate([q, tq]), np.concatenate([c, tc])
            yield pa.RecordBatch.from_arrays(
                [pa.array(qrid[q]), pa.array(crid[c]), pa.array(cid[c]), pa.array(score[q, c])],
                ["rid", "crid", "vec_id", "score"],
            )


def exact_top_k(
    vectors: DataFrame, is_query: Column, k: int = 20, scale: int = 64, id_col: str = "vec_id", vec_col: str = "embedding"
) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the ``k`` best candidates of every query.

    ``is_query`` picks the queries by the column ``vec_id``; every other row is a candidate of
    a query, also one that repeats its id or vector. Components become ``floor(scale * x)``
    and the score is their integer inner product; ties go to the smaller id. Vectors that are
    null, hold a null or a non-finite component or have a null id take no part; vectors of
    different lengths do not meet. With fewer than ``k`` candidates all are returned; an empty
    table gives an empty result. Other columns are ignored.
    """
    spark = vectors.sparkSession
    rows = written(quantised(vectors, id_col, vec_col, scale), "vectors")
    norm = F.sqrt(F.aggregate("vec", F.lit(0.0), lambda a, x: a + x.cast("double") * x))
    queries = rows.filter(is_query)
    n, most = queries.agg(F.count(F.lit(1)), F.max(norm)).first()
    reach = rows.agg(F.max(norm)).first()[0] or 0.0
    bound = int((most or 0.0) * reach * (1 + 1e-9)) + 2  # no score is beyond it either way
    blocks = max(1, -(-n // QUERY_BLOCK))
    shares = max(1, -(-parallelism(spark) // blocks))

    packed = rows.mapInArrow(_pack, PACKED)
    grid = packed.withColumn("share", F.pmod(F.xxhash64("first"), F.lit(shares))).withColumn(
        "block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    )
    query_rows = queries.select(
        F.pmod(F.xxhash64("rid"), F.lit(blocks)).cast("int").alias("block"), F.size("vec").alias("dim"), "rid", "vec"
    )

    def against(state: DataFrame) -> DataFrame:
        sized = (
            query_rows.join(state, "rid")
            .groupBy("block", "dim")
            .agg(F.collect_list(F.struct("rid", "vec", "lo", "need")).alias("queries"))
            .withColumn("share", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shares - 1).cast("long"))))
        )
        return grid.join(sized, ["block", "dim", "share"]).select("dim", "rids", "ids", "mat", "queries")

    state = query_rows.select("rid", F.lit(-bound).cast("long").alias("lo"), F.lit(k).cast("long").alias("need"))
    span = 2 * bound + 1
    while span > 1:
        width = -(-span // BUCKETS)
        counts = (
            against(state)
            .mapInArrow(_histograms(width, span), "rid long, bucket long, n long")
            .groupBy("rid", "bucket")
            .agg(F.sum("n").alias("n"))
        )
        down = Window.partitionBy("rid").orderBy(F.col("bucket").desc())
        reached = (
            counts.withColumn("upto", F.sum("n").over(down))
            .join(state, "rid")
            .filter("upto >= need")
            .groupBy("rid")
            .agg(F.max(F.struct("bucket", "upto", "n")).alias("b"))
        )
        # A query with fewer candidates than k reaches no bucket: it keeps the lowest bound.
        state = checkpoint(
            state.join(reached, "rid", "left").select(
                "rid",
                F.coalesce(F.col("lo") + F.col("b.bucket") * width, "lo").alias("lo"),
                F.coalesce(F.col("need") - (F.col("b.upto") - F.col("b.n")), "need").alias("need"),
            )
        )
        span = width
    best = Window.partitionBy("rid").orderBy(F.col("score").desc(), "vec_id", "crid")
    chosen = against(state).mapInArrow(_chosen, "rid long, crid long, vec_id long, score long")
    ids = queries.select("rid", F.col("vec_id").alias("query_id"))
    return (
        chosen.withColumn("rank", F.row_number().over(best))
        .filter(F.col("rank") <= k)
        .join(ids, "rid")
        .select("query_id", "rank", "vec_id", "score")
    )
