"""Near duplicates by one-permutation hashing, banded buckets and star-shaped candidate edges.

A document's distinct five-word shingles are hashed once and dealt to bins; the least hash of
each bin is its signature, and an empty bin borrows from bins drawn by a fixed random sequence
(optimal densification). Four bins form a band. Documents with equal shingle sets are one class
and only one of them goes on.

In every bucket each member is compared with the bucket's least and greatest member, two stars,
so candidate pairs grow with the members. Links are confirmed on the full sets of word
sequences. Stars alone can miss a link between two members that are both unlike the centres. So
buckets that still hold several components are searched again: members outside the bucket's largest
component are held against the members of other components, in cells of bounded size,
first by signature and then by their full sets, and only links leave the cell. Pairs inside a
component cannot change the result. The odds that no band of a pair at the threshold agrees
are about 5 in a million.

Outsiders that fit one cell make at most two rows of each member. A bucket with more of them is dealt
to cells at random, each member to one, and dealt anew with the components found as long as that
brings many outsiders in: a large family is one component soon. What is then still open shares a passage
more than a text. Its rows are grouped by their rarest shingles: of two sets at the threshold, the
rarest quarter of each, in one order of all shingles, have one in common. Where that makes fewer
rows than all pairs of cells, it takes their place.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType

from barloom.llm.common import LONG, array_of, extended, give_back, row_order, text_or_empty, written
from barloom.llm.components import components

SHINGLE, PERCENT = 5, 75
BINS, BAND, TRIES, SEED = 128, 4, 1024, 11
CELL = 256
TURNS, WORTH, SLOTS = 8, 10, 1 << 20
_MIX = tuple(np.uint64(x) for x in (0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0x9E3779B97F4A7C15))


def words_of(text: str) -> list[bytes]:
    """Words between ASCII white space, A to Z in lower case."""
    return text.encode().lower().split()


def shingle_set(text: str) -> set[tuple[bytes, ...]]:
    """Distinct five-word sequences; a shorter text is one sequence, an empty one has none."""
    w = words_of(text)
    if len(w) < SHINGLE:
        return {tuple(w)} if w else set()
    return set(zip(*(w[i:] for i in range(SHINGLE)), strict=False))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _MIX[0]
    x = (x ^ (x >> np.uint64(27))) * _MIX[1]
    return x ^ (x >> np.uint64(31))


def shingle_hashes(text: str) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles."""
    from xxhash import xxh3_64_intdigest

    words = words_of(text)
    w = np.fromiter(map(xxh3_64_intdigest, words), np.uint64, len(words))
    if not len(w):
        return w
    h = np.zeros(max(1, len(w) - SHINGLE + 1), np.uint64)
    for i in range(min(SHINGLE, len(w))):
        h = _mixed(h * _MIX[2] + w[i : i + len(h)])
    return np.unique(h)


@cache
def _lenders() -> np.ndarray:
    """For every bin, the bins it asks in turn when it is empty."""
    return np.random.Generator(np.random.PCG64(SEED)).integers(0, BINS, (BINS, TRIES))


def signature(hashes: np.ndarray) -> np.ndarray:
    """The least hash of each bin, as 32 bits; empty bins borrow. ``hashes`` is not empty."""
    at, first = np.unique(hashes >> np.uint64(64 - int(np.log2(BINS))), return_index=True)
    at = at.astype(np.int64)
    out, full = np.zeros(BINS, np.uint64), np.zeros(BINS, bool)
    out[at], full[at] = hashes[first], True
    done = full.copy()
    for tries in (32, TRIES):  # most bins find a lender soon
        empty = np.flatnonzero(~done)
        if len(empty):
            asked = full[_lenders()[empty, :tries]]
            lucky = asked.any(1)
            out[empty[lucky]] = out[_lenders()[empty[lucky], asked[lucky].argmax(1)]]
            done[empty[lucky]] = True
    rest = np.flatnonzero(~done)  # all but impossible: the next full bin lends
    out[rest] = out[at[np.searchsorted(at, rest) % len(at)]]
    return (out >> np.uint64(16)).astype(np.uint32)


def bands(sig: np.ndarray) -> np.ndarray:
    """One 64-bit key for each band, the band's number included."""
    rows = sig.reshape(-1, BAND).astype(np.uint64)
    key = np.arange(len(rows), dtype=np.uint64)
    for i in range(BAND):
        key = _mixed(key * _MIX[2] + rows[:, i] + np.uint64(1))
    return key.view(np.int64)


def _sketched(text: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size, digest, sigs, keys = [], [], [], []
            for t in batch.column(text).to_pylist():
                h = shingle_hashes(t or "")
                size.append(len(h))
                digest.append(blake2b(h.tobytes(), digest_size=16).digest())
                sig = signature(h) if len(h) else None
                sigs.append(None if sig is None else sig.astype(np.uint8).tobytes())
                keys.append([] if sig is None else bands(sig).tolist())
            columns = [pa.array(size, pa.int64()), pa.array(digest, pa.binary()), pa.array(sigs, pa.binary())]
            columns.append(pa.array(keys, pa.list_(pa.int64())))
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], [*batch.schema.names, *SKETCH])

    return run


SKETCH = ("n_shingles", "set_digest", "signature", "band_keys")


def sketches(docs: DataFrame, text: str, row: str) -> DataFrame:
    """``docs`` with a row number and the sketch of each text (written)."""
    schema = extended(docs.schema, n_shingles=LONG, set_digest=BinaryType(), signature=BinaryType(), band_keys=array_of(LONG))
    return written(docs.mapInArrow(_sketched(text), schema).withColumn(row, F.monotonically_increasing_id()), "sketches")


def _confirmed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pairs whose full sets reach the threshold."""
    last: tuple | None = None
    for batch in batches:
        a, b = batch.column("a").to_pylist(), batch.column("b").to_pylist()
        keep = []
        for i, (ta, tb) in enumerate(zip(batch.column("text_a"), batch.column("text_b"), strict=True)):
            if last is None or last[0] != a[i]:
                last = (a[i], shingle_set(ta.as_py()))
            other = shingle_set(tb.as_py())
            both = len(last[1] & other)
            if 100 * both >= PERCENT * (len(last[1]) + len(other) - both):
                keep.append(i)
        yield pa.RecordBatch.from_arrays(
            [pa.array([a[i] for i in keep], pa.int64()), pa.array([b[i] for i in keep], pa.int64())], ["a", "b"]
        )


def _least_agreement(n: np.ndarray) -> np.ndarray:
    """Five standard errors below the threshold, for a set of ``n`` shingles."""
    share = PERCENT / 100
    return share - 5 * np.sqrt(share * (1 - share) / np.minimum(n, BINS))


def _agreeing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sa, sb = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(-1, BINS) for c in ("sa", "sb"))
        least = np.minimum(batch.column("na").to_numpy(), batch.column("nb").to_numpy())
        keep = pa.array((sa == sb).mean(1) >= _least_agreement(least))
        yield pa.RecordBatch.from_arrays([batch.column(c).filter(keep) for c in ("a", "b")], ["a", "b"])


def _across(cell: pa.Table) -> pa.Table:
    """Links between the outsiders of a cell and its members of other components.

    A pair is looked at in the first band it shares only, unless the band is null, and once if both
    are outsiders. Of a component, one link is enough.
    """
    row, comp, n = (cell.column(c).to_numpy() for c in ("row", "component", "n_shingles"))
    asks, held, outside = (np.asarray(cell.column(c).to_pylist(), bool) for c in ("asks", "held", "outside"))
    sigs = np.frombuffer(b"".join(cell.column("signature").to_pylist()), np.uint8).reshape(len(row), BINS)
    keys = np.array(cell.column("band_keys").to_pylist(), np.int64)
    band = cell.column("band")[0].as_py()
    text, sets = cell.column("text"), {}

    def full(i: int) -> set:
        if row[i] not in sets:
            sets[row[i]] = shingle_set(text[i].as_py())
        return sets[row[i]]

    members, links = np.flatnonzero(held), []
    for q in np.flatnonzero(asks):
        fits = (comp[members] != comp[q]) & (~outside[members] | (row[members] > row[q]))
        fits &= 100 * np.minimum(n[members], n[q]) >= PERCENT * np.maximum(n[members], n[q])
        at = members[fits]
        first = True if band is None else (keys[at] == keys[q]).argmax(1) == band
        agree = (sigs[at] == sigs[q]).mean(1)
        likely = first & (agree >= _least_agreement(np.minimum(n[at], n[q])))
        at, agree = at[likely], agree[likely]
        linked = set()
        for i in at[np.argsort(-agree, kind="stable")]:
            if comp[i] not in linked:
                both = len(full(q) & full(i))
                if 100 * both >= PERCENT * (n[q] + n[i] - both):
                    linked.add(comp[i])
                    links.append((int(row[q]), int(row[i])))
    return pa.table({"a": pa.array([min(x) for x in links], pa.int64()), "b": pa.array([max(x) for x in links], pa.int64())})


def _confirm(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """``pairs (a, b)`` that are links; ``texts`` is ``(row, text)``. The joins carry texts, so they are
    sort-merge joins at any size."""
    with_a = pairs.hint("merge").join(texts.select(F.col("row").alias("a"), F.col("text").alias("text_a")), "a")
    full = with_a.hint("merge").join(texts.select(F.col("row").alias("b"), F.col("text").alias("text_b")), "b")
    return written(full.select("a", "b", "text_a", "text_b").mapInArrow(_confirmed, "a long, b long"), "confirmed")


RESULT = ("n_shingles", "component_id", "kept")


def _grouped(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame, list[Column]]:
    """The written rows, the rows with their group, and the columns of ``docs`` in either."""
    own = docs.columns
    clash = {c: f"own_{i}_" for i, c in enumerate(own)}
    doc_id, text = clash[id_col], clash[text_col]
    renamed = docs.select(*[F.col(f"`{c}`").alias(clash[c]) for c in own])
    rows = sketches(renamed.withColumn(text, F.col(text).cast("string")), text, "row")

    classes = written(
        rows.filter("n_shingles > 0")
        .groupBy("set_digest", "n_shingles")
        .agg(
            F.min("row").alias("class"),
            F.min(doc_id).alias("low"),
            F.min(row_order(F.col(doc_id), F.col("row"))).alias("first"),
        ),
        "classes",
    )
    reps = rows.join(classes.select(F.col("class").alias("row")), "row", "left_semi")
    members = written(reps.select("row", "n_shingles", "signature", "band_keys"), "members")

    keyed = members.select(F.posexplode("band_keys").alias("band", "key"), "row", "n_shingles")
    buckets = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("m"), F.min("row").alias("lo"), F.max("row").alias("hi"))
    buckets = written(buckets.filter("m > 1"), "buckets")
    filled = written(keyed.join(buckets, "key"), "bucket-members")
    stars = filled.select(F.col("lo").alias("a"), F.col("row").alias("b"), "n_shingles").union(
        filled.select(F.col("row"), F.col("hi"), "n_shingles")
    )
    pairs = stars.filter("a <> b").select("a", "b").distinct()
    # All later comparisons are between rows that share a bucket: their texts move once.
    texts = rows.select("row", "n_shingles", "signature", "band_keys", text_or_empty(F.col(text)).alias("text"))
    texts = written(texts.join(filled.select("row").distinct().hint("merge"), "row", "left_semi"), "bucket-texts")
    links = _confirm(_likely(pairs, members), texts)
    joined = components(links)

    opened = _opened(filled.filter("m > 3").select(*BUCKET), joined)
    before = None
    for turn in range(TURNS):
        wide = opened.filter(F.col("others") > CELL)
        outsiders = wide.filter("outside").select("row").distinct().count()
        if not outsiders or (before and WORTH * (before - outsiders) < before):
            break
        more, before = _linked(_dealt(wide, turn), texts), outsiders
        if more.isEmpty():
            break
        links = links.union(more)
        joined = components(links)
        opened = _opened(opened.select(*BUCKET), joined)
    if not opened.isEmpty():
        cells, wide = _cells(opened.filter(F.col("others") <= CELL)), opened.filter(F.col("others") > CELL)
        if not wide.isEmpty():
            rare = _by_rare_shingles(wide, texts)
            cells = cells.union(_cells(min(wide, rare, key=_rows_in_cells)))
        more = _linked(cells, texts)
        if not more.isEmpty():
            joined = components(links.union(more))

    by_class = classes.join(joined.select(F.col("node").alias("class"), "component"), "class", "left").withColumn(
        "component", F.coalesce("component", "class")
    )
    least = by_class.groupBy("component").agg(F.min("low").alias("component_id"), F.min("first").alias("first"))
    found = by_class.drop("first", "low").join(least, "component").select("set_digest", "n_shingles", "component_id", "first")
    lean = rows.drop("signature", "band_keys")
    some = lean.filter("n_shingles > 0").join(found, ["set_digest", "n_shingles"])
    kept = row_order(F.col(doc_id), F.col("row")) == F.col("first")
    alone = lean.filter("n_shingles = 0")
    grouped = some.select(*lean.columns, "component_id", kept.alias("kept")).union(
        alone.select(*lean.columns, F.col(doc_id).alias("component_id"), F.lit(True).alias("kept"))
    )
    return rows, grouped, [F.col(clash[c]).alias(c) for c in own]


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All rows of ``docs`` with ``n_shingles``, ``component_id`` and ``kept``.

    ``component_id`` is the smallest id that can be reached over links, the row's own included.
    One row of each component is kept: the one with that id, of repeated ids the first row.
    Null texts count as empty; texts without words are linked with nothing and stay. Texts of
    less than five words are one shingle. A null id comes last and ``component_id`` is null
    only if all ids of a component are. An empty table gives an empty result. Columns of
    ``docs`` named like a result are replaced, others pass through.
    """
    _, grouped, own = _grouped(docs.drop(*[c for c in docs.columns if c.lower() in RESULT]), id_col, text_col)
    return grouped.select(*own, *RESULT)


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each component."""
    rows, grouped, own = _grouped(docs, id_col, text_col)
    gone = grouped.filter(~F.col("kept")).select("row")
    return rows.join(gone, "row", "left_anti").select(*own)


def _likely(pairs: DataFrame, members: DataFrame) -> DataFrame:
    """Pairs whose sizes allow the threshold and whose signatures make it likely enough."""
    side = members.select("row", "n_shingles", "signature")
    a, b = (side.toDF(x, f"n{x}", f"s{x}") for x in ("a", "b"))
    like = pairs.join(a, "a").join(b, "b").filter(100 * F.least("na", "nb") >= PERCENT * F.greatest("na", "nb"))
    return written(like.mapInArrow(_agreeing, "a long, b long"), "likely")


BUCKET = ("key", "band", "row")


def _opened(buckets: DataFrame, joined: DataFrame) -> DataFrame:
    """The members of the buckets that hold several components (written). ``outside`` are those not in
    the bucket's largest component, ``others`` is their number."""
    labelled = buckets.join(joined.withColumnRenamed("node", "row"), "row", "left")
    labelled = written(labelled.select(*BUCKET, F.coalesce("component", "row").alias("component")), "labelled")
    parts = labelled.groupBy("key", "component").agg(F.count(F.lit(1)).alias("n"))
    mixed = parts.groupBy("key").agg(F.max_by("component", "n").alias("main"), (F.sum("n") - F.max("n")).alias("others"))
    rows = labelled.join(mixed.filter("others > 0"), "key")
    return written(rows.withColumn("outside", F.col("component") != F.col("main")).drop("main"), "open-buckets")


def _linked(cells: DataFrame, texts: DataFrame) -> DataFrame:
    """The links found in ``cells`` (written). Sketches and texts come in by one join."""
    full = cells.join(texts.hint("merge"), "row")
    return written(full.groupBy("key", "cm", "co").applyInArrow(_across, "a long, b long").distinct(), "across")


def _shares(rows: DataFrame) -> DataFrame:
    """Of each bucket the shares of its members and of its outsiders, and their numbers."""
    share = lambda c: F.ceil(F.col(c) / CELL)
    sizes = rows.groupBy("key").agg(F.count(F.lit(1)).alias("members"), F.sum(F.col("outside").cast("int")).alias("outsiders"))
    return sizes.select("*", share("members").alias("nm"), share("outsiders").alias("no"))


def _rows_in_cells(rows: DataFrame) -> int:
    cost = F.when(F.col("nm") == 1, F.col("members")).otherwise(F.col("members") * F.col("no") + F.col("outsiders") * F.col("nm"))
    return _shares(rows).agg(F.sum(cost)).first()[0] or 0


def _dealt(rows: DataFrame, turn: int) -> DataFrame:
    """The rows of each bucket dealt to cells of about ``CELL``, every row to one of them."""
    cell = F.pmod(F.xxhash64("row", F.lit(turn)), "nm")
    dealt = rows.withColumn("band", F.lit(None).cast("int")).join(_shares(rows).select("key", "nm"), "key")
    return dealt.select(*rows.columns, F.col("outside").alias("asks"), F.lit(True).alias("held"), cell.alias("cm"), cell.alias("co"))


def _cells(rows: DataFrame) -> DataFrame:
    """The rows dealt to cells of about ``CELL`` outsiders, who ask, and ``CELL`` members of one
    bucket, who are held. A member goes to as many cells as there are shares of outsiders, and the
    reverse; in a bucket of one cell a row is there once."""
    sized = rows.join(_shares(rows).select("key", "nm", "no"), "key").withColumn("dealt", F.xxhash64("row"))
    upto = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    yes, no, zero = F.lit(True), F.lit(False), F.lit(0).cast("long")
    one = sized.filter("nm = 1").select(*rows.columns, F.col("outside").alias("asks"), yes.alias("held"), zero.alias("cm"), zero.alias("co"))
    many = sized.filter("nm > 1")
    held = many.select(*rows.columns, no.alias("asks"), yes.alias("held"), F.pmod("dealt", "nm").alias("cm"), upto("no").alias("co"))
    out = many.filter("outside").select(
        *rows.columns, yes.alias("asks"), no.alias("held"), upto("nm").alias("cm"), F.pmod("dealt", "no").alias("co")
    )
    return one.union(held).union(out)


def _slots(hashes: np.ndarray) -> np.ndarray:
    return (hashes & np.uint64(SLOTS - 1)).astype(np.int64)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many texts of the task hold shingles of each slot."""
    counts = np.zeros(SLOTS, np.int64)
    for batch in batches:
        for t in batch.column("text"):
            np.add.at(counts, _slots(shingle_hashes(t.as_py())), 1)
    held = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(counts[held])], ["slot", "n"])


def _rarest(counts: np.ndarray):
    """The rows by each of their rarest shingles, as many as a set at the threshold cannot lack."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, keys = [], []
            for i, t in enumerate(batch.column("text")):
                h = shingle_hashes(t.as_py())
                some = len(h) - -(-PERCENT * len(h) // 100) + 1
                keys.append(h[np.lexsort((h, counts[_slots(h)]))[:some]].view(np.int64))
                at.append(np.full(some, i))
            rows = batch.select(["row", "component"]).take(pa.array(np.concatenate(at)))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys)), *rows.columns], ["key", "row", "component"])

    return run


def _by_rare_shingles(rows: DataFrame, texts: DataFrame) -> DataFrame:
    """The rows of ``rows`` as open buckets of equal rare shingles, without a band (written)."""
    some = written(rows.select("row", "component").distinct().join(texts.select("row", "text").hint("merge"), "row"), "open-texts")
    counted = some.mapInArrow(_counted, "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(SLOTS, np.int32)  # collisions change the order of shingles, which any order may be
    counts[counted.column("slot").to_numpy()] = np.minimum(counted.column("n").to_numpy(), 2**31 - 1)
    del counted
    give_back()
    held = written(some.mapInArrow(_rarest(counts), "key long, row long, component long"), "rare-shingles")
    mixed = held.groupBy("key").agg(F.min("component").alias("x"), F.max("component").alias("y")).filter("x <> y")
    keyed = held.join(mixed.select("key"), "key", "left_semi").select("key", F.lit(None).cast("int").alias("band"), "row")
    return _opened(keyed, held.select(F.col("row").alias("node"), "component").distinct())
