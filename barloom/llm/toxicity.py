"""Toxicity by the nearest labelled examples under exact TF-IDF cosine.

Terms are lower-cased words and word beginnings of four to six letters. The vocabulary is every
term of a bounded labelled sample; document frequencies come from all documents, and a term that
prefers one label counts more by its likelihood ratio. A term that no example holds changes no
order of neighbours, so it is left out of a text's length too. The examples stand in blocks of
like ones. Terms of few examples have postings that are read whole; for those of many the index
keeps the largest weight in each block. From both follows a bound of a text's cosines with all
examples of a block; the blocks of the highest bounds are compared first, and of the others only
those whose bound can still reach the last of the nearest found, by all texts that need a block
together. These cosines are of single precision; whatever its error could put among the nearest
is compared again exactly, so nothing is lost. Votes weighted by distance are turned into probabilities by a monotone fit on the examples
themselves, each judged without its own vote, at the class shares of all labels.

The corpus is cut into terms once. Their numbers and counts are written in about three bytes each, and read for
document frequencies and for verdicts.
Vocabulary and examples are bounded by the sample, so index and broadcast are too.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Collection, Iterator
from dataclasses import dataclass, fields
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType

from barloom.llm.common import DOUBLE, LONG, array_of, extended, fresh_name, give_back, written
from barloom.llm.quality import labelled_sample

SAMPLE_PER_CLASS, NEIGHBOURS = 2000, 15
#: Examples in a block, blocks compared first, numbers an example's sketch has, texts judged at once, and
#: the share of examples (one in so many) from which a term is held block by block.
BLOCK, FIRST_BLOCKS, SKETCH, TEXTS, COMMON = 32, 3, 64, 256, 16
MULTIPLIERS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], np.uint64)
BEGINNINGS = (4, 5, 6)
#: Prefixes of unknown words whose known beginnings are kept.
PREFIXES = 100_000
_WORD = re.compile(r"[^\W\d_]+")
#: The same letters of Latin-1 as a plain set, which is matched in less time.
_LATIN_WORD = re.compile("[" + "".join(re.escape(c) for c in map(chr, range(256)) if _WORD.match(c)) + "]+")


def words_of(text: str) -> list[str]:
    """The lower-cased words."""
    text = text.lower()
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return _WORD.findall(text)
    return _LATIN_WORD.findall(text)


def terms_of(word: str) -> list[str]:
    """The word, marked as whole, and its beginnings."""
    return [word + "$", *(word[:n] for n in BEGINNINGS if len(word) >= n)]


def _document_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents of each class that hold a term, summed within the task."""
    held: tuple[Counter, Counter] = (Counter(), Counter())
    for batch in batches:
        for text, y in zip(batch.column("text").to_pylist(), batch.column("y").to_pylist(), strict=True):
            held[y].update({t for w in set(words_of(text)) for t in terms_of(w)})
    terms = sorted({*held[0], *held[1]})
    for at in range(0, len(terms), 50_000):
        part = terms[at : at + 50_000]
        columns = [pa.array(part), *(pa.array([h[t] for t in part], pa.int64()) for h in held)]
        yield pa.RecordBatch.from_arrays(columns, ["term", "clean", "toxic"])


def _sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The least hashes of a document's word triples under several multipliers."""
    for batch in batches:
        out = []
        for text in batch.column("text").to_pylist():
            words = np.fromiter((crc32(w) for w in text.lower().encode().split()), np.uint64)
            triples = words[:-2] * np.uint64(31**2) + words[1:-1] * np.uint64(31) + words[2:] if len(words) > 2 else words
            out.append([int((triples * m >> np.uint64(16)).min(initial=2**48)) for m in MULTIPLIERS])
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("y"), pa.array(out, pa.list_(pa.int64()))], ["doc_id", "y", "sketch"]
        )


def one_of_each_family(sample: DataFrame) -> DataFrame:
    """The sample without near copies, so that a text with many copies is one example.

    A row goes if any of its sketch values was seen in its class before, in the order of ids.
    Only the sketches of the bounded sample come to the driver.
    """
    rows = sample.select("doc_id", F.col("y").cast("int").alias("y"), "text")
    seen: set[tuple[int, int, int]] = set()
    kept = []
    for r in rows.mapInArrow(_sketches, "doc_id long, y int, sketch array<long>").orderBy("doc_id").collect():
        own = {(r["y"], i, v) for i, v in enumerate(r["sketch"])}
        if not own & seen:
            kept.append((r["doc_id"],))
        seen |= own
    ids = sample.sparkSession.createDataFrame(kept, "doc_id long")
    return sample.join(F.broadcast(ids), "doc_id", "left_semi")


def weigh_terms(sample: DataFrame) -> tuple[pa.Array, np.ndarray]:
    """All terms of the sample in order, and for each how far it prefers one class.

    That is the square of 1 and the likelihood ratio against equal rates, in units of what chance
    alone reaches among so many terms (twice the logarithm of their number). It is a weight, never a
    gate: a term without any preference counts like in plain TF-IDF. Rates are per distinct term
    of a class, not per document, so a class of longer documents does not make every rare term
    look telling.
    """
    counts = (
        sample.select("text", F.col("y").cast("int").alias("y"))
        .mapInArrow(_document_terms, "term string, clean long, toxic long")
        .groupBy("term")
        .agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
        .toArrow()
        .sort_by("term")
    )
    held = np.array([counts["clean"].to_numpy(), counts["toxic"].to_numpy()], np.float64).reshape(2, -1)
    totals = held.sum(1, keepdims=True)
    weight = np.ones(held.shape[1])
    if totals.all():
        expected = held.sum(0) * totals / totals.sum()
        ratio = 2 * (held * np.log(np.where(held > 0, held, 1) / np.where(held > 0, expected, 1))).sum(0)
        weight += np.maximum(ratio, 0) / (2 * math.log(max(2, len(weight))))
    return counts["term"].combine_chunks(), weight**2


class _Known(dict):
    """A row for each word of the vocabulary met, with the numbers of its terms, -1 for none.

    Other words can hold known beginnings; these go to ``extra`` and the word gets the empty row
    0. So what is kept is bounded by the vocabulary and ``PREFIXES``, and stays from task to task in a worker.
    """

    def __init__(self, terms: pa.Array):
        super().__init__()
        vocabulary = terms.to_pylist()
        self.number = {t: i for i, t in enumerate(vocabulary)}
        self.rows = np.full((1 + sum(t[-1] == "$" for t in vocabulary), 1 + len(BEGINNINGS)), -1, np.int32)
        self.extra: list[int] = []
        self.begun: dict[str, tuple[int, ...]] = {}

    def __missing__(self, word: str) -> int:
        number = self.number
        whole = number.get(word + "$", -1)
        if whole < 0:
            prefix = word[: BEGINNINGS[-1]]
            found = self.begun.get(prefix)
            if found is None:
                if len(self.begun) >= PREFIXES:
                    self.begun.clear()
                found = self.begun[prefix] = tuple(number[prefix[:n]] for n in BEGINNINGS if len(prefix) >= n and prefix[:n] in number)
            self.extra += found
            return 0
        row = self[word] = len(self) + 1
        found = [number.get(t, -1) for t in terms_of(word)]
        self.rows[row, : len(found)] = found
        return row


@dataclass
class _Vocabulary:
    """The terms in one buffer, as they are shared; workers read it as :class:`_Known`."""

    terms: pa.Array

    def __reduce__(self):
        return _Known, (self.terms,)


def _numbers(words: Collection[str], known: _Known) -> tuple[np.ndarray, np.ndarray]:
    """Numbers and counts of the vocabulary's terms in the words."""
    at = known.rows[np.fromiter(map(known.__getitem__, words), np.int64, len(words))].ravel()
    if known.extra:
        at = np.concatenate([at, np.array(known.extra, np.int32)])
        known.extra.clear()
    at.sort()
    at = at[np.searchsorted(at, 0) :]
    new = np.ones(len(at) + 1, bool)
    np.not_equal(at[1:], at[:-1], out=new[1:-1])
    edges = np.flatnonzero(new)
    return at[edges[:-1]], edges[1:] - edges[:-1]


def _terms_in(text: str, known: _Known) -> tuple[np.ndarray, np.ndarray]:
    """Numbers and counts of the vocabulary's terms in a text."""
    return _numbers(words_of(text), known)


def _cut(vocabulary):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary.value
        for batch in batches:
            found = [_terms_in(t, known) for t in batch.column("text").to_pylist()]
            ids, counts = [f[0] for f in found], [f[1] for f in found]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("y"), pa.array(ids, pa.list_(pa.int32())), pa.array(counts, pa.list_(pa.int32()))],
                ["doc_id", "y", "terms", "counts"],
            )

    return run


def _packed(terms: np.ndarray, counts: np.ndarray) -> bytes:
    """Rising numbers and counts in few bytes; the first two say how wide a gap and a count are."""
    gaps = np.diff(terms, prepend=0)
    wide = 2 if gaps.max(initial=0) < 2**16 else 4, 1 if counts.max(initial=0) < 2**8 else 4
    return bytes(wide) + gaps.astype(f"<u{wide[0]}").tobytes() + counts.astype(f"<u{wide[1]}").tobytes()


def _unpacked(packed: bytes) -> tuple[np.ndarray, np.ndarray]:
    gap, count = packed[0], packed[1]
    n = (len(packed) - 2) // (gap + count)
    gaps = np.frombuffer(packed, f"<u{gap}", n, 2)
    return np.cumsum(gaps, dtype=np.int64), np.frombuffer(packed, f"<u{count}", n, 2 + gap * n).astype(np.int64)


def _with_terms(vocabulary, text: str, keep_text: bool, terms: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary.value
        for batch in batches:
            found = pa.array([_packed(*_terms_in(t.as_py() or "", known)) for t in batch.column(text)], pa.binary())
            keep = [i for i, name in enumerate(batch.schema.names) if keep_text or name != text]
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in keep), found], [*(batch.schema.names[i] for i in keep), terms])

    return run


def _holding(n_terms: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, held = 0, np.zeros(n_terms, np.int64)
        for batch in batches:
            rows += batch.num_rows
            for packed in batch.column("packed"):
                held[_unpacked(packed.as_py())[0]] += 1
        at = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array([-1], pa.int32()), pa.array([rows], pa.int64())], ["term", "held"])
        for i in range(0, len(at), 50_000):
            part = at[i : i + 50_000]
            yield pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), pa.array(held[part])], ["term", "held"])

    return run


def document_frequencies(cut: DataFrame, n_terms: int, terms: str) -> tuple[int, np.ndarray]:
    """The number of all documents, and of those that hold each term of the vocabulary."""
    held = cut.select(F.col(terms).alias("packed")).mapInArrow(_holding(n_terms), "term int, held long")
    summed = held.groupBy("term").agg(F.sum("held").alias("held")).toArrow()  # one row for each term
    numbers, counts = summed["term"].to_numpy(), summed["held"].to_numpy()
    df = np.zeros(n_terms, np.int64)
    df[numbers[numbers >= 0]] = counts[numbers >= 0]
    return int(counts[numbers < 0].sum()), df


def isotonic(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Non-decreasing weighted fit: the points and the fitted values, one for each level."""
    levels: list[list[float]] = []  # weight, weighted sum, least x, largest x
    order = np.lexsort((y, x))
    for a, b, c in zip(x[order], y[order], w[order], strict=True):
        if levels and levels[-1][3] == a:
            levels[-1][0] += c
            levels[-1][1] += b * c
        else:
            levels.append([c, b * c, a, a])
        while len(levels) > 1 and levels[-2][1] * levels[-1][0] >= levels[-1][1] * levels[-2][0]:
            last = levels.pop()
            levels[-1] = [levels[-1][0] + last[0], levels[-1][1] + last[1], levels[-1][2], last[3]]
    at = np.array([v for level in levels for v in level[2:]])
    return at, np.array([level[1] / level[0] for level in levels for _ in range(2)])


def _ranges(first: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers ``first[i] .. first[i] + sizes[i] - 1`` one after the other."""
    before = np.cumsum(sizes) - sizes
    return np.repeat(first - before, sizes) + np.arange(int(sizes.sum()))


def like_order(sketch: np.ndarray, block: int) -> np.ndarray:
    """Rows in an order that puts like ones together: halves along the widest direction, again and again."""
    out, todo = [], [np.arange(len(sketch))]
    while todo:
        rows = todo.pop()
        if len(rows) <= block:
            out.append(rows)
            continue
        x = sketch[rows] - sketch[rows].mean(0)
        widest = np.linalg.eigh(x.T @ x)[1][:, -1]
        rows = rows[np.argsort(x @ widest, kind="stable")]
        half = block * max(1, len(rows) // 2 // block)
        todo += [rows[half:], rows[:half]]
    return np.concatenate([*out, np.empty(0, np.int64)]).astype(np.int64)


@dataclass
class NearestExamples:
    """The examples' block-max index. ``ids`` are the examples' document ids, in their order.

    ``terms`` and ``weights`` hold the examples' vectors one after the other; the rest is made from
    them where it is used.
    """

    ids: np.ndarray
    labels: np.ndarray
    idf: np.ndarray
    neighbours: int
    without_terms: float
    at: np.ndarray
    value: np.ndarray
    start: np.ndarray
    terms: np.ndarray
    weights: np.ndarray

    def arrange(self) -> None:
        """Blocks of like examples, postings of rare terms, blocks and their maxima of common ones."""
        n, m = len(self.ids), len(self.idf)
        example = np.repeat(np.arange(n, dtype=np.int32), np.diff(self.start))
        mixed = np.arange(m, dtype=np.uint64) * MULTIPLIERS[0] >> np.uint64(32)
        bucket = (mixed % np.uint64(SKETCH)).astype(np.int32)
        sign = np.where(mixed & np.uint64(1 << 20), np.float32(1), np.float32(-1))
        del mixed
        sketch = np.bincount(example * np.int32(SKETCH) + bucket[self.terms], self.weights * sign[self.terms], n * SKETCH)
        self.example_at = like_order(sketch.reshape(n, SKETCH), BLOCK)
        del bucket, sign, sketch
        place = np.empty(n, np.int32)
        place[self.example_at] = np.arange(n)
        at = place[example]
        held = np.bincount(self.terms, minlength=m)
        common = np.flatnonzero(held * COMMON >= max(n, 1))
        self.common_at = np.full(m, -1, np.int32)
        self.common_at[common] = np.arange(len(common))
        row = self.common_at[self.terms]
        self.blocks = -(-n // BLOCK)
        self.common = np.zeros((self.blocks, len(common), BLOCK), np.float32)
        often = row >= 0
        self.common[at[often] // BLOCK, row[often], at[often] % BLOCK] = self.weights[often]
        self.common_most = np.ascontiguousarray(self.common.max(2, initial=0).T)
        rare = np.flatnonzero(~often).astype(np.int32)
        rare = rare[np.argsort(self.terms[rare], kind="stable")]
        del example, row, often
        self.posting_at, self.posting_weight = at[rare], self.weights[rare].astype(np.float32)
        self.posting_start = np.concatenate([[0], np.cumsum(np.bincount(self.terms[rare], minlength=m))])
        self.margin = 8 * (len(common) + 64) * 2.0**-24
        self.whole = np.zeros(m)
        self.skipped = self.compared = 0

    def disarrange(self) -> None:
        """Forgets what :meth:`arrange` made."""
        self.__dict__ = self.__getstate__()

    def __getstate__(self) -> dict:
        return {f.name: self.__dict__[f.name] for f in fields(self)}

    def vector(self, terms: np.ndarray, counts: np.ndarray) -> np.ndarray:
        v = (1 + np.log(counts)) * self.idf[terms]
        norm = np.sqrt(v @ v)
        return v / norm if norm else v

    def rough(self, terms: list[np.ndarray], vectors: list[np.ndarray], leave_out: np.ndarray | None = None) -> np.ndarray:
        """Cosines of some texts with the examples in their blocks, in single precision; 0 where a
        block was skipped. ``leave_out`` has the place of an example for each text that it must not meet."""
        if not hasattr(self, "whole"):
            self.arrange()
        n, texts = self.blocks * BLOCK, np.arange(len(terms))
        out = np.empty((len(terms), n), np.float32)
        wide = np.zeros((len(terms), len(self.common_most)), np.float32)
        for i, (t, v) in enumerate(zip(terms, vectors, strict=True)):
            at = self.common_at[t]
            wide[i, at[at >= 0]] = v[at >= 0]
            t, v = t[at < 0], v[at < 0].astype(np.float32)
            first = self.posting_start[t]
            sizes = self.posting_start[t + 1] - first
            where = _ranges(first, sizes)
            out[i] = np.bincount(self.posting_at[where], self.posting_weight[where] * np.repeat(v, sizes), n)
        by_block = out.reshape(len(terms), self.blocks, BLOCK)
        bound = by_block.max(2, initial=0) + wide @ self.common_most
        k, done = min(self.neighbours, n), np.zeros(bound.shape, bool)
        needed = done.copy()
        needed[texts[:, None], np.argsort(-bound, axis=1)[:, :FIRST_BLOCKS]] = True
        for _ in range(2):
            for b in np.flatnonzero(needed.any(0)):
                own = np.flatnonzero(needed[:, b])
                by_block[own, b] += wide[own] @ self.common[b]
            done |= needed
            if leave_out is not None:
                out[texts, leave_out] = 0
            known = np.where(done[:, :, None], by_block, 0).reshape(len(terms), n)
            last = np.partition(known, n - k, axis=1)[:, n - k] if n else np.zeros(len(terms))
            needed = ~done & (bound > 0) & (bound >= last[:, None] - self.margin)
            if not needed.any():
                break
        self.compared += int(done.sum())
        self.skipped += int((~done & (bound > 0)).sum())
        return known

    def best(self, terms: np.ndarray, vector: np.ndarray, rough: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The examples of the largest cosines above zero, ties by their order, and the cosines.

        All that the error of single precision could put among them are compared exactly.
        """
        k = min(self.neighbours, len(rough))
        least = np.partition(rough, len(rough) - k)[len(rough) - k] if k else 0.0
        found = np.flatnonzero((rough > 0) & (rough >= least - self.margin))
        found = np.sort(self.example_at[found])
        self.whole[terms] = vector
        ends = zip(self.start[found].tolist(), self.start[found + 1].tolist(), strict=True)
        # Clipping changes nothing, for all numbers lie inside; it spares a check of each.
        cosines = np.array([self.whole.take(self.terms[a:b], mode="clip") @ self.weights[a:b] for a, b in ends])
        self.whole[terms] = 0
        order = np.lexsort((found, -np.round(cosines, 12)))[:k]
        return found[order], cosines[order]

    def nearest(self, terms: np.ndarray, vector: np.ndarray, leave_out: int = -1) -> tuple[np.ndarray, np.ndarray]:
        if not hasattr(self, "whole"):
            self.arrange()
        out = np.flatnonzero(self.example_at == leave_out) if leave_out >= 0 else None
        return self.best(terms, vector, self.rough([terms], [vector], out)[0])

    def vote(self, at: np.ndarray, cosines: np.ndarray) -> float:
        weight = 1 / (1.05 - np.minimum(cosines, 1))
        return float(weight @ self.labels[at] / weight.sum())

    def judge(self, terms: list[np.ndarray], counts: list[np.ndarray]) -> list[tuple[float, np.ndarray, np.ndarray]]:
        """Score, neighbours and their cosines of each text."""
        out = [(self.without_terms, self.ids[:0], np.empty(0))] * len(terms)
        full = [i for i, t in enumerate(terms) if len(t) and len(self.ids)]
        for first in range(0, len(full), TEXTS):
            part = full[first : first + TEXTS]
            vectors = [self.vector(terms[i], counts[i]) for i in part]
            for i, v, rough in zip(part, vectors, self.rough([terms[i] for i in part], vectors), strict=True):
                at, cosines = self.best(terms[i], v, rough)
                if len(at):
                    out[i] = float(np.interp(self.vote(at, cosines), self.at, self.value)), self.ids[at], cosines
        return out


def build_index(
    ids: np.ndarray, labels: np.ndarray, terms: list, counts: list, idf: np.ndarray, share: float, neighbours: int = NEIGHBOURS
) -> NearestExamples:
    """Index and calibration; ``share`` is the share of toxic rows among all labels."""
    n = len(ids)
    start = np.concatenate([[0], np.cumsum([len(t) for t in terms])]).astype(np.int64)
    index = NearestExamples(
        ids, labels, idf, neighbours, share, np.array([0.0]), np.array([share]), start, np.concatenate([*terms, np.empty(0, np.int32)]).astype(np.int32), np.empty(start[-1])
    )
    vectors = [index.weights[a:b] for a, b in zip(start[:-1], start[1:], strict=True)]
    for v, t, c in zip(vectors, terms, counts, strict=True):
        v[:] = index.vector(t, c)
    # Rows stand for their class's share among all labels.
    toxic = max(1, int(labels.sum()))
    row_weight = np.where(labels == 1, share / toxic, (1 - share) / max(1, n - toxic))
    index.arrange()
    votes, has = np.zeros(n), np.zeros(n, bool)
    place = np.argsort(index.example_at)
    for first in range(0, n, TEXTS):
        part = slice(first, min(n, first + TEXTS))
        for i, rough in enumerate(index.rough(terms[part], vectors[part], place[part]), first):
            at, cosines = index.best(terms[i], vectors[i], rough)
            if len(at):
                votes[i], has[i] = index.vote(at, cosines), True
    if has.any():
        index.at, index.value = isotonic(votes[has], labels[has].astype(float), row_weight[has])
    least = 0.5 * min([*row_weight, 1.0]) if n else 1.0  # half a row for each side
    none = ~has
    if none.any():
        w = row_weight[none]
        index.without_terms = float((w @ labels[none] + least) / (w.sum() + 2 * least))
    index.disarrange()  # the driver judges nothing more
    return index


def fit(
    docs: DataFrame,
    labels: DataFrame,
    learn: Column,
    text_col: str = "text",
    per_class: int = SAMPLE_PER_CLASS,
    with_text: bool = False,
) -> tuple[NearestExamples, DataFrame, str]:
    """The index, and ``docs`` cut into terms (written), with the name of the column that has them.

    ``learn`` picks by ``doc_id`` the labelled rows that may be learnt from; at most
    ``per_class`` of each class are. The text is kept if ``with_text``.
    """
    sample = written(labelled_sample(docs, labels, "toxic", learn, per_class), "labelled")
    sample = written(one_of_each_family(sample), "examples")
    vocabulary, weight = weigh_terms(sample)
    shared = docs.sparkSession.sparkContext.broadcast(_Vocabulary(vocabulary))
    docs = docs.withColumn(text_col, F.col(text_col).cast("string"))
    (terms,) = fresh_name(docs, "terms_")
    schema = extended((docs if with_text else docs.drop(text_col)).schema, **{terms: BinaryType()})
    docs = written(docs.mapInArrow(_with_terms(shared, text_col, with_text, terms), schema), "terms")
    n, df = document_frequencies(docs, len(vocabulary), terms)
    idf = (np.log((1 + n) / (1 + df)) + 0.1) * weight
    cut = sample.select("doc_id", F.col("y").cast("int").alias("y"), "text").mapInArrow(
        _cut(shared), "doc_id long, y int, terms array<int>, counts array<int>"
    )
    rows = cut.toArrow().sort_by("doc_id")
    known = labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull()).groupBy("doc_id").agg(F.max("toxic").alias("y"))
    share = known.filter(learn).agg(F.avg(F.col("y").cast("double"))).first()[0]
    index = build_index(
        rows["doc_id"].to_numpy().astype(np.int64),
        rows["y"].to_numpy().astype(np.int64),
        [t.values.to_numpy() for t in rows["terms"]],
        [c.values.to_numpy() for c in rows["counts"]],
        idf,
        float(share or 0.0),
    )
    del rows
    give_back()
    return index, docs, terms


def _verdicts(got: list[tuple[float, np.ndarray, np.ndarray]]) -> list[pa.Array]:
    return [
        pa.array([g[0] for g in got], pa.float64()),
        pa.array([g[1].tolist() for g in got], pa.list_(pa.int64())),
        pa.array([g[2].tolist() for g in got], pa.list_(pa.float64())),
    ]


def _judged(model, terms: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = model.value
        for batch in batches:
            got = []
            for first in range(0, batch.num_rows, TEXTS):
                found = [_unpacked(p.as_py()) for p in batch.column(terms).slice(first, TEXTS)]
                got += index.judge([f[0] for f in found], [f[1] for f in found])
            keep = [i for i, name in enumerate(batch.schema.names) if name != terms]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in keep), *_verdicts(got)],
                [*(batch.schema.names[i] for i in keep), "score", "neighbours", "cosines"],
            )

    return run


def score_toxicity(
    docs: DataFrame, labels: DataFrame, learn: Column, text_col: str = "text", with_text: bool = False
) -> DataFrame:
    """``docs`` with ``score``, ``neighbours`` and ``cosines``, and its text if ``with_text``.

    The score is the calibrated probability that a text is toxic. A text that shares no term
    with any example (also a null or empty one) has no neighbours and the share of toxic rows
    among such examples as its score. Equal texts have equal scores; ties between neighbours
    go to the smaller id. Without labels of both classes the score is the share of toxic labels,
    zero without labels. Columns named like a result are replaced; others pass through.
    """
    taken = {"score", "neighbours", "cosines"} - {text_col}
    docs = docs.drop(*[c for c in docs.columns if c.lower() in taken])
    index, docs, terms = fit(docs, labels, learn, text_col, with_text=with_text)
    run = _judged(docs.sparkSession.sparkContext.broadcast(index), terms)
    schema = extended(docs.drop(terms).schema, score=DOUBLE, neighbours=array_of(LONG), cosines=array_of(DOUBLE))
    return docs.mapInArrow(run, schema)
