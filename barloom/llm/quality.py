"""A quality classifier: random-indexing word vectors and a two-layer network.

Every word has two forms: its lower-cased letters, and its shape, such as ``Aa.`` for ``The.``;
repeated words and lines count as shapes of their own. A form's index vector is a sparse ternary vector drawn from its
hash. Its word vector is its own index vector and the sum of the index vectors of its
neighbours over the training sample, each of length one. A document is the mean of its words'
vectors. A network with one hidden layer reads it, and a temperature fitted on rows kept out of
training calibrates its probabilities.

Word forms are hashed to a fixed number of vectors, so a model has the same size for any
corpus. It is fitted on the driver on a bounded sample of labelled rows; scoring is one pass over the
documents without a shuffle.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.llm.common import DOUBLE, extended, fresh_name, give_back, text_or_empty

SAMPLE_PER_CLASS, WORD_FORMS, SHAPE_FORMS, WIDTH, NONZERO, REACH, HIDDEN = 2000, 4096, 1024, 64, 6, 2, 32
SEED, EPOCHS, BATCH, STEP, DECAY = 7, 60, 128, 0.003, 1e-3
CACHED_WORDS = 300_000
_RUNS = ((re.compile(r"[^\W\d_]+"), lambda m: _case(m[0])), (re.compile(r"\d+"), "0"), (re.compile(r"(.)\1+"), r"\1"))
_NO_LETTER = re.compile(r"[\W\d_]+")


def _case(letters: str) -> str:
    if letters.islower():
        return "a"
    return "A" if letters.isupper() else "Aa" if letters[0].isupper() and not letters[1:].isupper() else "aA"


def shape(word: str) -> str:
    """Runs of letters by case, digits as 0, other characters once for each run."""
    stem = word.rstrip(".,")
    if stem.isalpha() and len(word) - len(stem) < 2:  # most words; the general way gives the same
        return _case(stem) + word[len(stem) :]
    word = word[:40]
    for pattern, to in _RUNS:
        word = pattern.sub(to, word)
    return word[:8]


def _form(word: str) -> int:
    """The word's form number and its shape's, in one number."""
    letters = word.lower()
    if not letters.isalpha():
        letters = _NO_LETTER.sub("", letters)
    return crc32(letters.encode()) % WORD_FORMS * SHAPE_FORMS + crc32(shape(word).encode()) % SHAPE_FORMS


class _Forms(dict):
    def __missing__(self, word: str) -> int:
        form = _form(word)
        if len(word) <= 40:
            if len(self) >= CACHED_WORDS:
                self.clear()
            self[word] = form
        return form


_forms = _Forms()
Forms = tuple[np.ndarray, np.ndarray, np.ndarray]
EXTRA = 4


def forms_of(text: str) -> Forms:
    """Word forms and shape forms in order, and the document's shares of repetition."""
    words = text.split()
    both = np.fromiter(map(_forms.__getitem__, words), np.int32, len(words))
    lines = [x for x in text.split("\n") if x]
    n = max(1, len(words))
    extra = [
        sum(map(eq, words, words[1:])) / n,
        1 - len(set(lines)) / max(1, len(lines)),
        1 - len(set(words)) / n,
        np.log1p(len(words)) / 10,
    ]
    return both // SHAPE_FORMS, both % SHAPE_FORMS, np.array(extra)


def index_vectors(n: int, seed: int) -> np.ndarray:
    """Sparse ternary vectors, a function of the seed alone."""
    rng = np.random.Generator(np.random.PCG64(seed))
    out = np.zeros((n, WIDTH), np.float32)
    for _ in range(NONZERO):
        out[np.arange(n), rng.integers(0, WIDTH, n)] += rng.choice([-1.0, 1.0], n)
    return out


def word_vectors(sequences: list[np.ndarray], n: int, seed: int) -> np.ndarray:
    """Index vector plus the sum of the neighbours' index vectors, each of length one."""
    index = index_vectors(n, seed)
    context = np.zeros_like(index)
    for seq in sequences:
        for d in range(1, REACH + 1):
            near = np.concatenate([seq[:-d], seq[d:]])
            order = np.argsort(at := np.concatenate([seq[d:], seq[:-d]]), kind="stable")
            forms, first = np.unique(at[order], return_index=True)
            if len(forms):
                context[forms] += np.add.reduceat(index[near[order]], first)

    def unit(m: np.ndarray) -> np.ndarray:
        return m / np.maximum(np.linalg.norm(m, axis=1, keepdims=True), 1e-9)

    return (unit(index) + unit(context)).astype(np.float32)


@dataclass(frozen=True)
class QualityModel:
    words: np.ndarray
    shapes: np.ndarray
    mean: np.ndarray
    spread: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float

    def pooled(self, text: str) -> np.ndarray:
        return pooled(forms_of(text), self.words, self.shapes)

    def probability(self, pooled: np.ndarray) -> np.ndarray:
        x = (pooled - self.mean) / self.spread
        z = (np.maximum(x @ self.w1 + self.b1, 0) @ self.w2 + self.b2) / self.temperature
        return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def pooled(forms: Forms, words: np.ndarray, shapes: np.ndarray) -> np.ndarray:
    w, s, extra = forms
    if not len(w):
        return np.concatenate([np.zeros(2 * WIDTH), extra])
    counts = np.bincount(s, minlength=SHAPE_FORMS)
    used = np.flatnonzero(counts)
    return np.concatenate([words[w].mean(0), counts[used] @ shapes[used] / len(s), extra])


def train(rows: list[Forms], labels: np.ndarray) -> QualityModel:
    """Fit vectors, network and temperature. Every fifth row only sets the temperature."""
    words = word_vectors([w for w, _, _ in rows], WORD_FORMS, SEED)
    shapes = word_vectors([s for _, s, _ in rows], SHAPE_FORMS, SEED + 1)
    x = np.array([pooled(r, words, shapes) for r in rows]).reshape(len(rows), 2 * WIDTH + EXTRA)
    y = np.asarray(labels, np.float64)
    mean, spread = (x.mean(0), x.std(0) + 1e-3) if len(x) else (np.zeros(x.shape[1]), np.ones(x.shape[1]))
    aside = np.arange(len(x)) % 5 == 4
    xs = (x - mean) / spread
    rng = np.random.Generator(np.random.PCG64(SEED))
    p = [
        rng.normal(0, np.sqrt(2 / x.shape[1]), (x.shape[1], HIDDEN)),
        np.zeros(HIDDEN),
        rng.normal(0, np.sqrt(1 / HIDDEN), HIDDEN),
        np.zeros(1),
    ]
    m, v, t = [np.zeros_like(a) for a in p], [np.zeros_like(a) for a in p], 0
    fit = np.flatnonzero(~aside)
    for _ in range(EPOCHS):
        rng.shuffle(fit)
        for at in range(0, len(fit), BATCH):
            b = fit[at : at + BATCH]
            h = np.maximum(xs[b] @ p[0] + p[1], 0)
            err = (1 / (1 + np.exp(-np.clip(h @ p[2] + p[3], -40, 40))) - y[b]) / len(b)
            back = np.outer(err, p[2]) * (h > 0)
            grads = [xs[b].T @ back + DECAY * p[0], back.sum(0), h.T @ err + DECAY * p[2], err.sum(keepdims=True)]
            t += 1
            for i, g in enumerate(grads):
                m[i] = 0.9 * m[i] + 0.1 * g
                v[i] = 0.999 * v[i] + 0.001 * g * g
                p[i] = p[i] - STEP * (m[i] / (1 - 0.9**t)) / (np.sqrt(v[i] / (1 - 0.999**t)) + 1e-8)
    z = np.maximum(xs[aside] @ p[0] + p[1], 0) @ p[2] + p[3]

    def loss(temperature: float) -> float:
        q = np.clip(1 / (1 + np.exp(-np.clip(z / temperature, -40, 40))), 1e-9, 1 - 1e-9)
        return -float(np.mean(y[aside] * np.log(q) + (1 - y[aside]) * np.log(1 - q)))

    temperature = min(np.geomspace(0.5, 8, 41), key=loss) if aside.any() else 1.0
    return QualityModel(words, shapes, mean, spread, *p[:3], float(p[3][0]), float(temperature))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, learn: Column, per_class: int) -> DataFrame:
    """``(doc_id, y, text)`` of at most ``per_class`` labelled rows of each class.

    ``learn`` picks rows by ``doc_id``. Rows are taken in the order of a hash of the id, so the
    sample does not depend on the order of the input. Of repeated labels the largest counts, of
    repeated documents one. Both tables are reduced to the sample by key before any text moves.
    """
    known = (
        labels.filter(F.col("doc_id").isNotNull() & F.col(label).isNotNull())
        .groupBy("doc_id")
        .agg(F.max(label).alias("y"))
        .filter(learn)
    )
    picked = [known.filter(F.col("y") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class) for y in (0, 1)]
    chosen = F.broadcast(picked[0].union(picked[1]))  # at most 2 * per_class short rows
    return docs.select("doc_id", text_or_empty(F.col("text")).alias("text")).join(chosen, "doc_id").dropDuplicates(["doc_id"])


def fit_quality(docs: DataFrame, labels: DataFrame, learn: Column, per_class: int = SAMPLE_PER_CLASS) -> QualityModel:
    """A model from at most ``per_class`` rows of each class. Without rows of both classes it is
    what an untrained network says."""
    sample = labelled_sample(docs, labels, "quality", learn, per_class).orderBy("doc_id").toLocalIterator()
    rows, y = [], []
    for r in sample:
        rows.append(forms_of(r["text"]))
        y.append(r["y"])
    order = np.random.Generator(np.random.PCG64(SEED)).permutation(len(rows))
    model = train([rows[i] for i in order], np.array([y[i] for i in order], np.float64))
    del rows, y
    give_back()
    return model


def _scored(model, text: str, score: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model.value
        for batch in batches:
            rows = [m.pooled(t or "") for t in batch.column(text).to_pylist()]
            got = m.probability(np.array(rows).reshape(len(rows), 2 * WIDTH + EXTRA))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(got, pa.float64())], [*batch.schema.names, score])

    return run


def score_quality(docs: DataFrame, model: QualityModel, text_col: str = "text", score_col: str = "score") -> DataFrame:
    """``docs`` with the calibrated probability of good quality.

    Null texts count as empty; an empty text has the score of an empty pool. Rows are scored by
    their text alone, so equal texts have equal scores. Columns pass through by any name; one
    named like the score is replaced.
    """
    docs = docs.drop(*[c for c in docs.columns if c.lower() == score_col.lower()])
    (text,) = fresh_name(docs, "text_")
    wide = docs.withColumn(text, text_or_empty(F.col(text_col)))
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = extended(wide.schema, **{score_col: DOUBLE})
    return wide.mapInArrow(_scored(shared, text, score_col), schema).drop(text)
