"""Packing documents into sequences along a space-filling curve.

A document's token counts are hashed to a vector of fixed width, projected to three dimensions
and placed on a Hilbert curve, so documents with like wording get near positions. The documents
are range-sorted by that position, and every partition packs its run of the curve: ids are laid
end to end and cut at the sequence length. What is left at the end of a partition is cut into
powers of two, so no sequence needs padding, whatever the number of partitions.

Ties on the curve (copies) are ordered by id and position in the input, so a hot position is
spread over as many partitions as it needs. A task holds one batch and the open sequence.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.llm.common import parallelism, text_or_empty, written
from barloom.llm.tokens import encoder

HASHED, DIMENSIONS, BITS, SEED = 4096, 3, 20, 20240501
END_ID = 0


def hilbert_key(points: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Positions on the Hilbert curve of integer points ``(n, d)`` with ``bits`` bits a side.

    The high bits are undone one by one: where a coordinate's bit is set the first coordinate is
    reflected in what lies below, elsewhere the two are exchanged there. A Gray code follows.
    """
    x = [points[:, i].astype(np.int64).copy() for i in range(points.shape[1])]
    for bit in range(bits - 1, 0, -1):
        below = (1 << bit) - 1
        for i in range(len(x)):
            is_set = (x[i] >> bit) & 1 == 1
            exchanged = np.where(is_set, 0, (x[0] ^ x[i]) & below)
            x[0] = np.where(is_set, x[0] ^ below, x[0]) ^ exchanged
            x[i] = x[i] ^ exchanged if i else x[0]
    for i in range(1, len(x)):
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    for bit in range(bits - 1, 0, -1):
        turn ^= np.where((x[-1] >> bit) & 1 == 1, (1 << bit) - 1, 0)
    key = np.zeros_like(x[0])
    for bit in range(bits - 1, -1, -1):
        for c in x:
            key = (key << 1) | (((c ^ turn) >> bit) & 1)
    return key


def _projection(vocabulary: int) -> np.ndarray:
    """Rows of the hashed vector's projection for every token id, a function of the seed alone."""
    rng = np.random.Generator(np.random.PCG64(SEED))
    return rng.standard_normal((HASHED, DIMENSIONS))[rng.integers(0, HASHED, vocabulary)]


def _tokenised(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        size = enc.vocabulary.size
        projection = _projection(size)
        end = np.array([END_ID], enc.dtype).tobytes()
        for batch in batches:
            ids = [enc.encode(t) + end for t in batch.column("text").to_pylist()]
            points = np.empty((len(ids), DIMENSIONS))
            for i, raw in enumerate(ids):
                row = np.frombuffer(raw, enc.dtype)
                points[i] = projection[row].sum(0) / len(row)
            # The projection of a mean of n tokens lies within a few units of zero; beyond, it is clamped.
            scaled = np.clip((points + 4) / 8, 0, 1) * ((1 << BITS) - 1)
            key = hilbert_key(scaled.astype(np.int64))
            n = pa.array([len(x) // enc.dtype.itemsize for x in ids], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("row"), pa.array(key), n, pa.array(ids, pa.binary())],
                ["doc_id", "row", "key", "n", "ids"],
            )

    return run


FIELDS = ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def _packed(length: int, dtype: str, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 33
        held: list[tuple] = []  # pieces of the open sequence: document, start, ids, document's tokens
        fill = 0
        out: list[tuple] = []

        def close(pieces: list[tuple]) -> None:
            nonlocal number
            at = 0
            for doc, start, ids, total in pieces:
                row = (doc, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes()), total, number, at)
                out.append((*row, ids.astype(np.int32)) if with_ids else row)
                at += len(ids)
            number += 1

        def batch_of() -> pa.RecordBatch:
            columns = list(zip(*out, strict=True)) or [[] for _ in range(len(FIELDS) + with_ids)]
            arrays = [pa.array(list(c), pa.int64()) for c in columns[: len(FIELDS)]]
            names = list(FIELDS)
            if with_ids:
                arrays.append(pa.array(list(columns[-1]), pa.list_(pa.int32())))
                names.append("ids")
            out.clear()
            return pa.RecordBatch.from_arrays(arrays, names)

        for batch in batches:
            docs = batch.column("doc_id").to_pylist()
            for i, doc in enumerate(docs):
                ids = np.frombuffer(batch.column("ids")[i].as_buffer(), dtype)
                start = 0
                while start < len(ids):
                    piece = ids[start : start + length - fill]
                    held.append((doc, start, piece, len(ids)))
                    start += len(piece)
                    fill += len(piece)
                    if fill == length:
                        close(held)
                        held, fill = [], 0
            held = [(d, s, p.copy(), t) for d, s, p, t in held]  # the batch may go
            yield batch_of()
        while held:
            size = 1 << (fill.bit_length() - 1)
            part, rest, taken = [], [], 0
            for doc, start, ids, total in held:
                cut = min(len(ids), size - taken)
                if cut:
                    part.append((doc, start, ids[:cut], total))
                if cut < len(ids):
                    rest.append((doc, start + cut, ids[cut:], total))
                taken += cut
            close(part)
            held, fill = rest, fill - size
        yield batch_of()

    return run


def pack(
    docs: DataFrame, vocabulary: str, length: int = 1024, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False
) -> DataFrame:
    """Pieces ``(doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset)``.

    Each document is its ids and then id 0. A null or empty text is that one id; rows that
    repeat an id are documents of their own; a null id stays null. An empty table gives an
    empty result. Other columns are ignored, whatever their names. ``with_ids`` adds the
    token ids of each piece.
    """
    if length & (length - 1):
        raise ValueError("the sequence length must be a power of two")
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.monotonically_increasing_id().alias("row"),
        text_or_empty(F.col(text_col)).alias("text"),
    )
    schema = "doc_id long, row long, key long, n long, ids binary"
    # Sorting by range reads its input twice, so the ids are written first.
    ready = written(rows.mapInArrow(_tokenised(vocabulary), schema), "tokens")
    order = ["key", "doc_id", "row"]
    lined = ready.repartitionByRange(parallelism(docs.sparkSession), *order).sortWithinPartitions(*order)
    fields = ", ".join(f"{f} long" for f in FIELDS) + (", ids array<int>" if with_ids else "")
    dtype = encoder(vocabulary).dtype.str
    return lined.mapInArrow(_packed(length, dtype, with_ids), fields)
