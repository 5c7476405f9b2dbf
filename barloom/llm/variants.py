"""Spelling variants by a trie over letter counts.

Letters are dealt to groups, and a word is described by how often each group occurs in it. One
inserted, deleted or replaced letter changes at most one of these counts upwards and one
downwards. Words are arranged in a trie by the counts of one group after the other; a search
goes down depth first, spending a surplus and a deficit of one each, and whole branches end
where the budget does. Words at the leaves reached are verified letter by letter.

The trie is cut into cells: branches of more than ``CELL`` words are opened level by level, by
counting prefixes, so a cell is a branch of bounded size, wherever the words crowd. Words of one
and the same full vector beyond that bound are dealt to slices. A word is sent to the cells that
its budget can reach and that come at or after its own, so each pair meets once; tasks return
one row for each word with its number of near words and the best of them, never the pairs.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import cache
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.llm.common import parallelism, text_or_empty, written

#: Letters by group, about equally frequent in West European text; all other code points go by their number.
GROUPS = ("e", "a", "t", "o", "i", "n", "s", "r", "h", "ld", "uc", "mf", "pg", "wyb", "vk", "xjqz")
LEVELS = len(GROUPS)
#: Least size of a branch that is opened, and the most branches of the corpus' words that reach it.
CELL, MOST_CELLS = 8192, 4096
LEAF, HELD_WORDS, PAIRS_AT_ONCE = 12, 400_000, 1 << 20
_FACTOR = 0x9E3779B97F4A7C15 | 1


@cache
def _letters() -> bytes:
    """Latin-1 bytes to themselves where they are letters of a word, A to Z in lower case, all else to a space."""
    table = bytearray(b" " * 256)
    for c in (*range(0x61, 0x7B), *range(0xC0, 0x100)):
        table[c] = c
    for c in range(0x41, 0x5B):
        table[c] = c + 32
    return bytes(table)


def runs(text: str) -> list[bytes]:
    """Maximal runs of ``[A-Za-z\\u00C0-\\u00FF]`` in Latin-1, A to Z in lower case."""
    return text.encode("latin-1", "replace").translate(_letters()).split()


def _hash(run: bytes, start: int) -> int:
    return crc32(run if run.isascii() else run.decode("latin-1").encode(), start)


def _counted(least_length: int, slip: int):
    """Sums of words in each task, handed on whenever many are held."""

    def out(held: Counter) -> pa.RecordBatch:
        rows = [(w.decode("latin-1"), n) for w, n in held.items() if n and len(w) >= least_length]
        words, n = zip(*rows, strict=True) if rows else ((), ())
        return pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(n, pa.int64())], ["word", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()
        for batch in batches:
            for name, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                words = runs(text)
                if not words:
                    continue
                held.update(words)
                if slip:
                    own, start = Counter(words), crc32(f"{name}:".encode())
                    for w in [w for w in own if not _hash(w, start) % slip]:
                        at = _hash(w, start) % len(w)
                        held[w] -= own[w]
                        held[w[:at] + w[at + 1 :]] += own[w]
                if len(held) > HELD_WORDS:
                    yield out(held)
                    held.clear()
        yield out(held)

    return run


def corpus_words(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_length: int = 5, least_count: int = 3, slip: int = 0
) -> DataFrame:
    """``(word, n)``: the runs of letters of all whole texts and their number of occurrences.

    With ``slip`` a run whose hash with the document's id is a multiple of it loses one letter
    wherever it stands in that document. Null texts have no words, a null id counts as empty
    text; repeated rows count again. Other columns are not read.
    """
    rows = docs.select(text_or_empty(F.col(id_col)).alias("id"), text_or_empty(F.col(text_col)).alias("text"))
    counts = rows.mapInArrow(_counted(least_length, slip), "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return counts.filter(F.col("n") >= least_count)


@cache
def _group_of() -> np.ndarray:
    out = np.arange(256) % LEVELS
    for g, letters in enumerate(GROUPS):
        for c in letters:
            out[ord(c)] = g
    return out


class Words:
    """Words as one array of code points: ``points[ends[i] : ends[i + 1]]``, with their letter counts."""

    def __init__(self, words: list[str]):
        self.points = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
        self.length = np.fromiter(map(len, words), np.int64, len(words))
        self.ends = np.concatenate([[0], np.cumsum(self.length)])
        row = np.repeat(np.arange(len(words)), self.length)
        low = self.points < 256
        group = np.where(low, _group_of()[np.where(low, self.points, 0)], self.points % LEVELS)
        counts = np.bincount(row * LEVELS + group, minlength=len(words) * LEVELS).reshape(-1, LEVELS)
        #: Counts past two bytes are cut, which can only let more words through to the verification.
        self.counts = np.minimum(counts, 0xFFFF).astype(np.int32)
        self._halves()

    def _halves(self) -> None:
        """Sums over the first half and the rest of a word, for a partner as long or one longer, and one shorter.

        Of two words one change apart, the first halves or the rests are the same, counted by
        the shorter of the two.
        """
        at = np.arange(len(self.points)) - np.repeat(self.ends[:-1], self.length)
        back = np.repeat(self.length, self.length) - at
        value = (self.points.astype(np.uint64) + np.uint64(1)) * np.uint64(_FACTOR)
        value ^= value >> np.uint64(29)
        powers = np.cumprod(np.full(int(self.length.max(initial=0)) + 1, _FACTOR, np.uint64))
        ahead = np.concatenate([[np.uint64(0)], np.cumsum(value * powers[at])])
        behind = np.concatenate([[np.uint64(0)], np.cumsum(value * powers[back])])
        self.first, self.rest = [], []
        for short in (0, 1):
            least = np.maximum(self.length - short, 0)
            half = least // 2
            self.first.append(ahead[self.ends[:-1] + half] - ahead[self.ends[:-1]])
            self.rest.append(behind[self.ends[1:]] - behind[self.ends[1:] - (least - half)])

    def one_change(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Which pairs of words differ by exactly one inserted, deleted or replaced code point."""
        a, b = np.where(self.length[a] <= self.length[b], a, b), np.where(self.length[a] <= self.length[b], b, a)
        longer = self.length[b] - self.length[a]
        maybe = longer <= 1
        s = np.where(longer == 1, 1, 0)
        first, rest = np.stack(self.first), np.stack(self.rest)
        maybe &= (first[0, a] == first[s, b]) | (rest[0, a] == rest[s, b])
        found = np.zeros(len(a), bool)
        left = np.flatnonzero(maybe)
        left = left[np.argsort(self.length[b[left]], kind="stable")]
        start = 0
        while start < len(left):  # pairs of about one length, as a matrix of bounded size
            width = int(self.length[b[left[start]]]) + 8
            n = max(1, (1 << 21) // width)
            part = left[start : start + n]
            part = part[self.length[b[part]] <= width]
            found[part] = self._compared(a[part], b[part], int(self.length[b[part]].max(initial=0)))
            start += len(part)
        return found

    def _matrix(self, rows: np.ndarray, width: int) -> np.ndarray:
        at = self.ends[rows][:, None] + np.arange(width)
        inside = np.arange(width) < self.length[rows][:, None]
        return np.where(inside, self.points[np.where(inside, at, 0)], np.uint32(0xFFFFFFFF))

    def _compared(self, a: np.ndarray, b: np.ndarray, width: int) -> np.ndarray:
        short, long = self._matrix(a, width), self._matrix(b, width)
        differs = short != long
        same_length = self.length[a] == self.length[b]
        before = differs.argmax(1)
        shifted = (short[:, :-1] != long[:, 1:]) & (np.arange(max(width - 1, 0)) >= before[:, None])
        return np.where(same_length, differs.sum(1) == 1, ~shifted.any(1) & differs.any(1))


def reached(queries: np.ndarray, members: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of rows whose counts differ by at most one up and one down, by depth-first search.

    ``members`` are sorted; a node of the trie is a range of them that agree in the first
    columns. All queries that can still reach a node visit it together.
    """
    all_ = np.arange(len(queries))
    nodes = [(0, 0, len(members), all_, np.zeros(len(all_), np.int32), np.zeros(len(all_), np.int32))]
    while nodes:
        level, lo, hi, alive, up, down = nodes.pop()
        if not len(alive):
            continue
        if level == LEVELS or hi - lo <= LEAF:
            step = max(1, (1 << 20) // ((hi - lo) * LEVELS))
            for k in range(0, len(alive), step):
                own = alive[k : k + step]
                over = queries[own][:, None, level:] - members[None, lo:hi, level:]
                spent = np.abs(over).sum(2)
                net = over.sum(2)
                u, d = up[k : k + step, None], down[k : k + step, None]
                q, m = np.nonzero(((spent + net) // 2 + u <= 1) & ((spent - net) // 2 + d <= 1))
                yield own[q], m + lo
            continue
        column = members[lo:hi, level]
        starts = np.flatnonzero(np.concatenate([[True], column[1:] != column[:-1]]))
        own = queries[alive, level]
        for a, b in zip(starts, [*starts[1:], hi - lo], strict=True):
            over = own - column[a]
            u, d = up + np.maximum(over, 0), down + np.maximum(-over, 0)
            keep = (u <= 1) & (d <= 1)
            nodes.append((level + 1, lo + a, lo + b, alive[keep], u[keep], d[keep]))


class Top:
    """The opened branches of the trie: for each known prefix of counts its number of words."""

    def __init__(self, sizes: dict[bytes, int], cell: int):
        self.sizes, self.cell = sizes, cell

    def open(self, prefix: bytes) -> bool:
        return len(prefix) < 2 * LEVELS and self.sizes.get(prefix, 0) > self.cell

    def slices(self, prefix: bytes) -> int:
        return max(1, -(-self.sizes[prefix] // self.cell))

    def cells(self, counts: np.ndarray) -> tuple[bytes, list[bytes]]:
        """The cell of a vector of counts, and all later cells that a word with it can reach."""
        own, found, todo = b"", [], [(b"", 0, 0, True)]
        counts = counts.tolist()
        while todo:
            prefix, up, down, exact = todo.pop()
            if not self.open(prefix):
                if exact:
                    own = prefix
                elif prefix in self.sizes:
                    found.append(prefix)
                continue
            c = counts[len(prefix) // 2]
            todo.append((prefix + c.to_bytes(2, "big"), up, down, exact))
            if not up and c:
                todo.append((prefix + (c - 1).to_bytes(2, "big"), 1, down, False))
            if not down and c < 0xFFFF:
                todo.append((prefix + (c + 1).to_bytes(2, "big"), up, 1, False))
        return own, [p for p in found if p > own]


def _vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts = Words(batch.column("word").to_pylist()).counts.astype(">u2")
        yield pa.RecordBatch.from_arrays([pa.array([r.tobytes() for r in counts], pa.binary())], ["counts"])


def trie_top(words: DataFrame) -> Top:
    """Open every branch that holds more than a cell's words, one level after the other.

    Each level is one aggregate over the words of the branches opened so far. At most
    ``MOST_CELLS`` branches of a level can be larger than a cell, so what is kept here is
    bounded, however many words there are.
    """
    spark, total = words.sparkSession, words.count()
    top = Top({b"": total}, max(CELL, total // MOST_CELLS))
    opened = [b""] if total > top.cell else []
    vectors = written(words.select("word").mapInArrow(_vectors, "counts binary"), "counts") if opened else None
    level = 0
    while opened:
        level += 1
        own = vectors.withColumn("parent", F.substring("counts", 1, 2 * level - 2))
        if level > 1:
            own = own.join(F.broadcast(spark.createDataFrame([(bytearray(p),) for p in opened], "parent binary")), "parent")
        sizes = own.groupBy(F.substring("counts", 1, 2 * level).alias("prefix")).count().collect()
        found = {bytes(r["prefix"]): r["count"] for r in sizes}
        top.sizes.update(found)
        opened = [p for p in found if top.open(p)]
    return top


def _sent(top: Top):
    """Every word to its own cell, and as a visitor to the later cells it can reach."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = batch.column("word").to_pylist()
            counts, which = np.unique(Words(words).counts, axis=0, return_inverse=True)
            reach = [top.cells(c) for c in counts]
            at, cell, part, own = [], [], [], []
            for i, v in enumerate(which.reshape(-1).tolist()):
                home, others = reach[v]
                n = top.slices(home)
                mine = crc32(words[i].encode()) % n if n > 1 else 0
                for c, s in ((home, range(mine, n)), *((c, range(top.slices(c))) for c in others)):
                    for k in s:
                        at.append(i)
                        cell.append(c)
                        part.append(k)
                        own.append(c is home and k == mine)
            yield pa.RecordBatch.from_arrays(
                [pa.array(cell, pa.binary()), pa.array(part, pa.int32()), pa.array(own), *(batch.column(c).take(pa.array(at, pa.int64())) for c in ("word", "n"))],
                ["cell", "slice", "own", "word", "n"],
            )

    return run


def near_in_cell(words: list[str], n: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For every word, how many near words it has among the pairs of this cell, and the best one's place or -1.

    Pairs are two of the cell's own words, or a visitor and one of them. The best is the near
    word of largest ``n``, then the smallest.
    """
    w = Words(words)
    order = np.array(sorted(range(len(words)), key=words.__getitem__), np.int64)
    rank = np.empty(len(words), np.int64)
    rank[np.lexsort((np.argsort(order), -n))] = np.arange(len(words))
    by_rank = np.argsort(rank)
    near, best = np.zeros(len(words), np.int64), np.full(len(words), len(words), np.int64)

    members, visitors = np.flatnonzero(own), np.flatnonzero(~own)
    mine, at_mine, n_mine = _by_vector(w.counts, members)
    theirs, at_theirs, n_theirs = _by_vector(w.counts, visitors)
    queries = np.concatenate([mine, theirs])
    held_at, held_n = np.concatenate([at_mine, at_theirs + len(members)]), np.concatenate([n_mine, n_theirs])
    place = np.concatenate([members[_sorted_by(w.counts, members)], visitors[_sorted_by(w.counts, visitors)]])

    def verify(q: np.ndarray, m: np.ndarray) -> None:
        size = held_n[q] * n_mine[m]
        for part in np.split(np.arange(len(q)), np.flatnonzero(np.diff(np.cumsum(size) // PAIRS_AT_ONCE)) + 1):
            cut = size[part]
            pair = np.repeat(part, cut)
            nth = np.arange(len(pair)) - np.repeat(np.cumsum(cut) - cut, cut)
            a = place[held_at[q[pair]] + nth // n_mine[m[pair]]]
            b = place[at_mine[m[pair]] + nth % n_mine[m[pair]]]
            keep = ~own[a] | (q[pair] != m[pair]) | (a < b)
            a, b = a[keep], b[keep]
            linked = w.one_change(a, b)
            a, b = a[linked], b[linked]
            near[:] += np.bincount(a, minlength=len(words)) + np.bincount(b, minlength=len(words))
            np.minimum.at(best, a, rank[b])
            np.minimum.at(best, b, rank[a])

    waiting, size = [], 0
    for q, m in reached(queries, mine):
        keep = (q >= len(mine)) | (q <= m)  # two own words meet once
        waiting.append((q[keep], m[keep]))
        size += int((held_n[q[keep]] * n_mine[m[keep]]).sum())
        if size > PAIRS_AT_ONCE:
            verify(*(np.concatenate(x) for x in zip(*waiting, strict=True)))
            waiting, size = [], 0
    if size:
        verify(*(np.concatenate(x) for x in zip(*waiting, strict=True)))
    return near, np.where(best < len(words), by_rank[np.minimum(best, len(words) - 1)], -1)


def _sorted_by(counts: np.ndarray, rows: np.ndarray) -> np.ndarray:
    return np.lexsort(counts[rows].T[::-1])


def _by_vector(counts: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct vectors in order, and where the rows of each begin and how many they are."""
    ordered = counts[rows][_sorted_by(counts, rows)]
    if not len(ordered):
        return ordered, np.zeros(0, np.int64), np.zeros(0, np.int64)
    starts = np.flatnonzero(np.concatenate([[True], (ordered[1:] != ordered[:-1]).any(1)]))
    return ordered[starts], starts, np.diff(np.append(starts, len(ordered)))


def _near(table: pa.Table) -> pa.Table:
    words, n = table.column("word").to_pylist(), table.column("n").to_numpy()
    own = table.column("own").combine_chunks().to_numpy(zero_copy_only=False)
    near, best = near_in_cell(words, n, own)
    has = np.flatnonzero(near)
    found = pa.array(has)
    partner = table.take(pa.array(best[has]))
    return pa.table(
        {"word": table.column("word").take(found), "n_near": pa.array(near[has]), "best_n": partner.column("n"), "best": partner.column("word")}
    )


def near_words(words: DataFrame) -> DataFrame:
    """``(word, n, n_near, best, best_n)`` for distinct words ``(word, n)``.

    ``n_near`` counts the words that differ by exactly one inserted, deleted or replaced code
    point; ``best`` is the one of them with the largest ``n``, then the smallest in code-point
    order, and ``best_n`` its ``n`` (null without near words). Words are not null and distinct.
    """
    words = written(words.select("word", F.col("n").cast("long").alias("n")), "words")
    top = trie_top(words)
    spread = words.repartition(parallelism(words.sparkSession))
    sent = spread.mapInArrow(_sent(top), "cell binary, slice int, own boolean, word string, n long")
    found = sent.groupBy("cell", "slice").applyInArrow(_near, "word string, n_near long, best_n long, best string")
    one = found.groupBy("word").agg(
        F.sum("n_near").alias("n_near"), F.min(F.struct((-F.col("best_n")).alias("less"), "best")).alias("first")
    )
    return words.join(one, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.col("first.best").alias("best"), (-F.col("first.less")).alias("best_n")
    )


def roots(forms: DataFrame) -> DataFrame:
    """``(word, root)`` for ``(word, form)``: forms followed to their ends, by doubling."""
    ends = written(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        onward = ends.select(F.col("word").alias("root"), F.col("root").alias("further"))
        moved = written(ends.join(onward, "root", "left").select("word", "root", "further"), "roots")
        ends = moved.select("word", F.coalesce("further", "root").alias("root"))
        if moved.filter("further is not null").isEmpty():
            return ends


def spelling_variants(words: DataFrame, factor: int = 2) -> DataFrame:
    """``(word, form, root, n, n_near, form_n)`` for distinct words ``(word, n)``.

    A word's ``form`` is its near word of largest ``n`` (ties: the smallest in code-point order)
    if that is at least ``factor`` times its own, else null; ``root`` is where the forms lead,
    the word itself if it has none. Counts rise along the way (``factor`` is above 1), so no
    way comes back. An empty table gives an empty result.
    """
    near = written(near_words(words), "near-words")
    formed = near.withColumn("form", F.when(F.col("best_n") >= factor * F.col("n"), F.col("best")))
    ends = roots(formed.filter("form is not null"))
    return formed.join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", F.when(F.col("form").isNotNull(), F.col("best_n")).alias("form_n")
    )
