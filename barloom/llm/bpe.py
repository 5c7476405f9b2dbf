"""Byte-level BPE by a tokenization automaton.

The automaton reads tokens and accepts exactly the sequences that the merges produce. It starts
as one state with an arc for every byte. Each merge (a, b) -> c, in order, applies one gadget:
the arcs of a lead to a copy of their state without the arc b, and wherever a could be read, c
can be read, leading to where b led. Every token's arcs lead to one state, so a copy costs one
entry: the arc it lacks. An arc of a merged token exists where the arc of its left part existed
when the merge came.

Exactly one path spells any string, so the state after a string is a function of the string.
Encoding walks a table from (string state, byte) to string state. A string state holds which
tokens are begun and may still end, with the automaton states they began in, and the arc that
ends there. States in which the same longer tokens can be read count as one, so strings of different words meet
in few string states and a new word needs few new entries. A table entry is computed when it is
first needed. The path is read off from its end, arc by arc. Decoding emits the labels of the arcs.

Automaton and tables are made in each Python worker from the vocabulary file; tables are
emptied when full.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.llm.common import INT, array_of, extended, fresh_name, text_or_empty
from barloom.llm.tokens import NOT_PLAIN, Pieces, Vocabulary

TABLE_ENTRIES, TABLE_WORD, ROWS = 250_000, 48, 512
#: What is begun in the empty string; automaton states whose readable tokens are kept; a time after all merges.
START, KEPT_STATES, NEVER = (0, 0), 4096, 2**31 - 1
#: Fixed value: the pre-split pattern of this kind of vocabulary; white space is Unicode's.
PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
    r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
)


class MergeAutomaton:
    """States are numbers; state 0 is the start. A state lacks the arcs of its line up to its
    time, and of the lines before it."""

    def __init__(self, vocabulary: Vocabulary):
        ids = vocabulary.ids
        self.single = {bytes([b]): ids[bytes([b])] for b in range(256) if bytes([b]) in ids}
        self.line, self.until = [0], [0]  # of each state
        self.lacks: list[dict[int, int]] = [{}]  # of each line: missing token and since when
        self.base: list[tuple[int, int]] = [(-1, 0)]
        self.target = dict.fromkeys(self.single.values(), 0)
        self.left: dict[int, int] = {}
        self.made: dict[int, int] = {}
        own_line: dict[int, int] = {}
        for time, (a, b) in enumerate(((ids[x], ids[y]) for x, y in vocabulary.merges), 1):
            self._merge(a, b, ids[vocabulary.bytes_of[a] + vocabulary.bytes_of[b]], time, own_line)

    def _merge(self, a: int, b: int, c: int, time: int, own_line: dict[int, int]) -> None:
        if c in self.target:
            raise ValueError("two merges make the same token")
        if a not in self.target or b not in self.target or not self.arc(self.target[a], b):
            return  # an earlier merge always comes first
        from_a, to_b = self.target[a], self.target[b]
        line = own_line.get(a)
        if line is None:
            line = own_line[a] = len(self.lacks)
            self.lacks.append({})
            self.base.append((self.line[from_a], self.until[from_a]))
        self.lacks[line][b] = time
        self.line.append(line)
        self.until.append(time)
        self.target[a] = len(self.line) - 1
        self.target[c], self.left[c], self.made[c] = to_b, a, time

    def arc(self, state: int, token: int) -> bool:
        """Whether ``token`` can be read in ``state``: neither it nor, when it was made, its left
        part was missing. A merge of a token with itself takes its own copy into account."""
        before = len(self.made) + len(self.line) + 10**9
        while True:
            line, until = self.line[state], self.until[state]
            while line >= 0:
                since = self.lacks[line].get(token)
                if since is not None and since <= until and since <= before:
                    return False
                line, until = self.base[line]
            if token not in self.left:
                return True
            before, token = self.made[token], self.left[token]


class StringState(dict):
    """The table's line of one string state: byte to string state, filled as needed. ``begun`` holds automaton
    state and tree node of each token that is begun in the string and may still end, the longest
    first. ``label`` and ``width`` are those of the arc that ends here."""

    __slots__ = ("begun", "encoder", "label", "width")

    def __init__(self, encoder: AutomatonEncoder, begun: tuple[int, ...], label: bytes = b"", width: int = 0):
        super().__init__()
        self.encoder, self.begun, self.label, self.width = encoder, begun, label, width

    def __missing__(self, byte: int) -> StringState:
        return self.encoder.entry(self, byte)


class AutomatonEncoder:
    def __init__(self, path: str):
        self.vocabulary = Vocabulary(path)
        self.automaton = MergeAutomaton(self.vocabulary)
        self.dtype = np.dtype("<u2" if self.vocabulary.size <= 2**16 else "<u4")
        self._lay_out_tokens()
        self.raw = {i: i.to_bytes(self.dtype.itemsize, "little") for i in self.vocabulary.bytes_of}
        self.split = regex.compile(PATTERN).findall
        added = [regex.escape(t) for t in sorted(self.vocabulary.added, key=len, reverse=True)]
        self.special = regex.compile("|".join(added)) if added else None
        self.pieces = Pieces(self._spaced)
        self._empty_table()

    def _lay_out_tokens(self) -> None:
        """The tokens with arcs as a tree of bytes: (node << 8 | byte) to node, and the token that ends in a node."""
        self.child: dict[int, int] = {}
        alive = sorted((token, i) for token, i in self.vocabulary.ids.items() if i in self.automaton.target)
        self.in_order, self.length = [i for _, i in alive], {i: len(token) for token, i in alive}
        self.token, self.after, self.until = [-1], [0], [len(alive)]  # a node's extensions in that order
        for place, (token, i) in enumerate(alive):
            node = 0
            for byte in token:
                key = node << 8 | byte
                node = self.child.get(key)
                if node is None:
                    node = self.child[key] = len(self.token)
                    self.token.append(-1)
                    self.after.append(place)
                    self.until.append(place)
                self.until[node] = place + 1
            self.token[node], self.after[node] = i, place + 1
        # Tokens by the number of their left parts; of each its left part and when it was made.
        left, made, depth = self.automaton.left, self.automaton.made, dict.fromkeys(self.in_order, 0)
        for i in made:  # in the order of merges
            depth[i] = depth[left[i]] + 1
        by_depth = sorted(depth, key=depth.__getitem__)
        self.row = {i: k for k, i in enumerate(by_depth)}
        self.in_order_rows = np.array([self.row[i] for i in self.in_order])
        self.left_row = np.array([self.row[left[i]] if i in left else -1 for i in by_depth])
        self.made_at = np.array([made.get(i, 0) for i in by_depth], np.int32)
        self.depth_ends = np.cumsum(np.bincount(list(depth.values()), minlength=1))

    def _empty_table(self) -> None:
        self.entries = 0
        self.start = StringState(self, START)
        self.states = {}
        self.alike: dict[int, int] = {}  # (node << 32 | automaton state) to the first state that reads the same, or -1
        self.reads: dict[tuple[int, int], int] = {}
        self.readable: dict[int, int] = {}

    def _read(self, begun: tuple[int, ...], byte: int) -> tuple[tuple[int, ...], int]:
        """What is begun after one more byte, and the token of the arc that ends there."""
        child, tokens, found, on = self.child.get, self.token, -1, []
        for state, node in zip(begun[::2], begun[1::2], strict=True):
            node = child(node << 8 | byte)
            if node is not None:
                if found < 0 <= tokens[node] and self.automaton.arc(state, tokens[node]):
                    found = tokens[node]
                key = node << 32 | state
                same = self.alike.get(key)
                if same is None:
                    same = self._alike(key)
                if same >= 0:
                    on += (same, node)
        if found < 0:
            raise ValueError("a byte of the text has no token")
        return (*on, self.automaton.target[found], 0), found

    def _alike(self, key: int) -> int:
        """The first automaton state found that reads the same tokens below a node, -1 if none is read."""
        node, state = key >> 32, key & 0xFFFFFFFF
        bits = self.readable.get(state)
        if bits is None:
            if len(self.readable) >= KEPT_STATES:
                self.readable.clear()
            bits = self.readable[state] = self._readable(state)
        if len(self.alike) >= TABLE_ENTRIES:
            self.alike.clear()
            self.reads.clear()
        below = bits >> self.after[node] & (1 << self.until[node] - self.after[node]) - 1
        same = self.alike[key] = self.reads.setdefault((node, below), state) if below else -1
        return same

    def _readable(self, state: int) -> int:
        """The tokens that can be read in a state, as bits in their order: what :meth:`MergeAutomaton.arc` says."""
        since = np.full(len(self.row), NEVER, np.int32)  # since when a token is missing, -1 if its left part was
        line, until = self.automaton.line[state], self.automaton.until[state]
        while line >= 0:
            for token, time in self.automaton.lacks[line].items():
                if time <= until:
                    row = self.row[token]
                    since[row] = min(since[row], time)
            line, until = self.automaton.base[line]
        for first, end in zip(self.depth_ends, self.depth_ends[1:]):
            since[first:end][since[self.left_row[first:end]] <= self.made_at[first:end]] = -1
        read = since[self.in_order_rows] == NEVER
        return int.from_bytes(np.packbits(read, bitorder="little").tobytes(), "little")

    def entry(self, at: StringState, byte: int) -> StringState:
        """The string state after one more byte, a new entry of the table."""
        begun, token = self._read(at.begun, byte)
        to = self.states.get((begun, token))
        if to is None:
            to = self.states[begun, token] = StringState(self, begun, self.raw[token], self.length[token])
        self.entries += 1
        at[byte] = to
        return to

    def word(self, word: bytes) -> bytes:
        """Ids of one pre-split word."""
        if len(word) > TABLE_WORD:
            return self._long(word)
        if self.entries >= TABLE_ENTRIES:
            self._empty_table()
        path, at = [], self.start
        for byte in word:
            at = at[byte]
            path.append(at)
        out, end = [], len(path)
        while end:
            at = path[end - 1]
            out.append(at.label)
            end -= at.width
        out.reverse()
        return b"".join(out)

    def _long(self, word: bytes) -> bytes:
        """The same without keeping table entries."""
        begun, ends = START, []
        for byte in word:
            begun, token = self._read(begun, byte)
            ends.append(token)
        out, end = [], len(word)
        while end:
            token = ends[end - 1]
            out.append(self.raw[token])
            end -= self.length[token]
        return b"".join(reversed(out))

    def _spaced(self, part: str) -> bytes:
        """Ids of a space and ``part``. A Latin word, perhaps with a point or comma, is split in
        the way the pattern does it."""
        stem = part[:-1] if part[-1] in ".," else part
        if stem.isalpha() and (stem.isascii() or max(stem) < "\u0250"):
            if stem is part:
                return self.word(b" " + stem.encode())
            ids = self.pieces.known(stem)
            return (self.word(b" " + stem.encode()) if ids is None else ids) + self.word(part[-1].encode())
        return self._piece(" " + part)

    def _piece(self, piece: str) -> bytes:
        return b"".join([self.word(w.encode()) for w in self.split(piece)])

    def encode(self, text: str) -> bytes:
        if not text:
            return b""
        if self.special and self.special.search(text):
            out, at = [], 0
            for m in self.special.finditer(text):
                out += [self.encode(text[at : m.start()]), self.raw[self.vocabulary.added[m[0]]]]
                at = m.end()
            return b"".join([*out, self.encode(text[at:])])
        if NOT_PLAIN.search(text):
            return self._piece(text)
        head, *parts = text.split(" ")
        return self._piece(head) + b"".join(map(self.pieces.__getitem__, parts))

    def decode(self, ids: list[int]) -> str:
        return emitted(self.vocabulary, ids)


def emitted(vocabulary: Vocabulary, ids: Sequence[int] | np.ndarray) -> str:
    """The text that the arcs' labels spell; bytes that are no UTF-8 become U+FFFD."""
    return vocabulary.decode(ids).decode("utf-8", "replace")


@lru_cache(maxsize=2)
def labels_only(path: str) -> Vocabulary:
    return Vocabulary(path)


@lru_cache(maxsize=2)
def automaton_encoder(path: str) -> AutomatonEncoder:
    return AutomatonEncoder(path)


def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows in small batches, so that a worker holds little besides the batch it got."""
    for batch in batches:
        for first in range(0, batch.num_rows, ROWS):
            yield batch.slice(first, ROWS)


def _encoded(path: str, text: str, ids_col: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = automaton_encoder(path)
        for batch in parts(batches):
            rows = [np.frombuffer(enc.encode(t), enc.dtype) for t in batch.column(text).to_pylist()]
            ends = np.concatenate([[0], np.cumsum([len(r) for r in rows], dtype=np.int64)])
            flat = np.concatenate([*rows, np.empty(0, enc.dtype)]).astype(np.int32)
            ids = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat))
            keep = [i for i, n in enumerate(batch.schema.names) if n != text]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in keep), ids], [*(batch.schema.names[i] for i in keep), ids_col]
            )

    return run


def encode(docs: DataFrame, vocabulary: str, text_col: str = "text", ids_col: str = "ids") -> DataFrame:
    """``docs`` with ``ids`` in place of the text.

    A null or empty text has no ids. Strings of added tokens in a text become their ids, as the
    vocabulary's own library does it. Rows are independent: repeated rows, nulls in other columns and
    empty tables need no care. Columns pass through; one named like the result is replaced.
    """
    docs = docs.drop(*[c for c in docs.columns if c.lower() == ids_col.lower() and c != text_col])
    (text,) = fresh_name(docs, "text_")
    ready = docs.withColumn(text, text_or_empty(F.col(text_col))).drop(text_col)
    schema = extended(ready.drop(text).schema, **{ids_col: array_of(INT)})
    return ready.mapInArrow(_encoded(vocabulary, text, ids_col), schema)


def _decoded(path: str, ids_col: str, text: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = labels_only(path)
        for batch in parts(batches):
            column = batch.column(ids_col)
            got = [emitted(vocabulary, v.values.to_numpy()) if v.is_valid else "" for v in column]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(got, pa.string())], [*batch.schema.names, text])

    return run


def decode(encoded: DataFrame, vocabulary: str, ids_col: str = "ids", text_col: str = "decoded") -> DataFrame:
    """``encoded`` with the text its ids spell; null ids spell the empty text."""
    encoded = encoded.drop(*[c for c in encoded.columns if c.lower() == text_col.lower() and c != ids_col])
    schema = encoded.withColumn(text_col, F.lit("")).schema
    return encoded.mapInArrow(_decoded(vocabulary, ids_col, text_col), schema)
