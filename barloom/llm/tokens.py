"""Byte-level BPE with a public vocabulary file, and a cache for what stands between spaces.

The file is a parameter and must lie at the same path on every executor. A text is cut before
each space that is followed by something else than white space. The vocabulary's pre-split
pattern always breaks there, so the pieces can be encoded by themselves, and most of them have
been seen before. Texts in which that cut is not plain are encoded whole.
"""

from __future__ import annotations

import json
import os
import re
from functools import lru_cache

import numpy as np

CACHED_PIECES, CACHED_LENGTH = 300_000, 48
NOT_PLAIN = re.compile(r" (?=\s|\Z)")


def byte_alphabet() -> dict[str, int]:
    """The characters that stand for bytes in such vocabulary files: a printable byte is
    itself, the others follow from code point 256 in order."""
    printable = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    others = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


class Vocabulary:
    """Token bytes, merges and added tokens of a byte-level BPE file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            data = json.load(f)
        alphabet = byte_alphabet()
        self.ids = {bytes(alphabet[c] for c in token): i for token, i in data["model"]["vocab"].items()}
        pairs = (m.split(" ") if isinstance(m, str) else m for m in data["model"]["merges"])
        self.merges = [tuple(bytes(alphabet[c] for c in side) for side in m) for m in pairs]
        self.added = {t["content"]: t["id"] for t in data["added_tokens"]}
        self.size = 1 + max([*self.ids.values(), *self.added.values()])
        self.bytes_of = {i: b for b, i in self.ids.items()} | {i: t.encode() for t, i in self.added.items()}
        self.labels = np.full(self.size, None, object)
        self.labels[list(self.bytes_of)] = list(self.bytes_of.values())

    def decode(self, ids) -> bytes:
        return b"".join(self.labels[np.asarray(ids, np.int64)].tolist())


class Pieces(dict):
    """Encoded pieces by their text without the leading space. ``encode`` gives the ids of a
    space and the text. When full, the pieces become the older half, out of which those still
    met are taken over, and the half before is dropped."""

    def __init__(self, encode):
        super().__init__()
        self.encode, self.older = encode, {}

    def __missing__(self, part: str) -> bytes:
        ids = self.older.get(part)
        if ids is None:
            ids = self.encode(part)
            if len(part) > CACHED_LENGTH:
                return ids
        if len(self) >= CACHED_PIECES // 2:
            self.older = dict(self)
            self.clear()
        self[part] = ids
        return ids

    def known(self, part: str) -> bytes | None:
        """The ids of a piece met lately."""
        ids = self.get(part)
        return self.older.get(part) if ids is None else ids


class Encoder:
    """``encode`` gives a text's ids as the bytes of little-endian integers of ``dtype``."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.whole.no_truncation()
        self.whole.no_padding()
        self.vocabulary = Vocabulary(path)
        self.dtype = np.dtype("<u2" if self.vocabulary.size <= 2**16 else "<u4")
        self.piece = self._piece_encoder()
        self.pieces = Pieces(lambda part: self.piece(" " + part))

    def _piece_encoder(self):
        """Ids of one piece. Where ids follow the order of the merges a rank-based encoder
        gives the same ids in less time."""
        known, dtype = self.vocabulary.ids, self.dtype
        made = [known.get(a + b) for a, b in self.vocabulary.merges]
        singles = all(bytes([b]) in known for b in range(256))
        if not singles or None in made or any(a >= b for a, b in zip(made, made[1:])) or len(known) != 256 + len(made):
            return self.encode_whole
        import tiktoken
        from public_tokenizers import PATTERN

        fast = tiktoken.Encoding("pieces", pat_str=PATTERN, mergeable_ranks=known, special_tokens={})
        return lambda piece: np.array(fast.encode_ordinary(piece), dtype).tobytes()

    def encode_whole(self, text: str) -> bytes:
        return np.array(self.whole.encode(text, add_special_tokens=False).ids, self.dtype).tobytes()

    def plain(self, text: str) -> bool:
        return not NOT_PLAIN.search(text) and not any(t in text for t in self.vocabulary.added)

    def encode(self, text: str) -> bytes:
        if not text:
            return b""
        if not self.plain(text):
            return self.encode_whole(text)
        head, *parts = text.split(" ")
        first = self.piece(head) if head else b""
        return first + b"".join(map(self.pieces.__getitem__, parts))

    def ids(self, text: str) -> np.ndarray:
        return np.frombuffer(self.encode(text), self.dtype)


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One encoder for each Python worker and file."""
    return Encoder(path)
