"""Chat formatting on token level.

The template is ``<|im_start|>role\\ntext<|im_end|>\\n`` for every turn. Role and text are
encoded by themselves and the reserved ids are put between them, so no merge crosses a segment
and no text can produce a reserved id. Control strings inside a role or text are escaped by a
backslash: ``<``, any backslashes and ``|`` get one more backslash, which is undone exactly.

Turns are formatted one by one, before they are brought together, so a conversation with very
many turns is formatted by many tasks. Reading back streams over the sorted turns of a
partition and holds one batch and the digests of one conversation.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.llm.common import text_or_empty
from barloom.llm.tokens import encoder

START, END = "<|im_start|>", "<|im_end|>"
_CONTROL, _ESCAPED = re.compile(r"<(\\*)\|"), re.compile(r"<\\(\\*)\|")


def escape(text: str) -> str:
    return _CONTROL.sub(r"<\1\\|", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"<\1|", text)


def escape_role(role: str) -> str:
    return escape(role).replace("\\", "\\\\").replace("\n", "\\n")


def unescape_role(role: str) -> str:
    return unescape(re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], role))


def _formatted(path: str, loss_roles: frozenset[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        start, end = enc.vocabulary.size, enc.vocabulary.size + 1
        mark = {s: np.array([i]) for s, i in ((START, start), (END, end))}
        newline = enc.ids("\n")
        for batch in batches:
            ids, masks, texts = [], [], []
            for role, text in zip(batch.column("role").to_pylist(), batch.column("text").to_pylist(), strict=True):
                head, body = escape_role(role) + "\n", escape(text)
                parts = [mark[START], enc.ids(head), enc.ids(body), mark[END], newline]
                ends = np.cumsum([len(p) for p in parts])
                step = np.zeros(ends[-1] + 1, np.int8)
                if role in loss_roles:
                    step[ends[1]] += 1
                    step[ends[2]] -= 1
                ids.append(np.concatenate(parts).astype(np.int32))
                masks.append(np.cumsum(step[:-1]).astype(bool))
                texts.append(f"{START}{head}{body}{END}\n")
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("conv_id"),
                    batch.column("turn"),
                    pa.array(ids, pa.list_(pa.int32())),
                    pa.array(masks, pa.list_(pa.bool_())),
                    pa.array(texts, pa.string()),
                ],
                ["conv_id", "turn", "ids", "loss_mask", "formatted"],
            )

    return run


def format_turns(turns: DataFrame, vocabulary: str, loss_roles: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """``(conv_id, turn, ids, loss_mask, formatted)`` of every row of ``turns``.

    ``turns`` has ``conv_id, turn, role, text``; other columns are ignored. A null role or text
    counts as empty; an empty text still makes a turn. Null ids and turns stay null. The mask
    covers the text of the roles in ``loss_roles``, without template and end mark.
    """
    rows = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        text_or_empty(F.col("role")).alias("role"),
        text_or_empty(F.col("text")).alias("text"),
    )
    schema = "conv_id long, turn long, ids array<int>, loss_mask array<boolean>, formatted string"
    return rows.mapInArrow(_formatted(vocabulary, frozenset(loss_roles)), schema)


SUMMARY = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, n_tokens long, loss_tokens long"


def _read_back(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        vocabulary, start, end = enc.vocabulary, enc.vocabulary.size, enc.vocabulary.size + 1
        names = {start: START.encode(), end: END.encode()}
        table = {**vocabulary.bytes_of, **names}
        out: list[tuple] = []
        open_id: tuple | None = None
        turns = loss = formatted = tokens = masked = 0
        all_turns, all_loss = hashlib.sha256(), hashlib.sha256()

        def close() -> None:
            if open_id is not None:
                out.append((open_id[0], turns, all_turns.hexdigest(), loss, all_loss.hexdigest(), formatted, tokens, masked))

        def flush() -> pa.RecordBatch:
            fields = [f.split() for f in SUMMARY.split(", ")]
            columns = list(zip(*out, strict=True)) or [[]] * len(fields)
            arrays = [
                pa.array(list(c), pa.int64() if kind == "long" else pa.string()) for c, (_, kind) in zip(columns, fields, strict=True)
            ]
            out.clear()
            return pa.RecordBatch.from_arrays(arrays, [name for name, _ in fields])

        for batch in batches:
            conv = batch.column("conv_id").to_pylist()
            for i, cid in enumerate(conv):
                if open_id != (cid,):
                    close()
                    open_id = (cid,)
                    turns = loss = formatted = tokens = masked = 0
                    all_turns, all_loss = hashlib.sha256(), hashlib.sha256()
                ids = batch.column("ids")[i].values.to_numpy()
                mask = batch.column("loss_mask")[i].values.to_numpy(zero_copy_only=False)
                whole = b"".join(map(table.__getitem__, ids.tolist()))
                inner = b"".join(map(table.__getitem__, ids[np.flatnonzero(ids == start)[0] + 1 : np.flatnonzero(ids == end)[-1]].tolist()))
                role, _, text = inner.decode().partition("\n")
                all_turns.update(f"{unescape_role(role)}\n{unescape(text)}\n".encode())
                if mask.any():
                    part = unescape(vocabulary.decode(ids[mask].tolist()).decode())
                    loss += len(part)
                    all_loss.update(part.encode())
                turns += 1
                formatted += len(whole.decode())
                tokens += len(ids)
                masked += int(mask.sum())
            yield flush()
        close()
        yield flush()

    return run


def read_conversations(formatted: DataFrame, vocabulary: str) -> DataFrame:
    """One row for each conversation, read back from the ids and masks of ``format_turns``.

    ``turns_sha256`` digests role, newline, text, newline of all turns in order; ``loss_*``
    describe the text under the mask. Turns are ordered by ``turn``, nulls first, ties by their
    formatted text. Rows with a null ``conv_id`` are one conversation.
    """
    lined = formatted.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "formatted")
    return lined.select("conv_id", "ids", "loss_mask").mapInArrow(_read_back(vocabulary), SUMMARY)
