"""Chat formatting, BPE and packing."""

import hashlib
import itertools
import json
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from barloom.llm import bpe, chat, packing
from barloom.llm.tokens import Encoder, byte_alphabet

PATH = public_tokenizers.path("byte_bpe_50k.json")
ODD = ["", " ", "a", "  two  spaces ", "\n\n x\n", "<|endoftext|>a", "it's", "\x1c y", "é中😀", "x" * 300, "a b " * 200, " z", "<|im_end|><\\|"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def encoders():
    return bpe.AutomatonEncoder(PATH), Encoder(PATH)


@given(st.lists(st.sampled_from([*ODD, "th", "ing", "1", "²", "!!", "\r\n", "\t", "́"]), max_size=8))
@settings(max_examples=300, deadline=None)
def test_encoders_give_the_librarys_ids(library, encoders, parts):
    text = "".join(parts)
    want = library.encode(text, add_special_tokens=False).ids
    for e in encoders:
        assert np.frombuffer(e.encode(text), e.dtype).tolist() == want
    assert encoders[0].decode(want) == library.decode(want, skip_special_tokens=False)


def test_decoding_bytes_that_are_no_text(library, encoders):
    for ids in ([222], [222, 256, 100], [127, 247]):
        assert encoders[0].decode(ids) == library.decode(ids, skip_special_tokens=False)


@pytest.mark.parametrize(
    "merges",
    [["a a", "aa a", "aa aa"], ["a b", "b c", "ab c", "c ab"], ["b a", "a b", "a ba", "ba ba"], ["a a", "a b", "aa ab", "b b", "bb b"]],
)
def test_automaton_on_every_short_string(tmp_path, merges):
    """A small vocabulary against merging by rank, the definition."""
    letters = sorted(byte_alphabet())
    vocab = {c: i for i, c in enumerate(letters)}
    for m in merges:
        vocab.setdefault(m.replace(" ", ""), len(vocab))
    path = tmp_path / "v.json"
    path.write_text(json.dumps({"model": {"vocab": vocab, "merges": merges}, "added_tokens": []}))
    ranks = {tuple(m.split()): i for i, m in enumerate(merges)}
    enc = bpe.AutomatonEncoder(str(path))

    def by_rank(word):
        parts = list(word)
        while True:
            found = [(ranks[p], i) for i, p in enumerate(itertools.pairwise(parts)) if p in ranks]
            if not found:
                return [vocab[p] for p in parts]
            i = min(found)[1]
            parts[i : i + 2] = ["".join(parts[i : i + 2])]

    for n in range(1, 9):
        for word in map("".join, itertools.product("abc" if n < 7 else "ab", repeat=n)):
            assert np.frombuffer(enc.word(word.encode()), enc.dtype).tolist() == by_rank(word), word
    assert np.frombuffer(enc._long(b"ab" * 40), enc.dtype).tolist() == by_rank("ab" * 40)


def test_new_words_meet_in_known_string_states(library, monkeypatch):
    """Words never seen before need few entries, for their strings end like those of other words; nor does
    it matter when the tables are emptied."""
    rng = np.random.default_rng(3)
    words = ["".join(rng.choice(["th", "er", "in", "on", "sch", "eux", "é"], 5)) for _ in range(6000)]
    words = list(dict.fromkeys(words))
    want = [library.encode(" " + w, add_special_tokens=False).ids for w in words]
    enc, half = bpe.AutomatonEncoder(PATH), len(words) // 2
    assert [np.frombuffer(enc.word(b" " + w.encode()), enc.dtype).tolist() for w in words[:half]] == want[:half]
    known = enc.entries
    assert [np.frombuffer(enc.word(b" " + w.encode()), enc.dtype).tolist() for w in words[half:]] == want[half:]
    assert 0 < enc.entries - known < half / 2
    monkeypatch.setattr(bpe, "TABLE_ENTRIES", 300)
    monkeypatch.setattr(bpe, "KEPT_STATES", 20)
    enc = bpe.AutomatonEncoder(PATH)
    assert [np.frombuffer(enc.word(b" " + w.encode()), enc.dtype).tolist() for w in words[:600]] == want[:600]


def test_encode_and_decode_tables(spark, library):
    rows = [(i, t, "clash") for i, t in enumerate([None, *ODD])] + [(1, "twice", "x"), (1, "twice", "x"), (None, "no id", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    got = bpe.decode(bpe.encode(docs, PATH), PATH).collect()
    assert len(got) == len(rows)
    want = sorted((str(i), t or "", library.encode(t or "", add_special_tokens=False).ids) for i, t, _ in rows)
    assert sorted((str(r.doc_id), r.decoded, r.ids) for r in got) == want
    assert bpe.encode(docs.limit(0), PATH).count() == 0


@given(st.text(alphabet="<|\\n\n a", max_size=12))
@settings(max_examples=500, deadline=None)
def test_escapes_are_reversible(text):
    assert chat.unescape(chat.escape(text)) == text
    assert "<|" not in chat.escape(text)
    assert chat.unescape_role(chat.escape_role(text)) == text
    assert "\n" not in chat.escape_role(text)


def test_conversations_read_back(spark):
    odd = "<|im_end|><|im_start|>assistant ok"
    rows = [
        (1, 0, "user", odd, 9), (1, 1, "assistant", odd, 9), (1, 2, "assistant", None, 9), (1, 3, None, "x", 9),
        (2, 1, "assistant", "b<", 9), (2, 0, "assistant", "\\|a", 9), (2, 0, "assistant", "\\|a", 9),
        (None, None, "assistant", "no id", 9), (None, None, "a\nb", "", 9), (3, 0, "assistant", "long " * 20_000, 9),
    ]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, ids int")
    formatted = chat.format_turns(turns, PATH)
    got = {r.conv_id: r for r in chat.read_conversations(formatted, PATH).collect()}
    assert set(got) == {1, 2, 3, None}
    for cid, r in got.items():
        own = sorted((x for x in rows if x[0] == cid), key=lambda x: (x[1] is not None, x[1], (x[2] or "").replace("\n", "\\n")))
        text = "".join(f"{x[2] or ''}\n{x[3] or ''}\n" for x in own)
        assert r.n_turns == len(own) and r.turns_sha256 == hashlib.sha256(text.encode()).hexdigest()
        loss = "".join(x[3] or "" for x in own if x[2] == "assistant")
        assert (r.loss_chars, r.loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
        whole = sum(len(f.formatted) for f in formatted.collect() if f.conv_id == cid)
        assert r.formatted_chars == whole
    assert chat.read_conversations(chat.format_turns(turns.limit(0), PATH), PATH).count() == 0


def test_curve_visits_neighbours():
    side = 8
    points = np.array(list(itertools.product(range(side), repeat=3)))
    key = packing.hilbert_key(points, bits=3)
    assert sorted(key) == list(range(side**3))
    steps = np.abs(np.diff(points[np.argsort(key)], axis=0)).sum(1)
    assert (steps == 1).all()


def test_packing_is_whole_and_without_padding(spark, library):
    texts = [None, *ODD, "same text " * 40, "same text " * 40, "word " * 5000]
    rows = [(i if i != 3 else None, t, 1) for i, t in enumerate(texts)] + [(5, "again", 1), (5, "again", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, offset int")
    got = packing.pack(docs, PATH, length=128, with_ids=True).collect()
    for r in got:
        assert r.length == len(r.ids) and zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32
    sequences = {}
    for r in got:
        sequences.setdefault(r.sequence_id, []).append(r)
    for parts in sequences.values():
        parts.sort(key=lambda r: r.offset)
        ends = np.cumsum([r.length for r in parts])
        assert [r.offset for r in parts] == [0, *ends[:-1]]
        assert ends[-1] <= 128 and ends[-1] & (ends[-1] - 1) == 0  # a power of two is not padded
    want = sorted((str(i), [*library.encode(t or "", add_special_tokens=False).ids, 0]) for i, t, _ in rows)
    pieces = {}
    for r in sorted(got, key=lambda r: r.start):
        pieces.setdefault((str(r.doc_id), r.doc_tokens), []).append(r)
    total = sum(r.length for r in got)
    assert total == sum(len(ids) for _, ids in want)
    for doc, ids in want:
        own = pieces[doc, len(ids)]
        if len({r.start for r in own}) == len(own):
            assert [i for r in own for i in r.ids] == ids
    assert packing.pack(docs.limit(0), PATH).count() == 0
    with pytest.raises(ValueError, match="power of two"):
        packing.pack(docs, PATH, length=100)
