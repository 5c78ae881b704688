import zlib

import numpy as np
import public_tokenizers
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tierline.llm import packing
from tierline.llm.words import Cache, WordTokenizer

PATH = public_tokenizers.path("word_bpe_49k.json")
TEXTS = [None, "", " ", "Hello it's", "İstanbul ŞŤ <|endoftext|> naïve ½²３ ẞ Σας\x1c a", "漢字 's're", "áe  ́ x", "\x85\x0b\x0c a",
         "x'll'LL '", "word " * 30_000, "z" * 5000, "same", "same"]


def library():
    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.encode_special_tokens = True
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids


LIBRARY, OURS = library(), WordTokenizer(PATH)


@settings(max_examples=150, deadline=None)
@given(st.text(st.characters(codec="utf-8"), max_size=60))
def test_ids_are_those_of_the_library(text):
    assert np.frombuffer(OURS.encode(text), "<u4").tolist() == LIBRARY(text)


def test_ids_of_every_plain_character():
    """Alone, inside words and in upper and lower case; also those that only their case moves out of the range."""
    for c in [*map(chr, range(0x20, 0x250)), *"–—‘’‚“”„…€\t\n\r"]:
        for text in (c, f"a{c}b", f"{c}we", f"K{c}ND x", f"1{c}2", f"{c}{c.lower()}{c.upper()}"):
            assert np.frombuffer(OURS.encode(text), "<u4").tolist() == LIBRARY(text), repr(text)


def test_ids_of_capitals_with_small_letters_elsewhere():
    for text in ("AZƏRBAYCAN", "KƏND", "Ɛwe", "Ɔkyeame", "İstanbul", "ȺȾɃɄɅ"):
        assert np.frombuffer(OURS.encode(text), "<u4").tolist() == LIBRARY(text)


def test_blocks_do_not_change_ids(monkeypatch):
    ours, text = WordTokenizer(PATH), "one two's  three\n" * 50 + "x" * 300
    want = ours.encode(text)
    monkeypatch.setattr("tierline.llm.words.BLOCK", 37)
    assert ours.encode(text) == want


def test_a_full_cache_keeps_working(monkeypatch):
    monkeypatch.setattr("tierline.llm.words.REMEMBERED", 2)
    cache = Cache(lambda w: [len(w)])
    assert [cache[w] for w in ("a", "bb", "ccc", "a", "dddd", "bb")] == [n.to_bytes(4, "little") for n in (1, 2, 3, 1, 4, 2)]
    assert len(cache) <= 2


def checked(rows, texts, capacity):
    encode, by_doc, by_sequence = library(), {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
    for doc_id, text in enumerate(texts):
        ids, at = np.array(encode(text) + [2], "<u4"), 0
        for r in sorted(by_doc.pop(doc_id), key=lambda r: r.start):
            assert (r.start, r.doc_tokens) == (at, len(ids))
            assert r.ids_crc32 == zlib.crc32(ids[at:at + r.length].tobytes())
            at += r.length
        assert at == len(ids)
    assert not by_doc
    for pieces in by_sequence.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= capacity
    return len(by_sequence)


def test_every_id_is_packed_once(documents):
    for capacity, group in ((4096, 4096), (100, 7)):
        rows = packing.pack(packing.pieces(documents(*TEXTS), PATH, capacity), capacity, group).collect()
        checked(rows, TEXTS, capacity)


def test_first_fit_decreasing_is_the_plain_algorithm():
    rng = np.random.default_rng(6)
    for n in (1, 2, 3, 50, 257):
        lengths = rng.integers(1, 101, n)
        bins, offsets = packing.first_fit_decreasing(lengths, 100)
        room, want = [], np.zeros(n, int)
        for i in np.argsort(-lengths, kind="stable"):
            k = next((b for b, r in enumerate(room) if r >= lengths[i]), len(room))
            if k == len(room):
                room.append(100)
            room[k] -= lengths[i]
            want[i] = k
        assert bins.tolist() == want.tolist()
        assert all(offsets[bins == b].tolist() for b in set(bins.tolist()))


def test_little_padding(documents):
    rng = np.random.default_rng(7)
    texts = [" ".join("w" for _ in range(n)) for n in rng.integers(1, 900, 800)]
    used = checked(packing.pack_documents(documents(*texts), PATH).collect(), texts, 4096)
    assert used <= 1.02 * sum(len(t.split()) + 1 for t in texts) / 4096 + 1


def test_ids_repeat_are_missing_or_clash(documents):
    docs = documents((1, "a b"), (1, "a b"), (None, "c"), (2 ** 62 + 1, "d")).withColumns(
        {c: F.lit(0) for c in ("start", "length", "slot", "group_no", "offset")})
    rows = packing.pack_documents(docs, PATH, keep_ids=True).collect()
    assert sorted((str(r.doc_id), r.length) for r in rows) == [("1", 3), ("1", 3), (str(2 ** 62 + 1), 2), ("None", 2)]
    assert all(r.ids[-1] == 2 for r in rows)
    assert packing.pack_documents(documents(), PATH).count() == 0
