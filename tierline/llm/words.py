"""Token ids of whole texts by way of a cache of their words or pieces.

Both vocabularies encode each match of a pattern by itself, and a corpus uses
the same matches again and again. A worker keeps the ids of those it has seen,
as bytes, so a text is one pass of the pattern and one join of bytes. Unseen
matches go to the tokenizer library.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import regex
import tiktoken
from tokenizers import Tokenizer, pre_tokenizers

#: Matches in each of the two generations a worker remembers, and the longest that it keeps.
REMEMBERED, LONGEST = 250_000, 64
#: Characters handled at a time.
BLOCK = 1 << 20

# Characters for which case, composition, spaces and classes are the same in every
# version of Unicode: Latin letters, ASCII and common punctuation.
_LETTERS = "A-Za-zªµºÀ-ÖØ-öø-ɏ"
_NUMBERS = "0-9²³¹¼-¾"
# A capital whose small letter lies elsewhere, or is several characters, is not among them.
_BELOW = "".join(c for c in map(chr, range(0xA0, 0x250)) if all(0xA0 <= ord(s) < 0x250 for s in c.lower()) and len(c.lower()) == 1)
_PLAIN = re.compile(f"[\\t\\n\\r\\x20-\\x7e{_BELOW}–—‘-„…€]*")


class Cache(dict):
    """Ids of a match as little-endian unsigned 32-bit bytes.

    When full, it becomes the older generation, from which matches in use return.
    """

    def __init__(self, encode: Callable[[str], list[int]]):
        super().__init__()
        self._encode, self._older = encode, {}

    def __missing__(self, match: str) -> bytes:
        found = self._older.get(match)
        if found is None:
            found = np.asarray(self._encode(match), "<u4").tobytes()
        if len(match) <= LONGEST:
            if len(self) >= REMEMBERED:
                self._older = dict(self)
                self.clear()
            self[match] = found
        return found


class WordTokenizer:
    """A lower-casing word BPE file of the ``tokenizers`` library."""

    _WORDS = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[{_NUMBERS}]|[^\\s{_LETTERS}{_NUMBERS}]+")

    def __init__(self, path: str):
        self._whole = Tokenizer.from_file(path)
        self._whole.encode_special_tokens = True  # their strings are ordinary text
        word = Tokenizer(self._whole.model)
        word.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self._cache = Cache(lambda w: word.encode(w, add_special_tokens=False).ids)

    def encode(self, text: str) -> bytes:
        """Ids of a text without special tokens, as bytes."""
        if not _PLAIN.fullmatch(text):
            return np.asarray(self._whole.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        ids = self._cache.__getitem__
        return b"".join(b"".join(map(ids, self._WORDS.findall(part.lower()))) for part in _blocks(text))


def _blocks(text: str) -> Iterator[str]:
    """The text in parts that end before white space, which no word crosses."""
    at = 0
    while len(text) - at > BLOCK:
        space = re.compile(r"\s").search(text, at + BLOCK)
        if not space:
            break
        yield text[at:space.start()]
        at = space.start()
    yield text[at:] if at else text


@lru_cache(maxsize=2)
def word_tokenizer(path: str) -> WordTokenizer:
    return WordTokenizer(path)


class ByteTokenizer:
    """Byte-level BPE by a file of ranks; each match of the pattern is encoded by itself."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self._bytes = dict(zip(ranks.values(), ranks.keys()))
        merges = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self._cache = Cache(merges.encode_ordinary)
        # \s of the pattern stands for Unicode's white space, whatever a library makes of it.
        self._any = regex.compile(pattern.replace(r"[^\s", r"[^\p{White_Space}").replace(r"\S", r"\P{White_Space}")
                                  .replace(r"\s", r"\p{White_Space}"))
        self._plain = re.compile(pattern.replace(r"[^\s\p{L}\p{N}]", f"[^\\s{_LETTERS}{_NUMBERS}]")
                                 .replace(r"\p{L}", f"[{_LETTERS}]").replace(r"\p{N}", f"[{_NUMBERS}]"))

    def pieces(self, text: str) -> list[str]:
        """The matches of the pattern; joined they are the text."""
        return (self._plain if _PLAIN.fullmatch(text) else self._any).findall(text)

    def encode_pieces(self, pieces: list[str]) -> bytes:
        return b"".join(map(self._cache.__getitem__, pieces))

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self._bytes.__getitem__, np.frombuffer(ids, "<u4").tolist()))


@lru_cache(maxsize=2)
def byte_tokenizer(path: str, pattern: str) -> ByteTokenizer:
    return ByteTokenizer(path, pattern)
