"""Which script each character belongs to, and the words of texts as runs of one script."""

from __future__ import annotations

import sys
from functools import lru_cache

import numpy as np

# The first and last code point of the blocks that hold a script's letters.
RANGES = {
    "latin": ((0x41, 0x24F), (0x250, 0x2AF), (0x1E00, 0x1EFF), (0x2C60, 0x2C7F), (0xA720, 0xA7FF), (0xFF21, 0xFF5A)),
    "greek": ((0x370, 0x3FF), (0x1F00, 0x1FFF)),
    "cyrillic": ((0x400, 0x52F), (0x1C80, 0x1C8F), (0x2DE0, 0x2DFF), (0xA640, 0xA69F)),
    "armenian": ((0x530, 0x58F),),
    "hebrew": ((0x590, 0x5FF), (0xFB1D, 0xFB4F)),
    "arabic": ((0x600, 0x6FF), (0x750, 0x77F), (0x8A0, 0x8FF), (0xFB50, 0xFDFF), (0xFE70, 0xFEFF)),
    "devanagari": ((0x900, 0x97F), (0xA8E0, 0xA8FF)),
    "bengali": ((0x980, 0x9FF),),
    "gurmukhi": ((0xA00, 0xA7F),),
    "gujarati": ((0xA80, 0xAFF),),
    "tamil": ((0xB80, 0xBFF),),
    "telugu": ((0xC00, 0xC7F),),
    "kannada": ((0xC80, 0xCFF),),
    "malayalam": ((0xD00, 0xD7F),),
    "thai": ((0xE00, 0xE7F),),
    "georgian": ((0x10A0, 0x10FF), (0x1C90, 0x1CBF)),
    "hangul": ((0x1100, 0x11FF), (0x3130, 0x318F), (0xAC00, 0xD7AF)),
    "ethiopic": ((0x1200, 0x139F),),
    "khmer": ((0x1780, 0x17FF),),
    "kana": ((0x3040, 0x30FF), (0x31F0, 0x31FF), (0xFF66, 0xFF9F)),
    "han": ((0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0x20000, 0x3FFFF)),
}
NAMES = ("none", "other", *RANGES)


@lru_cache(maxsize=1)
def script_of() -> np.ndarray:
    """The place in ``NAMES`` of every code point: none for what is no letter."""
    letters = np.fromiter((chr(c).isalpha() for c in range(sys.maxunicode + 1)), bool, sys.maxunicode + 1)
    scripts = letters.astype(np.uint8)
    for number, spans in enumerate(RANGES.values(), 2):
        for first, last in spans:
            scripts[first:last + 1][letters[first:last + 1]] = number
    return scripts


@lru_cache(maxsize=1)
def small_letters() -> np.ndarray:
    """The small letter of every code point, where that is one character; else the code point itself."""
    small = np.arange(sys.maxunicode + 1, dtype=np.uint32)
    for c in range(sys.maxunicode + 1):
        lower = chr(c).lower()
        if len(lower) == 1:
            small[c] = ord(lower)
    return small


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def words(points: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and scripts of the maximal runs of letters of one script."""
    scripts = script_of()[points]
    edges = np.flatnonzero(np.diff(scripts)) + 1
    starts, ends = np.concatenate(([0], edges)), np.concatenate((edges, [len(points)]))
    if not len(points):
        return starts[:0], ends[:0], scripts
    kinds = scripts[starts]
    spoken = kinds > 0
    return starts[spoken], ends[spoken], kinds[spoken]
