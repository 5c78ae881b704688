"""Secrets in text: fixed forms, and strings of high entropy. SQL functions only.

The entropy kind proposes long strings over the base64 alphabet. A window of
``WINDOW`` characters slides over each; the counts of the characters in it,
packed into a few numbers of five bits a character, change by one in and one out
per step, and with them the sum of c*log2(c) that gives Shannon's entropy. Every
class of characters (digits, hexadecimal, letters of one case or both, wider
strings of letters and digits) has a threshold of its own, below what its alphabet
can reach and, for letters, above what long words of a language do; other strings,
such as paths of words, are not proposed. Strings on the allow-list, or next to words that name
a published digest, are suppressed; that concerns the entropy kind only, the
fixed forms always stay.

Patterns are written so that no match recurses and no run of characters is
tried again from each of its places, however long it is.

Defined results: a null text is empty; texts and strings of any length are
scanned whole; rows that share an id are reported each; a row without an id is
reported with a null one; an empty table gives no rows. Other columns do not matter.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from tierline.llm.spans import Kind, joined, located, masked, of_kind

#: Characters in the sliding window, and the entropy in bits a window must reach, by class.
WINDOW = 20
THRESHOLDS = {"digits": 3.0, "hex": 3.0, "lower": 3.8, "upper": 3.8, "letters": 3.8, "wide": 3.6}
#: What the strings of each class look like; the first that fits counts (fixed values).
CLASSES = {"digits": "^[0-9]+$", "hex": "^(?:[0-9a-f]+|[0-9A-F]+)$", "lower": "^[a-z]+$", "upper": "^[A-Z]+$",
           "letters": "^[A-Za-z]+$", "wide": "^(?=.*[0-9])(?=.*[A-Za-z])"}
#: Counts in one number, and bits of each: a count is at most ``WINDOW``.
_PACKED, _BITS = 12, 5
#: Strings that are never secrets by entropy: alphabets, placeholders, runs of one unit.
ALLOWED = (r"(?i)example|sample|dummy|placeholder|xxxx|0123456789|abcdefgh|"
           r"^([0-9A-Za-z+/_=-]{1,4}?)\1{4,}")
#: Words shortly before a string that make it a published digest or an identifier.
PUBLIC = r"(?i)(?:sha-?(?:1|224|256|384|512)|md5|checksum|digest|integrity|commit|uuid|etag|fingerprint)[\s:=\"'-]*$"

_ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""


def _assigned(value: Column) -> Column:
    return F.length(F.regexp_extract(value, _ASSIGN, 1)) >= 8


def window_entropy(value: Column) -> Column:
    """The highest Shannon entropy, in bits, of any ``WINDOW`` characters of an ASCII string.

    A string shorter than the window has entropy zero.
    """
    codes = F.transform(F.filter(F.split(value, ""), lambda c: c != ""), lambda c: F.ascii(c))
    leaving = F.concat(F.array_repeat(F.lit(-1), WINDOW), codes)
    steps = F.slice(F.arrays_zip(codes.alias("new"), leaving.alias("old"))
                    .cast("array<struct<new:int,old:int>>"), F.lit(1), F.greatest(F.length(value), F.lit(1)))

    def weight(count):
        return F.when(count > 1, count * F.log2(count)).otherwise(0.0)

    def unit(code):
        """One, at the place of a character's count."""
        return F.call_function("shiftleft", F.lit(1).cast("long"), (code % _PACKED) * _BITS)

    def count(counts, code):
        held = F.get(counts, F.floor(code / _PACKED).cast("int"))
        return F.call_function("shiftright", held, (code % _PACKED) * _BITS).bitwiseAND(F.lit((1 << _BITS) - 1).cast("long"))

    def step(state, x):
        moved, full = x["new"] != x["old"], x["old"] >= 0
        added, gone = count(state["counts"], x["new"]), count(state["counts"], x["old"])
        total = state["total"] + F.when(moved, weight(added + 1) - weight(added)
                                        - F.when(full, weight(gone) - weight(gone - 1)).otherwise(0.0)
                                        ).otherwise(0.0)
        counts = F.transform(state["counts"], lambda c, k: c
                             + F.when(moved & (k == F.floor(x["new"] / _PACKED)), unit(x["new"])).otherwise(0)
                             - F.when(moved & full & (k == F.floor(x["old"] / _PACKED)), unit(x["old"])).otherwise(0))
        seen = state["seen"] + 1
        bits = F.lit(math.log2(WINDOW)) - total / WINDOW
        best = F.when(seen >= WINDOW, F.greatest(state["best"], bits)).otherwise(state["best"])
        return F.struct(counts.alias("counts"), total.alias("total"), best.alias("best"), seen.alias("seen"))

    start = F.struct(F.array_repeat(F.lit(0).cast("long"), math.ceil(128 / _PACKED)).alias("counts"), F.lit(0.0).alias("total"),
                     F.lit(0.0).alias("best"), F.lit(0).alias("seen"))
    return F.aggregate(steps, start, step, lambda s: s["best"])


def _entropic(value: Column) -> Column:
    limit = F.lit(None).cast("double")
    for name in reversed(CLASSES):
        limit = F.when(F.rlike(value, F.lit(CLASSES[name])), THRESHOLDS[name]).otherwise(limit)
    proposed = limit.isNotNull() & ~F.rlike(value, F.lit(ALLOWED))
    return F.when(proposed, window_entropy(value) >= limit).otherwise(False)


#: The fixed forms first, in the order of the contract.
BASE = [
    Kind("assign", _ASSIGN, (), _assigned),
    Kind("access", r"AKIA[A-Z0-9]{12,}+", ("AKIA",)),
    Kind("hex", r"[0-9a-f]{32,}+"),
]
KINDS = [*BASE, Kind("entropy", r"[A-Za-z0-9+/_=-]{20,}+", (), _entropic, PUBLIC)]


def scan(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id and ``spans``, an array of (start, kind, end, value).

    Spans are sorted by start, then kind as listed in ``KINDS``.
    """
    rows = located(docs, KINDS, id_column, text_column)
    valid = F.lit(False)
    for n, kind in enumerate(KINDS):
        valid = valid | ((F.col("kind") == n) & kind.valid(F.col("value"), F.col("before")))
    span = F.when(valid, F.struct("start", "kind", "end", "value"))
    return rows.groupBy("tag").agg(F.first("doc_id").alias("doc_id"),
                                   F.sort_array(F.collect_list(span)).alias("spans"))


def report(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id, counts and digest of the fixed forms, and all spans as text."""
    spans = F.col("spans")
    base = F.filter(spans, lambda s: s["kind"] < len(BASE))
    return scan(docs, id_column, text_column).select(
        "doc_id",
        *(F.size(of_kind(spans, n)).cast("long").alias(f"n_{k.name}") for n, k in enumerate(BASE)),
        F.sha2(joined(base, KINDS), 256).alias("base_sha256"), joined(spans, KINDS).alias("spans"))


def redact(docs: DataFrame, text_column: str = "text", mask: str = "[SECRET]") -> DataFrame:
    """``docs`` with every secret of its texts replaced; a null text stays null.

    Kinds are replaced one after the other, so overlapping ones end in one mask.
    """
    for kind in KINDS:
        text = F.col(f"`{text_column}`")
        docs = docs.withColumn(text_column, masked(text, kind, mask))
    return docs
