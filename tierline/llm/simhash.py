"""Near duplicates by SimHash: tiled exact comparison of all fingerprints.

Equal fingerprints are folded first, so a text with very many copies counts
once. The distinct fingerprints are cut into tiles by the population counts of
their four 16-bit quarters. Two fingerprints whose counts differ by more than
the radius, summed over the quarters, differ in more bits than the radius, so
only tiles within it are paired; all other tile pairs are skipped. Tiles are
held in blocks of about ``BLOCK`` fingerprints, and a pair of blocks is compared
whole with numpy exclusive-or and bit counts. Of the links inside a pair of
blocks a spanning forest is kept: the components are the same, and a large
group of near copies never becomes all its pairs.

Removal of near copies (:func:`deduplicate`) leaves one row of each such group.

Defined results: a null text is empty; empty texts have fingerprint zero and
link like any other; texts of any length count whole, their shingles hashed in
parts; rows that share an id are one document for the links; rows without an id
get a fingerprint but take no part in linking (null component); an empty table
gives no rows. Other columns are not looked at; removal returns them as they are.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import LongType

from tierline.llm.common import stored, whole_text
from tierline.llm.components import connected_components

#: Words per shingle, seed of the shingle hash, and differing bits that still link.
SHINGLE_WORDS, SEED, RADIUS = 3, 42, 2
#: Fingerprints per block; a block pair takes 16 bytes of each and is compared in strips.
BLOCK = 2048
_STRIP = 1 << 20
#: Shingles hashed before their bits are counted.
_HASHED = 1 << 16


def fingerprint(text: str, words: int = SHINGLE_WORDS, seed: int = SEED) -> int:
    """The 64-bit fingerprint: a bit is set when over half the shingle hashes have it."""
    found = text.encode("utf-8", "surrogatepass").lower().split()  # ASCII letters, ASCII white space
    if not found:
        return 0
    joined = b" ".join(found)
    ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    spans = max(1, len(found) - words + 1)
    starts, ends = starts[:spans].tolist(), ends[min(words, len(found)) - 1:].tolist()
    counts, digest = np.zeros(64, np.int64), xxhash.xxh64_intdigest
    for at in range(0, spans, _HASHED):
        hashes = np.array([digest(joined[s:e], seed) for s, e in
                           zip(starts[at:at + _HASHED], ends[at:at + _HASHED])], np.uint64)
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    chosen = np.packbits(2 * counts > spans, bitorder="little")
    return int(chosen.view(np.int64)[0])


@F.pandas_udf(LongType())
def _fingerprints(texts: pd.Series) -> pd.Series:
    return pd.Series([fingerprint(t) for t in texts], dtype="int64")


def fingerprints(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, print) of every row; ``print`` is the fingerprint as a signed number."""
    return docs.select(F.col(id_column).alias("doc_id"), _fingerprints(whole_text(text_column)).alias("print"))


def _tile():
    """The population counts of the quarters, one to a byte of the tile's number."""
    quarters = [F.bit_count(F.shiftrightunsigned("print", 16 * k).bitwiseAND(F.lit(0xFFFF))) for k in range(4)]
    return sum((F.shiftleft(q.cast("long"), 8 * k) for k, q in enumerate(quarters)), F.lit(0).cast("long"))


def tile_offsets(radius: int) -> list[int]:
    """Differences of tile numbers within the radius, one of each pair (d, -d), with 0."""
    steps = [d for d in itertools.product(range(-radius, radius + 1), repeat=4) if sum(map(abs, d)) <= radius]
    return [sum(x << (8 * k) for k, x in enumerate(d)) for d in steps if d >= (0, 0, 0, 0)]


def forest(a: np.ndarray, b: np.ndarray, same: bool, radius: int) -> list[tuple[int, int]]:
    """Positions (i, j) of links between two blocks that keep their components.

    A row of a block is a fingerprint, of one 64-bit word or several.
    """
    a, b = a.reshape(len(a), -1), b.reshape(len(b), -1)
    root, links = np.arange(len(b)), []
    strip = max(1, _STRIP // max(1, len(b)))
    for at in range(0, len(a), strip):
        differing = np.bitwise_count(a[at:at + strip, None, 0] ^ b[None, :, 0])
        for word in range(1, a.shape[1]):
            differing += np.bitwise_count(a[at:at + strip, None, word] ^ b[None, :, word])
        near = differing <= radius
        for k in np.flatnonzero(near.sum(axis=1) > 1 if same else near.any(axis=1)):
            i, hits = at + int(k), np.flatnonzero(near[k])
            roots, first = np.unique(root[hits], return_index=True)
            own = root[i] if same else -1
            links += [(i, int(hits[f])) for r, f in zip(roots, first) if r != own]
            if len(roots) > 1:
                root[np.isin(root, roots)] = roots[0]
    return links


def _compare(radius: int):
    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            left, right = [], []
            for prints, ids, same, other_prints, other_ids in zip(
                    batch["prints"], batch["ids"], batch["same"], batch["other_prints"], batch["other_ids"]):
                a = np.asarray(prints, np.int64).view(np.uint64)
                b = np.asarray(other_prints, np.int64).view(np.uint64)
                for i, j in forest(a, b, bool(same), radius):
                    left.append(ids[i])
                    right.append(other_ids[j])
            yield pd.DataFrame({"a": np.array(left, np.int64), "b": np.array(right, np.int64)})
    return compare


def links(distinct: DataFrame, radius: int = RADIUS, block: int = BLOCK) -> DataFrame:
    """Links (a, b) between ids of distinct fingerprints (print, least) that give their components."""
    tiled = distinct.withColumn("tile", _tile())
    # At most 17 ** 4 tiles exist, however many fingerprints there are.
    sizes = tiled.groupBy("tile").agg(F.ceil(F.count("*") / block).alias("parts"))
    blocks = stored(
        tiled.join(F.broadcast(sizes), "tile")
        .withColumn("part", F.pmod(F.xxhash64("print"), "parts"))
        .groupBy("tile", "part").agg(F.collect_list(F.struct("print", "least")).alias("rows"))
        .select("tile", "part", F.col("rows.print").alias("prints"), F.col("rows.least").alias("ids")), "tiles")
    offsets = F.array(*(F.lit(o).cast("long") for o in tile_offsets(radius)))
    left = blocks.withColumn("step", F.explode(offsets)).withColumn("near", F.col("tile") + F.col("step"))
    right = blocks.select(F.col("tile").alias("near"), F.col("part").alias("other_part"),
                          F.col("prints").alias("other_prints"), F.col("ids").alias("other_ids"))
    pairs = (left.join(right, "near").filter("step <> 0 OR part <= other_part")
             .select("prints", "ids", (F.expr("step = 0 AND part = other_part")).alias("same"),
                     "other_prints", "other_ids"))
    return pairs.mapInPandas(_compare(radius), "a long, b long")


def near_duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
                    radius: int = RADIUS) -> DataFrame:
    """(doc_id, fingerprint, component_id) of every row."""
    rows = stored(fingerprints(docs, id_column, text_column), "fingerprints")
    distinct = stored(rows.filter("doc_id IS NOT NULL").groupBy("print").agg(F.min("doc_id").alias("least")),
                      "distinct-fingerprints")
    # An id with several texts holds their fingerprints together.
    several = (rows.filter("doc_id IS NOT NULL").groupBy("doc_id")
               .agg(F.min("print").alias("m"), F.max("print").alias("n")).filter("m <> n").select("doc_id"))
    ties = (rows.join(several, "doc_id", "left_semi").join(distinct, "print")
            .select(F.col("doc_id").alias("a"), F.col("least").alias("b")))
    groups = connected_components(links(distinct, radius).unionByName(ties))
    named = stored(distinct.join(groups, distinct["least"] == groups["node"], "left")
                   .select("print", F.coalesce("component", "least").alias("component_id")), "components")
    return rows.join(named, "print", "left").select(
        "doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"),
        F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id"))


def _free_name(wanted: str, taken: list[str]) -> str:
    """A column name nobody uses, in whatever case."""
    known = {t.lower() for t in taken}
    while wanted.lower() in known:
        wanted += "_"
    return wanted


def deduplicate(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
                radius: int = RADIUS) -> DataFrame:
    """``docs`` with one row of each group of near copies, that of the least id; rows without an id stay.

    Groups are the components of :func:`near_duplicates`, taken row by row: rows
    that share an id are linked by their texts only, and of those with the least
    id of a group the first stays. Copies fold to one row per fingerprint before
    anything is joined.
    """
    row = _free_name("row_number", docs.columns)
    numbered = stored(docs.withColumn(row, F.monotonically_increasing_id()), "numbered")
    prints = numbered.filter(F.col(id_column).isNotNull()).select(
        F.col(row).alias("row"), F.col(id_column).alias("id"), _fingerprints(whole_text(text_column)).alias("print"))
    distinct = stored(prints.groupBy("print").agg(F.min("row").alias("least"), F.min(F.struct("id", "row")).alias("best")),
                      "distinct-fingerprints")
    groups = connected_components(links(distinct.select("print", "least"), radius))
    stay = (distinct.join(groups, distinct["least"] == groups["node"], "left")
            .groupBy(F.coalesce("component", "least").alias("group")).agg(F.min("best").alias("best"))
            .select(F.col("best.row").alias(row)))
    return (numbered.join(stored(stay, "stay"), row, "left_semi")
            .unionByName(numbered.filter(F.col(id_column).isNull())).drop(row))
