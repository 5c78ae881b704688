"""Exact duplicates by a tree merge of sorted digest runs.

A run is a set of (digest, proof, smallest row, count) entries sorted by digest.
Every input partition first folds its rows into a run. The runs then meet in
binomial rounds: partitions are numbered in binary, and in each round a
partition keeps the entries whose digest agrees with its number in the bits of
that round and sends the others to the partitions that differ in these bits
only. Each receiver merges its ``2 ** ROUND_BITS`` runs into one, keeping the
smallest row of equal entries. After all rounds a partition's number is the low
bits of its digests, so every digest has met all its copies, and no task ever
held more than its share. A text with any number of copies is one entry per
run from the first fold on, so a hot text does not load a partition.

The digest (64 bits) orders the runs. Entries are only merged when the proof,
SHA-256 of the normalised text, is equal too.

Defined results: a null text is empty; rows that repeat an id are rows of their
own, of which one stays; a row without an id stays only where no row of its
group has one; an empty table gives no rows. Other columns do not matter.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from tierline.llm.common import SPACES, shuffle_partitions, stored, whole_text

#: Bits settled per round: runs of 2 ** ROUND_BITS partitions are merged at a time.
ROUND_BITS = 3

_ENTRY = ("digest", "proof")


def normalised(column: str = "text") -> Column:
    return F.regexp_replace(whole_text(column), SPACES, " ")


def keyed(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id``, digest, proof and a row number ``tag`` of every row."""
    text = docs.select(F.col(id_column).alias("doc_id"), normalised(text_column).alias("text"))
    return text.select("doc_id", F.xxhash64("text").alias("digest"), F.sha2("text", 256).alias("proof"),
                       F.monotonically_increasing_id().alias("tag"))


def _rounds(partitions: int) -> int:
    return max(1, math.ceil(math.log2(max(2, partitions)) / ROUND_BITS))


def merge_runs(rows: DataFrame) -> DataFrame:
    """One row per text of :func:`keyed` rows: digest, proof, ``least`` row, ``size``."""
    rounds = _rounds(shuffle_partitions(rows.sparkSession))
    slots = 1 << (ROUND_BITS * rounds)
    # A row's rank: rows with an id first, by id, then by row number.
    least = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "tag")
    runs = (rows.withColumn("slot", F.pmod(F.spark_partition_id(), F.lit(slots)).cast("long"))
            .groupBy("slot", *_ENTRY).agg(F.min(least).alias("least"), F.count("*").alias("size")))
    for k in range(rounds):
        bits = ((1 << ROUND_BITS) - 1) << (ROUND_BITS * k)
        slot = (F.col("slot").bitwiseAND(F.lit(~bits & (slots - 1)).cast("long"))
                + F.col("digest").bitwiseAND(F.lit(bits).cast("long")))
        runs = (runs.withColumn("slot", slot)
                .repartition(slots, "slot").sortWithinPartitions("slot", *_ENTRY)
                .groupBy("slot", *_ENTRY).agg(F.min("least").alias("least"), F.sum("size").alias("size")))
    return runs.select(*_ENTRY, "least", "size")


def mark(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256, digest."""
    rows = stored(keyed(docs, id_column, text_column), "digests")
    runs = merge_runs(rows)
    # Rows are the left side: adaptive execution may split a hot text.
    return rows.join(runs, list(_ENTRY)).select(
        "doc_id", F.col("least.doc_id").alias("keep_id"), F.col("size").alias("group_size"),
        (F.col("tag") == F.col("least.tag")).alias("kept"), F.col("proof").alias("text_sha256"), "digest")


def deduplicate(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    marked = stored(mark(docs, id_column, text_column), "exact-groups")
    twins = marked.filter(~F.col("kept") & F.col("doc_id").eqNullSafe(F.col("keep_id")))
    names = docs.columns
    text = F.struct(*(F.col(f"`{c}`") for c in names)).alias("row")
    wide = docs.select(text, F.col(id_column).alias("doc_id"), normalised(text_column).alias("norm"))
    wide = wide.select("row", "doc_id", F.xxhash64("norm").alias("digest"), F.sha2("norm", 256).alias("text_sha256"))
    gone = marked.filter(~F.col("doc_id").eqNullSafe(F.col("keep_id"))).select(
        F.col("doc_id").alias("gone_id"), F.col("digest").alias("gone_digest"), F.col("text_sha256").alias("gone_sha"))
    same = (F.col("doc_id").eqNullSafe(F.col("gone_id")) & (F.col("digest") == F.col("gone_digest"))
            & (F.col("text_sha256") == F.col("gone_sha")))
    rest = wide.join(gone.distinct(), same, "left_anti")
    if not twins.isEmpty():  # rows that repeat an id and its text: one of them stays
        rest = rest.groupBy("doc_id", "digest", "text_sha256").agg(F.first("row").alias("row"))
    return rest.select("row.*")
