"""Packing documents into token sequences: first-fit decreasing in random groups.

A document's ids are cut at every ``capacity`` ids; the pieces are dealt to
random groups of about ``GROUP`` and packed within each by first-fit decreasing.
A tournament tree over the bins of a group holds the largest free room below
each node, so the first bin with room is found on one path from the root.
Groups are of bounded size whatever the corpus, sources or copies look like,
and independent of each other; each leaves at most a few bins open.

Defined results: a null text is empty and still has its end id; a text of any
length is cut whole; rows that share an id, or have none, are packed each (their
pieces carry that id); an empty table gives no rows. Other columns are not looked at.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tierline.llm.common import groups_for, stored, whole_text
from tierline.llm.words import word_tokenizer

CAPACITY, END_ID = 4096, 2
#: Pieces per group.
GROUP = 4096
_PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


def _cut(path: str, capacity: int, end_id: int, keep_ids: bool):
    step, end = 4 * capacity, end_id.to_bytes(4, "little")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = word_tokenizer(path).encode
        for batch in batches:
            rows, starts, lengths, sums, totals, kept = [], [], [], [], [], []
            for row, text in enumerate(batch.column(1)):
                ids = encode(text.as_py()) + end
                for at in range(0, len(ids), step):
                    piece = ids[at:at + step]
                    rows.append(row)
                    starts.append(at // 4)
                    lengths.append(len(piece) // 4)
                    sums.append(zlib.crc32(piece))
                    totals.append(len(ids) // 4)
                    if keep_ids:
                        kept.append(np.frombuffer(piece, "<u4").astype(np.int32))
            columns = [batch.column(0).take(pa.array(rows, pa.int64())),
                       *(pa.array(c, pa.int64()) for c in (starts, lengths, sums, totals))]
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
            if keep_ids:
                columns.append(pa.array(kept, pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names)
    return cut


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID,
           keep_ids: bool = False, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The documents' ids in pieces of at most ``capacity``, with ``keep_ids`` the ids themselves."""
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), whole_text(text_column).alias("text"))
    return rows.mapInArrow(_cut(tokenizer, capacity, end_id, keep_ids),
                           _PIECES + (", ids array<int>" if keep_ids else ""))


def first_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each item. No item may be longer than ``capacity``."""
    bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    size = 1 << max(0, (len(lengths) - 1).bit_length())
    room = [capacity] * (2 * size)
    for item in np.argsort(-lengths, kind="stable").tolist():
        need, node = int(lengths[item]), 1
        while node < size:
            node *= 2
            if room[node] < need:
                node += 1
        bins[item], offsets[item] = node - size, capacity - room[node]
        room[node] -= need
        while node > 1:
            node //= 2
            room[node] = max(room[2 * node], room[2 * node + 1])
    return bins, offsets


def _packed(capacity: int):
    def pack(group: pa.Table) -> pa.Table:
        bins, offsets = first_fit_decreasing(group.column("length").to_numpy(), capacity)
        number = group.column("group_no")[0].as_py() << 32
        return (group.drop_columns(["slot", "group_no"])
                .append_column("sequence_id", pa.array(bins + number))
                .append_column("offset", pa.array(offsets)))
    return pack


def pack(rows: DataFrame, capacity: int = CAPACITY, group: int = GROUP) -> DataFrame:
    """``rows`` (with a ``length`` of at most ``capacity``) and their sequence_id and offset."""
    # The random number is written, so a task that runs again deals its rows alike.
    rows = stored(rows.withColumn("slot", F.abs(F.xxhash64(F.monotonically_increasing_id(), F.lit(group)) % (1 << 40))),
                  "pieces")
    groups = groups_for(rows.count(), group)
    schema = ", ".join(f"`{n}` {t}" for n, t in rows.drop("slot").dtypes) + ", sequence_id long, offset long"
    return (rows.withColumn("group_no", F.col("slot") % groups)
            .groupBy("group_no").applyInArrow(_packed(capacity), schema))


def pack_documents(docs: DataFrame, tokenizer: str, **options) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    return pack(pieces(docs, tokenizer, **options))
