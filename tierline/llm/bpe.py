"""Byte-level BPE encoding of long and short texts, and decoding.

A text of at most ``CHUNK`` characters is one row of work. A longer one becomes
chunks that overlap by ``OVERLAP``; tasks pre-tokenise them in parallel, each
from the start of its chunk, which may lie inside a pre-token. Two neighbours
resynchronise at the first boundary that both find in their overlap: what
follows depends on the text from there on only, so from that place on they
agree. Between these places the pieces are encoded, again in parallel, and the
ids and raw bytes of a text are put together in order. A text in which some
neighbours have no boundary in common (a run of one class longer than the
overlap) is pre-tokenised whole, so the result never depends on the chunks.

Defined results: a null text is empty; rows that share an id, or have none,
are encoded each. Other columns do not matter.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tierline.llm.common import stored, whole_text
from tierline.llm.words import byte_tokenizer

#: Characters of a chunk, and of the text beyond it that the next one shares.
CHUNK, OVERLAP = 1 << 16, 1 << 10
#: Characters after a boundary that can bear on it (the pattern looks one ahead).
_AHEAD = 2


def _encode(path: str, pattern: str, digests: bool):
    """Rows (key..., text, size): the pieces of the first ``size`` characters, encoded and decoded."""
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = byte_tokenizer(path, pattern)
        for batch in batches:
            counts, ids_out, raw_out = [], [], []
            for text, size in zip(batch.column("text"), batch.column("size").to_pylist()):
                pieces = tokenizer.pieces(text.as_py())
                over = sum(map(len, pieces)) - size
                while over > 0:  # context after the boundary
                    over -= len(pieces.pop())
                ids = tokenizer.encode_pieces(pieces)
                raw = tokenizer.decode(ids)
                counts.append(len(ids) // 4)
                ids_out.append(hashlib.sha256(ids).hexdigest() if digests else ids)
                raw_out.append(hashlib.sha256(raw).hexdigest() if digests else raw)
            kind = pa.string() if digests else pa.binary()
            keys = batch.drop_columns(["text", "size"])
            yield pa.RecordBatch.from_arrays(
                [*keys.columns, pa.array(counts, pa.int64()), pa.array(ids_out, kind), pa.array(raw_out, kind)],
                [*keys.schema.names, "n_tokens", "ids", "decoded"])
    return encode


def _boundaries(path: str, pattern: str, chunk: int, overlap: int):
    """Rows (tag, no, text, last): piece starts in the chunk's first and last ``overlap`` characters."""
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = byte_tokenizer(path, pattern)
        for batch in batches:
            heads, tails = [], []
            for text, number, last in zip(batch.column("text"), batch.column("no").to_pylist(),
                                          batch.column("last").to_pylist()):
                at, head, tail = 0, [], []
                pieces = tokenizer.pieces(text.as_py())
                # A piece that touches the end of a chunk may go on beyond it.
                for piece in pieces if last else pieces[:-1]:
                    if at <= overlap:
                        head.append(number * chunk + at)
                    if at >= chunk:
                        tail.append(number * chunk + at)
                    at += len(piece)
                heads.append(head)
                tails.append(tail)
            places = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("tag"), batch.column("no"), pa.array(heads, places), pa.array(tails, places)],
                ["tag", "no", "head", "tail"])
    return find


def _whole(rows: DataFrame, path: str, pattern: str, digests: bool) -> DataFrame:
    kind = "string" if digests else "binary"
    return rows.select("doc_id", "text", F.length("text").cast("long").alias("size")).mapInArrow(
        _encode(path, pattern, digests), f"doc_id long, n_tokens long, ids {kind}, decoded {kind}")


def _gathered(part: str, digests: bool) -> Column:
    """The byte strings of a text's spans in order, as one or as its digest."""
    parts = F.transform(F.array_sort(F.collect_list(F.struct("no", F.hex(part).alias("hex")))), lambda p: p["hex"])
    whole = F.unhex(F.array_join(parts, ""))
    return F.sha2(whole, 256) if digests else whole


def _long(rows: DataFrame, path: str, pattern: str, chunk: int, overlap: int, digests: bool) -> DataFrame:
    size = F.length("text")
    last_no = F.ceil(size / chunk).cast("int") - 1
    # A text's last chunk is longer than its overlap, so that every stitch has room.
    chunks = stored(
        rows.select(F.monotonically_increasing_id().alias("tag"), "doc_id", "text",
                    last_no.alias("last_no"))
        .select("tag", "doc_id", "text", "last_no", F.explode(F.sequence(F.lit(0), "last_no")).alias("no"))
        .select("tag", "doc_id", "no", (F.col("no") == F.col("last_no")).alias("last"),
                F.substr("text", F.col("no") * chunk + 1, F.lit(chunk + overlap + _AHEAD)).alias("text"))
        .repartition("tag", "no"), "chunks")
    # The text of a chunk row that is not the last may still reach the end of its document.
    bounds = chunks.select("tag", "no", "text", "last").mapInArrow(
        _boundaries(path, pattern, chunk, overlap), "tag long, no int, head array<long>, tail array<long>")
    after = Window.partitionBy("tag").orderBy("no")
    stitches = bounds.select("tag", "no", F.lead("no").over(after).isNull().alias("final"),
                             F.array_min(F.array_intersect("tail", F.lead("head").over(after))).alias("until"))
    spans = stored(stitches.select("tag", "no", "final", "until", F.coalesce(
        F.lag("until").over(after), F.when(F.col("no") == 0, F.lit(0).cast("long"))).alias("since")), "stitches")
    broken = spans.filter("since IS NULL OR (until IS NULL AND NOT final)").select("tag").distinct()

    whole = (chunks.join(broken, "tag", "left_semi").groupBy("tag").agg(
        F.first("doc_id").alias("doc_id"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("no", F.left("text", F.lit(chunk)).alias("t")))),
                                 lambda c: c["t"]), "").alias("text")))
    offset = F.col("no").cast("long") * chunk
    end = F.coalesce("until", offset + F.length("text"))
    pieces = (chunks.join(spans.join(broken, "tag", "left_anti"), ["tag", "no"])
              .select("tag", "doc_id", "no",
                      F.substr("text", (F.col("since") - offset + 1).cast("int"),
                               (end - F.col("since") + _AHEAD).cast("int")).alias("text"),
                      (end - F.col("since")).alias("size"))
              .mapInArrow(_encode(path, pattern, False),
                          "tag long, doc_id long, no int, n_tokens long, ids binary, decoded binary"))
    joined = pieces.groupBy("tag").agg(
        F.first("doc_id").alias("doc_id"), F.sum("n_tokens").alias("n_tokens"),
        _gathered("ids", digests).alias("ids"), _gathered("decoded", digests).alias("decoded")).drop("tag")
    return joined.unionByName(_whole(whole, path, pattern, digests))


def encode(docs: DataFrame, path: str, pattern: str, chunk: int = CHUNK, overlap: int = OVERLAP,
           digests: bool = False, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id, n_tokens, ``ids`` (little-endian unsigned 32-bit) and ``decoded`` of every row.

    ``decoded`` are the raw bytes the ids stand for. With ``digests`` both come
    as the hexadecimal SHA-256 of these bytes, and short texts are not moved at all.
    """
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), whole_text(text_column).alias("text"))
    long = F.length("text") > chunk + overlap
    return _whole(rows.filter(~long), path, pattern, digests).unionByName(
        _long(rows.filter(long), path, pattern, chunk, overlap, digests))


def decode(rows: DataFrame, path: str, pattern: str, ids_column: str = "ids") -> DataFrame:
    """``rows`` with the raw bytes of their ids as ``decoded``; null ids give null."""
    names = [c for c in rows.columns if c != "decoded"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = byte_tokenizer(path, pattern)
        for batch in batches:
            raw = [None if i is None else table.decode(i) for i in batch.column(ids_column).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(raw, pa.binary())], [*names, "decoded"])
    kinds = dict(rows.dtypes)
    schema = ", ".join(f"`{n}` {kinds[n]}" for n in names) + ", decoded binary"
    return rows.select(*(f"`{n}`" for n in names)).mapInArrow(run, schema)
