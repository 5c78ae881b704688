"""Removal of repeated substrings by a distributed difference cover.

Every byte goes that a string of ``LENGTH`` bytes covers which also starts
earlier. A difference cover samples the positions of a text whose remainder mod
``PERIOD`` is in ``COVER``: for any two positions there is one shift below the
period that takes both to sampled ones. So if two windows of ``LENGTH`` bytes are
equal, two samples inside them are followed by the same ``LENGTH - PERIOD + 1``
bytes, wherever the windows lie. Only samples are sorted and named:

1. Samples are sorted by that tuple of bytes; names that occur once are done.
2. The others are named again by their whole context, all windows through the
   sample, as a pair of names of windows. Of equal contexts all but the earliest
   are repeats, with every window through them.
3. What remains, windows through the earliest sample of a context whose tuple
   also has other contexts, is merged: these windows are sorted, and each is
   compared with its neighbour in that order.

The suffix order beyond ``LENGTH`` bytes is never needed, so one step of naming
takes the place of the full recursion, and names stand for sort order (equal
prefixes are neighbours) rather than for ranks.

Texts are held in units of a few MB in a table bucketed by unit, which all steps
read where it lies; only names and single bits per name are shuffled. A unit
folds its own repeats before it sends names, so a passage that a third of all
texts share is one name per unit. A step derives what it needs anew from the
unit and the bits so far, so a lost executor costs only its own units.

Names are 64-bit hashes used to find candidates. A repeat is removed in step 2 where
the 64 bits of the context and the bucket and 32 more bits of the name agree, in step 3
where the 128 bits of an independent digest do.

Defined results: a null text is empty; rows that share an id are ordered by
offset, then by their place; rows without an id come after all others. A text
lies in one unit however long it is. An empty table gives no rows. Other columns
are not looked at.
"""

from __future__ import annotations

import hashlib
import math
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from tierline import files
from tierline.llm.common import shuffle_partitions, stored, whole_text
from tierline.session import scratch_path

LENGTH = 100
#: A perfect difference set: every remainder mod 57 is a difference of two of these (fixed values).
PERIOD, COVER = 57, (0, 1, 3, 13, 32, 36, 43, 52)
#: Bytes of text per unit, and names per bucket in one task.
UNIT, NAMES = 4 << 20, 2_000_000
_U64 = np.uint64
_A, _B, _C = _U64(0x9E3779B97F4A7C15), _U64(0xC2B2AE3D27D4EB4F), _U64(0x165667B19E3779F9)


def _mix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    x = a * _A
    x += b
    x ^= x >> _U64(29)
    x *= _C
    return x


def _settled(x: np.ndarray) -> np.ndarray:
    """The same name with all its bits depending on all of its window."""
    x = (x ^ (x >> _U64(32))) * _B
    return x ^ (x >> _U64(29))


#: Places whose windows are named together, so that the work stays in the processor's cache.
_BLOCK = 1 << 14


def doubled_names(data: np.ndarray, *sizes: int) -> list[np.ndarray]:
    """For each size, a power of two, a name of the window of that size at every place of ``data``."""
    table = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64)
    out = [np.zeros(max(0, len(data) - n + 1), np.uint64) for n in sizes]
    for start in range(0, len(data), _BLOCK):
        level, size = table[data[start:start + _BLOCK + max(sizes) - 1]], 1
        while len(level):
            for names, n in zip(out, sizes):
                if n == size:
                    part = level[:min(_BLOCK, len(names) - start)]
                    names[start:start + len(part)] = part
            if size == max(sizes):
                break
            level, size = _mix(level[:-size], level[size:]), 2 * size
    return out


def window_names(doubled: np.ndarray, size: int, places: np.ndarray, length: int) -> np.ndarray:
    """Names of the windows of ``length`` (from ``size`` to twice that) at some places.

    Such a window is the pair of the windows of ``size`` at its ends.
    """
    return _settled(_mix(doubled[places], doubled[places + (length - size)] + _U64(length)))


class Unit:
    """The texts of one unit, their samples and what is known of them."""

    def __init__(self, data: bytes, doc_ids: list, lengths: list, buckets: int, bits: int, windows: bool):
        self.bytes, self.buckets, self.bits = data, buckets, bits
        self.data = np.frombuffer(data, np.uint8)
        self.lengths = np.array(lengths, np.int64)
        self.ends = np.cumsum(self.lengths)
        self.starts = self.ends - self.lengths
        top = np.iinfo(np.int64).max
        self.doc_ids = np.array([top if d is None else d for d in doc_ids], np.int64)
        short = LENGTH - PERIOD + 1
        # Samples of the longest text; a shorter one has the first of them that leave room for a tuple.
        longest = int(self.lengths.max(initial=0))
        offsets = (np.arange(0, longest + PERIOD, PERIOD)[:, None] + np.array(COVER)).ravel()
        counts = np.where(self.lengths >= LENGTH, np.searchsorted(offsets, self.lengths - short, side="right"), 0)
        self.doc = np.repeat(np.arange(len(self.lengths)), counts)
        self.at = (np.concatenate([np.empty(0, np.int64), *(offsets[:n] for n in counts.tolist())])
                   + np.repeat(self.starts, counts)).astype(np.int64)
        halves = doubled_names(self.data, 32, 64) if windows else doubled_names(self.data, 32)
        self.halves = halves[-1]
        self.name = window_names(halves[0], 32, self.at, short)
        self.unique, self.inverse, counts = np.unique(self.name, return_inverse=True, return_counts=True)
        self.local = counts > 1

    # -- step 1: names that occur more than once ---------------------------

    def bucket(self, names: np.ndarray) -> np.ndarray:
        """Bucket of a name; it grows with the name."""
        return ((names >> _U64(32)) * _U64(self.buckets) >> _U64(32)).astype(np.int64)

    def shortened(self) -> np.ndarray:
        return self.unique >> _U64(64 - self.bits)

    def candidates(self, flags: np.ndarray) -> None:
        """Takes the samples whose names repeat, ordered by name, context and place."""
        chosen = np.flatnonzero((flags | self.local)[self.inverse])
        at, doc = self.at[chosen], self.doc[chosen]
        first = np.maximum(at - PERIOD + 1, self.starts[doc])
        last = np.minimum(at, self.ends[doc] - LENGTH)
        ends = [window_names(self.halves, 64, places, LENGTH) for places in (first, last)]
        context = _settled(_mix(ends[0], ends[1] + ((at - first) * 256 + (last - first)).astype(np.uint64)))
        name, offset, ids = self.name[chosen], at - self.starts[doc], self.doc_ids[doc]
        order = np.lexsort((doc, offset, ids, context, name))
        self.first, self.last = first[order], last[order]
        self.context, self.cand_name = context[order], name[order]
        self.cand_id, self.cand_offset = ids[order], offset[order]
        same = (self.context[1:] == self.context[:-1]) & (self.cand_name[1:] == self.cand_name[:-1])
        self.fresh = np.concatenate(([True], ~same))[:len(order)]

    # -- step 2 and 3: windows ---------------------------------------------

    def _windows(self, chosen: np.ndarray) -> np.ndarray:
        """Whether a window at each place goes through one of the chosen samples."""
        edges = np.zeros(len(self.data) + 1, np.int32)
        np.add.at(edges, self.first[chosen], 1)
        np.add.at(edges, self.last[chosen] + 1, -1)
        return np.cumsum(edges)[:-1] > 0

    def open_windows(self, later: np.ndarray, several: np.ndarray) -> None:
        """``later`` and ``several`` tell of each fresh sample whether an earlier one has its
        context, and whether its name has other contexts."""
        repeated = ~self.fresh
        repeated[self.fresh] = later
        wanted = np.zeros(len(self.fresh), bool)
        wanted[self.fresh] = ~later & several
        self.repeats = self._windows(repeated)
        places = np.flatnonzero(self._windows(wanted) & ~self.repeats)
        view, digest = memoryview(self.bytes), xxhash.xxh3_128_digest
        digests = np.frombuffer(b"".join([digest(view[p:p + LENGTH]) for p in places.tolist()]), ">u8").astype(np.uint64)
        high, low = digests[::2], digests[1::2]
        doc = np.searchsorted(self.ends, places, side="right")
        offset, ids = places - self.starts[doc], self.doc_ids[doc]
        order = np.lexsort((doc, offset, ids, low, high))
        places, self.high, self.low = places[order], high[order], low[order]
        self.window_id, self.window_offset = ids[order], offset[order]
        same = (self.high[1:] == self.high[:-1]) & (self.low[1:] == self.low[:-1])
        fresh = np.concatenate(([True], ~same))[:len(places)]
        self.repeats[places[~fresh]] = True
        self.places, self.high, self.low = places[fresh], self.high[fresh], self.low[fresh]
        self.window_id, self.window_offset = self.window_id[fresh], self.window_offset[fresh]

    def removed(self, later: np.ndarray) -> np.ndarray:
        """Whether each byte goes; ``later`` tells of each open window whether an earlier one is equal."""
        self.repeats[self.places[later]] = True
        starts = np.flatnonzero(self.repeats)
        edges = np.zeros(len(self.data) + 1, np.int32)
        np.add.at(edges, starts, 1)
        np.add.at(edges, starts + LENGTH, -1)
        return np.cumsum(edges)[:-1] > 0


# -- bytes that are shuffled ------------------------------------------------


def _planes(values: np.ndarray) -> bytes:
    """Numbers with their first bytes together, then their second: high zero bytes compress to nothing."""
    return values.astype("<u8").view(np.uint8).reshape(-1, 8).T.tobytes()


def _from_planes(blob: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(blob, np.uint8).reshape(8, -1).T).view("<u8").ravel()


def _cuts(buckets: np.ndarray):
    """(bucket, slice) of each run of equal buckets; they come in order."""
    edges = np.flatnonzero(np.diff(buckets)) + 1
    for start, end in zip([0, *edges.tolist()], [*edges.tolist(), len(buckets)]):
        if end > start:
            yield int(buckets[start]), slice(start, end)


def _flags(found: list | None, number: int) -> np.ndarray:
    """The flags of a unit from its buckets' bits (bucket, n, bits), in the order of the buckets."""
    parts = [np.unpackbits(np.frombuffer(f["bits"], np.uint8), count=f["n"]).astype(bool)
             for f in sorted(found or [], key=lambda f: f["bucket"]) if f["kind"] == number]
    return np.concatenate(parts) if parts else np.zeros(0, bool)


_SENT = pa.schema([("bucket", pa.int64()), ("unit", pa.int64()), ("blob", pa.binary())])
_BITS = pa.schema([("unit", pa.int64()), ("bucket", pa.int64()), ("kind", pa.int32()), ("n", pa.int32()),
                   ("bits", pa.binary())])
_BITS_DDL = "unit long, bucket long, kind int, n int, bits binary"


def _units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    number, waiting, size = 0, [], 0

    def unit():
        key = (TaskContext.get().partitionId() << 32) + number
        return pa.RecordBatch.from_arrays(
            [pa.array([key]), pa.array([[d for d, _ in waiting]], pa.list_(pa.int64())),
             pa.array([[len(t) for _, t in waiting]], pa.list_(pa.int64())), pa.array([b"".join(t for _, t in waiting)])],
            ["unit", "doc_ids", "lengths", "data"])

    for batch in batches:
        for doc_id, text in zip(batch.column(0), batch.column(1)):
            data = text.as_py().encode("utf-8", "surrogatepass")
            if waiting and size + len(data) > UNIT:
                yield unit()
                number, waiting, size = number + 1, [], 0
            waiting.append((doc_id.as_py(), data))
            size += len(data)
    if waiting:
        yield unit()


def _step(step: int, buckets: int, bits: int, digests: bool = False):
    """What a unit sends in a step, or in the last one its result."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                unit = Unit(row["data"], row["doc_ids"], row["lengths"], buckets, bits, step > 1)
                found = row.get("found")
                if step > 1:
                    flags = _flags(found, 1)
                    unit.candidates(flags if len(flags) else np.zeros(len(unit.unique), bool))
                if step > 2:
                    unit.open_windows(_flags(found, 2), _flags(found, 3))
                if step == 4:
                    yield _result(unit, unit.removed(_flags(found, 4)), row["doc_ids"], digests)
                    continue
                if step == 1:
                    owner, sent = unit.bucket(unit.unique), [unit.shortened()]
                elif step == 2:
                    name = unit.cand_name[unit.fresh]
                    owner = unit.bucket(name)
                    sent = [name & _U64(0xFFFFFFFF), unit.context[unit.fresh],
                            unit.cand_id[unit.fresh].view(np.uint64), unit.cand_offset[unit.fresh].astype(np.uint64)]
                else:
                    owner = unit.bucket(unit.high)
                    sent = [unit.high, unit.low, unit.window_id.view(np.uint64), unit.window_offset.astype(np.uint64)]
                rows = [(b, b"".join(_planes(np.diff(s[c], prepend=_U64(0)) if step == 1 else s[c]) for s in sent))
                        for b, c in _cuts(owner)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([b for b, _ in rows], pa.int64()), pa.array([row["unit"]] * len(rows), pa.int64()),
                     pa.array([x for _, x in rows], pa.binary())], schema=_SENT)
    return run


def _result(unit: Unit, gone: np.ndarray, doc_ids: list, digests: bool) -> pa.RecordBatch:
    removed, spans, kept = [], [], []
    for start, end in zip(unit.starts.tolist(), unit.ends.tolist()):
        part = gone[start:end]
        removed.append(int(part.sum()))
        spans.append(int((part[1:] & ~part[:-1]).sum() + part[:1].sum()))
        rest = unit.data[start:end][~part].tobytes()
        kept.append(hashlib.sha256(rest).hexdigest() if digests else rest)
    return pa.RecordBatch.from_arrays(
        [pa.array(doc_ids, pa.int64()), pa.array(unit.lengths), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()),
         pa.array(kept, pa.string() if digests else pa.binary())],
        ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])


def _answer(step: int):
    """Compares what the units sent to a bucket; answers with bits in the order it was sent."""
    def run(group: pa.Table) -> pa.Table:
        units, bucket = group.column("unit").to_numpy(), group.column("bucket")[0].as_py()
        blobs = group.column("blob").to_pylist()
        if step == 1:
            parts = [np.cumsum(_from_planes(b), dtype=np.uint64) for b in blobs]
            sizes, values = [len(p) for p in parts], np.concatenate(parts)
            order = np.argsort(values, kind="stable")
            same = values[order][1:] == values[order][:-1]
            repeated = np.zeros(len(values), bool)
            repeated[order] = np.concatenate(([False], same)) | np.concatenate((same, [False]))
            flags = {1: repeated}
        else:
            parts = [np.frombuffer(b, np.uint8).reshape(4, -1) for b in blobs]
            sizes = [p.shape[1] // 8 for p in parts]
            a, b, ids, offsets = (np.concatenate([_from_planes(p[k].tobytes()) for p in parts]) for k in range(4))
            order = np.lexsort((np.repeat(units, sizes), offsets, ids.view(np.int64), b, a))
            new_a = np.concatenate(([True], a[order][1:] != a[order][:-1]))
            new = new_a | np.concatenate(([True], b[order][1:] != b[order][:-1]))
            later = np.zeros(len(a), bool)
            later[order] = ~new
            flags = {4: later}
            if step == 2:
                kinds = np.add.reduceat(new.astype(np.int64), np.flatnonzero(new_a))
                several = np.zeros(len(a), bool)
                several[order] = (kinds > 1)[np.cumsum(new_a) - 1]
                flags = {2: later, 3: several}
        ends = np.cumsum(sizes)
        rows = [(int(u), bucket, kind, n, np.packbits(f[e - n:e]).tobytes())
                for kind, f in flags.items() for u, n, e in zip(units, sizes, ends)]
        return pa.table([pa.array(c, t.type) for c, t in zip(zip(*rows), _BITS)], schema=_BITS)
    return run


def remove_repeats(docs: DataFrame, digests: bool = False, id_column: str = "doc_id",
                   text_column: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, n_removed, n_spans and the ``kept`` bytes.

    With ``digests`` the hexadecimal SHA-256 of the kept bytes stands for them.
    """
    spark = docs.sparkSession
    partitions = shuffle_partitions(spark)
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), whole_text(text_column).alias("text"))
    # A bucketed table: later steps join their bits to it without moving the texts.
    name, place = f"units_{uuid.uuid4().hex}", scratch_path(spark, "units")
    (rows.mapInArrow(_units, "unit long, doc_ids array<long>, lengths array<long>, data binary")
     .write.option("compression", "zstd").bucketBy(partitions, "unit").saveAsTable(name, path=place))
    try:
        units = spark.table(name)
        total = (units.agg(F.sum(F.octet_length("data"))).first()[0] or 0) * len(COVER) // PERIOD
        buckets = max(partitions, math.ceil(total / NAMES))
        bits = min(64, max(1, total).bit_length() + 13)
        answers, found = None, units
        for step in (1, 2, 3):
            sent = found.mapInArrow(_step(step, buckets, bits), "bucket long, unit long, blob binary")
            said = stored(sent.groupBy("bucket").applyInArrow(_answer(step), _BITS_DDL), f"repeats-{step}")
            answers = said if answers is None else answers.unionByName(said)
            gathered = answers.groupBy("unit").agg(F.collect_list(F.struct("bucket", "kind", "n", "bits")).alias("found"))
            found = units.join(gathered, "unit", "left")
        schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept " + ("string" if digests else "binary")
        return stored(found.mapInArrow(_step(4, buckets, bits, digests), schema), "kept")
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        files.delete(spark, place)
