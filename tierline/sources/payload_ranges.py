"""One large API document cut into rows by many tasks.

A document ``{"data": {"<table>": [{...}, ...], ...}}`` of any size is scanned as
text that ends at closing braces, so Spark splits the file by byte ranges like
any text file. What a range means depends on where it begins: inside a string or
not, and how deep. So each range is first read for both beginnings and gives for
each where it ends (in a string, levels up or down), the least level it reaches
and the keys it passes. These maps are composed along the file by windows over
the ranges, one row each. With its beginning known, every range then cuts out
its own rows. A row that begins in one range and ends in a later one comes as a
fragment of each; fragments are joined by the range in which their row began.

The documents are read twice, and nothing but fragments and one row per range is
shuffled. Rows stay the text they were delivered as, line breaks between their
values replaced by spaces.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tierline import files
from tierline.session import scratch_path

#: Segments of the scan end here; valid JSON has no escape that is cut by it.
_END = "}"
_QUOTE, _COLON, _BACKSLASH = b'":\\'
#: Levels: the document's members, those of ``data``, the elements of a table, the members of a row.
_DOCUMENT, _DATA, _TABLE, _ROW = 1, 2, 3, 4
#: What follows the key of a table that is a list, and of anything else.
_LIST, _OTHER = "[", "?"
#: A key that begins in an earlier segment.
_CUT = "\0"

_RANGE = ("file string, start long, quoted int, ends_quoted int, levels int, least int, keys map<int,string>,"
          " kinds map<int,string>")
_PIECE = "name string, value string, file string, began long, start long, note string"
#: Notes in place of a row: a table was seen, or cannot be cut.
_SEEN, _NAME_CUT, _NO_LIST, _NO_ROWS = ("seen", "has a name that holds a closing brace", "is no list of rows",
                                        "has elements that are no rows")


def _segments(spark: SparkSession, documents: str | list[str]) -> DataFrame:
    """The documents' text, cut at closing braces, in order within each byte range of a file."""
    return spark.read.text(documents, lineSep=_END).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), "value")


def _ranges_of(batch: pa.RecordBatch) -> Iterator[tuple[tuple[str, int], slice]]:
    """The byte ranges of a batch, each with its rows."""
    starts = batch.column("start").to_numpy()
    names = batch.column("file")
    edges = [0, *(np.flatnonzero(np.diff(starts)) + 1).tolist(), batch.num_rows]
    for a, b in zip(edges, edges[1:]):
        while a < b:  # files of one range each all start at zero
            name = names[a].as_py()
            end = next((i for i in range(a + 1, b) if names[i].as_py() != name), b) if names[b - 1].as_py() != name else b
            yield (name, int(starts[a])), slice(a, end)
            a = end


def _text(batch: pa.RecordBatch, rows: slice) -> bytes:
    return b"".join(v.as_buffer().to_pybytes() + b"}" for v in batch.column("value")[rows])


class _Scan:
    """Strings and levels of a piece of text, given whether it begins in a string and how deep."""

    def __init__(self, text: bytes, quoted: int, level: int):
        # An escape is two characters that are part of a string whatever they are.
        plain = re.sub(rb"\\.", b"  ", text, flags=re.DOTALL) if _BACKSLASH in text else text
        self.bytes = np.frombuffer(plain, np.uint8)
        self.quotes = self.bytes == _QUOTE
        parity = np.cumsum(self.quotes, dtype=np.int64) + quoted
        self.outside = (parity & 1 == 0) & ~self.quotes
        self.quoted = int(parity[-1] & 1) if len(parity) else quoted
        opens = self.outside & ((self.bytes == ord("{")) | (self.bytes == ord("[")))
        closes = self.outside & ((self.bytes == ord("}")) | (self.bytes == ord("]")))
        self.levels = level + np.cumsum(opens.astype(np.int32) - closes)
        self.level = int(self.levels[-1]) if len(parity) else level
        self.opens, self.closes, self.text = opens, closes, text

    def keys(self, deepest: int, last_only: bool = False) -> list[tuple[int, int, str, str]]:
        """Place, level, name and kind of value of each key at a level up to ``deepest``, or of the last of each level."""
        places = np.flatnonzero((self.bytes == _COLON) & self.outside & (self.levels <= deepest))
        if last_only:
            _, back = np.unique(self.levels[places][::-1], return_index=True)
            places = np.sort(places[::-1][back])
        found, quotes = [], np.flatnonzero(self.quotes) if len(places) else places
        for place, end in zip(places.tolist(), np.searchsorted(quotes, places).tolist()):
            value = re.compile(rb"\s*(.?)", re.DOTALL).match(self.text, place + 1)[1]
            name = self.text[quotes[end - 2] + 1:quotes[end - 1]].decode("utf-8", "replace") if end >= 2 else _CUT
            found.append((place, int(self.levels[place]), name, _LIST if value == b"[" else _OTHER))
        return found


def _read_ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What each range does, for both ways it may begin. Levels are relative to its beginning."""
    found: dict[tuple[str, int], list[dict]] = {}
    for batch in batches:
        for key, rows in _ranges_of(batch):
            states = found.setdefault(key, [{"quoted": q, "at": q, "level": 0, "least": 0, "keys": {}, "kinds": {}}
                                            for q in (0, 1)])
            text = _text(batch, rows)
            for state in states:
                scan = _Scan(text, state["at"], state["level"])
                for _, level, name, kind in scan.keys(_DATA, last_only=True):
                    state["keys"][level], state["kinds"][level] = name, kind
                state["at"], state["level"] = scan.quoted, scan.level
                state["least"] = min(state["least"], int(scan.levels.min(initial=0)))
    rows = [(*key, s["quoted"], s["at"], s["level"], s["least"], list(s["keys"].items()), list(s["kinds"].items()))
            for key, states in found.items() for s in states]
    named = pa.map_(pa.int32(), pa.string())
    kinds = (pa.string(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), named, named)
    columns = list(zip(*rows)) if rows else [()] * len(kinds)
    yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds)],
                                     [f.split()[0] for f in _RANGE.split(", ")])


def beginnings(ranges: DataFrame) -> DataFrame:
    """How each range begins: in a string, how deep, below which keys, and where the row that is open began."""
    before = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    # A range flips the state or keeps it, so the state is a parity.
    flips = ranges.filter("quoted = 0").withColumn(
        "begins", F.coalesce(F.sum("ends_quoted").over(before) % 2, F.lit(0))).select("file", "start", "begins")
    real = ranges.join(flips, ["file", "start"]).filter("quoted = begins")
    deep = real.withColumn("level", F.coalesce(F.sum("levels").over(before), F.lit(0)).cast("int"))

    def last(values: str, level: int):
        return F.last(F.try_element_at(values, F.lit(level) - F.col("level")), ignorenulls=True).over(before)
    return deep.select(
        "file", "start", F.col("quoted"), "level",
        last("keys", _DOCUMENT).alias("member"), last("keys", _DATA).alias("name"), last("kinds", _DATA).alias("kind"),
        # A row that is open at a range's end began in the last range that was outside of rows.
        F.max(F.when(F.col("level") + F.col("least") < _ROW, F.col("start"))).over(before).alias("began"))


class _Cutter:
    """Cuts the rows out of one range, whose text comes in parts."""

    def __init__(self, key, quoted, level, member, name, kind, began):
        self.file, self.start = key
        self.quoted, self.level, self.member, self.name, self.kind = quoted, level, member, name, kind
        self.began = began if level >= _ROW else None  # the open row's range, if it is an earlier one
        self.open: list[bytes] = []
        self.out: list[tuple] = []

    def _in_table(self) -> bool:
        return self.member == "data" and self.kind == _LIST

    def _emit(self, name: str, value: bytes, began: int | None = None, note: str | None = None) -> None:
        self.out.append((name, value.decode("utf-8", "replace"), self.file, began, self.start, note))

    def _pass(self, level: int, name: str, kind: str) -> None:
        """A key of the document or of ``data``."""
        if level == _DOCUMENT:
            self.member = name
        elif level == _DATA:
            self.name, self.kind = name, kind
            if self.member == "data":
                self._emit(name, b"", None, _NAME_CUT if name == _CUT else _SEEN if kind == _LIST else _NO_LIST)

    def feed(self, text: bytes) -> None:
        scan = _Scan(text, self.quoted, self.level)
        levels, whole = scan.levels, scan.bytes
        keys = scan.keys(_DATA)
        bounds = [0, *(k[0] for k in keys), len(text)]
        opened = np.flatnonzero(scan.opens & (levels == _ROW) & (whole == ord("{")))
        closed = np.flatnonzero(scan.closes & (levels == _TABLE))
        # Elements of a table that are no rows: anything between its rows but commas and white space.
        between = (levels == _TABLE) & (scan.outside | scan.quotes) & ~scan.opens
        between &= ~np.isin(whole, np.frombuffer(b" \t\r\n,}]", np.uint8))
        stray = np.flatnonzero(between | (scan.opens & (levels == _ROW) & (whole == ord("["))))
        at = 0 if self.level >= _ROW else None
        for n, (first, end) in enumerate(zip(bounds, bounds[1:])):
            if n:
                self._pass(*keys[n - 1][1:])
            if not self._in_table():
                if (levels[first:end] < _ROW).any():  # what was open there ended, and was no row
                    at, self.began = None, None
                continue
            inside = lambda places: places[slice(*np.searchsorted(places, (first, end)))]
            if len(inside(stray)):
                self._emit(self.name, b"", None, _NO_ROWS)
            ends, starts = inside(closed).tolist(), inside(opened).tolist()
            if at is not None and ends:  # the row that was open
                self._emit(self.name, b"".join(self.open) + text[at:ends[0] + 1], self.began)
                at, self.open, self.began, ends = None, [], None, ends[1:]
            for a, b in zip(starts, ends):
                self._emit(self.name, text[a:b + 1])
            if len(starts) > len(ends):
                at = starts[-1]
        if at is not None and self._in_table():
            self.open.append(text[at:])
        self.quoted, self.level = scan.quoted, scan.level

    def end(self) -> None:
        """A row that is still open gives a fragment, of this range's row or of an earlier one's."""
        if self.open:
            self._emit(self.name, b"".join(self.open), self.start if self.began is None else self.began)


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    cutter = None
    for batch in batches:
        done = []
        for key, rows in _ranges_of(batch):
            if cutter is None or (cutter.file, cutter.start) != key:
                if cutter:
                    cutter.end()
                    done += cutter.out
                first = {n: batch.column(n)[rows.start].as_py() for n in ("quoted", "level", "member", "name", "kind", "began")}
                cutter = _Cutter(key, **first)
            cutter.feed(_text(batch, rows))
        if cutter:
            done += cutter.out
            cutter.out = []
        yield _pieces(done)
    if cutter:
        cutter.end()
        yield _pieces(cutter.out)


def _pieces(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string())
    columns = list(zip(*rows)) if rows else [()] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds)],
                                      [f.split()[0] for f in _PIECE.split(", ")])


def cut_documents(spark: SparkSession, documents: str | list[str], tables: tuple[str, ...],
                  scratch: str | None = None) -> DataFrame:
    """(name, value): every row of the named tables as JSON text on one line.

    A table that the documents do not hold is a KeyError, one that is no list of
    rows a TypeError. The rows are read from ``scratch``, by default a folder that
    goes when the application ends.
    """
    copy = scratch or scratch_path(spark, "payload-ranges")
    segments = _segments(spark, documents)
    segments.mapInArrow(_read_ranges, _RANGE).write.parquet(f"{copy}/ranges")
    begins = beginnings(spark.read.parquet(f"{copy}/ranges"))
    begins.write.parquet(f"{copy}/begins")
    begins = spark.read.parquet(f"{copy}/begins")
    # One row per byte range of the scan: about a millionth of the documents.
    known = begins.select("file", "start", "quoted", "level", "member", "name", "kind", "began")
    pieces = segments.join(F.broadcast(known), ["file", "start"]).mapInArrow(_cut, _PIECE)
    wanted = pieces.filter(F.col("name").isin(*tables) | (F.col("name") == _CUT))
    wanted.write.parquet(f"{copy}/pieces")
    files.delete(spark, f"{copy}/ranges")
    cut = spark.read.schema(_PIECE).parquet(f"{copy}/pieces")
    _check(cut, tables)
    # At most two fragments a range.
    fragments = cut.filter("began IS NOT NULL").groupBy("file", "began").agg(
        F.max("name").alias("name"), F.array_sort(F.collect_list(F.struct("start", "value"))).alias("parts"))
    joined = fragments.select("name", F.array_join(F.col("parts.value"), "").alias("value"))
    rows = cut.filter("began IS NULL AND note IS NULL").select("name", "value").unionByName(joined)
    return rows.select("name", F.regexp_replace("value", r"[\r\n]+", " ").alias("value"))


def _check(cut: DataFrame, tables: tuple[str, ...]) -> None:
    noted = {(r["name"], r["note"]) for r in cut.filter("note IS NOT NULL").select("name", "note").distinct().collect()}
    for name, note in sorted(noted):
        if note != _SEEN:
            raise TypeError(f"Table {name!r} {note}; read such documents whole")
    for name in tables:
        if (name, _SEEN) not in noted:
            raise KeyError(f"The documents hold no table {name!r}")
