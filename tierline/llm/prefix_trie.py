"""Prefix trie of conversations from sorted sequences and range minima over their LCPs.

Conversations are sequences of turns, each turn known by the SHA-256 of its role
and text. They are sorted by Spark, equal ones by id, and numbered; ``lcp`` of a
position is the number of turns it shares with the one before (-1 for the first).
A node of the trie is a prefix: the sequences that begin with it are an interval
of positions. Every candidate prefix (position, depth) searches the two ends of
its interval by itself, by binary steps over a sparse table of range minima: to
the right up to the first ``lcp`` below its depth, to the left down to the last.
No stack of open nodes is kept, so candidates can be searched anywhere.

Positions are dealt to blocks of ``BLOCK`` (more for tables beyond ``BLOCKS`` of
them), each with a sparse table of its own. One row per block (its least ``lcp``
and id, its sums) is what all tasks know; a search that leaves its block steps
over a sparse table of those rows to the block where it ends and is finished
there. What nodes report comes from their intervals:

* members: the interval's length; smallest member: a range minimum of the ids;
* saved tokens below a node: position k shares its first ``lcp`` turns with one
  before, so they are saved; the sum over the interval, less those above the node;
* leaves below it: positions whose successor does not extend them;
* children: nodes by the left end of their parent's interval;
* conversations that end at it: the run of equal sequences it begins with.

Defined results: rows without a conv_id take no part; a null role or text is
empty; turns with equal numbers, and those without, are ordered by the digest of
role and text, and repeated rows are turns of their own; an empty table has no
nodes; other columns are not looked at. A conversation is one row of digests,
40 bytes a turn, so its length is bounded by a row; its texts, of any length, are
digested where they lie. The ids that end at a node are hashed in their order,
as the digest asks; each block sends the text of its ids as one row.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tierline.llm.common import stored, whole_text

#: Conversations in a block, and blocks from which blocks grow instead.
BLOCK, BLOCKS = 512, 1 << 16
#: Conversations that share their first turns: an id less its remainder by this; turns taken are below HEADS.
FAMILY, HEADS = 100, 6
_EMPTY = hashlib.sha256(b"").hexdigest()
_ALL = (1 << 31) - 1


def digest(role: Column, text: Column) -> Column:
    """Stands for a turn. The role's length keeps role and text apart."""
    return F.unhex(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256))


def sequences(turns: DataFrame) -> DataFrame:
    """(conv_id, turns): the turns of each conversation in order, as structs of digest and length of the text."""
    role, text = whole_text("role"), whole_text("text")
    rows = turns.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.struct(F.col("turn").alias("turn"), digest(role, text).alias("digest"),
                 F.char_length(text).cast("long").alias("chars")).alias("t"))
    ordered = F.sort_array(F.collect_list("t"))  # nulls first
    return rows.groupBy("conv_id").agg(ordered.alias("turns")).select(
        "conv_id", F.transform("turns", lambda t: F.struct(t["digest"].alias("digest"), t["chars"].alias("chars"))).alias("turns"))


def rebuilt(own: DataFrame, family: int = FAMILY, heads: int = HEADS) -> DataFrame:
    """Every conversation with its first turns taken from the first of its family."""
    first = F.col("conv_id") - F.col("conv_id") % family
    h = (F.crc32(F.col("conv_id").cast("string")) % heads).cast("int")
    bases = own.filter(F.col("conv_id") % family == 0).select(
        F.col("conv_id").alias("base"), F.slice("turns", 1, heads - 1).alias("head"))
    joined = own.withColumn("base", first).join(bases, "base", "left")
    none = F.slice("turns", 1, 0)
    return joined.select("conv_id", F.concat(F.coalesce(F.slice("head", F.lit(1), h), none),
                                             F.slice("turns", h + 1, F.lit(_ALL))).alias("turns"))


def ordered(conversations: DataFrame) -> DataFrame:
    """(pos, conv_id, keys, chars) in the order of keys, then conv_id; written."""
    rows = conversations.select("conv_id", F.col("turns.digest").alias("keys"), F.col("turns.chars").alias("chars"))
    placed = stored(rows.orderBy("keys", "conv_id").select(
        "*", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("place")), "sorted")
    counts = placed.groupBy("part").agg(F.count("*").alias("n")).orderBy("part").collect()  # one row per partition
    offsets, total = [], 0
    for row in counts:
        offsets.append((row["part"], total))
        total += row["n"]
    first = placed.sparkSession.createDataFrame(offsets, "part int, first long")
    within = F.col("place") - F.shiftleft(F.col("part").cast("long"), 33)
    return placed.join(F.broadcast(first), "part").select((F.col("first") + within).alias("pos"), "conv_id", "keys", "chars")


def _marks(group: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What each position of a block shares with the one before it; the last of the block before comes along."""
    rows = sorted((r for batch in group for r in batch.to_pylist()), key=lambda r: r["pos"])
    out = {n: [] for n in ("block", "pos", "conv_id", "lcp", "sums", "shared", "ended")}
    before = None
    for row in rows:
        if row["own"]:
            lcp = -1
            if before is not None:
                lcp = next((i for i, (a, b) in enumerate(zip(before["keys"], row["keys"])) if a != b),
                           min(len(before["keys"]), len(row["keys"])))
            sums = np.concatenate(([0], np.cumsum(np.asarray(row["chars"], np.int64))))
            out["block"].append(row["block"])
            out["pos"].append(row["pos"])
            out["conv_id"].append(row["conv_id"])
            out["lcp"].append(lcp)
            out["sums"].append(sums)
            out["shared"].append(int(sums[max(lcp, 0)]))
            out["ended"].append(int(before is not None and lcp < len(before["keys"])))
        before = row
    yield pa.RecordBatch.from_arrays([pa.array(v, pa.list_(pa.int64()) if n == "sums" else pa.int64())
                                      for n, v in out.items()], list(out))


#: Of each position: its block, id, lcp, characters of its first turns (0, 1, ... of them), those of the
#: shared turns, and whether the one before it is a leaf of the trie.
_MARKS = "block long, pos long, conv_id long, lcp long, sums array<long>, shared long, ended long"


def marks(placed: DataFrame, block: int) -> DataFrame:
    here = placed.withColumn("block", F.floor(F.col("pos") / block)).withColumn("own", F.lit(True))
    last = (here.filter(F.col("pos") % block == block - 1)
            .withColumn("block", F.col("block") + 1).withColumn("own", F.lit(False)))
    return stored(here.unionByName(last).groupBy("block").applyInArrow(_marks, _MARKS), "marks")


class RangeMinima:
    """Sparse table: row j holds the minima of 2**j neighbours."""

    def __init__(self, values: np.ndarray):
        self.rows = [np.asarray(values, np.int64)]
        while len(self.rows[-1]) > 1 << (len(self.rows) - 1):
            half, step = self.rows[-1], 1 << (len(self.rows) - 1)
            self.rows.append(np.minimum(half[:-step], half[step:]))

    def least(self, first: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Minima of [first, end); the largest number where that is empty."""
        found = np.full(len(first), np.iinfo(np.int64).max)
        some = np.flatnonzero(end > first)
        level = np.frexp((end - first)[some].astype(float))[1] - 1
        for j in np.unique(level):
            at = some[level == j]
            found[at] = np.minimum(self.rows[j][first[at]], self.rows[j][end[at] - (1 << int(j))])
        return found

    def right(self, first: np.ndarray, depth: np.ndarray) -> np.ndarray:
        """The first place from ``first`` on whose value is below ``depth``; the length if there is none."""
        at = np.array(first, np.int64)
        for j in range(len(self.rows) - 1, -1, -1):
            row = self.rows[j]
            fits = at < len(row)
            fits[fits] = row[at[fits]] >= depth[fits]
            at[fits] += 1 << j
        return at

    def left(self, last: np.ndarray, depth: np.ndarray) -> np.ndarray:
        """The last place up to ``last`` whose value is below ``depth``; -1 if there is none."""
        at = np.array(last, np.int64)
        for j in range(len(self.rows) - 1, -1, -1):
            begins = at - (1 << j) + 1
            fits = begins >= 0
            fits[fits] = self.rows[j][begins[fits]] >= depth[fits]
            at[fits] -= 1 << j
        return at


@dataclass(frozen=True)
class Overview:
    """One entry per block: least lcp and id, sums of shared and ended, whether it begins within a run of equals."""

    size: int
    total: int
    lcp: np.ndarray
    conv: np.ndarray
    shared: np.ndarray
    ended: np.ndarray
    joins: np.ndarray


def overview(marked: DataFrame, size: int, total: int) -> Overview:
    joins = (F.col("pos") % size == 0) & (F.col("lcp") == F.size("sums") - 1) & (F.col("ended") == 0)
    # At most BLOCKS rows.
    rows = marked.groupBy("block").agg(
        F.min("lcp").alias("lcp"), F.min("conv_id").alias("conv"), F.sum("shared").alias("shared"),
        F.sum("ended").alias("ended"), F.max(joins.cast("int")).alias("joins")).orderBy("block").toPandas()
    return Overview(size, total, *(rows[c].to_numpy() for c in ("lcp", "conv", "shared", "ended", "joins")))


class _Block:
    """The positions of one block and the prefixes that are searched from it."""

    def __init__(self, batches: list[pa.RecordBatch]):
        table = pa.Table.from_batches(batches).sort_by("pos")
        column = lambda n: table.column(n).to_numpy()
        self.pos, self.conv, self.lcp = column("pos"), column("conv_id"), column("lcp")
        self.shared = np.concatenate(([0], np.cumsum(column("shared"))))
        self.ended = np.concatenate(([0], np.cumsum(column("ended"))))
        self.begins_leaf = column("ended")
        lists = table.column("sums").combine_chunks()
        self.sums, self.at = lists.flatten().to_numpy(), lists.offsets.to_numpy() - lists.offsets[0].as_py()
        self.length = np.diff(self.at) - 1
        self.number, self.first = int(table.column("block")[0].as_py()), int(self.pos[0])
        self.minima, self.least = RangeMinima(self.lcp), RangeMinima(self.conv)

    def prefixes(self) -> tuple[np.ndarray, np.ndarray]:
        """Candidates (place in the block, depth): every new prefix of a position and the one it hangs on.

        A position that begins the block within a run of equals is a candidate
        at its full length, for the run it belongs to.
        """
        least = np.maximum(self.lcp, 0)
        counts = np.where(self.lcp < self.length, self.length - least + 1, 0)
        if self.lcp[0] == self.length[0]:
            counts[0] = 1
        places = np.repeat(np.arange(len(self.pos)), counts)
        within = np.arange(len(places)) - np.repeat(np.cumsum(counts) - counts, counts)
        return places, least[places] + within


class _Searched:
    """The intervals of a block's prefixes, as far as the block goes, and what ends elsewhere."""

    def __init__(self, block: _Block, top: Overview, lcps: RangeMinima):
        self.place, self.depth = block.prefixes()
        self.end = block.minima.right(self.place + 1, self.depth)
        self.begin = block.minima.left(self.place, self.depth)
        # Every prefix that leaves the block at one side is, at its depth, the same one.
        n = len(block.pos)
        self.open_right, self.open_left = np.unique(self.depth[self.end == n]), np.unique(self.depth[self.begin < 0])
        number = np.full
        self.right_block = lcps.right(number(len(self.open_right), block.number + 1), self.open_right)
        self.left_block = lcps.left(number(len(self.open_left), block.number - 1), self.open_left)


def _blocks(group: Iterator[pa.RecordBatch]) -> _Block:
    return _Block([b for b in group if b.num_rows])


_OPEN = "block long, side int, depth long, target long"


def _opens(top: Overview):
    def opens(group: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = _blocks(group)
        found = _Searched(block, top, RangeMinima(top.lcp))
        sides = [np.repeat(s, len(d)) for s, d in ((1, found.open_right), (0, found.open_left))]
        depths = np.concatenate((found.open_right, found.open_left))
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(depths), block.number)), pa.array(np.concatenate(sides), pa.int32()), pa.array(depths),
             pa.array(np.concatenate((found.right_block, found.left_block)))], ["block", "side", "depth", "target"])
    return opens


_ANSWER = "target long, side int, depth long, at long, conv long, shared long, ended long"


def _answers(asked: pa.Table, held: pa.Table) -> pa.Table:
    """Where a search that comes from another block ends in this one, and what it passes here."""
    rows = asked.to_pydict()
    out = {n: [] for n in ("target", "side", "depth", "at", "conv", "shared", "ended")}
    block = _Block(held.to_batches()) if asked.num_rows else None
    for target, side, depth in zip(rows["target"], rows["side"], rows["depth"]):
        depths = np.array([depth])
        if side:
            end = int(block.minima.right(np.array([0]), depths)[0])
            least = block.conv[:end].min(initial=np.iinfo(np.int64).max)
            values = (block.first + end, int(least), int(block.shared[end]), int(block.ended[end] + block.begins_leaf[end]))
        else:
            begin = int(block.minima.left(np.array([len(block.pos) - 1]), depths)[0])
            values = (block.first + begin, int(block.conv[begin:].min()), 0, 0)
        for name, value in zip(out, (target, side, depth, *values)):
            out[name].append(value)
    return pa.table([pa.array(v, pa.int32() if n == "side" else pa.int64()) for n, v in out.items()], list(out))


_NODES = ("pos long, depth long, conv_id long, parent_pos long, parent_conv_id long, n_convs long, n_leaves long,"
          " saved_tokens long, ends_sha256 string, run long, block long, ids binary")


def _nodes(top: Overview):
    def nodes(held: pa.Table, resolved: pa.Table) -> pa.Table:
        block = _Block(held.to_batches())
        lcps, convs = RangeMinima(top.lcp), RangeMinima(top.conv)
        found, n = _Searched(block, top, lcps), len(block.pos)
        place, depth = found.place, found.depth
        known = {(r["side"], r["depth"]): r for r in resolved.to_pylist()}
        shared, ended = np.concatenate(([0], np.cumsum(top.shared))), np.concatenate(([0], np.cumsum(top.ended)))

        # Both ends of every prefix's interval and the least id within.
        begin, end = block.first + found.begin, block.first + found.end
        least = block.least.least(np.maximum(found.begin, 0), found.end)
        # Sums from the block's start to the end of the interval; the leaf at its last position is told by its successor.
        closes = np.minimum(found.end, n - 1)
        to_shared = block.shared[found.end]
        to_ended = block.ended[found.end] + np.where(found.end < n, block.begins_leaf[closes], 0)
        for d, target in zip(found.open_right, found.right_block):
            rows = np.flatnonzero((found.end == n) & (depth == d))
            between = convs.least(np.array([block.number + 1]), np.array([target]))[0]
            passed = [s[target] - s[block.number + 1] for s in (shared, ended)]
            if target < len(top.lcp):
                row = known[1, d]
                values = row["at"], min(between, row["conv"]), passed[0] + row["shared"], passed[1] + row["ended"]
            else:
                values = top.total, between, passed[0], passed[1] + 1
            end[rows] = values[0]
            least[rows] = np.minimum(least[rows], values[1])
            to_shared[rows] += values[2]
            to_ended[rows] += values[3]
        for d, target in zip(found.open_left, found.left_block):
            rows = np.flatnonzero((found.begin < 0) & (depth == d))
            between = convs.least(np.array([target + 1]), np.array([block.number]))[0]
            begin[rows] = known[0, d]["at"]
            least[rows] = np.minimum(least[rows], min(between, known[0, d]["conv"]))

        # A prefix longer than what its position shares is a node, first met here.
        new = depth > block.lcp[place]
        rows, parents = np.flatnonzero(new), np.flatnonzero(new) - 1
        spot, deep = place[rows], depth[rows]
        rooted = deep > 0
        members = end[rows] - block.pos[spot]
        above = block.sums[block.at[spot] + np.maximum(deep - 1, 0)]
        saved = to_shared[rows] - block.shared[spot + 1] - (members - 1) * above
        leaves = to_ended[rows] - block.ended[spot + 1]
        ends, chunks = self_ending(block, top, spot, deep, begin, place, depth)
        number = len(rows) + len(chunks)
        pad = [None] * len(chunks)
        column = lambda values, keep=None: pa.array(
            [*(v if k else None for v, k in zip(values.tolist(), np.ones(len(rows), bool) if keep is None else keep)), *pad],
            pa.int64())
        return pa.table([
            column(block.pos[spot]), column(deep), column(least[rows]), column(begin[parents], rooted),
            column(least[parents], rooted), column(members), column(leaves), column(saved),
            pa.array(ends + pad, pa.string()), pa.array([None] * len(rows) + [c[0] for c in chunks], pa.int64()),
            pa.array(np.full(number, block.number)),
            pa.array([None] * len(rows) + [c[1] for c in chunks], pa.binary())],
            [c.split()[0] for c in _NODES.split(", ")])
    return nodes


def self_ending(block: _Block, top: Overview, spot, deep, begin, place, depth):
    """Digests of the ids that end at each node, None where their run leaves the block; and the ids of such runs.

    The latter come as (first position of the run, ids joined by commas).
    """
    n = len(block.pos)
    starts = np.flatnonzero(np.concatenate(([True], (block.lcp != block.length)[1:] | (block.begins_leaf[1:] != 0))))
    stops = np.concatenate((starts[1:], [n]))
    goes_on = block.number + 1 < len(top.joins) and bool(top.joins[block.number + 1])
    came = bool(top.joins[block.number])
    digests, chunks = {}, []
    for a, b in zip(starts.tolist(), stops.tolist()):
        ids = ",".join(map(str, block.conv[a:b].tolist())).encode()
        if (a == 0 and came) or (b == n and goes_on):
            first = int(begin[0]) if a == 0 and came else int(block.pos[a])
            chunks.append((first, ids))
            digests[a] = None
        else:
            digests[a] = hashlib.sha256(ids).hexdigest()
    return [digests[a] if d == block.length[a] else _EMPTY for a, d in zip(spot.tolist(), deep.tolist())], chunks


def _long_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digest of each run's ids, whose texts come in order."""
    run, state = None, None
    for batch in batches:
        done = []
        for row in batch.to_pylist():
            if row["run"] != run:
                if state:
                    done.append((run, state.hexdigest()))
                run, state = row["run"], hashlib.sha256(row["ids"])
            else:
                state.update(b"," + row["ids"])
        yield _run_rows(done)
    if state:
        yield _run_rows([(run, state.hexdigest())])


def _run_rows(done: list[tuple[int, str]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], pa.int64()),
                                       pa.array([d[1] for d in done], pa.string())], ["run", "digest"])


def trie(conversations: DataFrame, block: int = BLOCK) -> DataFrame:
    """One row per node of the trie of ``conversations`` (conv_id, turns as structs of digest and chars)."""
    placed = ordered(conversations)
    total = placed.count()
    size = max(block, math.ceil(total / BLOCKS))
    marked = marks(placed, size)
    top = overview(marked, size, total)
    opens = stored(marked.groupBy("block").applyInArrow(_opens(top), _OPEN), "open")
    asked = opens.filter((F.col("target") >= 0) & (F.col("target") < len(top.lcp))).select("target", "side", "depth").distinct()
    answers = (asked.groupBy("target").cogroup(marked.withColumnRenamed("block", "target_block").withColumn(
        "block", F.col("target_block")).groupBy("target_block")).applyInArrow(_answers, _ANSWER))
    resolved = opens.join(answers, ["target", "side", "depth"]).select("block", "side", "depth", "at", "conv", "shared", "ended")
    found = stored(marked.groupBy("block").cogroup(resolved.groupBy("block")).applyInArrow(_nodes(top), _NODES), "nodes")
    nodes = found.filter("run IS NULL").drop("run", "block", "ids")
    children = (nodes.filter("parent_pos IS NOT NULL").groupBy("parent_pos", F.col("depth") - 1)
                .agg(F.count("*").alias("n_children")).toDF("pos", "depth", "n_children"))
    runs = (found.filter("run IS NOT NULL").select("run", "block", "ids").repartition("run")
            .sortWithinPartitions("run", "block").mapInArrow(_long_runs, "run long, digest string"))
    return (nodes.join(children, ["pos", "depth"], "left")
            .join(runs, (F.col("pos") == F.col("run")) & F.col("ends_sha256").isNull(), "left")
            .select("conv_id", "depth", "parent_conv_id", "n_convs", F.coalesce("n_children", F.lit(0).cast("long")).alias("n_children"),
                    "n_leaves", "saved_tokens", F.coalesce("ends_sha256", "digest").alias("ends_sha256")))
