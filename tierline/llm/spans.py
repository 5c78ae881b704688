"""Pattern matches with their places in a text, by SQL functions only.

A pattern's matches and the pieces between them rebuild the text, so a match
starts where the pieces and matches before it end. Lengths are in code points.
Matches are numbered per text and kind and summed by a window; one text's
matches meet in one task, texts themselves are never shuffled.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from tierline.llm.common import whole_text

#: Characters of the surroundings kept on each side of a match.
CONTEXT = 48

_HIT = "struct<kind:int,pos:int,gap:int,head:string,tail:string,value:string>"


@dataclass(frozen=True)
class Kind:
    """A pattern, what a text must contain for it to be tried, a check of its matches,
    and a pattern for what stands before a match that rules it out."""
    name: str
    pattern: str
    needs: tuple[str, ...] = ()
    check: Callable[[Column], Column] | None = None
    unless_after: str | None = None

    def tried(self, text: Column) -> Column:
        tried = F.lit(not self.needs)
        for part in self.needs:
            tried = tried | F.contains(text, F.lit(part))
        return tried

    def valid(self, value: Column, before: Column) -> Column:
        valid = value.isNotNull()
        if self.unless_after:
            valid = valid & ~F.rlike(before, F.lit(self.unless_after))
        return valid & F.coalesce(self.check(value), F.lit(False)) if self.check else valid


def _hits(number: int, kind: Kind, text: Column, found: Column) -> Column:
    """The pieces of the text, each with the match that follows it; the last has none."""
    pieces = F.arrays_zip(F.split(text, kind.pattern, -1).alias("piece"), found.alias("value"))
    named = pieces.cast("array<struct<piece:string,value:string>>")
    hits = F.transform(named, lambda x, i: F.struct(
        F.lit(number).alias("kind"), i.alias("pos"), F.length(x["piece"]).alias("gap"),
        F.left(x["piece"], F.lit(CONTEXT)).alias("head"), F.right(x["piece"], F.lit(CONTEXT)).alias("tail"),
        x["value"].alias("value")))
    return F.when(F.size(found) > 0, hits.cast(f"array<{_HIT}>"))


def located(docs: DataFrame, kinds: list[Kind], id_column: str, text_column: str) -> DataFrame:
    """One row per match: tag, doc_id, kind (its number), start, end, value, before, after.

    A text without matches has one row, with null from ``kind`` on. ``tag``
    numbers the texts. Rows are dealt by ``tag``.
    """
    rows = docs.select(F.monotonically_increasing_id().alias("tag"), F.col(id_column).alias("doc_id"),
                       whole_text(text_column).alias("text"))
    text = F.col("text")
    found = rows.select("*", *(
        F.when(k.tried(text), F.regexp_extract_all(text, F.lit(k.pattern), F.lit(0))).alias(f"found{n}")
        for n, k in enumerate(kinds)))
    none = F.array().cast(f"array<{_HIT}>")
    hits = F.concat(*(F.coalesce(_hits(n, k, text, F.col(f"found{n}")), none) for n, k in enumerate(kinds)))
    place = Window.partitionBy("tag", "kind").orderBy("pos")
    size = F.coalesce(F.length("value"), F.lit(0))
    end = F.sum(F.col("gap").cast("long") + size).over(place.rowsBetween(Window.unboundedPreceding, 0))
    return (found.select("tag", "doc_id", F.explode_outer(hits).alias("hit")).select("tag", "doc_id", "hit.*")
            .repartition("tag")
            .withColumns({"end": end, "after": F.lead("head").over(place)})
            # The last piece of a text has done its part; a text without matches keeps its one row.
            .filter("value IS NOT NULL OR kind IS NULL")
            .select("tag", "doc_id", "kind", (F.col("end") - size).alias("start"), "end", "value",
                    F.col("tail").alias("before"), "after"))


def span_text(kinds: list[Kind], kind: Column, start: Column, end: Column) -> Column:
    names = F.array(*(F.lit(k.name) for k in kinds))
    return F.concat_ws(":", F.get(names, kind), start.cast("string"), end.cast("string"))


def of_kind(spans: Column, number: int) -> Column:
    return F.filter(spans, lambda s: s["kind"] == number)


def joined(spans: Column, kinds: list[Kind]) -> Column:
    """Sorted (start, kind, end) structs as ``kind:start:end``, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: span_text(kinds, s["kind"], s["start"], s["end"])), ",")


def masked(text: Column, kind: Kind, mask: str) -> Column:
    """The text with the valid matches of one kind replaced."""
    found = F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0))
    pieces = F.arrays_zip(F.split(text, kind.pattern, -1).alias("piece"), found.alias("value"))
    named = pieces.cast("array<struct<piece:string,value:string>>")
    done = F.array_join(F.transform(named, lambda x: F.concat(
        x["piece"], F.when(kind.valid(x["value"], F.right(x["piece"], F.lit(CONTEXT))), F.lit(mask)).otherwise(F.coalesce(x["value"], F.lit(""))))), "")
    return F.when(kind.tried(text) & (F.size(found) > 0), done).otherwise(text)
