"""Keyed type-1 upsert as joins: update matches, insert the rest, keep the others."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tierline.operators.clean import quoted

KEY = "dwid"


class DuplicateKeyError(ValueError):
    """Several new rows would update the same existing row."""


class KeyCollisionError(ValueError):
    """Rows of different ids have the same key."""


#: The least and the greatest witness of the rows of a key.
_LEAST, _GREATEST = "__least", "__greatest"


def _witnesses(witness: tuple[str, ...]) -> list[Column]:
    ids = F.struct(*(quoted(c) for c in witness))
    return [F.min(ids).alias(_LEAST), F.max(ids).alias(_GREATEST)] if witness else []


def matched_keys(current: DataFrame, batch: DataFrame, key: str = KEY,
                 carry: tuple[str, ...] = (), batch_is_small: bool = False, witness: tuple[str, ...] = ()) -> DataFrame:
    """Keys of ``batch`` that exist in ``current``, at most one row per key.

    Reads only the key column of ``current`` (and columns that follow from the
    key, in ``carry``). Both sides are folded to one row per key before they
    meet, so a hot key of either is one row per map task, and the join needs no
    shuffle beyond those of the folding. With a batch known to be small its keys
    are broadcast instead and ``current`` is not shuffled before. Null keys never match.
    With ``witness`` columns each key has the least and greatest of them that ``current`` holds.
    """
    present, wanted = current.select(key, *carry, *witness), batch.select(key).filter(F.col(key).isNotNull()).distinct()
    if batch_is_small:
        present, wanted = present.join(F.broadcast(wanted), key, "left_semi"), None
    carried = [*(F.first(c).alias(c) for c in carry), *_witnesses(witness)]
    folded = present.groupBy(key).agg(*carried) if carried else present.distinct()
    return folded if wanted is None else folded.join(wanted, key, "left_semi")


def conflicting_keys(batch: DataFrame, matched: DataFrame, key: str = KEY) -> DataFrame:
    """Matched keys that more than one new row carries."""
    repeated = (batch.filter(F.col(key).isNotNull())
                .groupBy(key).count().filter(F.col("count") > 1)
                .select(key))
    return repeated.join(matched.select(key), key, "left_semi")


def check_conflicts(batch: DataFrame, matched: DataFrame, key: str = KEY) -> None:
    examples = [r[key] for r in conflicting_keys(batch, matched, key).take(20)]
    if examples:
        raise DuplicateKeyError(
            f"Several new rows match one existing row; {key} values include {examples}")


def key_collisions(batch: DataFrame, matched: DataFrame | None, key: str = KEY, witness: tuple[str, ...] = ()) -> DataFrame:
    """Keys whose rows differ in the ``witness`` columns, with the least and greatest of those, as ``first`` and ``other``.

    ``matched`` are the keys of the table, with what its rows hold (:func:`matched_keys`).
    Both sides are one row per key when they meet.
    """
    own = batch.filter(F.col(key).isNotNull()).groupBy(key).agg(*_witnesses(witness))
    if matched is not None:
        own = own.unionByName(matched.select(key, _LEAST, _GREATEST)).groupBy(key).agg(
            F.min(_LEAST).alias(_LEAST), F.max(_GREATEST).alias(_GREATEST))
    return own.filter(~F.col(_LEAST).eqNullSafe(F.col(_GREATEST))).toDF(key, "first", "other")


def check_collisions(batch: DataFrame, matched: DataFrame | None, key: str = KEY, witness: tuple[str, ...] = ()) -> None:
    found = key_collisions(batch, matched, key, witness).take(20) if witness else []
    if found:
        examples = [f"{r[key]}: {tuple(r['first'])} and {tuple(r['other'])}" for r in found]
        raise KeyCollisionError(f"Different {', '.join(witness)} have the same {key}: {'; '.join(map(str, examples))}")


def updated_rows(current: DataFrame, batch: DataFrame, key: str = KEY) -> DataFrame:
    """Every row of ``current``, with the batch values where the key matches.

    Rows of ``current`` that share a key are all updated. ``current`` is the
    left side: a small batch is broadcast and ``current`` is not shuffled, a
    large one leaves adaptive execution free to split a hot key.
    """
    others = [c for c in batch.columns if c != key]
    incoming = batch.select(
        key, F.struct(*(quoted(c) for c in others)).alias("__incoming"))
    taken = F.col("__incoming").isNotNull()
    columns = [
        F.when(taken, F.col("__incoming").getField(c)).otherwise(quoted(c)).alias(c)
        if c in others else quoted(c)
        for c in current.columns]
    return current.join(incoming, key, "left").select(*columns)


def new_rows(batch: DataFrame, matched: DataFrame, key: str = KEY) -> DataFrame:
    """Batch rows whose key is not in the table; null keys are always new."""
    return batch.join(matched.select(key), key, "left_anti")


def upsert(current: DataFrame, batch: DataFrame, key: str = KEY) -> DataFrame:
    """The table after the upsert, as one lazy plan and without the conflict check.

    Columns that only ``current`` has keep their value in updated rows and are
    null in new ones.
    """
    return updated_rows(current, batch, key).unionByName(
        new_rows(batch, current.select(key).distinct(), key), allowMissingColumns=True)
