"""Versioned Parquet tables for full loads and keyed upserts.

Layout below the table's root::

    data/version_no=<n>-<writer>/slice_no=<k>/part-*.parquet
    _manifests/<n>.json            which version folders make up each slice
    _registered/<name>.json        which version the catalog shows

A slice is a function of the key, so a key never moves between slices. An
upsert reads the key column of the slices its batch falls into, rewrites those
that hold a matching key and adds a folder to those that do not. All other
slices are neither read nor written. A version becomes visible when its
manifest appears, and readers of the older one are not disturbed. Each write has
a folder of its own; of two writers that start from the same version one
publishes, the other fails with :class:`FileExistsError` and may try again.

Columns may change with an upsert that says so: the table's types become the
common ones (:mod:`tierline.functions.lattice`), files written before keep theirs,
which the manifest notes per write, and are cast when they are read.

Where the catalog has a format with row-level operations, use
:func:`merge_into` and leave storage to that format.
"""

from __future__ import annotations

import hashlib
import json
import logging
import time
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from tierline import files
from tierline.functions.lattice import merged
from tierline.mapping import KEY
from tierline.operators import upsert
from tierline.session import scratch_path

logger = logging.getLogger(__name__)

SLICE, VERSION = "slice_no", "version_no"
NULL_SLICE = -1
#: Folders of one slice from which :meth:`SnapshotTable.compact` rewrites it.
CROWDED = 16
#: Seconds an unused version stays for its readers.
KEEP_SECONDS = 7 * 86400
#: Partition column of registered tables that tells versions apart, and partitions named in one statement.
SNAPSHOT, STATEMENT = "snapshot_no", 200
#: Parquet bytes of a batch, all columns, up to which its distinct keys are broadcast.
BROADCAST_BYTES = 8 << 20


def hash_slices(count: int, key: str = KEY) -> str:
    """Slice expression for dimensions: keys spread evenly."""
    if count < 1:
        raise ValueError(f"A table has at least one slice, not {count}")
    return f"pmod(xxhash64({key}), {count})"


def date_slices(days: int = 30, column: str = "date") -> str:
    """Slice expression for facts by a date their key begins with; all slices span ``days`` days."""
    return f"cast(floor(unix_date({column}) / {days}) AS int)"


ONE_SLICE = "0"


class SnapshotTable:
    """One versioned table. ``slice_by`` is a SQL expression over the key."""

    def __init__(self, spark: SparkSession, root: str, key: str = KEY,
                 slice_by: str = ONE_SLICE):
        self.spark, self.root, self.key = spark, root.rstrip("/"), key
        self._slice_by = slice_by

    # -- manifests ---------------------------------------------------------

    def versions(self) -> list[int]:
        names = (p.rsplit("/", 1)[-1] for p, _ in
                 files.children(self.spark, f"{self.root}/_manifests"))
        return sorted(int(n[:-5]) for n in names if n.endswith(".json"))

    def exists(self) -> bool:
        return bool(self.versions())

    def manifest(self, version: int | None = None) -> dict:
        version = self.versions()[-1] if version is None else version
        return json.loads(files.read_text(
            self.spark, f"{self.root}/_manifests/{version:012d}.json"))

    def _next(self, after: int | None = None) -> tuple[int, str]:
        """The number of the version after the given one, or the last, and the folder of this write."""
        version = ((self.versions() or [0])[-1] if after is None else after) + 1
        return version, f"{version:012d}-{uuid.uuid4().hex}"

    def _publish(self, version: int, schema: StructType, slice_by: str, slices: dict[str, list[str]],
                 older: dict | None = None) -> int:
        """``older`` has the types of the writes that were made with others: ``schemas`` and, by writer, ``written``."""
        used = {w for writers in slices.values() for w in writers}
        written = {w: n for w, n in (older or {}).get("written", {}).items() if w in used}
        changed = {"schemas": older["schemas"], "written": written} if written else {}
        files.publish_text(
            self.spark, f"{self.root}/_manifests/{version:012d}.json",
            json.dumps({"version": version, "key": self.key, "slice_by": slice_by,
                        "schema": schema.jsonValue(), "slices": slices} | changed))
        return version

    @staticmethod
    def _widened(manifest: dict, schema: StructType) -> dict:
        """The manifest as it would be with these columns; writes so far keep the ones they have."""
        schemas, written = [*manifest.get("schemas", []), manifest["schema"]], dict(manifest.get("written", {}))
        for writers in manifest["slices"].values():
            for writer in writers:
                written.setdefault(writer, len(schemas) - 1)
        return manifest | {"schema": schema.jsonValue(), "schemas": schemas, "written": written}

    # -- reading -----------------------------------------------------------

    def _folders(self, slices: dict[str, list[str]]) -> list[str]:
        return [f"{self.root}/data/{VERSION}={v}/{SLICE}={s}"
                for s, versions in sorted(slices.items()) for v in versions]

    def _by_schema(self, manifest: dict, only: set[str] | None = None) -> list[tuple[StructType, dict[str, list[str]]]]:
        """The chosen slices' writes, by the columns they were made with."""
        found: dict[int, dict[str, list[str]]] = {}
        for number, writers in manifest["slices"].items():
            for writer in writers if only is None or number in only else ():
                place = manifest.get("written", {}).get(writer, -1)
                found.setdefault(place, {}).setdefault(number, []).append(writer)
        schemas = [*manifest.get("schemas", []), manifest["schema"]]
        return [(StructType.fromJson(schemas[place]), slices) for place, slices in sorted(found.items())]

    def _read(self, manifest: dict, only: set[str] | None = None) -> DataFrame:
        """Rows of the chosen slices, with the slice number, older writes cast to the columns of now."""
        schema, rows = StructType.fromJson(manifest["schema"]), None
        for own, slices in self._by_schema(manifest, only):
            wide = StructType(own.fields).add(VERSION, StringType()).add(SLICE, IntegerType())
            part = (self.spark.read.schema(wide).option("basePath", f"{self.root}/data")
                    .parquet(*self._folders(slices)).drop(VERSION))
            part = part if own == schema else part.select(*_cast(own, schema), SLICE)
            rows = part if rows is None else rows.unionByName(part)
        if rows is None:
            return self.spark.createDataFrame([], StructType([*schema.fields, StructField(SLICE, IntegerType())]))
        return rows

    def read(self, version: int | None = None) -> DataFrame:
        return self._read(self.manifest(version)).drop(SLICE)

    def read_key(self, value: str | int) -> DataFrame:
        """The rows of one key; only its slice is read."""
        manifest = self.manifest()
        kind = StructType.fromJson(manifest["schema"])[self.key].dataType
        one = self.spark.range(1).select(F.lit(value).cast(kind).alias(self.key))
        number = self._sliced(one, manifest["slice_by"]).first()[SLICE]
        return self._read(manifest, {str(number)}).drop(SLICE).filter(F.col(self.key) == F.lit(value))

    # -- writing -----------------------------------------------------------

    def _sliced(self, df: DataFrame, slice_by: str) -> DataFrame:
        number = F.coalesce(F.expr(slice_by), F.lit(NULL_SLICE)).cast("int")
        return df.withColumn(SLICE, number)

    def _write(self, sliced: DataFrame, writer: str, slice_by: str) -> None:
        folder = f"{self.root}/data/{VERSION}={writer}"
        if slice_by == ONE_SLICE:
            sliced.drop(SLICE).write.parquet(f"{folder}/{SLICE}=0")
        else:
            # Gathers each slice into few files and splits slices that are too big.
            sliced.hint("rebalance", SLICE).write.partitionBy(SLICE).parquet(folder)

    def _written_slices(self, writer: str) -> list[str]:
        names = (p.rsplit("/", 1)[-1] for p, folder in
                 files.children(self.spark, f"{self.root}/data/{VERSION}={writer}") if folder)
        return [n.split("=", 1)[1] for n in names if n.startswith(f"{SLICE}=")]

    def full_load(self, df: DataFrame, after: int | None = None) -> int:
        """Replace the table by ``df``; the old version stays whole until then.

        With ``after`` it is the version after that one, or fails if another writer was first.
        """
        version, writer = self._next(after)
        self._write(self._sliced(df, self._slice_by), writer, self._slice_by)
        return self._publish(version, df.schema, self._slice_by,
                             {s: [writer] for s in self._written_slices(writer)})

    def latest(self) -> dict | None:
        """The manifest of the current version; None before the first load."""
        versions = self.versions()
        return self.manifest(versions[-1]) if versions else None

    def differs(self, rows: DataFrame) -> bool:
        """Whether the rows have other columns than the table, or other types."""
        manifest = self.latest()
        return manifest is not None and dict(rows.dtypes) != {
            f.name: f.dataType.simpleString() for f in StructType.fromJson(manifest["schema"])}

    def upsert(self, batch: DataFrame, stored_at: str | None = None,
               unique_keys: bool = False, based_on: dict | None = None, evolve: bool = False,
               update: list[str] | None = None, insert: list[str] | None = None,
               witness: tuple[str, ...] = ()) -> int:
        """Type-1 keyed load: update matching rows, insert the others.

        A missing table is a full load. Fails, changing nothing, when several
        batch rows match one existing row; ``unique_keys`` says that cannot be.
        The batch is read several times, so it is first written to the shared
        folder, which also keeps a lost executor from recomputing its whole
        history. Give ``stored_at`` if it already is a scan of that path. A batch
        that was chosen by what a version holds gives its manifest as ``based_on``:
        if there is a later version by now, :class:`FileExistsError` says so.

        With ``evolve`` the batch may have other columns: new ones are added,
        changed ones take the common type, and those it lacks keep their values in
        updated rows and are null in new ones. ``update`` and ``insert`` name the
        columns that existing and new rows take from the batch (all). Rows with
        one key must agree in the ``witness`` columns, which the key is made of;
        else :class:`KeyCollisionError` names some and nothing is changed.
        """
        manifest = based_on or self.latest()
        if manifest is None:
            upsert.check_collisions(batch, None, self.key, witness)
            return self.full_load(batch, after=0)
        schema = StructType.fromJson(manifest["schema"])
        if evolve:
            wider = merged(schema, batch.schema)
            if wider[self.key].dataType != schema[self.key].dataType:
                raise ValueError(f"The key of {self.root} is {schema[self.key].dataType.simpleString()}, not "
                                 f"{batch.schema[self.key].dataType.simpleString()}")
            if [(f.name, f.dataType) for f in wider] != [(f.name, f.dataType) for f in schema]:
                manifest, schema = self._widened(manifest, wider), wider
        elif dict(batch.dtypes) != {f.name: f.dataType.simpleString() for f in schema}:
            raise ValueError(f"Columns differ from the table {self.root}: "
                             f"{batch.schema.simpleString()} against {schema.simpleString()}")
        staging = scratch_path(self.spark, "upsert")
        kinds = {f.name: f.dataType for f in schema}
        batch = self._sliced(batch.select(*(F.col(f"`{c}`").cast(kinds[c]).alias(c) for c in schema.names
                                            if c in batch.columns)), manifest["slice_by"])
        try:
            if not stored_at or evolve:
                stored_at = f"{staging}/batch"
                batch.write.parquet(stored_at)
                batch = self.spark.read.schema(batch.schema).parquet(stored_at)
            return self._upsert_stored(batch, stored_at, unique_keys, manifest, staging, update, insert, witness)
        finally:
            files.delete(self.spark, staging)

    def _upsert_stored(self, batch, stored_at, unique_keys, manifest, staging, update, insert, witness) -> int:
        key, slice_by, names = self.key, manifest["slice_by"], StructType.fromJson(manifest["schema"]).names
        counted = self._slice_numbers(batch)
        touched, without_key = set(counted), sum(counted.values())
        if not touched:
            return manifest["version"]
        if without_key:
            logger.warning("%s: %d rows without a key are added as new", self.root, without_key)
        small = files.bytes_below(self.spark, stored_at) <= BROADCAST_BYTES
        (upsert.matched_keys(self._read(manifest, touched), batch, key, (SLICE,), small, witness)
         .write.parquet(f"{staging}/matched"))
        matched = self.spark.read.parquet(f"{staging}/matched")
        matching = set(self._slice_numbers(matched))
        upsert.check_collisions(batch, matched, key, witness)
        if matching and not unique_keys:
            upsert.check_conflicts(batch, matched, key)

        rows = upsert.new_rows(batch, matched, key)
        if insert is not None:
            rows = rows.select(*(c for c in rows.columns if c in (*insert, key, SLICE)))
        if matching:
            taken = batch if update is None else batch.select(*(c for c in batch.columns if c in (*update, key, SLICE)))
            rows = upsert.updated_rows(
                self._read(manifest, matching),
                taken.filter(F.col(SLICE).isin(*map(int, matching))), key).unionByName(rows, allowMissingColumns=True)
        kinds = {f.name: f.dataType for f in StructType.fromJson(manifest["schema"])}
        rows = rows.select(*(F.col(f"`{c}`") if c in rows.columns else F.lit(None).cast(kinds[c]).alias(c) for c in names), SLICE)
        writer = self._next(manifest["version"])[1]
        self._write(rows, writer, slice_by)
        return self._replace(manifest, writer, matching)

    def _replace(self, manifest: dict, writer: str, rewritten: set[str]) -> int:
        """Publish the version after ``manifest``: a write replaces some slices and adds to others."""
        slices = dict(manifest["slices"])
        for s in self._written_slices(writer):
            slices[s] = [writer] if s in rewritten else slices.get(s, []) + [writer]
        return self._publish(manifest["version"] + 1, StructType.fromJson(manifest["schema"]),
                             manifest["slice_by"], slices, manifest)

    def compact(self, crowded: int = CROWDED) -> int:
        """Rewrite the slices that lie in ``crowded`` folders or more; a new version if there are any."""
        manifest = self.manifest()
        chosen = {s for s, writes in manifest["slices"].items() if len(writes) >= crowded}
        if not chosen:
            return manifest["version"]
        writer = self._next(manifest["version"])[1]
        self._write(self._read(manifest, chosen), writer, manifest["slice_by"])
        return self._replace(manifest, writer, chosen)

    def read_slices_of(self, batch: DataFrame, manifest: dict) -> DataFrame:
        """The rows of the slices that the batch's rows belong to, whether or not they match."""
        return self._read(manifest, set(self._slice_numbers(self._sliced(batch, manifest["slice_by"])))).drop(SLICE)

    def _slice_numbers(self, sliced: DataFrame) -> dict[str, int]:
        """The slices that occur, each with its number of rows without a key."""
        without_key = F.count_if(F.col(self.key).isNull())
        return {str(number): count for number, count in sliced.groupBy(SLICE).agg(without_key).collect()}

    def expire(self, keep: int = 1, seconds: float = KEEP_SECONDS) -> None:
        """Remove versions nobody should read any more, and folders none of the others uses.

        The last ``keep`` versions stay, those younger than ``seconds``, and any
        that a catalog view shows. Writes in progress are younger than that, too;
        what broken ones leave goes when it is older.
        """
        oldest = time.time() - seconds
        versions = self.versions()
        if not versions:
            return
        shown = {json.loads(files.read_text(self.spark, p))["version"]
                 for p, _ in files.children(self.spark, f"{self.root}/_registered") if p.endswith(".json")}
        gone = [v for v in versions[:-keep] if v not in shown
                and files.modified(self.spark, f"{self.root}/_manifests/{v:012d}.json") <= oldest]
        old = []  # folders no write in progress uses, and no reader that began since
        for path, _ in files.children(self.spark, f"{self.root}/data"):
            number = int(path.rsplit("/", 1)[-1].split("=")[1].split("-")[0])
            if number <= versions[-1] and files.modified(self.spark, path) <= oldest:
                old.append(path)
        # Manifests are opened only if there is something to remove.
        used = {folder for v in versions if old and v not in gone
                for folder in self._folders(self.manifest(v)["slices"])}
        for version in gone:
            files.delete(self.spark, f"{self.root}/_manifests/{version:012d}.json")
        for path in old:
            name = path.rsplit("/", 1)[-1]
            slices = [p.rsplit("/", 1)[-1] for p, folder in files.children(self.spark, path) if folder]
            unused = [s for s in slices if f"{self.root}/data/{name}/{s}" not in used]
            if len(unused) == len(slices):
                files.delete(self.spark, path)
            else:
                for s in unused:
                    files.delete(self.spark, f"{path}/{s}")

    # -- catalog -----------------------------------------------------------

    def register(self, database: str, name: str, location: str | None = None) -> str:
        """Make the current version readable by SQL as ``database.name``.

        The files are an external table of the catalog, ``<name>__<schema>``,
        with one partition per folder. Its first partition column is the version
        the folder was registered for, so the partitions of two versions stand side
        by side and the view ``name`` changes from one to the other in one statement.
        The catalog resolves the partitions: filters on ``slice_no`` or
        ``version_no`` of the table read their folders only, and any engine that
        knows partitioned Parquet tables can read it.

        Catalogs take a missing folder for an empty one, so the view compares the
        number of rows in the files' footers with that at registration and fails
        if they differ. The version is noted, so :meth:`expire` leaves its folders
        alone until another is registered.
        """
        place = f" LOCATION '{location}'" if location else ""
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`{place}")
        manifest = self.manifest()
        schema = StructType.fromJson(manifest["schema"])
        rows = self._read(manifest).count()  # a missing folder fails here
        note = f"{self.root}/_registered/{database}.{name}.json"
        # Noted before the view changes: between the two the older version is still the view's.
        files.replace_text(self.spark, f"{note}.next.json", json.dumps({"version": manifest["version"]}))
        version, parts, last = manifest["version"], [], {}
        for own, slices in self._by_schema(manifest) or [(schema, {})]:
            held = self._partition_table(database, name, own)
            before = self._registered(held)
            self._partitions(held, "ADD IF NOT EXISTS", [
                f"{self._partition(version, writer, number)} LOCATION '{self.root}/data/{VERSION}={writer}/{SLICE}={number}'"
                for number, writers in sorted(slices.items()) for writer in writers])
            columns = ", ".join(f"CAST(`{f.name}` AS {f.dataType.simpleString()}) AS `{f.name}`" if f.name in own.names
                                else f"CAST(NULL AS {f.dataType.simpleString()}) AS `{f.name}`" for f in schema)
            parts.append((held, f"SELECT {columns} FROM {held} WHERE {SNAPSHOT} = {version}"))
            last[held] = before
        counts = " UNION ALL ".join(f"SELECT count(*) AS n FROM {held} WHERE {SNAPSHOT} = {version}" for held, _ in parts)
        whole = (f"(SELECT CASE WHEN sum(n) = {rows} THEN true ELSE raise_error(concat("
                 f"'files of {database}.{name} not found: ', sum(n), ' of {rows} rows are there')) END FROM ({counts}))")
        self.spark.sql(f"CREATE OR REPLACE VIEW `{database}`.`{name}` AS "
                       + " UNION ALL ".join(f"{select} AND {whole}" for _, select in parts))
        files.replace_text(self.spark, note, json.dumps({"version": version}))
        files.delete(self.spark, f"{note}.next.json")
        # The version shown last stays one time more, for queries that began with it.
        for held, before in last.items():
            kept = (max((v for v, _, _ in before if v < version), default=version), version)
            self._partitions(held, "DROP IF EXISTS", [self._partition(*p) for p in before if p[0] not in kept], ", ")
        for table in self.spark.sql(f"SHOW TABLES IN `{database}` LIKE '{name}__*'").collect():
            if f"`{database}`.`{table['tableName']}`" not in last and len(table["tableName"]) == len(name) + 14:
                self.spark.sql(f"DROP TABLE `{database}`.`{table['tableName']}`")  # of other columns; its files stay
        return f"{database}.{name}"

    def _partition_table(self, database: str, name: str, schema: StructType) -> str:
        """The external table that holds the partitions of versions with these columns."""
        digest = hashlib.sha256(schema.json().encode()).hexdigest()[:12]
        held = f"`{database}`.`{name}__{digest}`"
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
        self.spark.sql(f"""
            CREATE TABLE IF NOT EXISTS {held} ({columns}, {SNAPSHOT} BIGINT, {VERSION} STRING, {SLICE} INT) USING parquet
            PARTITIONED BY ({SNAPSHOT}, {VERSION}, {SLICE}) LOCATION '{self.root}/data'""")
        return held

    def _registered(self, held: str) -> list[tuple[int, str, str]]:
        """Version, writer and slice of each partition the catalog knows."""
        rows = self.spark.sql(f"SHOW PARTITIONS {held}").collect()
        parts = (dict(p.split("=", 1) for p in r["partition"].split("/")) for r in rows)
        return [(int(p[SNAPSHOT]), p[VERSION], p[SLICE]) for p in parts]

    @staticmethod
    def _partition(version: int, writer: str, number: str) -> str:
        return f"PARTITION ({SNAPSHOT} = {version}, {VERSION} = '{writer}', {SLICE} = {number})"

    def _partitions(self, held: str, action: str, partitions: list[str], between: str = " ") -> None:
        for at in range(0, len(partitions), STATEMENT):
            self.spark.sql(f"ALTER TABLE {held} {action} {between.join(partitions[at:at + STATEMENT])}")


def _cast(own: StructType, wanted: StructType) -> list[Column]:
    """The wanted columns from those there are; missing ones are null."""
    return [(F.col(f"`{f.name}`") if f.name in own.names else F.lit(None)).cast(f.dataType).alias(f.name) for f in wanted]


def merge_into(batch: DataFrame, table: str, key: str = KEY) -> None:
    """The same upsert as one statement, for catalogs with row-level operations."""
    values = {c: F.col(f"source.{c}") for c in batch.columns}
    (batch.alias("source")
     .mergeInto(table, F.col(f"{table}.{key}") == F.col(f"source.{key}"))
     .whenMatched().update({c: v for c, v in values.items() if c != key})
     .whenNotMatched().insert(values)
     .merge())
