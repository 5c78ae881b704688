"""Keyed state in buckets: a large batch is the only thing an upsert shuffles.

Where most batches touch most slices, :class:`~tierline.sources.snapshots.SnapshotTable`
shuffles the table by key for every join. Here each version is a catalog table bucketed
and sorted by the key. A batch is dealt to the same buckets, the joins read the table's
buckets where they lie, and the result is written bucket by bucket as the next version.
The price is that every upsert rewrites the whole table, and that rows without a key, and
those of one key, lie in one bucket: use it for keys that hardly repeat.

A version is published by a small file that only one writer can make, then the view
``<database>.<name>`` turns to it. The version before stays for its readers until the next.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession, functions as F

from tierline import files
from tierline.mapping import KEY
from tierline.operators import upsert
from tierline.session import scratch_path


class BucketedTable:
    """``database.name`` with its files below ``root``; ``buckets`` is fixed by the first load."""

    def __init__(self, spark: SparkSession, root: str, database: str, name: str, key: str = KEY, buckets: int = 200):
        self.spark, self.root, self.database, self.name, self.key = spark, root.rstrip("/"), database, name, key
        self._buckets = buckets

    def versions(self) -> list[int]:
        names = (p.rsplit("/", 1)[-1] for p, _ in files.children(self.spark, f"{self.root}/_versions"))
        return sorted(int(n[:-5]) for n in names if n.endswith(".json"))

    def _table(self, version: int) -> str:
        return f"`{self.database}`.`{self.name}__b{version}`"

    def buckets(self) -> int:
        versions = self.versions()
        if not versions:
            return self._buckets
        return json.loads(files.read_text(self.spark, f"{self.root}/_versions/{versions[-1]:012d}.json"))["buckets"]

    def read(self) -> DataFrame:
        return self.spark.table(self._table(self.versions()[-1]))

    def dealt(self, batch: DataFrame) -> DataFrame:
        """The batch by key in as many partitions as there are buckets, so the table need not move to meet it."""
        return batch.repartition(self.buckets(), F.col(self.key))

    def full_load(self, df: DataFrame) -> int:
        return self._save(self.dealt(df), (self.versions() or [0])[-1], self.buckets())

    def merged(self, batch: DataFrame) -> DataFrame:
        """The table after the upsert: both joins read its buckets without an exchange."""
        current = self.read()
        new = upsert.new_rows(batch, current.select(self.key), self.key)
        return upsert.updated_rows(current, batch, self.key).unionByName(new, allowMissingColumns=True)

    def upsert(self, batch: DataFrame) -> int:
        """Type-1 keyed load. Fails, changing nothing, when several batch rows match one existing row."""
        versions, buckets = self.versions(), self.buckets()
        if not versions:
            return self.full_load(batch)
        staging = scratch_path(self.spark, "bucketed")
        try:
            batch.write.parquet(staging)
            batch = self.dealt(self.spark.read.schema(batch.schema).parquet(staging))
            upsert.check_conflicts(batch, self.read().select(self.key), self.key)
            # Each partition of the result holds keys of one bucket, so a task writes one file.
            return self._save(self.merged(batch), versions[-1], buckets)
        finally:
            files.delete(self.spark, staging)

    def _save(self, rows: DataFrame, after: int, buckets: int) -> int:
        version, table = after + 1, self._table(after + 1)
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS `{self.database}`")
        path = f"{self.root}/v{version}-{scratch_path(self.spark, 'b').rsplit('-', 1)[-1]}"
        if files.exists(self.spark, f"{self.root}/_versions/{version:012d}.json"):
            raise FileExistsError(table)
        self.spark.sql(f"DROP TABLE IF EXISTS {table}")  # what a broken write left; its files stay apart
        (rows.write.format("parquet").bucketBy(buckets, self.key).sortBy(self.key)
         .option("path", path).saveAsTable(table.replace("`", "")))
        files.publish_text(self.spark, f"{self.root}/_versions/{version:012d}.json", json.dumps({"buckets": buckets, "path": path}))
        self.spark.sql(f"CREATE OR REPLACE VIEW `{self.database}`.`{self.name}` AS SELECT * FROM {table}")
        for old in self.versions()[:-2]:
            note = f"{self.root}/_versions/{old:012d}.json"
            gone = json.loads(files.read_text(self.spark, note))["path"]
            self.spark.sql(f"DROP TABLE IF EXISTS {self._table(old)}")
            files.delete(self.spark, note)
            files.delete(self.spark, gone)
        return version
