"""Status events of the jobs, the keyed run log, and the gates that read it."""

from __future__ import annotations

import random
import time

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tierline import files
from tierline.session import scratch_path
from tierline.sources.snapshots import SnapshotTable, hash_slices

# Event envelope, producers and message texts.
TABLE_PROBLEM = "There was issue while processing table:{}\nERROR: {}\n"
DATE_PROBLEM = " There was issue while processing dim date \nERROR: {}\n"
EVENT_SOURCE = "pf-resources"
EVENT_TYPE = "pf-resource-event"
INGEST, TO_BRONZE, TO_SILVER, TO_GOLD = (
    "ingest-lambda", "landing-2-bronze", "bronze-2-silver", "silver-2-gold")
SUCCESS, FAILURE, PARTIAL = "success", "failed", "partial"
MESSAGES = {
    INGEST: ("The ingestion was successfull:",
             "An error was occured while ingesting files. Error:"),
    TO_BRONZE: ("The data transfer from landing to bronze was successfull:",
                "An error was occured while transfering files from landing to bronze. Error:"),
    TO_SILVER: ("The data transfer from bronze to silver was successfull:",
                "An error was occured while transfering files from bronze to silver. Error:"),
    TO_GOLD: ("Processing dim date was successfull:",
              "An error was occured while processing dim date. Error:"),
}

LOG_KEY = "task_run_id"
DETAIL_SCHEMA = "run_id string, producer string, status string, message string"
#: ``Time`` is the arrival time the event bus adds; it may be absent.
EVENT_SCHEMA = "Source string, DetailType string, Detail string, Time timestamp"


def message_text(producer: str, status: str, update: str) -> str:
    done, failed = MESSAGES[producer]
    return (failed if status == FAILURE else done) + update


def task_run_id(run_id: Column, producer: Column) -> Column:
    """Log key: run id as a whole number, then the producer. Null if it is no number."""
    return F.concat(run_id.try_cast("bigint").cast("string"), F.lit("_"), producer)


def status_events(df: DataFrame, run_id: Column, producer: Column, status: Column,
                  message: Column, *keep: Column | str) -> DataFrame:
    """Event envelopes, one per input row, with further columns to ``keep``."""
    detail = F.struct(run_id.alias("run_id"), producer.alias("producer"),
                      status.alias("status"), message.alias("message"))
    return df.select(F.lit(EVENT_SOURCE).alias("Source"),
                     F.lit(EVENT_TYPE).alias("DetailType"),
                     F.to_json(detail, {"ignoreNullFields": "false"}).alias("Detail"),
                     *keep)


def status_event(spark: SparkSession, run_id: int | str, producer: str, status: str,
                 update: str = "ok") -> DataFrame:
    """The one event a job sends when it ends."""
    texts = (str(run_id), producer, status, message_text(producer, status, update))
    return status_events(spark.range(0, 1, 1, 1), *(F.lit(t) for t in texts),
                         F.current_timestamp().alias("Time"))


def own_events(events: DataFrame) -> DataFrame:
    """Events of this system only."""
    return events.filter((F.col("Source") == EVENT_SOURCE) & (F.col("DetailType") == EVENT_TYPE))


def log_records(events: DataFrame, *keep: str) -> DataFrame:
    """``task_run_id`` and ``body`` of each event; the key is null if unusable.

    The detail is parsed by a generator, so that later filters on its fields
    read them instead of parsing the text again.
    """
    detail = F.array(F.from_json("Detail", DETAIL_SCHEMA))
    parsed = events.select(*keep, F.inline_outer(detail))
    body = F.struct("run_id", "producer", "status", "message")
    return parsed.select(task_run_id(F.col("run_id"), F.col("producer")).alias(LOG_KEY),
                         body.alias("body"), *keep)


def latest_records(records: DataFrame, *order: str) -> DataFrame:
    """Last record per key, with its ``order`` columns. Records without a key are refused,
    as by a keyed store.

    ``order`` should decide the order; equal ones fall back on the content. An
    aggregate, so each task sends on one record per key, however hot the key.
    """
    last = F.max(F.struct(*order, "body")).alias("last")
    return records.filter(F.col(LOG_KEY).isNotNull()).groupBy(LOG_KEY).agg(last).select(LOG_KEY, "last.*")


def gate_state(log: DataFrame) -> DataFrame:
    """The log with ``is_open``: true only for status ``success``."""
    is_open = F.coalesce(F.col("body.status") == SUCCESS, F.lit(False))
    return log.select("*", is_open.alias("is_open"))


def run_summary(log: DataFrame) -> DataFrame:
    """Per run: number of steps, failed steps, and ``partial`` if any failed."""
    bad = F.col("body.status") != SUCCESS
    return (log.groupBy(F.col("body.run_id").alias("run_id"))
            .agg(F.count(F.lit(1)).alias("steps"), F.count_if(bad).alias("failed_steps"),
                 F.bool_or(F.coalesce(bad, F.lit(True))).alias("any_failed"))
            .select("run_id", "steps", "failed_steps",
                    F.when(F.col("any_failed"), PARTIAL).otherwise(SUCCESS).alias("status")))


#: Slices of the stored log, and how often a writer tries again when another was first.
LOG_SLICES, ATTEMPTS = 8, 20


class RunLog:
    """The keyed run log as a table; of each key the last event by time is kept.

    The time is stored with the record, so the result does not depend on how
    events were cut into batches or in which order those were applied. Events
    without a time count as older than all others; of these the last applied stays.
    """

    def __init__(self, spark: SparkSession, root: str, slice_by: str = hash_slices(LOG_SLICES, LOG_KEY)):
        self.spark = spark
        self.table = SnapshotTable(spark, root, key=LOG_KEY, slice_by=slice_by)

    def apply(self, events: DataFrame, *order: str) -> None:
        """Upsert a batch of events; applying the same batch again changes nothing.

        ``order`` names the columns that order events, the same in all batches.
        Several writers may apply batches at a time: one that loses the race for
        the next version starts again from the winner's.
        """
        self.put(latest_records(log_records(own_events(events), *order), *order), *order)

    def put(self, records: DataFrame, *order: str) -> None:
        """Upsert records of one row per key (``task_run_id``, ``body`` and the order).

        Only the slices of the batch are read. What is newer is decided by one
        version of the log and written after that one: if another writer came
        between, both are done again.
        """
        # All writers of a log store the order under the same names.
        places = [F.col(c).alias(f"order_{i}") for i, c in enumerate(order)]
        order = tuple(f"order_{i}" for i in range(len(order))) or ("order_0",)
        records = records.select(LOG_KEY, "body", *(places or [F.lit(None).cast("timestamp").alias("order_0")]))
        path = scratch_path(self.spark, "events")
        records.write.parquet(path)
        batch = self.spark.read.schema(records.schema).parquet(path)
        try:
            for attempt in range(ATTEMPTS):
                try:
                    manifest = self.table.latest()
                    self.table.upsert(self._newer(batch, order, manifest), unique_keys=True, based_on=manifest)
                    break
                except FileExistsError:
                    if attempt == ATTEMPTS - 1:
                        raise
                    time.sleep(random.uniform(0, 0.2 * (attempt + 1)))
        finally:
            files.delete(self.spark, path)

    def _newer(self, batch: DataFrame, order: tuple[str, ...], manifest: dict | None) -> DataFrame:
        """The records of the batch that no stored one of that version is later than."""
        if manifest is None:
            return batch
        stored = self.table.read_slices_of(batch, manifest).select(
            F.col(LOG_KEY).alias("__key"), F.struct(*order).alias("__stored"))
        later = (F.col(LOG_KEY) == F.col("__key")) & (F.col("__stored") > F.struct(*order))
        return batch.join(stored, later, "left_anti")

    def tidy(self) -> None:
        """Gather slices that lie in many folders and remove versions nobody reads; once per run is enough."""
        if self.table.exists():
            try:
                self.table.compact()
            except FileExistsError:  # another writer was first; the next run gathers them
                pass
            self.table.expire()

    def report(self, run_id: int | str, producer: str, status: str, update: str = "ok") -> None:
        self.apply(status_event(self.spark, run_id, producer, status, update), "Time")

    def record(self, run_id: int | str, producer: str) -> DataFrame:
        """The record of one step, found by its key; no row if it never reported."""
        return self.table.read_key(f"{int(run_id)}_{producer}")

    def lookup(self, run_id: int | str, producer: str) -> dict | None:
        """Body of one record, or None."""
        found = self.record(run_id, producer).take(1) if self.table.exists() else []
        return found[0]["body"].asDict() if found else None

    def gate(self, run_id: int | str, producer: str) -> bool:
        """Whether the next step may run: its predecessor reported ``success``."""
        body = self.lookup(run_id, producer)
        return body is not None and body["status"] == SUCCESS
