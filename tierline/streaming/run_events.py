"""Feed the run log from a folder of event files as a stream, with or without keyed state."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from tierline.operators.runlog import EVENT_SCHEMA, LOG_KEY, RunLog, latest_records, log_records, own_events

ARRIVAL = "arrived_at"
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_LEAST_SLICES = "spark.sql.shuffle.partitions"


def read_events(spark: SparkSession, folder: str, max_files: int | None = None) -> DataFrame:
    """Event envelopes from JSON-lines files, with the time they arrived.

    That is ``Time`` where the bus has set it, else the file's own time.
    """
    reader = spark.readStream.schema(EVENT_SCHEMA)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    events = reader.json(folder)
    arrived = F.coalesce(F.col("Time"), F.col("_metadata.file_modification_time"))
    return own_events(events.withColumn(ARRIVAL, arrived))


def start_run_log(spark: SparkSession, folder: str, log_root: str, checkpoint: str,
                  max_files: int | None = None, once: bool = True) -> StreamingQuery:
    """Keep the run log up to date with ``folder``.

    Batches are applied in order and each is reduced to its last record per
    key, so a batch that is delivered again after a failure does no harm.
    """
    log = RunLog(spark, log_root)
    writer = (read_events(spark, folder, max_files).writeStream
              .foreachBatch(lambda batch, _: log.apply(batch, ARRIVAL))
              .option("checkpointLocation", checkpoint))
    return (writer.trigger(availableNow=True) if once else writer).start()


@contextmanager
def _settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """A stream takes its session's settings when it starts; the session gets its own back."""
    before = {name: spark.conf.get(name, None) for name in values}
    for name, value in values.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def latest_events(events: DataFrame) -> DataFrame:
    """The last record of each key, kept up to date: one row of state per key."""
    return latest_records(log_records(own_events(events), ARRIVAL), ARRIVAL)


def start_run_state(spark: SparkSession, folder: str, log_root: str, checkpoint: str,
                    max_files: int | None = None, once: bool = True, partitions: int = 8) -> StreamingQuery:
    """The run log as keyed state of a stream over ``folder``, and as a table for the gates.

    The state holds the latest record of each key by time, so events may come in
    any order, however late, and in whatever batches: the state after a batch is
    that of all events so far. No event is too late, since the state is no larger
    than the log itself, a row per step of a run; it lies in RocksDB below the
    checkpoint, not in the executors' heaps. Each batch sends on the keys it
    touched only, which are upserted into the slices of the log they belong to;
    a batch that is delivered again changes nothing. ``partitions`` is the number
    of state partitions, fixed by the first start.
    """
    log = RunLog(spark, log_root)
    latest = latest_events(read_events(spark, folder, max_files))
    with _settings(spark, {_PROVIDER: _ROCKSDB, _LEAST_SLICES: str(partitions)}):
        writer = (latest.writeStream.outputMode("update")
                  .foreachBatch(lambda rows, _: log.put(rows, ARRIVAL))
                  .option("checkpointLocation", checkpoint))
        return (writer.trigger(availableNow=True) if once else writer).start()


def state_log(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The log as the stream's state holds it after its last finished batch: ``task_run_id``, ``body``, time."""
    with _settings(spark, {_PROVIDER: _ROCKSDB}):
        state = spark.read.format("statestore").load(checkpoint)
    last = F.col("value").getField(state.schema["value"].dataType.names[0])
    return state.select(F.col(f"key.{LOG_KEY}").alias(LOG_KEY), last.getField("body").alias("body"),
                        last.getField(ARRIVAL).alias(ARRIVAL))
