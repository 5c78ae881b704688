"""Queries for status events, the run log and its gates, over the event table."""

from __future__ import annotations

from pyspark.sql import functions as F

from tierline.operators import runlog
from tierline.queries.registry import given, query
from tierline.session import scratch_path
from tierline.streaming.run_events import start_run_log, start_run_state, state_log

# A user stands for a run, the event type for the reporting job, a low value for trouble.
_STATUS = "CASE WHEN value < 2 THEN 'failed' WHEN value < 5 THEN 'partial' ELSE 'success' END"
_PRODUCER = ("CASE event_type WHEN 'click' THEN 'ingest-lambda' WHEN 'purchase' THEN 'landing-2-bronze'"
             " WHEN 'signup' THEN 'bronze-2-silver' ELSE 'silver-2-gold' END")
_ORDER = ("Time", "event_id")


def _events(spark, sf_dir):
    """Status events; views come from elsewhere and are not ours."""
    events = runlog.status_events(
        given(spark, sf_dir, "events"), F.col("user_id").cast("string"), F.expr(_PRODUCER),
        F.expr(_STATUS), F.col("props"), F.col("ts").cast("timestamp").alias("Time"), "event_id", "event_type")
    return events.withColumn("Source", F.when(F.col("event_type") == "view", "elsewhere")
                             .otherwise(F.col("Source")))


def _log(spark, sf_dir):
    events = runlog.own_events(_events(spark, sf_dir))
    return runlog.latest_records(runlog.log_records(events, *_ORDER), *_ORDER)


_LOG_SQL = f"""
    SELECT user_id || '_' || producer AS task_run_id, CAST(user_id AS VARCHAR) AS run_id, producer,
           status, props AS message
    FROM (SELECT user_id, {_PRODUCER} AS producer, {_STATUS} AS status, props,
                 row_number() OVER (PARTITION BY user_id, {_PRODUCER} ORDER BY ts DESC, event_id DESC) AS place
          FROM events WHERE event_type <> 'view') WHERE place = 1"""


def _flat(log):
    return log.select("task_run_id", "body.run_id", "body.producer", "body.status", "body.message")


@query("event_filter", f"""
    SELECT event_id, 'pf-resources' AS "Source", 'pf-resource-event' AS "DetailType",
           {_STATUS} AS status FROM events WHERE event_type <> 'view'""")
def event_filter(spark, sf_dir):
    return runlog.own_events(_events(spark, sf_dir)).select(
        "event_id", "Source", "DetailType", F.get_json_object("Detail", "$.status").alias("status"))


@query("run_log_latest", _LOG_SQL)
def run_log_latest(spark, sf_dir):
    return _flat(_log(spark, sf_dir))


@query("run_log_stored", _LOG_SQL)
def run_log_stored(spark, sf_dir):
    """Two batches upserted into the stored log, the later one second."""
    log = runlog.RunLog(spark, scratch_path(spark, "run-log"))
    events = _events(spark, sf_dir)
    halfway = F.lit("2024-01-15").cast("timestamp")
    log.apply(events.filter(F.col("Time") < halfway), *_ORDER)
    log.apply(events.filter(F.col("Time") >= halfway), *_ORDER)
    return _flat(log.table.read())


@query("run_log_lookup", f"SELECT * FROM ({_LOG_SQL}) WHERE task_run_id = '8_silver-2-gold'")
def run_log_lookup(spark, sf_dir):
    """One record of the stored log by its key."""
    log = runlog.RunLog(spark, scratch_path(spark, "run-log"))
    log.apply(_events(spark, sf_dir), *_ORDER)
    return _flat(log.record("008", runlog.TO_GOLD))


@query("run_log_stream", _LOG_SQL)
def run_log_stream(spark, sf_dir):
    """The log kept by a stream over event files."""
    base = scratch_path(spark, "stream")
    (_events(spark, sf_dir).select("Source", "DetailType", "Detail", "Time").write
     .option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").json(f"{base}/events"))
    stream = start_run_log(spark, f"{base}/events", f"{base}/log", f"{base}/checkpoint")
    stream.awaitTermination()
    return _flat(runlog.RunLog(spark, f"{base}/log").table.read())


@query("run_log_state_stream", f"""
    SELECT *, true AS in_table FROM ({_LOG_SQL})""")
def run_log_state_stream(spark, sf_dir):
    """The log as keyed state of a stream whose files come in an order of their own, beside the table it feeds.

    Files hold the events of a user, so most of them come later than events of a later time.
    """
    base = scratch_path(spark, "state")
    (_events(spark, sf_dir).select("Source", "DetailType", "Detail", "Time")
     .repartition(6, F.get_json_object("Detail", "$.run_id")).write
     .option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").json(f"{base}/events"))
    start_run_state(spark, f"{base}/events", f"{base}/log", f"{base}/checkpoint", max_files=2).awaitTermination()
    table = _flat(runlog.RunLog(spark, f"{base}/log").table.read())
    state = _flat(state_log(spark, f"{base}/checkpoint"))
    return state.join(table.withColumn("in_table", F.lit(True)), state.columns, "left")


@query("status_gate", f"""
    WITH log AS ({_LOG_SQL}),
    steps AS (SELECT DISTINCT user_id || '_' || producer AS task_run_id FROM events,
              (VALUES ('ingest-lambda'), ('landing-2-bronze'), ('bronze-2-silver'), ('silver-2-gold')) p(producer))
    SELECT task_run_id, coalesce(status = 'success', false) AS is_open
    FROM steps LEFT JOIN log USING (task_run_id)""")
def status_gate(spark, sf_dir):
    """The gate after every step of every run; a step that never reported is shut."""
    producers = F.array(*map(F.lit, (runlog.INGEST, runlog.TO_BRONZE, runlog.TO_SILVER, runlog.TO_GOLD)))
    steps = (given(spark, sf_dir, "events").select("user_id").distinct()
             .select(F.col("user_id").cast("string").alias("run_id"), F.explode(producers).alias("producer"))
             .select(runlog.task_run_id(F.col("run_id"), F.col("producer")).alias("task_run_id")))
    gates = runlog.gate_state(_log(spark, sf_dir)).select("task_run_id", "is_open")
    return steps.join(gates, "task_run_id", "left").na.fill({"is_open": False})


@query("run_status", f"""
    SELECT run_id, count(*) AS steps, count(*) FILTER (status <> 'success') AS failed_steps,
           CASE WHEN bool_or(status <> 'success') THEN 'partial' ELSE 'success' END AS status
    FROM ({_LOG_SQL}) GROUP BY run_id""")
def run_status(spark, sf_dir):
    return runlog.run_summary(_log(spark, sf_dir))
