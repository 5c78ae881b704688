import json
import os
import random
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from tierline.operators import runlog
from tierline.streaming.run_events import start_run_log, start_run_state, state_log


def envelope(run_id, producer, status, time, source=runlog.EVENT_SOURCE, kind=runlog.EVENT_TYPE):
    detail = json.dumps({"run_id": run_id, "producer": producer, "status": status, "message": "m"})
    return (source, kind, detail, time)


def frame(spark, events):
    df = spark.createDataFrame(events, "Source string, DetailType string, Detail string, Time string")
    return df.withColumn("Time", F.to_timestamp("Time"))


EVENTS = [
    envelope("7", runlog.TO_BRONZE, "failed", "2024-01-01 10:00:00"),
    envelope(7, runlog.TO_BRONZE, "success", "2024-01-01 11:00:00"),
    envelope("007", runlog.TO_SILVER, "partial", "2024-01-01 12:00:00"),
    envelope(8, runlog.INGEST, "success", "2024-01-01 12:00:00", source="other"),
    envelope(8, runlog.INGEST, "success", "2024-01-01 12:00:00", kind="other"),
    envelope("x", runlog.INGEST, "success", "2024-01-01 12:00:00"),
]
EXPECTED = [("7_bronze-2-silver", "007", "partial"), ("7_landing-2-bronze", "7", "success")]


def test_latest_per_key(spark, rows):
    records = runlog.log_records(runlog.own_events(frame(spark, EVENTS)), "Time")
    latest = runlog.latest_records(records, "Time")
    assert rows(latest.select("task_run_id", "body.run_id", "body.status")) == EXPECTED


def test_stored_log_and_gates(spark, tmp_path, rows):
    log = runlog.RunLog(spark, f"{tmp_path}/log")
    assert log.lookup(7, runlog.TO_BRONZE) is None and log.gate(7, runlog.TO_BRONZE) is False
    log.apply(frame(spark, EVENTS[:1]), "Time")
    assert log.gate(7, runlog.TO_BRONZE) is False
    for _ in range(2):
        log.apply(frame(spark, EVENTS), "Time")
        assert rows(log.table.read().select("task_run_id", "body.run_id", "body.status")) == EXPECTED
    assert log.gate(7, runlog.TO_BRONZE) is True
    assert log.gate("007", runlog.TO_BRONZE) is True
    assert log.gate(7, runlog.TO_SILVER) is False


def test_the_latest_event_wins_in_whatever_batches(spark, tmp_path):
    for name, batches in (("one", [EVENTS[:2]]), ("late", [EVENTS[1:2], EVENTS[:1]]), ("two", [EVENTS[:1], EVENTS[1:2]])):
        log = runlog.RunLog(spark, f"{tmp_path}/{name}")
        for batch in batches:
            log.apply(frame(spark, batch), "Time")
        assert log.lookup(7, runlog.TO_BRONZE)["status"] == "success"


def test_without_times_the_last_applied_stays(spark, tmp_path):
    log = runlog.RunLog(spark, f"{tmp_path}/log")
    log.apply(frame(spark, EVENTS[1:2]))
    log.apply(frame(spark, EVENTS[:1]))
    assert log.lookup(7, runlog.TO_BRONZE)["status"] == "failed"


def test_two_writers_lose_no_event(spark, tmp_path):
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(lambda run: runlog.RunLog(spark, f"{tmp_path}/log").report(run, runlog.INGEST, runlog.SUCCESS), range(8)))
    assert runlog.RunLog(spark, f"{tmp_path}/log").table.read().count() == 8


def test_a_newer_event_published_between_reading_and_writing_stays(spark, tmp_path, monkeypatch):
    """A's older failure is chosen by a version that B's newer success replaces before A writes."""
    log, other = (runlog.RunLog(spark, f"{tmp_path}/log") for _ in range(2))
    log.apply(frame(spark, [envelope(7, runlog.TO_BRONZE, "partial", "2024-01-01 10:00:00")]), "Time")
    newer, calls = log._newer, []

    def interleaved(*args):
        found = newer(*args)
        if not calls:
            other.apply(frame(spark, [envelope(7, runlog.TO_BRONZE, "success", "2024-01-01 12:00:00")]), "Time")
        calls.append(args)
        return found
    monkeypatch.setattr(log, "_newer", interleaved)
    log.apply(frame(spark, [envelope(7, runlog.TO_BRONZE, "failed", "2024-01-01 11:00:00")]), "Time")
    assert log.lookup(7, runlog.TO_BRONZE)["status"] == "success" and len(calls) == 2


def test_a_first_event_published_between_reading_and_writing_stays(spark, tmp_path, monkeypatch):
    log, other = (runlog.RunLog(spark, f"{tmp_path}/log") for _ in range(2))
    latest, calls = log.table.latest, []

    def interleaved():
        found = latest()
        if not calls:
            other.report(1, runlog.INGEST, runlog.SUCCESS)
        calls.append(found)
        return found
    monkeypatch.setattr(log.table, "latest", interleaved)
    log.report(2, runlog.INGEST, runlog.SUCCESS)
    assert log.gate(1, runlog.INGEST) and log.gate(2, runlog.INGEST)


def test_reports_read_few_files_however_many_came_before(spark, tmp_path, monkeypatch):
    log, opened = runlog.RunLog(spark, f"{tmp_path}/log"), []
    read = runlog.files.read_text
    monkeypatch.setattr("tierline.files.read_text", lambda *a: opened.append(a[1]) or read(*a))
    counts = []
    for run in range(6):
        opened.clear()
        log.report(run, runlog.INGEST, runlog.SUCCESS)
        counts.append(len(opened))
    assert counts == [0, 1, 1, 1, 1, 1]
    log.tidy()
    assert log.table.read().count() == 6


def test_only_the_slices_of_a_batch_are_read(spark, tmp_path):
    log = runlog.RunLog(spark, f"{tmp_path}/log")
    log.apply(frame(spark, [envelope(i, runlog.INGEST, "success", "2024-01-01 10:00:00") for i in range(50)]), "Time")
    one = spark.createDataFrame([(f"7_{runlog.INGEST}",)], f"{runlog.LOG_KEY} string")
    read = log.table.read_slices_of(one, log.table.latest())
    assert len({f.rsplit("/", 2)[-2] for f in read.inputFiles()}) == 1 and 0 < read.count() < 50


def test_a_record_is_read_from_its_slice(spark, tmp_path):
    log = runlog.RunLog(spark, f"{tmp_path}/log")
    log.apply(frame(spark, [envelope(i, runlog.INGEST, "success", "2024-01-01 10:00:00") for i in range(50)]), "Time")
    assert len({f.rsplit("/", 2)[-2] for f in log.record(7, runlog.INGEST).inputFiles()}) == 1
    assert log.gate(7, runlog.INGEST)


def test_report(spark, tmp_path):
    log = runlog.RunLog(spark, f"{tmp_path}/log")
    log.report(5, runlog.TO_GOLD, runlog.SUCCESS)
    log.report(5, runlog.INGEST, runlog.FAILURE, "no host")
    assert log.lookup(5, runlog.TO_GOLD) == {
        "run_id": "5", "producer": "silver-2-gold", "status": "success",
        "message": "Processing dim date was successfull:ok"}
    assert log.lookup(5, runlog.INGEST)["message"].endswith("Error:no host")


@pytest.mark.parametrize("status, is_open", [("success", True), ("partial", False), ("failed", False), (None, False)])
def test_gate_state(spark, status, is_open):
    log = runlog.log_records(frame(spark, [envelope(1, runlog.INGEST, status, "2024-01-01 00:00:00")]))
    assert runlog.gate_state(log).first()["is_open"] is is_open


def test_run_summary(spark, rows):
    events = [envelope(1, runlog.INGEST, "success", None), envelope(1, runlog.TO_BRONZE, "failed", None),
              envelope(2, runlog.INGEST, "success", None), envelope(3, runlog.INGEST, None, None)]
    log = runlog.log_records(frame(spark, events))
    assert rows(runlog.run_summary(log)) == [
        ("1", 2, 1, "partial"), ("2", 1, 0, "success"), ("3", 1, 0, "partial")]


def test_stream(spark, tmp_path, rows):
    """Two rounds of the stream; the second only sees the new file."""
    folder = tmp_path / "events"
    folder.mkdir()

    def drop(name, events):
        folder.joinpath(name).write_text("\n".join(json.dumps(
            {"Source": s, "DetailType": k, "Detail": d, "Time": t.replace(" ", "T") + "Z"}) for s, k, d, t in events))

    def run():
        stream = start_run_log(spark, str(folder), f"{tmp_path}/log", f"{tmp_path}/checkpoint")
        stream.awaitTermination()
        return rows(runlog.RunLog(spark, f"{tmp_path}/log").table.read()
                    .select("task_run_id", "body.run_id", "body.status"))

    drop("1.json", EVENTS)
    assert run() == EXPECTED
    drop("2.json", [envelope(7, runlog.TO_SILVER, "success", "2024-01-02 00:00:00")])
    assert run() == [("7_bronze-2-silver", "7", "success"), EXPECTED[1]]


def test_stream_applies_files_in_the_order_they_arrive(spark, tmp_path, rows):
    """One file per batch; the last to arrive wins whatever its place by name."""
    folder = tmp_path / "events"
    folder.mkdir()
    for age, (name, status) in enumerate((("z.json", "failed"), ("m.json", "partial"), ("a.json", "success"))):
        source, kind, detail, _ = envelope(3, runlog.INGEST, status, "")
        path = folder / name
        path.write_text(json.dumps({"Source": source, "DetailType": kind, "Detail": detail}))
        os.utime(path, (1_700_000_000 + age, 1_700_000_000 + age))
    stream = start_run_log(spark, str(folder), f"{tmp_path}/log", f"{tmp_path}/checkpoint", max_files=1)
    stream.awaitTermination()
    log = runlog.RunLog(spark, f"{tmp_path}/log")
    assert log.table.versions() == [1, 2, 3]
    assert log.lookup(3, runlog.INGEST)["status"] == "success"


def event_files(folder, batches):
    """A file per batch, the files in this order."""
    os.makedirs(folder, exist_ok=True)
    for number, events in enumerate(batches, len(os.listdir(folder))):
        path = f"{folder}/{number:03d}.json"
        with open(path, "w") as out:
            for source, kind, detail, time in events:
                out.write(json.dumps({"Source": source, "DetailType": kind, "Detail": detail, "Time": time.replace(" ", "T") + "Z"}) + "\n")
        os.utime(path, (1_700_000_000 + number,) * 2)


def by_hand(events):
    last = {}
    for source, kind, detail, time in events:
        body = json.loads(detail)
        if (source, kind) == (runlog.EVENT_SOURCE, runlog.EVENT_TYPE) and str(body["run_id"]).isdigit():
            key = f"{int(body['run_id'])}_{body['producer']}"
            last[key] = max(last.get(key, ("", "")), (time, body["status"]))
    return sorted((k, status) for k, (_, status) in last.items())


@pytest.mark.parametrize("size", [1, 7, 100])
def test_state_is_that_of_all_events_in_any_batches(spark, tmp_path, size):
    chance = random.Random(size)
    events = EVENTS[2:] + [envelope(run, producer, f"s{i}", f"2024-01-{day:02d} 10:00:{i % 60:02d}")
                           for i, (run, producer, day) in enumerate(
                               (chance.randrange(4), chance.choice([runlog.INGEST, runlog.TO_GOLD]), chance.randint(1, 28))
                               for _ in range(24))]
    chance.shuffle(events)  # most are late
    event_files(f"{tmp_path}/events", [events[i:i + size] for i in range(0, 24, size)])
    run = lambda: start_run_state(spark, f"{tmp_path}/events", f"{tmp_path}/log", f"{tmp_path}/checkpoint",
                                  max_files=3, partitions=2).awaitTermination()
    before = spark.conf.get("spark.sql.shuffle.partitions")
    run()
    # Stopped and started again with more events, the state goes on where it was.
    event_files(f"{tmp_path}/events", [events[24:]])
    run()
    run()
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
    expected = by_hand(events)
    for log in (runlog.RunLog(spark, f"{tmp_path}/log").table.read(), state_log(spark, f"{tmp_path}/checkpoint")):
        assert sorted((r.task_run_id, r.body.status) for r in log.collect()) == expected


def test_a_batch_of_the_state_touches_its_keys_only(spark, tmp_path):
    """The second batch holds one event: one slice of the log gets a new folder."""
    events = [envelope(i, runlog.INGEST, "success", "2024-01-01 10:00:00") for i in range(60)]
    late = envelope(7, runlog.INGEST, "failed", "2023-12-31 10:00:00")
    event_files(f"{tmp_path}/events", [events])
    log = runlog.RunLog(spark, f"{tmp_path}/log")
    for batches in ([], [[late]], [[envelope(7, runlog.INGEST, "failed", "2024-01-02 10:00:00")]]):
        event_files(f"{tmp_path}/events", batches)
        start_run_state(spark, f"{tmp_path}/events", f"{tmp_path}/log", f"{tmp_path}/checkpoint", partitions=2).awaitTermination()
        if batches:
            first, last = log.table.manifest(1)["slices"], log.table.manifest()["slices"]
            assert sum(first[s] != last[s] for s in first) <= 1
            assert log.lookup(7, runlog.INGEST)["status"] == ("success" if batches == [[late]] else "failed")
