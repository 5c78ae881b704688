"""The jobs between the layers, each reporting its outcome to the run log."""

from __future__ import annotations

import logging
import threading
import uuid
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from datetime import datetime, timezone

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.types import StructType

from tierline import files
from tierline.mapping import KEY, TableMapping
from tierline.operators import quality, runlog
from tierline.operators.clean import clean
from tierline.operators.transform import CustomColumns, transform
from tierline.plans import dairy
from tierline.plans.date_dim import DEFAULT_SPAN, load_date_dim
from tierline.plans.parameters import FULL_LOAD, INCREMENTAL_LOAD, LOAD_TYPES, RunParameters
from tierline.session import scratch_path, sized_shuffles
from tierline.sources import bronze as bronze_layer
from tierline.sources import landing as landing_layer
from tierline.sources.snapshots import ONE_SLICE, SnapshotTable, date_slices, hash_slices

logger = logging.getLogger(__name__)

_INTERRUPT = "spark.job.interruptOnCancel"


def _details(error: Exception) -> str:
    return str(error.args[0]) if error.args else str(error) or "Unknown error"


def _each(spark: SparkSession, work, items, at_once: int) -> list:
    """Apply ``work`` to each item, ``at_once`` of them submitting Spark jobs together."""
    pool = ThreadPoolExecutor(max_workers=at_once)
    try:
        # Wrapped one by one: each item has local properties, and so job tags, of its own.
        return [f.result() for f in [pool.submit(inheritable_thread_target(spark)(work), item) for item in items]]
    finally:
        pool.shutdown(cancel_futures=True)


@contextmanager
def time_limit(spark: SparkSession, seconds: float | None, what: str) -> Iterator[None]:
    """Spark jobs this thread submits within are cancelled after ``seconds``; those of other threads go on.

    They carry a tag of their own. Later jobs are cancelled too until the work
    within has ended, which then fails with :class:`TimeoutError`.
    """
    if seconds is None:
        yield
        return
    tag, over, done = f"tierline-{uuid.uuid4().hex}", threading.Event(), threading.Event()

    def watch() -> None:
        if not done.wait(seconds):
            over.set()
            while not done.is_set():
                spark.sparkContext.cancelJobsWithTag(tag)
                done.wait(1)
    watcher = threading.Thread(target=watch, daemon=True)
    before = spark.sparkContext.getLocalProperty(_INTERRUPT)
    spark.sparkContext.addJobTag(tag)
    spark.sparkContext.setLocalProperty(_INTERRUPT, "true")  # also tasks that wait
    watcher.start()
    try:
        yield
    except Exception as error:
        if over.is_set():
            raise TimeoutError(f"{what} took longer than {seconds:g} s") from error
        raise
    finally:
        done.set()
        watcher.join()
        spark.sparkContext.removeJobTag(tag)
        spark.sparkContext.setLocalProperty(_INTERRUPT, before)
    if over.is_set():
        raise TimeoutError(f"{what} took longer than {seconds:g} s")


def ingest(spark: SparkSession, log: runlog.RunLog, parameters: RunParameters, landing: str,
           dimension_documents: str | list[str], fact_documents: str | list[str],
           dimensions: tuple[str, ...] = dairy.DIMENSION_TABLES,
           facts: tuple[str, ...] = dairy.FACT_TABLES) -> bool:
    """API documents to landing; facts are those of the run's date window."""
    try:
        landing_layer.land_payload(spark, dimension_documents, landing, "dims", dimensions)
        landing_layer.land_payload(spark, fact_documents, landing, "facts", facts,
                                   window=parameters.window)
    except Exception as error:
        log.report(parameters.run_id, runlog.INGEST, runlog.FAILURE, str(error))
        return False
    log.report(parameters.run_id, runlog.INGEST, runlog.SUCCESS)
    return True


def landing_to_bronze(spark: SparkSession, landing: str, bronze: str, run_id: int | str,
                      log: runlog.RunLog | None = None,
                      schemas: dict[str, StructType | str] | None = None,
                      multi_line: bool = False, at_once: int = 4,
                      mapping: dict[str, TableMapping] | None = None) -> bool:
    """Every landed JSON dataset to ``<bronze>/<run_id>/<table>``.

    The first failure ends the job. Tables given in ``schemas`` skip the extra
    pass over the data that type inference takes. A dataset without rows has the
    source columns of its mapping. Lines that are no JSON go to
    ``<bronze>/corrupt/<run_id>/<table>``, not to bronze.
    """
    mapping = dairy.MAPPING if mapping is None else mapping

    def convert(item: tuple[str, str]) -> None:
        table, path = item
        schema = landing_layer.with_corrupt((schemas or {}).get(table))
        df = landing_layer.read_json(spark, path, schema, multi_line)
        if not df.columns and table in mapping:
            df = spark.createDataFrame([], ", ".join(f"`{r.source_column}` string" for r in mapping[table].source_rules))
        if df.columns == [landing_layer.CORRUPT] and table in mapping:  # not one line is JSON
            known = ", ".join(f"`{r.source_column}` string" for r in mapping[table].source_rules)
            df = landing_layer.read_json(spark, path, landing_layer.with_corrupt(known), multi_line)
        seen = Observation()
        if landing_layer.CORRUPT in df.columns:
            df = df.observe(seen, F.count_if(F.col(landing_layer.CORRUPT).isNotNull()).alias("lines"))
        rows, corrupt = landing_layer.split_corrupt(df)
        bronze_layer.write_bronze(rows, bronze, run_id, table)
        if corrupt is not None and seen.get["lines"]:
            logger.warning("%s: lines that are no JSON are in %s/corrupt/%s", table, bronze, run_id)
            bronze_layer.write_rejected(corrupt, f"{bronze}/corrupt/{run_id}", table, run_id)

    try:
        _each(spark, convert, landing_layer.discover(spark, landing).items(), at_once)
    except Exception as error:
        if log is None:
            raise
        log.report(run_id, runlog.TO_BRONZE, runlog.FAILURE, str(error))
        return False
    if log:
        log.report(run_id, runlog.TO_BRONZE, runlog.SUCCESS)
    return True


def silver_rows(df: DataFrame, mapping: TableMapping, run_id: int | str,
                as_of: datetime | str | None = None,
                custom: CustomColumns | None = None, functions: str | None = None) -> DataFrame:
    """Clean and transform one bronze table and evaluate its quality rules."""
    shaped = transform(clean(df, mapping), mapping, run_id, as_of, custom, functions)
    return quality.evaluate(shaped, mapping.dq_rules)


def _log_outcomes(mapping: TableMapping, evaluated: DataFrame) -> None:
    logger.info("%s: %s", mapping.name, quality.ruleset_text(mapping.dq_rules))
    for row in quality.rule_outcomes(evaluated, mapping.dq_rules).collect():
        logger.info("%s: %s %s, %d of %d rows failed", mapping.name, *row)


def load_silver_table(spark: SparkSession, mapping: TableMapping, bronze: str, silver: str,
                      rejected: str, run_id: int | str, load_type: str = INCREMENTAL_LOAD,
                      as_of: datetime | str | None = None, slice_by: str = ONE_SLICE,
                      custom: CustomColumns | None = None, check_quality: bool = True,
                      database: str | None = None, functions: str | None = None) -> SnapshotTable:
    """One table from bronze to silver; failing rows go to ``<rejected>``.

    With quality rules the evaluated rows are written once to the shared
    folder, parted by outcome, and both outputs are read from there. Neither
    the whole-row distinct nor its shuffle runs twice.
    """
    if load_type not in LOAD_TYPES:
        raise ValueError(f"load_type is one of {LOAD_TYPES}")
    source = bronze_layer.read_bronze(spark, bronze, run_id, mapping.name)
    target = SnapshotTable(spark, f"{silver}/{mapping.name}", slice_by=slice_by)

    def load(rows: DataFrame, stored_at: str | None = None) -> None:
        if load_type == FULL_LOAD:
            target.full_load(rows)
        else:
            # A column the mapping gained or lost since the last run needs no full load.
            target.upsert(rows, stored_at, evolve=target.differs(rows), update=mapping.update_columns,
                          insert=mapping.insert_columns, witness=mapping.key_parts)

    if not (check_quality and mapping.dq_rules):
        load(transform(clean(source, mapping), mapping, run_id, as_of, custom, functions))
    else:
        staging = scratch_path(spark, "quality")
        try:
            evaluated = silver_rows(source, mapping, run_id, as_of, custom, functions)
            evaluated.write.partitionBy(quality.RESULT).parquet(staging)
            staged = spark.read.schema(evaluated.schema).parquet(staging)
            _log_outcomes(mapping, staged)
            bronze_layer.write_rejected(quality.failed_rows(staged), rejected,
                                        mapping.name, run_id)
            load(quality.passed_rows(staged), staging)
        finally:
            files.delete(spark, staging)
    target.expire()
    if database:
        target.register(database, mapping.name)
    return target


def default_slices(mapping: dict[str, TableMapping]) -> dict[str, str]:
    """Facts, whose key begins with their date, are stored by week; other tables by their key."""
    def dated(table: TableMapping) -> bool:
        return any(r.target_column == KEY and "unix_timestamp(date" in r.expr for r in table.rules) and any(
            r.target_column == "date" and r.cast_to == "date" for r in table.rules)
    return {n: date_slices(7) if dated(t) else hash_slices(8) for n, t in mapping.items()}


def bronze_to_silver(spark: SparkSession, bronze: str, silver: str, rejected: str,
                     run_id: int | str, load_type: str = INCREMENTAL_LOAD,
                     mapping: dict[str, TableMapping] | None = None,
                     log: runlog.RunLog | None = None, as_of: datetime | str | None = None,
                     slices: dict[str, str] | None = None,
                     custom: dict[str, CustomColumns] | None = None,
                     check_quality: bool = True, database: str | None = None,
                     at_once: int = 4, functions: str | None = None,
                     table_seconds: float | dict[str, float] | None = None) -> tuple[str, str]:
    """All mapped tables; a table that fails does not stop the others.

    Returns the status and the collected messages. ``at_once`` tables are
    submitted together so that small ones do not leave the cluster idle. A table
    that takes longer than ``table_seconds`` (of all, or by name) is cancelled alone
    and counts as failed. ``functions`` is a database of SQL functions for ``CUSTOM`` columns.
    """
    mapping = dairy.MAPPING if mapping is None else mapping
    as_of = as_of or datetime.now(timezone.utc)
    slices = default_slices(mapping) | (slices or {})

    def load(table: str) -> str:
        try:
            seconds = table_seconds.get(table) if isinstance(table_seconds, dict) else table_seconds
            with time_limit(spark, seconds, table):
                load_silver_table(spark, mapping[table], bronze, silver, rejected, run_id, load_type,
                                  as_of, slices.get(table, ONE_SLICE),
                                  (custom or {}).get(table), check_quality, database, functions)
            return ""
        except Exception as error:
            return runlog.TABLE_PROBLEM.format(table, _details(error))

    largest = max((f"{bronze}/{run_id}/{t}" for t in mapping), key=lambda p: files.bytes_below(spark, p))
    with sized_shuffles(spark, largest):
        problems = "".join(_each(spark, load, sorted(mapping), at_once))
    status = runlog.PARTIAL if problems else runlog.SUCCESS
    if log:
        log.report(run_id, runlog.TO_SILVER, status, f" {problems}" if problems else "ok")
    return status, problems


def silver_to_gold(spark: SparkSession, gold: str, run_id: int | str = 0,
                   log: runlog.RunLog | None = None, start: str = DEFAULT_SPAN[0],
                   end: str = DEFAULT_SPAN[1], database: str | None = None) -> bool:
    """Build the calendar dimension."""
    try:
        target = load_date_dim(spark, gold, start, end)
        if database:
            target.register(database, "dim_date")
    except Exception as error:
        if log is None:
            raise
        log.report(run_id, runlog.TO_GOLD, runlog.FAILURE,
                   runlog.DATE_PROBLEM.format(_details(error)))
        return False
    if log:
        log.report(run_id, runlog.TO_GOLD, runlog.SUCCESS)
    return True


def run_steps(spark: SparkSession, base: str, parameters: RunParameters,
              dimension_documents: str | list[str], fact_documents: str | list[str],
              database: str | None = None, mapping: dict[str, TableMapping] | None = None,
              slices: dict[str, str] | None = None, schemas: dict[str, StructType | str] | None = None,
              multi_line: bool = False) -> bool:
    """Ingest, bronze, silver, each only if the step before reported success.

    ``schemas`` and ``multi_line`` are for the landed JSON, ``mapping`` and
    ``slices`` for silver.
    """
    log = runlog.RunLog(spark, f"{base}/run_log")
    run_id = parameters.run_id
    ingest(spark, log, parameters, f"{base}/landing", dimension_documents, fact_documents)
    if not log.gate(run_id, runlog.INGEST):
        return False
    landing_to_bronze(spark, f"{base}/landing", f"{base}/bronze", run_id, log, schemas, multi_line, mapping=mapping)
    if not log.gate(run_id, runlog.TO_BRONZE):
        return False
    bronze_to_silver(spark, f"{base}/bronze", f"{base}/silver", f"{base}/dq_failed", run_id,
                     parameters.load_type, mapping, log, slices=slices, database=database)
    log.tidy()
    return log.gate(run_id, runlog.TO_SILVER)
