"""Landing layer: JSON datasets, one per table, below ``dims/`` and ``facts/``."""

from __future__ import annotations

import logging
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from tierline import files
from tierline.operators.clean import column_types, quoted
from tierline.session import scratch_path
from tierline.sources.payload_ranges import cut_documents

logger = logging.getLogger(__name__)


def table_name(path: str) -> str:
    """Last part of the path, up to its first dot."""
    return path.rstrip("/").rsplit("/", 1)[-1].split(".", 1)[0]


def table_name_column() -> Column:
    """The same for the rows of a multi-file scan, from the scan's file path.

    Covers both a ``<table>.json`` file and a file in a ``<table>.json/`` folder.
    """
    tail = F.substring_index(F.col("_metadata.file_path"), "/", -2)
    folder, own = F.substring_index(tail, "/", 1), F.substring_index(tail, "/", -1)
    return F.substring_index(F.when(folder.endswith(".json"), folder).otherwise(own), ".", 1)


def discover(spark: SparkSession, landing: str) -> dict[str, str]:
    """Map table name to its ``.json`` dataset below ``landing``.

    A dataset is a file, or a folder of part files for tables too large for
    one file. Names only are listed here. Should two datasets share a table
    name, the last in path order is used, and a warning says so.
    """
    found: dict[str, str] = {}
    pending = [landing]
    keys = []
    while pending:
        for path, is_folder in files.children(spark, pending.pop()):
            if path.endswith(".json"):
                keys.append(path)
            elif is_folder:
                pending.append(path)
    for path in sorted(keys):
        name = table_name(path)
        if not name:
            raise ValueError(f"No table name in {path}")
        if name in found:
            logger.warning("%s replaces %s for table %s", path, found[name], name)
        found[name] = path
    return found


#: Holds the text of a line that is no JSON; all other columns of such a row are null.
CORRUPT = "_corrupt_record"


def split_corrupt(df: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """Good rows, and the lines that could not be parsed if the scan keeps them."""
    if CORRUPT not in df.columns:
        return df, None
    return df.filter(F.col(CORRUPT).isNull()).drop(CORRUPT), df.filter(F.col(CORRUPT).isNotNull())


def with_corrupt(schema: StructType | str | None) -> StructType | None:
    """A schema that also keeps the lines which cannot be parsed."""
    if schema is None:
        return None
    schema = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
    return schema if CORRUPT in schema.names else StructType([*schema.fields, StructField(CORRUPT, StringType())])


def read_json(spark: SparkSession, path: str | list[str], schema: StructType | str | None = None,
              multi_line: bool = False) -> DataFrame:
    """Scan JSON lines (or one array per line); types are inferred without a schema.

    Inference reads the data once more, so pass ``schema`` for large tables.
    """
    reader = spark.read.option("multiLine", multi_line)
    return (reader.schema(schema) if schema else reader).json(path)


def scan_landing(spark: SparkSession, landing: str, schema: StructType | str | None = None) -> DataFrame:
    """All ``.json`` files below ``landing`` in one scan, with their ``table_name``."""
    reader = (spark.read.option("pathGlobFilter", "*.json").option("recursiveFileLookup", True))
    df = (reader.schema(schema) if schema else reader).json(landing)
    return df.select("*", table_name_column().alias("table_name"))


def write_json(df: DataFrame, path: str) -> None:
    """Write rows as JSON lines; nulls are kept so that no column disappears."""
    df.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def read_payload(spark: SparkSession, documents: str | list[str],
                 schema: StructType | str | None = None, multi_line: bool = True) -> DataFrame:
    """API documents ``{"data": {"<table>": [...]}}``: a row each, a column per table."""
    return read_json(spark, documents, schema, multi_line).select("data.*")


def payload_table(payload: DataFrame, name: str) -> DataFrame:
    """Rows of one table of the documents.

    Tables delivered as ready-made JSON text come as one text row per document.
    """
    if name not in payload.columns:
        raise KeyError(f"The documents hold no table {name!r}")
    dtype, value = payload.schema[name].dataType, quoted(name)
    if isinstance(dtype, StringType):
        return payload.select(value.alias("value")).filter(F.col("value").isNotNull())
    if not isinstance(dtype, ArrayType):
        raise TypeError(f"Table {name!r} is neither a list of rows nor JSON text")
    if isinstance(dtype.elementType, StructType):
        return payload.select(F.inline(value))
    return payload.select(F.explode(value).alias("value"))


def land_payload(spark: SparkSession, documents: str | list[str], landing: str,
                 folder: str, tables: tuple[str, ...], multi_line: bool = True,
                 window: tuple[str, str] | None = None,
                 schema: StructType | str | None = None, by_ranges: bool = False) -> None:
    """Write each table of the documents to ``<landing>/<folder>/<table>.json``.

    With a ``window`` (first and last day) rows outside it are not landed. All rows
    need a ``date`` then, also those of a list delivered as JSON text, which is
    landed as a line per row; without a window such text is landed as it comes.
    The documents are parsed once into a columnar copy, of which each table
    then reads its own column. ``schema`` saves the pass that infers types.

    ``by_ranges`` is for documents too large for one task: many tasks cut the rows
    out of each (:mod:`tierline.sources.payload_ranges`), no types are inferred, and
    every table has to be a list of rows, landed as the text they come in.
    """
    copy = scratch_path(spark, "payload")
    try:
        if by_ranges:
            cut_documents(spark, documents, tables, f"{copy}/cut").write.parquet(f"{copy}/rows")
            files.delete(spark, f"{copy}/cut")
            cut = spark.read.parquet(f"{copy}/rows")
            for name in tables:
                _land_lines(cut.filter(F.col("name") == name).select("value"), f"{landing}/{folder}/{name}.json", name, window)
            return
        read_payload(spark, documents, schema, multi_line).write.parquet(copy)
        payload = spark.read.parquet(copy)
        for name in tables:
            rows, path = payload_table(payload, name), f"{landing}/{folder}/{name}.json"
            if isinstance(payload.schema[name].dataType, StringType):
                _land_lines(_text_rows(rows) if window else rows, path, name, window)
                continue
            if window:
                if "date" not in rows.columns and payload_has_rows(rows):
                    raise ValueError(f"Table {name!r} has no date, but a window of dates is asked for")
                if "date" in rows.columns:
                    rows = fact_window(rows, window[1], window[0], backfill="1")
            write_json(rows, path)
    finally:
        files.delete(spark, copy)


def payload_has_rows(rows: DataFrame) -> bool:
    return not rows.isEmpty()


def _land_lines(lines: DataFrame, path: str, name: str, window: tuple[str, str] | None) -> None:
    """Write lines of JSON text, of a window only those with a date in it; one pass finds lines without a date."""
    seen = Observation()
    if window:
        dated = lines.select("value", F.get_json_object("value", "$.date").alias("date")).observe(
            seen, F.count_if(F.col("date").isNull()).alias("undated"))
        lines = fact_window(dated, window[1], window[0], backfill="1").select("value")
    lines.write.mode("overwrite").text(path)
    if window and seen.get["undated"]:
        files.delete(lines.sparkSession, path)
        raise ValueError(f"Table {name!r} has rows without a date, but a window of dates is asked for")


def _text_rows(texts: DataFrame) -> DataFrame:
    """JSON text of a list of rows: a line per row."""
    lists = F.coalesce(F.from_json("value", "array<string>"), F.array("value"))
    return texts.select(F.explode(lists).alias("value"))


def fact_window(df: DataFrame, input_date: str, start_date: str | None = None,
                backfill: str = "0", column: str = "date") -> DataFrame:
    """Rows from ``start_date`` to ``input_date``, both included.

    Without backfill only ``input_date`` itself. Text may go on with a time
    after the day. The column is compared as it is, so that the filter
    reaches the file scan.
    """
    if backfill == "0":
        start_date = input_date
    if not start_date:
        raise ValueError("A backfill needs a start date.")
    value = quoted(column)
    dtype = column_types(df, [value])[0].typeName()
    after = str(date.fromisoformat(input_date) + timedelta(days=1))
    if dtype == "date" or dtype.startswith("timestamp"):
        start, end = (F.lit(text).cast(dtype) for text in (start_date, after))
    else:
        start, end = F.lit(start_date), F.lit(after)
    return df.filter((value >= start) & (value < end))
