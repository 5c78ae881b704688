"""Bronze without a schema: JSON lines are parsed once, into variants, and typed from those.

Landed lines of all tables are one scan. Each line becomes a variant (a line that
holds an array becomes a row per element) and is written once, beside the name
of its table. Types come from an aggregate over the variants, long and fractional
numbers and absent fields merged, and the typed bronze tables are cast from the
written rows: the JSON itself is read a single time, where inference reads it twice.

The same rows can be staged by a stream that takes what has landed since its last
run (:func:`start_landing_stream`). Its checkpoint knows the files that are done;
a batch has a folder by its number, so one that was interrupted and comes again
replaces what it wrote. Batches need not agree on types: :func:`settle` merges them.

Types are those that inference gives: whole numbers are long, others double;
fields that are null everywhere, or of different kinds, are text; empty objects
are left out. JSON is read strictly: a line with single quotes or with a key
that repeats counts as no JSON.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import (ArrayType, DataType, DecimalType, DoubleType, LongType, NullType, StringType, StructField,
                               StructType, VariantType)

from tierline import files
from tierline.sources.bronze import write_bronze, write_rejected
from tierline.sources.landing import CORRUPT, table_name_column

#: Below ``<bronze>/<run_id>``: the variants by batch and table.
ROWS, BATCH, TABLE = "_rows", "batch_no", "table_name"


def parsed(lines: DataFrame) -> DataFrame:
    """``table_name`` and either the ``row`` as a variant or the ``corrupt`` line, of lines (table_name, value)."""
    whole = F.try_parse_json("value")
    elements = F.coalesce(F.try_variant_get(whole, "$", "array<variant>"), F.array(whole))
    rows = lines.filter("trim(value) <> ''").select(TABLE, "value", F.explode(elements).alias("row"))
    is_object = F.try_variant_get("row", "$", "map<string,variant>").isNotNull()
    return rows.select(TABLE, F.when(is_object, F.col("row")).alias("row"),
                       F.when(~is_object, F.col("value")).alias("corrupt"))


def _batch_path(bronze: str, run_id: int | str, batch: int) -> str:
    return f"{bronze}/{run_id}/{ROWS}/{BATCH}={batch}"


def stage(lines: DataFrame, bronze: str, run_id: int | str, batch: int = 0) -> None:
    """Write one batch of lines as variants; a batch that comes again replaces itself."""
    parsed(lines).write.mode("overwrite").partitionBy(TABLE).parquet(_batch_path(bronze, run_id, batch))


def scan_lines(spark: SparkSession, landing: str, whole_files: bool = False) -> DataFrame:
    """Lines of all landed ``.json`` files with their table's name, in one scan."""
    reader = spark.read.option("pathGlobFilter", "*.json").option("recursiveFileLookup", True)
    return reader.text(landing, wholetext=whole_files).select(table_name_column().alias(TABLE), "value")


def start_landing_stream(spark: SparkSession, landing: str, bronze: str, run_id: int | str, checkpoint: str,
                         max_files: int | None = None, once: bool = True) -> StreamingQuery:
    """Stage the files that landed since the last run; with ``once`` it ends when all that is there is done."""
    reader = spark.readStream.option("pathGlobFilter", "*.json").option("recursiveFileLookup", True)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    lines = reader.text(landing).select(table_name_column().alias(TABLE), "value")
    writer = (lines.writeStream.foreachBatch(lambda batch, number: stage(batch, bronze, run_id, number))
              .option("checkpointLocation", checkpoint))
    return (writer.trigger(availableNow=True) if once else writer).start()


_WORDS = re.compile(r"`(?:[^`]|``)*`|\bOBJECT<")


def inferred_type(variant_schema: str) -> StructType:
    """The types of a variant's schema as inference from JSON would give them."""
    text = _WORDS.sub(lambda m: "STRUCT<" if m[0] == "OBJECT<" else m[0], variant_schema)
    found = _usual(DataType.fromDDL(text))
    return found if isinstance(found, StructType) else StructType([])


def _usual(kind: DataType) -> DataType | None:
    if isinstance(kind, StructType):
        fields = [StructField(f.name, t) for f in kind for t in [_usual(f.dataType)] if t is not None]
        return StructType(fields) if fields else None
    if isinstance(kind, ArrayType):
        inner = _usual(kind.elementType)
        return ArrayType(inner if inner is not None else StringType())
    if isinstance(kind, DecimalType):
        return DoubleType() if kind.scale else LongType() if kind.precision <= 18 else kind
    return StringType() if isinstance(kind, (NullType, VariantType)) else kind


def _ddl(kind: DataType) -> str:
    if isinstance(kind, StructType):
        return "struct<" + ", ".join(f"`{f.name.replace('`', '``')}`: {_ddl(f.dataType)}" for f in kind) + ">"
    return f"array<{_ddl(kind.elementType)}>" if isinstance(kind, ArrayType) else kind.simpleString()


def typed(row: str, kind: StructType) -> Column:
    """A variant as a struct of these types."""
    return F.try_variant_get(row, "$", _ddl(kind))


def settle(spark: SparkSession, bronze: str, run_id: int | str) -> dict[str, StructType]:
    """Typed bronze tables of all batches staged for a run; the types of each.

    Lines that are no JSON go to ``<bronze>/corrupt/<run_id>/<table>``. May be
    called again when more batches were staged.
    """
    staged = f"{bronze}/{run_id}/{ROWS}"
    if not files.exists(spark, staged):
        return {}
    rows = spark.read.schema(f"row variant, corrupt string, {BATCH} long, {TABLE} string").parquet(staged)
    found = (rows.groupBy(TABLE).agg(F.schema_of_variant_agg("row").alias("kind"), F.count("corrupt").alias("corrupt"))
             .collect())  # one row per table
    kinds = {}
    for table in found:
        name = table[TABLE]
        own = rows.filter(F.col(TABLE) == name)
        kinds[name] = inferred_type(table["kind"] or "VOID")
        fields = [F.col("r").getField(f.name).alias(f.name) for f in kinds[name]]
        if fields:
            write_bronze(own.filter("corrupt IS NULL").select(typed("row", kinds[name]).alias("r")).select(*fields),
                         bronze, run_id, name)
        if table["corrupt"]:
            write_rejected(own.filter("corrupt IS NOT NULL").select(F.col("corrupt").alias(CORRUPT)),
                           f"{bronze}/corrupt/{run_id}", name, run_id)
    return kinds


def landing_to_typed(spark: SparkSession, landing: str, bronze: str, run_id: int | str,
                     whole_files: bool = False) -> dict[str, StructType]:
    """Every landed table to typed bronze, the landed JSON read once."""
    stage(scan_lines(spark, landing, whole_files), bronze, run_id)
    return settle(spark, bronze, run_id)
