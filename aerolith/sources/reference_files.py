"""Headerless latin-1 reference files (airports, airlines, routes, planes)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from aerolith.schemas import REFERENCE_FILES

# Fixed value: how the files write a missing field.
NULL_MARK = r"\N"


def is_missing(text: Column) -> Column:
    return text.isNull() | text.isin(NULL_MARK, "")


def read_reference(spark: SparkSession, table: str, path: str) -> DataFrame:
    """One reference file as a typed table.

    Rows with too few fields are dropped, extra fields are ignored, missing marks
    and unreadable numbers become NULL. All columns are read as text first and
    pruning is off, since a pruned reader would not notice a short row.
    """
    schema = REFERENCE_FILES[table]
    bad = "_short"
    raw_schema = StructType(
        [StructField(f.name, StringType()) for f in schema.fields] + [StructField(bad, StringType())]
    )
    raw = (
        spark.read.schema(raw_schema)
        .option("encoding", "ISO-8859-1")
        .option("quote", '"')
        .option("escape", '"')
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", bad)
        .option("columnPruning", "false")
        .csv(path)
    )
    # Rows of any other length are flagged; the longer ones are kept. Spark refuses to
    # read the flag alone, as a plain count would, so the rule also looks at a field.
    never = F.octet_length(F.coalesce(F.col(schema.fields[0].name), F.lit(""))) < 0
    long_enough = _field_count(F.col(bad)) >= len(schema.fields)
    rows = raw.filter(F.when(F.col(bad).isNull(), True).when(long_enough, True).otherwise(never))
    columns = []
    for f in schema.fields:
        text = F.when(~is_missing(F.col(f.name)), F.col(f.name))
        columns.append((text if f.dataType == StringType() else text.try_cast(f.dataType)).alias(f.name))
    typed = rows.select(*columns)
    return drop_missing_codes(typed) if table == "routes" else typed


def _field_count(line: Column) -> Column:
    """Number of fields of a CSV line: separators outside quotes, plus one."""
    bare = F.regexp_replace(line, r'"[^"]*"', "")
    return F.length(bare) - F.length(F.replace(bare, F.lit(","))) + 1


def drop_missing_codes(routes: DataFrame) -> DataFrame:
    """Routes need both airport codes."""
    return routes.filter(~is_missing(F.col("src_airport")) & ~is_missing(F.col("dst_airport")))


def load_once(spark: SparkSession, table: str, load) -> DataFrame:
    """Saved table if it exists with rows, else loaded and saved."""
    if spark.catalog.tableExists(table):
        saved = spark.table(table)
        if not saved.isEmpty():
            return saved
    load().write.mode("overwrite").saveAsTable(table)
    return spark.table(table)


def load_once_path(spark: SparkSession, path: str, load) -> DataFrame:
    """As :func:`load_once` for a parquet folder; a folder with rows is left alone."""
    from pyspark.errors import AnalysisException

    try:
        saved = spark.read.parquet(path)
        if not saved.isEmpty():
            return saved
    except AnalysisException as error:
        if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):  # no folder, or an empty one
            raise
    load().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
