"""Data-quality rules and their report."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

COLUMN_RULES = ("not_null", "non_negative")
REPORT_COLUMNS = ["table_name", "column_name", "check_name", "failures"]


def rules_from_spec(spec: dict) -> list[tuple[str, str]]:
    """(column, rule) pairs of a declaration; the key may read ``check`` or ``checks``."""
    return [
        (column, rule)
        for column, declared in spec.items()
        for rule in (*declared.get("checks", ()), *declared.get("check", ()))
    ]


def failures(column: str, rule: str) -> Column:
    """Number of rows breaking one rule, as an aggregate."""
    if rule == "not_null":
        return F.count_if(F.col(column).isNull())
    if rule == "non_negative":
        return F.count_if(F.col(column) < 0)
    raise ValueError(f"rule must be one of {COLUMN_RULES}")


def key_duplicates(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys held by more than one row, with their row count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).filter(F.col("copies") > 1)


def run_checks(
    df: DataFrame,
    table: str,
    rules: Sequence[tuple[str, str]] = (),
    key: Sequence[str] | None = None,
    source: DataFrame | None = None,
) -> DataFrame:
    """Report with one row per check: table, column, check and failing rows.

    All column rules are one aggregate pass. ``source`` is checked for having
    rows at all, ``key`` for being unique (NULL keys count as duplicates of each other).
    """
    spark = df.sparkSession
    report = None

    def add(part: DataFrame) -> None:
        nonlocal report
        part = part.select(*REPORT_COLUMNS)
        report = part if report is None else report.unionByName(part)

    if rules:
        totals = df.agg(*[failures(c, r).alias(f"_{i}") for i, (c, r) in enumerate(rules)])
        entries = [
            F.struct(
                F.lit(c).alias("column_name"), F.lit(r).alias("check_name"), F.col(f"_{i}").alias("failures")
            )
            for i, (c, r) in enumerate(rules)
        ]
        add(totals.select(F.lit(table).alias("table_name"), F.inline(F.array(*entries))))
    if source is not None:
        empty = source.limit(1).agg(F.when(F.count(F.lit(1)) > 0, 0).otherwise(1).cast("bigint").alias("failures"))
        add(empty.select(F.lit(table).alias("table_name"), F.lit("*").alias("column_name"),
                         F.lit("row_count_positive").alias("check_name"), "failures"))
    if key is not None:
        dup = key_duplicates(df, key).agg(F.count(F.lit(1)).alias("failures"))
        add(dup.select(F.lit(table).alias("table_name"), F.lit(",".join(key)).alias("column_name"),
                       F.lit("unique").alias("check_name"), "failures"))
    if report is None:
        report = spark.createDataFrame([], "table_name string, column_name string, check_name string, failures bigint")
    return report.withColumn("passed", F.col("failures") == 0)


def observe_rules(df: DataFrame, name: str, rules: Sequence[tuple[str, str]]) -> tuple[DataFrame, Observation | str]:
    """Attach the column rules as metrics, so a load reports them without a second pass.

    On a stream the metrics arrive with every progress event under ``name``.
    """
    metrics = [failures(c, r).alias(f"{c}__{r}") for c, r in rules]
    if df.isStreaming:
        return df.observe(name, *metrics), name
    observation = Observation(name)
    return df.observe(observation, *metrics), observation
