"""Data quality checks, profiles and load reports."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from coverledger.functions.cleaning import clean_numeric
from coverledger.functions.money import READ


def unique_violations(df: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once, nulls ignored."""
    return (
        df.filter(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("n_records"))
        .filter(F.col("n_records") > 1)
    )


def null_violations(df: DataFrame, column: str) -> DataFrame:
    """Rows without a value."""
    return df.filter(F.col(column).isNull())


def _counts(tables: dict[str, DataFrame], name: str) -> DataFrame:
    parts = [df.agg(F.count(F.lit(1)).alias(name)).select(F.lit(t).alias("table_name"), name) for t, df in tables.items()]
    return reduce(DataFrame.unionByName, parts)


def reconcile(source: dict[str, DataFrame], target: dict[str, DataFrame]) -> DataFrame:
    """Row counts of both sides per table; a table missing on one side counts as null there."""
    return (
        _counts(source, "source_rows")
        .join(_counts(target, "target_rows"), "table_name", "full")
        .withColumn("difference", F.coalesce("source_rows", F.lit(0)) - F.coalesce("target_rows", F.lit(0)))
    )


def profile(df: DataFrame, columns: list[str]) -> DataFrame:
    """Non-null count per column, in one pass."""
    counts = df.agg(*[F.count(c).alias(c) for c in columns], F.count(F.lit(1)).alias("_rows"))
    return counts.unpivot("_rows", columns, "column_name", "non_null").select(
        "column_name", "non_null", F.col("_rows").alias("total_rows")
    )


def unfit_amounts(df: DataFrame, columns: list[str], amount_type: str = READ) -> DataFrame:
    """Per text column, how many values hold a number that the amount type cannot: they would
    be read as null and be missing from every sum."""
    unfit = [F.count_if(F.col(c).rlike("[0-9]") & clean_numeric(F.col(c), amount_type).isNull()).alias(c) for c in columns]
    counts = df.agg(*unfit, F.count(F.lit(1)).alias("_rows"))
    return counts.unpivot("_rows", columns, "column_name", "unfit_values").select(
        "column_name", "unfit_values", F.col("_rows").alias("total_rows")
    )


def load_metrics(columns: list[str], by: str | None = None, names: list[str] = ()) -> dict[str, Column]:
    """What ``load_summary`` and ``profile`` count, as metrics that a write can observe.

    Rows read and skipped as empty, per name of ``by`` where names are given, and non-null values
    per column. One pass computes and writes the rows and counts them.
    """
    empty = reduce(lambda a, b: a & b, [F.col(c).isNull() for c in columns])
    out = {f"non_null_{k}": F.count(c) for k, c in enumerate(columns)}
    for k, name in enumerate(names):
        own = F.col(by).eqNullSafe(F.lit(name))
        out |= {f"read_{k}": F.count_if(own), f"skipped_{k}": F.count_if(own & empty)}
    return out | {"read": F.count(F.lit(1)), "skipped": F.count_if(empty)}


def observed_rows(seen: dict[str, int], names: list[str]) -> list[tuple[str, int, int, int]]:
    """Name, rows read, skipped and inserted, from observed metrics."""
    counts = [(n, seen[f"read_{k}"], seen[f"skipped_{k}"]) for k, n in enumerate(names)]
    return [(n, read, skipped, read - skipped) for n, read, skipped in counts]


def observed_summary(spark: SparkSession, seen: dict[str, int], by: str, names: list[str]) -> DataFrame:
    """``load_summary`` from observed metrics."""
    return spark.createDataFrame(observed_rows(seen, names), f"{by} string, rows_read long, rows_skipped long, rows_inserted long")


def observed_profile(spark: SparkSession, seen: dict[str, int], columns: list[str]) -> DataFrame:
    """``profile`` of the rows that are not empty, from observed metrics."""
    total = seen["read"] - seen["skipped"]
    rows = [(c, seen[f"non_null_{k}"], total) for k, c in enumerate(columns)]
    return spark.createDataFrame(rows, "column_name string, non_null long, total_rows long")


def load_summary(landed: DataFrame, columns: list[str], by: str) -> DataFrame:
    """Rows read, skipped as empty and inserted, per source."""
    empty = reduce(lambda a, b: a & b, [F.col(c).isNull() for c in columns])
    return landed.groupBy(by).agg(
        F.count(F.lit(1)).alias("rows_read"),
        F.count_if(empty).alias("rows_skipped"),
        F.count_if(~empty).alias("rows_inserted"),
    )
