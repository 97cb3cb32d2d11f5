"""Dimension lookups and join fan-out without emitting it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def lookup_value(df: DataFrame, key: Column, dim: DataFrame, dim_key: str, value: Column, name: str) -> DataFrame:
    """Add one value per row from a dimension, as a scalar function would.

    The dimension is reduced to one row per key first, so duplicates never multiply rows.
    """
    single = dim.groupBy(F.col(dim_key).alias("_lookup_key")).agg(F.max(value).alias(name))
    return df.join(single, key == F.col("_lookup_key"), "left").drop("_lookup_key")


def count_by_key(df: DataFrame, key: str, name: str) -> DataFrame:
    return df.groupBy(F.col(key).alias(key)).agg(F.count(F.lit(1)).alias(name))


def left_join_copies(
    df: DataFrame, key: str, link: str | None = None, next_copies: DataFrame | None = None, next_key: str | None = None
) -> DataFrame:
    """How many rows a chain of left joins makes per key of this table.

    ``next_copies`` holds the same count for the following table in the chain, reached
    through ``link``; a missing match still counts once.
    """
    if next_copies is None:
        return df.groupBy(key).agg(F.count(F.lit(1)).alias("copies"))
    onward = next_copies.select(F.col(next_key).alias("_next"), F.col("copies").alias("_copies"))
    return (
        df.select(key, link)
        .join(onward, F.col(link) == F.col("_next"), "left")
        .groupBy(key)
        .agg(F.sum(F.coalesce(F.col("_copies"), F.lit(1))).alias("copies"))
    )
