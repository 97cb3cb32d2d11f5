"""Report order: ascending puts nulls last, descending puts them first."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def sort_keys(spec: list[tuple[str | Column, str]]) -> list[Column]:
    keys = []
    for c, direction in spec:
        column = F.col(c) if isinstance(c, str) else c
        keys.append(column.desc_nulls_first() if direction == "desc" else column.asc_nulls_last())
    return keys


def report_order(df: DataFrame, spec: list[tuple[str | Column, str]]) -> DataFrame:
    return df.orderBy(*sort_keys(spec))


def preview(df: DataFrame, spec: list[tuple[str | Column, str]], rows: int = 5) -> DataFrame:
    """First rows in a stated order."""
    return report_order(df, spec).limit(rows)
