"""Change against the previous row and share of a total."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from coverledger.functions.ratios import ratio_or_zero


def change_from_previous(value: str, partition: list[str], order: str) -> Column:
    """Value minus the previous row's value; the first row keeps its full value.

    Meant for rows already summed per period, so a partition is a short calendar.
    """
    spec = Window.partitionBy(*partition).orderBy(order)
    return F.col(value) - F.lag(value, 1, 0).over(spec)


def share_of_summed(df: DataFrame, keys: list[str], value: str, total: str, share: str) -> DataFrame:
    """As ``share_of_total``, for rows already summed per category: a group is a short list,
    so one window over it spares the second computation of the input."""
    whole = F.sum(value).over(Window.partitionBy(*keys))
    totals = df.withColumn(total, whole)
    return totals.withColumn(share, ratio_or_zero(F.col(value), F.col(total)) * 100.0)


def share_of_total(df: DataFrame, keys: list[str], value: str, total: str, share: str) -> DataFrame:
    """Add the total of the row's group and the row's percentage of it, 0 for a zero total.

    Totals are summed first and joined back, so rows of one large group stay spread
    over many tasks; a window would sort the whole group in one.
    """
    totals = df.groupBy(*keys).agg(F.sum(value).alias(total)).toDF(*[f"_t_{k}" for k in keys], total)
    match = [F.col(k).eqNullSafe(F.col(f"_t_{k}")) for k in keys]
    joined = df.join(totals, match, "inner")
    return joined.select(
        *df.columns, F.col(total), (ratio_or_zero(F.col(value), F.col(total)) * 100.0).alias(share)
    )
