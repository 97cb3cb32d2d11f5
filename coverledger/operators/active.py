"""Balances of open contracts at every month end."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window, functions as F

from coverledger.functions.dates import month_end_at_or_after, next_month_end


def month_spine(rows: DataFrame, start: str, last_month: dt.date, name: str = "report_month") -> DataFrame:
    """Month ends from the earliest start in the rows to the given last month.

    Empty when there is no start or it lies after the last month.
    """
    first = rows.agg(F.last_day(F.min(F.col(start).cast("date"))).alias("_first"))
    last = F.lit(last_month)
    return first.filter(F.col("_first") <= last).select(
        F.explode(
            F.transform(
                F.sequence(F.trunc("_first", "MM"), F.trunc(last, "MM"), F.expr("INTERVAL 1 MONTH")), F.last_day
            )
        ).alias(name)
    )


def first_month(rows: DataFrame, start: str) -> Column:
    """Month end of the earliest start, as a scalar subquery."""
    return rows.agg(F.last_day(F.min(F.col(start).cast("date")))).scalar()


def months_between(start: Column, end: Column, as_of: dt.date) -> Column:
    """First days of the months from start to end; an open end reaches to ``as_of``.

    Null, so that an explode gives no row, where the end lies before the start.
    """
    first = F.trunc(start.cast("date"), "MM")
    last = F.trunc(F.coalesce(end.cast("date"), F.lit(as_of)), "MM")
    return F.when(first <= last, F.sequence(first, last, F.expr("INTERVAL 1 MONTH")))


def active_balance(
    rows: DataFrame,
    start: str,
    end: str,
    amount: str,
    keys: list[str],
    first: Column,
    last_month: dt.date,
    month: str = "report_month",
) -> DataFrame:
    """Sum of amounts open at each month end m: ``start <= m`` and ``end`` null or after m.

    Each contract gives one entry and at most one exit; entries and exits are summed
    per key and month before the shuffle, and a running total over those few months
    gives the balance. A long contract therefore costs two rows and not one per month,
    and no contract is joined with the calendar. A month appears for a key only while
    something is open, with ``amount`` and the number of open contracts in ``n_open``.
    """
    last = F.lit(last_month)
    value = F.coalesce(F.col(amount), F.lit(0)).cast("decimal(28,4)")
    spans = (
        rows.select(
            *keys,
            F.greatest(month_end_at_or_after(F.col(start)), first).alias("_in"),
            month_end_at_or_after(F.col(end)).alias("_out"),
            value.alias("_value"),
            F.col(start).alias("_start"),
        )
        .filter(F.col("_start").isNotNull() & first.isNotNull() & (F.col("_in") <= last))
        .filter(F.col("_out").isNull() | (F.col("_out") > F.col("_in")))
    )
    moves = spans.select(
        *keys,
        F.inline(
            F.array(
                F.struct(F.col("_in").alias("_month"), F.col("_value"), F.lit(1).alias("_n")),
                F.struct(F.col("_out").alias("_month"), (-F.col("_value")).alias("_value"), F.lit(-1).alias("_n")),
            )
        ),
    ).filter(F.col("_month").isNotNull() & (F.col("_month") <= last))
    changes = moves.groupBy(*keys, "_month").agg(F.sum("_value").alias("_value"), F.sum("_n").alias("_n"))
    by_key = Window.partitionBy(*keys).orderBy("_month")
    running = changes.select(
        *keys,
        "_month",
        F.sum("_value").over(by_key).cast("decimal(38,4)").alias("amount"),
        F.sum("_n").over(by_key).alias("n_open"),
        F.lead("_month").over(by_key).alias("_next"),
    ).filter(F.col("n_open") > 0)
    until = F.coalesce(F.add_months(F.trunc("_next", "MM"), -1), F.trunc(last, "MM"))
    months = F.transform(F.sequence(F.trunc("_month", "MM"), until, F.expr("INTERVAL 1 MONTH")), F.last_day)
    return running.select(*keys, F.explode(months).alias(month), "amount", "n_open")
