"""As-of rate lookup: the latest rate published at or before a moment."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

#: Keys per currency over which rows later than the newest rate spread, and days over which rows
#: spread that match no rate.
LATE_KEYS, IDLE_KEYS = 1024, 1_000_000


def rate_days(rates: DataFrame, currency: str, published: str, rate: str) -> DataFrame:
    """Validity interval of every rate, spread over the days it covers.

    The last rate of a currency is spread up to the newest day of the whole table and
    over ``LATE_KEYS`` days more, which stand for all later days; it stays open-ended. The result has at most one row per currency, day and
    publication, so it is bounded by the calendar and not by the payments.
    """
    spec = Window.partitionBy("_currency").orderBy("_from")
    intervals = (
        rates.select(
            F.col(currency).alias("_currency"), F.col(published).cast("timestamp_ntz").alias("_from"), F.col(rate).alias("_rate")
        )
        .filter(F.col("_currency").isNotNull() & F.col("_from").isNotNull())
        .repartition("_currency")  # one shuffle for the aggregate and the window
        .groupBy("_currency", "_from")
        .agg(F.max("_rate").alias("_rate"))
        .withColumn("_to", F.lead("_from").over(spec))
    )
    last_day = F.coalesce(
        F.to_date(F.col("_to") - F.expr("INTERVAL '0.000001' SECOND")),
        F.date_add(newest_rate_day(rates, published), LATE_KEYS),
    )
    return intervals.withColumn("_day", F.explode(F.sequence(F.to_date("_from"), last_day)))


def newest_rate_day(rates: DataFrame, published: str):
    """One value for the whole rate table, as a scalar subquery."""
    return rates.agg(F.max(F.col(published).cast("date"))).scalar()


def with_rate(
    rows: DataFrame,
    rates: DataFrame,
    row_currency: str,
    row_time: str,
    rate_currency: str = "val_type",
    rate_time: str = "kurs_date",
    rate_value: str = "kurs",
    name: str = "rate",
    needed: Column | None = None,
) -> DataFrame:
    """Add the rate in force at each row's moment; null when none was published yet, and for
    rows that do not need one.

    An as-of match becomes an equality on (currency, day) with the exact interval
    test beside it. No row is moved into a per-currency window, so a currency that
    holds most of the payments still spreads over its days. Rows later than the newest
    rate spread over the days that stand for it, and rows that match nothing over keys
    of their own, both by a hash of the row, so neither piles up on one key. The planner
    broadcasts the day table when its measured size allows and shuffles otherwise.
    """
    days = rate_days(rates, rate_currency, rate_time, rate_value)
    moment = F.col(row_time).cast("timestamp_ntz")
    newest, day, row = newest_rate_day(rates, rate_time), F.to_date(row_time), F.xxhash64(*rows.columns)
    wanted = F.col(row_currency).isNotNull() & day.isNotNull()
    wanted = wanted if needed is None else wanted & F.coalesce(needed, F.lit(False))
    key = f"{row_currency}_of_rate"
    keyed = rows.withColumns(
        {
            key: F.when(wanted, F.col(row_currency)),
            "_row_day": F.when(~wanted, F.date_add(F.lit("1970-01-01").cast("date"), F.pmod(row, F.lit(IDLE_KEYS)).cast("int")))
            .when(day > newest, F.date_add(newest, F.pmod(row, F.lit(LATE_KEYS)).cast("int") + 1))
            .otherwise(day),
        }
    )
    match = (
        (F.col(key) == F.col("_currency"))
        & (F.col("_row_day") == F.col("_day"))
        & (F.col("_from") <= moment)
        & (F.col("_to").isNull() | (moment < F.col("_to")))
    )
    return keyed.join(days, match, "left").select(*[F.col(c) for c in rows.columns], F.col("_rate").alias(name))
