"""Amounts and currency conversion in exact decimals.

An amount of a source table has 4 decimals and a rate 10; a product is rounded once,
to the 10 decimals that 38 digits leave room for. Numbers read from text may be larger
and finer (``READ``). Nothing else is rounded before it is summed.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

AMOUNT = "decimal(22,4)"
READ = "decimal(30,6)"
RATE = "decimal(18,10)"
CONVERTED = "decimal(38,10)"
TOTAL = "decimal(38,4)"
HOME_CURRENCY = 1


def amount_or_zero(c: Column) -> Column:
    return F.coalesce(c.cast(AMOUNT), F.lit(0).cast(AMOUNT))


def convert(currency: Column, home_amount: Column, foreign_amount: Column, rate: Column) -> Column:
    """Home amount for the home currency, else foreign amount times the rate.

    Missing amounts count as 0. A missing rate leaves the result null; wrap the
    rate in ``rate_or_one`` where a missing rate means 1.
    """
    home = F.coalesce(home_amount, F.lit(0)).cast(CONVERTED)
    foreign = amount_or_zero(foreign_amount) * rate.cast(RATE)
    return F.when(currency == HOME_CURRENCY, home).otherwise(foreign.cast(CONVERTED))


def rate_or_one(rate: Column) -> Column:
    return F.coalesce(rate.cast(RATE), F.lit(1).cast(RATE))


def percent_of(amount: Column, percent: Column) -> Column:
    """amount x percent / 100, rounded once; a percentage has as many decimals as a rate."""
    share = F.coalesce(percent.cast(RATE), F.lit(0).cast(RATE)) * F.lit("0.01").cast("decimal(2,2)")
    return (amount_or_zero(amount) * share).cast(CONVERTED)


def billions(total: Column) -> Column:
    """Exact amount in billions, 13 decimals."""
    return total.cast("decimal(28,4)") * F.lit("0.000000001").cast("decimal(9,9)")
