"""Plans at scale: shuffle counts, pushdown, no nested loops, and a hot key split by AQE."""

from __future__ import annotations

from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

from coverledger.bridge import Bridge
from coverledger.plans import curated, marts
from coverledger.plans.warehouse import CURATED, MARTS


@contextmanager
def settings(spark, **values):
    names = {k.replace("__", "."): v for k, v in values.items()}
    old = {k: spark.conf.get(k, None) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", [*CURATED, *MARTS])
def test_no_nested_loops_and_no_forced_broadcast(spark, sf_dir, name):
    """With automatic broadcast off nothing is broadcast, so no hint forces one."""
    with settings(spark, spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__enabled="false"):
        plan = plan_of(Bridge(spark, sf_dir).warehouse()[name])
    assert "NestedLoop" not in plan and "Cartesian" not in plan and "BroadcastExchange" not in plan
    assert "PythonUDF" not in plan and "ArrowEval" not in plan


def test_payments_share_the_contract_shuffle(spark, sf_dir):
    """Policy check and contract join use one shuffle of the payments; the others are currency and bank payment."""
    with settings(spark, spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__enabled="false"):
        plan = plan_of(curated.general_premium_rows(Bridge(spark, sf_dir)))
    lines = plan.splitlines()
    assert sum("Exchange hashpartitioning(anketa_id" in x for x in lines) == 1
    assert sum("Exchange hashpartitioning(bc_id" in x for x in lines) == 1
    assert sum("Exchange hashpartitioning(opl_val" in x for x in lines) == 1


def test_columns_and_filters_reach_the_scan(spark, sf_dir):
    plan = plan_of(Bridge(spark, sf_dir).warehouse()["reinsurance_monthly"])
    assert "l_tax" not in plan and "c_acctbal" not in plan and "policyholder" not in plan
    b = Bridge(spark, sf_dir)
    recoveries = plan_of(b.source("orders").filter(F.col("o_orderstatus") == "P").select("o_orderkey"))
    assert "EqualTo(o_orderstatus,P)" in recoveries and "ReadSchema: struct<o_orderkey:bigint,o_orderstatus:string>" in recoveries


def hot_tables(spark, hot: bool):
    """100,000 payments; with ``hot`` a third of them belong to one contract and one bank payment."""
    n = F.col("id")
    key = F.when(n % 3 == 0, F.lit(7)).otherwise(n % 5000) if hot else n % 5000
    payments = spark.range(0, 100_000, 1, 8).select(
        n.alias("ins_id"), key.alias("anketa_id"), key.alias("bc_id"), (n % 4).alias("ins_type"), (n % 3 + 1).alias("opl_val"),
        F.date_add(F.lit("2000-01-01").cast("date"), (n % 300).cast("int")).alias("opl_data"),
        (n % 1000).cast("decimal(22,4)").alias("oplata"), (n % 100).cast("decimal(22,4)").alias("opl_summa"),
        F.lit(2).cast("decimal(22,4)").alias("val_kurs"))
    keys = spark.range(5000)
    return {
        "ins_oplata": payments,
        "ins_anketa": keys.select(n.alias("ins_id"), (n * 2).cast("decimal(22,4)").alias("ins_otv")),
        "ins_polis": keys.select(n.alias("tb_anketa"), F.lit(2).alias("tb_status")),
        "ins_bank_client": keys.select(
            n.alias("ins_id"), F.lit("2000-05-05").cast("timestamp_ntz").alias("pym_date"), (n % 2 + 1).alias("status")),
        "ins_kurs": spark.range(2, 4).select(n.alias("val_type"), F.lit("2000-01-01").cast("date").alias("kurs_date"), n.cast("decimal(15,6)").alias("kurs")),
    }


def test_hot_contract_is_split_and_whole(spark):
    shuffled = settings(
        spark,
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="64KB",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="32KB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="1.5",
    )
    with shuffled:
        tables = hot_tables(spark, hot=True)
        rows = curated.general_premium_rows(tables.get)
        got = rows.groupBy("source_query_id").agg(
            F.count("*"), F.sum("premium_amount"), F.sum("liability_amount"))
        result = sorted(map(tuple, got.collect()))
        assert "skew=true" in plan_of(got)
    unshuffled = curated.general_premium_rows(hot_tables(spark, hot=True).get).groupBy("source_query_id").agg(
        F.count("*"), F.sum("premium_amount"), F.sum("liability_amount"))
    assert result == sorted(map(tuple, unshuffled.collect()))
    assert "skew=true" not in plan_of(unshuffled)


def test_open_balances_do_not_grow_with_contract_length(spark):
    """A contract open for a century adds two rows before the shuffle, not 1,200."""
    from coverledger.operators import active
    import datetime as dt

    rows = spark.range(1000).select(
        F.lit("1900-01-05").cast("timestamp_ntz").alias("s"), F.lit("2000-01-05").cast("timestamp_ntz").alias("e"), F.lit(1).cast("decimal(22,4)").alias("a"), F.lit("k").alias("k"))
    got = active.active_balance(rows, "s", "e", "a", ["k"], active.first_month(rows, "s"), dt.date(2000, 12, 31))
    assert got.count() == 1200 and got.agg(F.min("n_open"), F.max("amount")).first() == (1000, 1000)


def test_market_mart_reads_two_years(spark, sf_dir):
    plan = plan_of(marts.volume_terminations(Bridge(spark, sf_dir).warehouse()))
    assert "1999-01-01" in plan and "2001-01-01" in plan


def test_rates_come_last_and_payments_carry_one_amount(spark):
    """The exchange on the bank's key holds no rate, and no payment is shuffled with two amounts."""
    tables = hot_tables(spark, hot=False)
    with settings(spark, spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__enabled="false"):
        lines = plan_of(curated.general_premium_rows(tables.get)).splitlines()
    depth = {k: next(len(x) - len(x.lstrip(" :+-|*")) for x in lines if f"Exchange hashpartitioning({k}" in x)
             for k in ("opl_val_of_rate", "bc_id", "anketa_id")}
    assert depth["opl_val_of_rate"] < depth["bc_id"] < depth["anketa_id"]
    payments = next(i for i, x in enumerate(lines) if "Exchange hashpartitioning(anketa_id" in x)
    assert "paid#" in lines[payments + 1] and "AS oplata" not in lines[payments + 1]


def test_volumes_join_the_years_of_the_bank_first(spark, sf_dir):
    with settings(spark, spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__enabled="false"):
        lines = plan_of(marts.volume_premiums(Bridge(spark, sf_dir).warehouse())).splitlines()
    depth = {k: max(len(x) - len(x.lstrip(" :+-|*")) for x in lines if f"Exchange hashpartitioning({k}" in x)
             for k in ("bc_id", "anketa_id", "polis_id")}
    assert depth["polis_id"] < depth["anketa_id"] < depth["bc_id"]
