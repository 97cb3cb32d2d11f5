"""Raw tables bucketed by contract, row tables by month, parts stored once."""

from __future__ import annotations

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from coverledger import jobs
from coverledger.bridge import AS_OF, REINSURANCE_YEARS, STATEMENTS, Bridge
from coverledger.plans import curated, warehouse
from coverledger.plans.warehouse import Warehouse
from coverledger.sources import layout
from tests.test_warehouse import values

CONTRACT_COLUMNS = "anketa_id|_in_force|_contract|tb_anketa|_pay_contract|_policy_contract"
BUILDS = [
    curated.general_premium_rows,
    curated.motor_liability_rows,
    curated.motor_liability_sums,
    curated.premium_amounts_by_owner,
    curated.commission_rows,
]


@pytest.fixture(scope="module")
def raw(spark, sf_dir, tmp_path_factory):
    """The bridge's raw tables as folders of files."""
    root, bridge = str(tmp_path_factory.mktemp("raw")), Bridge(spark, sf_dir)
    for name in STATEMENTS:
        bridge(name).write.parquet(f"{root}/{name}")
    return jobs.raw_folder(spark, root)


@pytest.fixture(scope="module")
def staged(spark, raw, tmp_path_factory):
    return layout.stage(raw, STATEMENTS, spark, str(tmp_path_factory.mktemp("staged")))


def exchanges(df) -> list[str]:
    plan = df._jdf.queryExecution().executedPlan().toString()
    return re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan)


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def by_contract_key(df) -> list[str]:
    return [e for e in exchanges(df) if re.search(rf"\b({CONTRACT_COLUMNS})#", e)]


def test_staged_rows_are_the_raw_rows(raw, staged):
    assert not staged.hot
    for name in [*layout.CONTRACT_KEYS, *layout.DATES, "ins_kurs"]:
        assert values(staged(name)) == values(raw(name)), name
    for build in BUILDS:
        assert values(build(staged)) == values(build(raw)), build.__name__


@pytest.mark.parametrize("build", [curated._general_premium_rows, curated._motor_liability_sums, curated._commission_rows, curated._premium_amounts])
def test_joins_by_contract_need_no_exchange(raw, staged, no_broadcast, build):
    """Bank payments and acts follow by keys of their own; those may well need one."""
    [part] = staged.contract_parts()
    assert len(by_contract_key(build(raw))) >= 2
    assert by_contract_key(build(part)) == []


def test_a_session_that_did_not_write_them_uses_the_buckets(spark, staged, raw, no_broadcast):
    for name in layout.CONTRACT_KEYS:
        spark.sql(f"DROP TABLE {layout._table(staged.root, staged.run, name)}")
    again = layout.Staged(spark, staged.root)
    contracts = again("ins_anketa").select(F.col("ins_id").alias("contract"))
    joined = again("ins_oplata").join(contracts, F.col("anketa_id") == F.col("contract"))
    assert exchanges(joined) == []
    assert values(curated.commission_rows(again)) == values(curated.commission_rows(raw))


def test_a_hot_contract_is_stored_apart(spark, raw, tmp_path):
    """A third of the payments on one contract, and as many without any, give the same rows."""
    names = [*layout.CONTRACT_KEYS, "ins_bank_client", "ins_kurs", "ins_agent_akt"]
    key = raw("ins_polis").filter("tb_anketa IS NOT NULL").first().tb_anketa
    turn = F.pmod(F.col("ins_id"), F.lit(3))
    skewed = raw("ins_oplata").withColumn(
        "anketa_id", F.when(turn == 0, F.lit(key)).when(turn == 1, F.lit(None)).otherwise(F.col("anketa_id"))
    )
    tables = lambda name: skewed if name == "ins_oplata" else raw(name)
    laid_out = layout.stage(tables, names, spark, str(tmp_path), buckets=8)
    assert laid_out.hot and len(laid_out.contract_parts()) == 2
    sizes = laid_out._bucketed("ins_oplata").groupBy(F.input_file_name()).count()
    assert sizes.agg(F.max("count")).first()[0] < skewed.count() / 4
    assert values(laid_out("ins_oplata")) == values(skewed)
    for build in BUILDS:
        assert values(build(laid_out)) == values(build(tables)), build.__name__


def test_bucket_count_follows_the_largest_table():
    assert layout.bucket_count([]) == layout.LEAST == layout.bucket_count([1, 5])
    assert layout.bucket_count([layout.BUCKET_BYTES * 9]) == 16
    assert layout.bucket_count([10**20]) == layout.MOST


def test_a_range_of_days_reads_its_months(raw, staged):
    start, end = dt.date(1995, 2, 10), dt.date(1995, 4, 1)
    rows = staged.between("ins_bank_client", start, end)
    assert values(rows) == values(raw("ins_bank_client").filter(F.col("pym_date").between(start, end) & (F.col("pym_date") < end)))
    read, whole = rows.inputFiles(), staged("ins_bank_client").inputFiles()
    assert rows.count() and len([f for f in whole if "_month=1995-0" in f]) >= 3
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*_month", plan) and len(read) <= len(whole)
    assert values(curated.premium_total(staged, start, end)) == values(curated.premium_total(raw, start, end))


def test_stored_rows_by_month(spark, raw, tmp_path):
    w = Warehouse(raw, AS_OF, REINSURANCE_YEARS)
    first = w["agency_commissions"].agg(F.min("commission_date")).first()[0]
    start = first.replace(day=1)
    end = (start + dt.timedelta(days=31)).replace(day=1)
    planned = values(w.between("agency_commissions", start, end))
    w.save("agency_commissions", str(tmp_path))
    found = w.between("agency_commissions", start, end)
    assert values(found) == planned and planned
    scan = found._jdf.queryExecution().executedPlan()
    assert re.search(r"PartitionFilters: \[[^\]]*_month", scan.toString())
    files = {r.f for r in found.select(F.input_file_name().alias("f")).collect()}
    assert all(f"_month={start:%Y-%m}" in f for f in files)


def test_runs_replace_each_other_whole(spark, tmp_path):
    root = str(tmp_path / "t")
    rows = lambda days: spark.createDataFrame([(d, dt.date(2024, d, 1) if d else None) for d in days], "k int, day date")
    assert layout.published(spark, str(tmp_path / "none")) is None
    layout.write_months(rows([1, 2, 0]), root, "day")
    first = layout.read_months(spark, root)
    layout.write_months(rows([2, 3]), root, "day")
    assert sorted(r.k for r in layout.read_months(spark, root).collect()) == [2, 3]
    assert sorted(r.k for r in first.collect()) == [0, 1, 2]  # readers of the run before
    broken = rows([4]).withColumn("k", F.raise_error(F.lit("lost")).cast("int"))
    with pytest.raises(Exception, match="lost"):
        layout.write_months(broken, root, "day")
    assert sorted(r.k for r in layout.read_months(spark, root).collect()) == [2, 3]
    layout.write_months(rows([]), root, "day")
    assert layout.read_months(spark, root).collect() == []
    runs = [p.name for p in (tmp_path / "t").iterdir() if p.name.startswith("run=")]
    assert len(runs) == 2  # the broken run is gone with the next good one


def test_shared_parts_are_joined_once(spark, raw, tmp_path, monkeypatch):
    """Over all models payments are scanned once for premiums and once for commissions."""
    scans = []

    def counted(write):
        def run(df, *rest):
            scans.append((rest[0].rsplit("/", 1)[-1], df._jdf.queryExecution().executedPlan().toString()))
            return write(df, *rest)

        return run

    monkeypatch.setattr(layout, "write_months", counted(layout.write_months))
    monkeypatch.setattr(warehouse, "write_snapshot", counted(warehouse.write_snapshot))
    w = Warehouse(raw, AS_OF, REINSURANCE_YEARS)
    names = ["premium_general", "premium_motor_sums", "commission_rows", "insurance_premium", "agency_commissions",
             "agency_commissions_monthly", "bank_partner_performance_monthly", "insurance_operations_monthly"]
    for name in names:
        w.save(name, str(tmp_path))
    read = {name: len(re.findall(r"FileScan parquet \[[^\n]*?/ins_oplata\]", plan)) for name, plan in scans}
    assert read == {n: int(n in ("premium_general", "commission_rows")) for n in names}
    assert w.stored("premium_sums")
    plain = Warehouse(raw, AS_OF, REINSURANCE_YEARS)
    for name in ("insurance_premium", "agency_commissions", "premium_sums", "bank_partner_performance_monthly"):
        assert values(w[name]) == values(plain[name]), name


def test_hot_contracts_are_sought_by_slots(spark, monkeypatch):
    """Keys are counted one by one only in slots above a share, and only if there are any."""
    n = F.col("id")
    even = spark.range(1000).select((n % 500).alias("anketa_id"))
    hot = spark.range(1000).select(F.when(n % 2 == 0, F.lit(7)).when(n % 5 == 0, F.lit(None)).otherwise(n).alias("anketa_id"))
    collected = []
    collect = type(even).collect
    monkeypatch.setattr(type(even), "collect", lambda df: collected.append(df.columns) or collect(df))
    assert layout.hot_keys({"ins_oplata": even, "ins_polis": even.select(F.col("anketa_id").alias("tb_anketa"))}, 8) == []
    assert collected == [["name", "slot"]]
    assert layout.hot_keys({"ins_oplata": even}, 1) == layout.hot_keys({"ins_oplata": even.limit(0)}, 8) == []
    assert layout.hot_keys({"ins_oplata": hot}, 16) == ["7", None]
    monkeypatch.setattr(layout, "LEAST_SLOTS", 1)
    monkeypatch.setattr(layout, "SLOTS_A_BUCKET", 1)  # many keys share a slot
    assert set(layout.hot_keys({"ins_oplata": hot}, 16)) == {None, "7"}
