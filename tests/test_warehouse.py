"""Models together: stored and unstored runs agree, invariants hold, skew and repeats change nothing."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from coverledger.bridge import AS_OF, REINSURANCE_YEARS, Bridge
from coverledger.plans import curated
from coverledger.plans.warehouse import CURATED, MARTS, Warehouse
from coverledger.queries import comparable
from tests.compare import plain


def values(df):
    names = sorted(df.columns)
    return sorted(tuple(plain(r[n]) for n in names) for r in comparable(df).collect())


def test_stored_run_gives_the_same_marts(spark, sf_dir, tmp_path):
    plan, stored = Bridge(spark, sf_dir).warehouse(), Bridge(spark, sf_dir).warehouse()
    stored.save_all(str(tmp_path))
    for name in MARTS:
        assert values(stored[name]) == values(plan[name]), name
    saved = spark.read.parquet(f"{tmp_path}/curated/claims_portfolio")
    assert {"loaded_at", "updated_at"} <= set(saved.columns)
    assert not {"loaded_at", "updated_at"} & set(spark.read.parquet(f"{tmp_path}/curated/deposits").columns)
    later = Bridge(spark, sf_dir).warehouse()
    later.read_stored(str(tmp_path), ["premium_sums", "claims_portfolio", "loans"])
    assert later.stored("premium_sums") and later.stored("claims_portfolio") and not later.stored("deposits")
    assert values(later["financial_ratios_monthly"]) == values(plan["financial_ratios_monthly"])


def test_landing_time_is_kept(spark, tmp_path):
    landed = spark.createDataFrame(
        [("01-02-2025", "1", "2", "2025-03-04T05:06:07.5"), (None, None, None, "soon")],
        "report_date string, actual_solvency_margin_adequacy_ratio string, "
        "required_solvency_margin_adequacy_ratio string, loaded_at string",
    )
    w = Warehouse(lambda name: landed, AS_OF)
    w.save("solvency_adequacy_ratio", str(tmp_path))
    got = {r.loaded_at for r in spark.read.parquet(f"{tmp_path}/curated/solvency_adequacy_ratio").collect()}
    assert got == {dt.datetime(2025, 3, 4, 5, 6, 7, 500000), None}


def test_invariants(spark, sf_dir):
    w = Bridge(spark, sf_dir).warehouse()
    portfolio = w["investment_portfolio_monthly"].groupBy("report_month").agg(
        F.count("*").alias("n"), F.sum("total_investment_category_pct").alias("pct"), F.max("total_investment_portfolio_volume_uzs").alias("v")
    ).collect()
    assert all(r.n == 4 and (r.v == 0 or abs(r.pct - 100) < 1e-6) for r in portfolio)
    bad = w["subrogation_recoveries"].filter("total_recovery_amount <> exact_recovery_amount + undefined_recovery_amount")
    assert bad.count() == 0
    for name, keys in {
        "financial_ratios_monthly": ["report_month", "scenario"],
        "bank_partner_performance_monthly": ["report_month", "bank_partner_name"],
        "investment_partner_indicators_monthly": ["report_month", "portfolio_category", "partner_name"],
    }.items():
        assert w[name].groupBy(*keys).count().filter("count > 1").count() == 0


def test_views(spark, sf_dir):
    w = Bridge(spark, sf_dir).warehouse()
    w.create_views(["product_dimension"])
    assert spark.sql("SELECT count(*) AS n FROM product_dimension WHERE insurance_type = 'Compulsory'").first().n > 0
    assert set(CURATED) & set(MARTS) == set()


@pytest.fixture(scope="module")
def repeated(spark):
    """Keys that repeat everywhere; one contract holds most rows."""
    t = {}

    def table(name, schema, rows):
        t[name] = spark.createDataFrame(rows, schema)

    day = dt.datetime(2000, 3, 5)
    keys = [1] * 6 + [2, 2, 3]
    dec = Decimal
    table("tb_anketa", "tb_id int, tb_fizur int, tb_user int", [(1, 1, 10), (1, 1, 10), (2, 2, 11), (3, 1, None)])
    table("tb_polis", "tb_anketa int, tb_summa decimal(22,4), tb_komissia decimal(10,4), tb_status int, akt int",
          [(k, dec(i + 1) / 4, dec(5), 2 if i % 3 else 8, 1) for i, k in enumerate(keys)] + [(1, dec(99), dec(1), 5, 1), (2, None, None, 2, 1)])
    table("tb_oplata", "tb_id int, tb_anketa int, tb_summa decimal(22,4), tb_typepl int, bc_id int",
          [(i, k, dec(i), 1 if i % 4 else 2, 1 + i % 3) for i, k in enumerate(keys * 2)])
    table("tb_avto", "tb_anketa int", [(k,) for k in keys])
    table("ins_bank_client", "ins_id int, pym_date timestamp_ntz, pym_summa decimal(22,4), bc_type int, status int",
          [(1, day, dec(100), 2, 2), (2, None, dec(50), 2, 2), (3, day, None, 2, 1), (1, day, dec(7), 2, 2), (4, day, dec(1), 1, 2)])
    table("ins_regress_bank", "bc_id int, regress_id int, recovery_sum decimal(22,4)",
          [(1, 1, dec(5)), (1, 1, dec(6)), (1, 2, dec(7)), (3, None, dec(8)), (4, 1, dec(9)), (1, 9, None)])
    table("ins_regress", "ins_id int, polis_id int", [(1, 1), (1, 2), (2, 1)])
    table("ins_polis", "tb_id int, tb_anketa int, tb_status int, pturi_id int", [(1, 1, 2, 1), (1, 2, 9, 1), (2, 5, 10, None)])
    table("ins_anketa", "ins_id int, owner int, fizyur int, ins_otv decimal(22,4), beneficiary int",
          [(1, 10, 1, dec(3), 10), (1, 10, 1, dec(4), 11), (2, 11, 2, None, 10)])
    table("ins_kontragent", "tb_id int, tb_orgname string, tb_name string", [(10, " ", "n"), (10, "o", "n"), (11, None, "")])
    return t


def test_fan_out_sums_equal_the_rows(spark, repeated):
    rows = curated.motor_liability_rows(repeated.get).groupBy("anketa_id", "payment_date").agg(F.sum("liability_amount").alias("s"))
    sums = curated.motor_liability_sums(repeated.get).groupBy("anketa_id", "payment_date").agg(F.sum("liability_amount").alias("s"))
    assert values(rows) == values(sums) and rows.count() > 2


def test_recoveries_equal_the_literal_joins(spark, repeated):
    for name, df in repeated.items():
        df.createOrReplaceTempView(name)
    literal = spark.sql("""
        SELECT b.ins_id AS transaction_id, CAST(b.pym_date AS DATE) AS recovery_payment_date, coalesce(b.pym_summa, 0) AS total_recovery_amount,
               coalesce(e.x, 0) AS exact_recovery_amount, coalesce(b.pym_summa, 0) - coalesce(e.x, 0) AS undefined_recovery_amount
        FROM ins_bank_client b LEFT JOIN (
            SELECT c.ins_id, coalesce(sum(rb.recovery_sum), 0) AS x FROM ins_bank_client c
            JOIN ins_regress_bank rb ON rb.bc_id = c.ins_id LEFT JOIN ins_regress r ON rb.regress_id = r.ins_id
            LEFT JOIN ins_polis p ON r.polis_id = p.tb_id LEFT JOIN ins_anketa a ON a.ins_id = p.tb_anketa
            LEFT JOIN ins_kontragent k ON a.beneficiary = k.tb_id WHERE c.bc_type = 2 GROUP BY c.ins_id) e ON e.ins_id = b.ins_id
        WHERE b.bc_type = 2 AND b.pym_date IS NOT NULL""")
    assert values(curated.subrogation_recoveries(repeated.get)) == values(literal)


def test_loan_without_payable(spark):
    dec, day = Decimal, dt.datetime(2024, 1, 1)
    t = {
        "ins_invloan": spark.createDataFrame(
            [(i, 1, "L", "D", day, day, None, 1, 1, dec(1), 1, 1, 0) for i in (1, 2, 3)],
            "ins_id int, client_id int, loan_num string, dog_num string, dog_date timestamp_ntz, loandate_from timestamp_ntz, "
            "loandate_to timestamp_ntz, loan_day int, prof_rate int, loan_sum decimal(22,4), val_type int, val_vozvrat int, status int"),
        "ins_kontragent": spark.createDataFrame([(1, "", "n")], "tb_id int, tb_orgname string, tb_name string"),
        "p_sp_currency": spark.createDataFrame([(1, "UZS")], "sp_id int, name string"),
        "ins_invloan_oplata": spark.createDataFrame([(1, dec(5)), (2, dec(5))], "loan_id int, amount decimal(22,4)"),
        "ins_invloan_accrual": spark.createDataFrame([(1, dec(0)), (3, dec(8))], "loan_id int, amount decimal(22,4)"),
    }
    got = {r.loan_id: (r.repayment_progress_pct, r.remaining_balance) for r in curated.loans(t.get).collect()}
    assert got == {1: (0.0, dec(-5)), 2: (None, None), 3: (None, None)}


def test_warehouse_years():
    w = Warehouse(lambda name: None, AS_OF)
    assert (w.prior_year, w.current_year, w.last_month) == (1999, 2000, dt.date(2000, 12, 31))
    assert w.reinsurance_years == (2024, 2025) and REINSURANCE_YEARS == (1999, 2000)


def test_products_without_a_name_stay_apart(spark):
    """Unnamed products match neither across measures nor across years."""
    dec, day = Decimal, dt.datetime
    t = {
        "ins_oplata": spark.createDataFrame(
            [(1, 1, 1, 1, 1, dec(10), dec(0), None), (2, 2, 2, 1, 1, dec(20), dec(0), None), (3, 3, 3, 3, 2, dec(5), dec(0), dec(2))],
            "anketa_id int, polis_id int, bc_id int, ins_type int, opl_val int, oplata decimal(22,4), opl_summa decimal(22,4), val_kurs decimal(22,4)"),
        "ins_bank_client": spark.createDataFrame(
            [(1, day(1999, 5, 1), 2), (2, day(2000, 12, 31, 23), 1), (3, day(2000, 1, 1), 2), (4, day(2001, 1, 1), 2)],
            "ins_id int, pym_date timestamp_ntz, status int"),
        "ins_anketa": spark.createDataFrame([(1, dec(100)), (3, dec(7))], "ins_id int, ins_otv decimal(22,4)"),
        "ins_polis": spark.createDataFrame([(1, 1, 2, 1), (2, 2, 9, 1), (3, 3, 10, 2), (4, 4, 5, None)], "tb_id int, tb_anketa int, tb_status int, pturi_id int"),
        "ins_sobitie": spark.createDataFrame([(1, 1), (2, 3), (3, 4)], "ins_id int, polis_id int"),
        "ins_viplati": spark.createDataFrame(
            [(1, day(2000, 2, 1), dec(4), None, None), (2, day(2000, 2, 1), dec(3), 2, dec(2)), (3, day(2000, 2, 1), dec(99), 1, None)],
            "sobitie_id int, date_viplata timestamp_ntz, viplate decimal(22,4), val_type int, val_kurs decimal(22,4)"),
        "ins_rastorg": spark.createDataFrame([(day(2000, 3, 1), dec(1), 3), (None, dec(9), 3)], "tb_dateras timestamp_ntz, tb_summa decimal(22,4), tb_polis int"),
        "ins_pturi": spark.createDataFrame(
            [(1, None, "u", "5", 1, 1, 1, 1, 0), (2, "named", "n", "108", 9, 1, 1, 1, 0)],
            "ins_id int, polis_name_rus string, polis_name string, kod_num string, vertical int, group1 int, group2 int, active int, import int"),
        "ins_vertical": spark.createDataFrame([(1, "line")], "ins_id int, name1 string"),
        "ins_pgroup1": spark.createDataFrame([(1, "g")], "ins_id int, name1 string"),
        "ins_pgroup2": spark.createDataFrame([(1, "g")], "ins_id int, name1 string"),
    }
    from coverledger.plans.marts import company_volumes

    w = Warehouse(t.get, AS_OF)
    cols = ["product_name", "co_prem_py", "co_prem_cy", "co_liab_py", "co_liab_cy", "co_claims_py", "co_claims_cy", "co_term_py", "co_term_cy"]
    got = sorted((tuple(r) for r in company_volumes(w).select(*cols).collect()), key=str)
    want = [
        (None, 10, 0, 100, 0, 0, 0, 0, 0),  # premium of the prior year
        (None, 0, 20, 0, 0, 0, 0, 0, 0),  # premium of the current year, contract missing
        (None, 0, 0, 0, 0, 0, 4, 0, 0),  # claims of the current year
        ("named", 0, 10, 0, 7, 0, 6, 0, 1),
    ]
    assert got == sorted([tuple(v if v is None or isinstance(v, str) else Decimal(v).quantize(Decimal("0.0001")) for v in r) for r in want], key=str)
