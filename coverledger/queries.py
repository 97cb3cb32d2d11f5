"""Registered queries: every model and operator over one folder of benchmark tables.

Each takes ``(spark, sf_dir)`` and reads whole tables. ``comparable`` gives the results
common types, so they can be compared value by value with another engine.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable
from decimal import Decimal
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F, types as T

from coverledger import catalog, jobs
from coverledger.bridge import AS_OF, SCHEMAS, Bridge
from coverledger.functions import cleaning, dates, money, ratios, reports as json_values
from coverledger.operators import active, asof, lookup, merge, ordering, quality, upsert, windows
from coverledger.plans import curated, marts
from coverledger.plans.warehouse import CURATED, MARTS, report_sort
from coverledger.session import checkpoint_dir, tune
from coverledger.sources import landing, layout, rejected, reports, sinks, snapshots
from coverledger.streaming import loads

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def comparable(df: DataFrame) -> DataFrame:
    """Decimals to 10 places, doubles rounded to 6."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DecimalType):
            c = c.cast("decimal(38,10)").alias(f.name)
        elif isinstance(f.dataType, T.DoubleType):
            c = F.round(c, 6).alias(f.name)
        out.append(c)
    return df.select(*out)


def query(name: str):
    """Register ``f(bridge)`` under a name."""

    def add(build: Callable[[Bridge], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return comparable(build(Bridge(tune(spark), sf_dir)))

        QUERIES[name] = run
        return build

    return add


# ---- curated models and marts ------------------------------------------------

CURATED_KEYS = {
    "c01_claims_portfolio": "claims_portfolio",
    "c02_reinsurance_incoming": "reinsurance_incoming",
    "c03_reinsurance_outgoing": "reinsurance_outgoing",
    "c04_balance_sheet": "balance_sheet",
    "c05_financial_performance": "financial_performance",
    "c06_investment_activity": "investment_activity",
    "c07_insurance_premium": "insurance_premium",
    "c08_agency_commissions": "agency_commissions",
    "c09_subrogation_recoveries": "subrogation_recoveries",
    "c10_terminated_contracts": "terminated_contracts",
    "c11_deposits": "deposits",
    "c12_loans": "loans",
    "c13_product_dimension": "product_dimension",
    "c14_solvency_adequacy_ratio": "solvency_adequacy_ratio",
}
MART_KEYS = {
    "m01_financial_kpi": "financial_kpi",
    "m02_agency_commissions_monthly": "agency_commissions_monthly",
    "m03_bank_partner_performance_monthly": "bank_partner_performance_monthly",
    "m04_financial_ratios_monthly": "financial_ratios_monthly",
    "m05_financial_stability_monthly": "financial_stability_monthly",
    "m06_insurance_operations_monthly": "insurance_operations_monthly",
    "m07_insurance_reserves_monthly": "insurance_reserves_monthly",
    "m08_investment_portfolio_monthly": "investment_portfolio_monthly",
    "m09_investment_partner_indicators_monthly": "investment_partner_indicators_monthly",
    "m10_operational_efficiency_monthly": "operational_efficiency_monthly",
    "m11_reinsurance_monthly": "reinsurance_monthly",
    "m12_reinsurance_indicators": "reinsurance_indicators",
    "m13_reinsurance_indicators_reinsurer": "reinsurance_indicators_reinsurer",
    "m14_subrogation_indicators_monthly": "subrogation_indicators_monthly",
    "m15_insurance_volume_indicators": "insurance_volume_indicators",
}
assert set(CURATED_KEYS.values()) == set(CURATED) and set(MART_KEYS.values()) == set(MARTS)


def _model(name: str):
    return lambda b: b.warehouse().report(name)


for _key, _name in (CURATED_KEYS | MART_KEYS).items():
    query(_key)(_model(_name))


# ---- sources and loading -----------------------------------------------------


def _text(c: str):
    return F.col(c).cast("string")


@query("s01_positional_landing")
def _(b: Bridge) -> DataFrame:
    raw = b.source("orders").select(
        F.col("o_orderkey").alias("row_no"),
        _text("o_custkey").alias("_c0"),
        F.col("o_orderstatus").alias("_c1"),
        F.col("o_orderpriority").alias("_c2"),
    )
    return landing.positional(raw, catalog.OUTGOING_COLUMNS[:5], catalog.HEADER_ROWS["outgoing"], keep=("row_no",))


@query("s02_index_projection")
def _(b: Bridge) -> DataFrame:
    cents = F.col("l_extendedprice").cast("decimal(22,2)").cast("string")
    raw = b.source("lineitem").select(
        _text("l_orderkey").alias("_c0"),
        F.concat(F.lit(" "), F.col("l_returnflag"), F.lit(" \t")).alias("_c16"),
        F.when(F.col("l_linenumber") == 1, F.lit("  ")).otherwise(F.col("l_linestatus")).alias("_c21"),
        F.substring(_text("l_shipdate"), 1, 10).alias("_c40"),
        cents.alias("_c42"),
        F.lit("not mapped").alias("_c43"),
    )
    return landing.project_positions(raw, catalog.CLAIMS_2025_POSITIONS, catalog.CLAIMS_COLUMNS)


def _sparse(b: Bridge) -> DataFrame:
    """Line items with three often empty columns and the flag they came under."""
    n = F.col("l_linenumber")
    return b.source("lineitem").select(
        F.col("l_returnflag").alias("source_name"),
        F.when(n % 2 == 0, F.col("l_orderkey")).alias("a"),
        F.when(n % 3 == 0, F.col("l_linestatus")).alias("b"),
        F.when(F.col("l_quantity") > 25, F.col("l_partkey")).alias("c"),
    )


@query("s03_drop_empty")
def _(b: Bridge) -> DataFrame:
    return landing.drop_empty(_sparse(b), ["a", "b", "c"])


@query("s04_lineage")
def _(b: Bridge) -> DataFrame:
    rows = landing.with_lineage(b.source("orders"), sheet="portfolio")
    return rows.select("o_orderkey", "source_file", (F.length("loaded_at") > 0).alias("has_load_time"))


S05_TEXT = """
    SELECT l_orderkey AS row_key,
           CASE l_linenumber % 3 WHEN 0 THEN substr(CAST(l_shipdate AS STRING), 1, 10) WHEN 1 THEN '02.01.2025' ELSE '2025' END AS contract_start_date,
           CASE l_linenumber % 4 WHEN 0 THEN concat(CAST(l_partkey AS STRING), '.7') WHEN 1 THEN concat('-', CAST(l_partkey AS STRING), '.7')
                WHEN 2 THEN 'x1' ELSE CAST(l_partkey AS STRING) END AS insurance_days_count,
           CASE l_linenumber % 4 WHEN 0 THEN concat(' ', CAST(CAST(l_extendedprice AS DECIMAL(22,2)) AS STRING), ' ') WHEN 1 THEN '1 234,56'
                WHEN 2 THEN concat(CAST(l_partkey AS STRING), ' UZS') ELSE CAST(l_partkey AS STRING) END AS insurance_premium_policy,
           CASE l_linenumber % 3 WHEN 0 THEN '  ' WHEN 1 THEN concat('  ', l_returnflag) ELSE NULL END AS region
    FROM {lineitem}"""


@query("s05_typed_clean")
def _(b: Bridge) -> DataFrame:
    raw = b.spark.sql(S05_TEXT, lineitem=b.source("lineitem"))
    columns = ["contract_start_date", "insurance_days_count", "insurance_premium_policy", "region"]
    return landing.clean_typed_table(raw, columns, keep=("row_key",))


@query("s06_text_clean")
def _(b: Bridge) -> DataFrame:
    padded = F.when(F.col("o_orderstatus") == "P", F.lit(" \t ")).otherwise(F.concat(F.lit(" "), "o_orderstatus"))
    rows = b.source("orders").select("o_orderkey", "o_orderdate", padded.alias("status"), "o_custkey")
    return landing.clean_text_table(rows)


S07_FILE = {"1-URGENT": "Claims_2024.csv", "2-HIGH": "out REINSURANCE.csv", "3-MEDIUM": "q1_solvency.csv"}


@query("s07_route_files")
def _(b: Bridge) -> DataFrame:
    name = cleaning.code_label(F.col("o_orderpriority"), S07_FILE, default="other.csv")
    rows = b.source("orders").select("o_orderkey", name.alias("source_file"))
    return rows.withColumn("route", landing.route_of(F.col("source_file")))


@query("s09_append_columns")
def _(b: Bridge) -> DataFrame:
    stored = b.source("customer").select(F.col("c_custkey").alias("record_id"), F.col("c_name").alias("client_name"))
    incoming = b.source("supplier").select(
        F.col("s_suppkey").alias("record_id"), F.col("s_name").alias("client_name"), F.col("s_nationkey").alias("branch_name")
    )
    return sinks.append_columns(stored, incoming)


@query("s10_latest_wins")
def _(b: Bridge) -> DataFrame:
    rows = b.source("events").select("user_id", "event_type", "ts", "event_id", "value")
    return upsert.latest_wins(rows, ["user_id", "event_type"], ["ts", "event_id"])


@query("s11_code_rows")
def _(b: Bridge) -> DataFrame:
    return reports.code_rows(b("financial_performance_api_response"))


@query("s12_json_long")
def _(b: Bridge) -> DataFrame:
    return reports.investment_rows(b("investment_activity_api_response"))


@query("s13_upsert_codes")
def _(b: Bridge) -> DataFrame:
    stored = reports.code_rows(b("financial_performance_api_response"))
    incoming = stored.filter(F.col("report_date") >= dt.date(2000, 1, 1)).select(
        "report_date",
        F.when(F.col("code") == "F320", "F999").otherwise(F.col("code")).alias("code"),
        (F.col("amount") + 1).cast(money.AMOUNT).alias("amount"),
    )
    return reports.upsert_codes(stored, incoming)


@query("s14_replace_slice")
def _(b: Bridge) -> DataFrame:
    orders = b.source("orders")
    date = F.col("o_orderdate").cast("date").alias("report_date")
    stored = orders.select(date, "o_orderkey", "o_orderstatus")
    incoming = orders.filter((F.col("o_orderstatus") == "P") & (F.col("o_orderpriority") == "1-URGENT")).select(
        date, (-F.col("o_orderkey")).alias("o_orderkey"), "o_orderstatus"
    )
    return upsert.replace_slice(stored, incoming, ["report_date"])


S15_CATALOG = [
    ("O_ORDERKEY", "NUMBER", 18, 0, "N"),
    ("O_CUSTKEY", "NUMBER", 9, 0, "Y"),
    ("O_ORDERSTATUS", "CHAR", None, None, "Y"),
    ("O_TOTALPRICE", "NUMBER", 15, 2, "Y"),
    ("O_ORDERDATE", "DATE", None, None, "Y"),
    ("O_ORDERPRIORITY", "VARCHAR2", None, None, "Y"),
]


@query("s15_typed_snapshot")
def _(b: Bridge) -> DataFrame:
    return snapshots.typed_snapshot(b.source("orders"), S15_CATALOG)


@query("s16_refresh_decision")
def _(b: Bridge) -> DataFrame:
    """Every customer stands for a table; its finished orders for the loads, all orders for the changes."""
    loaded = F.max(F.when(F.col("o_orderstatus") == "F", F.col("o_orderdate")))
    tables = b.source("orders").groupBy(F.col("o_custkey").alias("table_id")).agg(
        loaded.alias("target_loaded"),
        F.max("o_orderdate").alias("source_modified"),
        F.count("*").alias("n"),
    )
    has_modified = F.col("table_id") % 2 == 0
    decision = snapshots.refresh_decision(
        F.col("n") > 5, F.col("target_loaded"), has_modified, F.col("source_modified"), dt.datetime(2000, 12, 31)
    )
    return tables.select("table_id", decision.alias("decision"))


@query("s17_load_stamps")
def _(b: Bridge) -> DataFrame:
    stored = b.source("orders").select(F.col("o_orderdate").alias("etl_uploaded_date"))
    rows = b.source("customer").select("c_custkey", "c_name")
    return snapshots.stamp_load(rows, dt.datetime(2000, 12, 31, 8, 0), stored)


@query("s18_reconcile")
def _(b: Bridge) -> DataFrame:
    source = {t: b.source(t) for t in ("orders", "lineitem", "customer")}
    target = {
        "orders": b.source("orders").filter(F.col("o_orderstatus") == "F"),
        "lineitem": b.source("lineitem"),
        "part": b.source("part"),
    }
    return quality.reconcile(source, target)


@query("s19_profile")
def _(b: Bridge) -> DataFrame:
    return quality.profile(b.warehouse()["claims_portfolio"], catalog.CLAIMS_COLUMNS)


@query("s20_load_summary")
def _(b: Bridge) -> DataFrame:
    return quality.load_summary(_sparse(b), ["a", "b", "c"], "source_name")


@query("s21_month_end_calendar")
def _(b: Bridge) -> DataFrame:
    """Reports landed per back-filled month end; months without one show 0."""
    calendar = snapshots.month_end_calendar(b.spark, dt.date(1995, 1, 1), AS_OF)
    landed = b.source("orders").groupBy(dates.month_end(F.col("o_orderdate")).alias("report_date")).agg(
        F.count("*").alias("n_landed")
    )
    return calendar.join(landed, "report_date", "left").select("report_date", F.coalesce("n_landed", F.lit(0)).alias("n_landed"))


@query("s23_harmonised_headers")
def _(b: Bridge) -> DataFrame:
    old = b.source("orders").select(
        F.col("o_orderkey").alias("№"), F.col("o_custkey").alias("Класс"), F.col("o_orderstatus").alias("Класс ")
    )
    new = b.source("customer").select(
        F.col("c_custkey").alias("№ п/п"), F.col("c_nationkey").alias("Some Field!"), F.col("c_name").alias("Страхователь")
    )
    return landing.harmonised_union([old, new])


# ---- projection and filters --------------------------------------------------


@query("f01_rename")
def _(b: Bridge) -> DataFrame:
    return b("ins_invloan").select(
        F.col("ins_id").alias("loan_id"), F.col("loan_num").alias("loan_number"), F.col("loan_sum").alias("loan_amount")
    )


@query("f02_predicates")
def _(b: Bridge) -> DataFrame:
    """``<>`` leaves nulls out, as does a range on a null date."""
    rows = b("ins_bank_client")
    keep = ((F.col("bc_type") != 2) | (F.col("status") == 2)) & (
        F.col("pym_date").isNotNull() & (F.col("pym_date") >= dt.date(1999, 1, 1)) & (F.col("pym_date") < dt.date(2000, 1, 1))
    )
    return rows.filter(keep).select("ins_id", "bc_type", "status")


@query("f03_in_list")
def _(b: Bridge) -> DataFrame:
    return b("ins_polis").filter(F.col("tb_status").isin(catalog.GENERAL_POLICY_STATUSES)).select("tb_id", "tb_status")


F04_FLAGS = """
    SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN '1' WHEN 'O' THEN '2' WHEN 'P' THEN 'x' END AS flag_text, 1 + o_custkey % 2 AS flag_number
    FROM {orders}"""


@query("f04_flag_in")
def _(b: Bridge) -> DataFrame:
    rows = b.spark.sql(F04_FLAGS, orders=b.source("orders"))
    return rows.select(
        "o_orderkey",
        cleaning.flag_is(F.col("flag_text"), 1).alias("text_is_1"),
        cleaning.flag_is(F.col("flag_number"), 1).alias("number_is_1"),
    )


@query("f05_regex_guard")
def _(b: Bridge) -> DataFrame:
    code = F.col("kod_num")
    return b("ins_pturi").select("ins_id", cleaning.digits_in(code, catalog.COMPULSORY_PRODUCT_CODES).alias("compulsory"))


F06_WORDS = [("stand", "Compulsory"), ("pro", "Voluntary"), ("STANDARD", "never"), ("med", "Voluntary")]


@query("f06_ilike_class")
def _(b: Bridge) -> DataFrame:
    return b.source("part").select("p_partkey", cleaning.first_word_match(F.col("p_type"), F06_WORDS).alias("insurance_type"))


@query("f07_semi_join")
def _(b: Bridge) -> DataFrame:
    payments = b("ins_oplata").select("ins_id", "anketa_id")
    return payments.join(curated.policies_in_force(b), F.col("anketa_id") == F.col("_in_force"), "left_semi")


@query("f08_row_tags")
def _(b: Bridge) -> DataFrame:
    return b("ins_oplata").select("ins_id", F.lit(21).alias("source_query_id"), F.lit(catalog.SCENARIO).alias("scenario"))


@query("f09_typed_null")
def _(b: Bridge) -> DataFrame:
    return b("ins_rastorg").select("tb_polis", F.lit(None).cast(money.TOTAL).alias("insurance_profit_volume_uzs"))


# ---- joins -------------------------------------------------------------------


@query("j01_inner")
def _(b: Bridge) -> DataFrame:
    bank = b("ins_bank_client").select(F.col("ins_id").alias("bank_id"), "pym_date")
    return b("ins_oplata").join(bank, F.col("bc_id") == F.col("bank_id"), "inner").select("ins_id", "bank_id", "pym_date")


@query("j02_left_keys")
def _(b: Bridge) -> DataFrame:
    """Left join on two keys: loan balance per start month and partner beside deposits of the same."""
    def by_month(table: str, date: str, amount: str, name: str) -> DataFrame:
        return b(table).groupBy(dates.month_start(F.col(date)).alias("report_month"), "client_id").agg(F.sum(amount).alias(name))

    deposits = by_month("ins_invdep", "depdate_from", "dep_sum", "deposit_amount")
    loans = by_month("ins_invloan", "loandate_from", "loan_sum", "loan_amount")
    return deposits.join(loans, ["report_month", "client_id"], "left")


@query("j03_left_literal")
def _(b: Bridge) -> DataFrame:
    bank = b("ins_bank_client").filter(F.col("status") == 2).select(F.col("ins_id").alias("bank_id"), "pym_summa")
    return b("ins_oplata").join(bank, F.col("bc_id") == F.col("bank_id"), "left").select("ins_id", "bank_id", "pym_summa")


@query("j04_left_then_filter")
def _(b: Bridge) -> DataFrame:
    contracts = b("ins_anketa").select(F.col("ins_id").alias("contract_id"), "fizyur")
    joined = b("ins_oplata").join(contracts, F.col("anketa_id") == F.col("contract_id"), "left")
    return joined.filter(F.col("fizyur") == 1).select("ins_id", "contract_id")


def _product_measures(b: Bridge) -> list[tuple[DataFrame, dict]]:
    policies = b("ins_polis").select(F.col("tb_id").alias("policy"), F.col("pturi_id"))

    def by_product(table: str, key: str, date: str, amount: str, name: str):
        rows = b(table).join(policies, F.col(key) == F.col("policy"), "left")
        sums = rows.groupBy(F.year(date).alias("report_year"), "pturi_id").agg(F.sum(amount).alias("_sum"))
        return sums, {name: F.col("_sum")}

    return [
        by_product("ins_oplata", "polis_id", "opl_data", "oplata", "premium"),
        by_product("ins_viplati", "sobitie_id", "date_viplata", "viplate", "claims"),
        by_product("ins_rastorg", "tb_polis", "tb_dateras", "tb_summa", "terminated"),
    ]


@query("j05_full_merge")
def _(b: Bridge) -> DataFrame:
    return merge.merge_measures(_product_measures(b), ["report_year", "pturi_id"], null_keys="separate")


@query("j06_year_slices")
def _(b: Bridge) -> DataFrame:
    def year(y: int, name: str) -> DataFrame:
        rows = b.source("orders").filter(dates.year_range(F.col("o_orderdate"), y, y))
        return rows.groupBy("o_custkey").agg(F.sum(F.col("o_totalprice").cast(money.AMOUNT)).alias(name))

    return year(2000, "cy").join(year(1999, "py"), "o_custkey", "full").select(
        "o_custkey", F.coalesce("py", F.lit(0)).alias("py"), F.coalesce("cy", F.lit(0)).alias("cy")
    )


@query("j07_parameter_row")
def _(b: Bridge) -> DataFrame:
    """Year labels from the table itself, as scalar subqueries and not a cross join."""
    orders = b.source("orders")
    newest = orders.agg(F.max(F.year("o_orderdate"))).scalar()
    return orders.select("o_orderkey", (newest - 1).alias("prior_year"), newest.alias("current_year"))


@query("j08_active_interval")
def _(b: Bridge) -> DataFrame:
    first = active.first_month(b("ins_invdep"), "depdate_from")
    return active.active_balance(
        b("ins_invdep"), "depdate_from", "depdate_to", "dep_sum", ["val_type"], first, dt.date(2000, 12, 31)
    )


@query("j09_explode_months")
def _(b: Bridge) -> DataFrame:
    months = active.months_between(F.col("loandate_from"), F.col("loandate_to"), AS_OF)
    return b("ins_invloan").select("ins_id", F.explode(months).alias("month"))


@query("j10_semi_recovery")
def _(b: Bridge) -> DataFrame:
    matched = b("ins_regress_bank").select("bc_id")
    return b("ins_bank_client").join(matched, F.col("ins_id") == F.col("bc_id"), "left_semi").select("ins_id", "pym_summa")


@query("j11_quarter_spread")
def _(b: Bridge) -> DataFrame:
    w = b.warehouse()
    months = b.source("orders").select(
        dates.month_start(F.col("o_orderdate")).alias("report_month"), F.lit(catalog.SCENARIO).alias("scenario")
    ).distinct()
    return marts.spread_quarter(months, marts.solvency_quarterly(w), ["_actual", "_required"]).select(
        "report_month", "scenario", F.col("_actual").alias("actual"), F.col("_required").alias("required")
    )


@query("j12_fan_out")
def _(b: Bridge) -> DataFrame:
    return curated.motor_liability_rows(b)


@query("j12_fan_out_sums")
def _(b: Bridge) -> DataFrame:
    """The same sums without emitting the combinations."""
    sums = curated.motor_liability_sums(b)
    return sums.groupBy("payment_date").agg(F.sum("liability_amount").alias("liability_amount"))


# ---- aggregation, windows, order, sets ---------------------------------------


@query("a01_monthly_sum")
def _(b: Bridge) -> DataFrame:
    month = dates.month_start(F.col("contract_conclusion_date"))
    return b("reinsurance_outgoing_portfolio").groupBy(month.alias("report_month")).agg(
        F.sum("total_accrued_premium_uzs").alias("volume")
    )


@query("a02_group_by_expression")
def _(b: Bridge) -> DataFrame:
    partner = cleaning.first_filled(F.col("tb_orgname"), F.col("tb_name"), default=catalog.NO_PARTNER)
    return b("ins_kontragent").groupBy(partner.alias("bank_partner_name")).agg(F.count("*").alias("n"))


@query("a03_conditional_sum")
def _(b: Bridge) -> DataFrame:
    amount = F.col("total_accrued_premium_uzs")
    year = F.year("contract_conclusion_date")
    return b("reinsurance_incoming_portfolio").groupBy("insurance_type").agg(
        F.sum(F.when(year == 1999, amount).otherwise(0)).alias("volume_1999"),
        F.sum(F.when(year == 2000, amount).otherwise(0)).alias("volume_2000"),
    )


@query("a04_converted_sum")
def _(b: Bridge) -> DataFrame:
    paid = money.convert(F.col("opl_val"), F.col("oplata"), F.col("opl_summa"), money.rate_or_one(F.col("val_kurs")))
    return b("ins_oplata").groupBy(F.year("opl_data").alias("pay_year")).agg(F.sum(paid).alias("premium_uzs"))


@query("a05_min_max")
def _(b: Bridge) -> DataFrame:
    return b("ins_invdep").groupBy("val_type").agg(
        F.min("depdate_from").alias("first_start"), F.max("depdate_from").alias("last_start")
    )


@query("a06_count")
def _(b: Bridge) -> DataFrame:
    return b("ins_polis").groupBy("tb_status").agg(F.count("*").alias("n"))


@query("a07_distinct")
def _(b: Bridge) -> DataFrame:
    return b("ins_oplata").select(dates.month_start(F.col("opl_data")).alias("report_month"), "ins_type").distinct()


@query("a08_two_stage")
def _(b: Bridge) -> DataFrame:
    products = b.warehouse()["product_dimension"].select(F.col("pturi_id").alias("product"), "insurance_type", "category")
    sums, _ = _product_measures(b)[0]
    return sums.join(products, F.col("pturi_id") == F.col("product")).groupBy("report_year", "insurance_type", "category").agg(
        F.sum("_sum").alias("premium")
    )


@query("a09_global")
def _(b: Bridge) -> DataFrame:
    return b("ins_oplata").agg(F.sum("oplata").alias("total"), F.count("*").alias("n"), F.max("opl_data").alias("last_day"))


def _price_by_month(b: Bridge) -> DataFrame:
    return b.source("orders").groupBy("o_orderpriority", dates.month_start(F.col("o_orderdate")).alias("report_month")).agg(
        F.sum(F.col("o_totalprice").cast(money.AMOUNT)).alias("amount")
    )


@query("w01_lag_change")
def _(b: Bridge) -> DataFrame:
    change = windows.change_from_previous("amount", ["o_orderpriority"], "report_month")
    return _price_by_month(b).withColumn("change", change)


@query("w02_group_total")
def _(b: Bridge) -> DataFrame:
    rows = b("ins_invloan").select("ins_id", "client_id", "loan_sum")
    return windows.share_of_total(rows, ["client_id"], "loan_sum", "client_total", "share_pct").drop("share_pct")


@query("w03_share_of_total")
def _(b: Bridge) -> DataFrame:
    return windows.share_of_summed(_price_by_month(b), ["report_month"], "amount", "month_total", "share_pct")


@query("o01_report_order")
def _(b: Bridge) -> DataFrame:
    return ordering.report_order(_price_by_month(b), [("report_month", "desc"), ("o_orderpriority", "asc")])


@query("o02_order_by_case")
def _(b: Bridge) -> DataFrame:
    rows = b.warehouse()["product_dimension"].select("pturi_id", "insurance_type", "category", "product_name")
    return ordering.report_order(rows, report_sort("insurance_volume_indicators"))


@query("o03_preview")
def _(b: Bridge) -> DataFrame:
    rows = b.warehouse()["claims_portfolio"].select("record_id", "client_name", "payout_date", "payout_total")
    return ordering.preview(
        rows, [("payout_total", "desc"), ("record_id", "asc"), ("payout_date", "asc"), ("client_name", "asc")], 5
    )


@query("e01_union_all")
def _(b: Bridge) -> DataFrame:
    general = b("ins_oplata").select("ins_id", F.col("oplata").alias("amount"), F.lit(1).alias("source_query_id"))
    motor = b("tb_oplata").select(F.col("tb_id").alias("ins_id"), F.col("tb_summa").alias("amount"), F.lit(21).alias("source_query_id"))
    return general.unionByName(motor)


@query("e02_spine_union")
def _(b: Bridge) -> DataFrame:
    def keyed(table: str, date: str) -> DataFrame:
        return b(table).select(dates.month_start(F.col(date)).alias("report_month"), F.lit(catalog.SCENARIO).alias("scenario"))

    frames = [keyed("ins_oplata", "opl_data"), keyed("ins_bank_client", "pym_date"), keyed("ins_rastorg", "tb_dateras")]
    return merge.key_spine(frames, ["report_month", "scenario"])


@query("e02_spine_merge")
def _(b: Bridge) -> DataFrame:
    def keyed(table: str, date: str, amount: str, name: str):
        rows = b(table).withColumn("report_month", dates.month_start(F.col(date)))
        return rows, {name: F.col(amount)}

    return merge.merge_measures(
        [
            keyed("ins_oplata", "opl_data", "oplata", "paid"),
            keyed("ins_bank_client", "pym_date", "pym_summa", "banked"),
            keyed("ins_rastorg", "tb_dateras", "tb_summa", "terminated"),
        ],
        ["report_month"],
    )


@query("e03_expand_categories")
def _(b: Bridge) -> DataFrame:
    rows = b("ins_rastorg").select("tb_polis", "tb_summa", "vernut", "retention")
    parts = {"terminated": F.col("tb_summa"), "returned": F.col("vernut"), "retained": F.col("retention")}
    return merge.expand_categories(rows, parts, "category", "amount").select("tb_polis", "category", "amount")


# ---- scalar functions --------------------------------------------------------


@query("x01_clean_numeric")
def _(b: Bridge) -> DataFrame:
    return b("claims_portfolio").select("record_id", "payout_total", cleaning.clean_numeric(F.col("payout_total")).alias("amount"))


@query("x02_clean_date")
def _(b: Bridge) -> DataFrame:
    return b("claims_portfolio").select("record_id", "payout_date", cleaning.clean_date(F.col("payout_date")).alias("paid_on"))


@query("x03_to_date")
def _(b: Bridge) -> DataFrame:
    rows = b.source("orders").select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") == "P", F.lit("  "))
        .otherwise(F.concat(F.lit(" "), F.date_format("o_orderdate", "dd-MM-yyyy")))
        .alias("day_text"),
    )
    return rows.select("o_orderkey", cleaning.parse_day_first_date(F.col("day_text")).alias("report_date"))


@query("x04_text_chain")
def _(b: Bridge) -> DataFrame:
    label = cleaning.first_filled(F.col("tb_orgname"), F.col("tb_name"), default=catalog.NO_PARTNER)
    return b("ins_kontragent").select("tb_id", label.alias("partner"))


@query("x05_regex_text")
def _(b: Bridge) -> DataFrame:
    number = F.regexp_extract(F.replace(F.col("c_name"), F.lit("#"), F.lit(" ")), "([0-9]+)", 1)
    return b.source("customer").select("c_custkey", number.alias("digits"))


@query("x06_month_start")
def _(b: Bridge) -> DataFrame:
    return b.source("orders").select("o_orderkey", dates.month_start(F.col("o_orderdate")).alias("report_month"))


@query("x07_month_end")
def _(b: Bridge) -> DataFrame:
    ts = F.col("ts")
    return b.source("events").select(
        "event_id", dates.month_end(ts).alias("month_end"), dates.month_end_at_or_after(ts).alias("first_month_end")
    )


@query("x08_year_quarter")
def _(b: Bridge) -> DataFrame:
    d = F.col("o_orderdate")
    return b.source("orders").select("o_orderkey", F.year(d).alias("report_year"), F.quarter(d).alias("report_quarter"))


@query("x09_as_of")
def _(b: Bridge) -> DataFrame:
    """The run date is a parameter, so the result does not depend on the clock."""
    age = F.datediff(F.lit(AS_OF), F.col("o_orderdate").cast("date"))
    return b.source("orders").select("o_orderkey", age.alias("age_days"))


@query("x10_month_spine")
def _(b: Bridge) -> DataFrame:
    return active.month_spine(b("ins_invdep"), "depdate_from", dt.date(2000, 12, 31))


@query("x11_code_label")
def _(b: Bridge) -> DataFrame:
    return b("ins_invloan").select("ins_id", cleaning.code_label(F.col("status"), catalog.LOAN_STATUS, "").alias("loan_status"))


@query("x12_round_half_up")
def _(b: Bridge) -> DataFrame:
    exact = F.col("l_extendedprice").cast("decimal(22,2)") * F.lit(Decimal("0.125"))
    return b.source("lineitem").groupBy("l_orderkey").agg(F.sum(F.round(exact, 2)).alias("rounded"))


@query("x13_scaled_arithmetic")
def _(b: Bridge) -> DataFrame:
    total = F.col("o_totalprice").cast(money.AMOUNT)
    thousands = total * F.lit(Decimal("0.001"))
    return b.source("orders").select("o_orderkey", thousands.alias("thousands"), (total * 2 - thousands).alias("mixed"))


@query("x14_guarded_ratio")
def _(b: Bridge) -> DataFrame:
    sums = b("ins_invloan_accrual").groupBy("loan_id").agg(F.sum("amount").alias("payable"))
    paid = b("ins_invloan_oplata").groupBy(F.col("loan_id").alias("paid_id")).agg(F.sum("amount").alias("paid"))
    rows = sums.join(paid, F.col("loan_id") == F.col("paid_id"), "left")
    num, den = F.coalesce("paid", F.lit(0)), F.col("payable")
    return rows.select(
        "loan_id",
        ratios.ratio_or_zero(num, den).alias("or_zero"),
        ratios.ratio_or_null(num, den).alias("or_null"),
        ratios.ratio_if_positive(num, den).alias("if_positive"),
    )


@query("x15_json_value")
def _(b: Bridge) -> DataFrame:
    body = json_values.report_body(F.col("payload_json"), "$.OperationResult.Balance")
    return b("balance_sheet_api_response").select(
        "report_date",
        json_values.report_number(body, "A490").alias("total_assets"),
        json_values.report_text(body, "P590").cast("decimal(22,4)").alias("upr"),
        json_values.report_number(body, "P999").alias("missing"),
    )


@query("x16_json_array")
def _(b: Bridge) -> DataFrame:
    body = json_values.report_body(F.col("payload_json"), "$.OperationResult")
    items = b("investment_activity_api_response").select("report_date", F.explode(json_values.report_items(body, "Bonds")).alias("v"))
    return items.select(
        "report_date",
        F.try_variant_get("v", "$.partner", "string").alias("partner"),
        json_values.report_number(F.col("v"), "amount").alias("amount"),
    )


@query("x17_casts")
def _(b: Bridge) -> DataFrame:
    price = F.col("p_retailprice").cast("decimal(22,2)")
    return b.source("part").select(
        "p_partkey",
        price.alias("amount"),
        F.col("p_size").cast("string").alias("size_text"),
        F.regexp_extract("p_brand", "([0-9]+)", 1).try_cast("int").alias("brand_number"),
        F.col("p_type").try_cast("int").alias("not_a_number"),
    )


@query("x18_fx_convert")
def _(b: Bridge) -> DataFrame:
    stored = money.rate_or_one(F.col("val_kurs"))
    return b("ins_oplata").select(
        "ins_id", money.convert(F.col("opl_val"), F.col("kommis_summa"), F.col("kommis_summa"), stored).alias("commission")
    )


# ---- lookups -----------------------------------------------------------------


@query("u01_asof_fx")
def _(b: Bridge) -> DataFrame:
    payments = b("ins_oplata").select("ins_id", "opl_val", "opl_data")
    return asof.with_rate(payments, b("ins_kurs"), "opl_val", "opl_data")


def _lookup(b: Bridge, table: str, key: str, dim: str, dim_key: str, value, name: str) -> DataFrame:
    return lookup.lookup_value(b(table).select("ins_id", key), F.col(key), b(dim), dim_key, value, name)


@query("u02_partner_name")
def _(b: Bridge) -> DataFrame:
    return _lookup(b, "ins_anketa", "owner", "ins_kontragent", "tb_id", curated.partner_name(), "partner_name")


@query("u03_currency_label")
def _(b: Bridge) -> DataFrame:
    return _lookup(b, "ins_invloan", "val_type", "p_sp_currency", "sp_id", F.col("name"), "currency_type")


def _loan_sums(b: Bridge, table: str, name: str) -> DataFrame:
    sums = b(table).groupBy(F.col("loan_id").alias("_loan")).agg(F.sum("amount").alias(name))
    return b("ins_invloan").join(sums, F.col("ins_id") == F.col("_loan"), "left").select("ins_id", name)


@query("u04_loan_paid")
def _(b: Bridge) -> DataFrame:
    return _loan_sums(b, "ins_invloan_oplata", "paid_amount")


@query("u05_loan_payable")
def _(b: Bridge) -> DataFrame:
    return _loan_sums(b, "ins_invloan_accrual", "payable_amount")


@query("u06_try_cast_date")
def _(b: Bridge) -> DataFrame:
    text = F.concat_ws("-", F.col("l_orderkey") % 3000, F.col("l_linenumber") * 3, F.col("l_partkey") % 40)
    padded = F.when(F.col("l_linenumber") == 2, F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss")).otherwise(text)
    rows = b.source("lineitem").select("l_orderkey", padded.alias("day_text"))
    return rows.select("l_orderkey", "day_text", cleaning.clean_date(F.col("day_text")).alias("day"))


# ---- quality -----------------------------------------------------------------


@query("q01_unique")
def _(b: Bridge) -> DataFrame:
    return quality.unique_violations(b("ins_oplata"), "ins_id")


@query("q02_not_null")
def _(b: Bridge) -> DataFrame:
    return quality.null_violations(b("ins_bank_client"), "pym_date").select("ins_id")


@query("q04_unfit_amounts")
def _(b: Bridge) -> DataFrame:
    """Amount texts, some of them too long for an amount."""
    long = F.repeat(F.col("o_orderkey").cast("string"), F.lit(5))
    texts = b.source("orders").select(F.col("o_totalprice").cast("string").alias("price"), long.alias("long"))
    return quality.unfit_amounts(texts, ["price", "long"], money.AMOUNT)


@query("q03_premium_total")
def _(b: Bridge) -> DataFrame:
    return curated.premium_total(b, dt.date(2000, 1, 1), dt.date(2000, 4, 1))


# ---- stored and streamed tables ----------------------------------------------


def _new_folder(b: Bridge, name: str) -> str:
    """A new folder among the shared ones of the session, removed when the application ends."""
    alone = b.spark.sparkContext.master.startswith("local")  # without a cluster any folder is shared
    shared = checkpoint_dir(b.spark, b.spark.conf.get("spark.sql.warehouse.dir") if alone else None)
    path = f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    place = b.spark._jvm.org.apache.hadoop.fs.Path(path)
    conf = b.spark._jsparkSession.sessionState().newHadoopConf()
    place.getFileSystem(conf).deleteOnExit(place)
    return path


@query("s08_drop_folder")
def _(b: Bridge) -> DataFrame:
    """Orders landed as headerless files, picked up by a stream; a second run finds nothing new."""
    root = _new_folder(b, "drop-folder")
    b.source("orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority").write.csv(f"{root}/drop")
    for _ in range(2):
        raw = loads.landing_stream(b.spark, f"{root}/drop", 3)
        rows = landing.positional(raw, catalog.CLAIMS_COLUMNS[:3], catalog.HEADER_ROWS["claims"], keep=("row_no",))
        loads.append_stream(rows, f"{root}/table", f"{root}/state").awaitTermination()
    return b.spark.read.parquet(f"{root}/table")


def _land_files(b: Bridge, rows: DataFrame, folder: str, prefix: str) -> None:
    """Rows as headerless files whose names begin with a prefix."""
    written = f"{folder}-{prefix}written"
    rows.write.csv(written)
    path = b.spark._jvm.org.apache.hadoop.fs.Path
    store = path(folder).getFileSystem(b.spark._jsparkSession.sessionState().newHadoopConf())
    store.mkdirs(path(folder))
    for name in sinks.folder_names(b.spark, written):
        store.rename(path(f"{written}/{name}"), path(f"{folder}/{prefix}{name}"))


@query("s08_quarantine")
def _(b: Bridge) -> DataFrame:
    """Orders in routed files, some without a row number, and customers in files without a route:
    what was loaded, what was not a row, and what was left where it is, after two runs."""
    root = _new_folder(b, "quarantine")
    number = F.when(F.col("o_orderpriority") == "5-LOW", F.concat(F.lit("n"), F.col("o_orderkey")))
    number = F.coalesce(number, (F.col("o_orderkey") + 10).cast("string"))
    _land_files(b, b.source("orders").select(number, "o_orderkey", "o_orderstatus"), f"{root}/drop", "Claims_")
    _land_files(b, b.source("customer").select("c_custkey", "c_name"), f"{root}/drop", "notes_")
    for _ in range(2):
        loads.load_drop_folder(b.spark, f"{root}/drop", f"{root}/table", f"{root}/state").awaitTermination()
    loaded = b.spark.read.parquet(f"{root}/table").select(F.lit("loaded").alias("kind"), F.col("record_id").alias("value"))
    lost = b.spark.read.parquet(f"{root}/table_quarantine/rows").select(F.lit("not a row"), F.split("text", ",")[0])
    left = b.spark.read.parquet(f"{root}/table_quarantine/files").select(
        F.lit("left"), F.regexp_extract("source_file", "^[a-z]+_", 0)
    )
    return loaded.union(lost).union(left.distinct())


@query("s20_observed_load")
def _(b: Bridge) -> DataFrame:
    """The load summary as the write itself observed it."""
    columns, names, counted = ["a", "b", "c"], ["A", "N", "R"], Observation()
    metrics = quality.load_metrics(columns, "source_name", names)
    read = _sparse(b).observe(counted, *(m.alias(k) for k, m in metrics.items()))
    sinks.write_snapshot(landing.drop_empty(read, columns), _new_folder(b, "observed"))
    return quality.observed_summary(b.spark, counted.get, "source_name", names)


@query("s05_rejected_values")
def _(b: Bridge) -> DataFrame:
    """The side table of what typed columns could not hold, filled by two runs of one load."""
    raw, root = b.spark.sql(S05_TEXT, lineitem=b.source("lineitem")), _new_folder(b, "rejected")
    columns = ["contract_start_date", "insurance_days_count", "insurance_premium_policy", "region"]
    rows = landing.clean_typed_rows(raw, columns, keep=("row_key",))
    for _ in range(2):
        seen = sinks.write_snapshot(rows, f"{root}/table", rejected=rejected.rejected_count())
        stored = sinks.read_snapshot_table(b.spark, f"{root}/table", rows.schema)
        rejected.keep_rejected(stored, f"{root}/side", "lineitem", ["row_key"], seen["rejected"])
    return rejected.read_rejected(b.spark, f"{root}/side")


COPIED = {
    "orders": [
        ("O_ORDERKEY", "NUMBER", 18, 0, "N"),
        ("O_ORDERSTATUS", "CHAR", None, None, "Y"),
        ("O_TOTALPRICE", "NUMBER", 7, 2, "Y"),
        ("O_ORDERDATE", "DATE", None, None, "N"),
    ],
    "customer": [("C_NAME", "VARCHAR2", None, None, "N"), ("C_CUSTKEY", "NUMBER", 9, 0, "N")],
}


@query("s15_catalog_copy")
def _(b: Bridge) -> DataFrame:
    """Two tables copied by their catalog, and again after one hour and after two days."""
    root, start = _new_folder(b, "copies"), dt.datetime(2000, 12, 31, 8)
    runs = [
        jobs.copy_tables(b.spark, COPIED, b.source, root, start + dt.timedelta(hours=h)).withColumn("hour", F.lit(h))
        for h in (0, 1, 49)
    ]
    return reduce(DataFrame.unionByName, runs)


@query("s22_stored_model")
def _(b: Bridge) -> DataFrame:
    """A mart read back from storage, computed from a stored curated table."""
    w, root = b.warehouse(), _new_folder(b, "stored-model")
    w.save("terminated_contracts", root)
    monthly = w["terminated_contracts"].groupBy(dates.month_start(F.col("termination_date")).alias("report_month")).agg(
        F.sum("terminated_amount").alias("terminated_amount"), F.count("*").alias("n")
    )
    sinks.write_slices(monthly, f"{root}/monthly", "report_month")
    return b.spark.read.parquet(f"{root}/monthly")


@query("s22_staged_premium")
def _(b: Bridge) -> DataFrame:
    """Monthly premium over raw tables that are bucketed by contract and partitioned by month."""
    names = [*layout.CONTRACT_KEYS, "ins_bank_client", "ins_kurs"]
    staged = layout.stage(b, names, b.spark, _new_folder(b, "staged"))
    month = dates.month_start(F.col("payment_date")).alias("report_month")
    sums = [F.sum(c).alias(c) for c in ("premium_amount", "liability_amount")]
    return curated.premium_sums(staged).groupBy(month).agg(*sums)


@query("s22_month_range")
def _(b: Bridge) -> DataFrame:
    """Half a year of commissions, read from a table stored by month that holds all of them."""
    w = b.warehouse()
    w.save("agency_commissions", _new_folder(b, "months"))
    return w.between("agency_commissions", dt.date(1997, 1, 1), dt.date(1997, 7, 1))


@query("t02_latest_per_date")
def _(b: Bridge) -> DataFrame:
    """Events as a file stream, kept at the newest event of each day."""
    root = _new_folder(b, "latest-per-date")
    # A glob, because a stream takes a folder or a pattern and the table may be one file.
    events = b.spark.readStream.schema(SCHEMAS["events"]).parquet(f"{b.sf_dir}/[e]vents.parquet")
    rows = events.select(F.to_date("ts").alias("report_date"), "event_id", "ts", "user_id", "event_type")
    loads.latest_per_date_stream(rows, f"{root}/table", f"{root}/state", ["ts", "event_id"]).awaitTermination()
    return b.spark.read.parquet(f"{root}/table")
