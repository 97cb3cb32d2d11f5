"""KPI marts. Each takes the warehouse ``w`` and reads curated models from it.

Measures of one mart are merged in a single aggregation (``merge_measures``), and sums
are taken before any dimension is joined, so the joins see months, not payments.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from coverledger import catalog
from coverledger.functions import money
from coverledger.functions.cleaning import code_label, first_filled, first_word_match, flag_is
from coverledger.functions.dates import month_end, month_start, year_range
from coverledger.functions.ratios import ratio_if_positive, ratio_or_null, ratio_or_zero
from coverledger.operators.active import active_balance, first_month, month_spine
from coverledger.operators.merge import expand_categories, merge_measures
from coverledger.operators.windows import change_from_previous
from coverledger.plans import curated


def _scenario():
    return F.lit(catalog.SCENARIO).alias("scenario")


def _zero(name: str):
    return F.coalesce(F.col(name), F.lit(0))


# ---- report-based marts ------------------------------------------------------


def financial_kpi(w) -> DataFrame:
    """Return on assets and on equity per report date; null where the base is 0."""
    fp = w.columns("financial_performance", "report_date", "net_profit").alias("fp")
    bs = w.columns("balance_sheet", "report_date", "total_assets_final", "equity", "retained_earnings").alias("bs")
    profit = F.col("fp.net_profit")
    return fp.join(bs, F.col("fp.report_date") == F.col("bs.report_date"), "inner").select(
        F.col("fp.report_date").alias("report_date"),
        profit.alias("net_profit"),
        ratio_or_null(profit, F.col("bs.total_assets_final")).alias("roa"),
        ratio_or_null(profit, F.col("bs.equity") + F.col("bs.retained_earnings")).alias("roe"),
        F.col("fp.scenario").alias("scenario"),
    )


def _monthly_sums(w, name: str, sums: dict[str, str]) -> DataFrame:
    return (
        w.columns(name, "report_date", *sums.values())
        .filter(F.col("report_date").isNotNull())
        .groupBy(month_start(F.col("report_date")).alias("report_month"), "scenario")
        .agg(*[F.sum(c).alias(n) for n, c in sums.items()])
    )


def insurance_reserves_monthly(w) -> DataFrame:
    sums = _monthly_sums(
        w,
        "balance_sheet",
        {
            "upr": "unearned_premium_reserve",
            "ibnr": "ibnr_reserve",
            "rbns": "rbns_reserve",
            "_base": "stabilization_reserve_base",
            "_additional": "stabilization_reserve_additional",
            "total_assets": "total_assets_final",
            "total_reserves_denominator": "total_equity_reserves",
        },
    )
    return sums.select(
        "report_month",
        "scenario",
        "upr",
        "ibnr",
        "rbns",
        (F.col("upr") + F.col("ibnr") + F.col("rbns")).alias("calculated_p580_check"),
        (_zero("_base") + _zero("_additional")).alias("stabilization_reserve"),
        (ratio_or_zero(_zero("total_assets"), _zero("total_reserves_denominator")) * 100.0).alias(
            "allocated_assets_to_reserves_pct"
        ),
        "total_assets",
        "total_reserves_denominator",
    )


def operational_efficiency_monthly(w) -> DataFrame:
    sums = _monthly_sums(
        w,
        "financial_performance",
        {"_f090": "period_expenses", "_f060": "operating_income", "_f140": "financial_income"},
    )
    income = _zero("_f060") + _zero("_f140")
    return sums.select(
        "report_month",
        "scenario",
        _zero("_f090").alias("operating_expenses_sum"),
        income.alias("operating_income_sum"),
        (ratio_or_zero(_zero("_f090"), income) * 100.0).alias("cir_pct"),
        _zero("_f090").alias("total_expenses_f090"),
        _zero("_f060").alias("total_revenue_f060"),
        _zero("_f140").alias("financial_income_f140"),
    )


def _dated(w, name: str, date: str, *amounts: str) -> DataFrame:
    """Amounts of a curated model by month, rows without a date left out."""
    rows = w.columns(name, date, *amounts).filter(F.col(date).isNotNull())
    return rows.select(month_start(F.col(date)).alias("report_month"), "scenario", *amounts)


def _ratio_sources(w) -> list[tuple[DataFrame, dict]]:
    """Measures behind the ratios, premium aside."""
    balance = _monthly_sums(
        w, "balance_sheet", {"_p610": "rbns_reserve", "_p590": "unearned_premium_reserve"}
    ).withColumn("_change", change_from_previous("_p590", ["scenario"], "report_month"))
    performance = {
        "premium_f011": "premium_income",
        "premium_f013": "other_premium_income",
        "reinsurance_f012": "reinsurance_premium_ceded",
        "expenses_f070": "costs_of_goods_sold",
        "expenses_f090": "period_expenses",
    }
    return [
        (balance, {"p610_reserve": F.col("_p610"), "p590_change": F.col("_change")}),
        (
            _dated(w, "financial_performance", "report_date", *performance.values()),
            {n: F.col(c) for n, c in performance.items()},
        ),
        (_dated(w, "claims_portfolio", "payout_date", "payout_total"), {"claims_payout": F.col("payout_total")}),
        (
            _dated(w, "reinsurance_outgoing", "contract_conclusion_date", "total_accrued_premium_uzs"),
            {"outward_ceded_premium": F.col("total_accrued_premium_uzs")},
        ),
    ]


def _premium_amounts(w) -> DataFrame:
    """Premiums by date where no one reads the liabilities; from the stored sums if there are any."""
    return w["premium_sums"] if w.stored("premium_sums") else curated.premium_amounts(w.raw)


def _premium_by_month(w) -> DataFrame:
    return w["premium_sums"].select(
        month_start(F.col("payment_date")).alias("report_month"), _scenario(), "premium_amount", "liability_amount"
    )


def _with_earned_premium(merged: DataFrame) -> DataFrame:
    return merged.withColumn(
        "denominator_net_earned_premium",
        (F.col("premium_f011") + F.col("premium_f013") - F.col("reinsurance_f012")) - F.col("p590_change"),
    )


def _loss_ratio():
    claims = F.col("claims_payout") + F.col("p610_reserve")
    return ratio_or_zero(claims, F.col("denominator_net_earned_premium")) * 100.0


def financial_ratios_monthly(w) -> DataFrame:
    """Loss, expense, combined and reinsurance ratios on one month spine."""
    premium = _premium_amounts(w).filter(F.col("payment_date").isNotNull()).select(
        month_start(F.col("payment_date")).alias("report_month"), _scenario(), "premium_amount"
    )
    merged = merge_measures(
        [*_ratio_sources(w), (premium, {"premium_written": F.col("premium_amount")})], ["report_month", "scenario"]
    )
    expenses = F.col("expenses_f070") + F.col("expenses_f090")
    expense = ratio_or_zero(expenses, F.col("denominator_net_earned_premium")) * 100.0
    return _with_earned_premium(merged).select(
        "report_month",
        "scenario",
        _loss_ratio().alias("loss_ratio_pct"),
        expense.alias("expense_ratio_pct"),
        (_loss_ratio() + expense).alias("combined_ratio_pct"),
        (ratio_or_zero(F.col("outward_ceded_premium"), F.col("premium_written")) * 100.0).alias("reinsurance_level_pct"),
        "claims_payout",
        "p610_reserve",
        "premium_f011",
        "premium_f013",
        "reinsurance_f012",
        "p590_change",
        "expenses_f070",
        "expenses_f090",
        "outward_ceded_premium",
        "premium_written",
        "denominator_net_earned_premium",
    )


def spread_quarter(months: DataFrame, quarterly: DataFrame, values: list[str]) -> DataFrame:
    """Repeat quarterly values on every month of the quarter; both keep the scenario."""
    q = quarterly.select(
        F.col("report_year").alias("_y"), F.col("report_quarter").alias("_q"), F.col("scenario").alias("_s"), *values
    )
    match = (
        (F.year("report_month") == F.col("_y"))
        & (F.quarter("report_month") == F.col("_q"))
        & (F.col("scenario") == F.col("_s"))
    )
    return months.join(q, match, "left").select(*months.columns, *values)


def solvency_quarterly(w) -> DataFrame:
    return (
        w["solvency_adequacy_ratio"]
        .filter(F.col("report_date").isNotNull())
        .groupBy(F.year("report_date").alias("report_year"), F.quarter("report_date").alias("report_quarter"), "scenario")
        .agg(
            F.max("actual_solvency_margin_adequacy_ratio").alias("_actual"),
            F.max("required_solvency_margin_adequacy_ratio").alias("_required"),
        )
    )


def financial_stability_monthly(w) -> DataFrame:
    """Cash-to-claims per month and the quarter's solvency ratio on each of its months."""
    months = merge_measures(
        [
            (
                _dated(w, "balance_sheet", "report_date", "other_long_term_assets_two"),
                {"cash_and_equivalents_a410": F.col("other_long_term_assets_two")},
            ),
            (_dated(w, "claims_portfolio", "payout_date", "payout_total"), {"total_claims_incurred": F.col("payout_total")}),
        ],
        ["report_month", "scenario"],
    )
    return spread_quarter(months, solvency_quarterly(w), ["_actual", "_required"]).select(
        "report_month",
        "scenario",
        "cash_and_equivalents_a410",
        "total_claims_incurred",
        ratio_or_zero(F.col("cash_and_equivalents_a410"), F.col("total_claims_incurred")).alias(
            "cash_to_claims_ratio_actual"
        ),
        F.lit(catalog.REQUIRED_CASH_TO_CLAIMS).alias("cash_to_claims_ratio_required"),
        _zero("_actual").alias("solvency_margin_adequacy_ratio_actual"),
        _zero("_required").alias("solvency_margin_adequacy_ratio_required"),
    )


# ---- commissions, recoveries, partners ---------------------------------------


def agency_commissions_monthly(w) -> DataFrame:
    """Monthly commission: all, legal entities (flag 1) and individuals (flag 2).

    The partner join only repeats sums where partner keys repeat; with keys proven unique
    it is skipped. Else sums shrink per month, flag and partner before it.
    """
    sums = (
        w["commission_rows"]
        .filter(F.col("commission_date").isNotNull())
        .groupBy(month_start(F.col("commission_date")).alias("report_month"), "entity_type_flag", "partner_id")
        .agg(F.sum("commission_amount_uzs").alias("_sum"))
    )
    rows = sums if w.registry_keys_unique else curated.with_partner(sums, w.raw)

    def part(flag: int):
        return F.coalesce(
            F.sum(F.when(flag_is(F.col("entity_type_flag"), flag), F.col("_sum")).otherwise(F.lit(0))), F.lit(0)
        )

    return (
        rows.groupBy("report_month")
        .agg(
            F.coalesce(F.sum("_sum"), F.lit(0)).alias("total_commission_volume_uzs"),
            part(1).alias("legal_entity_commission_volume_uzs"),
            part(2).alias("individual_commission_volume_uzs"),
        )
        .withColumn("scenario", _scenario())
    )


def subrogation_indicators_monthly(w) -> DataFrame:
    return (
        w["subrogation_recoveries"]
        .groupBy(month_start(F.col("recovery_payment_date")).alias("report_month"))
        .agg(
            F.coalesce(F.sum("total_recovery_amount"), F.lit(0)).alias("total_subrogation_volume_uzs"),
            F.coalesce(F.sum("exact_recovery_amount"), F.lit(0)).alias("exact_subrogation_volume_uzs"),
            F.coalesce(F.sum("undefined_recovery_amount"), F.lit(0)).alias("undefined_subrogation_volume_uzs"),
        )
        .withColumn("scenario", _scenario())
    )


def premium_by_partner(w) -> DataFrame:
    """Premium per month and partner name: sums shrink before the partner join."""
    if not w.stored("premium_sums"):
        by_owner = (
            curated.premium_amounts_by_owner(w.raw)
            .groupBy(month_start(F.col("payment_date")).alias("report_month"), "partner_id")
            .agg(F.sum("premium_amount").alias("_sum"))
        )
        return curated.with_partner(by_owner, w.raw)
    by_contract = (
        w["premium_sums"]
        .groupBy(month_start(F.col("payment_date")).alias("report_month"), "anketa_id")
        .agg(F.sum("premium_amount").alias("_sum"))
    )
    contracts = w.raw("ins_anketa").select(F.col("ins_id").alias("_contract"), F.col("owner").alias("partner_id"))
    by_owner = (
        by_contract.join(contracts, F.col("anketa_id") == F.col("_contract"), "left")
        .groupBy("report_month", "partner_id")
        .agg(F.sum("_sum").alias("_sum"))
    )
    return curated.with_partner(by_owner, w.raw)


def bank_partner_performance_monthly(w) -> DataFrame:
    """Premium, commission, claims and exact recovery per month and partner."""
    commission = (
        w["commission_rows"]
        .groupBy(month_start(F.col("commission_date")).alias("report_month"), "partner_id")
        .agg(F.sum("commission_amount_uzs").alias("_sum"))
    )
    claims = w.columns("claims_portfolio", "payout_date", "client_name", "payout_total").select(
        month_start(F.col("payout_date")).alias("report_month"),
        F.coalesce("client_name", F.lit(catalog.NO_PARTNER)).alias("bank_partner_name"),
        "payout_total",
    )
    recoveries = w["subrogation_recoveries"].select(
        month_start(F.col("recovery_payment_date")).alias("report_month"),
        F.lit(catalog.RECOVERY_PARTNER).alias("bank_partner_name"),
        "exact_recovery_amount",
    )
    merged = merge_measures(
        [
            (premium_by_partner(w), {"insurance_premium_volume_uzs": F.col("_sum")}),
            (curated.with_partner(commission, w.raw), {"agency_commission_volume_uzs": F.col("_sum")}),
            (claims, {"insurance_claims_volume_uzs": F.col("payout_total")}),
            (recoveries, {"recovery_from_bank_uzs": F.col("exact_recovery_amount")}),
        ],
        ["report_month", "bank_partner_name"],
    )
    return merged.select(
        "report_month",
        "bank_partner_name",
        "insurance_premium_volume_uzs",
        "agency_commission_volume_uzs",
        "insurance_claims_volume_uzs",
        F.lit(None).cast(money.TOTAL).alias("insurance_profit_volume_uzs"),
        "recovery_from_bank_uzs",
        F.lit(None).cast(money.TOTAL).alias("avg_recovery_processing_time_days"),
    )


# ---- operations and reinsurance ----------------------------------------------


def insurance_operations_monthly(w) -> DataFrame:
    """Premium, liability, claims, loss ratio and terminations on one month spine.

    Claims and the loss ratio are those of the ratios mart. Where that mart is stored
    they are read from it; otherwise its measures join the same aggregation, so the
    payments are scanned once for both.
    """
    ended = w["terminated_contracts"].select(
        month_start(F.col("termination_date")).alias("report_month"), _scenario(), "terminated_amount"
    )
    premium = {
        "insurance_premium_volume_uzs": F.col("premium_amount"),
        "insurance_liabilities_volume_uzs": F.col("liability_amount"),
    }
    sources = [
        (_premium_by_month(w), premium),
        (ended, {"terminated_contracts_volume_uzs": F.col("terminated_amount")}),
    ]
    if w.stored("financial_ratios_monthly"):
        ratios = {"claims_payout": F.col("claims_payout"), "loss_ratio_pct": F.col("loss_ratio_pct")}
        merged = merge_measures([*sources, (w["financial_ratios_monthly"], ratios)], ["report_month", "scenario"])
        loss = F.col("loss_ratio_pct")
    else:
        merged = _with_earned_premium(merge_measures([*sources, *_ratio_sources(w)], ["report_month", "scenario"]))
        loss = _loss_ratio()
    return merged.select(
        "report_month",
        "scenario",
        "insurance_premium_volume_uzs",
        F.col("claims_payout").alias("insurance_claims_volume_uzs"),
        loss.alias("loss_ratio_pct"),
        "insurance_liabilities_volume_uzs",
        "terminated_contracts_volume_uzs",
    )


def premium_monthly(w) -> DataFrame:
    """The premium column of the operations mart, read from that mart where it is stored."""
    if w.stored("insurance_operations_monthly"):
        return w["insurance_operations_monthly"].select("report_month", "scenario", "insurance_premium_volume_uzs")
    return (
        _premium_amounts(w)
        .groupBy(month_start(F.col("payment_date")).alias("report_month"))
        .agg(F.coalesce(F.sum("premium_amount"), F.lit(0)).alias("insurance_premium_volume_uzs"))
        .withColumn("scenario", _scenario())
    )


def reinsurance_monthly(w) -> DataFrame:
    """Premium ceded and assumed per month and the ceded level against written premium."""

    def by_month(name: str) -> DataFrame:
        return _dated(w, name, "contract_conclusion_date", "total_accrued_premium_uzs")

    amount = F.col("total_accrued_premium_uzs")
    volumes = merge_measures(
        [
            (by_month("reinsurance_incoming"), {"incoming_reinsurance_volume_uzs": amount}),
            (by_month("reinsurance_outgoing"), {"outgoing_reinsurance_volume_uzs": amount}),
        ],
        ["report_month"],
    )
    premium = premium_monthly(w).filter(F.col("scenario") == catalog.SCENARIO).select(
        F.col("report_month").alias("_month"), "insurance_premium_volume_uzs"
    )
    level = ratio_if_positive(F.col("outgoing_reinsurance_volume_uzs"), _zero("insurance_premium_volume_uzs"))
    return volumes.join(premium, F.col("report_month") == F.col("_month"), "left").select(
        "report_month",
        _scenario(),
        "incoming_reinsurance_volume_uzs",
        "outgoing_reinsurance_volume_uzs",
        (level * 100.0).alias("reinsurance_level_pct"),
    )


def _reinsurance_years(w, keys: dict[str, tuple], read: list[tuple[str, ...]]) -> DataFrame:
    """Ceded and assumed premium of two years side by side, in billions, with the change in %."""
    first, second = w.reinsurance_years
    names = list(keys)

    def source(table: str, side: int, prefix: str):
        df = w.columns(table, "contract_conclusion_date", "total_accrued_premium_uzs", *read[side])
        df = df.filter(F.col("contract_conclusion_date").isNotNull())
        df = df.withColumns({k: exprs[side] for k, exprs in keys.items()})
        year = F.year("contract_conclusion_date")
        amounts = {
            f"_{prefix}_{y}": F.when(year == y, F.col("total_accrued_premium_uzs")) for y in (first, second)
        }
        return df, amounts

    merged = merge_measures([source("reinsurance_outgoing", 0, "out"), source("reinsurance_incoming", 1, "in")], names)
    out = []
    for prefix, label in (("out", "outgoing"), ("in", "incoming")):
        old, new = F.col(f"_{prefix}_{first}"), F.col(f"_{prefix}_{second}")
        out += [
            money.billions(old).alias(f"{label}_volume_{first}_bn_uzs"),
            money.billions(new).alias(f"{label}_volume_{second}_bn_uzs"),
            (ratio_if_positive(new - old, old) * 100.0).alias(f"{label}_pct_change_yoy"),
        ]
    return merged.select(*names, *out)


def reinsurance_indicators(w) -> DataFrame:
    kind = first_filled(F.col("insurance_type"), default="Unknown")
    category = first_filled(F.col("voluntary_insurance_type"), F.col("mandatory_insurance_type"), default="N/A")
    read = ("insurance_type", "voluntary_insurance_type", "mandatory_insurance_type")
    return _reinsurance_years(w, {"insurance_type": (kind, kind), "category": (category, category)}, [read, read])


def reinsurance_indicators_reinsurer(w) -> DataFrame:
    """Keyed by reinsurer; on the assumed side that is the policyholder."""
    ceded = first_filled(F.col("reinsurer"), default="Unknown")
    assumed = first_filled(F.col("policyholder"), default="Unknown")
    return _reinsurance_years(w, {"reinsurer": (ceded, assumed)}, [("reinsurer",), ("policyholder",)])


# ---- investments -------------------------------------------------------------


def _deposit_starts(w) -> DataFrame:
    """Start dates alone: the joins behind the deposits do not change the earliest."""
    if w.stored("deposits"):
        return w["deposits"].select("deposit_start_date")
    return w.raw("ins_invdep").select(F.col("depdate_from").alias("deposit_start_date"))


def _open_balances(w, by_partner: bool) -> DataFrame:
    """Open deposits ('Deposits') and loans ('Other') at every month end since the first deposit."""
    deposits = w["deposits"].select(
        F.lit("Deposits").alias("portfolio_category"),
        F.col("partner_name").alias("partner_name"),
        F.col("deposit_start_date").alias("_start"),
        F.col("deposit_end_date").alias("_end"),
        F.col("deposit_amount").alias("_amount"),
    )
    loans = w["loans"].select(
        F.lit("Other").alias("portfolio_category"),
        F.col("client_name").alias("partner_name"),
        F.col("loan_start_date").alias("_start"),
        F.col("loan_end_date").alias("_end"),
        F.col("loan_amount").alias("_amount"),
    )
    rows = deposits.unionByName(loans)
    keys = ["portfolio_category"]
    if by_partner:
        rows, keys = rows.filter(F.col("partner_name").isNotNull()), keys + ["partner_name"]
    first = first_month(_deposit_starts(w), "deposit_start_date")
    return active_balance(rows, "_start", "_end", "_amount", keys, first, w.last_month)


def _income(w) -> DataFrame:
    return w["investment_activity"].select(
        month_end(F.col("report_date")).alias("report_month"),
        code_label(F.col("investment_type"), catalog.INVESTMENT_CATEGORY).alias("portfolio_category"),
        "partner_name",
        "amount",
    )


def investment_portfolio_monthly(w) -> DataFrame:
    """Month-end balance and income of four categories with their shares of the month."""
    spine = month_spine(_deposit_starts(w), "deposit_start_date", w.last_month)
    grid = expand_categories(
        spine, {c: F.lit(0) for c in catalog.PORTFOLIO_CATEGORIES}, "portfolio_category", "_none"
    ).drop("_none")
    balances = _open_balances(w, by_partner=False).select("report_month", "portfolio_category", "amount")
    income = (
        _income(w)
        .groupBy("report_month", "portfolio_category")
        .agg(F.sum("amount").alias("_income"))
    )
    key = ["report_month", "portfolio_category"]
    rows = grid.join(balances, key, "left").join(income, key, "left").select(
        *key,
        F.coalesce("amount", F.lit(0)).cast(money.TOTAL).alias("_volume"),
        F.coalesce("_income", F.lit(0)).cast(money.TOTAL).alias("_income"),
    )
    month = Window.partitionBy("report_month")  # four rows each
    volume, income_sum = F.sum("_volume").over(month), F.sum("_income").over(month)
    return rows.select(
        *key,
        volume.alias("total_investment_portfolio_volume_uzs"),
        F.col("_volume").alias("total_investment_category_amount_uzs"),
        (ratio_or_zero(F.col("_volume"), volume) * 100.0).alias("total_investment_category_pct"),
        income_sum.alias("total_investment_income_portfolio_volume_uzs"),
        F.col("_income").alias("total_investment_income_category_amount_uzs"),
        (ratio_or_zero(F.col("_income"), income_sum) * 100.0).alias("total_investment_income_category_pct"),
    )


def investment_partner_indicators_monthly(w) -> DataFrame:
    return merge_measures(
        [
            (_open_balances(w, by_partner=True), {"portfolio_amount_uzs": F.col("amount")}),
            (_income(w).filter(F.col("partner_name").isNotNull()), {"income_amount_uzs": F.col("amount")}),
        ],
        ["report_month", "portfolio_category", "partner_name"],
    )


# ---- company against market --------------------------------------------------

MEASURES = ("prem", "claims", "liab", "term")
YEARS = ("py", "cy")


def market_volumes(w) -> DataFrame:
    """Market totals per insurance type in billions (the source is in millions)."""
    names = [f"mkt_{m}_{y}" for m in ("prem", "claims", "liab") for y in YEARS]
    columns = dict(zip(names, w.market_columns))
    kind = first_word_match(F.col("insurance_type_name"), catalog.MARKET_CLASS_WORDS)
    thousandth = F.lit("0.001").cast("decimal(3,3)")
    sums = (
        w.raw("market_share_insurance_class_stats")
        .withColumn("_kind", kind)
        .filter(F.col("_kind").isNotNull())
        .groupBy("_kind")
        .agg(*[F.sum(money.amount_or_zero(F.col(c))).alias(n) for n, c in columns.items()])
    )
    return sums.select("_kind", *[(F.col(n) * thousandth).alias(n) for n in columns])


def volume_premiums(w) -> DataFrame:
    """Premium and liability of both years per product, with the stored rate (default 1).

    One pass over the payments serves ordinary and bank-linked payments. The bank's payments come
    first: they are those of two years, so only payments of these are shuffled on.
    """
    payments = w.raw("ins_oplata").filter(F.col("ins_type").isNotNull()).select(
        "anketa_id", "polis_id", "bc_id", "ins_type", "opl_val", curated.paid_amount().alias("paid"), "val_kurs"
    )
    bank = (
        w.raw("ins_bank_client")
        .filter(year_range(F.col("pym_date"), w.prior_year, w.current_year))
        .select(F.col("ins_id").alias("_bank_id"), F.year("pym_date").alias("pay_year"), F.col("status").alias("_status"))
    )
    # Keys once each and not a semi join, which the planner would move below the bank's payments.
    in_force = curated.policies_in_force(w.raw).distinct()
    contracts = w.raw("ins_anketa").select(F.col("ins_id").alias("_contract"), "ins_otv")
    policies = _policy_products(w)
    ordinary = F.col("ins_type") != 3
    rate = money.rate_or_one(F.col("val_kurs"))
    linked = (
        payments.join(bank, (F.col("bc_id") == F.col("_bank_id")) & (ordinary | (F.col("_status") == 2)), "inner")
        .drop("bc_id", "_bank_id", "_status")
        .join(in_force, F.col("anketa_id") == F.col("_in_force"), "inner")
        .join(contracts, F.col("anketa_id") == F.col("_contract"), "left")
        .drop("anketa_id", "_in_force", "_contract")
        .join(policies, F.col("polis_id") == F.col("_policy"), "inner")
    )
    liability = F.when(
        ordinary, money.convert(F.col("opl_val"), F.col("ins_otv"), F.col("ins_otv"), rate)
    ).otherwise(money.amount_or_zero(F.col("ins_otv")).cast(money.CONVERTED))
    return linked.groupBy("pay_year", "pturi_id").agg(
        F.sum(money.convert(F.col("opl_val"), F.col("paid"), F.col("paid"), rate)).alias("prem"),
        F.sum(liability).alias("liab"),
    )


def _policy_products(w) -> DataFrame:
    """Policy to product; policies without a product drop out of every volume."""
    return w.raw("ins_polis").filter(F.col("pturi_id").isNotNull()).select(F.col("tb_id").alias("_policy"), "pturi_id")


def volume_claims(w) -> DataFrame:
    cases = w.raw("ins_sobitie").select(F.col("ins_id").alias("_case"), F.col("polis_id").alias("_case_policy"))
    home = F.coalesce(F.col("val_type"), F.lit(1))
    paid = money.convert(home, F.col("viplate"), F.col("viplate"), money.rate_or_one(F.col("val_kurs")))
    return (
        w.raw("ins_viplati")
        .filter(year_range(F.col("date_viplata"), w.prior_year, w.current_year))
        .join(cases, F.col("sobitie_id") == F.col("_case"), "inner")
        .join(_policy_products(w), F.col("_case_policy") == F.col("_policy"), "inner")
        .groupBy(F.year("date_viplata").alias("pay_year"), "pturi_id")
        .agg(F.sum(paid).alias("claims"))
    )


def volume_terminations(w) -> DataFrame:
    return (
        w.raw("ins_rastorg")
        .filter(year_range(F.col("tb_dateras"), w.prior_year, w.current_year))
        .join(_policy_products(w), F.col("tb_polis") == F.col("_policy"), "inner")
        .groupBy(F.year("tb_dateras").alias("pay_year"), "pturi_id")
        .agg(F.sum(money.amount_or_zero(F.col("tb_summa"))).alias("term"))
    )


def company_volumes(w) -> DataFrame:
    """Premium, liability, claims and terminations of both years, one row per product.

    A product without a name never matches itself across measures or years, so each
    of its parts stays a row of its own.
    """
    products = w["product_dimension"].select(
        F.col("pturi_id").alias("_product"), "insurance_type", "category", "product_name"
    )
    parts = [
        (volume_premiums(w), ["prem", "liab"]),
        (volume_claims(w), ["claims"]),
        (volume_terminations(w), ["term"]),
    ]
    tagged = None
    for tag, (df, names) in enumerate(parts):
        df = df.select(
            "pay_year",
            "pturi_id",
            F.lit(tag).alias("_part"),
            *[(F.col(m) if m in names else F.lit(None)).cast(money.CONVERTED).alias(m) for m in MEASURES],
        )
        tagged = df if tagged is None else tagged.unionByName(df)
    named = tagged.join(products, F.col("pturi_id") == F.col("_product"), "inner")
    unnamed = F.when(F.col("product_name").isNull(), F.struct("pay_year", "_part"))
    years = {"py": w.prior_year, "cy": w.current_year}
    return (
        named.groupBy("insurance_type", "category", "product_name", unnamed.alias("_own_row"))
        .agg(
            *[
                F.coalesce(F.sum(F.when(F.col("pay_year") == y, F.col(m))), F.lit(0)).cast(money.TOTAL).alias(f"co_{m}_{n}")
                for m in MEASURES
                for n, y in years.items()
            ]
        )
        .drop("_own_row")
    )


def insurance_volume_indicators(w) -> DataFrame:
    """Company against market per product, prior and current year side by side."""
    rows = company_volumes(w).join(market_volumes(w), F.col("insurance_type") == F.col("_kind"), "left")
    rows = rows.withColumns({f"co_{m}_{y}": money.billions(F.col(f"co_{m}_{y}")) for m in MEASURES for y in YEARS})

    def pct(num: str, den: str):
        """Rounded percentage, null when the base is 0 or missing."""
        return F.round(ratio_or_null(F.col(num), F.col(den)) * 100.0, 2)

    def change(m: str):
        grown = F.col(f"co_{m}_cy") - F.col(f"co_{m}_py")
        return F.round(ratio_or_null(grown, F.col(f"co_{m}_py")) * 100.0, 2)

    def against_market(m: str, volume: str) -> list:
        """Volumes, shares and changes of one measure that the market report has too."""
        share = {y: ratio_or_null(F.col(f"co_{m}_{y}"), F.col(f"mkt_{m}_{y}")) * 100.0 for y in YEARS}
        out = []
        for y in YEARS:
            out += [
                F.round(f"mkt_{m}_{y}", 2).alias(f"market_{volume}_{y}_bn"),
                F.round(f"co_{m}_{y}", 2).alias(f"co_{volume}_{y}_bn"),
                F.round(share[y], 2).alias(f"co_{m}_market_share_{y}_pct"),
            ]
        return out + [
            F.round(share["cy"] - share["py"], 2).alias(f"co_{m}_share_change_pp"),
            change(m).alias(f"co_{m}_volume_change_pct"),
        ]

    loss_ratios = [
        pct(f"{who}_claims_{y}", f"{who}_prem_{y}").alias(f"{label}_loss_ratio_{y}_pct")
        for y in YEARS
        for who, label in (("mkt", "market"), ("co", "co"))
    ]
    return rows.select(
        "insurance_type",
        "category",
        "product_name",
        F.lit(w.prior_year).alias("prior_year"),
        F.lit(w.current_year).alias("current_year"),
        *against_market("prem", "premium_volume"),
        *against_market("claims", "claims_volume"),
        *loss_ratios,
        *against_market("liab", "liabilities"),
        *[F.round(f"co_term_{y}", 2).alias(f"co_terminated_{y}_bn") for y in YEARS],
        change("term").alias("co_terminated_volume_change_pct"),
    )
