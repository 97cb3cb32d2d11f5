"""Curated tables: cleaned, typed and joined inputs of the marts.

Every model takes ``raw``, a function from table name to DataFrame. The wide models
take the names of the columns wanted, so a mart plans two columns and not 128. Audit
columns (``loaded_at``, ``updated_at``) are added when a table is saved, see ``warehouse``;
a landing time that the raw table holds is kept.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Collection

from pyspark.sql import DataFrame, Window, functions as F

from coverledger import catalog
from coverledger.functions import money
from coverledger.functions.cleaning import (
    blank_to_null,
    clean_date,
    clean_numeric,
    code_label,
    digits_in,
    first_filled,
    parse_day_first_date,
    strip_to_null,
)
from coverledger.functions.reports import report_body, report_number
from coverledger.operators.asof import with_rate
from coverledger.operators.lookup import left_join_copies, lookup_value
from coverledger.sources.landing import column_class, conform
from coverledger.sources.layout import by_contract, rows_between
from coverledger.sources.rejected import with_rejected
from coverledger.sources.reports import explode_list

Raw = Callable[[str], DataFrame]
Columns = Collection[str] | None


def _wanted(all_columns: list[str], columns: Columns) -> list[str]:
    """Layout order, all columns unless some are named."""
    return [c for c in all_columns if columns is None or c in columns]


def _scenario():
    return F.lit(catalog.SCENARIO).alias("scenario")


def _times(total, copies):
    """Exact total x count, 4 decimals."""
    return total.cast("decimal(26,4)") * copies.cast("decimal(11,0)")


def partner_name(org: str = "tb_orgname", person: str = "tb_name"):
    """Organisation name, else person name, else null."""
    return F.coalesce(blank_to_null(F.col(org)), blank_to_null(F.col(person)))


# ---- landed portfolios -------------------------------------------------------


def landing_time(table: DataFrame) -> list:
    """The time at which a row was landed, where the landed table tells it."""
    return [F.col("loaded_at").try_cast("timestamp").alias("loaded_at")] if "loaded_at" in table.columns else []


def claims_portfolio(raw: Raw, columns: Columns = None, rejected: bool = False) -> DataFrame:
    """Claims with dates and amounts read from text; with ``rejected`` also the values of a row
    that these cannot hold."""
    names = _wanted(catalog.CLAIMS_COLUMNS, columns)
    table = raw("claims_portfolio")
    stamp = landing_time(table) if columns is None else []
    kinds = dict.fromkeys(catalog.CLAIMS_NUMERIC_COLUMNS, money.READ) | dict.fromkeys(catalog.CLAIMS_DATE_COLUMNS, "date")
    source = {c: f"_text_{c}" if rejected and c in kinds else c for c in names}
    landed = conform(table, [*names, *["loaded_at" for _ in stamp]]).withColumnsRenamed(source)

    def cleaned(name: str):
        c = F.col(source[name])
        if name in catalog.CLAIMS_DATE_COLUMNS:
            return clean_date(c)
        return clean_numeric(c) if name in catalog.CLAIMS_NUMERIC_COLUMNS else F.trim(c)

    texts = {c: source[c] for c in names if source[c] != c}
    rows = landed.select(*[cleaned(c).alias(c) for c in names], _scenario(), *stamp, *texts.values())
    if not rejected:
        return rows
    trimmed = {c: strip_to_null(F.col(t)) for c, t in texts.items()}
    return with_rejected(rows, trimmed, {c: kinds[c] for c in texts}).drop(*texts.values())


def _reinsurance(table: DataFrame, columns: list[str]) -> DataFrame:
    have = set(table.columns)

    def passed(name: str):
        kind = column_class(name)
        if name not in have:
            return F.lit(None).cast(kind)
        return F.trim(F.col(name)) if kind == "string" else F.col(name).cast(kind)

    first = [F.col("id")] if "id" in have else []
    return table.select(*first, *[passed(c).alias(c) for c in columns], _scenario())


def reinsurance_incoming(raw: Raw, columns: Columns = None) -> DataFrame:
    return _reinsurance(raw("reinsurance_incoming_portfolio"), _wanted(catalog.INCOMING_COLUMNS, columns))


def reinsurance_outgoing(raw: Raw, columns: Columns = None) -> DataFrame:
    return _reinsurance(raw("reinsurance_outgoing_portfolio"), _wanted(catalog.OUTGOING_COLUMNS, columns))


# ---- JSON reports ------------------------------------------------------------


def _coded_report(reports: DataFrame, path: str, codes: dict[str, str], columns: Columns) -> DataFrame:
    names = _wanted(list(codes.values()), columns)
    code_of = {n: k for k, n in codes.items()}
    bodies = reports.select("report_date", report_body(F.col("payload_json"), path).alias("_body"))
    return bodies.select(
        "report_date", _scenario(), *[report_number(F.col("_body"), code_of[n]).alias(n) for n in names]
    )


def balance_sheet(raw: Raw, columns: Columns = None) -> DataFrame:
    reports = raw("balance_sheet_api_response")
    return _coded_report(reports, "$.OperationResult.Balance", catalog.BALANCE_SHEET_CODES, columns)


def financial_performance(raw: Raw, columns: Columns = None) -> DataFrame:
    reports = raw("financial_performance_api_response")
    return _coded_report(reports, "$.OperationResult", catalog.PERFORMANCE_CODES, columns)


def investment_activity(raw: Raw) -> DataFrame:
    """Bonds, deposits and FX deposits item by item, loans and shares as single amounts.

    All five kinds come out of one pass over the reports: each report is parsed once,
    spread to its kinds and then to the items of each list.
    """
    bodies = raw("investment_activity_api_response").select(
        F.col("report_date").cast("date").alias("report_date"),
        report_body(F.col("payload_json"), "$.OperationResult").alias("_body"),
    )
    kinds = catalog.INVESTMENT_LIST_KEYS | catalog.INVESTMENT_SCALAR_KEYS
    parts = [
        F.struct(F.lit(kind).alias("investment_type"), F.try_variant_get("_body", f"$.{key}", "variant").alias("_part"))
        for key, kind in kinds.items()
    ]
    entries = bodies.select("report_date", F.inline(F.array(*parts))).filter(F.col("_part").isNotNull())
    listed = F.col("investment_type").isin(list(catalog.INVESTMENT_LIST_KEYS.values()))
    rows = explode_list(entries, F.when(listed, F.col("_part")))
    single = ~listed & F.nullif(F.try_variant_get("_part", "$", "string"), F.lit("")).isNotNull()
    amount = report_number(F.col("_item"), "amount")
    return rows.filter(single | F.col("_item").isNotNull()).select(
        "report_date",
        "investment_type",
        F.try_variant_get("_item", "$.partner", "string").alias("partner_name"),
        F.try_variant_get("_item", "$.contract", "string").alias("contract"),
        F.when(listed, amount).otherwise(F.try_variant_get("_part", "$", money.READ)).alias("amount"),
        _scenario(),
    )


def solvency_adequacy_ratio(raw: Raw) -> DataFrame:
    table = raw("solvency_adequacy")
    return table.select(
        parse_day_first_date(F.col("report_date")).alias("report_date"),
        "actual_solvency_margin_adequacy_ratio",
        "required_solvency_margin_adequacy_ratio",
        _scenario(),
        *landing_time(table),
    )


# ---- premiums ----------------------------------------------------------------


def policies_in_force(raw: Raw) -> DataFrame:
    """Contract keys with a general policy in force, for a semi join."""
    in_force = raw("ins_polis").filter(F.col("tb_status").isin(catalog.GENERAL_POLICY_STATUSES))
    return in_force.select(F.col("tb_anketa").alias("_in_force"))


def _in_home_currency():
    return F.coalesce(F.col("opl_val") == money.HOME_CURRENCY, F.lit(False))


def paid_amount():
    """The amount of a payment that its premium is made of: payments of any type but 3 in a foreign
    currency have it in ``opl_summa``, all others in ``oplata``."""
    abroad = (F.col("ins_type") != 3) & ~_in_home_currency()
    return F.when(abroad, F.col("opl_summa")).otherwise(F.col("oplata"))


def _linked_payments(raw: Raw, contracts: DataFrame) -> DataFrame:
    """Payments of types 1 (any but 3) and 22 (type 3, bank payment status 2), with the columns
    of ``contracts`` (key ``_contract``).

    Both kinds need the same joins, so one pass serves them. The policy check and the
    contract come first: both use the contract key, so one shuffle serves both. Only
    foreign payments of type 1 need a rate. It comes last: by then the planner has measured the
    rates and broadcasts them if they are small, and the payments are not shuffled for it. A payment
    carries one amount, and a day and a rate only where these are read.
    """
    foreign = (F.col("ins_type") != 3) & (F.col("opl_val") != money.HOME_CURRENCY)
    payments = raw("ins_oplata").filter(F.col("ins_type").isNotNull()).select(
        "anketa_id",
        "bc_id",
        "ins_type",
        "opl_val",
        F.when(foreign, F.col("opl_data")).alias("opl_data"),
        paid_amount().alias("paid"),
        F.when((F.col("ins_type") == 3) & ~_in_home_currency(), F.col("val_kurs")).alias("val_kurs"),
    )
    bank = raw("ins_bank_client").select(
        F.col("ins_id").alias("_bank_id"), F.col("pym_date").cast("date").alias("payment_date"), F.col("status").alias("_status")
    )
    linked = payments.join(policies_in_force(raw), F.col("anketa_id") == F.col("_in_force"), "left_semi")
    linked = linked.join(contracts, F.col("anketa_id") == F.col("_contract"), "left").drop("_contract")
    linked = linked.join(
        bank, (F.col("bc_id") == F.col("_bank_id")) & ((F.col("ins_type") != 3) | (F.col("_status") == 2)), "inner"
    ).drop("bc_id", "_bank_id", "_status")
    return with_rate(linked, raw("ins_kurs"), "opl_val", "opl_data", needed=foreign)


def _payment_premium():
    """Premium of a linked payment in the home currency."""
    rate = F.when(F.col("ins_type") != 3, F.col("rate").cast(money.RATE)).otherwise(money.rate_or_one(F.col("val_kurs")))
    return money.convert(F.col("opl_val"), F.col("paid"), F.col("paid"), rate)


def general_premium_rows(raw: Raw) -> DataFrame:
    """Premium and liability of every linked payment."""
    return by_contract(_general_premium_rows, raw)


def _general_premium_rows(raw: Raw) -> DataFrame:
    contracts = raw("ins_anketa").select(F.col("ins_id").alias("_contract"), "ins_otv")
    ordinary = F.col("ins_type") != 3
    return _linked_payments(raw, contracts).select(
        "payment_date",
        F.when(ordinary, 1).otherwise(22).alias("source_query_id"),
        "anketa_id",
        _payment_premium().alias("premium_amount"),
        F.when(ordinary, money.convert(F.col("opl_val"), F.col("ins_otv"), F.col("ins_otv"), F.col("rate")))
        .otherwise(money.amount_or_zero(F.col("ins_otv")).cast(money.CONVERTED))
        .alias("liability_amount"),
    )


def _motor_payments(raw: Raw) -> DataFrame:
    """Motor payments with their contract and bank payment."""
    paid = raw("tb_oplata").filter(F.col("tb_typepl") == 1)
    return paid.select(F.col("tb_anketa").alias("anketa_id"), "bc_id")


def _when_paid(payments: DataFrame, raw: Raw) -> DataFrame:
    """Payments that the bank has booked, with the day."""
    bank = raw("ins_bank_client").filter(F.col("status") == 2).select(
        F.col("ins_id").alias("_bank_id"), F.col("pym_date").cast("date").alias("payment_date")
    )
    return payments.join(bank, F.col("bc_id") == F.col("_bank_id"), "inner").drop("bc_id", "_bank_id")


def motor_policies(raw: Raw) -> DataFrame:
    return raw("tb_polis").filter(F.col("tb_status").isin(catalog.MOTOR_POLICY_STATUSES))


def motor_liability_rows(raw: Raw) -> DataFrame:
    """One row per contract, policy, payment and vehicle, repeats kept on purpose."""
    return by_contract(_motor_liability_rows, raw)


def _motor_liability_rows(raw: Raw) -> DataFrame:
    contracts = raw("tb_anketa").select(F.col("tb_id").alias("anketa_id"))
    policies = motor_policies(raw).select(F.col("tb_anketa").alias("anketa_id"), "tb_summa")
    vehicles = raw("tb_avto").select(F.col("tb_anketa").alias("anketa_id"))
    rows = (
        _when_paid(_motor_payments(raw), raw)
        .join(contracts, "anketa_id")
        .join(policies, "anketa_id")
        .join(vehicles, "anketa_id")
    )
    return rows.select(
        "payment_date",
        F.lit(21).alias("source_query_id"),
        "anketa_id",
        F.lit(0).cast(money.CONVERTED).alias("premium_amount"),
        money.amount_or_zero(F.col("tb_summa")).cast(money.CONVERTED).alias("liability_amount"),
    )


def motor_liability_sums(raw: Raw) -> DataFrame:
    """``motor_liability_rows`` summed per payment.

    Policies and vehicles are reduced to one row per contract before they are joined, so the
    policy x payment x vehicle combinations are counted, never emitted. The contract's key comes
    first, on which bucketed tables need no exchange, then the bank's.
    """
    return by_contract(_motor_liability_sums, raw)


def _motor_liability_sums(raw: Raw) -> DataFrame:
    contracts = raw("tb_anketa").groupBy(F.col("tb_id").alias("anketa_id")).agg(F.count(F.lit(1)).alias("_contracts"))
    policies = motor_policies(raw).groupBy(F.col("tb_anketa").alias("anketa_id")).agg(
        F.sum(money.amount_or_zero(F.col("tb_summa"))).alias("_liability")
    )
    vehicles = raw("tb_avto").groupBy(F.col("tb_anketa").alias("anketa_id")).agg(F.count(F.lit(1)).alias("_vehicles"))
    rows = _motor_payments(raw).join(contracts, "anketa_id").join(policies, "anketa_id").join(vehicles, "anketa_id")
    liability = _times(F.col("_liability"), F.col("_contracts") * F.col("_vehicles")).cast(money.CONVERTED)
    rows = rows.select("anketa_id", "bc_id", liability.alias("liability_amount"))
    return _when_paid(rows, raw).select(
        "payment_date",
        F.lit(21).alias("source_query_id"),
        "anketa_id",
        F.lit(0).cast(money.CONVERTED).alias("premium_amount"),
        "liability_amount",
    )


def insurance_premium(raw: Raw) -> DataFrame:
    return general_premium_rows(raw).unionByName(motor_liability_rows(raw))


def premium_sums(raw: Raw) -> DataFrame:
    """Same columns and sums as ``insurance_premium`` without its repeated motor rows."""
    return general_premium_rows(raw).unionByName(motor_liability_sums(raw))


def motor_payment_keys(raw: Raw) -> DataFrame:
    """Motor payments that ``motor_liability_rows`` has; their premium is 0, so no repeats are counted."""
    rows = _motor_payments(raw)
    held = (
        raw("tb_anketa").select(F.col("tb_id").alias("_key")),
        motor_policies(raw).select(F.col("tb_anketa").alias("_key")),
        raw("tb_avto").select(F.col("tb_anketa").alias("_key")),
    )
    for keys in held:
        rows = rows.join(keys, F.col("anketa_id") == F.col("_key"), "left_semi")
    return _when_paid(rows, raw)


def premium_amounts(raw: Raw) -> DataFrame:
    """Date and premium of ``insurance_premium``, without its liabilities and repeated motor rows."""
    return by_contract(_premium_amounts, raw)


def _premium_amounts(raw: Raw) -> DataFrame:
    contracts = raw("ins_anketa").select(F.col("ins_id").alias("_contract"))
    general = _linked_payments(raw, contracts).select("payment_date", _payment_premium().alias("premium_amount"))
    motor = motor_payment_keys(raw).select("payment_date", F.lit(0).cast(money.CONVERTED).alias("premium_amount"))
    return general.unionByName(motor)


def premium_amounts_by_owner(raw: Raw) -> DataFrame:
    """Date, premium and contract owner of every payment of ``insurance_premium``.

    The report joins the contracts twice, for the premium and for the owner. Once is enough
    where each contract row knows how often its key occurs: that count replaces the first
    join. Count and join share the shuffle on the contract key.
    """
    return by_contract(_premium_amounts_by_owner, raw)


def _premium_amounts_by_owner(raw: Raw) -> DataFrame:
    contracts = raw("ins_anketa").filter(F.col("ins_id").isNotNull()).select(
        F.col("ins_id").alias("_contract"),
        F.col("owner").alias("partner_id"),
        F.count(F.lit(1)).over(Window.partitionBy("ins_id")).alias("_copies"),
    )
    once = _payment_premium()
    times = once.cast("decimal(27,10)") * F.col("_copies").cast("decimal(10,0)")
    general = _linked_payments(raw, contracts).select(
        "payment_date",
        "partner_id",
        F.when(F.col("_copies") > 1, times).otherwise(once).cast(money.CONVERTED).alias("premium_amount"),
    )
    motor = (
        motor_payment_keys(raw)
        .join(contracts, F.col("anketa_id") == F.col("_contract"), "left")
        .select("payment_date", "partner_id", F.lit(0).cast(money.CONVERTED).alias("premium_amount"))
    )
    return general.unionByName(motor)


def premium_total(raw: Raw, start: dt.date, end: dt.date, registry_keys_unique: bool = False) -> DataFrame:
    """Converted payment and liability sums of a payment period.

    The rate depends on currency and day only, so amounts are summed per currency and
    day before the rate lookup. The report also left joins policies, acts and partners,
    which only repeat rows where their keys repeat: those repeats are counted, not
    joined, and with keys proven unique the three lookups are skipped.
    """
    payments = raw("ins_oplata").filter(F.col("ins_type") != 3).select(
        "anketa_id", "polis_id", "bc_id", "akt", "opl_val", "opl_data", "oplata", "opl_summa"
    )
    bank = rows_between(raw, "ins_bank_client", start, end).select(F.col("ins_id").alias("_bank_id"))
    contracts = raw("ins_anketa").select(F.col("ins_id").alias("_contract"), "ins_otv", "owner")
    rows = (
        payments.join(policies_in_force(raw), F.col("anketa_id") == F.col("_in_force"), "left_semi")
        .join(contracts, F.col("anketa_id") == F.col("_contract"), "left")
        .join(bank, F.col("bc_id") == F.col("_bank_id"), "inner")
    )
    copies = F.lit(1).cast("bigint")
    if not registry_keys_unique:
        chain = {
            "owner": (raw("ins_kontragent"), "tb_id"),
            "polis_id": (raw("ins_polis"), "tb_id"),
            "akt": (raw("ins_agent_akt").filter(F.col("active") == 2), "ins_id"),
        }
        for link, (table, key) in chain.items():
            counts = left_join_copies(table, key).select(F.col(key).alias(f"_{link}"), F.col("copies").alias(f"_{link}_copies"))
            rows = rows.join(counts, F.col(link) == F.col(f"_{link}"), "left")
            copies = copies * F.coalesce(F.col(f"_{link}_copies"), F.lit(1))

    def times(c: str):
        return F.sum(_times(money.amount_or_zero(F.col(c)), copies)).cast(money.AMOUNT).alias(c)

    sums = rows.groupBy("opl_val", "opl_data").agg(times("oplata"), times("opl_summa"), times("ins_otv"))
    foreign = F.col("opl_val") != money.HOME_CURRENCY
    rated = with_rate(sums, raw("ins_kurs"), "opl_val", "opl_data", needed=foreign)

    def total(home: str, foreign: str):
        return F.sum(money.convert(F.col("opl_val"), F.col(home), F.col(foreign), F.col("rate")))

    return rated.agg(
        total("oplata", "opl_summa").alias("premium_total"),
        total("ins_otv", "ins_otv").alias("liability_total"),
        F.sum("ins_otv").alias("liability_unconverted"),
    )


# ---- commissions -------------------------------------------------------------


def commission_rows(raw: Raw) -> DataFrame:
    """General and motor commissions with the partner's id in place of the name."""
    return by_contract(_commission_rows, raw)


def _commission_rows(raw: Raw) -> DataFrame:
    acts = raw("ins_agent_akt").filter(F.col("active") == 2).select(
        F.col("ins_id").alias("_act"), F.col("akt_date").cast("date").alias("commission_date")
    )
    contracts = raw("ins_anketa").select(F.col("ins_id").alias("_contract"), "fizyur", "owner")
    payments = raw("ins_oplata").select("ins_id", "anketa_id", "akt", "opl_val", "kommis_summa", "val_kurs")
    general = (
        payments.join(policies_in_force(raw), F.col("anketa_id") == F.col("_in_force"), "left_semi")
        .join(contracts, F.col("anketa_id") == F.col("_contract"), "left")
        .join(acts, F.col("akt") == F.col("_act"), "inner")
        .select(
            F.col("ins_id").alias("transaction_id"),
            "commission_date",
            money.convert(
                F.col("opl_val"), F.col("kommis_summa"), F.col("kommis_summa"), money.rate_or_one(F.col("val_kurs"))
            ).alias("commission_amount_uzs"),
            F.col("fizyur").alias("entity_type_flag"),
            F.col("owner").alias("partner_id"),
        )
    )
    motor_contracts = raw("tb_anketa").select(F.col("tb_id").alias("_contract"), "tb_fizur", "tb_user")
    motor_payments = raw("tb_oplata").filter(F.col("tb_typepl") == 1).select(
        F.col("tb_id").alias("transaction_id"), F.col("tb_anketa").alias("_pay_contract"), "tb_summa"
    )
    policies = motor_policies(raw).select(F.col("tb_anketa").alias("_policy_contract"), "tb_komissia", "akt")
    motor = (
        policies.join(motor_contracts, F.col("_policy_contract") == F.col("_contract"), "inner")
        .join(motor_payments, F.col("_contract") == F.col("_pay_contract"), "inner")
        .join(acts, F.col("akt") == F.col("_act"), "inner")
        .select(
            "transaction_id",
            "commission_date",
            money.percent_of(F.col("tb_summa"), F.col("tb_komissia")).alias("commission_amount_uzs"),
            F.col("tb_fizur").alias("entity_type_flag"),
            F.col("tb_user").alias("partner_id"),
        )
    )
    return general.unionByName(motor)


def with_partner(rows: DataFrame, raw: Raw, key: str = "partner_id", name: str = "bank_partner_name") -> DataFrame:
    """Left join of the partner name, with a label where there is none."""
    partners = raw("ins_kontragent").select(F.col("tb_id").alias("_partner"), "tb_orgname", "tb_name")
    label = first_filled(F.col("tb_orgname"), F.col("tb_name"), default=catalog.NO_PARTNER)
    kept = [c for c in rows.columns if c != key]
    return rows.join(partners, F.col(key) == F.col("_partner"), "left").select(*kept, label.alias(name))


def agency_commissions(raw: Raw) -> DataFrame:
    return with_partner(commission_rows(raw), raw)


# ---- recoveries, terminations ------------------------------------------------


def subrogation_recoveries(raw: Raw, registry_keys_unique: bool = False) -> DataFrame:
    """Total, matched and unmatched part of every recovery payment.

    A matched sum is repeated once per row the registry chain (recovery case, policy,
    contract, beneficiary) yields. The repeats are counted along the chain instead of
    joined. With keys proven unique there is nothing to count and the chain is skipped.
    """
    payments = raw("ins_bank_client").filter(F.col("bc_type") == 2)
    matched = raw("ins_regress_bank").groupBy("bc_id", "regress_id").agg(F.sum("recovery_sum").alias("_sum"))
    if not registry_keys_unique:
        partners = left_join_copies(raw("ins_kontragent"), "tb_id")
        contracts = left_join_copies(raw("ins_anketa"), "ins_id", "beneficiary", partners, "tb_id")
        policies = left_join_copies(raw("ins_polis"), "tb_id", "tb_anketa", contracts, "ins_id")
        cases = left_join_copies(raw("ins_regress"), "ins_id", "polis_id", policies, "tb_id")
        cases = cases.select(F.col("ins_id").alias("_case"), F.col("copies").alias("_case_copies"))
        matched = matched.join(cases, F.col("regress_id") == F.col("_case"), "left").withColumn(
            "_sum", _times(F.col("_sum"), F.coalesce(F.col("_case_copies"), F.lit(1)))
        )
    exact = matched.groupBy(F.col("bc_id").alias("_bank_id")).agg(F.sum("_sum").cast(money.TOTAL).alias("_exact"))
    if not registry_keys_unique:
        repeats = payments.groupBy(F.col("ins_id").alias("_pay_id")).agg(F.count(F.lit(1)).alias("_repeats"))
        exact = exact.join(repeats, F.col("_bank_id") == F.col("_pay_id")).select(
            "_bank_id", _times(F.col("_exact"), F.col("_repeats")).alias("_exact")
        )
    total = money.amount_or_zero(F.col("pym_summa")).cast(money.TOTAL)
    found = F.coalesce(F.col("_exact"), F.lit(0).cast(money.TOTAL))
    return (
        payments.filter(F.col("pym_date").isNotNull())
        .join(exact, F.col("ins_id") == F.col("_bank_id"), "left")
        .select(
            F.col("ins_id").alias("transaction_id"),
            F.col("pym_date").cast("date").alias("recovery_payment_date"),
            total.alias("total_recovery_amount"),
            found.alias("exact_recovery_amount"),
            (total - found).cast(money.TOTAL).alias("undefined_recovery_amount"),
        )
    )


def terminated_contracts(raw: Raw) -> DataFrame:
    names = {
        "tb_summa": "terminated_amount",
        "vernut": "returned_amount",
        "ostatok": "remainder_amount",
        "vozvrat_sum": "returned_sum",
        "retention": "retention_amount",
    }
    return raw("ins_rastorg").filter(F.col("tb_dateras").isNotNull()).select(
        F.col("tb_dateras").cast("date").alias("termination_date"),
        *[money.amount_or_zero(F.col(c)).alias(n) for c, n in names.items()],
    )


# ---- investments, products ---------------------------------------------------


def deposits(raw: Raw) -> DataFrame:
    currencies = raw("p_sp_currency").select(F.col("sp_id").alias("_currency"))
    rows = raw("ins_invdep").join(currencies, F.col("val_type") == F.col("_currency"), "left")
    rows = lookup_value(rows, F.col("client_id"), raw("ins_kontragent"), "tb_id", partner_name(), "partner_name")
    kind = F.when(F.col("val_type") == 2, "Foreign Currency Deposits").otherwise("Non-Foreign Currency Deposits")
    return rows.select(
        kind.alias("deposit_type"),
        "partner_name",
        F.col("dep_sum").alias("deposit_amount"),
        F.col("depdate_from").alias("deposit_start_date"),
        F.col("depdate_to").alias("deposit_end_date"),
        _scenario(),
    )


def loans(raw: Raw) -> DataFrame:
    rows = lookup_value(
        raw("ins_invloan"), F.col("client_id"), raw("ins_kontragent"), "tb_id", partner_name(), "client_name"
    )
    for key, name in (("val_type", "currency_type"), ("val_vozvrat", "return_currency_type")):
        rows = lookup_value(rows, F.col(key), raw("p_sp_currency"), "sp_id", F.col("name"), name)
    for table, name in (("ins_invloan_oplata", "paid_amount"), ("ins_invloan_accrual", "payable_amount")):
        sums = raw(table).groupBy(F.col("loan_id").alias("_loan")).agg(F.sum("amount").alias(name))
        rows = rows.join(sums, F.col("ins_id") == F.col("_loan"), "left").drop("_loan")
    payable, paid = F.col("payable_amount"), F.col("paid_amount")
    progress = F.when(payable == 0, F.lit(0.0)).otherwise(paid.cast("double") * 100.0 / payable.cast("double"))
    return rows.select(
        F.col("ins_id").alias("loan_id"),
        "client_name",
        F.col("loan_num").alias("loan_number"),
        F.col("dog_num").alias("contract_number"),
        F.col("dog_date").alias("contract_date"),
        F.col("loandate_from").alias("loan_start_date"),
        F.col("loandate_to").alias("loan_end_date"),
        F.col("loan_day").alias("loan_duration_days"),
        F.col("prof_rate").alias("interest_rate"),
        F.col("loan_sum").alias("loan_amount"),
        "currency_type",
        "return_currency_type",
        paid.alias("paid_amount"),
        payable.alias("payable_amount"),
        (payable - paid).alias("remaining_balance"),
        progress.alias("repayment_progress_pct"),
        code_label(F.col("status"), catalog.LOAN_STATUS, default="").alias("loan_status"),
        _scenario(),
    )


def product_dimension(raw: Raw) -> DataFrame:
    def names(table: str, key: str, name: str) -> DataFrame:
        return raw(table).select(F.col("ins_id").alias(key), F.col("name1").alias(name))

    rows = raw("ins_pturi")
    rows = rows.join(names("ins_vertical", "_v", "_vertical"), F.col("vertical") == F.col("_v"), "left")
    rows = rows.join(names("ins_pgroup1", "_g1", "insurance_class_group"), F.col("group1") == F.col("_g1"), "left")
    rows = rows.join(names("ins_pgroup2", "_g2", "insurance_subgroup"), F.col("group2") == F.col("_g2"), "left")
    code = F.col("kod_num").cast("string")
    return rows.select(
        F.col("ins_id").alias("pturi_id"),
        F.col("polis_name_rus").alias("product_name"),
        F.col("polis_name").alias("product_name_uz"),
        code.alias("product_code"),
        F.when(digits_in(code, catalog.COMPULSORY_PRODUCT_CODES), "Compulsory").otherwise("Voluntary").alias("insurance_type"),
        F.coalesce(F.col("_vertical"), F.lit("Unclassified")).alias("category"),
        "insurance_class_group",
        "insurance_subgroup",
        F.col("vertical").alias("vertical_id"),
        F.col("group1").alias("group1_id"),
        F.col("group2").alias("group2_id"),
        F.col("active").alias("is_active"),
        F.col("import").alias("import_flag"),
    )
