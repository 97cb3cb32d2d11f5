"""Checking SQL per registered query. Views of the benchmark tables are given."""

from __future__ import annotations

from coverledger import catalog
from oracle.compose import compose, finish
from oracle.models import MODELS, _date, _number

A = "DECIMAL(22,4)"


def _model(name: str, decimals: str = "", doubles: str = "") -> str:
    return finish(f"SELECT * FROM {name}", decimals, doubles)


_YEARS = "{0}_volume_1999_bn_uzs {0}_volume_2000_bn_uzs"
_RATIO_DEC = (
    "claims_payout p610_reserve premium_f011 premium_f013 reinsurance_f012 p590_change expenses_f070 expenses_f090 "
    "outward_ceded_premium premium_written denominator_net_earned_premium"
)
_VOLUME_DEC = " ".join(
    f"{who}_{v}_{y}_bn" for v in ("premium_volume", "claims_volume", "liabilities") for y in ("py", "cy") for who in ("market", "co")
) + " co_terminated_py_bn co_terminated_cy_bn"
_VOLUME_DBL = " ".join(
    [f"co_{m}_market_share_{y}_pct" for m in ("prem", "claims", "liab") for y in ("py", "cy")]
    + [f"co_{m}_share_change_pp" for m in ("prem", "claims", "liab")]
    + [f"co_{m}_volume_change_pct" for m in ("prem", "claims", "liab")]
    + [f"{w}_loss_ratio_{y}_pct" for w in ("market", "co") for y in ("py", "cy")]
    + ["co_terminated_volume_change_pct"]
)

# Curated models and marts: model, decimal columns, double columns.
_MODEL_QUERIES = {
    "c01_claims_portfolio": ("q_claims", " ".join(catalog.CLAIMS_NUMERIC_COLUMNS), ""),
    "c02_reinsurance_incoming": (
        "q_incoming",
        " ".join(c for c in catalog.INCOMING_COLUMNS if c in catalog.REINSURANCE_NUMERIC_COLUMNS),
        "",
    ),
    "c03_reinsurance_outgoing": (
        "q_outgoing",
        " ".join(c for c in catalog.OUTGOING_COLUMNS if c in catalog.REINSURANCE_NUMERIC_COLUMNS),
        "",
    ),
    "c04_balance_sheet": ("q_balance", " ".join(catalog.BALANCE_SHEET_CODES.values()), ""),
    "c05_financial_performance": ("q_performance", " ".join(catalog.PERFORMANCE_CODES.values()), ""),
    "c06_investment_activity": ("q_investment", "amount", ""),
    "c07_insurance_premium": ("q_premium", "premium_amount liability_amount", ""),
    "c08_agency_commissions": ("q_commission", "commission_amount_uzs", ""),
    "c09_subrogation_recoveries": ("q_recovery", "total_recovery_amount exact_recovery_amount undefined_recovery_amount", ""),
    "c10_terminated_contracts": (
        "q_terminated",
        "terminated_amount returned_amount remainder_amount returned_sum retention_amount",
        "",
    ),
    "c11_deposits": ("q_deposits", "deposit_amount", ""),
    "c12_loans": ("q_loans", "loan_amount paid_amount payable_amount remaining_balance", "repayment_progress_pct"),
    "c13_product_dimension": ("q_products", "", ""),
    "c14_solvency_adequacy_ratio": (
        "q_solvency",
        "actual_solvency_margin_adequacy_ratio required_solvency_margin_adequacy_ratio",
        "",
    ),
    "m01_financial_kpi": ("q_kpi", "net_profit", "roa roe"),
    "m02_agency_commissions_monthly": (
        "q_commission_monthly",
        "total_commission_volume_uzs legal_entity_commission_volume_uzs individual_commission_volume_uzs",
        "",
    ),
    "m03_bank_partner_performance_monthly": (
        "q_bank",
        "insurance_premium_volume_uzs agency_commission_volume_uzs insurance_claims_volume_uzs recovery_from_bank_uzs "
        "insurance_profit_volume_uzs avg_recovery_processing_time_days",
        "",
    ),
    "m04_financial_ratios_monthly": (
        "q_ratios",
        _RATIO_DEC,
        "loss_ratio_pct expense_ratio_pct combined_ratio_pct reinsurance_level_pct",
    ),
    "m05_financial_stability_monthly": (
        "q_stability",
        "cash_and_equivalents_a410 total_claims_incurred solvency_margin_adequacy_ratio_actual "
        "solvency_margin_adequacy_ratio_required",
        "cash_to_claims_ratio_actual cash_to_claims_ratio_required",
    ),
    "m06_insurance_operations_monthly": (
        "q_operations",
        "insurance_premium_volume_uzs insurance_claims_volume_uzs insurance_liabilities_volume_uzs terminated_contracts_volume_uzs",
        "loss_ratio_pct",
    ),
    "m07_insurance_reserves_monthly": (
        "q_reserves",
        "upr ibnr rbns calculated_p580_check stabilization_reserve total_assets total_reserves_denominator",
        "allocated_assets_to_reserves_pct",
    ),
    "m08_investment_portfolio_monthly": (
        "q_portfolio",
        "total_investment_portfolio_volume_uzs total_investment_category_amount_uzs "
        "total_investment_income_portfolio_volume_uzs total_investment_income_category_amount_uzs",
        "total_investment_category_pct total_investment_income_category_pct",
    ),
    "m09_investment_partner_indicators_monthly": ("q_partners", "portfolio_amount_uzs income_amount_uzs", ""),
    "m10_operational_efficiency_monthly": (
        "q_efficiency",
        "operating_expenses_sum operating_income_sum total_expenses_f090 total_revenue_f060 financial_income_f140",
        "cir_pct",
    ),
    "m11_reinsurance_monthly": (
        "q_reinsurance",
        "incoming_reinsurance_volume_uzs outgoing_reinsurance_volume_uzs",
        "reinsurance_level_pct",
    ),
    "m12_reinsurance_indicators": (
        "q_type_years",
        _YEARS.format("outgoing") + " " + _YEARS.format("incoming"),
        "outgoing_pct_change_yoy incoming_pct_change_yoy",
    ),
    "m13_reinsurance_indicators_reinsurer": (
        "q_who_years",
        _YEARS.format("outgoing") + " " + _YEARS.format("incoming"),
        "outgoing_pct_change_yoy incoming_pct_change_yoy",
    ),
    "m14_subrogation_indicators_monthly": (
        "q_recovery_monthly",
        "total_subrogation_volume_uzs exact_subrogation_volume_uzs undefined_subrogation_volume_uzs",
        "",
    ),
    "m15_insurance_volume_indicators": ("q_volume", _VOLUME_DEC, _VOLUME_DBL),
}

_IN_FORCE = "o.anketa_id IN (SELECT tb_anketa FROM q_in_force)"
_SPARSE = """SELECT l_returnflag AS source_name, CASE WHEN l_linenumber % 2 = 0 THEN l_orderkey END AS a,
    CASE WHEN l_linenumber % 3 = 0 THEN l_linestatus END AS b, CASE WHEN l_quantity > 25 THEN l_partkey END AS c FROM lineitem"""
_EMPTY = "a IS NULL AND b IS NULL AND c IS NULL"
_BLANK = "chr(32) || chr(9) || chr(10) || chr(13)"
_MAPPED = {"record_id": "CAST(l_orderkey AS VARCHAR)", "branch_name": "l_returnflag",
           "insurance_type": "CASE WHEN l_linenumber = 1 THEN NULL ELSE l_linestatus END",
           "payout_date": "substr(CAST(l_shipdate AS VARCHAR), 1, 10)",
           "payout_total": "CAST(CAST(l_extendedprice AS DECIMAL(22,2)) AS VARCHAR)"}
_S05_TEXT = """
    SELECT l_orderkey AS row_key,
           CASE l_linenumber % 3 WHEN 0 THEN substr(CAST(l_shipdate AS VARCHAR), 1, 10) WHEN 1 THEN '02.01.2025' ELSE '2025' END AS d,
           CASE l_linenumber % 4 WHEN 0 THEN concat(CAST(l_partkey AS VARCHAR), '.7') WHEN 1 THEN concat('-', CAST(l_partkey AS VARCHAR), '.7')
                WHEN 2 THEN 'x1' ELSE CAST(l_partkey AS VARCHAR) END AS i,
           CASE l_linenumber % 4 WHEN 0 THEN concat(' ', CAST(CAST(l_extendedprice AS DECIMAL(22,2)) AS VARCHAR), ' ') WHEN 1 THEN '1 234,56'
                WHEN 2 THEN concat(CAST(l_partkey AS VARCHAR), ' UZS') ELSE CAST(l_partkey AS VARCHAR) END AS n,
           CASE l_linenumber % 3 WHEN 0 THEN '  ' WHEN 1 THEN concat('  ', l_returnflag) ELSE NULL END AS t
    FROM lineitem"""
_FP_CODES = f"""SELECT r.report_date, e.key AS code, CAST(e.value AS {A}) AS amount
    FROM financial_performance_api_response r, json_each(r.payload_json, '$.OperationResult') e
    WHERE e.key <> 'Result' AND e.type IN ('UBIGINT', 'BIGINT', 'DOUBLE')"""
_PRICE = f"""SELECT o_orderpriority, CAST(date_trunc('month', o_orderdate) AS DATE) AS report_month,
    sum(CAST(o_totalprice AS {A})) AS amount FROM orders GROUP BY 1, 2"""
_PARTNER = "coalesce(nullif(trim(tb_orgname), ''), nullif(trim(tb_name), ''))"


def _product_sum(table: str, key: str, date: str, amount: str, name: str) -> str:
    return f"""(SELECT year({date}) AS report_year, p.pturi_id, sum({amount}) AS {name}
        FROM {table} t LEFT JOIN ins_polis p ON t.{key} = p.tb_id GROUP BY 1, 2)"""


_PREM = _product_sum("ins_oplata", "polis_id", "opl_data", "oplata", "premium")
_CLAIM = _product_sum("ins_viplati", "sobitie_id", "date_viplata", "viplate", "claims")
_TERM = _product_sum("ins_rastorg", "tb_polis", "tb_dateras", "tb_summa", "terminated")


def _month_sum(table: str, date: str, amount: str, name: str) -> str:
    return f"(SELECT CAST(date_trunc('month', {date}) AS DATE) AS report_month, sum({amount}) AS {name} FROM {table} GROUP BY 1)"


_PAID = _month_sum("ins_oplata", "opl_data", "oplata", "paid")
_BANKED = _month_sum("ins_bank_client", "pym_date", "pym_summa", "banked")
_ENDED = _month_sum("ins_rastorg", "tb_dateras", "tb_summa", "terminated")


def _by_start(table: str, date: str, amount: str, name: str) -> str:
    return f"(SELECT CAST(date_trunc('month', {date}) AS DATE) AS report_month, client_id, sum({amount}) AS {name} FROM {table} GROUP BY 1, 2)"


_MOTOR = "SELECT * FROM q_motor"

_QUERIES = {
    "c01_claims_portfolio": ("q_claims", " ".join(catalog.CLAIMS_NUMERIC_COLUMNS), ""),
    "c02_reinsurance_incoming": (
        "q_incoming",
        " ".join(c for c in catalog.INCOMING_COLUMNS if c in catalog.REINSURANCE_NUMERIC_COLUMNS),
        "",
    ),
    "c03_reinsurance_outgoing": (
        "q_outgoing",
        " ".join(c for c in catalog.OUTGOING_COLUMNS if c in catalog.REINSURANCE_NUMERIC_COLUMNS),
        "",
    ),
    "c04_balance_sheet": ("q_balance", " ".join(catalog.BALANCE_SHEET_CODES.values()), ""),
    "c05_financial_performance": ("q_performance", " ".join(catalog.PERFORMANCE_CODES.values()), ""),
    "c06_investment_activity": ("q_investment", "amount", ""),
    "c07_insurance_premium": ("q_premium", "premium_amount liability_amount", ""),
    "c08_agency_commissions": ("q_commission", "commission_amount_uzs", ""),
    "c09_subrogation_recoveries": ("q_recovery", "total_recovery_amount exact_recovery_amount undefined_recovery_amount", ""),
    "c10_terminated_contracts": (
        "q_terminated",
        "terminated_amount returned_amount remainder_amount returned_sum retention_amount",
        "",
    ),
    "c11_deposits": ("q_deposits", "deposit_amount", ""),
    "c12_loans": ("q_loans", "loan_amount paid_amount payable_amount remaining_balance", "repayment_progress_pct"),
    "c13_product_dimension": ("q_products", "", ""),
    "c14_solvency_adequacy_ratio": (
        "q_solvency",
        "actual_solvency_margin_adequacy_ratio required_solvency_margin_adequacy_ratio",
        "",
    ),
    "m01_financial_kpi": ("q_kpi", "net_profit", "roa roe"),
    "m02_agency_commissions_monthly": (
        "q_commission_monthly",
        "total_commission_volume_uzs legal_entity_commission_volume_uzs individual_commission_volume_uzs",
        "",
    ),
    "m03_bank_partner_performance_monthly": (
        "q_bank",
        "insurance_premium_volume_uzs agency_commission_volume_uzs insurance_claims_volume_uzs recovery_from_bank_uzs "
        "insurance_profit_volume_uzs avg_recovery_processing_time_days",
        "",
    ),
    "m04_financial_ratios_monthly": (
        "q_ratios",
        _RATIO_DEC,
        "loss_ratio_pct expense_ratio_pct combined_ratio_pct reinsurance_level_pct",
    ),
    "m05_financial_stability_monthly": (
        "q_stability",
        "cash_and_equivalents_a410 total_claims_incurred solvency_margin_adequacy_ratio_actual "
        "solvency_margin_adequacy_ratio_required",
        "cash_to_claims_ratio_actual cash_to_claims_ratio_required",
    ),
    "m06_insurance_operations_monthly": (
        "q_operations",
        "insurance_premium_volume_uzs insurance_claims_volume_uzs insurance_liabilities_volume_uzs terminated_contracts_volume_uzs",
        "loss_ratio_pct",
    ),
    "m07_insurance_reserves_monthly": (
        "q_reserves",
        "upr ibnr rbns calculated_p580_check stabilization_reserve total_assets total_reserves_denominator",
        "allocated_assets_to_reserves_pct",
    ),
    "m08_investment_portfolio_monthly": (
        "q_portfolio",
        "total_investment_portfolio_volume_uzs total_investment_category_amount_uzs "
        "total_investment_income_portfolio_volume_uzs total_investment_income_category_amount_uzs",
        "total_investment_category_pct total_investment_income_category_pct",
    ),
    "m09_investment_partner_indicators_monthly": ("q_partners", "portfolio_amount_uzs income_amount_uzs", ""),
    "m10_operational_efficiency_monthly": (
        "q_efficiency",
        "operating_expenses_sum operating_income_sum total_expenses_f090 total_revenue_f060 financial_income_f140",
        "cir_pct",
    ),
    "m11_reinsurance_monthly": (
        "q_reinsurance",
        "incoming_reinsurance_volume_uzs outgoing_reinsurance_volume_uzs",
        "reinsurance_level_pct",
    ),
    "m12_reinsurance_indicators": (
        "q_type_years",
        _YEARS.format("outgoing") + " " + _YEARS.format("incoming"),
        "outgoing_pct_change_yoy incoming_pct_change_yoy",
    ),
    "m13_reinsurance_indicators_reinsurer": (
        "q_who_years",
        _YEARS.format("outgoing") + " " + _YEARS.format("incoming"),
        "outgoing_pct_change_yoy incoming_pct_change_yoy",
    ),
    "m14_subrogation_indicators_monthly": (
        "q_recovery_monthly",
        "total_subrogation_volume_uzs exact_subrogation_volume_uzs undefined_subrogation_volume_uzs",
        "",
    ),
    "m15_insurance_volume_indicators": ("q_volume", _VOLUME_DEC, _VOLUME_DBL),
}

_IN_FORCE = "o.anketa_id IN (SELECT tb_anketa FROM q_in_force)"
_SPARSE = """SELECT l_returnflag AS source_name, CASE WHEN l_linenumber % 2 = 0 THEN l_orderkey END AS a,
    CASE WHEN l_linenumber % 3 = 0 THEN l_linestatus END AS b, CASE WHEN l_quantity > 25 THEN l_partkey END AS c FROM lineitem"""
_EMPTY = "a IS NULL AND b IS NULL AND c IS NULL"
_BLANK = "chr(32) || chr(9) || chr(10) || chr(13)"
_MAPPED = {"record_id": "CAST(l_orderkey AS VARCHAR)", "branch_name": "l_returnflag",
           "insurance_type": "CASE WHEN l_linenumber = 1 THEN NULL ELSE l_linestatus END",
           "payout_date": "substr(CAST(l_shipdate AS VARCHAR), 1, 10)",
           "payout_total": "CAST(CAST(l_extendedprice AS DECIMAL(22,2)) AS VARCHAR)"}
_S05_TEXT = """
    SELECT l_orderkey AS row_key,
           CASE l_linenumber % 3 WHEN 0 THEN substr(CAST(l_shipdate AS VARCHAR), 1, 10) WHEN 1 THEN '02.01.2025' ELSE '2025' END AS d,
           CASE l_linenumber % 4 WHEN 0 THEN concat(CAST(l_partkey AS VARCHAR), '.7') WHEN 1 THEN concat('-', CAST(l_partkey AS VARCHAR), '.7')
                WHEN 2 THEN 'x1' ELSE CAST(l_partkey AS VARCHAR) END AS i,
           CASE l_linenumber % 4 WHEN 0 THEN concat(' ', CAST(CAST(l_extendedprice AS DECIMAL(22,2)) AS VARCHAR), ' ') WHEN 1 THEN '1 234,56'
                WHEN 2 THEN concat(CAST(l_partkey AS VARCHAR), ' UZS') ELSE CAST(l_partkey AS VARCHAR) END AS n,
           CASE l_linenumber % 3 WHEN 0 THEN '  ' WHEN 1 THEN concat('  ', l_returnflag) ELSE NULL END AS t
    FROM lineitem"""
_FP_CODES = f"""SELECT r.report_date, e.key AS code, CAST(e.value AS {A}) AS amount
    FROM financial_performance_api_response r, json_each(r.payload_json, '$.OperationResult') e
    WHERE e.key <> 'Result' AND e.type IN ('UBIGINT', 'BIGINT', 'DOUBLE')"""
_PRICE = f"""SELECT o_orderpriority, CAST(date_trunc('month', o_orderdate) AS DATE) AS report_month,
    sum(CAST(o_totalprice AS {A})) AS amount FROM orders GROUP BY 1, 2"""
_PARTNER = "coalesce(nullif(trim(tb_orgname), ''), nullif(trim(tb_name), ''))"


def _product_sum(table: str, key: str, date: str, amount: str, name: str) -> str:
    return f"""(SELECT year({date}) AS report_year, p.pturi_id, sum({amount}) AS {name}
        FROM {table} t LEFT JOIN ins_polis p ON t.{key} = p.tb_id GROUP BY 1, 2)"""


_PREM = _product_sum("ins_oplata", "polis_id", "opl_data", "oplata", "premium")
_CLAIM = _product_sum("ins_viplati", "sobitie_id", "date_viplata", "viplate", "claims")
_TERM = _product_sum("ins_rastorg", "tb_polis", "tb_dateras", "tb_summa", "terminated")


def _month_sum(table: str, date: str, amount: str, name: str) -> str:
    return f"(SELECT CAST(date_trunc('month', {date}) AS DATE) AS report_month, sum({amount}) AS {name} FROM {table} GROUP BY 1)"


_PAID = _month_sum("ins_oplata", "opl_data", "oplata", "paid")
_BANKED = _month_sum("ins_bank_client", "pym_date", "pym_summa", "banked")
_ENDED = _month_sum("ins_rastorg", "tb_dateras", "tb_summa", "terminated")


def _by_start(table: str, date: str, amount: str, name: str) -> str:
    return f"(SELECT CAST(date_trunc('month', {date}) AS DATE) AS report_month, client_id, sum({amount}) AS {name} FROM {table} GROUP BY 1, 2)"


_MOTOR = f"""SELECT CAST(bc.pym_date AS DATE) AS payment_date, 21 AS source_query_id, t.tb_id AS anketa_id,
    CAST(0 AS {A}) AS premium_amount, coalesce(p.tb_summa, 0) AS liability_amount
    FROM tb_anketa t JOIN tb_polis p ON t.tb_id = p.tb_anketa JOIN tb_oplata o ON t.tb_id = o.tb_anketa
    JOIN tb_avto v ON t.tb_id = v.tb_anketa JOIN ins_bank_client bc ON o.bc_id = bc.ins_id AND bc.status = 2
    WHERE o.tb_typepl = 1 AND p.tb_status IN (2, 8)"""

_QUERIES = {
    "s01_positional_landing": """SELECT CAST(o_custkey AS VARCHAR) AS seq_number, o_orderstatus AS insurance_contract_number,
        o_orderpriority AS policyholder, CAST(NULL AS VARCHAR) AS insurance_type, CAST(NULL AS VARCHAR) AS voluntary_insurance_type,
        o_orderkey AS row_no FROM orders WHERE o_orderkey > 7""",
    "s02_index_projection": "SELECT "
    + ", ".join(f"{_MAPPED.get(c, 'CAST(NULL AS VARCHAR)')} AS {c}" for c in catalog.CLAIMS_COLUMNS)
    + " FROM lineitem",
    "s03_drop_empty": f"SELECT * FROM ({_SPARSE}) t WHERE NOT ({_EMPTY})",
    "s04_lineage": "SELECT o_orderkey, 'orders.parquet | portfolio' AS source_file, true AS has_load_time FROM orders",
    "s05_typed_clean": f"""SELECT row_key, {_date('d')} AS contract_start_date,
        CAST(trunc(TRY_CAST(i AS DOUBLE)) AS INTEGER) AS insurance_days_count,
        CAST(TRY_CAST(trim(n) AS {A}) AS DECIMAL(38,10)) AS insurance_premium_policy, nullif(trim(t), '') AS region FROM ({_S05_TEXT}) x""",
    "s06_text_clean": f"""SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') AS o_orderdate,
        CASE WHEN o_orderstatus = 'P' THEN NULL ELSE trim(o_orderstatus, {_BLANK}) END AS status, CAST(o_custkey AS VARCHAR) AS o_custkey
        FROM orders""",
    "s07_route_files": """SELECT o_orderkey, f AS source_file, CASE WHEN contains(lower(f), 'claim') THEN 'claims'
        WHEN contains(lower(f), 'reinsur') THEN 'reinsurance' WHEN contains(lower(f), 'solvency') THEN 'solvency' END AS route
        FROM (SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN 'Claims_2024.csv' WHEN '2-HIGH' THEN 'out REINSURANCE.csv'
                     WHEN '3-MEDIUM' THEN 'q1_solvency.csv' ELSE 'other.csv' END AS f FROM orders) t""",
    "s09_append_columns": """SELECT CAST(c_custkey AS VARCHAR) AS record_id, c_name AS client_name, CAST(NULL AS VARCHAR) AS branch_name FROM customer
        UNION ALL SELECT CAST(s_suppkey AS VARCHAR), s_name, CAST(s_nationkey AS VARCHAR) FROM supplier""",
    "s10_latest_wins": """SELECT user_id, event_type, ts, event_id, round(value, 6) AS value FROM (
        SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS n FROM events) t WHERE n = 1""",
    "s11_code_rows": finish(_FP_CODES, "amount"),
    "s12_json_long": finish(
        f"""WITH entries AS (SELECT r.report_date, e.key, e.value, e.type
                FROM investment_activity_api_response r, json_each(r.payload_json, '$.OperationResult') e WHERE e.key <> 'Result')
        SELECT report_date, key AS category, CAST(NULL AS VARCHAR) AS partner, CAST(NULL AS VARCHAR) AS contract, CAST(value AS {A}) AS amount
        FROM entries WHERE type IN ('UBIGINT', 'BIGINT', 'DOUBLE')
        UNION ALL
        SELECT report_date, key, json_extract_string(item, '$.partner'), json_extract_string(item, '$.contract'),
               CASE WHEN json_exists(item, '$.amount') THEN TRY_CAST(nullif(json_extract_string(item, '$.amount'), '') AS {A}) ELSE 0 END
        FROM (SELECT report_date, key, unnest(CAST(value AS JSON[])) AS item FROM entries WHERE type = 'ARRAY') t""",
        "amount",
    ),
    "s13_upsert_codes": finish(
        f"""WITH stored AS ({_FP_CODES}), incoming AS (
            SELECT report_date, CASE WHEN code = 'F320' THEN 'F999' ELSE code END AS code, amount + 1 AS amount FROM stored
            WHERE report_date >= DATE '2000-01-01')
        SELECT * FROM incoming UNION ALL
        SELECT * FROM stored s WHERE NOT EXISTS (SELECT 1 FROM incoming i WHERE i.report_date = s.report_date AND i.code = s.code)""",
        "amount",
    ),
    "s14_replace_slice": """WITH incoming AS (SELECT CAST(o_orderdate AS DATE) AS report_date, -o_orderkey AS o_orderkey, o_orderstatus FROM orders
            WHERE o_orderstatus = 'P' AND o_orderpriority = '1-URGENT')
        SELECT CAST(o_orderdate AS DATE) AS report_date, o_orderkey, o_orderstatus FROM orders
        WHERE CAST(o_orderdate AS DATE) NOT IN (SELECT report_date FROM incoming) UNION ALL SELECT * FROM incoming""",
    "s15_typed_snapshot": """SELECT o_orderkey, CAST(o_custkey AS INTEGER) AS o_custkey, o_orderstatus,
        CAST(CAST(o_totalprice AS DECIMAL(15,2)) AS DECIMAL(38,10)) AS o_totalprice, o_orderdate, o_orderpriority FROM orders""",
    "s16_refresh_decision": """SELECT table_id, CASE WHEN n <= 5 THEN 'CREATED' WHEN loaded IS NULL THEN 'RELOADED'
            WHEN table_id % 2 = 0 THEN CASE WHEN loaded < changed THEN 'RELOADED' ELSE 'SKIPPED' END
            WHEN loaded < TIMESTAMP '2000-12-30 00:00:00' THEN 'RELOADED' ELSE 'SKIPPED' END AS decision
        FROM (SELECT o_custkey AS table_id, max(CASE WHEN o_orderstatus = 'F' THEN o_orderdate END) AS loaded, max(o_orderdate) AS changed,
                     count(*) AS n FROM orders GROUP BY 1) t""",
    "s17_load_stamps": """SELECT c_custkey, c_name, (SELECT min(o_orderdate) FROM orders) AS etl_uploaded_date,
        TIMESTAMP '2000-12-31 08:00:00' AS etl_updated_date FROM customer""",
    "s18_reconcile": """WITH s AS (SELECT 'orders' AS table_name, count(*) AS source_rows FROM orders UNION ALL
            SELECT 'lineitem', count(*) FROM lineitem UNION ALL SELECT 'customer', count(*) FROM customer),
        t AS (SELECT 'orders' AS table_name, count(*) AS target_rows FROM orders WHERE o_orderstatus = 'F' UNION ALL
            SELECT 'lineitem', count(*) FROM lineitem UNION ALL SELECT 'part', count(*) FROM part)
        SELECT coalesce(s.table_name, t.table_name) AS table_name, source_rows, target_rows,
               coalesce(source_rows, 0) - coalesce(target_rows, 0) AS difference FROM s FULL JOIN t ON s.table_name = t.table_name""",
    "s19_profile": " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count({c}) AS non_null, count(*) AS total_rows FROM q_claims" for c in catalog.CLAIMS_COLUMNS
    ),
    "s20_load_summary": f"""SELECT source_name, count(*) AS rows_read, count(*) FILTER (WHERE {_EMPTY}) AS rows_skipped,
        count(*) FILTER (WHERE NOT ({_EMPTY})) AS rows_inserted FROM ({_SPARSE}) t GROUP BY 1""",
    "s21_month_end_calendar": """SELECT m.report_date, coalesce(n, 0) AS n_landed FROM (
            SELECT CAST(last_day(CAST(d AS DATE)) AS DATE) AS report_date
            FROM (SELECT unnest(generate_series(TIMESTAMP '1995-01-01', TIMESTAMP '2000-12-31', INTERVAL 1 MONTH)) AS d) t) m
        LEFT JOIN (SELECT CAST(last_day(o_orderdate) AS DATE) AS report_date, count(*) AS n FROM orders GROUP BY 1) o ON o.report_date = m.report_date""",
    "s23_harmonised_headers": """SELECT CAST(o_orderkey AS VARCHAR) AS record_id, CAST(o_custkey AS VARCHAR) AS insurance_class,
            o_orderstatus AS "класс", CAST(NULL AS VARCHAR) AS some_field, CAST(NULL AS VARCHAR) AS client_name FROM orders
        UNION ALL SELECT CAST(c_custkey AS VARCHAR), NULL, NULL, CAST(c_nationkey AS VARCHAR), c_name FROM customer""",
    "f01_rename": finish("SELECT ins_id AS loan_id, loan_num AS loan_number, loan_sum AS loan_amount FROM ins_invloan", "loan_amount"),
    "f02_predicates": """SELECT ins_id, bc_type, status FROM ins_bank_client WHERE (bc_type <> 2 OR status = 2) AND pym_date IS NOT NULL
        AND pym_date >= DATE '1999-01-01' AND pym_date < DATE '2000-01-01'""",
    "f03_in_list": "SELECT tb_id, tb_status FROM ins_polis WHERE tb_status IN (2, 9, 10)",
    "f04_flag_in": """SELECT o_orderkey, o_orderstatus = 'F' AS text_is_1, 1 + o_custkey % 2 = 1 AS number_is_1 FROM orders""",
    "f05_regex_guard": """SELECT ins_id, regexp_full_match(kod_num, '[0-9]+') AND coalesce(TRY_CAST(kod_num AS BIGINT), 0) IN
        (3, 108, 123, 210, 211, 218, 401, 402, 418) AS compulsory FROM ins_pturi""",
    "f06_ilike_class": """SELECT p_partkey, CASE WHEN p_type ILIKE '%stand%' THEN 'Compulsory' WHEN p_type ILIKE '%pro%' THEN 'Voluntary'
        WHEN p_type ILIKE '%standard%' THEN 'never' WHEN p_type ILIKE '%med%' THEN 'Voluntary' END AS insurance_type FROM part""",
    "f07_semi_join": f"SELECT o.ins_id, o.anketa_id FROM ins_oplata o WHERE {_IN_FORCE}",
    "f08_row_tags": "SELECT ins_id, 21 AS source_query_id, 'Actual' AS scenario FROM ins_oplata",
    "f09_typed_null": "SELECT tb_polis, CAST(NULL AS DECIMAL(38,10)) AS insurance_profit_volume_uzs FROM ins_rastorg",
    "j01_inner": "SELECT o.ins_id, b.ins_id AS bank_id, b.pym_date FROM ins_oplata o JOIN ins_bank_client b ON o.bc_id = b.ins_id",
    "j02_left_keys": finish(
        f"""SELECT d.report_month, d.client_id, d.deposit_amount, l.loan_amount FROM {_by_start('ins_invdep', 'depdate_from', 'dep_sum', 'deposit_amount')} d
        LEFT JOIN {_by_start('ins_invloan', 'loandate_from', 'loan_sum', 'loan_amount')} l
        ON d.report_month = l.report_month AND d.client_id = l.client_id""",
        "deposit_amount loan_amount",
    ),
    "j03_left_literal": finish(
        "SELECT o.ins_id, b.ins_id AS bank_id, b.pym_summa FROM ins_oplata o LEFT JOIN ins_bank_client b ON o.bc_id = b.ins_id AND b.status = 2",
        "pym_summa",
    ),
    "j04_left_then_filter": """SELECT o.ins_id, a.ins_id AS contract_id FROM ins_oplata o LEFT JOIN ins_anketa a ON o.anketa_id = a.ins_id
        WHERE a.fizyur = 1""",
    "j05_full_merge": finish(
        f"""SELECT coalesce(p.report_year, c.report_year, t.report_year) AS report_year, coalesce(p.pturi_id, c.pturi_id, t.pturi_id) AS pturi_id,
        coalesce(premium, 0) AS premium, coalesce(claims, 0) AS claims, coalesce(terminated, 0) AS terminated
        FROM {_PREM} p FULL JOIN {_CLAIM} c ON c.report_year = p.report_year AND c.pturi_id = p.pturi_id
        FULL JOIN {_TERM} t ON t.report_year = coalesce(p.report_year, c.report_year) AND t.pturi_id = coalesce(p.pturi_id, c.pturi_id)""",
        "premium claims terminated",
    ),
    "j06_year_slices": finish(
        f"""SELECT coalesce(c.o_custkey, p.o_custkey) AS o_custkey, coalesce(p.v, 0) AS py, coalesce(c.v, 0) AS cy
        FROM (SELECT o_custkey, sum(CAST(o_totalprice AS {A})) AS v FROM orders WHERE year(o_orderdate) = 2000 GROUP BY 1) c
        FULL JOIN (SELECT o_custkey, sum(CAST(o_totalprice AS {A})) AS v FROM orders WHERE year(o_orderdate) = 1999 GROUP BY 1) p
        ON c.o_custkey = p.o_custkey""",
        "py cy",
    ),
    "j07_parameter_row": """SELECT o_orderkey, y - 1 AS prior_year, y AS current_year FROM orders
        CROSS JOIN (SELECT max(year(o_orderdate)) AS y FROM orders) t""",
    "j08_active_interval": finish(
        """SELECT d.val_type, m.report_month, sum(d.dep_sum) AS amount, count(*) AS n_open FROM q_months m
        JOIN ins_invdep d ON d.depdate_from <= m.report_month AND (d.depdate_to IS NULL OR d.depdate_to > m.report_month) GROUP BY 1, 2""",
        "amount",
    ),
    "j09_explode_months": """SELECT ins_id, CAST(unnest(generate_series(date_trunc('month', loandate_from),
        date_trunc('month', coalesce(loandate_to, DATE '2000-12-31')), INTERVAL 1 MONTH)) AS DATE) AS month FROM ins_invloan""",
    "j10_semi_recovery": finish(
        "SELECT ins_id, pym_summa FROM ins_bank_client b WHERE EXISTS (SELECT 1 FROM ins_regress_bank r WHERE r.bc_id = b.ins_id)", "pym_summa"
    ),
    "j11_quarter_spread": finish(
        """SELECT m.report_month, 'Actual' AS scenario, s.actual, s.required
        FROM (SELECT DISTINCT CAST(date_trunc('month', o_orderdate) AS DATE) AS report_month FROM orders) m
        LEFT JOIN q_stability_quarter s ON year(m.report_month) = s.y AND quarter(m.report_month) = s.q""",
        "actual required",
    ),
    "j12_fan_out": finish(_MOTOR, "premium_amount liability_amount"),
    "j12_fan_out_sums": finish(
        f"SELECT payment_date, sum(liability_amount) AS liability_amount FROM ({_MOTOR}) t GROUP BY 1", "liability_amount"
    ),
    "a01_monthly_sum": finish(
        """SELECT CAST(date_trunc('month', contract_conclusion_date) AS DATE) AS report_month, sum(total_accrued_premium_uzs) AS volume
        FROM reinsurance_outgoing_portfolio GROUP BY 1""",
        "volume",
    ),
    "a02_group_by_expression": f"""SELECT coalesce({_PARTNER}, 'Direct/No Partner') AS bank_partner_name, count(*) AS n
        FROM ins_kontragent GROUP BY 1""",
    "a03_conditional_sum": finish(
        """SELECT insurance_type, sum(CASE WHEN year(contract_conclusion_date) = 1999 THEN total_accrued_premium_uzs ELSE 0 END) AS volume_1999,
        sum(CASE WHEN year(contract_conclusion_date) = 2000 THEN total_accrued_premium_uzs ELSE 0 END) AS volume_2000
        FROM reinsurance_incoming_portfolio GROUP BY 1""",
        "volume_1999 volume_2000",
    ),
    "a04_converted_sum": finish(
        """SELECT year(opl_data) AS pay_year, sum(CASE WHEN opl_val = 1 THEN coalesce(oplata, 0)
        ELSE coalesce(opl_summa, 0) * coalesce(val_kurs, 1) END) AS premium_uzs FROM ins_oplata GROUP BY 1""",
        "premium_uzs",
    ),
    "a05_min_max": "SELECT val_type, min(depdate_from) AS first_start, max(depdate_from) AS last_start FROM ins_invdep GROUP BY 1",
    "a06_count": "SELECT tb_status, count(*) AS n FROM ins_polis GROUP BY 1",
    "a07_distinct": "SELECT DISTINCT CAST(date_trunc('month', opl_data) AS DATE) AS report_month, ins_type FROM ins_oplata",
    "a08_two_stage": finish(
        f"""SELECT p.report_year, d.insurance_type, d.category, sum(p.premium) AS premium FROM {_PREM} p
        JOIN q_products d ON d.pturi_id = p.pturi_id GROUP BY 1, 2, 3""",
        "premium",
    ),
    "a09_global": finish("SELECT sum(oplata) AS total, count(*) AS n, max(opl_data) AS last_day FROM ins_oplata", "total"),
    "w01_lag_change": finish(
        f"SELECT *, amount - lag(amount, 1, 0) OVER (PARTITION BY o_orderpriority ORDER BY report_month) AS change FROM ({_PRICE}) t",
        "amount change",
    ),
    "w02_group_total": finish(
        "SELECT ins_id, client_id, loan_sum, sum(loan_sum) OVER (PARTITION BY client_id) AS client_total FROM ins_invloan",
        "loan_sum client_total",
    ),
    "w03_share_of_total": finish(
        f"""SELECT *, CASE WHEN month_total = 0 THEN 0 ELSE CAST(amount AS DOUBLE) / CAST(month_total AS DOUBLE) * 100.0 END AS share_pct
        FROM (SELECT *, sum(amount) OVER (PARTITION BY report_month) AS month_total FROM ({_PRICE}) p) t""",
        "amount month_total",
        "share_pct",
    ),
    "o01_report_order": finish(f"SELECT * FROM ({_PRICE}) t ORDER BY report_month DESC NULLS FIRST, o_orderpriority NULLS LAST", "amount"),
    "o02_order_by_case": """SELECT pturi_id, insurance_type, category, product_name FROM q_products
        ORDER BY CASE insurance_type WHEN 'Compulsory' THEN 1 ELSE 2 END, category NULLS LAST, product_name NULLS LAST""",
    "o03_preview": finish(
        """SELECT record_id, client_name, payout_date, payout_total FROM q_claims
        ORDER BY payout_total DESC NULLS FIRST, record_id NULLS LAST, payout_date NULLS LAST, client_name NULLS LAST LIMIT 5""",
        "payout_total",
    ),
    "e01_union_all": finish(
        """SELECT ins_id, oplata AS amount, 1 AS source_query_id FROM ins_oplata UNION ALL
        SELECT tb_id, tb_summa, 21 FROM tb_oplata""",
        "amount",
    ),
    "e02_spine_union": """SELECT CAST(date_trunc('month', opl_data) AS DATE) AS report_month, 'Actual' AS scenario FROM ins_oplata
        UNION SELECT CAST(date_trunc('month', pym_date) AS DATE), 'Actual' FROM ins_bank_client
        UNION SELECT CAST(date_trunc('month', tb_dateras) AS DATE), 'Actual' FROM ins_rastorg""",
    "e02_spine_merge": finish(
        f"""SELECT s.report_month, coalesce(paid, 0) AS paid, coalesce(banked, 0) AS banked, coalesce(terminated, 0) AS terminated
        FROM (SELECT report_month FROM {_PAID} UNION SELECT report_month FROM {_BANKED} UNION SELECT report_month FROM {_ENDED}) s
        LEFT JOIN {_PAID} a ON a.report_month = s.report_month LEFT JOIN {_BANKED} b ON b.report_month = s.report_month
        LEFT JOIN {_ENDED} c ON c.report_month = s.report_month""",
        "paid banked terminated",
    ),
    "e03_expand_categories": finish(
        """SELECT tb_polis, 'terminated' AS category, tb_summa AS amount FROM ins_rastorg UNION ALL
        SELECT tb_polis, 'returned', vernut FROM ins_rastorg UNION ALL SELECT tb_polis, 'retained', retention FROM ins_rastorg""",
        "amount",
    ),
    "x01_clean_numeric": finish(f"SELECT record_id, payout_total, {_number('payout_total')} AS amount FROM claims_portfolio", "amount"),
    "x02_clean_date": f"SELECT record_id, payout_date, {_date('payout_date')} AS paid_on FROM claims_portfolio",
    "x03_to_date": """SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN CAST(o_orderdate AS DATE) END AS report_date FROM orders""",
    "x04_text_chain": f"SELECT tb_id, coalesce({_PARTNER}, 'Direct/No Partner') AS partner FROM ins_kontragent",
    "x05_regex_text": "SELECT c_custkey, regexp_extract(replace(c_name, '#', ' '), '([0-9]+)', 1) AS digits FROM customer",
    "x06_month_start": "SELECT o_orderkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS report_month FROM orders",
    "x07_month_end": """SELECT event_id, CAST(last_day(ts) AS DATE) AS month_end,
        CAST(CASE WHEN CAST(last_day(ts) AS TIMESTAMP) >= ts THEN last_day(ts) ELSE last_day(last_day(ts) + INTERVAL 1 DAY) END AS DATE)
        AS first_month_end FROM events""",
    "x08_year_quarter": "SELECT o_orderkey, year(o_orderdate) AS report_year, quarter(o_orderdate) AS report_quarter FROM orders",
    "x09_as_of": "SELECT o_orderkey, DATE '2000-12-31' - CAST(o_orderdate AS DATE) AS age_days FROM orders",
    "x10_month_spine": """SELECT CAST(last_day(CAST(d AS DATE)) AS DATE) AS report_month FROM (SELECT unnest(generate_series(
        date_trunc('month', (SELECT min(depdate_from) FROM ins_invdep)), TIMESTAMP '2000-12-31', INTERVAL 1 MONTH)) AS d) t""",
    "x11_code_label": """SELECT ins_id, CASE status WHEN 0 THEN 'Актив' WHEN 1 THEN 'Исполненный' WHEN 2 THEN 'Досрочное погашение'
        ELSE '' END AS loan_status FROM ins_invloan""",
    "x12_round_half_up": finish(
        """SELECT l_orderkey, sum(round(CAST(l_extendedprice AS DECIMAL(22,2)) * CAST(0.125 AS DECIMAL(4,3)), 2)) AS rounded
        FROM lineitem GROUP BY 1""",
        "rounded",
    ),
    "x13_scaled_arithmetic": finish(
        f"""SELECT o_orderkey, t * CAST(0.001 AS DECIMAL(4,3)) AS thousands, t * 2 - t * CAST(0.001 AS DECIMAL(4,3)) AS mixed
        FROM (SELECT o_orderkey, CAST(o_totalprice AS {A}) AS t FROM orders) x""",
        "thousands mixed",
    ),
    "x14_guarded_ratio": finish(
        """SELECT loan_id, CASE WHEN den = 0 THEN 0 ELSE num / den END AS or_zero, CASE WHEN den <> 0 THEN num / den END AS or_null,
        CASE WHEN den > 0 THEN num / den ELSE 0 END AS if_positive
        FROM (SELECT a.loan_id, CAST(a.payable AS DOUBLE) AS den, CAST(coalesce(p.paid, 0) AS DOUBLE) AS num
              FROM (SELECT loan_id, sum(amount) AS payable FROM ins_invloan_accrual GROUP BY 1) a
              LEFT JOIN (SELECT loan_id, sum(amount) AS paid FROM ins_invloan_oplata GROUP BY 1) p ON p.loan_id = a.loan_id) t""",
        "",
        "or_zero or_null if_positive",
    ),
    "x15_json_value": finish(
        f"""SELECT report_date, CAST(json_extract_string(payload_json, '$.OperationResult.Balance.A490') AS {A}) AS total_assets,
        CAST(json_extract_string(payload_json, '$.OperationResult.Balance.P590') AS {A}) AS upr,
        CAST(json_extract_string(payload_json, '$.OperationResult.Balance.P999') AS {A}) AS missing FROM balance_sheet_api_response""",
        "total_assets upr missing",
    ),
    "x16_json_array": finish("SELECT report_date, partner_name AS partner, amount FROM q_investment WHERE investment_type = 'BOND'", "amount"),
    "x17_casts": finish(
        """SELECT p_partkey, CAST(p_retailprice AS DECIMAL(22,2)) AS amount, CAST(p_size AS VARCHAR) AS size_text,
        TRY_CAST(regexp_extract(p_brand, '([0-9]+)', 1) AS INTEGER) AS brand_number, TRY_CAST(p_type AS INTEGER) AS not_a_number FROM part""",
        "amount",
    ),
    "x18_fx_convert": finish(
        """SELECT ins_id, CASE WHEN opl_val = 1 THEN coalesce(kommis_summa, 0)
        ELSE coalesce(kommis_summa, 0) * coalesce(val_kurs, 1) END AS commission FROM ins_oplata""",
        "commission",
    ),
    "u01_asof_fx": finish("SELECT ins_id, opl_val, opl_data, rate FROM q_payment_rate", "rate"),
    "u02_partner_name": f"SELECT a.ins_id, a.owner, {_PARTNER} AS partner_name FROM ins_anketa a LEFT JOIN ins_kontragent k ON k.tb_id = a.owner",
    "u03_currency_label": """SELECT i.ins_id, i.val_type, c.name AS currency_type FROM ins_invloan i
        LEFT JOIN p_sp_currency c ON c.sp_id = i.val_type""",
    "u04_loan_paid": finish("SELECT loan_id AS ins_id, paid_amount FROM q_loans", "paid_amount"),
    "u05_loan_payable": finish("SELECT loan_id AS ins_id, payable_amount FROM q_loans", "payable_amount"),
    "u06_try_cast_date": f"""SELECT l_orderkey, day_text, {_date('day_text')} AS day FROM (
        SELECT l_orderkey, CASE WHEN l_linenumber = 2 THEN strftime(l_shipdate, '%Y-%m-%d %H:%M:%S')
            ELSE concat_ws('-', l_orderkey % 3000, l_linenumber * 3, l_partkey % 40) END AS day_text FROM lineitem) t""",
    "q01_unique": "SELECT ins_id, count(*) AS n_records FROM ins_oplata WHERE ins_id IS NOT NULL GROUP BY 1 HAVING count(*) > 1",
    "q02_not_null": "SELECT ins_id FROM ins_bank_client WHERE pym_date IS NULL",
    "q04_unfit_amounts": """SELECT 'price' AS column_name, 0 AS unfit_values, count(*) AS total_rows FROM orders UNION ALL
        SELECT 'long', count(*) FILTER (WHERE length(repeat(CAST(o_orderkey AS VARCHAR), 5)) > 18), count(*) FROM orders""",
    "q03_premium_total": finish(
        """SELECT sum(premium_amount) AS premium_total, sum(liability_amount) AS liability_total,
            (SELECT sum(contract.ins_otv) FROM ins_oplata o JOIN ins_bank_client bank ON bank.ins_id = o.bc_id
             JOIN ins_anketa contract ON contract.ins_id = o.anketa_id WHERE o.ins_type <> 3 AND bank.pym_date >= DATE '2000-01-01'
             AND bank.pym_date < DATE '2000-04-01' AND o.anketa_id IN (SELECT tb_anketa FROM q_in_force)) AS liability_unconverted
        FROM q_premium WHERE source_query_id = 1 AND payment_date >= DATE '2000-01-01' AND payment_date < DATE '2000-04-01'""",
        "premium_total liability_total liability_unconverted",
    ),
}
_QUERIES["s08_drop_folder"] = """SELECT CAST(o_custkey AS VARCHAR) AS record_id, o_orderstatus AS insured_region,
    o_orderpriority AS insured_branch, o_orderkey AS row_no FROM orders WHERE o_orderkey > 5"""
_QUERIES["s22_stored_model"] = finish(
    """SELECT CAST(date_trunc('month', termination_date) AS DATE) AS report_month, sum(terminated_amount) AS terminated_amount,
    count(*) AS n FROM q_terminated GROUP BY 1""",
    "terminated_amount",
)
_QUERIES["s08_quarantine"] = """SELECT CASE WHEN o_orderpriority = '5-LOW' THEN 'not a row' ELSE 'loaded' END AS kind,
        CASE WHEN o_orderpriority = '5-LOW' THEN 'n' ELSE '' END || o_orderkey AS value FROM orders
    UNION ALL SELECT 'left', 'notes_'"""
_QUERIES["s20_observed_load"] = _QUERIES["s20_load_summary"]
_QUERIES["s05_rejected_values"] = """SELECT 'lineitem' AS table_name, '{"row_key":' || l_orderkey || '}' AS row_key, v.* FROM (
    SELECT l_orderkey, unnest([
        {column_name: 'contract_start_date', text: CASE l_linenumber % 3 WHEN 1 THEN '02.01.2025' WHEN 2 THEN '2025' END, reason: 'not a date'},
        {column_name: 'insurance_days_count', text: CASE WHEN l_linenumber % 4 = 2 THEN 'x1' END, reason: 'does not fit int'},
        {column_name: 'insurance_premium_policy', text: CASE l_linenumber % 4 WHEN 1 THEN '1 234,56' WHEN 2 THEN l_partkey || ' UZS' END,
         reason: 'does not fit decimal(30,6)'}]) AS v FROM lineitem) x WHERE v.text IS NOT NULL"""
_QUERIES["s15_catalog_copy"] = """WITH facts AS (
    SELECT 'orders' AS table_name, count(*) AS rows_copied,
        count(*) FILTER (WHERE round(CAST(o_totalprice AS DECIMAL(22,4)), 2) > 99999.99) AS rejected_values,
        'o_orderkey' AS split_column, CAST(min(o_orderkey) AS VARCHAR) AS lower, CAST(max(o_orderkey) AS VARCHAR) AS upper FROM orders
    UNION ALL SELECT 'customer', count(*), 0, 'c_custkey', CAST(min(c_custkey) AS VARCHAR), CAST(max(c_custkey) AS VARCHAR) FROM customer)
SELECT table_name, CASE hour WHEN 0 THEN 'CREATED' WHEN 1 THEN 'SKIPPED' ELSE 'RELOADED' END AS decision,
    CASE WHEN hour <> 1 THEN rows_copied END AS rows_copied, CASE WHEN hour <> 1 THEN rejected_values END AS rejected_values,
    split_column, lower, upper, hour FROM facts, (VALUES (0), (1), (49)) h(hour)"""
_QUERIES["s22_staged_premium"] = finish(
    """SELECT CAST(date_trunc('month', payment_date) AS DATE) AS report_month, sum(premium_amount) AS premium_amount,
    sum(liability_amount) AS liability_amount FROM q_premium GROUP BY 1""",
    "premium_amount liability_amount",
)
_QUERIES["s22_month_range"] = finish(
    "SELECT * FROM q_commission WHERE commission_date >= DATE '1997-01-01' AND commission_date < DATE '1997-07-01'",
    "commission_amount_uzs",
)
_QUERIES["t02_latest_per_date"] = """SELECT report_date, event_id, ts, user_id, event_type FROM (
    SELECT *, CAST(ts AS DATE) AS report_date, row_number() OVER (PARTITION BY CAST(ts AS DATE) ORDER BY ts DESC, event_id DESC) AS n
    FROM events) t WHERE n = 1"""


def oracle_sql() -> dict[str, str]:
    out = {k: compose(_model(*spec), MODELS) for k, spec in _MODEL_QUERIES.items()}
    out |= {k: compose(text, MODELS) for k, text in _QUERIES.items()}
    return out
