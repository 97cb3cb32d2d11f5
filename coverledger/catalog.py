"""Fixed values of the insurance data model.

Column lists, report codes, status labels and word lists that define the input
and output layouts. They are plain data: nothing here is computed.
"""

from __future__ import annotations

# Claims landing layout (40 text columns, in file order; the older
# export stops after vehicle_engine_type, 38 columns).
CLAIMS_COLUMNS = """
record_id insured_region insured_branch reporting_region claim_reported_by claim_report_date grouping_code insurance_type
insurance_class entity_type taxpayer_id client_name injured_party contract_id policy_id incident_date reported_damage_property
reported_damage_health damage_adjustment_notes incident_cause settlement_order_id settlement_decision_date payout_date
payout_property payout_health payout_total currency rejection_date rejection_reason claim_id claim_expense_amount
outstanding_loss_amount damaged_object recovery_amount claim_handler notes beneficiary vehicle_engine_type branch_name
claim_submission_date
""".split()
CLAIMS_SHORT_WIDTH = 38
CLAIMS_DATE_COLUMNS = """
claim_report_date incident_date settlement_decision_date payout_date rejection_date claim_submission_date
""".split()
CLAIMS_NUMERIC_COLUMNS = """
reported_damage_property reported_damage_health payout_property payout_health payout_total
claim_expense_amount outstanding_loss_amount recovery_amount
""".split()

# 2025 claims export, source position -> field.
CLAIMS_2025_POSITIONS = {
    0: "record_id",
    16: "branch_name",
    21: "insurance_type",
    22: "grouping_code",
    23: "policy_id",
    24: "insurance_class",
    25: "contract_id",
    26: "client_name",
    27: "injured_party",
    28: "taxpayer_id",
    29: "damaged_object",
    30: "incident_date",
    35: "entity_type",
    38: "claim_id",
    39: "claim_submission_date",
    40: "payout_date",
    42: "payout_total",
    44: "claim_handler",
    51: "recovery_amount",
    57: "beneficiary",
    64: "notes",
}

# Outgoing reinsurance layout (112 columns, in file order).
OUTGOING_COLUMNS = """
seq_number insurance_contract_number policyholder insurance_type voluntary_insurance_type
mandatory_insurance_type region policyholder_country city_village individual_legal_entity
contract_conclusion_date insured_amount_contract contract_currency insurance_premium_contract
premium_currency_contract contract_start_date contract_end_date insured_amount_policy
reinsurance_type insurance_premium_policy premium_currency_policy insurance_days_count
reinsurance_broker reinsurer cedant_commission actual_premium_usd_paid_in_uzs
actual_premium_eur_paid_in_uzs actual_premium_usd actual_premium_eur actual_premium_rub
actual_premium_uzs_net_reinsurance premium_currency_policy2 total_accrued_premium_uzs
premium_accrual_date received_premium_usd received_premium_eur received_premium_rub
received_premium_uzs total_received_premium_uzs premium_receipt_date policy_number_slip_number
insurance_effective_start_date insurance_effective_end_date policy_issue_date_slip_sign_date
insurance_duration_days notes bank_name_beneficiary reinsurer_share_pct reinsurer_or_broker_name
reinsurer_or_broker_country reinsurance_start_date reinsurance_end_date
reinsurance_duration_days liabilities_ceded_reinsurance liabilities_ceded_rub
liabilities_ceded_eur liabilities_ceded_usd total_premiums_ceded_uzs premiums_ceded_uzs
premiums_ceded_usd premiums_ceded_usd_star premiums_ceded_eur_star premiums_ceded_eur
premiums_ceded_rub total_commission_received_uzs commission_received_uzs commission_received_usd
commission_received_usd_star commission_received_eur_star commission_received_eur
commission_received_rub nonresident_tax_usd nonresident_tax_rub nonresident_tax_uzs
net_reinsurance_premium_uzs net_reinsurance_premium_rub net_reinsurance_premium_usd_star
net_reinsurance_premium_eur net_reinsurance_premium_usd net_reinsurance_premium_transfer_date
own_retention income_attribution_date agency_commission agency_commission_pct agent_name
acquisition_accrual_date preventive_reserve commission_accrual_date mtpl_preventive_reserve_5pct
legal_entity_status assistance_commission reinsurance_agreement_number
reinsurance_agreement_date branch administrative_expenses base_insurance_premium
insurance_contract_duration blank_col reporting_date contract_duration_days
days_elapsed_since_effective days_remaining_liability days_remaining_liability_calc
upr_reinsurer_share ibnr_reinsurer_share accounting_group upr_reinsurer_share_usd
upr_reinsurer_share_eur upr_reinsurer_share_rub ibnr_reinsurer_share_usd
ibnr_reinsurer_share_eur ibnr_reinsurer_share_rub
""".split()

# Incoming reinsurance layout (28 columns, in file order).
INCOMING_COLUMNS = """
seq_number contract_number policyholder insurance_type voluntary_insurance_type
mandatory_insurance_type region policyholder_country city_village individual_legal_entity
contract_conclusion_date insured_amount_contract contract_currency insurance_premium_contract
premium_currency_contract contract_start_date contract_end_date insured_amount_policy
insured_amount_policy_usd insurance_premium_policy premium_currency_policy actual_premium_usd
actual_premium_eur actual_premium_rub actual_premium_uzs premium_currency_policy2
total_accrued_premium_uzs branch
""".split()

# Column classes of both reinsurance layouts; the rest is text.
REINSURANCE_DATE_COLUMNS = """
contract_conclusion_date contract_start_date contract_end_date premium_accrual_date
premium_receipt_date insurance_effective_start_date insurance_effective_end_date
policy_issue_date_slip_sign_date reinsurance_start_date reinsurance_end_date
net_reinsurance_premium_transfer_date income_attribution_date acquisition_accrual_date
commission_accrual_date reinsurance_agreement_date reporting_date
""".split()
REINSURANCE_INT_COLUMNS = """
insurance_days_count insurance_duration_days reinsurance_duration_days contract_duration_days
days_elapsed_since_effective days_remaining_liability days_remaining_liability_calc
""".split()
REINSURANCE_NUMERIC_COLUMNS = """
insured_amount_contract insurance_premium_contract insured_amount_policy
insurance_premium_policy cedant_commission actual_premium_usd_paid_in_uzs
actual_premium_eur_paid_in_uzs actual_premium_usd actual_premium_eur actual_premium_rub
actual_premium_uzs_net_reinsurance total_accrued_premium_uzs received_premium_usd
received_premium_eur received_premium_rub received_premium_uzs total_received_premium_uzs
reinsurer_share_pct liabilities_ceded_reinsurance liabilities_ceded_rub liabilities_ceded_eur
liabilities_ceded_usd total_premiums_ceded_uzs premiums_ceded_uzs premiums_ceded_usd
premiums_ceded_usd_star premiums_ceded_eur_star premiums_ceded_eur premiums_ceded_rub
total_commission_received_uzs commission_received_uzs commission_received_usd
commission_received_usd_star commission_received_eur_star commission_received_eur
commission_received_rub nonresident_tax_usd nonresident_tax_rub nonresident_tax_uzs
net_reinsurance_premium_uzs net_reinsurance_premium_rub net_reinsurance_premium_usd_star
net_reinsurance_premium_eur net_reinsurance_premium_usd own_retention agency_commission
agency_commission_pct preventive_reserve mtpl_preventive_reserve_5pct assistance_commission
administrative_expenses base_insurance_premium upr_reinsurer_share ibnr_reinsurer_share
upr_reinsurer_share_usd upr_reinsurer_share_eur upr_reinsurer_share_rub ibnr_reinsurer_share_usd
ibnr_reinsurer_share_eur ibnr_reinsurer_share_rub insured_amount_policy_usd actual_premium_uzs
""".split()

# Header rows above the data in each landed layout.
HEADER_ROWS = {"outgoing": 7, "incoming": 3, "claims": 5, "claims_2025": 4}


def _code_table(text: str) -> dict[str, str]:
    return dict(line.split() for line in text.strip().splitlines())


# Balance sheet report code -> column name.
BALANCE_SHEET_CODES = _code_table("""
A010 total_assets_at_start
A011 long_term_assets
A012 current_assets
A020 cash_and_equivalents
A021 cash
A022 bank_accounts
A030 short_term_investments
A040 financial_assets
A050 intangible_assets
A060 reinsurance_receivables
A070 coinsurance_receivables
A080 premium_receivables
A090 commission_receivables
A100 total_receivables
A110 prepayments
A120 deferred_expenses
A130 total_assets_check
A140 deferred_tax_assets
A150 inventory
A160 other_current_assets_one
A170 other_current_assets_two
A180 other_current_assets_three
A190 total_assets_alt
A191 additional_current_assets
A200 current_assets_subtotal
A210 long_term_receivables
A220 long_term_intragroup_receivables
A230 long_term_advances
A240 loans_issued
A250 long_term_investments
A260 investments_in_subsidiaries
A270 investments_in_associates
A280 real_estate_investments
A290 other_long_term_investments
A300 equipment
A310 accumulated_depreciation
A320 intangible_assets_net
A330 accumulated_amortization
A340 capital_investments
A350 advances_for_fixed_assets
A360 long_term_deferred_expenses
A370 deferred_tax_assets_long_term
A380 insurance_reserves_assets
A390 accumulated_assets
A400 other_long_term_assets_one
A410 other_long_term_assets_two
A420 other_long_term_assets_three
A430 fixed_assets
A440 lease_assets
A450 contingent_assets
A460 operating_assets
A470 off_balance_sheet_assets
A480 total_balance_assets
A490 total_assets_final
P500 authorized_capital
P510 additional_capital
P520 reserve_capital
P530 treasury_shares
P540 retained_earnings_prior_years
P550 share_premium
P560 other_reserves
P570 equity
P580 total_equity_reserves
P590 unearned_premium_reserve
P600 ibnr_reserve
P610 rbns_reserve
P620 matemathical_reserve
P630 stabilization_reserve_base
P640 unexpired_risk_reserve
P650 stabilization_reserve_additional
P660 claims_equalization_reserve
P670 total_liabilities
P680 current_liabilities
P690 short_term_loans
P700 long_term_liabilities
P710 short_term_payables
P720 retained_earnings
P730 payables_to_reinsurers
P731 payables_to_coinsurers
P740 commission_payables
P750 tax_payables
P760 social_security_payables
P770 salary_payables
P780 dividends_payable
P790 advances_received
P800 deferred_income
P810 provisions_for_liabilities
P820 other_short_term_liabilities_one
P830 other_short_term_liabilities_two
P840 other_short_term_liabilities_three
P850 other_short_term_liabilities_four
P860 other_short_term_liabilities_five
P870 other_short_term_liabilities_six
P880 other_short_term_liabilities_seven
P890 other_short_term_liabilities_eight
P900 net_profit_loss
P910 non_controlling_interest
P920 minority_interest
P930 equity_check
P931 equity_reserve_subtotal
P932 equity_adjustment
P940 additional_equity_reserves
P950 additional_reserves
P960 pension_obligations
P970 deferred_tax_liabilities
P980 other_long_term_liabilities_one
P990 other_long_term_liabilities_two
P1000 total_capital
P1010 long_term_loans
P1020 long_term_advances_received
P1030 long_term_provisions
P1040 lease_liabilities
P1050 other_non_current_liabilities_one
P1060 other_non_current_liabilities_two
P1070 other_non_current_liabilities_three
P1080 other_non_current_liabilities_four
P1090 total_liabilities_alt
P1100 off_balance_sheet_liabilities
P1110 contingent_liabilities
P1120 unearned_premiums_ceded
P1130 claims_reserve_ceded
P1140 ibnr_reserve_ceded
P1150 rbns_reserve_ceded
P1160 mathematical_reserve_ceded
P1170 other_reserves_ceded
P1180 total_ceded_reserves
P1190 total_equity_final
P1200 total_liabilities_and_equity
""")

# Financial performance report code -> column name.
PERFORMANCE_CODES = _code_table("""
F010 total_revenue
F011 premium_income
F012 reinsurance_premium_ceded
F013 other_premium_income
F020 commission_income
F030 fee_income
F040 subrogation_income
F050 other_operating_income
F060 operating_income
F070 costs_of_goods_sold
F090 period_expenses
F100 commission_expenses
F110 standard_operating_income
F120 standard_operating_expense
F130 interest_income
F140 financial_income
F160 financial_expense
F170 foreign_exchange_gains
F180 dividend_income
F190 realization_of_investments_gains
F200 revaluation_of_investments
F210 other_financial_income
F220 foreign_exchange_losses
F230 realization_of_investments_losses
F240 other_financial_expenses
F250 administrative_costs
F260 marketing_expenses
F300 extraordinary_income
F310 extraordinary_expenses
F320 net_profit
F014L life_insurance_premium
F014P property_insurance_premium
F015L health_insurance_premium
F015P liability_insurance_premium
F016L personal_accident_premium
F016P motor_insurance_premium
F017L travel_insurance_premium
F017P marine_aviation_transit_premium
F018L credit_surety_premium
F018P legal_expenses_premium
F019L assistance_premium
F019P miscellaneous_financial_loss_premium
F080L life_premium_loss
F080P property_premium_income
F150L life_claims_loss
F150P property_claims_paid
F270L life_underwriting_loss
F270P property_underwriting_profit
F280L life_investment_income
F280P property_investment_income
F290L life_technical_loss
F290P property_technical_result
Result total_financial_result
""")

# Investment report key -> investment type (lists of items, then single amounts).
INVESTMENT_LIST_KEYS = {"Bonds": "BOND", "Deposits": "DEPOSIT", "ForeignCurrencyDeposits": "FX_DEPOSIT"}
INVESTMENT_SCALAR_KEYS = {"Loans": "LOAN", "Shares": "SHARE"}

# Investment type -> portfolio category, and the four categories reported.
INVESTMENT_CATEGORY = {
    "DEPOSIT": "Deposits",
    "FX_DEPOSIT": "Deposits",
    "SHARE": "Shares",
    "BOND": "Bonds",
    "LOAN": "Other",
}
PORTFOLIO_CATEGORIES = ["Deposits", "Shares", "Bonds", "Other"]

# Product codes that make an insurance product compulsory.
COMPULSORY_PRODUCT_CODES = [3, 108, 123, 210, 211, 218, 401, 402, 418]

# Word in a market class name -> insurance type, first match wins.
MARKET_CLASS_WORDS = [
    ("majburiy sug", "Compulsory"),
    ("ixtiyoriy sug", "Voluntary"),
    ("fuqarolik javobgarlik", "Compulsory"),
    ("osago", "Compulsory"),
    ("majburiy", "Compulsory"),
    ("ixtiyoriy", "Voluntary"),
]

# Loan status code -> label.
LOAN_STATUS = {0: "Актив", 1: "Исполненный", 2: "Досрочное погашение"}

# Policy statuses that count as in force.
GENERAL_POLICY_STATUSES = [2, 9, 10]
MOTOR_POLICY_STATUSES = [2, 8]

# Labels and settings.
SCENARIO = "Actual"
NO_PARTNER = "Direct/No Partner"
RECOVERY_PARTNER = "General Recovery"
REQUIRED_CASH_TO_CLAIMS = 2.5

# Word in a landed file name -> target, first match wins.
FILE_ROUTES = [("claim", "claims"), ("reinsur", "reinsurance"), ("solvency", "solvency")]

# Characters that count as blank in the loaders' text cleaning.
BLANK_CHARACTERS = " \t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"

# Words that identify a claims header, per target column, first free target wins.
CLAIMS_HEADER_WORDS = {
    "record_id": ["№", "id", "п/п"],
    "insured_region": ["суғурталанувчи суғурталанган ҳудудий тармоқ"],
    "insured_branch": ["суғурталанувчи суғурталанган филиал"],
    "reporting_region": ["хабарномани қабул қилган ҳудудий тармоқ"],
    "claim_reported_by": ["сугурта ходисаси хакида ариза бер"],
    "claim_report_date": ["ариза берилган ёки", "санаси"],
    "grouping_code": ["группировка"],
    "insurance_type": ["суғурта тури", "вид страхования"],
    "insurance_class": ["класс"],
    "entity_type": ["ю/ф", "физ/юр"],
    "taxpayer_id": ["инн (стир ), юр/лиц"],
    "counterparty_name": ["unnamed: 11"],
    "injured_party": ["жабрланувчи"],
    "contract_id": ["шартнома рақами", "№ договор", "№ договора страхования"],
    "policy_id": ["полис рақами", "информация о выплате"],
    "incident_date": ["сугурта ходисаси содир булган сана", "зарар юз берган сана", "дата и время события"],
    "reported_damage_property": ["зарарлар миқдори (мулкка)"],
    "reported_damage_health": ["зарарлар миқдори (согликка)"],
    "damage_adjustment_notes": ["зарарларни бартараф", "маълумот"],
    "incident_cause": ["ходисаси сабаби"],
    "settlement_order_id": ["қарор тартиб рақами"],
    "settlement_decision_date": ["қарор қабул қилинган сана"],
    "payout_date": ["қоплама тўланган сана", "дата выплаты"],
    "payout_property": ["мулкка"],
    "payout_health": ["согликка"],
    "payout_total": ["жами (19 устун+20 устун)", "жами (19 устун + 20 устун)", "сумма убытков"],
    "currency": ["валюта бирлиги"],
    "rejection_date": ["коплама рад этилди сана", "рад этилган - сана"],
    "rejection_reason": ["рад этиш сабаби", "причина"],
    "claim_id": ["дело рақами"],
    "claim_expense_amount": ["зарарни бартараф қилиш бўйича харажат (3%)"],
    "outstanding_loss_amount": ["жами бартараф этилмаган зарарлар"],
    "damaged_object": ["зарарланган суғурта объекти"],
    "recovery_amount": ["регресс бўйича ундириладиган сумма", "регресс миқдори", "регресс"],
    "claim_handler": ["ижрочи"],
    "notes": ["изоҳ"],
    "beneficiary": ["наф олувчи"],
    "vehicle_engine_type": ["тв тури(двигатель хажми)"],
    "branch_name": ["филиал", "отделение"],
    "client_name": ["страхователь", "заявитель", "сугурталанувчи"],
    "claim_submission_date": ["келиб тушган сана", "дата подачи"],
}
