"""Insurance tables derived from the benchmark tables, for tests and measurements.

Each statement is portable SQL over the benchmark tables, so the same inputs exist in
Spark and in the database used for checking. Braces name the benchmark tables.
"""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import DataFrame, SparkSession

from coverledger.plans.warehouse import Warehouse

AS_OF = dt.date(2000, 12, 31)
REINSURANCE_YEARS = (1999, 2000)

# Declared types of the benchmark tables, so that no footer is read to find them.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}

STATEMENTS = {
    "ins_oplata": """
        SELECT l_orderkey * 10 + l_linenumber AS ins_id, l_orderkey AS anketa_id, l_orderkey AS polis_id,
               l_orderkey AS bc_id, 1 + l_linenumber % 3 AS ins_type, 1 + l_partkey % 3 AS opl_val,
               CAST(l_shipdate AS DATE) AS opl_data, CAST(l_extendedprice AS DECIMAL(22,4)) AS oplata,
               CAST(l_quantity AS DECIMAL(22,4)) AS opl_summa,
               CASE WHEN l_suppkey % 5 = 0 THEN NULL ELSE CAST(100 + l_suppkey % 7 AS DECIMAL(22,4)) END AS val_kurs,
               CAST(l_quantity AS DECIMAL(22,4)) AS kommis_summa, l_suppkey AS akt
        FROM {lineitem}""",
    "ins_anketa": """
        SELECT CASE WHEN o_orderkey % 11 = 0 THEN -1 - o_orderkey ELSE o_orderkey END AS ins_id, o_custkey AS owner,
               1 + o_custkey % 2 AS fizyur, CAST(o_totalprice AS DECIMAL(22,4)) AS ins_otv, o_custkey AS beneficiary
        FROM {orders}""",
    "ins_polis": """
        SELECT o_orderkey AS tb_id, o_orderkey AS tb_anketa,
               CASE o_orderstatus WHEN 'F' THEN 2 WHEN 'O' THEN 9 ELSE 5 END AS tb_status,
               CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE o_orderkey % 150 END AS pturi_id
        FROM {orders}""",
    "ins_bank_client": """
        SELECT o_orderkey AS ins_id, CASE WHEN o_orderkey % 29 = 0 THEN NULL ELSE o_orderdate END AS pym_date,
               CAST(o_totalprice AS DECIMAL(22,4)) AS pym_summa, 1 + o_orderkey % 2 AS bc_type,
               1 + o_custkey % 2 AS status
        FROM {orders}""",
    "ins_agent_akt": """
        SELECT s_suppkey AS ins_id,
               make_date(CAST(1996 + s_suppkey % 5 AS INT), CAST(1 + s_suppkey % 12 AS INT), 1) AS akt_date,
               CASE WHEN s_suppkey % 4 = 0 THEN 1 ELSE 2 END AS active
        FROM {supplier}""",
    "ins_kontragent": """
        SELECT c_custkey AS tb_id,
               CASE c_custkey % 3 WHEN 0 THEN '  ' WHEN 1 THEN concat(c_mktsegment, ' ') ELSE NULL END AS tb_orgname,
               CASE WHEN c_custkey % 5 = 0 THEN '' ELSE c_name END AS tb_name
        FROM {customer}""",
    "ins_kurs": """
        SELECT val_type,
               make_date(CAST(yr AS INT), CAST(mo AS INT), CAST(CASE WHEN mo % 4 = 0 THEN 20 ELSE 1 END AS INT)) AS kurs_date,
               CAST(100 * val_type + yr % 100 + mo AS DECIMAL(22,4)) AS kurs
        FROM (SELECT DISTINCT 2 + o_custkey % 2 AS val_type, year(o_orderdate) AS yr, month(o_orderdate) AS mo
              FROM {orders}) t""",
    "tb_anketa": """
        SELECT o_orderkey AS tb_id, 1 + o_custkey % 2 AS tb_fizur, o_custkey AS tb_user
        FROM {orders} WHERE o_orderpriority = '1-URGENT'""",
    "tb_polis": """
        SELECT o_orderkey AS tb_anketa, CAST(o_totalprice AS DECIMAL(22,4)) AS tb_summa,
               o_orderkey % 20 AS tb_komissia,
               CASE o_orderstatus WHEN 'F' THEN 2 WHEN 'O' THEN 8 ELSE 5 END AS tb_status, o_orderkey % 10 AS akt
        FROM {orders}""",
    "tb_oplata": """
        SELECT l_orderkey * 10 + l_linenumber AS tb_id, l_orderkey AS tb_anketa,
               CAST(l_extendedprice AS DECIMAL(22,4)) AS tb_summa, 1 + l_linenumber % 2 AS tb_typepl,
               l_orderkey AS bc_id
        FROM {lineitem}""",
    "tb_avto": """
        SELECT CASE WHEN o_orderkey % 3 = 0 THEN -1 - o_orderkey ELSE o_orderkey END AS tb_anketa FROM {orders}
        UNION ALL
        SELECT CASE WHEN o_orderkey % 6 = 1 THEN o_orderkey ELSE -1 - o_orderkey END AS tb_anketa FROM {orders}""",
    "ins_invdep": """
        SELECT CAST(o_totalprice AS DECIMAL(22,4)) AS dep_sum, o_orderdate AS depdate_from,
               CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_orderdate + INTERVAL '1' YEAR END AS depdate_to,
               o_custkey AS client_id, 1 + o_custkey % 2 AS val_type
        FROM {orders} WHERE o_orderstatus = 'P'""",
    "ins_invloan": """
        SELECT o_orderkey AS ins_id, o_custkey AS client_id, concat('L', CAST(o_orderkey AS STRING)) AS loan_num,
               concat('D', CAST(o_orderkey AS STRING)) AS dog_num, o_orderdate AS dog_date,
               o_orderdate AS loandate_from,
               CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_orderdate + INTERVAL '6' MONTH END AS loandate_to,
               180 AS loan_day, o_orderkey % 25 AS prof_rate, CAST(o_totalprice AS DECIMAL(22,4)) AS loan_sum,
               1 + o_custkey % 3 AS val_type, 1 + o_custkey % 2 AS val_vozvrat, o_orderkey % 4 AS status
        FROM {orders} WHERE o_orderstatus = 'O'""",
    "ins_invloan_oplata": """
        SELECT l_orderkey AS loan_id, CAST(l_extendedprice AS DECIMAL(22,4)) AS amount
        FROM {lineitem} WHERE l_returnflag = 'N'""",
    "ins_invloan_accrual": """
        SELECT l_orderkey AS loan_id,
               CASE WHEN l_orderkey % 17 = 0 THEN CAST(0 AS DECIMAL(22,4)) ELSE CAST(l_extendedprice AS DECIMAL(22,4)) END AS amount
        FROM {lineitem}""",
    "p_sp_currency": """
        SELECT CAST(1 + r_regionkey AS BIGINT) AS sp_id, concat('CUR', CAST(r_regionkey AS STRING)) AS name
        FROM {region}""",
    "ins_rastorg": """
        SELECT CASE WHEN o_orderkey % 31 = 0 THEN NULL ELSE o_orderdate END AS tb_dateras,
               CAST(o_totalprice AS DECIMAL(22,4)) AS tb_summa, CAST(o_custkey AS DECIMAL(22,4)) AS vernut,
               CAST(NULL AS DECIMAL(22,4)) AS ostatok, CAST(o_orderkey % 100 AS DECIMAL(22,4)) AS vozvrat_sum,
               CAST(o_orderkey % 10 AS DECIMAL(22,4)) AS retention, o_orderkey AS tb_polis
        FROM {orders} WHERE o_orderpriority = '5-LOW'""",
    "ins_regress_bank": """
        SELECT l_orderkey AS bc_id, l_orderkey AS regress_id, CAST(l_extendedprice AS DECIMAL(22,4)) AS recovery_sum
        FROM {lineitem} WHERE l_returnflag = 'R'""",
    "ins_regress": "SELECT o_orderkey AS ins_id, o_orderkey AS polis_id FROM {orders}",
    "ins_pturi": """
        SELECT p_partkey AS ins_id, p_name AS polis_name_rus, p_type AS polis_name,
               CASE p_partkey % 4 WHEN 0 THEN '201-1' WHEN 1 THEN '108' ELSE CAST(p_partkey % 500 AS STRING) END AS kod_num,
               p_size % 6 AS vertical, p_size % 30 AS group1, p_size % 7 AS group2, 1 AS active, 0 AS import
        FROM {part}""",
    "ins_vertical": "SELECT r_regionkey AS ins_id, r_name AS name1 FROM {region}",
    "ins_pgroup1": "SELECT n_nationkey AS ins_id, n_name AS name1 FROM {nation}",
    "ins_pgroup2": "SELECT n_nationkey AS ins_id, n_name AS name1 FROM {nation}",
    "ins_viplati": """
        SELECT l_orderkey AS sobitie_id, l_shipdate AS date_viplata,
               CAST(l_extendedprice AS DECIMAL(22,4)) AS viplate,
               CASE l_suppkey % 3 WHEN 0 THEN NULL ELSE l_suppkey % 3 END AS val_type,
               CAST(2 + l_suppkey % 5 AS DECIMAL(22,4)) AS val_kurs
        FROM {lineitem} WHERE l_returnflag = 'A'""",
    "ins_sobitie": "SELECT o_orderkey AS ins_id, o_orderkey AS polis_id FROM {orders}",
    "claims_portfolio": """
        SELECT concat(' ', CAST(l_orderkey AS STRING)) AS record_id, c_name AS client_name,
               CASE l_linenumber % 3 WHEN 0 THEN substr(CAST(l_shipdate AS STRING), 1, 10)
                    WHEN 1 THEN concat(substr(CAST(l_shipdate AS STRING), 1, 10), 'T00:00:00') ELSE 'n/a' END AS payout_date,
               CASE l_linenumber % 4 WHEN 0 THEN concat(CAST(CAST(l_extendedprice AS DECIMAL(22,2)) AS STRING), ' UZS')
                    WHEN 1 THEN replace(CAST(CAST(l_extendedprice AS DECIMAL(22,2)) AS STRING), '.', ',')
                    WHEN 2 THEN '' ELSE concat(' ', CAST(CAST(l_extendedprice AS DECIMAL(22,2)) AS STRING)) END AS payout_total
        FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey JOIN {customer} ON o_custkey = c_custkey""",
    "reinsurance_outgoing_portfolio": """
        SELECT CASE l_linenumber WHEN 1 THEN ' ' ELSE l_returnflag END AS insurance_type,
               CASE WHEN l_linenumber % 2 = 0 THEN l_linestatus ELSE '' END AS voluntary_insurance_type,
               CASE WHEN l_linenumber % 3 = 0 THEN 'M' ELSE NULL END AS mandatory_insurance_type,
               s_name AS reinsurer, CAST(l_shipdate AS DATE) AS contract_conclusion_date,
               CAST(l_extendedprice AS DECIMAL(22,4)) AS total_accrued_premium_uzs
        FROM {lineitem} JOIN {supplier} ON l_suppkey = s_suppkey""",
    "reinsurance_incoming_portfolio": """
        SELECT o_orderstatus AS insurance_type, o_orderpriority AS voluntary_insurance_type,
               '' AS mandatory_insurance_type, c_name AS policyholder,
               CAST(o_orderdate AS DATE) AS contract_conclusion_date,
               CAST(o_totalprice AS DECIMAL(22,4)) AS total_accrued_premium_uzs
        FROM {orders} JOIN {customer} ON o_custkey = c_custkey""",
    "balance_sheet_api_response": """
        SELECT last_day(CAST(max(o_orderdate) AS DATE)) AS report_date,
               concat('{{"OperationResult":{{"Balance":{{"A410":', CAST(sum(CAST(o_totalprice AS DECIMAL(22,4))) AS STRING),
                      ',"A490":', CAST(3 * sum(CAST(o_totalprice AS DECIMAL(22,4))) AS STRING),
                      ',"P570":', CAST(count(*) AS STRING), ',"P580":', CAST(count(*) * 7 AS STRING),
                      ',"P590":', CAST(count(*) * 5 AS STRING), ',"P600":', CAST(count(*) * 2 AS STRING),
                      ',"P610":', CAST(count(*) * 3 AS STRING), ',"P630":', CAST(count(*) AS STRING),
                      ',"P720":', CAST(count(*) * 4 AS STRING), '}}}}}}') AS payload_json
        FROM {orders} GROUP BY year(o_orderdate), month(o_orderdate)""",
    "financial_performance_api_response": """
        SELECT last_day(CAST(max(l_shipdate) AS DATE)) AS report_date,
               concat('{{"OperationResult":{{"Result":"OK","F011":', CAST(sum(CAST(l_extendedprice AS DECIMAL(22,4))) AS STRING),
                      ',"F012":', CAST(count(*) * 10 AS STRING), ',"F013":', CAST(count(*) * 20 AS STRING),
                      ',"F060":', CAST(count(*) * 9 AS STRING), ',"F070":', CAST(count(*) * 4 AS STRING),
                      ',"F090":', CAST(count(*) * 3 AS STRING), ',"F140":', CAST(count(*) AS STRING),
                      ',"F320":', CAST(count(*) * 2 AS STRING), '}}}}') AS payload_json
        FROM {lineitem} GROUP BY year(l_shipdate), month(l_shipdate)""",
    "investment_activity_api_response": """
        SELECT last_day(CAST(o_orderdate AS DATE)) AS report_date,
               concat('{{"OperationResult":{{"Result":"OK","Loans":', CAST(o_orderkey % 1000 AS STRING),
                      ',"Shares":"","Bonds":',
                      CASE WHEN o_orderkey % 2 = 0 THEN '0' ELSE concat('[{{"partner":"', o_orderpriority,
                           '","contract":"c1","amount":', CAST(CAST(o_totalprice AS DECIMAL(22,4)) AS STRING),
                           '}},{{"partner":"B","contract":"c2","amount":""}}]') END,
                      ',"Deposits":[{{"partner":"', o_orderstatus, '","contract":"d","amount":5.5}}]}}}}') AS payload_json
        FROM {orders}""",
    "solvency_adequacy": """
        SELECT concat('15-', CASE WHEN q = 4 THEN '12' ELSE concat('0', CAST(q * 3 AS STRING)) END, '-', CAST(yr AS STRING)) AS report_date,
               CAST(1.5 + q AS DECIMAL(10,2)) AS actual_solvency_margin_adequacy_ratio,
               CAST(1 AS DECIMAL(10,2)) AS required_solvency_margin_adequacy_ratio
        FROM (SELECT DISTINCT quarter(o_orderdate) AS q, year(o_orderdate) AS yr FROM {orders}) t""",
    "market_share_insurance_class_stats": """
        SELECT CASE r_regionkey WHEN 0 THEN 'Majburiy sugurta' WHEN 1 THEN 'IXTIYORIY sugurta' WHEN 2 THEN 'OSAGO'
                    WHEN 3 THEN 'Jami' ELSE NULL END AS insurance_type_name,
               CAST(1000 * (1 + r_regionkey) AS DECIMAL(22,4)) AS total_premium_2024,
               CAST(1100 * (1 + r_regionkey) AS DECIMAL(22,4)) AS total_premium_2025,
               CAST(300 AS DECIMAL(22,4)) AS claims_paid_2024, CAST(NULL AS DECIMAL(22,4)) AS claims_paid_2025,
               CAST(9000 AS DECIMAL(22,4)) AS insurance_liabilities_2024,
               CAST(9500 AS DECIMAL(22,4)) AS insurance_liabilities_2025
        FROM {region}""",
}


def tables_used(statement: str) -> list[str]:
    return sorted(set(re.findall(r"(?<!\{)\{([a-z]+)\}(?!\})", statement)))


class Bridge:
    """Raw tables of one data folder, built on demand."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self._raw: dict[str, DataFrame] = {}
        self._sources: dict[str, DataFrame] = {}

    def source(self, name: str) -> DataFrame:
        """One benchmark table."""
        if name not in self._sources:
            reader = self.spark.read
            if name in SCHEMAS:
                reader = reader.schema(SCHEMAS[name])
            self._sources[name] = reader.parquet(f"{self.sf_dir}/{name}.parquet")
        return self._sources[name]

    def __call__(self, name: str) -> DataFrame:
        if name not in self._raw:
            statement = STATEMENTS[name]
            frames = {t: self.source(t) for t in tables_used(statement)}
            self._raw[name] = self.spark.sql(statement, **frames)
        return self._raw[name]

    def warehouse(self) -> Warehouse:
        return Warehouse(self, AS_OF, REINSURANCE_YEARS)


def portable_sql(name: str) -> str:
    """A statement with plain table names, for another engine."""
    return STATEMENTS[name].format(**{t: t for t in tables_used(STATEMENTS[name])})
