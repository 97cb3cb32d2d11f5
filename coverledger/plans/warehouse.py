"""The warehouse: raw tables in, curated and mart models out, by name."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Collection
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from coverledger.operators.ordering import report_order
from coverledger.plans import curated, marts
from coverledger.sources import layout, rejected
from coverledger.sources.sinks import has_files, read_snapshot_table, write_snapshot

# Model name -> builder. Curated builders read raw tables, marts read the warehouse.
CURATED: dict[str, Callable] = {
    "claims_portfolio": curated.claims_portfolio,
    "reinsurance_incoming": curated.reinsurance_incoming,
    "reinsurance_outgoing": curated.reinsurance_outgoing,
    "balance_sheet": curated.balance_sheet,
    "financial_performance": curated.financial_performance,
    "investment_activity": curated.investment_activity,
    "insurance_premium": curated.insurance_premium,
    "agency_commissions": curated.agency_commissions,
    "subrogation_recoveries": curated.subrogation_recoveries,
    "terminated_contracts": curated.terminated_contracts,
    "deposits": curated.deposits,
    "loans": curated.loans,
    "product_dimension": curated.product_dimension,
    "solvency_adequacy_ratio": curated.solvency_adequacy_ratio,
}
# Curated tables that tell when a row was landed and stored.
AUDITED = (
    "claims_portfolio",
    "reinsurance_incoming",
    "reinsurance_outgoing",
    "balance_sheet",
    "financial_performance",
    "investment_activity",
    "solvency_adequacy_ratio",
)
# Join results that several models share; each is stored once and read by all of them.
PARTS: dict[str, Callable] = {
    "premium_general": curated.general_premium_rows,
    "premium_motor_sums": curated.motor_liability_sums,
    "commission_rows": curated.commission_rows,
}
# Compact forms the marts read instead of the row-level curated table, as unions of parts.
COMPACT: dict[str, tuple[str, ...]] = {"premium_sums": ("premium_general", "premium_motor_sums")}
# Models that read values from text: a builder that tells which do not fit, and their row key.
REJECTING: dict[str, tuple[Callable, list[str]]] = {
    "claims_portfolio": (curated.claims_portfolio, ["record_id", "claim_id"]),
}
# Row tables stored by month of a date, so that a range of days reads the files of its months.
MONTHLY = {
    "premium_general": "payment_date",
    "premium_motor_sums": "payment_date",
    "insurance_premium": "payment_date",
    "commission_rows": "commission_date",
    "agency_commissions": "commission_date",
    "subrogation_recoveries": "recovery_payment_date",
    "terminated_contracts": "termination_date",
}
# Marts in an order in which each finds what it reads.
MARTS: dict[str, Callable] = {
    "financial_kpi": marts.financial_kpi,
    "agency_commissions_monthly": marts.agency_commissions_monthly,
    "bank_partner_performance_monthly": marts.bank_partner_performance_monthly,
    "financial_ratios_monthly": marts.financial_ratios_monthly,
    "financial_stability_monthly": marts.financial_stability_monthly,
    "insurance_operations_monthly": marts.insurance_operations_monthly,
    "insurance_reserves_monthly": marts.insurance_reserves_monthly,
    "investment_portfolio_monthly": marts.investment_portfolio_monthly,
    "investment_partner_indicators_monthly": marts.investment_partner_indicators_monthly,
    "operational_efficiency_monthly": marts.operational_efficiency_monthly,
    "reinsurance_monthly": marts.reinsurance_monthly,
    "reinsurance_indicators": marts.reinsurance_indicators,
    "reinsurance_indicators_reinsurer": marts.reinsurance_indicators_reinsurer,
    "subrogation_indicators_monthly": marts.subrogation_indicators_monthly,
    "insurance_volume_indicators": marts.insurance_volume_indicators,
}

def report_sort(name: str) -> list:
    """Sort order of a served mart; none where the order is not defined."""
    if name == "insurance_volume_indicators":
        compulsory_first = F.when(F.col("insurance_type") == "Compulsory", 1).otherwise(2)
        return [(compulsory_first, "asc"), ("category", "asc"), ("product_name", "asc")]
    return {
        "agency_commissions_monthly": [("report_month", "desc")],
        "bank_partner_performance_monthly": [("report_month", "desc"), ("bank_partner_name", "asc")],
        "financial_ratios_monthly": [("report_month", "desc"), ("scenario", "asc")],
        "financial_stability_monthly": [("report_month", "desc"), ("scenario", "asc")],
        "insurance_operations_monthly": [("report_month", "desc"), ("scenario", "asc")],
        "insurance_reserves_monthly": [("report_month", "desc")],
        "investment_portfolio_monthly": [("report_month", "desc"), ("portfolio_category", "asc")],
        "investment_partner_indicators_monthly": [
            ("report_month", "desc"),
            ("portfolio_category", "asc"),
            ("partner_name", "asc"),
        ],
        "operational_efficiency_monthly": [("report_month", "desc")],
        "reinsurance_monthly": [("report_month", "desc")],
        "reinsurance_indicators": [("insurance_type", "asc"), ("category", "asc")],
        "reinsurance_indicators_reinsurer": [("reinsurer", "asc")],
        "subrogation_indicators_monthly": [("report_month", "desc")],
    }.get(name, [])


class Warehouse:
    """Builds each model once per instance, lazily, from ``raw(name)``.

    ``as_of`` stands in for today, so a run can be repeated. ``registry_keys_unique`` says that
    keys of partners, contracts, policies and recovery cases never repeat. A model can be saved with
    ``save``; later models then read the stored table and not the plan behind it.
    """

    def __init__(
        self,
        raw: Callable[[str], DataFrame],
        as_of: dt.date,
        reinsurance_years: tuple[int, int] = (2024, 2025),
        market_columns: tuple[str, ...] = (
            "total_premium_2024",
            "total_premium_2025",
            "claims_paid_2024",
            "claims_paid_2025",
            "insurance_liabilities_2024",
            "insurance_liabilities_2025",
        ),
        registry_keys_unique: bool = False,
    ):
        self.raw = raw
        self.as_of = as_of
        self.prior_year, self.current_year = as_of.year - 1, as_of.year
        self.last_month = dt.date(as_of.year, 12, 31)
        self.reinsurance_years = reinsurance_years
        self.market_columns = market_columns
        self.registry_keys_unique = registry_keys_unique
        self._models: dict[str, DataFrame] = {}
        self._stored: set[str] = set()
        self._roots: dict[str, str] = {}  # stored monthly table -> its folder
        self._earlier: dict[str, str] = {}  # model name -> root of an earlier run, not looked up yet

    def __getitem__(self, name: str) -> DataFrame:
        self._read_earlier(name)
        if name not in self._models:
            self._models[name] = self._planned(name)
        return self._models[name]

    def _planned(self, name: str) -> DataFrame:
        """A model's plan over raw tables, stored models and the parts that it shares with others."""
        if name in MARTS:
            return MARTS[name](self)
        if name in COMPACT:
            return reduce(DataFrame.unionByName, [self[part] for part in COMPACT[name]])
        if name == "insurance_premium":
            return self["premium_general"].unionByName(curated.motor_liability_rows(self.raw))
        if name == "agency_commissions":
            return curated.with_partner(self["commission_rows"], self.raw)
        if name == "subrogation_recoveries":
            return curated.subrogation_recoveries(self.raw, self.registry_keys_unique)
        return (CURATED.get(name) or PARTS[name])(self.raw)

    def columns(self, name: str, *columns: str) -> DataFrame:
        """Some columns (and the scenario) of a wide curated model; its dates and amounts
        that no one reads are then never planned."""
        self._read_earlier(name)
        if name in self._models:
            return self._models[name].select(*columns, "scenario")
        return CURATED[name](self.raw, columns).select(*columns, "scenario")

    def stored(self, name: str) -> bool:
        if name in COMPACT:
            return all(self.stored(part) for part in COMPACT[name])
        self._read_earlier(name)
        return name in self._stored

    def between(self, name: str, start: dt.date, end: dt.date) -> DataFrame:
        """Rows of a monthly table from ``start`` up to but not on ``end``; a stored one reads
        the files of those months only."""
        if self.stored(name) and name in self._roots:
            return layout.read_months(self[name].sparkSession, self._roots[name], start, end)
        day = F.col(MONTHLY[name])
        return self[name].filter((day >= start) & (day < end))

    def report(self, name: str) -> DataFrame:
        """A model in the order it is served in."""
        sort = report_sort(name)
        return report_order(self[name], sort) if sort else self[name]

    def save(self, name: str, root: str) -> DataFrame:
        """Write one model as Parquet with its audit columns, and read it back from there on.

        Row tables are laid out by month. A compact form is stored as its parts. Values that the
        model reads from text and cannot hold go to ``root/rejected``, replaced with every run.
        """
        if name in COMPACT:
            for part in COMPACT[name]:
                self.save(part, root)
            self._models.pop(name, None)
            return self[name]
        path = self._path(name, root)
        model = self[name]
        if name in MONTHLY:
            layout.write_months(model, path, MONTHLY[name])
            return self._read_months(name, path, model.sparkSession)
        checked = name in REJECTING and name not in self._stored
        if checked:
            model = REJECTING[name][0](self.raw, rejected=True)
        stamps = {"loaded_at": F.current_timestamp(), "updated_at": F.current_timestamp()} if name in AUDITED else {}
        rows = model.withColumns({c: at for c, at in stamps.items() if c not in model.columns})
        if checked:
            seen = write_snapshot(rows, path, rejected=rejected.rejected_count())
            stored = read_snapshot_table(model.sparkSession, path, rows.schema)
            rejected.keep_rejected(stored, f"{root}/rejected", name, REJECTING[name][1], seen["rejected"])
            model = model.drop(rejected.REJECTED)
        else:
            write_snapshot(rows, path)
        self._models[name] = read_snapshot_table(model.sparkSession, path, model.schema)
        self._stored.add(name)
        return self._models[name]

    def _read_months(self, name: str, path: str, spark: SparkSession) -> DataFrame:
        self._models[name] = layout.read_months(spark, path)
        self._stored.add(name)
        self._roots[name] = path
        return self._models[name]

    @staticmethod
    def _path(name: str, root: str) -> str:
        return f"{root}/{'presentation' if name in MARTS else 'curated'}/{name}"

    def read_stored(self, root: str, names: Collection[str]) -> None:
        """From here on read the named models from what an earlier run saved under the root.

        Each is looked up when it is first asked for; without a stored slice (never saved,
        or saved empty) it is planned from raw.
        """
        for name in names:
            self._earlier |= dict.fromkeys(COMPACT.get(name, (name,)), root)

    def _read_earlier(self, name: str) -> None:
        if name not in self._earlier:
            return
        path, model = self._path(name, self._earlier.pop(name)), self[name]
        if name in MONTHLY:
            if layout.published(model.sparkSession, path):
                self._read_months(name, path, model.sparkSession)
        elif has_files(model.sparkSession, f"{path}/snapshot=current"):
            self._models[name] = read_snapshot_table(model.sparkSession, path, model.schema)
            self._stored.add(name)

    def save_all(self, root: str) -> None:
        """Shared parts first, then curated tables, then the marts that read both."""
        for name in [*PARTS, *CURATED, *MARTS]:
            self.save(name, root)

    def create_views(self, names: list[str] | None = None) -> None:
        """Expose models as temporary views for SQL."""
        for name in names or [*CURATED, *MARTS]:
            self[name].createOrReplaceTempView(name)
