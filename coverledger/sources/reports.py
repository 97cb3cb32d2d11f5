"""Landed JSON reports: one report per date, flattened to rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from coverledger.functions.reports import is_list, is_number, report_body, variant_number
from coverledger.functions.money import READ
from coverledger.operators.upsert import latest_wins, upsert


def latest_reports(landed: DataFrame) -> DataFrame:
    """One report per date, the one ingested last."""
    return latest_wins(landed, ["report_date"], ["ingested_at", "payload_json"])


def upsert_reports(stored: DataFrame, incoming: DataFrame) -> DataFrame:
    """A new report for a date replaces the stored one."""
    return upsert(stored, incoming, ["report_date"], ["ingested_at", "payload_json"])


def explode_list(rows: DataFrame, value: Column, name: str = "_item") -> DataFrame:
    """One row per item of a VARIANT list; a row whose value is no list stays once with a null item."""
    exploded = rows.withColumn("_list", value).lateralJoin(
        rows.sparkSession.tvf.variant_explode_outer(F.col("_list").outer())
    )
    kept = exploded.filter(F.coalesce(F.col("pos"), F.lit(0)).eqNullSafe(0) | F.col("key").isNull())
    item = F.when(F.col("key").isNull(), F.col("value"))
    return kept.select(*[F.col(c) for c in rows.columns], item.alias(name))


def _entries(reports: DataFrame, path: str) -> DataFrame:
    """Every key of the reports with its value, but the status key."""
    bodies = reports.select("report_date", report_body(F.col("payload_json"), path).alias("_body"))
    return (
        bodies.lateralJoin(reports.sparkSession.tvf.variant_explode(F.col("_body").outer()))
        .filter(F.col("key").isNotNull() & (F.col("key") != "Result"))
        .select("report_date", F.col("key").alias("code"), F.col("value").alias("_value"))
    )


def code_rows(reports: DataFrame, path: str = "$.OperationResult") -> DataFrame:
    """Code and amount pairs as rows; entries that are not numbers are left out."""
    return (
        _entries(reports, path)
        .filter(is_number(F.col("_value")))
        .select("report_date", "code", variant_number(F.col("_value")).alias("amount"))
    )


def investment_rows(reports: DataFrame, path: str = "$.OperationResult") -> DataFrame:
    """Single amounts as one row and lists as one row per item.

    An item without an amount counts as 0; an amount that is not a number is null.
    """
    entries = _entries(reports, path)
    listed = is_list(F.col("_value"))
    rows = explode_list(entries, F.when(listed, F.col("_value")))
    item_amount = F.when(
        F.try_variant_get("_item", "$.amount", "variant").isNull(), F.lit(0).cast(READ)
    ).otherwise(F.try_variant_get("_item", "$.amount", READ))
    return rows.filter(F.col("_item").isNotNull() | (~listed & is_number(F.col("_value")))).select(
        "report_date",
        F.col("code").alias("category"),
        F.try_variant_get("_item", "$.partner", "string").alias("partner"),
        F.try_variant_get("_item", "$.contract", "string").alias("contract"),
        F.when(F.col("_item").isNotNull(), item_amount).otherwise(variant_number(F.col("_value"))).alias("amount"),
    )


def upsert_codes(stored: DataFrame, incoming: DataFrame) -> DataFrame:
    """Incoming (date, code) amounts replace stored ones."""
    return upsert(stored, incoming, ["report_date", "code"], ["amount"])
