"""Reading values out of landed JSON reports through VARIANT.

VARIANT keeps decimals exact; ``from_json`` to text would pass them through a double.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from coverledger.functions.money import READ


def report_body(payload: Column, path: str) -> Column:
    """One object of the report as VARIANT; bad JSON or a missing path is null."""
    return F.try_variant_get(F.try_parse_json(payload), path, "variant")


def report_number(body: Column, key: str, amount_type: str = READ) -> Column:
    """Number under a key; text that is not a number is null."""
    return F.try_variant_get(body, f"$.{key}", amount_type)


def report_text(body: Column, key: str) -> Column:
    return F.nullif(F.try_variant_get(body, f"$.{key}", "string"), F.lit(""))


def report_items(body: Column, key: str) -> Column:
    """Array of items under a key; anything that is not an array gives an empty array."""
    items = F.try_variant_get(body, f"$.{key}", "array<variant>")
    return F.coalesce(items, F.array().cast("array<variant>"))


def is_list(value: Column) -> Column:
    """True for a VARIANT list with at least one item; looks at the first item only."""
    return F.try_variant_get(value, "$[0]", "variant").isNotNull()


def is_number(value: Column) -> Column:
    """True for a JSON number or boolean, not for text that looks like one."""
    return F.schema_of_variant(value).rlike("^(BIGINT|DECIMAL|DOUBLE|FLOAT|BOOLEAN)")


def variant_number(value: Column, amount_type: str = READ) -> Column:
    """A JSON number or boolean as an amount."""
    return F.coalesce(
        F.try_variant_get(value, "$", amount_type), F.try_variant_get(value, "$", "boolean").cast("int").cast(amount_type)
    )
