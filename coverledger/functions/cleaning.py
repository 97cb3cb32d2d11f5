"""Text, number and date cleaning as native column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from coverledger.catalog import BLANK_CHARACTERS
from coverledger.functions.money import READ


def blank_to_null(c: Column) -> Column:
    """Trim spaces; an empty result is null."""
    return F.nullif(F.trim(c), F.lit(""))


def strip_to_null(c: Column) -> Column:
    """Trim every kind of white space, as the file loaders do; empty is null."""
    return F.nullif(F.btrim(c.cast("string"), F.lit(BLANK_CHARACTERS)), F.lit(""))


def first_filled(*cols: Column, default: str) -> Column:
    """First non-blank text, trimmed, else a label."""
    return F.coalesce(*[blank_to_null(c) for c in cols], F.lit(default))


def clean_numeric(c: Column, amount_type: str = READ) -> Column:
    """First signed number in free text.

    Spaces are dropped, one group after ``.`` or ``,`` is the fraction and the rest
    is ignored, so ``1,234,567.89`` gives 1.234 and ``(12)`` gives 12.
    """
    digits = F.regexp_extract(F.replace(c, F.lit(" "), F.lit("")), r"(-?[0-9]+(?:[.,][0-9]+)?)", 1)
    return F.nullif(F.replace(digits, F.lit(","), F.lit(".")), F.lit("")).try_cast(amount_type)


def clean_numeric_strict(c: Column, amount_type: str = READ) -> Column:
    """The whole text must be one number, else null (no partial reads)."""
    return strip_to_null(c).try_cast(amount_type)


def clean_date(c: Column) -> Column:
    """ISO date, with or without a time part; anything else is null.

    Spark alone would read ``2025`` and ``2025-01`` as 1 January, so a full
    year-month-day prefix is required first.
    """
    text = F.trim(c)
    return F.when(text.rlike(r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}"), text.try_cast("date"))


def parse_day_first_date(c: Column) -> Column:
    """``DD-MM-YYYY`` text to a date; blank or unreadable is null."""
    return F.try_to_timestamp(blank_to_null(c), F.lit("dd-MM-yyyy")).cast("date")


def flag_is(c: Column, value: int) -> Column:
    """Equality for a flag stored as a number or as text."""
    return c.cast("string") == F.lit(str(value))


def digits_in(c: Column, values: list[int]) -> Column:
    """True when the text is all digits and its number is in the list; never null."""
    number = F.when(c.rlike("^[0-9]+$"), c.try_cast("bigint"))
    return F.coalesce(number.isin(values), F.lit(False))


def first_word_match(c: Column, words: list[tuple[str, str]]) -> Column:
    """Label of the first word contained in the text, ignoring case; null if none."""
    chain = None
    for word, label in words:
        test = c.ilike(f"%{word}%")
        chain = F.when(test, F.lit(label)) if chain is None else chain.when(test, F.lit(label))
    return chain


def code_label(c: Column, labels: dict, default: str | None = None) -> Column:
    """CASE mapping of codes to labels."""
    chain = None
    for code, label in labels.items():
        test = c == F.lit(code)
        chain = F.when(test, F.lit(label)) if chain is None else chain.when(test, F.lit(label))
    return chain if default is None else chain.otherwise(F.lit(default))
