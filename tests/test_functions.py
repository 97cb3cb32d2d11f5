"""Cleaning, dates, ratios, money and JSON values on hand-written edge cases."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from coverledger import catalog
from coverledger.functions import cleaning, dates, money, ratios, reports

D = dt.date


def column(spark, values, kind, expr):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r.out for r in df.select("i", expr(F.col("v")).alias("out")).orderBy("i").collect()]


def test_clean_numeric(spark):
    values = ["1 234,56", "1,234,567.89", "(12)", "abc", "", None, "-5 UZS", "1.5e6", "1\u00a0234"]
    got = column(spark, values, "string", cleaning.clean_numeric)
    want = ["1234.56", "1.234", "12", None, None, None, "-5", "1.5", "1"]
    assert got == [None if w is None else Decimal(w) for w in want]


def test_clean_numeric_strict(spark):
    got = column(spark, [" 12.50 ", "1 234", "1e3", "12 UZS", "  "], "string", cleaning.clean_numeric_strict)
    assert got == [Decimal("12.5"), None, Decimal(1000), None, None]


def test_clean_date(spark):
    day = D(2025, 1, 2)
    values = ["2025-01-02", "2025-01-02T00:00:00", "2025-01-02 00:00:00", " 2025-1-2 ", "02.01.2025", "x", "2025-13-01", "2025", "2025-01", None]
    assert column(spark, values, "string", cleaning.clean_date) == [day, day, day, day] + [None] * 6


def test_day_first_date(spark):
    got = column(spark, [" 31-12-2025 ", "2025-12-31", "", "31-02-2025", None], "string", cleaning.parse_day_first_date)
    assert got == [D(2025, 12, 31), None, None, None, None]


def test_blank_rules(spark):
    assert column(spark, [" a ", "  ", None, "\t"], "string", cleaning.blank_to_null) == ["a", None, None, "\t"]
    assert column(spark, ["\u00a0a\t", " \t ", None, "b"], "string", cleaning.strip_to_null) == ["a", None, None, "b"]


def test_flags(spark):
    assert column(spark, ["1", "x", None], "string", lambda c: cleaning.flag_is(c, 1)) == [True, False, None]
    assert column(spark, [1, 2, None], "int", lambda c: cleaning.flag_is(c, 1)) == [True, False, None]


def test_product_codes(spark):
    got = column(
        spark, ["201-1", "108", None, "0108", "99999999999999999999", "5"], "string",
        lambda c: cleaning.digits_in(c, catalog.COMPULSORY_PRODUCT_CODES),
    )
    assert got == [False, True, False, True, False, False]


def test_market_words_first_match_wins(spark):
    values = ["MAJBURIY sug'urta", "Ixtiyoriy sug", "osago majburiy", "majburiy va ixtiyoriy", "Jami", None]
    got = column(spark, values, "string", lambda c: cleaning.first_word_match(c, catalog.MARKET_CLASS_WORDS))
    assert got == ["Compulsory", "Voluntary", "Compulsory", "Compulsory", None, None]


def test_loan_status(spark):
    got = column(spark, [0, 1, 2, 3, None], "int", lambda c: cleaning.code_label(c, catalog.LOAN_STATUS, ""))
    assert got == ["Актив", "Исполненный", "Досрочное погашение", "", ""]


def test_month_ends(spark):
    ts = dt.datetime
    values = [ts(2025, 1, 31, 0, 0), ts(2025, 1, 31, 10, 0), ts(2025, 1, 1), ts(2024, 2, 29, 0, 0, 1), None]
    got = column(spark, values, "timestamp_ntz", dates.month_end_at_or_after)
    assert got == [D(2025, 1, 31), D(2025, 2, 28), D(2025, 1, 31), D(2024, 3, 31), None]


@pytest.mark.parametrize(
    "num, den, zero, null, positive",
    [(1, 2, 0.5, 0.5, 0.5), (1, 0, 0.0, None, 0.0), (1, None, None, None, 0.0), (None, 2, None, None, None), (4, -2, -2.0, -2.0, 0.0)],
)
def test_ratios(spark, num, den, zero, null, positive):
    df = spark.createDataFrame([(None if num is None else Decimal(num), None if den is None else Decimal(den))], "n decimal(38,4), d decimal(38,4)")
    n, d = F.col("n"), F.col("d")
    row = df.select(ratios.ratio_or_zero(n, d), ratios.ratio_or_null(n, d), ratios.ratio_if_positive(n, d)).first()
    assert tuple(row) == (zero, null, positive)


def test_conversion(spark):
    rows = [(1, Decimal(5), Decimal(7), Decimal(3)), (2, Decimal(5), Decimal(7), Decimal(3)), (2, None, None, Decimal(3)),
            (1, None, Decimal(7), None), (2, Decimal(5), Decimal(7), None), (None, Decimal(5), Decimal(7), Decimal(3))]
    df = spark.createDataFrame(rows, "v int, h decimal(22,4), f decimal(22,4), r decimal(22,4)")
    keep = money.convert(F.col("v"), F.col("h"), F.col("f"), F.col("r"))
    one = money.convert(F.col("v"), F.col("h"), F.col("f"), money.rate_or_one(F.col("r")))
    got = [tuple(r) for r in df.select(keep, one).collect()]
    assert [g[0] for g in got] == [5, 21, 0, 0, None, 21]
    assert [g[1] for g in got] == [5, 21, 0, 0, 7, 21]


def test_conversion_keeps_ten_decimals(spark):
    df = spark.createDataFrame([(Decimal("123456789012345678.1234"), Decimal("1.000001"))], "a decimal(22,4), r decimal(15,6)")
    got = df.select(money.convert(F.lit(2), F.lit(0), F.col("a"), F.col("r")).alias("x")).first().x
    assert got == Decimal("123456912469134690.4690781234")


def test_percent_is_exact(spark):
    df = spark.createDataFrame([(Decimal("0.0001"), Decimal("12.5"))], "a decimal(22,4), p decimal(10,4)")
    assert df.select(money.percent_of(F.col("a"), F.col("p")).alias("x")).first().x == Decimal("0.0000125000")


def test_billions_are_exact(spark):
    df = spark.createDataFrame([(Decimal("2345000000.0001"),)], "a decimal(38,4)")
    row = df.select(money.billions(F.col("a")).alias("x"), F.round(money.billions(F.col("a")), 2).alias("r")).first()
    assert (row.x, row.r) == (Decimal("2.3450000000001"), Decimal("2.35"))


PAYLOAD = """{"OperationResult":{"Result":"OK","Loans":12345678901234.5678,"Shares":"","Text":"7","Yes":true,
"Bonds":0,"Empty":[],"Deposits":[{"partner":"p","contract":"c","amount":5.5},{"partner":"q"},{"partner":"r","amount":""},3]}}"""


def test_report_values(spark):
    df = spark.createDataFrame([(PAYLOAD,), ("not json",), (None,), ('{"OperationResult":5}',)], "p string")
    body = reports.report_body(F.col("p"), "$.OperationResult")
    rows = df.select(
        reports.report_number(body, "Loans").alias("loans"),
        reports.report_number(body, "Result").alias("result"),
        reports.report_number(body, "Text").alias("text"),
        reports.report_number(body, "Missing").alias("missing"),
        F.size(reports.report_items(body, "Bonds")).alias("bonds"),
        F.size(reports.report_items(body, "Deposits")).alias("deposits"),
    ).collect()
    assert tuple(rows[0]) == (Decimal("12345678901234.5678"), None, Decimal(7), None, 0, 4)
    assert all(r.loans is None and r.deposits == 0 for r in rows[1:])


def test_large_and_fine_numbers_are_read_whole(spark):
    from coverledger.functions.cleaning import clean_numeric

    texts = ["1234567890123456789", "999999999999999999999 UZS", "0.00001"]
    got = spark.createDataFrame([(t,) for t in texts], "t string").select(clean_numeric(F.col("t")).alias("v")).collect()
    assert [r["v"] for r in got] == [Decimal(1234567890123456789), Decimal(999999999999999999999), Decimal("0.00001")]


def test_rates_keep_ten_decimals(spark):
    from coverledger.functions.money import convert

    df = spark.createDataFrame([(2, Decimal("1.0000"), Decimal("12.3456789012"))], "c int, a decimal(22,4), r decimal(18,10)")
    got = df.select(convert(F.col("c"), F.col("a"), F.col("a"), F.col("r")).alias("v")).first()["v"]
    assert got == Decimal("12.3456789012")
