"""Landing files, sinks, snapshots and reports in temporary folders."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F, types as T

from coverledger import catalog
from coverledger.sources import landing, reports, sinks, snapshots

D = dt.date


def write_csv(path, rows):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join(",".join("" if v is None else str(v) for v in r) for r in rows) + "\n", encoding="utf-8")


def test_read_landing_skips_pads_and_trims(spark, tmp_path):
    write_csv(tmp_path / "in" / "a.csv", [(1, "h1"), (2, "h2"), (3, "x", "y"), (4, "p", "q", "r", "extra"), (5,)])
    raw = landing.read_landing(spark, str(tmp_path / "in"), 3)
    named = landing.positional(raw, ["one", "two", "three", "four"], 2, keep=("source_file",))
    got = sorted(map(tuple, named.collect()), key=str)
    assert got == sorted([("x", "y", None, None, "a.csv"), ("p", "q", "r", None, "a.csv"), (None, None, None, None, "a.csv")], key=str)
    assert landing.drop_empty(named, ["one", "two", "three", "four"]).count() == 2


def test_positions_last_mapping_wins(spark):
    raw = spark.createDataFrame([(" a ", "b")], "_c0 string, _c5 string")
    out = landing.project_positions(raw, {0: "x", 5: "x", 9: "y"}, ["x", "y", "z"])
    assert tuple(out.first()) == ("b", None, None)


def test_layouts():
    assert len(catalog.CLAIMS_COLUMNS) == 40 and len(catalog.CLAIMS_COLUMNS[: catalog.CLAIMS_SHORT_WIDTH]) == 38
    assert (len(catalog.OUTGOING_COLUMNS), len(catalog.INCOMING_COLUMNS)) == (112, 28)
    assert (len(catalog.BALANCE_SHEET_CODES), len(catalog.PERFORMANCE_CODES)) == (128, 53)
    assert len(catalog.CLAIMS_2025_POSITIONS) == 21
    assert set(catalog.CLAIMS_2025_POSITIONS.values()) <= set(catalog.CLAIMS_COLUMNS)


def test_typed_clean(spark):
    rows = [("2025-01-02", " 12.9 ", "1e3", " a "), ("02.01.2025", "-12.9", "1 234", "\t"), ("2025", "x", "(5)", None)]
    columns = ["contract_start_date", "insurance_days_count", "insurance_premium_policy", "region"]
    df = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in columns))
    got = [tuple(r) for r in landing.clean_typed_table(df, columns).collect()]
    assert got == [(D(2025, 1, 2), 12, Decimal(1000), "a"), (None, -12, None, None), (None, None, None, None)]


def test_text_clean(spark):
    df = spark.createDataFrame([(1, dt.datetime(2025, 1, 2, 3, 4, 5), D(2025, 1, 2), " x ")], "i int, t timestamp_ntz, d date, s string")
    assert tuple(landing.clean_text_table(df).first()) == ("1", "2025-01-02T03:04:05", "2025-01-02", "x")


def test_routes(spark):
    names = ["Claims_2024.csv", "REINSURANCE claim.csv", "reinsur.csv", "Solvency.csv", "other.csv"]
    df = spark.createDataFrame([(n,) for n in names], "source_file string")
    assert [r[0] for r in df.select(landing.route_of(F.col("source_file"))).collect()] == [
        "claims", "claims", "reinsurance", "solvency", None]
    assert {t: f.count() for t, f in landing.split_by_route(df).items()} == {"claims": 2, "reinsurance": 1, "solvency": 1}


def test_header_names():
    got = landing.harmonised_names(["№ п/п", "Класс страхования", "Класс", "Some  Field (x)", "Some Field-x", "", "Страхователь"])
    assert got == ["record_id", "insurance_class", "класс", "some_field_x", "some_field_x_2", "col_unnamed", "client_name"]
    assert len(landing.harmonised_names(["x" * 50], {})[0]) == 30


def test_evolving_append(spark, tmp_path):
    path = str(tmp_path / "claims")
    first = spark.createDataFrame([(1, "a")], "record_id int, client_name string")
    later = spark.createDataFrame([("2", "b", "north")], "record_id string, client_name string, branch_name string")
    sinks.write_landing(first, path, append=True)
    sinks.write_landing(later, path, append=True)
    got = sorted(map(tuple, sinks.read_landing_table(spark, path).select("record_id", "client_name", "branch_name").collect()))
    assert got == [("1", "a", None), ("2", "b", "north")]
    sinks.write_batch([first, later], path)  # a new run replaces the table
    assert sinks.read_landing_table(spark, path).count() == 2
    assert sinks.append_columns(first, later).columns == ["record_id", "client_name", "branch_name"]


def test_write_slices_leaves_other_dates(spark, tmp_path):
    path = str(tmp_path / "rows")
    schema = "report_date date, v int"
    sinks.write_slices(spark.createDataFrame([(D(2024, 1, 31), 1), (D(2024, 2, 29), 2), (D(2024, 2, 29), 3)], schema), path, "report_date")
    sinks.write_slices(spark.createDataFrame([(D(2024, 2, 29), 9)], schema), path, "report_date")
    assert sorted(r.v for r in spark.read.parquet(path).collect()) == [1, 9]


@pytest.mark.parametrize(
    "args, want",
    [
        (("NUMBER", None, None), T.DecimalType(38, 10)),
        (("NUMBER", 9, 0), T.IntegerType()),
        (("NUMBER", 10, 0), T.LongType()),
        (("NUMBER", 18, 0), T.LongType()),
        (("NUMBER", 19, 0), T.DecimalType(19, 0)),
        (("NUMBER", 38, 0), T.DecimalType(38, 0)),
        (("NUMBER", 15, 2), T.DecimalType(15, 2)),
        (("number", None, 0), T.DecimalType(38, 0)),
        (("VARCHAR2",), T.StringType()),
        (("CLOB",), T.StringType()),
        (("DATE",), T.TimestampNTZType()),
        (("TIMESTAMP(6)",), T.StringType()),
        (("BLOB",), T.StringType()),
    ],
)
def test_catalog_types(args, want):
    assert snapshots.catalog_type(*args) == want


def test_refresh_decision(spark):
    now = dt.datetime(2025, 6, 2, 12)
    hours = lambda h: now - dt.timedelta(hours=h)
    cases = [
        (False, None, True, hours(1), "CREATED"),
        (True, None, True, None, "RELOADED"),
        (True, None, False, None, "RELOADED"),
        (True, hours(5), True, hours(1), "RELOADED"),
        (True, hours(1), True, hours(5), "SKIPPED"),
        (True, hours(99), True, None, "SKIPPED"),
        (True, hours(23), False, None, "SKIPPED"),
        (True, hours(25), False, None, "RELOADED"),
    ]
    df = spark.createDataFrame([(i, *c[:4]) for i, c in enumerate(cases)], "i int, e boolean, l timestamp_ntz, m boolean, s timestamp_ntz")
    decision = snapshots.refresh_decision(F.col("e"), F.col("l"), F.col("m"), F.col("s"), now)
    assert [r[0] for r in df.select(decision).collect()] == [c[4] for c in cases]


def test_load_stamps(spark):
    now = dt.datetime(2025, 6, 2)
    rows = spark.createDataFrame([(1,)], "i int")
    assert tuple(snapshots.stamp_load(rows, now).first()) == (1, now, now)
    first = dt.datetime(2024, 1, 1)
    stored = spark.createDataFrame([(first,), (now,)], "etl_uploaded_date timestamp_ntz")
    assert tuple(snapshots.stamp_load(rows, now, stored).first()) == (1, first, now)


def test_watermarks_and_modified_column(spark):
    assert snapshots.modified_column(["id", "DATE_MODIFIED", "updated"]) == "DATE_MODIFIED"
    assert snapshots.modified_column(["id"]) is None
    df = spark.createDataFrame([(1, dt.datetime(2024, 1, 1)), (2, dt.datetime(2025, 1, 1))], "i int, m timestamp_ntz")
    got = {r.table_name: (r.has_source_max, r.source_max) for r in snapshots.watermarks({"a": (df, "m"), "b": (df, None)}, "source_max").collect()}
    assert got == {"a": (True, dt.datetime(2025, 1, 1)), "b": (False, None)}


def test_month_end_calendar(spark):
    got = [r[0] for r in snapshots.month_end_calendar(spark, D(2023, 12, 1), D(2024, 2, 10)).collect()]
    assert sorted(got) == [D(2023, 12, 31), D(2024, 1, 31), D(2024, 2, 29)]
    assert snapshots.month_end_calendar(spark, D(2025, 1, 1), D(2024, 2, 10)).count() == 0


def test_reports(spark):
    landed = [
        (D(2024, 1, 31), '{"OperationResult":{"Result":"OK","F1":1.5,"F2":"x","F3":true}}', dt.datetime(2024, 2, 1)),
        (D(2024, 1, 31), '{"OperationResult":{"Result":"OK","F1":2}}', dt.datetime(2024, 2, 2)),
        (D(2024, 2, 29), "broken", dt.datetime(2024, 3, 1)),
    ]
    df = spark.createDataFrame(landed, "report_date date, payload_json string, ingested_at timestamp_ntz")
    assert {(r.code, r.amount) for r in reports.code_rows(df).collect()} == {("F1", Decimal("1.5")), ("F3", Decimal(1)), ("F1", Decimal(2))}
    latest = reports.latest_reports(df)
    assert latest.count() == 2 and [r.amount for r in reports.code_rows(latest).collect()] == [2]
    assert reports.upsert_reports(df.limit(1), df.filter("day(ingested_at) = 2")).first().payload_json == landed[1][1]


def test_investment_rows(spark):
    payload = """{"OperationResult":{"Result":"OK","Loans":5,"Shares":"7","Empty":[],"Object":{"partner":"no"},"Nothing":null,
      "Bonds":[{"partner":"p","contract":"c","amount":1.25},{"partner":"q"},{"amount":""},{"amount":"2.5"},4]}}"""
    df = spark.createDataFrame([(D(2024, 1, 31), payload)], "report_date date, payload_json string")
    got = sorted(((r.category, r.partner, r.contract, r.amount) for r in reports.investment_rows(df).collect()), key=str)
    want = [("Loans", None, None, Decimal(5)), ("Bonds", "p", "c", Decimal("1.25")), ("Bonds", "q", None, Decimal(0)),
            ("Bonds", None, None, None), ("Bonds", None, None, Decimal("2.5")), ("Bonds", None, None, Decimal(0))]
    assert got == sorted(want, key=str)


def test_unsplit_database_read_is_refused(spark):
    with pytest.raises(ValueError, match="partition column"):
        snapshots.read_snapshot(spark, "jdbc:none", "big_table")


def test_rejected_values_are_gathered_once(spark):
    from coverledger.sources.rejected import REJECTED, with_rejected

    rows = spark.createDataFrame([("1", "2"), ("x", "y"), (None, "7z"), ("5", None)], "a string, b string")
    typed = rows.select("a", "b", *[F.col(c).try_cast("int").alias(f"n_{c}") for c in "ab"])
    df = with_rejected(typed, {f"n_{c}": F.col(c) for c in "ab"}, {"n_a": "int", "n_b": "int"})
    found = [None if r[0] is None else [(v.column_name, v.text, v.reason) for v in r[0]] for r in df.select(REJECTED).collect()]
    fits = "does not fit int"
    assert found == [None, [("n_a", "x", "no number"), ("n_b", "y", "no number")], [("n_b", "7z", fits)], None]
    assert df._jdf.queryExecution().optimizedPlan().toString().count("filter(array(") == 1
