"""Loads in one pass: observed counts, rejected values, table copies by catalog, quarantine."""

from __future__ import annotations

import datetime as dt
import json
from decimal import Decimal

import pytest
from pyspark.sql import functions as F, types as T

from coverledger import catalog, jobs
from coverledger.bridge import AS_OF
from coverledger.plans.warehouse import Warehouse
from coverledger.sources import landing, rejected, sinks, snapshots
from coverledger.streaming import loads
from tests.test_sources import write_csv

NOW = dt.datetime(2025, 6, 1, 12)
COLUMNS = {
    "deals": [("ID", "NUMBER", 9, 0, "N"), ("AMOUNT", "NUMBER", 7, 2, "Y"), ("DATE_MODIFIED", "DATE", None, None, "Y"), ("NOTE", "CLOB", None, None, "Y")],
    "people": [("NAME", "VARCHAR2", None, None, "Y"), ("BORN", "DATE", None, None, "N")],
}


def side(spark, root):
    return sorted((r.table_name, r.row_key, r.column_name, r.text, r.reason) for r in rejected.read_rejected(spark, root).collect())


# ---- copies by catalog ---------------------------------------------------------


def land(spark, root, deals, people=(("a", "1990-01-02"),)):
    spark.createDataFrame(deals, "id string, amount string, date_modified string, note string").write.mode("overwrite").parquet(f"{root}/deals")
    spark.createDataFrame(list(people), "Name string, born string").write.mode("overwrite").parquet(f"{root}/people")


def test_copy_by_catalog(spark, tmp_path):
    source, target = str(tmp_path / "source"), str(tmp_path / "target")
    read = lambda name: spark.read.parquet(f"{source}/{name}")
    run = lambda at: {r.table_name: r for r in jobs.copy_tables(spark, COLUMNS, read, target, at).collect()}
    land(spark, source, [("1", "12.345", "2025-05-01", "x"), ("7", "1000000000000000000", None, None), ("x", " ", "soon", "y")])
    first = run(NOW)
    assert tuple(first["deals"])[1:] == ("CREATED", 3, 3, "id", "1", "7")
    assert tuple(first["people"])[1:] == ("CREATED", 1, 0, "born", "1990-01-02 00:00:00", "1990-01-02 00:00:00")
    schema = T.StructType([*snapshots.catalog_schema(COLUMNS["deals"]).fields, *snapshots.STAMPS.fields])
    copy = lambda: sinks.read_snapshot_table(spark, f"{target}/deals", schema)
    rows = copy()
    assert rows.schema["amount"].dataType == T.DecimalType(7, 2) and rows.schema["id"].dataType == T.IntegerType()
    got = {(r.id, r.amount, r.note, r.etl_uploaded_date, r.etl_updated_date) for r in rows.collect()}
    assert got == {(1, Decimal("12.35"), "x", NOW, NOW), (7, None, None, NOW, NOW), (None, None, "y", NOW, NOW)}
    lost = [
        ("deals", "{\"id\":7}", "amount", "1000000000000000000", "does not fit decimal(7,2)"),
        ("deals", "{}", "date_modified", "soon", "not a date"),
        ("deals", "{}", "id", "x", "no number"),
    ]
    assert side(spark, f"{target}/_rejected") == lost
    assert {r.decision for r in run(NOW + dt.timedelta(hours=1)).values()} == {"SKIPPED"}
    land(spark, source, [("1", "2", "2025-06-02", None)])
    later = NOW + dt.timedelta(hours=30)
    again = run(later)
    assert (again["deals"].decision, again["deals"].rows_copied, again["people"].decision) == ("RELOADED", 1, "RELOADED")
    assert {(r.etl_uploaded_date, r.etl_updated_date) for r in copy().collect()} == {(NOW, later)}
    assert side(spark, f"{target}/_rejected") == []  # the copy has no such value any more
    with pytest.raises(ValueError, match="amount"):
        jobs.copy_tables(spark, {"people": COLUMNS["deals"]}, lambda _: spark.createDataFrame([(1,)], "id int"), target, NOW)


def test_copy_command(spark, tmp_path):
    source, target = str(tmp_path / "source"), str(tmp_path / "target")
    land(spark, source, [("5", "1", "2025-05-01", None)], people=[])
    rows = [(t, n, kind, p, s, null, k) for t, cs in COLUMNS.items() for k, (n, kind, p, s, null) in enumerate(cs)]
    columns = "table_name string, column_name string, data_type string, precision int, scale int, nullable string, position int"
    spark.createDataFrame(rows[::-1], columns).write.parquet(str(tmp_path / "catalog"))
    assert snapshots.read_catalog(spark.read.parquet(str(tmp_path / "catalog"))) == COLUMNS
    jobs.main(["snapshots", "--source", source, "--catalog", str(tmp_path / "catalog"), "--target", target, "--now", "2025-06-01T12:00:00"])
    assert sinks.read_snapshot_table(spark, f"{target}/deals", snapshots.STAMPS).count() == 1
    assert sinks.read_snapshot_table(spark, f"{target}/people", snapshots.STAMPS).count() == 0


def test_options_of_a_database_read():
    assert snapshots.split_column(COLUMNS["deals"]) == "id" and snapshots.split_column(COLUMNS["people"]) == "born"
    assert snapshots.split_column([("A", "NUMBER", 9, 0, "Y"), ("B", "NUMBER", 9, 2, "N"), ("C", "CHAR", None, None, "N")]) is None
    split = snapshots.jdbc_options("jdbc:x", "deals", "id", (1, 900), partitions=8, user="u")
    assert split == {
        "url": "jdbc:x", "dbtable": "deals", "fetchsize": "10000", "user": "u",
        "partitionColumn": "id", "lowerBound": "1", "upperBound": "900", "numPartitions": "8",
    }
    assert "partitionColumn" not in snapshots.jdbc_options("jdbc:x", "t", one_task=True)
    for bounds in (None, (None, None)):
        with pytest.raises(ValueError, match="one_task"):
            snapshots.jdbc_options("jdbc:x", "t", "id", bounds)
    asked = snapshots.facts_query("deals", "id", "date_modified")
    assert asked == "(SELECT max(date_modified) AS modified, min(id) AS lower_bound, max(id) AS upper_bound FROM deals) facts"
    assert "NULL AS modified, NULL AS lower_bound" in snapshots.facts_query("t", None, None)


# ---- observed loads ------------------------------------------------------------


def reinsurance_row(n, **cells):
    out = [None] * len(catalog.INCOMING_COLUMNS)
    for name, v in cells.items():
        out[catalog.INCOMING_COLUMNS.index(name)] = v
    return (n, *out)


HEAD = [(i, "header") for i in (1, 2, 3)]


@pytest.mark.parametrize("at_once", [200, 1])
def test_reinsurance_counts_rejects_and_reruns(spark, tmp_path, monkeypatch, at_once):
    monkeypatch.setattr(jobs, "FILES_AT_ONCE", at_once)
    inbox, table = str(tmp_path / "in"), str(tmp_path / "table")
    good = reinsurance_row(4, seq_number="s1", contract_conclusion_date="2025-03-01", total_accrued_premium_uzs="1000000000000000000")
    bad = reinsurance_row(5, seq_number="s2", contract_conclusion_date="01.03.2025", total_accrued_premium_uzs="9" * 30)
    write_csv(tmp_path / "in" / "a one.csv", [*HEAD, good, bad, (6,)])
    write_csv(tmp_path / "in" / "b.csv", [*HEAD, reinsurance_row(4, seq_number="s3")])
    write_csv(tmp_path / "in" / "c.csv", [*HEAD, (4,)])
    for _ in range(2):  # a rerun repeats nothing
        summary = sorted(tuple(r) for r in jobs.load_reinsurance(spark, inbox, table, "incoming").collect())
        assert summary == [("a%20one.csv", 3, 1, 2), ("b.csv", 1, 0, 1), ("c.csv", 1, 1, 0)]
        stored = sorted((r.seq_number, r.total_accrued_premium_uzs) for r in spark.read.parquet(table).collect())
        assert stored == [("s1", Decimal(10**18)), ("s2", None), ("s3", None)]
        key = json.dumps({"source_file": "a%20one.csv", "row_no": 5}, separators=(",", ":"))
        assert side(spark, f"{table}_rejected") == [
            ("reinsurance_incoming", key, "contract_conclusion_date", "01.03.2025", "not a date"),
            ("reinsurance_incoming", key, "total_accrued_premium_uzs", "9" * 30, "does not fit decimal(30,6)"),
        ]
    write_csv(tmp_path / "in" / "a one.csv", [*HEAD, good])
    write_csv(tmp_path / "in" / "b.csv", [*HEAD, (4,)])
    jobs.load_reinsurance(spark, inbox, table, "incoming")
    assert [r.seq_number for r in spark.read.parquet(table).collect()] == ["s1"]
    assert side(spark, f"{table}_rejected") == []


def test_a_load_reads_its_files_once(spark, tmp_path):
    """Every row passes the scan once, counted by a column that counts what it sees."""
    cells = [None] * jobs.CLAIMS_2025_WIDTH
    cells[0], cells[42] = "c1", "100"
    write_csv(tmp_path / "in" / "claims.csv", [*[(i, "header") for i in range(1, 5)], *[(5 + k, *cells) for k in range(50)]])
    seen, read = spark.sparkContext.accumulator(0), landing.read_landing

    def counting(*args):
        def count(batches):
            for batch in batches:
                seen.add(batch.num_rows)
                yield batch

        rows = read(*args)
        return rows.mapInArrow(count, rows.schema)

    landing.read_landing = counting
    try:
        counts = jobs.load_claims_2025(spark, str(tmp_path / "in"), str(tmp_path / "table")).collect()
    finally:
        landing.read_landing = read
    assert seen.value == 54 and {r.total_rows for r in counts} == {50}


def test_saved_claims_tell_what_did_not_fit(spark, tmp_path):
    root = str(tmp_path)
    schema = "record_id string, claim_id string, payout_total string, loaded_at string"
    table = lambda *rows: (lambda _: spark.createDataFrame(rows, schema))
    big = "1" + "0" * 18
    w = Warehouse(table(("1", "a", big, None), ("2", "b", "9" * 25, None), ("3", "c", "none", None), ("4", "d", " ", None)), AS_OF)
    w.save("claims_portfolio", root)
    assert {r.record_id: r.payout_total for r in w["claims_portfolio"].collect()} == {"1": Decimal(big), "2": None, "3": None, "4": None}
    assert rejected.REJECTED not in w["claims_portfolio"].columns
    assert [(c, t, why) for _, _, c, t, why in side(spark, f"{root}/rejected")] == [
        ("payout_total", "9" * 25, "does not fit decimal(30,6)"),
        ("payout_total", "none", "no number"),
    ]
    Warehouse(table(("1", "a", "5", None)), AS_OF).save("claims_portfolio", root)
    assert side(spark, f"{root}/rejected") == []


# ---- quarantine ----------------------------------------------------------------


def test_unrouted_files_stay_and_broken_rows_are_kept(spark, tmp_path):
    drop, table, state, archive = (str(tmp_path / n) for n in ("drop", "table", "state", "archive"))
    header = [(i, f"h{i}") for i in range(1, 6)]
    write_csv(tmp_path / "drop" / "CLAIMS_1.csv", [*header, (6, "r1", "north"), ("six", "lost"), (7,)])
    write_csv(tmp_path / "drop" / "notes.csv", [(1, "x")])
    for _ in range(2):  # looking again adds nothing
        loads.load_drop_folder(spark, drop, table, state, archive).awaitTermination()
        files = sinks.read_snapshot_table(spark, f"{table}_quarantine/files", T.StructType().add("source_file", "string").add("reason", "string"))
        assert [tuple(r) for r in files.collect()] == [("notes.csv", "no route for this name")]
        lost = spark.read.parquet(f"{table}_quarantine/rows").collect()
        assert [(r.source_file, r.route, r.text.split(",")[:2]) for r in lost] == [("CLAIMS_1.csv", "claims", ["six", "lost"])]
        assert [r.record_id for r in spark.read.parquet(table).collect()] == ["r1"]
    write_csv(tmp_path / "drop" / "reinsur.csv", [*header, (6, "r2")])
    for _ in range(2):
        loads.load_drop_folder(spark, drop, table, state, archive).awaitTermination()
    assert (tmp_path / "drop" / "notes.csv").exists() and not (tmp_path / "drop" / "CLAIMS_1.csv").exists()
    assert sorted(r.record_id for r in spark.read.parquet(table).collect()) == ["r1", "r2"]
    (tmp_path / "drop" / "notes.csv").rename(tmp_path / "claim_notes.csv")
    loads.load_drop_folder(spark, drop, table, state, archive).awaitTermination()
    assert spark.read.schema("source_file string").parquet(f"{table}_quarantine/files").count() == 0


def test_routed_names_match_like_routes(spark):
    names = ["Claims.csv", "my REINSURANCE.csv", "q1_solvency", "note.csv", "claim"]
    rows = spark.createDataFrame([(n,) for n in names], "n string")
    routed = {r.n for r in rows.filter(landing.route_of(F.col("n")).isNotNull()).collect()}
    glob = spark._jvm.org.apache.hadoop.fs.GlobPattern(loads.routed_names())
    assert {n for n in names if glob.matches(n)} == routed == set(names) - {"note.csv"}


# ---- evolving tables -------------------------------------------------------------


def test_three_loads_with_growing_columns(spark, tmp_path):
    table = str(tmp_path / "table")
    word = next(iter(catalog.CLAIMS_HEADER_WORDS.values()))[0]
    column = next(iter(catalog.CLAIMS_HEADER_WORDS))

    def load(name, *rows, append=True):
        write_csv(tmp_path / name / f"{name}.csv", rows)
        return [tuple(r) for r in jobs.load_claims_files(spark, str(tmp_path / name), table, append).collect()]

    assert load("one", (word, "Own Field"), (" 1 ", "a"), ("2", " "), append=False) == [("one.csv", 2)]
    first = sinks.read_landing_table(spark, table)
    assert first.columns == [column, "own_field", "source_file", "loaded_at"]
    load("two", ("Other", word), ("x", "3"))
    load("three", (word, "own field", "Late"), ("4", "b", "c"))
    grown = sinks.read_landing_table(spark, table)
    assert grown.columns == [column, "own_field", "source_file", "loaded_at", "other", "late"]
    got = {(r[column], r.own_field, r.other, r.late, r.source_file) for r in grown.collect()}
    assert got == {
        ("1", "a", None, None, "one.csv"), ("2", None, None, None, "one.csv"),
        ("3", None, "x", None, "two.csv"), ("4", "b", None, "c", "three.csv"),
    }
    lists = [p.name for p in (tmp_path / "table").iterdir() if p.name.startswith(sinks.COLUMNS)]
    assert len(lists) == 3  # a late column is added once
    load("two", ("Other", word), ("y", "5"))
    assert len([p for p in (tmp_path / "table").iterdir() if p.name.startswith(sinks.COLUMNS)]) == 3
    assert spark.read.option("mergeSchema", "true").parquet(table).count() == 5  # the list is no data
    load("one", (word,), ("6",), append=False)
    assert sinks.read_landing_table(spark, table).columns == [column, "source_file", "loaded_at"]


def test_a_table_from_before_column_lists(spark, tmp_path):
    table = str(tmp_path / "t")
    spark.createDataFrame([("1",)], "a string").write.parquet(table)
    assert sinks.stored_columns(spark, table) is None
    assert sinks.read_landing_table(spark, table).columns == ["a"]
    sinks.write_landing(spark.createDataFrame([("2", "3")], "b string, a string"), table, append=True)
    assert sinks.stored_columns(spark, table) == ["a", "b"]
    assert {tuple(r) for r in sinks.read_landing_table(spark, table).collect()} == {("1", None), ("3", "2")}
