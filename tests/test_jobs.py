"""Whole loads and runs in temporary folders."""

from __future__ import annotations

import datetime as dt
import json
from decimal import Decimal

from coverledger import catalog, jobs
from coverledger.bridge import STATEMENTS, Bridge
from coverledger.sources import sinks, snapshots
from tests.test_sources import write_csv

T = dt.datetime


def test_reinsurance_files(spark, tmp_path):
    date, premium = (catalog.INCOMING_COLUMNS.index(c) for c in ("contract_conclusion_date", "total_accrued_premium_uzs"))

    def row(n, **cells):
        out = [None] * 28
        for i, v in cells.items():
            out[int(i[1:])] = v
        return (n, *out)

    rows = [(i, "header") for i in (1, 2, 3)] + [row(4, c0="s1", **{f"c{date}": "2025-03-01", f"c{premium}": "12.5"}), row(5), row(6, c0=" x ", **{f"c{date}": "bad"})]
    write_csv(tmp_path / "in" / "incoming.csv", rows)
    summary = jobs.load_reinsurance(spark, str(tmp_path / "in"), str(tmp_path / "table"), "incoming").collect()
    assert [tuple(r) for r in summary] == [("incoming.csv", 3, 1, 2)]
    got = sorted((r.seq_number, r.contract_conclusion_date, r.total_accrued_premium_uzs) for r in spark.read.parquet(str(tmp_path / "table")).collect())
    assert got == [("s1", dt.date(2025, 3, 1), Decimal("12.5")), ("x", None, None)]


def test_claims_2025_files(spark, tmp_path):
    cells = [None] * jobs.CLAIMS_2025_WIDTH
    cells[0], cells[16], cells[42] = "c1", " branch ", "100"
    rows = [(i, "header") for i in range(1, 5)] + [(5, *cells), (6, *([None] * jobs.CLAIMS_2025_WIDTH))]
    write_csv(tmp_path / "in" / "claims.csv", rows)
    table = str(tmp_path / "table")
    first = jobs.load_claims_2025(spark, str(tmp_path / "in"), table, dry_run=True).collect()
    assert [r.record_id for r in first] == ["c1"] and not (tmp_path / "table").exists()
    counts = {r.column_name: r.non_null for r in jobs.load_claims_2025(spark, str(tmp_path / "in"), table).collect()}
    assert counts["payout_total"] == 1 and counts["notes"] == 0 and len(counts) == 21
    jobs.load_claims_2025(spark, str(tmp_path / "in"), table, append=True)
    stored = spark.read.parquet(table)
    assert stored.count() == 2 and stored.first().branch_name == "branch" and set(catalog.CLAIMS_COLUMNS) <= set(stored.columns)


def test_report_files(spark, tmp_path):
    inbox = tmp_path / "inbox"
    inbox.mkdir()

    def land(name, amount, at):
        body = {"report_date": "2024-01-31", "payload_json": json.dumps({"OperationResult": {"F011": amount}}), "ingested_at": at}
        (inbox / name).write_text(json.dumps(body) + "\n")
        jobs.load_reports(spark, str(inbox), str(tmp_path / "table"), str(tmp_path / "state"))

    land("a.json", 1, "2024-02-01T00:00:00")
    land("b.json", 2, "2024-02-02T00:00:00")
    rows = spark.read.parquet(str(tmp_path / "table")).collect()
    assert len(rows) == 1 and json.loads(rows[0].payload_json)["OperationResult"]["F011"] == 2


def test_snapshots(spark, tmp_path):
    root, now = str(tmp_path), T(2025, 6, 1, 12)
    changing = lambda at, n: spark.createDataFrame([(i, at) for i in range(n)], "id int, date_modified timestamp_ntz")
    plain = spark.createDataFrame([(1,)], "id int")
    first = jobs.refresh_snapshots(spark, {"a": changing(T(2025, 5, 1), 2), "b": plain}, root, [], now)
    assert first == {"a": "CREATED", "b": "CREATED"}
    soon = now + dt.timedelta(hours=1)
    again = jobs.refresh_snapshots(spark, {"a": changing(T(2025, 5, 1), 2), "b": plain}, root, ["a", "b"], soon)
    assert again == {"a": "SKIPPED", "b": "SKIPPED"}
    later = now + dt.timedelta(hours=30)
    third = jobs.refresh_snapshots(spark, {"a": changing(T(2025, 6, 1, 20), 3), "b": plain}, root, ["a", "b"], later)
    assert third == {"a": "RELOADED", "b": "RELOADED"}
    rows = sinks.read_snapshot_table(spark, f"{root}/a", snapshots.STAMPS).collect()
    assert len(rows) == 3 and {tuple(r) for r in rows} == {(now, later)}
    emptied = jobs.refresh_snapshots(spark, {"b": plain.filter("false")}, root, ["b"], later + dt.timedelta(hours=30))
    assert emptied == {"b": "RELOADED"}
    assert sinks.read_snapshot_table(spark, f"{root}/b", snapshots.STAMPS).count() == 0


def test_models_from_stored_raw_tables(spark, sf_dir, tmp_path):
    bridge = Bridge(spark, sf_dir)
    raw = str(tmp_path / "raw")
    for name in ("ins_bank_client", "ins_regress_bank", "ins_regress", "ins_polis", "ins_anketa", "ins_kontragent"):
        assert name in STATEMENTS
        bridge(name).write.parquet(f"{raw}/{name}")
    jobs.main(["models", "--raw", raw, "--out", str(tmp_path / "out"), "--as-of", "2000-12-31", "--select", "subrogation_recoveries", "subrogation_indicators_monthly"])
    got = spark.read.parquet(str(tmp_path / "out/presentation/subrogation_indicators_monthly")).count()
    assert got == bridge.warehouse()["subrogation_indicators_monthly"].count()
