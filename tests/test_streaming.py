"""Incremental loads: each file once, restart from the checkpoint, latest report per date."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from coverledger.session import checkpoint_dir
from coverledger.streaming import loads
from tests.test_sources import write_csv

HEADER = [(i, f"h{i}") for i in range(1, 6)]


def run(query):
    query.awaitTermination(120)
    assert query.exception() is None


def test_drop_folder_reads_each_file_once(spark, tmp_path):
    drop, table, state, archive = (str(tmp_path / n) for n in ("drop", "table", "state", "archive"))
    write_csv(tmp_path / "drop" / "claims_1.csv", [*HEADER, (6, "r1", "north"), (7,)])
    write_csv(tmp_path / "drop" / "notes.csv", [*HEADER, (6, "ignored")])
    for _ in range(2):  # the second run finds nothing new
        run(loads.load_drop_folder(spark, drop, table, state, archive))
    assert [(r.record_id, r.route, r.source_file) for r in spark.read.parquet(table).collect()] == [("r1", "claims", "claims_1.csv")]
    write_csv(tmp_path / "drop" / "Reinsurance.csv", [*HEADER, (6, "r2")])
    run(loads.load_drop_folder(spark, drop, table, state, archive))
    got = {(r.record_id, r.route) for r in spark.read.parquet(table).collect()}
    assert got == {("r1", "claims"), ("r2", "reinsurance")}
    assert any((tmp_path / "archive").rglob("claims_1.csv"))


def test_latest_report_per_date(spark, tmp_path):
    schema = "report_date date, payload_json string, ingested_at timestamp_ntz"
    d1, d2 = dt.date(2024, 1, 31), dt.date(2024, 2, 29)
    inbox, table, state = (str(tmp_path / n) for n in ("inbox", "table", "state"))

    def land(*rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(inbox)

    def load():
        stream = spark.readStream.schema(schema).parquet(inbox)
        run(loads.latest_per_date_stream(stream, table, state, ["ingested_at"]))
        return {r.report_date: r.payload_json for r in spark.read.parquet(table).collect()}

    land((d1, "first", dt.datetime(2024, 2, 1)), (d1, "second", dt.datetime(2024, 2, 2)), (d2, "other", dt.datetime(2024, 3, 1)))
    assert load() == {d1: "second", d2: "other"}
    land((d1, "late", dt.datetime(2024, 4, 1)))
    assert load() == {d1: "late", d2: "other"}
    assert load() == {d1: "late", d2: "other"}


def test_checkpoint_dir_comes_from_the_session(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None)
    assert checkpoint_dir(spark, "/tmp/x") == (configured or "/tmp/x")
    if configured is None:
        with pytest.raises(ValueError):
            checkpoint_dir(spark)


def test_an_older_report_in_a_later_batch_does_not_replace(spark, tmp_path):
    """The same winners however the reports are spread over batches, and after a replay."""
    reports = [("2024-01-01", 5, "new"), ("2024-01-01", 2, "old"), ("2024-01-02", 1, "a"), ("2024-01-02", 9, "b")]
    for order in (reports, reports[::-1]):
        root = tmp_path / order[0][2]
        for n, row in enumerate([*order, order[1]]):  # the second comes again
            rows = spark.createDataFrame([row], "report_date string, ingested_at int, body string")
            rows.withColumn("report_date", F.to_date("report_date")).coalesce(1).write.parquet(str(root / "in" / f"batch{n}"))
            incoming = spark.readStream.schema("report_date date, ingested_at int, body string").option(
                "recursiveFileLookup", "true"
            ).option("maxFilesPerTrigger", 1).parquet(str(root / "in"))
            loads.latest_per_date_stream(
                incoming, str(root / "table"), str(root / "state"), ["ingested_at"]
            ).awaitTermination()
        got = spark.read.parquet(str(root / "table")).select("ingested_at", "body").collect()
        assert sorted(tuple(r) for r in got) == [(5, "new"), (9, "b")]
