"""Whole loads and runs, each one call: what a scheduler starts.

    python -m coverledger.jobs models --raw RAW --out OUT --as-of 2025-12-31 [--select NAME ...]
    python -m coverledger.jobs snapshots --source ROOT --catalog COLUMNS --target COPIES [--now TIME]
    python -m coverledger.jobs stage --raw RAW --out STAGED [--buckets N]
    python -m coverledger.jobs reinsurance --path FILES --table TABLE --side outgoing
    python -m coverledger.jobs claims --path FILES --table TABLE [--append]
    python -m coverledger.jobs claims-2025 --path FILES --table TABLE [--append] [--dry-run]
    python -m coverledger.jobs drop-folder --path FOLDER --table TABLE [--archive FOLDER]
    python -m coverledger.jobs reports --path FILES --table TABLE

Folders are any paths Spark reads; raw tables are Parquet folders named after the table, or what
``stage`` laid out.
"""

from __future__ import annotations

import argparse
import datetime as dt
import re
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from coverledger import catalog
from coverledger.operators.ordering import preview
from coverledger.operators.quality import load_metrics, observed_profile, observed_rows, observed_summary
from coverledger.plans.warehouse import CURATED, MARTS, PARTS, Warehouse
from coverledger.session import checkpoint_dir, tune
from coverledger.sources import landing, layout, rejected, sinks, snapshots
from coverledger.streaming import loads

CLAIMS_2025_WIDTH = max(catalog.CLAIMS_2025_POSITIONS) + 1
#: Files of a reinsurance load that one write counts; more go by further writes.
FILES_AT_ONCE = 200
REPORT_SCHEMA = "report_date date, payload_json string, ingested_at timestamp_ntz"


def raw_folder(spark: SparkSession, root: str):
    """Raw tables stored as ``root/name``, or laid out under the root by ``stage``."""
    if layout.published(spark, root.rstrip("/")):
        return layout.Staged(spark, root.rstrip("/"))
    return lambda name: spark.read.parquet(f"{root.rstrip('/')}/{name}")


def run_models(warehouse: Warehouse, out: str, select: list[str] | None = None) -> list[str]:
    """Save all models, or the selected ones; returns the names saved.

    Selected models read the layers that an earlier run stored, where there are any.
    """
    if not select:
        warehouse.save_all(out)
        return [*CURATED, *MARTS]
    warehouse.read_stored(out, [n for n in [*PARTS, *CURATED, *MARTS] if n not in select])
    for name in select:
        warehouse.save(name, out)
    return select


def load_reinsurance(
    spark: SparkSession, path: str, table: str, side: str, rejected_table: str | None = None
) -> DataFrame:
    """Clean and store one side's landing files; returns rows read, skipped and inserted per file.

    A file's rows replace those of an earlier load of it, so a rerun repeats nothing. The counts
    are observed by the write. Values that their column cannot hold stay with the row and go to
    the side table (``table`` + ``_rejected`` unless another is named).
    """
    columns = catalog.OUTGOING_COLUMNS if side == "outgoing" else catalog.INCOMING_COLUMNS
    files = sorted(landing.read_landing(spark, path, 1).inputFiles())
    found, summaries = 0, []
    for a in range(0, len(files), FILES_AT_ONCE):
        some = files[a : a + FILES_AT_ONCE]
        names = sorted({f.rsplit("/", 1)[-1] for f in some})  # as Spark names them, with %20 for a blank
        paths = [re.sub(r"([\[\]{}*?\\])", r"\\\1", unquote(f)) for f in some]
        raw = landing.read_landing(spark, paths, len(columns))
        keep = ("source_file", "row_no")
        named = landing.positional(raw, columns, catalog.HEADER_ROWS[side], keep=keep)
        counted, fitted = Observation(), Observation()
        metrics = load_metrics(columns, "source_file", names)
        read = named.observe(counted, *(m.alias(k) for k, m in metrics.items()))
        rows = landing.clean_typed_rows(landing.drop_empty(read, columns), columns, keep)
        # A task reads one file, so its rows need no exchange; one without rows would lose the counts.
        sinks.replace_partitions(rows.observe(fitted, rejected.rejected_count().alias("n")), table, "source_file")
        seen, found = counted.get, found + fitted.get["n"]
        for name, read_rows, skipped, inserted in observed_rows(seen, names):
            if read_rows and not inserted:
                sinks.drop_slice(spark, f"{table}/source_file={name}")
        summaries.append(observed_summary(spark, seen, "source_file", names))
    side_table = rejected_table or f"{table.rstrip('/')}_rejected"
    if summaries and sinks.has_files(spark, table):
        stored = spark.read.parquet(table)
        rejected.keep_rejected(stored, side_table, f"reinsurance_{side}", ["source_file", "row_no"], found)
    return reduce(DataFrame.unionByName, summaries)


def load_claims_2025(spark: SparkSession, path: str, table: str, append: bool = False, dry_run: bool = False) -> DataFrame:
    """Pick the mapped positions of the 2025 export and store them as text.

    Returns the non-null counts of the mapped fields, observed by the write; a dry run returns the
    first five rows instead and stores nothing.
    """
    raw = landing.read_landing(spark, path, CLAIMS_2025_WIDTH).filter(F.col("row_no") > catalog.HEADER_ROWS["claims_2025"])
    mapped = [c for c in catalog.CLAIMS_COLUMNS if c in catalog.CLAIMS_2025_POSITIONS.values()]
    picked = landing.project_positions(raw, catalog.CLAIMS_2025_POSITIONS, catalog.CLAIMS_COLUMNS, keep=("source_file",))
    counted = Observation()
    read = picked.observe(counted, *(m.alias(k) for k, m in load_metrics(mapped).items()))
    rows = landing.drop_empty(read, mapped).withColumn("loaded_at", landing.iso_text(F.current_timestamp()))
    if dry_run:
        return preview(rows, [("record_id", "asc"), ("claim_id", "asc")], 5)
    sinks.write_landing(rows, table, append)
    return observed_profile(spark, counted.get, mapped)


def load_claims_files(spark: SparkSession, path: str, table: str, append: bool = False) -> DataFrame:
    """Claims files with headers of their own into one table that gains columns as they come.

    Returns the rows stored per file, as the write observed them.
    """
    frames = landing.headed_frames(spark, path)
    counted = [Observation() for _ in frames]
    rows = [f.observe(o, F.count(F.lit(1)).alias("n"), F.first("source_file").alias("file")) for f, o in zip(frames, counted)]
    sinks.write_batch(rows, table, append)
    seen = [o.get for o in counted]
    return spark.createDataFrame([(s["file"], s["n"]) for s in seen if s["n"]], "source_file string, rows_stored long")


def load_reports(spark: SparkSession, path: str, table: str, state: str) -> None:
    """Landed JSON reports into a table with one report per date, the last one landed."""
    incoming = spark.readStream.schema(REPORT_SCHEMA).json(path)
    loads.latest_per_date_stream(incoming, table, state, ["ingested_at", "payload_json"]).awaitTermination()


def refresh_snapshots(
    spark: SparkSession, sources: dict[str, DataFrame], target_root: str, existing: list[str], now: dt.datetime
) -> dict[str, str]:
    """Create, reload or skip each table copy; returns the decision per table.

    All watermarks come from two jobs; only one row per table reaches the driver.
    """
    facts = snapshots.source_facts({t: (df, None, snapshots.modified_column(df.columns)) for t, df in sources.items()})
    plan = decide(spark, facts, target_root, existing, now)
    for name, row in plan.items():
        if row.decision == "SKIPPED":
            continue
        uploaded = row.first_load if row.decision == "RELOADED" else now
        stamped = sources[name].withColumns(
            {
                "etl_uploaded_date": F.lit(uploaded).cast("timestamp_ntz"),
                "etl_updated_date": F.lit(now).cast("timestamp_ntz"),
            }
        )
        sinks.write_snapshot(stamped, f"{target_root}/{name}")
    return {name: row.decision for name, row in plan.items()}


def copy_tables(
    spark: SparkSession,
    columns: dict[str, list[tuple]],
    read: Callable[[str], DataFrame],
    target_root: str,
    now: dt.datetime,
    at_once: int = 4,
) -> DataFrame:
    """Copy the tables of a catalog: types, refresh decision, load stamps and counts in one run.

    One job reads every source once for its newest change and the bounds of its split column, one
    job the load times of the copies. Tables to be copied are typed by the catalog, stamped (a
    reload keeps the first load time) and replaced at commit, several at a time. Values that a type
    cannot hold are null in the copy and listed in ``target_root/_rejected``. Returns a row for
    each table: decision, rows copied and rejected values as the write observed them, split bounds.
    """
    sources = {t: read(t) for t in columns}
    split = {t: snapshots.split_column(c) for t, c in columns.items()}
    typed = {t: snapshots.typed_rows(df, columns[t]) for t, df in sources.items()}
    changed = {t: snapshots.modified_column([c for c in df.columns if c != rejected.REJECTED]) for t, df in typed.items()}
    facts = snapshots.source_facts({t: (typed[t], split[t], changed[t]) for t in columns})
    existing = [t for t in columns if sinks.has_files(spark, f"{target_root}/{t}/snapshot=current")]
    plan = decide(spark, facts, target_root, existing, now)

    def copy(name: str) -> tuple:
        row, observed = plan[name], {"n": None, "rejected": None}
        if row.decision != "SKIPPED":
            uploaded = row.first_load if row.decision == "RELOADED" and row.first_load else now
            stamps = {"etl_uploaded_date": uploaded, "etl_updated_date": now}
            rows = typed[name].withColumns({c: F.lit(at).cast("timestamp_ntz") for c, at in stamps.items()})
            path = f"{target_root}/{name}"
            observed = sinks.write_snapshot(rows, path, rejected=rejected.rejected_count())
            stored = sinks.read_snapshot_table(spark, path, rows.schema)
            key = [split[name]] if split[name] else []
            rejected.keep_rejected(stored, f"{target_root}/_rejected", name, key, observed["rejected"])
        return name, row.decision, observed["n"], observed["rejected"], split[name], row.lower, row.upper

    with ThreadPoolExecutor(at_once) as pool:
        rows = list(pool.map(copy, columns))
    return spark.createDataFrame(
        rows,
        "table_name string, decision string, rows_copied long, rejected_values long, "
        "split_column string, lower string, upper string",
    )


def decide(spark: SparkSession, facts: DataFrame, target_root: str, existing: list[str], now: dt.datetime) -> dict:
    """Per table its facts, the first and last load of its copy, and what to do with it."""
    stored = {t: sinks.read_snapshot_table(spark, f"{target_root}/{t}", snapshots.STAMPS) for t in existing}
    rows = facts.withColumns({"loaded": F.lit(None).cast("timestamp_ntz"), "first_load": F.lit(None).cast("timestamp_ntz")})
    if stored:
        loads_of = [
            df.agg(F.max("etl_updated_date").alias("loaded"), F.min("etl_uploaded_date").alias("first_load")).select(
                F.lit(t).alias("table_name"), "loaded", "first_load"
            )
            for t, df in stored.items()
        ]
        rows = facts.join(reduce(DataFrame.unionByName, loads_of), "table_name", "left")
    decision = snapshots.refresh_decision(
        F.col("table_name").isin(existing), F.col("loaded"), F.col("has_modified"), F.col("modified"), now
    )
    return {r.table_name: r for r in rows.withColumn("decision", decision).collect()}


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="coverledger.jobs")
    jobs = parser.add_subparsers(dest="job", required=True)
    models = jobs.add_parser("models")
    models.add_argument("--raw", required=True)
    models.add_argument("--out", required=True)
    models.add_argument("--as-of", type=dt.date.fromisoformat, default=dt.date.today())
    models.add_argument("--select", nargs="*", choices=[*CURATED, *MARTS])
    models.add_argument("--reinsurance-years", nargs=2, type=int, metavar=("FIRST", "SECOND"))
    models.add_argument("--market-columns", nargs=6, help="premium, claims and liabilities of the market, prior and current year each")
    models.add_argument("--registry-keys-unique", action="store_true")
    stage = jobs.add_parser("stage")
    stage.add_argument("--raw", required=True)
    stage.add_argument("--out", required=True)
    stage.add_argument("--buckets", type=int, help="of the tables that meet on the contract; by size if not given")
    copies = jobs.add_parser("snapshots")
    copies.add_argument("--source", required=True, help="folder with a Parquet folder for each table")
    copies.add_argument("--catalog", required=True, help="Parquet rows of the tables' columns")
    copies.add_argument("--target", required=True)
    copies.add_argument("--now", type=dt.datetime.fromisoformat)
    for name in ("reinsurance", "claims", "claims-2025", "drop-folder", "reports"):
        job = jobs.add_parser(name)
        job.add_argument("--path", required=True)
        job.add_argument("--table", required=True)
        if name == "reinsurance":
            job.add_argument("--side", choices=["outgoing", "incoming"], required=True)
        if name in ("claims", "claims-2025"):
            job.add_argument("--append", action="store_true")
        if name == "claims-2025":
            job.add_argument("--dry-run", action="store_true")
        if name == "drop-folder":
            job.add_argument("--archive")
    args = parser.parse_args(argv)
    spark = tune(SparkSession.builder.appName(f"coverledger-{args.job}").getOrCreate())
    if args.job == "models":
        options = {"reinsurance_years": args.reinsurance_years, "market_columns": args.market_columns}
        options = {k: tuple(v) for k, v in options.items() if v}
        warehouse = Warehouse(
            raw_folder(spark, args.raw), args.as_of, registry_keys_unique=args.registry_keys_unique, **options
        )
        for name in run_models(warehouse, args.out, args.select):
            print(name)
    elif args.job == "snapshots":
        columns = snapshots.read_catalog(spark.read.parquet(args.catalog))
        now = args.now or dt.datetime.now()
        source = lambda name: spark.read.parquet(f"{args.source}/{name}")
        copy_tables(spark, columns, source, args.target, now).show(len(columns), truncate=False)
    elif args.job == "stage":
        tables = sinks.folder_names(spark, args.raw)
        layout.stage(raw_folder(spark, args.raw), tables, spark, args.out.rstrip("/"), args.buckets)
    elif args.job == "reinsurance":
        load_reinsurance(spark, args.path, args.table, args.side).show(truncate=False)
    elif args.job == "claims":
        load_claims_files(spark, args.path, args.table, args.append).show(1000, truncate=False)
    elif args.job == "claims-2025":
        load_claims_2025(spark, args.path, args.table, args.append, args.dry_run).show(50, truncate=False)
    else:
        state = f"{checkpoint_dir(spark, args.table + '_state')}/{args.job}"
        if args.job == "drop-folder":
            loads.load_drop_folder(spark, args.path, args.table, state, args.archive).awaitTermination()
        else:
            load_reports(spark, args.path, args.table, state)


if __name__ == "__main__":
    main()
