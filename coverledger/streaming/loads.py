"""Incremental loads as file streams.

Both streams run with ``availableNow``: everything landed so far is processed once and
the query stops. The checkpoint records what was read, so a restart after a lost driver
or executor neither skips nor repeats a file.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from coverledger import catalog
from coverledger.operators.upsert import latest_wins
from coverledger.sources.landing import drop_empty, landing_schema, positional, route_of
from coverledger.sources.sinks import (
    as_text,
    has_files,
    read_snapshot_table,
    replace_partitions,
    write_slices,
    write_snapshot,
)

BROKEN = "_corrupt_record"


def routed_names() -> str:
    """Glob of the file names that have a route, in any case."""
    words = ("".join(f"[{c.lower()}{c.upper()}]" for c in word) for word, _ in catalog.FILE_ROUTES)
    return "{" + ",".join(f"*{w}*" for w in words) + "}"


def landing_stream(
    spark: SparkSession, drop_dir: str, width: int, archive_dir: str | None = None, names: str | None = None
) -> DataFrame:
    """New landing files of a drop folder, each read once; only names that match, if a glob is
    given. With an archive folder, files already processed are moved there when a later run looks
    at the folder again. The line of a row that does not fit the layout is in ``_corrupt_record``."""
    schema = landing_schema(width).add(BROKEN, "string")
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1000).option("columnNameOfCorruptRecord", BROKEN)
    if names is not None:
        reader = reader.option("pathGlobFilter", names)
    if archive_dir is not None:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive_dir)
    return reader.csv(drop_dir).select("*", F.col("_metadata.file_name").alias("source_file"))


def list_unrouted(spark: SparkSession, drop_dir: str, quarantine_dir: str) -> DataFrame:
    """Files of the drop folder without a route: listed with the reason, and left where they are.

    The list is replaced by what is there now, so looking again adds nothing.
    """
    found = spark.read.format("binaryFile").load(drop_dir).select("path", "length", "modificationTime")
    name = F.element_at(F.split("path", "/"), -1)
    files = found.filter(route_of(name).isNull()).select(
        name.alias("source_file"),
        "length",
        F.col("modificationTime").alias("modified_at"),
        F.lit("no route for this name").alias("reason"),
    )
    path = f"{quarantine_dir}/files"
    write_snapshot(files, path)
    return read_snapshot_table(spark, path, files.schema)


def load_drop_folder(
    spark: SparkSession,
    drop_dir: str,
    table_dir: str,
    checkpoint: str,
    archive_dir: str | None = None,
    quarantine_dir: str | None = None,
) -> StreamingQuery:
    """Land every new claims-shaped file of the drop folder, partitioned by its route and batch.

    Files whose name has no route do not enter the stream: they stay in the folder and are listed
    in the quarantine (``table_dir`` + ``_quarantine`` unless another is named). Lines without a
    readable row number go there too, with their file and text, from the batch that met them. A
    batch that runs again replaces what it wrote.
    """
    quarantine = quarantine_dir or f"{table_dir.rstrip('/')}_quarantine"
    list_unrouted(spark, drop_dir, quarantine)
    columns = catalog.CLAIMS_COLUMNS[: catalog.CLAIMS_SHORT_WIDTH]
    rows = landing_stream(spark, drop_dir, len(columns), archive_dir, routed_names())
    broken = F.col("row_no").isNull()  # a shorter or longer row is padded or cut, as in a batch load
    text = F.coalesce(BROKEN, F.concat_ws(",", *[f"_c{i}" for i in range(len(columns))]))

    def apply(batch: DataFrame, batch_id: int) -> None:
        seen = Observation()
        routed = batch.withColumn("route", route_of(F.col("source_file")))
        counted = routed.observe(seen, F.count_if(broken).alias("broken"))
        named = positional(counted.filter(~broken), columns, catalog.HEADER_ROWS["claims"], ("source_file", "route"))
        landed = as_text(drop_empty(named, columns)).withColumn("loaded_at", F.current_timestamp().cast("string"))
        replace_partitions(landed.withColumn("load_batch", F.lit(batch_id)), table_dir, "route", "load_batch")
        if seen.get["broken"]:
            lost = routed.filter(broken).select(
                "source_file", "route", text.alias("text"), F.lit("no row number").alias("reason")
            )
            replace_partitions(lost.withColumn("load_batch", F.lit(batch_id)), f"{quarantine}/rows", "load_batch")

    return (
        rows.writeStream.foreachBatch(apply)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def append_stream(rows: DataFrame, table_dir: str, checkpoint: str, *partition_by: str) -> StreamingQuery:
    """Append new rows to a Parquet table; its commit log keeps every batch exactly once."""
    writer = rows.writeStream.format("parquet").option("path", table_dir).option("checkpointLocation", checkpoint)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    return writer.trigger(availableNow=True).start()


def latest_per_date_stream(
    incoming: DataFrame, table_dir: str, checkpoint: str, order: list[str], date: str = "report_date"
) -> StreamingQuery:
    """Keep one row per date; a repeated or late report for a date replaces the stored one.

    A batch is compared with the stored rows of the dates it brings, and only those
    partitions are read and replaced, so its cost follows the batch and not the table.
    The greatest in ``order`` wins wherever batches begin and end, and running a batch
    again writes the same rows again.
    """

    def apply(batch: DataFrame, batch_id: int) -> None:
        rows = latest_wins(batch, [date], order)
        if has_files(batch.sparkSession, table_dir):
            stored = batch.sparkSession.read.schema(batch.schema).parquet(table_dir)
            stored = stored.join(rows.select(date), date, "left_semi")
            rows = latest_wins(rows.unionByName(stored.select(*rows.columns)), [date], order)
        write_slices(rows, table_dir, date)

    return (
        incoming.writeStream.foreachBatch(apply)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
