"""Writing tables: replace, evolving append, and whole-slice replacement."""

from __future__ import annotations

import json
import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T


def as_text(df: DataFrame) -> DataFrame:
    """Landing tables hold text only."""
    return df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])


def append_columns(stored: DataFrame, incoming: DataFrame) -> DataFrame:
    """Append rows; columns missing on either side become null text."""
    return as_text(stored).unionByName(as_text(incoming), allowMissingColumns=True)


COLUMNS = "_columns-"


def stored_columns(spark: SparkSession, path: str) -> list[str] | None:
    """The columns of an evolving table, in the order in which they came; None if none are kept."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    names = [s.getPath().getName() for s in store.listStatus(place)] if store.exists(place) else []
    newest = max((n for n in names if n.startswith(COLUMNS)), default=None)
    if newest is None:
        return None
    stream = store.open(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{newest}"))
    try:
        return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def keep_columns(spark: SparkSession, path: str, columns: list[str]) -> None:
    """Store a longer column list beside the table; the longest has the greatest name."""
    path_of = spark._jvm.org.apache.hadoop.fs.Path
    store = path_of(path).getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    unseen, final = path_of(f"{path}/_{uuid.uuid4().hex}"), path_of(f"{path}/{COLUMNS}{len(columns):06d}")
    out = store.create(unseen)
    out.write(bytearray(json.dumps(columns).encode()))
    out.close()
    store.rename(unseen, final)


def write_landing(df: DataFrame, path: str, append: bool) -> None:
    """Replace the table, or append to it. New columns need no rewrite of older files.

    The list of all columns is kept beside the table. Before an append it gets the new ones, so
    that no reader finds files with columns that the list lacks; a load that then fails leaves
    columns that are null so far.
    """
    spark, text = df.sparkSession, as_text(df)
    before = stored_columns(spark, path) if append else None
    if append and before is None and has_files(spark, path):
        before = spark.read.option("mergeSchema", "true").parquet(path).columns  # a table from before lists
        keep_columns(spark, path, before)
    known = before or []
    columns = known + [c for c in text.columns if c not in known]
    if append and columns != known:
        keep_columns(spark, path, columns)
    text.write.mode("append" if append else "overwrite").parquet(path)
    if not append:
        keep_columns(spark, path, columns)


def read_landing_table(spark: SparkSession, path: str) -> DataFrame:
    """All columns ever appended; older files show nulls for newer columns.

    The stored column list is the schema, so no file's footer is read for it.
    """
    columns = stored_columns(spark, path)
    if columns is None:
        return spark.read.option("mergeSchema", "true").parquet(path)
    return spark.read.schema(T.StructType([T.StructField(c, T.StringType()) for c in columns])).parquet(path)


def write_batch(frames: list[DataFrame], path: str, append: bool = False) -> None:
    """A run's files in one write: replace the table (or append), files unioned by column name."""
    union = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [as_text(f) for f in frames])
    write_landing(union, path, append)


def write_slices(df: DataFrame, path: str, by: str) -> None:
    """Replace exactly the slices present in the rows and leave all others untouched.

    Files are gathered per slice with a rebalance, which splits a slice too large for
    one task. The new files take the place of the old ones when the job commits, so a
    failed run leaves the stored slices as they were.
    """
    replace_partitions(df.hint("rebalance", F.col(by)), path, by)


def write_snapshot(df: DataFrame, path: str, **metrics: Column) -> dict[str, int]:
    """Replace a whole table at commit, as one slice; a failed run leaves the old rows.

    The rows are computed once and counted as they are written, as are further metrics; returns
    the counts, the rows' under ``n``. An empty table has no slice to put in place of the old one,
    so it clears the folder.
    """
    rows, seen = df.withColumn("snapshot", F.lit("current")), Observation()
    replace_partitions(rows.observe(seen, F.count(F.lit(1)).alias("n"), *(m.alias(k) for k, m in metrics.items())), path, "snapshot")
    if not seen.get["n"]:
        none = df.sparkSession.createDataFrame([], rows.schema)
        none.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("snapshot").parquet(path)
    return seen.get


def has_files(spark: SparkSession, path: str) -> bool:
    """Whether a table has been written at the path."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    return store.exists(place)


def drop_slice(spark: SparkSession, path: str) -> None:
    """Remove one slice of a table."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(place, True)


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the tables stored under a folder."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    names = (s.getPath().getName() for s in store.listStatus(place))
    return sorted(n for n in names if not n.startswith(("_", ".")))


def replace_partitions(df: DataFrame, path: str, *by: str) -> None:
    """Put the rows in place of the partitions that they have, when the job commits."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)


def read_snapshot_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Columns of a stored table; the schema is given, since an empty table has no files."""
    return spark.read.schema(schema).parquet(path).select(*schema.fieldNames())
