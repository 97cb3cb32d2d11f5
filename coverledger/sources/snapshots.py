"""Table snapshots from an operational database: types, refresh decision, load stamps."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from coverledger.functions.cleaning import strip_to_null
from coverledger.sources.rejected import REJECTED, with_rejected

TEXT_TYPES = ("VARCHAR2", "CHAR", "NVARCHAR2", "CLOB")
MOMENT_TYPES = ("DATE", "TIMESTAMP")
STAMPS = T.StructType(
    [T.StructField("etl_uploaded_date", T.TimestampNTZType()), T.StructField("etl_updated_date", T.TimestampNTZType())]
)


# Whole numbers by digits: the first type that holds them all.
WHOLE = ((9, T.IntegerType()), (18, T.LongType()))


def number_type(precision: int | None, scale: int | None) -> T.DataType:
    """A whole number keeps all its digits; an unsized number has ten decimals."""
    if (precision, scale) == (None, None):
        return T.DecimalType(38, 10)
    exact = T.DecimalType(precision or 38, scale or 0)
    if scale != 0 or precision is None:
        return exact
    return next((kind for digits, kind in WHOLE if precision <= digits), exact)


def catalog_type(name: str, precision: int | None = None, scale: int | None = None) -> T.DataType:
    """Spark type of a source catalog type; what is neither a number nor a moment is text."""
    by_name = {"NUMBER": number_type(precision, scale)} | dict.fromkeys(MOMENT_TYPES, T.TimestampNTZType())
    return by_name.get(name.upper(), T.StringType())


def catalog_schema(columns: list[tuple[str, str, int | None, int | None, str]]) -> T.StructType:
    """Schema from catalog rows (name, type, precision, scale, nullable Y/N)."""
    return T.StructType([T.StructField(n.lower(), catalog_type(t, p, s), null == "Y") for n, t, p, s, null in columns])


def typed_snapshot(landed: DataFrame, columns: list[tuple[str, str, int | None, int | None, str]]) -> DataFrame:
    """Landed columns under their catalog names and types."""
    schema = catalog_schema(columns)
    return landed.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def typed_rows(landed: DataFrame, columns: list[tuple[str, str, int | None, int | None, str]]) -> DataFrame:
    """``typed_snapshot`` with the row's rejected values beside it: a value that its catalog type
    cannot hold is null there, and neither lost nor the end of the run."""
    have, schema = {c.lower(): c for c in landed.columns}, catalog_schema(columns)
    kinds = {f.name: f.dataType for f in schema.fields}
    missing = [c for c in kinds if c not in have]
    if missing:
        raise ValueError(f"columns of the catalog that the source lacks: {missing}")
    raw = landed.select(*[F.col(f"`{have[c]}`").alias(f"_raw_{c}") for c in kinds])
    typed = raw.select("*", *[F.col(f"_raw_{c}").try_cast(t).alias(c) for c, t in kinds.items()])
    texts = {c: strip_to_null(F.col(f"_raw_{c}")) for c, t in kinds.items() if not isinstance(t, T.StringType)}
    rows = with_rejected(typed, texts, {c: kinds[c].simpleString() for c in texts})
    return rows.select(*kinds, REJECTED)


def read_catalog(rows: DataFrame) -> dict[str, list[tuple[str, str, int | None, int | None, str]]]:
    """Columns per table from rows (table_name, column_name, data_type, precision, scale, nullable,
    position). The driver holds a row for each column of the source's tables, and nothing else."""
    out: dict[str, list] = {}
    for r in rows.orderBy("table_name", "position").collect():
        out.setdefault(r.table_name, []).append((r.column_name, r.data_type, r.precision, r.scale, r.nullable))
    return out


def split_column(columns: list[tuple[str, str, int | None, int | None, str]]) -> str | None:
    """The column by which a read is split: the first whole number that is never null, else the
    first such moment."""
    sure = [(n.lower(), catalog_type(t, p, s)) for n, t, p, s, null in columns if null != "Y"]
    whole = [n for n, t in sure if isinstance(t, (T.IntegerType, T.LongType)) or getattr(t, "scale", None) == 0]
    moments = [n for n, t in sure if isinstance(t, T.TimestampNTZType)]
    return next(iter([*whole, *moments]), None)


FACTS = "table_name string, has_modified boolean, modified timestamp_ntz, lower string, upper string"


def source_facts(tables: dict[str, tuple[DataFrame, str | None, str | None]]) -> DataFrame:
    """Per table its newest change and the bounds of its split column, all from one pass over each
    table and one job over all. ``tables``: rows, split column, change column."""

    def bound(pick, column: str | None):
        return (pick(F.col(column)) if column else F.lit(None)).cast("string")

    parts = [
        df.agg(
            (F.max(F.col(changed)) if changed else F.lit(None)).cast("timestamp_ntz").alias("modified"),
            bound(F.min, split).alias("lower"),
            bound(F.max, split).alias("upper"),
        ).select(F.lit(name).alias("table_name"), F.lit(changed is not None).alias("has_modified"), "modified", "lower", "upper")
        for name, (df, split, changed) in tables.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def facts_query(table: str, split: str | None, changed: str | None) -> str:
    """The same facts as a subquery that a database answers with one row."""
    bounds = (f"min({split})", f"max({split})") if split else ("NULL", "NULL")
    newest = f"max({changed})" if changed else "NULL"
    return f"(SELECT {newest} AS modified, {bounds[0]} AS lower_bound, {bounds[1]} AS upper_bound FROM {table}) facts"


def jdbc_options(
    url: str,
    table: str,
    split: str | None = None,
    bounds: tuple[object, object] | None = None,
    partitions: int = 64,
    fetch_size: int = 10000,
    one_task: bool = False,
    **options: str,
) -> dict[str, str]:
    """Options of a database read split by a column, so that no table passes through one task.

    A table without rows or without such a column is read whole only if ``one_task`` says so.
    """
    out = {"url": url, "dbtable": table, "fetchsize": str(fetch_size), **options}
    if split is None or bounds is None or None in bounds:
        if not one_task:
            raise ValueError(f"{table}: give a partition column and its bounds, or one_task=True")
        return out
    lower, upper = map(str, bounds)
    return out | {"partitionColumn": split, "lowerBound": lower, "upperBound": upper, "numPartitions": str(partitions)}


def read_snapshot(
    spark: SparkSession,
    url: str,
    table: str,
    partition_column: str | None = None,
    bounds: tuple[int, int] | None = None,
    partitions: int = 64,
    fetch_size: int = 10000,
    one_task: bool = False,
    **options: str,
) -> DataFrame:
    """JDBC read split by a numeric or date column, so no table passes through one task.

    A small table without such a column is read whole if ``one_task`` says so.
    """
    asked = jdbc_options(url, table, partition_column, bounds, partitions, fetch_size, one_task, **options)
    return spark.read.format("jdbc").options(**asked).load()


def modified_column(columns: list[str]) -> str | None:
    """First column whose name says it holds the last change."""
    return next((c for c in columns if "modified" in c.lower() or "updated" in c.lower()), None)


def watermarks(tables: dict[str, tuple[DataFrame, str | None]], name: str) -> DataFrame:
    """Newest value of a column per table, in one job; null where a table has no such column."""
    parts = [
        df.agg((F.max(F.col(c)) if c else F.max(F.lit(None))).cast("timestamp_ntz").alias(name)).select(
            F.lit(t).alias("table_name"), F.lit(c is not None).alias(f"has_{name}"), name
        )
        for t, (df, c) in tables.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def refresh_decision(
    target_exists: Column, target_loaded: Column, has_modified: Column, source_modified: Column, now: dt.datetime
) -> Column:
    """CREATED, RELOADED or SKIPPED.

    A table with a change column reloads when its newest change is after the last load;
    one without reloads when the last load is over 24 hours old.
    """
    newer = source_modified.isNotNull() & (target_loaded < source_modified)
    stale = target_loaded < F.lit(now - dt.timedelta(days=1)).cast("timestamp_ntz")
    reload = target_loaded.isNull() | F.when(has_modified, newer).otherwise(stale)
    return F.when(~target_exists, "CREATED").when(reload, "RELOADED").otherwise("SKIPPED")


def stamp_load(rows: DataFrame, now: dt.datetime, stored: DataFrame | None = None) -> DataFrame:
    """Add the load times. A reload keeps the table's first upload time."""
    moment = F.lit(now).cast("timestamp_ntz")
    first = moment if stored is None else stored.agg(F.min("etl_uploaded_date").cast("timestamp_ntz")).scalar()
    return rows.withColumns({"etl_uploaded_date": first, "etl_updated_date": moment})


def month_end_calendar(spark: SparkSession, start: dt.date, today: dt.date) -> DataFrame:
    """Month ends from the start month through the current month, for back-filling reports."""
    n_months = (today.year - start.year) * 12 + today.month - start.month + 1
    months = spark.range(max(n_months, 0)).select(F.add_months(F.lit(start), F.col("id").cast("int")).alias("_month"))
    return months.select(F.last_day("_month").alias("report_date"))
