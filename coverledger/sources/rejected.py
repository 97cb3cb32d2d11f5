"""Values that a typed column cannot hold: kept beside the row, then in a side table.

A load or a stored model carries a column of the row's rejected values, which is null for almost
every row and so costs almost nothing. It is written with the rows, in the same pass, and the
number of rejected values is observed by that write. Only if there are any, the column alone is
read back to fill the side table: table, row key, column, text and reason.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from coverledger.sources.sinks import drop_slice, has_files, write_slices

REJECTED = "_rejected"
SIDE_SCHEMA = "table_name string, row_key string, column_name string, text string, reason string"


def reason_for(text: Column, kind: str) -> Column:
    """Why a text does not become a value of a type."""
    if kind in ("date", "timestamp_ntz"):
        return F.lit("not a date")
    fits = F.lit(f"does not fit {kind}")
    return F.when(text.rlike("[0-9]"), fits).otherwise(F.lit("no number"))


def with_rejected(df: DataFrame, texts: dict[str, Column], kinds: dict[str, str]) -> DataFrame:
    """Add the row's rejected values: columns whose text is not blank and whose value is null.

    ``texts`` gives the trimmed text of each typed column, ``kinds`` the types.
    """
    lost = {c: text.isNotNull() & F.col(c).isNull() for c, text in texts.items()}
    tests = [
        F.when(
            lost[c],
            F.struct(F.lit(c).alias("column_name"), text.alias("text"), reason_for(text, kinds[c]).alias("reason")),
        )
        for c, text in texts.items()
    ]
    # The array is made once, and only for rows that have something to put into it.
    found = F.array_compact(F.array(*tests))
    return df.withColumn(REJECTED, F.when(reduce(or_, lost.values(), F.lit(False)), found))


def rejected_count() -> Column:
    """How many values the rows have rejected; for the observation of a write."""
    return F.coalesce(F.sum(F.when(F.col(REJECTED).isNotNull(), F.size(REJECTED))), F.lit(0))


def side_rows(stored: DataFrame, table: str, key: list[str]) -> DataFrame:
    """A row for each rejected value of a stored table."""
    row_key = F.to_json(F.struct(*key)) if key else F.lit(None).cast("string")
    found = stored.filter(F.col(REJECTED).isNotNull())
    return found.select(row_key.alias("row_key"), F.explode(REJECTED).alias("v")).select(
        F.lit(table).alias("table_name"), "row_key", "v.column_name", "v.text", "v.reason"
    )


def keep_rejected(stored: DataFrame, side: str, table: str, key: list[str], observed: int) -> None:
    """Replace the table's slice of the side table by what the stored table has now.

    ``observed`` is the number of rejected values of the last write; without any, and without an
    earlier slice, nothing is read.
    """
    spark, slice_ = stored.sparkSession, f"{side}/table_name={table}"
    if not observed and not has_files(spark, slice_):
        return
    rows = side_rows(stored, table, key)
    if not observed and rows.isEmpty():
        drop_slice(spark, slice_)
    else:
        write_slices(rows, side, "table_name")


def read_rejected(spark: SparkSession, side: str) -> DataFrame:
    """The side table; empty if nothing was ever rejected."""
    if not has_files(spark, side):
        return spark.createDataFrame([], SIDE_SCHEMA)
    return spark.read.schema(SIDE_SCHEMA).parquet(side)
