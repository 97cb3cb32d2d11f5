"""Landed files: positional layouts, cleaning, lineage, routing and headers.

Landing contract: headerless CSV or Parquet exports whose first column is ``row_no``
(position in the original sheet, from 1) followed by ``_c0``, ``_c1``, ... as text.
Spark has no file line order of its own, so the row number travels with the row.
"""

from __future__ import annotations

import itertools
import re
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from coverledger import catalog
from coverledger.functions.cleaning import clean_date, strip_to_null
from coverledger.functions.money import READ
from coverledger.sources.rejected import REJECTED, with_rejected


def landing_schema(width: int) -> T.StructType:
    fields = [T.StructField("row_no", T.LongType())]
    return T.StructType(fields + [T.StructField(f"_c{i}", T.StringType()) for i in range(width)])


def read_landing(spark: SparkSession, path: str | list[str], width: int) -> DataFrame:
    """Headerless CSV landing files with the source file name beside every row."""
    rows = spark.read.schema(landing_schema(width)).option("mode", "PERMISSIVE").option("multiLine", False).csv(path)
    return rows.select("*", F.col("_metadata.file_name").alias("source_file"))


def positional(raw: DataFrame, columns: list[str], header_rows: int, keep: tuple[str, ...] = ()) -> DataFrame:
    """Skip the header rows and name the columns by position, padding or trimming to the layout."""
    have = set(raw.columns)
    named = [
        (F.col(f"_c{i}") if f"_c{i}" in have else F.lit(None)).cast("string").alias(c) for i, c in enumerate(columns)
    ]
    return raw.filter(F.col("row_no") > header_rows).select(*named, *keep)


def project_positions(raw: DataFrame, positions: dict[int, str], columns: list[str], keep: tuple[str, ...] = ()) -> DataFrame:
    """Pick source positions into named fields; fields without a source are null.

    When two positions name one field, the later one wins.
    """
    have = set(raw.columns)
    source = {field: f"_c{i}" for i, field in positions.items()}
    picked = [
        (strip_to_null(F.col(source[c])) if source.get(c) in have else F.lit(None).cast("string")).alias(c)
        for c in columns
    ]
    return raw.select(*picked, *keep)


def drop_empty(df: DataFrame, columns: list[str]) -> DataFrame:
    """Drop rows that are null in every given column."""
    return df.na.drop("all", subset=columns)


def conform(df: DataFrame, columns: list[str], data_type: str = "string") -> DataFrame:
    """Project to a full layout; columns the table lacks become typed nulls."""
    have = set(df.columns)
    return df.select(*[F.col(c) if c in have else F.lit(None).cast(data_type).alias(c) for c in columns])


def with_lineage(df: DataFrame, sheet: str | None = None) -> DataFrame:
    """Add the source file (and sheet) and the load time as text."""
    name = F.col("_metadata.file_name")
    label = name if sheet is None else F.concat(name, F.lit(f" | {sheet}"))
    return df.select("*", label.alias("source_file"), iso_text(F.current_timestamp()).alias("loaded_at"))


def iso_text(c: Column) -> Column:
    return F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")


def column_class(name: str) -> str:
    """Spark type of a reinsurance column, by its name."""
    if name in catalog.REINSURANCE_DATE_COLUMNS:
        return "date"
    if name in catalog.REINSURANCE_INT_COLUMNS:
        return "int"
    if name in catalog.REINSURANCE_NUMERIC_COLUMNS:
        return READ
    return "string"


def clean_typed(text: Column, name: str) -> Column:
    """One stripped text value by the class of its column; a bad value is null.

    Numbers are read as a whole (no partial reads) and integers are truncated.
    """
    kind = column_class(name)
    if kind == "date":
        return clean_date(text)
    if kind == "int":
        number = text.try_cast("double")
        return F.when(number >= 0, F.floor(number)).otherwise(F.ceil(number)).try_cast("int")
    return text.try_cast(READ) if kind == READ else text


def clean_typed_table(df: DataFrame, columns: list[str], keep: tuple[str, ...] = ()) -> DataFrame:
    """Strip every value once, then read it by the class of its column."""
    stripped = df.select(*keep, *[strip_to_null(F.col(c)).alias(c) for c in columns])
    return stripped.select(*keep, *[clean_typed(F.col(c), c).alias(c) for c in columns])


def clean_typed_rows(df: DataFrame, columns: list[str], keep: tuple[str, ...] = ()) -> DataFrame:
    """``clean_typed_table`` with the row's rejected values beside it."""
    text = {c: f"_text_{c}" for c in columns if column_class(c) != "string"}
    stripped = df.select(*keep, *[strip_to_null(F.col(c)).alias(text.get(c, c)) for c in columns])
    typed = stripped.select("*", *[clean_typed(F.col(t), c).alias(c) for c, t in text.items()])
    rows = with_rejected(typed, {c: F.col(t) for c, t in text.items()}, {c: column_class(c) for c in text})
    return rows.select(*keep, *columns, REJECTED)


def clean_text_table(df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Everything to text: moments as ISO text, the rest trimmed, empty as null."""
    out = []
    for field in df.schema.fields:
        c = F.col(field.name)
        if field.name in keep:
            out.append(c)
        elif isinstance(field.dataType, T.DateType):
            out.append(F.date_format(c, "yyyy-MM-dd").alias(field.name))
        elif isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
            out.append(F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss").alias(field.name))
        else:
            out.append(strip_to_null(c).alias(field.name))
    return df.select(*out)


def route_of(file_name: Column) -> Column:
    """Target of a landed file by a word in its name; null means skip."""
    chain = None
    for word, target in catalog.FILE_ROUTES:
        test = F.lower(file_name).contains(word)
        chain = F.when(test, F.lit(target)) if chain is None else chain.when(test, F.lit(target))
    return chain


def split_by_route(rows: DataFrame, file_name: str = "source_file") -> dict[str, DataFrame]:
    """Rows per target table; each is a filter on one shared scan plan."""
    routed = rows.withColumn("_route", route_of(F.col(file_name)))
    return {t: routed.filter(F.col("_route") == t).drop("_route") for _, t in catalog.FILE_ROUTES}


# What a header is made of; everything else separates.
HEADER_PART = re.compile(r"[a-z0-9а-яё]+")


def _numbered(names: list[str]) -> list[str]:
    """Each name once: a repeat takes the next free number from 2 on."""
    last: dict[str, int] = {}
    given: dict[str, None] = {}
    for name in names:
        numbers = itertools.count(last.get(name, 0) + 1)
        last[name], own = next(
            (n, own) for n in numbers if (own := name if n == 1 else f"{name}_{n}") not in given
        )
        given[own] = None
    return list(given)


def harmonised_names(headers: list[str], words: dict[str, list[str]] | None = None) -> list[str]:
    """Header texts to column names.

    A header that contains one of a column's words takes that column, the first still free in
    the given order. Any other keeps its own parts, up to 30 characters. Repeats are numbered.
    """
    layout = catalog.CLAIMS_HEADER_WORDS if words is None else words
    index = [("".join(HEADER_PART.findall(w.lower())), w.lower(), column) for column, ws in layout.items() for w in ws]
    named: list[str] = []
    claimed: set[str] = set()
    for header in headers:
        parts = HEADER_PART.findall(header.lower())
        whole = "".join(parts)
        held = (c for w, sign, c in index if (w in whole if w else sign in header.lower()))  # signs as they are
        column = next((c for c in held if c not in claimed), None)
        claimed.add(column or "")
        named.append(column or "_".join(parts)[:30] or "col_unnamed")
    return _numbered(named)


def headed_frames(spark: SparkSession, path: str, words: dict[str, list[str]] | None = None) -> list[DataFrame]:
    """One frame a file of CSV files with headers, under harmonised names, with file and load time.

    Only the header line of a file is read here, to learn its columns.
    """
    frames = []
    for file in sorted(spark.read.text(path).inputFiles()):
        escaped = re.sub(r"([\[\]{}*?\\])", r"\\\1", unquote(file))
        rows = spark.read.option("header", True).csv(escaped)
        names = harmonised_names(rows.columns, words)
        lined = with_lineage(rows).toDF(*names, "source_file", "loaded_at")
        frames.append(lined.select(*[strip_to_null(F.col(c)).alias(c) for c in lined.columns]))
    return frames


def harmonised_union(frames: list[DataFrame], words: dict[str, list[str]] | None = None) -> DataFrame:
    """Frames with differing headers under one set of column names, all as text."""
    renamed = []
    for df in frames:
        named = df.toDF(*harmonised_names(df.columns, words))
        renamed.append(named.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in named.columns]))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), renamed)
