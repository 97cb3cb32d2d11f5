"""Exact deduplication with a heavy-hitter split."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from coverledger.llm.common import cut, id_hash, keep_rows

#: Counters of a Misra-Gries summary: at most so many texts, plus one, are treated as frequent.
COUNTERS = 1024


def normalised(text: str | Column) -> Column:
    """Each run of white space as one space; a single space needs no replacing. Null is empty."""
    column = F.col(text) if isinstance(text, str) else text
    return F.regexp_replace(
        F.coalesce(column, F.lit("")), r"[\x20\x09-\x0D]{2,}|[\x09-\x0D]", " "
    )


def digest(text: str | Column) -> Column:
    return F.unhex(F.sha2(normalised(text), 256))


def frequent(digests: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """Digests of more than 2/(counters+1) of the rows, among at most ``counters`` + 1 candidates.

    Each task keeps a Misra-Gries summary, which holds no more than ``counters`` entries besides
    one batch. Summaries add up: what they leave out of any digest's count is at most
    rows/(counters+1) in all.
    """

    def summary(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[bytes, int] = {}
        for batch in batches:
            found = pc.value_counts(batch.column(0))
            for value, n in zip(found.field(0).to_pylist(), found.field(1).to_pylist()):
                counts[value] = counts.get(value, 0) + n
            if len(counts) > counters:
                floor = sorted(counts.values(), reverse=True)[counters]
                counts = {k: n - floor for k, n in counts.items() if n > floor}
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())],
            ["digest", "n"],
        )

    rows = digests.count()
    return (
        digests.select("digest")
        .mapInArrow(summary, "digest binary, n long")
        .groupBy("digest")
        .agg(F.sum("n").alias("n"))
        .filter(F.col("n") >= max(2, rows // (counters + 1) + 1))
        .select("digest")
    )


def exact_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", counters: int = COUNTERS
) -> DataFrame:
    """Group documents whose normalised texts are identical; the row of the smallest id stays.

    Returns one row per input row: the id column, ``digest`` (SHA-256), ``keep_id``,
    ``group_size``, ``kept``. A null text is an empty one. Rows without an id come last in their
    group; if all are without, ``keep_id`` is null. Of repeated rows one is ``kept``. An empty
    table gives an empty result, and no other column is read.

    Frequent digests are found by Misra-Gries summaries, counted exactly, and their winners
    (at most ``counters`` + 1 rows) broadcast, so their rows are resolved where they are read.
    The other digests, none of which holds more than 2/(counters+1) of the rows, are grouped by
    a shuffle of the digests after partial aggregation.
    """
    digests = cut(
        docs.select(
            F.col(id_col).alias("id"),
            digest(text_col).alias("digest"),
            F.monotonically_increasing_id().alias("row"),
        ),
        "digests",
    )
    best = F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "row")).alias("best")
    size = F.count(F.lit(1)).alias("group_size")
    winners = cut(
        digests.join(F.broadcast(cut(frequent(digests, counters), "frequent")), "digest")
        .groupBy("digest")
        .agg(best, size),
        "winners",
    )
    hot = digests.join(F.broadcast(winners), "digest")
    rest = digests.join(F.broadcast(winners.select("digest")), "digest", "left_anti")
    cold = rest.join(rest.groupBy("digest").agg(best, size), "digest")
    return hot.unionByName(cold).select(
        F.col("id").alias(id_col),
        "digest",
        F.col("best.id").alias("keep_id"),
        "group_size",
        (F.col("row") == F.col("best.row")).alias("kept"),
    )


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents that :func:`exact_dedup` keeps, with all their columns."""
    kept = exact_dedup(docs, id_col, text_col).filter("kept")
    chosen = kept.select(id_hash(id_col).alias("_id_key"), F.col("digest").alias("_digest"))
    return keep_rows(docs, chosen, {"_id_key": id_hash(id_col), "_digest": digest(text_col)})
