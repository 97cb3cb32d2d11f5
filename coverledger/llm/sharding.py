"""Reproducible sharding: a Feistel permutation over global row numbers. DataFrame functions only."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from coverledger.llm.common import cut

ROUNDS = 4
#: Steps of a cycle walk. Fewer than sqrt(rows) + 1 positions lie outside, so up to 4096 rows the
#: walk cannot be longer, and above that a longer one has a chance below rows ** -31.
WALK = 64


def number_rows(rows: DataFrame, order: list[str]) -> tuple[DataFrame, int]:
    """Number the rows from 0 by ``order`` (nulls last); returns them with ``number``, and the count.

    Rows are range-partitioned and sorted; a row's number is its place in its partition plus the
    rows of all partitions before. The offsets are one row per partition, however many rows there
    are. Rows equal in all of ``order`` are interchangeable.
    """
    by = [F.col(c).asc_nulls_last() for c in order]
    placed = rows.repartitionByRange(*by).sortWithinPartitions(*by)
    placed = cut(placed.withColumn("_at", F.monotonically_increasing_id()), "ranges")
    part, place = F.shiftright("_at", 33), F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    counts = placed.groupBy(part.alias("_part")).agg(F.count("*").alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before")
    )
    numbered = (
        placed.withColumn("_part", part)
        .join(F.broadcast(offsets), "_part")
        .withColumn("number", F.col("_before") + place)
        .drop("_at", "_part", "_before")
    )
    return numbered, placed.count()


def permuted(number: Column, rows: int, seed: int) -> Column:
    """A permutation of 0 .. rows-1: an alternating Feistel network over a grid, cycle-walked.

    The grid has a x b >= rows cells, fewer than a of them too many; a number that lands there is
    sent through the network again until it lands below ``rows``.
    """
    a = max(1, math.isqrt(max(rows - 1, 0)) + 1)
    b = max(1, -(-rows // a))

    def network(x: Column) -> Column:
        state = F.struct(F.floor(x / b).cast("long").alias("l"), (x % b).alias("r"))

        def turn(s: Column, k: Column) -> Column:
            mixed = lambda half, size: F.pmod(F.xxhash64(F.lit(seed), k, half), F.lit(size))
            left = F.struct(((s["l"] + mixed(s["r"], a)) % a).alias("l"), s["r"].alias("r"))
            right = F.struct(s["l"].alias("l"), ((s["r"] + mixed(s["l"], b)) % b).alias("r"))
            return F.when(k % 2 == 0, left).otherwise(right)

        keys = F.array(*(F.lit(k) for k in range(ROUNDS)))
        return F.aggregate(keys, state, turn, lambda s: s["l"] * b + s["r"])

    walk = F.aggregate(
        F.sequence(F.lit(2), F.lit(WALK)),
        network(number),
        lambda x, _: F.when(x < rows, x).otherwise(network(x)),
    )
    return F.when(walk < rows, walk).otherwise(F.raise_error(F.lit("cycle walk not ended")))


def shard_rows(
    docs: DataFrame,
    shards: int,
    id_col: str = "doc_id",
    text_col: str = "text",
    seed: int = 42,
) -> DataFrame:
    """Deal the rows out to ``shards`` shards in a shuffled order that anyone can compute again.

    Returns one row per input row: the id column, ``size`` (UTF-8 bytes of the text, null: none,
    plus 8), ``text_crc32``, ``number`` (rank by id, checksum and size, nulls last), ``shard`` and
    ``slot``. The permuted number p gives shard p mod shards and slot p div shards, so counts
    differ by one at most and slots have no gaps. Repeated rows get numbers of their own.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    keys = docs.select(
        F.col(id_col).alias("id"),
        (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
    )
    numbered, rows = number_rows(keys, ["id", "text_crc32", "size"])
    place = permuted(F.col("number"), rows, seed)
    return numbered.withColumn("_place", place).select(
        F.col("id").alias(id_col),
        "size",
        "text_crc32",
        "number",
        (F.col("_place") % shards).cast("int").alias("shard"),
        F.floor(F.col("_place") / shards).cast("long").alias("slot"),
    )
