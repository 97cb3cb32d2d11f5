"""SimHash near-duplicates by an inverted index over positional bytes."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from coverledger.llm.common import cut, id_hash, keep_rows, scanned
from coverledger.llm.components import connected_components

#: Fingerprints link when they differ in so many bits at most.
MAX_BITS = 2
#: Words of a shingle.
SHINGLE = 3
#: Two differing bits touch two of eight bytes at most, so linked fingerprints share six.
LEAST_BYTES = 8 - MAX_BITS
#: Posting lists up to this size are compared pair by pair, longer ones by flipped bits.
LIST_PAIRS = 64


def fingerprint(text: bytes, words_per_shingle: int = SHINGLE) -> int:
    """The 64-bit SimHash of a UTF-8 text; bytes.lower changes A-Z only, bytes.split the words."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    hash_of = xxhash.xxh64_intdigest
    if len(words) <= words_per_shingle:
        return hash_of(joined, 42)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    last = words_per_shingle - 1
    spans = zip(starts[: len(words) - last].tolist(), ends[last:].tolist())
    hashes = np.fromiter((hash_of(joined[a:b], 42) for a, b in spans), "<u8", len(words) - last)
    ones = np.zeros(64, np.int64)
    for k in range(0, len(hashes), 65_536):
        part = hashes[k : k + 65_536].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (ones * 2 > len(hashes)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``id``, ``text_key`` (a hash of the text) and ``fp`` (the fingerprint as a signed long)."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(2).cast(pa.binary()).to_pylist()
            found = np.array([fingerprint(t) for t in texts], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(found)], ["id", "text_key", "fp"]
            )

    rows = docs.select(
        F.col(id_col).alias("id"),
        F.xxhash64(text_col).alias("text_key"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    )
    kind = rows.schema["id"].dataType.simpleString()
    return scanned(rows, scan, f"id {kind}, text_key long, fp long")


def _two_bytes(fp: Column, block: int) -> Column:
    return F.shiftrightunsigned(fp, 16 * block).bitwiseAND(F.lit(0xFFFF))


def _postings(fps: DataFrame) -> DataFrame:
    """``slot``, ``key``, ``fp``: six lists per fingerprint, keyed by four positional bytes."""
    fp = F.col("fp")
    lists = [
        F.struct(
            F.lit(slot).alias("slot"),
            (_two_bytes(fp, i) * 65_536 + _two_bytes(fp, j)).alias("key"),
        )
        for slot, (i, j) in enumerate(combinations(range(4), 2))
    ]
    return fps.select("fp", F.explode(F.array(*lists)).alias("at")).select("at.slot", "at.key", "fp")


def _shared_bytes(difference: Column) -> Column:
    same = [
        F.when(F.shiftrightunsigned(difference, 8 * p).bitwiseAND(F.lit(255)) == 0, 1).otherwise(0)
        for p in range(8)
    ]
    total = same[0]
    for one in same[1:]:
        total = total + one
    return total


def links(fps: DataFrame) -> DataFrame:
    """Pairs ``a``, ``b`` that connect every two distinct fingerprints within MAX_BITS bits.

    A posting list of one positional byte would hold 1/256 of all rows, and its pairs grow with
    their square. The count filter is therefore used in its prefix form: of the six bytes that
    linked fingerprints share at least, four stand in two of the four aligned byte pairs, so the
    lists are keyed by two byte pairs. Within a list the shared positional bytes of each pair are
    tallied, pairs of six or more are kept, and their differing bits are counted.

    A list with more than LIST_PAIRS fingerprints is not compared pair by pair. Its members
    agree in four bytes; two of them are within two bits exactly if some value is within one bit
    of both, so each member is filed under itself and its 32 one-bit neighbours, and those who
    meet (65 at most) are linked to the smallest of them.
    """
    postings = _postings(fps)
    sizes = cut(
        postings.groupBy("slot", "key").agg(F.count("*").alias("n")).filter("n > 1"), "lists"
    )
    listed = cut(postings.join(sizes, ["slot", "key"]), "postings")
    short = listed.filter(F.col("n") <= LIST_PAIRS)
    left, right = short.select("slot", "key", F.col("fp").alias("a")), short.select(
        "slot", "key", F.col("fp").alias("b")
    )
    apart = F.col("a").bitwiseXOR(F.col("b"))
    pairs = (
        left.join(right, ["slot", "key"])
        .filter(F.col("a") < F.col("b"))
        .filter(_shared_bytes(apart) >= LEAST_BYTES)
        .filter(F.bit_count(apart) <= MAX_BITS)
        .select("a", "b")
    )
    flips = F.create_map(
        *(
            x
            for slot, (i, j) in enumerate(combinations(range(4), 2))
            for x in (
                F.lit(slot),
                F.array(
                    F.lit(0).cast("long"),
                    *(
                        F.expr(f"shiftleft(1L, {bit})")
                        for block in set(range(4)) - {i, j}
                        for bit in range(16 * block, 16 * block + 16)
                    ),
                ),
            )
        )
    )
    met = (
        listed.filter(F.col("n") > LIST_PAIRS)
        .select("fp", F.explode(F.element_at(flips, F.col("slot"))).alias("flip"))
        .select("fp", F.col("fp").bitwiseXOR(F.col("flip")).alias("middle"))
        .distinct()
        .groupBy("middle")
        .agg(F.collect_list("fp").alias("fps"))
        .filter(F.size("fps") > 1)
        .select(F.array_min("fps").alias("a"), F.explode("fps").alias("b"))
    )
    return pairs.unionByName(met.filter(F.col("a") != F.col("b")))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The near-duplicate class of every document by SimHash over shingles of three words.

    Returns one row per input row: the id column, ``text_key`` (a hash of the text), ``fp``,
    ``component_id`` (the smallest id reachable over links of MAX_BITS differing bits, itself
    included) and ``first`` (the row, or its repeats, that stands for the class: smallest id, then
    smallest text_key; without any id in the class, smallest text_key). A null text or one
    without words has fingerprint zero and links like any other. Null ids are never smallest; a
    class without ids has a null component_id. Empty tables give an empty result.

    Equal fingerprints are one node, so copies cost nothing, and nothing is emitted for pairs
    inside a class but the links that connect it.
    """
    rows = cut(fingerprints(docs, id_col, text_col), "fingerprints")
    best = F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "text_key")).alias("best")
    fps = cut(rows.groupBy("fp").agg(best), "nodes")
    roots = connected_components(links(fps.select("fp")))
    rooted = fps.join(cut(roots.withColumnRenamed("node", "fp"), "roots"), "fp", "left")
    rooted = cut(rooted.select("fp", F.coalesce("root", "fp").alias("root"), "best"), "rooted")
    classes = cut(rooted.groupBy("root").agg(F.min("best").alias("top")), "classes")
    labels = cut(rooted.select("fp", "root").join(classes, "root").select("fp", "top"), "labels")
    first = F.col("id").eqNullSafe(F.col("top.id")) & (F.col("text_key") == F.col("top.text_key"))
    return rows.join(labels, "fp").select(
        F.col("id").alias(id_col),
        "text_key",
        "fp",
        F.col("top.id").alias("component_id"),
        first.alias("first"),
    )


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One document of each near-duplicate class, with all its columns."""
    chosen = near_duplicates(docs, id_col, text_col).filter("first")
    chosen = chosen.select(id_hash(id_col).alias("_id_key"), F.col("text_key").alias("_text_key"))
    keys = {"_id_key": id_hash(id_col), "_text_key": F.xxhash64(text_col)}
    return keep_rows(docs, chosen, keys)
