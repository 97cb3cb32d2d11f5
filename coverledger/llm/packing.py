"""Best-fit packing of token sequences by patterns fitted with non-negative least squares."""

from __future__ import annotations

import functools
import json
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from pathlib import Path
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from coverledger.llm import bpe
from coverledger.llm.common import cut, groups, scanned

#: Tokens of a sequence, and the id that ends a document.
LENGTH, END = 1024, 2
#: Documents of a pattern at most.
DEPTH = 3
#: Ways to round the repeat counts: a share of them, and the fraction from which to round up. What
#: is left over packs better the more there is of it; the plan with the fewest sequences is taken.
ROUNDINGS = ((1.0, 0.5), (1.0, 1.0), (0.9, 1.0), (0.7, 1.0), (0.5, 1.0))
#: All that for fits in which a length's error weighs by these powers of the length.
POWERS = (2, 1)


def _byte_ranks(path: str) -> dict[bytes, int]:
    """The vocabulary of a byte-level tokenizer file as byte strings with their ids.

    Such files write a byte as itself where it is a visible Latin-1 character, and the others in
    order from code point 256 on.
    """
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in visible]
    byte_of = {chr(b): b for b in visible} | {chr(256 + k): b for k, b in enumerate(hidden)}
    model = json.loads(Path(path).read_text(encoding="utf-8"))
    special = {t["content"] for t in model["added_tokens"]}
    return {
        bytes(byte_of[c] for c in token): rank
        for token, rank in model["model"]["vocab"].items()
        if token not in special
    }


class Encoder:
    """Ids of texts by a byte-level BPE tokenizer file, as its own library gives them.

    A special token's string in a text is that token, and the parts around it are encoded each by
    itself. The classes of code points are those of the file's library.
    """

    def __init__(self, path: str):
        self.bpe = bpe.Encoder(_byte_ranks(path), "tokenizers")
        added = json.loads(Path(path).read_text(encoding="utf-8"))["added_tokens"]
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in added):
            raise ValueError("special tokens that take white space or whole words")
        self.special = {t["content"]: t["id"] for t in added}
        longest = sorted(self.special, key=len, reverse=True)
        self.cut = re.compile("(" + "|".join(map(re.escape, longest)) + ")") if longest else None

    def encode_all(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of every text, as unsigned 32-bit numbers."""
        parts = [self.cut.split(t) if self.cut else [t] for t in texts]
        ids, _, bounds = self.bpe.encode([p for own in parts for p in own[::2]])
        ids, out, at = ids.astype("<u4"), [], 0
        for own in parts:
            n = (len(own) + 1) // 2
            if n == 1:
                out.append(ids[bounds[at] : bounds[at + 1]])
            else:
                found = [np.array([self.special.get(p, 0)], "<u4") for p in own]
                found[::2] = (ids[bounds[k] : bounds[k + 1]] for k in range(at, at + n))
                out.append(np.concatenate(found))
            at += n
        return out


@functools.lru_cache(maxsize=2)
def _encoder(path: str) -> Encoder:
    return Encoder(path)


def pieces_of(n: int, length: int) -> list[tuple[int, int]]:
    """``start``, ``length`` of the pieces of ``n`` ids: only the first is shorter than ``length``."""
    first = (n - 1) % length + 1
    return [(0, first)] + [(s, length) for s in range(first, n, length)]


def tokenized(
    docs: DataFrame,
    tokenizer: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    length: int = LENGTH,
    end: int = END,
    keep_ids: bool = False,
) -> DataFrame:
    """``id``, ``piece``, ``start``, ``length``, ``ids_crc32`` (and ``ids``) of every document."""
    last = np.array([end], "<u4").tobytes()

    def parts(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            texts = batch.column(1).to_pylist()
            sizes = np.fromiter(map(len, texts), np.int64, len(texts))
            yield from ((batch, texts, a, b) for a, b in groups(sizes, bpe.WINDOW))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(tokenizer)
        for batch, texts, a, b in parts(batches):
            number = {t: k for k, t in enumerate(dict.fromkeys(texts[a:b]))}
            encoded = encoder.encode_all(list(number))  # a text that repeats is encoded once
            rows: list[tuple] = []
            for at in range(a, b):
                ids = encoded[number[texts[at]]].tobytes() + last
                for k, (start, n) in enumerate(pieces_of(len(ids) // 4, length)):
                    own = ids[4 * start : 4 * (start + n)]
                    rows.append((at, k, start, n, crc32(own), own if keep_ids else None))
            at, piece, start, n, crc, own = zip(*rows) if rows else ((),) * 6
            columns = [
                batch.column(0).take(pa.array(at, pa.int64())),
                pa.array(piece, pa.int32()),
                pa.array(start, pa.int64()),
                pa.array(n, pa.int64()),
                pa.array(crc, pa.int64()),
            ] + ([pa.array(own, pa.binary())] if keep_ids else [])
            names = ["id", "piece", "start", "length", "ids_crc32", "ids"][: len(columns)]
            yield pa.RecordBatch.from_arrays(columns, names)

    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(text_col, F.lit("")).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    schema = f"id {kind}, piece int, start long, length long, ids_crc32 long"
    return scanned(rows, scan, schema + (", ids binary" if keep_ids else ""))


def patterns(length: int, present: np.ndarray, depth: int = DEPTH) -> np.ndarray:
    """All ways to fill ``length`` with 2 to ``depth`` of the lengths present; 0 for no document."""
    has = np.zeros(length + 1, bool)
    has[present] = True
    found = []
    if depth >= 2:
        a = np.arange(length // 2, length)
        a = a[has[a] & has[length - a]]
        found.append(np.stack([a, length - a, np.zeros_like(a)], 1))
    if depth >= 3:
        for first in np.flatnonzero(has[:length]):
            rest = length - first
            b = np.arange((rest + 1) // 2, min(first, rest - 1) + 1)
            b = b[has[b] & has[rest - b]]
            found.append(np.stack([np.full_like(b, first), b, rest - b], 1))
    return np.concatenate(found) if found else np.zeros((0, 3), int)


def nnls(
    patterns_: np.ndarray, wanted: np.ndarray, power: int, enter: int = 128
) -> dict[int, float]:
    """Repeat counts x >= 0 that minimise |A x - wanted|, A having a column per pattern.

    A length's error weighs by a power of it: short pieces left over fill gaps, long ones do not.

    An active-set method after Lawson and Hanson: patterns of the largest gradient enter, several
    without a common length at once, the least-squares problem over all active ones is solved,
    and those with negative counts leave. It ends when no gradient is left or the squared error
    no longer falls by a hundredth.
    """
    length = len(wanted) - 1
    weight = (np.arange(length + 1) / length) ** power
    active: list[int] = []
    x = np.zeros(0)
    rest, best = wanted.copy(), np.inf
    fit: dict[int, float] = {}
    scale = max(1.0, float(wanted.max(initial=0)))
    for _ in range(400):
        gain = (rest * weight)[patterns_].sum(axis=1)
        if active:
            gain[active] = -np.inf
        used, new = np.zeros(length + 1, bool), []
        for k in np.argsort(-gain, kind="stable")[: 8 * enter]:
            if gain[k] <= 1e-6 * scale or len(new) == enter:
                break
            own = patterns_[k][patterns_[k] > 0]
            if not used[own].any():
                used[own] = True
                new.append(int(k))
        if not new:
            break
        active += new
        x = np.concatenate([x, np.zeros(len(new))])
        while active:
            columns = np.zeros((length + 1, len(active)))
            for place in range(patterns_.shape[1]):
                np.add.at(columns, (patterns_[active, place], np.arange(len(active))), 1)
            weighted = columns.T * weight
            gram = weighted @ columns + 1e-9 * np.eye(len(active))
            y = np.linalg.solve(gram, weighted @ wanted)
            if (y > 1e-9).all():
                x = y
                break
            stay = y > 1e-9
            active = [k for k, s in zip(active, stay) if s]
            x = y[stay]
        fitted = np.zeros(length + 1)
        for k, n in zip(active, x):
            for own in patterns_[k][patterns_[k] > 0]:
                fitted[own] += n
        rest = wanted - fitted
        error = float((weight * rest**2).sum())
        if error > best * 0.99:
            break
        best, fit = error, dict(zip(active, x))
    return fit


def best_fit(counts: np.ndarray, length: int) -> list[tuple[tuple[int, ...], int]]:
    """Best-fit decreasing over a histogram: packed length lists and how often each is repeated.

    Equal sequences are packed together, so the work depends on the number of lengths.
    """
    open_: dict[int, list[list]] = defaultdict(list)  # free tokens: [lengths, repeats]
    closed: list[tuple[tuple[int, ...], int]] = []
    for size in range(length, 0, -1):
        left = int(counts[size])
        while left:
            room = min((r for r, groups in open_.items() if groups and r >= size), default=None)
            if room is None:
                per = length // size
                full, some = divmod(left, per)
                for repeats, n in ((full, per), (1 if some else 0, some)):
                    if repeats:
                        open_[length - n * size].append([(size,) * n, repeats])
                left = 0
            else:
                group = open_[room][-1]
                take = min(left, group[1])
                group[1] -= take
                if not group[1]:
                    open_[room].pop()
                open_[room - size].append([group[0] + (size,), take])
                left -= take
    for groups in open_.values():
        closed += [(tuple(lengths), n) for lengths, n in groups if n]
    return closed


def plan(histogram: dict[int, int], length: int = LENGTH, depth: int = DEPTH) -> list[tuple]:
    """Sequences for a histogram of lengths: (lengths, repeats), all pieces used exactly once."""
    counts = np.zeros(length + 1, np.int64)
    for size, n in histogram.items():
        counts[size] = n
    packed: Counter = Counter()
    if counts[length]:
        packed[(length,)] = int(counts[length])
        counts[length] = 0
    ways = patterns(length, np.flatnonzero(counts), depth)
    fits = [nnls(ways, counts.astype(float), power) for power in POWERS] if len(ways) else [{}]
    found = [_rounded(ways, fit, counts, share, up, length) for fit in fits for share, up in ROUNDINGS]
    return list((packed + min(found, key=lambda p: p.total())).items())


def _rounded(
    ways: np.ndarray,
    fit: dict[int, float],
    counts: np.ndarray,
    share: float,
    up: float,
    length: int,
) -> Counter:
    """The patterns by rounded counts, the rest by best fit."""
    left, packed = counts.copy(), Counter()
    for k, x in sorted(fit.items(), key=lambda kv: -kv[1]):
        own = Counter(int(s) for s in ways[k] if s)
        n = min(int(np.floor(x * share + 1 - up)), *(int(left[s]) // m for s, m in own.items()))
        if n > 0:
            packed[tuple(int(s) for s in ways[k] if s)] += n
            for s, m in own.items():
                left[s] -= n * m
    for lengths, n in best_fit(left, length):
        packed[lengths] += n
    return packed


def ranges(planned: list[tuple]) -> list[tuple[int, int, int, int, int]]:
    """(length, first rank, repeats, first sequence, offset): which ranks of a length go where."""
    ranks: Counter = Counter()
    rows, sequence = [], 0
    for lengths, repeats in planned:
        offset = 0
        for size in lengths:
            rows.append((size, ranks[size], repeats, sequence, offset))
            ranks[size] += repeats
            offset += size
        sequence += repeats
    return rows


def pack(pieces: DataFrame, length: int = LENGTH, depth: int = DEPTH) -> DataFrame:
    """Pack rows with a ``length`` (1 to ``length``): adds ``sequence_id`` and ``offset``.

    The driver sees the histogram of lengths only (``length`` numbers), however many rows there
    are. It enumerates the patterns of up to ``depth`` documents that fill a sequence, fits their
    repeat counts by non-negative least squares, rounds them, and packs what is left by best fit.
    A row finds its place by its rank among the rows of its length: ranks are numbers within a
    part of the table, plus the counts of the parts before. Rows come back in any order.
    """
    spark = pieces.sparkSession
    parted = pieces.withColumn("_at", F.monotonically_increasing_id())
    parted = cut(parted.withColumn("_part", F.shiftright("_at", 33)), "pieces")
    counts = cut(parted.groupBy("length", "_part").agg(F.count("*").alias("_n")), "lengths")
    histogram = {
        r["length"]: r["n"]
        for r in counts.groupBy("length").agg(F.sum("_n").alias("n")).collect()
    }
    places = spark.createDataFrame(
        ranges(plan(histogram, length, depth)),
        "_length long, _first long, _repeats long, _sequence long, _offset long",
    )
    earlier = Window.partitionBy("length").orderBy("_part")
    earlier = earlier.rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.withColumn("_start", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
    own = Window.partitionBy("length", "_part").orderBy("_at")
    ranked = (
        parted.withColumn("_own", F.row_number().over(own) - 1)
        .join(starts.drop("_n"), ["length", "_part"])
        .withColumn("_rank", F.col("_start") + F.col("_own"))
    )
    inside = (F.col("_rank") >= F.col("_first")) & (
        F.col("_rank") < F.col("_first") + F.col("_repeats")
    )
    found = ranked.join(F.broadcast(places), (F.col("length") == F.col("_length")) & inside)
    return found.select(
        *pieces.columns,
        (F.col("_sequence") + F.col("_rank") - F.col("_first")).alias("sequence_id"),
        F.col("_offset").alias("offset"),
    )


def pack_documents(
    docs: DataFrame,
    tokenizer: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    length: int = LENGTH,
    end: int = END,
    depth: int = DEPTH,
    keep_ids: bool = False,
) -> DataFrame:
    """Tokenize, cut and pack documents.

    Returns one row per piece: the id column, ``piece``, ``start``, ``length``, ``ids_crc32``,
    ``sequence_id``, ``offset``, and ``ids`` (little-endian unsigned 32-bit) if asked for. A null
    or empty text is a document of the end id alone. Rows without an id, repeated rows and ties
    are packed like any other. An empty table gives an empty result.
    """
    pieces = tokenized(docs, tokenizer, id_col, text_col, length, end, keep_ids)
    return pack(pieces, length, depth).withColumnRenamed("id", id_col)


def sequences(packed: DataFrame) -> DataFrame:
    """The packed sequences, ``sequence_id`` and ``ids``, from pieces packed with their ids."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    joined = F.aggregate(parts, F.lit(b""), lambda out, p: F.concat(out, p["ids"]))
    return packed.groupBy("sequence_id").agg(joined.alias("ids"))
