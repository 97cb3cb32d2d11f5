"""Language-model scores from a log-frequency Bloom filter of word and word-pair counts."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from coverledger.llm.common import cut

#: Bits of the pair filter and of the word filter at most, segments of each, bits set per entry.
PAIR_BITS, WORD_BITS, SEGMENTS, PROBES = 1 << 28, 1 << 26, 256, 4
#: Bits that an entry gets on average at least; it bounds the share of false answers near 1 %.
BITS_PER_ENTRY = 10
#: Counts are kept as levels of these bases; the largest level that is probed.
PAIR_BASE, WORD_BASE, LEVELS = 1.5, 1.25, 120
#: Words whose counts every worker holds; the counts of the others are joined.
COMMON = 150_000
#: Text that a task counts, and words that it remembers, before it sends what it has.
COUNTED_BYTES, COUNTED_WORDS = 4 << 20, 250_000
#: Words that a worker remembers; rows that it takes up together.
REMEMBERED, TOGETHER = 100_000, 200
WEIGHTS = np.arange(0, 1, 0.05)
END = b" "  # no word has a blank in it

_A, _B, _C = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _B
    x = (x ^ (x >> np.uint64(27))) * _C
    return x ^ (x >> np.uint64(31))


def level_of(counts: np.ndarray, base: float) -> np.ndarray:
    return 1 + np.searchsorted(least_count(np.arange(2, LEVELS + 2), base), counts, side="right")


def least_count(levels: np.ndarray, base: float) -> np.ndarray:
    """The smallest count of each level; level 0 is a count of 0."""
    return np.where(levels > 0, np.ceil(np.power(base, np.maximum(levels, 1) - 1.0) - 1e-9), 0.0)


def most_count(levels: np.ndarray, base: float) -> np.ndarray:
    """The largest count of each level."""
    most = np.maximum(least_count(levels + 1, base) - 1, least_count(levels, base))
    return np.where(levels > 0, most, 0.0)


class Filter:
    """Which level a key's count has: a key of level q was entered once for each of 1 .. q."""

    def __init__(self, bits: np.ndarray, base: float):
        self.bits, self.base = bits, base  # one row of bytes per segment
        self.size = bits.shape[1] * 8
        self.least = np.ones(len(bits), np.int64)  # the least count that each segment holds

    @staticmethod
    def places(keys: np.ndarray, level: np.ndarray | int, size: int) -> Iterator[np.ndarray]:
        with np.errstate(over="ignore"):
            x = _mix(keys + np.asarray(level).astype(np.uint64) * _A)
            step = (_mix(x) >> np.uint64(20)) | np.uint64(1)
            for k in range(PROBES):
                yield ((x + np.uint64(k) * step) >> np.uint64(11)) % np.uint64(size)

    @staticmethod
    def segment(keys: np.ndarray) -> np.ndarray:
        return (keys % np.uint64(SEGMENTS)).astype(np.int64)

    def levels(self, keys: np.ndarray) -> np.ndarray:
        """Probe level after level as long as the key answers."""
        out = np.zeros(len(keys), np.int64)
        alive, row = np.arange(len(keys)), self.segment(keys)
        for level in range(1, LEVELS + 1):
            own, at = keys[alive], row[alive]
            hit = np.ones(len(alive), bool)
            for place in self.places(own, level, self.size):
                byte = self.bits[at, (place >> np.uint64(3)).astype(np.int64)]
                hit &= (byte >> (place & np.uint64(7)).astype(np.uint8)) & 1 == 1
            alive = alive[hit]
            if not len(alive):
                break
            out[alive] = level
        return out


def build_segment(keys: np.ndarray, counts: np.ndarray, base: float, size: int) -> tuple[bytes, int]:
    """The bits of a segment and the least count it holds.

    All keys enter if they fit; else the rarest counts stay out, from 1 upwards, until the rest
    has BITS_PER_ENTRY bits an entry. A key that is out is one that was never seen.
    """
    levels = level_of(counts, base)
    by_count = np.bincount(np.minimum(counts, 1 << 16), levels)
    above = by_count[::-1].cumsum()[::-1]
    fits = np.flatnonzero(above * BITS_PER_ENTRY <= size)
    least = int(fits[0]) if len(fits) else len(above)
    keep = counts >= max(least, 1)
    keys, levels = keys[keep], levels[keep]
    bits = np.zeros(size, bool)
    for level in range(1, int(levels.max(initial=0)) + 1):
        for place in Filter.places(keys[levels >= level], level, size):
            bits[place.astype(np.int64)] = True
    return np.packbits(bits, bitorder="little").tobytes(), max(least, 1)


def words_of(text: bytes) -> list[bytes]:
    """Lower-cased (A-Z) words of a UTF-8 text."""
    return text.lower().split()


def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same rows, TOGETHER at a time."""
    for batch in batches:
        for k in range(0, batch.num_rows, TOGETHER):
            yield batch.slice(k, TOGETHER)


class Hashes(dict):
    """Hashes of words; remembers a bounded number."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > REMEMBERED:
            self.clear()
        self[word] = found = xxhash.xxh64_intdigest(word, 42)
        return found


class _Numbers(dict):
    """Numbers the words it is asked for, and lists those that are new."""

    def __init__(self):
        self.new: list[bytes] = []

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        self.new.append(word)
        return number


def pair_keys(words: np.ndarray) -> np.ndarray:
    """Keys of the pairs of one text: its end stands before the first word as well. 48 bits."""
    with np.errstate(over="ignore"):
        before = np.concatenate((words[-1:], words[:-1]))
        return _mix(before * _A + words) >> np.uint64(16)


def _deltas(values: np.ndarray) -> bytes:
    """Sorted numbers as differences, byte by byte."""
    steps = np.diff(values, prepend=np.uint64(0))
    return zstandard.ZstdCompressor(level=1).compress(
        np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 8).T).tobytes()
    )


def _undeltas(load: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(load), np.uint8)
    return np.cumsum(np.ascontiguousarray(planes.reshape(8, -1).T).view(np.uint64).reshape(-1), dtype=np.uint64)


def _counted(texts: DataFrame) -> DataFrame:
    """By task: words (``word``, ``n``), and ``n`` packed pairs of a ``segment``: ``keys``, ``counts``."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, words, pairs, size = Hashes(), Counter(), [], 0

        def send() -> pa.RecordBatch:
            keys, counts = np.unique(np.concatenate(pairs), return_counts=True)
            segment = Filter.segment(keys)
            order = np.argsort(segment, kind="stable")
            keys, counts, segment = keys[order], counts[order], segment[order]
            parts = np.split(np.arange(len(keys)), np.flatnonzero(np.diff(segment)) + 1)
            pack = zstandard.ZstdCompressor(level=1).compress
            loads = [
                (int(segment[p[0]]), _deltas(keys[p]), pack(counts[p].astype("<u4").tobytes()))
                for p in parts
            ]
            n, m = len(words), len(loads)
            number, own, many = zip(*loads)
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([*words, *[None] * m], pa.binary()).cast(pa.string()),
                    pa.array([*words.values(), *map(len, parts)], pa.int64()),
                    pa.array([*[None] * n, *number], pa.int32()),
                    pa.array([*[None] * n, *own], pa.binary()),
                    pa.array([*[None] * n, *many], pa.binary()),
                ],
                ["word", "n", "segment", "keys", "counts"],
            )

        for batch in slices(batches):
            for text in batch.column(0).cast(pa.binary()).to_pylist():
                own = words_of(text)
                own.append(END)
                words.update(own)
                pairs.append(
                    pair_keys(np.fromiter(map(hashes.__getitem__, own), np.uint64, len(own)))
                )
                size += len(text)
                if size > COUNTED_BYTES or len(words) > COUNTED_WORDS:
                    yield send()
                    words, pairs, size = Counter(), [], 0
        if pairs:
            yield send()

    return texts.mapInArrow(scan, "word string, n long, segment int, keys binary, counts binary")


def _collect_filter(segments: DataFrame, bits: int, base: float) -> tuple[Filter, np.ndarray]:
    """The filter from its segments, and the least count of each. Always ``bits`` bits in all."""
    table = np.zeros((SEGMENTS, bits // SEGMENTS // 8), np.uint8)
    least = np.ones(SEGMENTS, np.int64)
    for row in segments.collect():
        table[row["segment"]] = np.frombuffer(row["bits"], np.uint8)
        least[row["segment"]] = row["least"]
    filter_ = Filter(table, base)
    filter_.least = least
    return filter_, least


def _pair_filter(counted: DataFrame, bits: int) -> tuple[Filter, np.ndarray]:
    def build(key: tuple, group: pa.Table) -> pa.Table:
        keys = np.concatenate([_undeltas(k) for k in group.column("keys").to_pylist()])
        unpack = zstandard.ZstdDecompressor().decompress
        counts = [np.frombuffer(unpack(c), "<u4") for c in group.column("counts").to_pylist()]
        keys, inverse = np.unique(keys, return_inverse=True)
        counts = np.bincount(inverse, np.concatenate(counts)).astype(np.int64)
        filled, least = build_segment(keys, counts, PAIR_BASE, bits // SEGMENTS)
        return pa.table({"segment": pa.array([key[0].as_py()], pa.int64()), "bits": [filled], "least": [least]})

    packed = counted.filter("segment is not null").select("segment", "keys", "counts")
    built = packed.groupBy("segment").applyInArrow(build, "segment long, bits binary, least long")
    return _collect_filter(built, bits, PAIR_BASE)


def _word_filter(words: DataFrame, bits: int) -> Filter:
    def build(key: tuple, group: pa.Table) -> pa.Table:
        keys = group.column("key").to_numpy().view(np.uint64)
        counts = group.column("n").to_numpy()
        filled, least = build_segment(keys, counts, WORD_BASE, bits // SEGMENTS)
        return pa.table({"segment": pa.array([key[0].as_py()], pa.int64()), "bits": [filled], "least": [least]})

    keyed = words.select(F.xxhash64("word").alias("key"), "n")
    segment = F.pmod(F.col("key"), F.lit(SEGMENTS)).cast("int")
    grouped = keyed.withColumn("segment", segment).groupBy("segment")
    return _collect_filter(grouped.applyInArrow(build, "segment long, bits binary, least long"), bits, WORD_BASE)[0]


@dataclass
class Model:
    """What every worker holds; its size is bounded by the parameters above."""

    tokens: int
    distinct: int
    common: dict[bytes, int]  # exact counts of the most frequent words
    words: Filter
    pairs: Filter
    least: np.ndarray  # the least pair count of each segment
    mass: float  # sum of the estimated counts of all words
    weights: np.ndarray  # of the pair model, by the level of the first word

    def alone(self, levels: np.ndarray, without: int = 0) -> np.ndarray:
        """Probability of words by their levels; the middle of a level stands for its counts."""
        middle = (least_count(levels, WORD_BASE) + most_count(levels, WORD_BASE)) / 2
        return (np.maximum(middle - without, 0) + 1) / (self.mass - without + self.distinct + 1)

    def parts(self, words: np.ndarray, level: np.ndarray, without: int = 0) -> tuple[np.ndarray, ...]:
        """For the tokens of texts (hashes and levels, each text ended by END): level of the word
        before, probability alone, and probability after the word before. ``without``: how much
        to take off all counts. The counts of pairs enter rounded down and those of first words
        rounded up, so that probabilities never add up to more than one."""
        alone = self.alone(level, without)
        ends = np.flatnonzero(words == np.uint64(xxhash.xxh64_intdigest(END, 42)))
        before = np.concatenate((words[:1], words[:-1]))
        context = np.concatenate((level[:1], level[:-1]))
        if len(ends):
            first = np.concatenate(([0], ends[:-1] + 1))
            before[first], context[first] = words[ends[0]], level[ends[0]]
        with np.errstate(over="ignore"):
            keys = _mix(before * _A + words) >> np.uint64(16)
        seen = least_count(self.pairs.levels(keys), PAIR_BASE) - without
        seen = np.where(seen >= self.least[Filter.segment(keys)], seen, 0)
        total = np.maximum(most_count(context, WORD_BASE) - without, 1)
        return context, alone, np.minimum(seen / total, 1.0)

    def logs(self, words: np.ndarray, level: np.ndarray) -> np.ndarray:
        """log10 probability of each token."""
        context, alone, after = self.parts(words, level)
        weight = self.weights[context]
        return np.log10((1 - weight) * alone + weight * after)


def held_out(id_col: str) -> Column:
    """Whether a document's checksum puts it in the fold that is not learned from."""
    name = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    return F.crc32(F.encode(name, "UTF-8")) % 7 == 2


def score(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    pair_bits: int = PAIR_BITS,
    word_bits: int = WORD_BITS,
) -> DataFrame:
    """Score every text by a model of the texts that are not held out.

    Returns one row per input row: the id column, ``held_out``, ``n_tokens``, ``n_known``,
    ``train_tokens``, ``base_score`` (add-one word model on exact counts) and ``score`` (log10
    probability under the pair model). A null or empty text is its end token alone. A row without
    an id counts as one with an empty id; repeated rows are scored each. If all are held out or
    the table is empty, no count is known and the base score is 0.

    There is one model at all sizes, that of ``routed.score``: words and pairs of all training
    texts go to segments, each with a filter of its own that has room for all of its pairs, and the
    weights come from all training texts. ``pair_bits`` and ``word_bits`` are taken for callers that
    give them and change nothing.
    """
    from coverledger.llm import routed

    rows = docs.select(
        F.col(id_col).alias("id"),
        held_out(id_col).alias("held_out"),
        F.coalesce(text_col, F.lit("")).alias("text"),
    )
    octets = rows.agg(F.sum(F.octet_length("text"))).first()[0]
    return routed.score(rows, octets or 0).withColumnRenamed("id", id_col)
