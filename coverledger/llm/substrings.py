"""Removal of repeated passages: every window of words that also starts earlier goes."""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coverledger.llm.common import cut, groups, tidy

#: Words of a window, and of the pieces whose least hash is a window's minimiser.
WINDOW, PIECE = 20, 3
#: A minimiser with over this share of all super-k-mers is hot; at most 2/HOT_SHARE of them are.
HOT_SHARE = 1e-4
#: Words of a partition on average, and parts of it that are dealt out one by one.
PARTITION_WORDS, SLOTS = 1_000_000, 4
#: Bytes of text among which a task merges equal super-k-mers before it sends them.
MERGED_BYTES = 8 << 20
#: Bytes of a word that are hashed eight at a time in all words at once; the rest of longer ones
#: is hashed alone.
LONG = 128
#: Masks that keep the first bytes of eight.
KEEP = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)
#: Stands for a null id: it comes after all others.
NO_ID = (1 << 63) - 1

TEXTS, WINDOWS, FLAGS = 0, 1, 2


class _Numbers(dict):
    """Numbers the words it is asked for."""

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number


def _mixed(values: np.ndarray) -> np.ndarray:
    """Every bit of a number spread over all 64; distinct numbers stay distinct."""
    values = values ^ (values >> np.uint64(33))
    values *= np.uint64(0xFF51AFD7ED558CCD)
    values ^= values >> np.uint64(33)
    values *= np.uint64(0xC4CEB9FE1A85EC53)
    values ^= values >> np.uint64(33)
    return values


class Words:
    """Words in a row, each followed by one blank, with the bytes where they start and end; eight
    more bytes follow the last blank."""

    def __init__(self, joined: bytes, starts: np.ndarray, ends: np.ndarray):
        self.joined, self.starts, self.ends = joined, starts, ends
        #: The eight bytes from each byte on.
        self.eights = np.ndarray((len(joined) - 7,), "<u8", joined, strides=(1,))
        self.hashes = self._hashes()

    def _hashes(self) -> np.ndarray:
        """Hashes of the words with their blank, which tells a word from its beginning."""
        size = self.ends - self.starts + 1
        total = _mixed(self.eights[self.starts] & KEEP[np.minimum(size, 8)])
        step, more = 8, np.flatnonzero(size > 8)
        while len(more) and step < LONG:
            left = size[more] - step
            part = self.eights[self.starts[more] + step] & KEEP[np.minimum(left, 8)]
            total[more] = _mixed(total[more] * np.uint64(0x9E3779B97F4A7C15) ^ part)
            step, more = step + 8, more[left > 8]
        for k in more.tolist():
            rest = self.joined[int(self.starts[k]) + step : int(self.ends[k])]
            total[k] ^= np.uint64(xxhash.xxh64_intdigest(rest))
        return total

    def same(self, a: np.ndarray, b: np.ndarray, n: np.ndarray | int) -> np.ndarray:
        """Whether the ``n`` words from ``a`` on are those from ``b`` on, byte by byte."""
        start, end = self.starts[a], self.ends[a + n - 1]
        other, size = self.starts[b], end - start
        equal = size == self.ends[b + n - 1] - other
        step, left = 0, np.flatnonzero(equal)
        while len(left) and step < 8 * LONG:
            rest = size[left] - step
            found = self.eights[start[left] + step] ^ self.eights[other[left] + step]
            good = (found & KEEP[np.minimum(rest, 8)]) == 0
            equal[left[~good]] = False
            step, left = step + 8, left[good & (rest > 8)]
        for k in left.tolist():
            i, j, m = int(start[k]) + step, int(other[k]) + step, int(size[k]) - step
            equal[k] = self.joined[i : i + m] == self.joined[j : j + m]
        return equal


def split(texts: list[bytes]) -> tuple[Words, np.ndarray]:
    """The words of all texts, and the number of words before each text."""
    found = np.frombuffer(b" ".join([*texts, b""]), np.uint8)
    other = found - np.uint8(9) < 5
    blank = (found == 32) | other
    after = np.ones(len(blank), bool)  # after a blank, or at the start
    after[1:] = blank[:-1]
    starts = np.flatnonzero(~blank & after)
    lengths = np.flatnonzero(blank & ~after) - starts
    sizes = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
    before = np.searchsorted(starts, np.cumsum(sizes) - sizes)
    ends = np.cumsum(lengths + 1) - 1
    if other.any():
        found = np.where(other, np.uint8(32), found)
    if (further := blank & after).any():
        found = found[~further]
    joined = found.tobytes() + bytes(8)
    return Words(joined, ends - lengths, ends), before


@dataclass
class Runs:
    """The super-k-mers of texts: runs of windows of one text that share their minimiser."""

    text: np.ndarray  # which text it is of
    first: np.ndarray  # first window, counted over all texts, number of windows and minimiser
    count: np.ndarray
    least: np.ndarray


def super_kmers(words: Words, before: np.ndarray, window: int) -> Runs:
    own = words.hashes
    n = len(own) - window + 1
    if n < 1:
        none = np.zeros(0, np.int64)
        return Runs(none, none, none, none.astype(np.uint64))
    piece = min(PIECE, window)
    mixed = np.zeros(len(own) - piece + 1, np.uint64)
    for k in range(piece):
        mixed *= np.uint64(0x9E3779B97F4A7C15)
        mixed += own[k : k + len(mixed)]
    mixed ^= mixed >> np.uint64(29)
    mixed *= np.uint64(0xBF58476D1CE4E5B9)
    mixed ^= mixed >> np.uint64(32)
    least, width, wide = mixed, 1, window - piece + 1
    while width < wide:  # minima over twice the width, until the window is covered
        step = min(width, wide - width)
        least = np.minimum(least[:-step], least[step:])
        width += step
    text = np.repeat(np.arange(len(before)), np.diff(before, append=len(own)))
    whole = text[:n] == text[window - 1 :]  # windows that lie in one text
    new = ~whole
    new[0] = True
    new[1:] |= (least[1:] != least[:-1]) | (text[1:n] != text[: n - 1])
    first = np.flatnonzero(new)
    count = np.diff(first, append=n)
    chosen = whole[first]
    first = first[chosen]
    return Runs(text[first], first, count[chosen], least[first])


def _rolled(words: np.ndarray, at: np.ndarray, n: np.ndarray | int, factor: int) -> np.ndarray:
    """A polynomial hash of the ``n`` numbers from each place on, as a difference of sums."""
    power = np.full(len(words) + 1, factor, np.uint64)
    power[0] = 1
    power = np.multiply.accumulate(power)
    power[1:] = np.cumsum(words * power[:-1])
    power[0] = 0
    total = power[at + n] - power[at]
    power = np.full(len(words) + 1, pow(factor, -1, 1 << 64), np.uint64)
    power[0] = 1
    return _mixed(total * np.multiply.accumulate(power)[at])


def _flags(ids: np.ndarray, keys: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, ...]:
    """Windows as ranges of consecutive starts in one text: id, key, first start, count."""
    order = np.lexsort((starts, keys, ids))
    ids, keys, starts = ids[order], keys[order], starts[order]
    new = np.ones(len(ids), bool)
    new[1:] = (ids[1:] != ids[:-1]) | (keys[1:] != keys[:-1]) | (starts[1:] != starts[:-1] + 1)
    at = np.flatnonzero(new)
    return ids[at], keys[at], starts[at], np.diff(at, append=len(ids))


def _repeats(group: np.ndarray, ids: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Which rows, in the order of (group, id, start), come after the first of their group."""
    new = np.ones(len(group), bool)
    new[1:] = group[1:] != group[:-1]
    head = np.flatnonzero(new)[np.cumsum(new) - 1]
    return (ids != ids[head]) | (starts != starts[head])


class _Sender:
    """Collects a task's texts and packs their super-k-mers by slot."""

    def __init__(self, slots: int, hot: np.ndarray, window: int):
        self.slots, self.hot, self.window = slots, hot, window
        self.reset()

    def reset(self) -> None:
        self.size = 0
        self.docs: list[int] = []
        self.keys: list[int] = []
        self.texts: list[bytes] = []

    def add(self, doc: int, key: int, text: bytes) -> None:
        self.size += len(text)
        self.docs.append(doc)
        self.keys.append(key)
        self.texts.append(text)

    def rows(self) -> Iterator[tuple[int, int, bytes]]:
        docs, keys = np.array(self.docs, np.int64), np.array(self.keys, np.int64)
        words, before = split(self.texts)
        self.reset()
        runs = super_kmers(words, before, self.window)
        is_hot = np.zeros(len(runs.least), bool)
        if len(self.hot):
            at = np.searchsorted(self.hot, runs.least)
            is_hot = self.hot[np.minimum(at, len(self.hot) - 1)] == runs.least
        doc, key, start = docs[runs.text], keys[runs.text], runs.first - before[runs.text]
        flags: list[np.ndarray] = []

        cold = np.flatnonzero(~is_hot)
        sent, late = _merged(words, runs, cold, (doc, key, start), self.window)
        if len(late):
            flags.append(np.stack([c[late] for c in (doc, key, start, runs.count)], 1))
        slot = (runs.least[sent] % np.uint64(self.slots)).astype(np.int64)
        order = np.argsort(slot, kind="stable")
        sent, slot = sent[order], slot[order]
        numbers = np.stack([c[sent] for c in (doc, key, start, runs.count)], 1)
        begin = words.starts[runs.first[sent]].tolist()
        end = (words.ends[runs.first[sent] + runs.count[sent] + self.window - 2] + 1).tolist()
        edges = [0, *(np.flatnonzero(np.diff(slot)) + 1).tolist(), len(slot)]
        pack = zstandard.ZstdCompressor(level=2).compress
        for a, b in zip(edges, edges[1:]):
            if a < b:
                texts = [words.joined[x:y] for x, y in zip(begin[a:b], end[a:b])]
                load = pack(_planes(numbers[a:b])), pack(b"".join(texts))
                yield TEXTS, int(slot[a]), pickle.dumps(load)

        hot = np.flatnonzero(is_hot)
        if len(hot):
            count = runs.count[hot]
            run = np.repeat(hot, count)
            nth = np.arange(len(run)) - np.repeat(np.cumsum(count) - count, count)
            one, two = (
                _rolled(words.hashes, runs.first[run] + nth, self.window, factor)
                for factor in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
            )
            ids, keys, at = doc[run], key[run], start[run] + nth
            order = np.lexsort((at, ids, two, one))
            one, two, ids, keys, at = (c[order] for c in (one, two, ids, keys, at))
            new = np.ones(len(one), bool)
            new[1:] = (one[1:] != one[:-1]) | (two[1:] != two[:-1])
            late = _repeats(np.cumsum(new), ids, at)
            flags.append(np.stack(_flags(ids[late], keys[late], at[late]), 1))
            one, two, ids, keys, at = (c[~late] for c in (one, two, ids, keys, at))
            slots = (one % np.uint64(self.slots)).astype(np.int64)
            order = np.argsort(slots, kind="stable")
            for part in np.split(order, np.flatnonzero(np.diff(slots[order])) + 1):
                yield WINDOWS, int(slots[part[0]]), pickle.dumps(
                    tuple(c[part] for c in (one, two, ids, keys, at))
                )
        if flags:
            load = np.concatenate(flags)
            yield FLAGS, xxhash.xxh32_intdigest(load[:1].tobytes()) % self.slots, pickle.dumps(load)


def _merged(
    words: Words, runs: Runs, chosen: np.ndarray, places: tuple[np.ndarray, ...], window: int
) -> tuple[np.ndarray, np.ndarray]:
    """Of the chosen runs, one of each sequence of words, and those that come after it.

    The one is the first by id and start. Runs at the same id and start of other texts are its
    equals and are kept too; those of copies of its row are left out, as they have its flags.
    """
    doc, key, start = places
    n = runs.count[chosen] + window - 1
    hashes = _rolled(words.hashes, runs.first[chosen], n, 0x9E3779B97F4A7C15)
    order = np.argsort(hashes)
    equal = hashes[order[1:]] == hashes[order[:-1]]
    if not equal.any():
        return chosen, chosen[:0]
    several = order[np.append(equal, False) | np.append(False, equal)]
    alone = np.ones(len(chosen), bool)
    alone[several] = False
    hashes, several = hashes[several], chosen[several]
    order = np.lexsort((key[several], start[several], doc[several], hashes))
    hashes, several = hashes[order], several[order]
    new = np.ones(len(several), bool)
    new[1:] = hashes[1:] != hashes[:-1]
    head = several[np.flatnonzero(new)[np.cumsum(new) - 1]]
    n = runs.count[several] + window - 1
    same = runs.count[several] == runs.count[head]
    at = np.flatnonzero(same)
    same[at] = words.same(runs.first[several[at]], runs.first[head[at]], n[at])
    late = same & ((doc[several] != doc[head]) | (start[several] != start[head]))
    copy = np.zeros(len(several), bool)
    copy[1:] = (several[1:] != head[1:]) & same[1:] & same[:-1] & ~late[1:] & ~late[:-1]
    copy[1:] &= key[several[1:]] == key[several[:-1]]
    return np.concatenate([chosen[alone], several[~late & ~copy]]), several[late]


def _planes(numbers: np.ndarray) -> bytes:
    """The first bytes of all rows, then the second ones and so on: most are zeros and pack well."""
    return numbers.view(np.uint8).reshape(len(numbers), -1).T.tobytes()


def _from_planes(planes: bytes) -> np.ndarray:
    """The rows of four numbers that ``_planes`` took apart."""
    found = np.frombuffer(planes, np.uint8).reshape(4 * 8, -1)
    return np.ascontiguousarray(found.T).view(np.int64)


def _text_windows(blobs: list[tuple], window: int) -> tuple[np.ndarray, ...]:
    """Repeated windows among packed super-k-mers: sorted by a hash, then compared by bytes."""
    unpack = zstandard.ZstdDecompressor().decompress
    words = split([unpack(packed)[:-1] for _, packed in blobs])[0]
    numbers = np.concatenate([_from_planes(unpack(packed)) for packed, _ in blobs])
    ids, keys, firsts, count = np.ascontiguousarray(numbers.T)
    total = count + window - 1
    run = np.repeat(np.arange(len(count)), count)
    nth = np.arange(len(run)) - np.repeat(np.cumsum(count) - count, count)
    at = (np.cumsum(total) - total)[run] + nth
    hashes = _rolled(words.hashes, at, window, 0x9E3779B97F4A7C15)
    order = np.argsort(hashes)
    hashes = hashes[order]
    equal = hashes[1:] == hashes[:-1]
    chosen = np.append(equal, False) | np.append(False, equal)
    group, order = hashes[chosen], order[chosen]
    if not len(group):
        none = np.zeros(0, np.int64)
        return none, none, none
    run, nth, at = run[order], nth[order], at[order]
    doc, key, start = ids[run], keys[run], firsts[run] + nth
    order = np.lexsort((start, doc, group))
    group, doc, key, start, at = (c[order] for c in (group, doc, key, start, at))
    pairs = np.flatnonzero(group[1:] == group[:-1])
    if not words.same(at[pairs + 1], at[pairs], window).all():  # other words under one hash
        known, ends = _Numbers(), words.ends[at + window - 1].tolist()
        group = np.array(
            [known[words.joined[a:b]] for a, b in zip(words.starts[at].tolist(), ends)], np.int64
        )
        order = np.lexsort((start, doc, group))
        group, doc, key, start = (c[order] for c in (group, doc, key, start))
    late = _repeats(group, doc, start)
    return doc[late], key[late], start[late]


def _hash_windows(blobs: list[tuple]) -> tuple[np.ndarray, ...]:
    one, two, ids, keys, at = (np.concatenate(c) for c in zip(*blobs))
    order = np.lexsort((at, ids, two, one))
    one, two, ids, keys, at = (c[order] for c in (one, two, ids, keys, at))
    new = np.ones(len(one), bool)
    new[1:] = (one[1:] != one[:-1]) | (two[1:] != two[:-1])
    late = _repeats(np.cumsum(new), ids, at)
    return ids[late], keys[late], at[late]


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(
        F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("doc"),
        F.xxhash64(text_col).alias("key"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
        F.col(id_col).cast("long").alias("id"),
    )


def hot_minimisers(keyed: DataFrame, window: int) -> tuple[np.ndarray, int]:
    """The minimisers of over HOT_SHARE of all super-k-mers, and the number of all words.

    Each task reports those that hold over half that share of its own, so what is left out adds
    up to less than half the share; at most 2/HOT_SHARE minimisers come back.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n_words = 0
        values, counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        for batch in batches:
            found = [values]
            texts = batch.column(0).cast(pa.binary()).to_pylist()
            for a, b in groups(np.fromiter(map(len, texts), np.int64, len(texts)), MERGED_BYTES):
                words, before = split(texts[a:b])
                n = np.diff(before, append=len(words.hashes))
                n_words += int(n[n >= window].sum())
                found.append(super_kmers(words, before, window).least)
            both = np.concatenate(found)
            weights = np.concatenate([counts, np.ones(len(both) - len(values), np.int64)])
            values, inverse = np.unique(both, return_inverse=True)
            counts = np.bincount(inverse, weights, minlength=len(values)).astype(np.int64)
        total = int(counts.sum())
        keep = counts > total * HOT_SHARE / 2
        rows = [None, None, *values[keep].view(np.int64).tolist()]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(rows, pa.int64()),
                pa.array([n_words, total, *counts[keep].tolist()], pa.int64()),
                pa.array([0, 1] + [2] * int(keep.sum()), pa.int32()),
            ],
            ["least", "n", "kind"],
        )

    found = cut(
        keyed.select("text")
        .mapInArrow(tidy(scan), "least long, n long, kind int")
        .groupBy("kind", "least")
        .agg(F.sum("n").alias("n")),
        "minimisers",
    )
    sums = {r["kind"]: r["n"] for r in found.filter("kind < 2").collect()}
    floor = sums.get(1, 0) * HOT_SHARE / 2
    rows = found.filter(F.col("kind") == 2).filter(F.col("n") > max(floor, 8)).collect()
    hot = np.sort(np.array([r["least"] for r in rows], np.int64).view(np.uint64))
    return hot, sums.get(0, 0)


def repeated_windows(keyed: DataFrame, window: int = WINDOW) -> DataFrame:
    """Windows that also start earlier, as ranges: ``doc``, ``key``, ``start``, ``n``."""
    spark = keyed.sparkSession
    hot, words = hot_minimisers(keyed, window)
    parts = max(
        int(spark.conf.get("spark.sql.shuffle.partitions")), words // PARTITION_WORDS + 1
    )
    slots = SLOTS * parts

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sender = _Sender(slots, hot, window)

        def packed() -> pa.RecordBatch:
            found = list(sender.rows()) if sender.size else []
            kinds, slot, load = zip(*found) if found else ((), (), ())
            return pa.RecordBatch.from_arrays(
                [pa.array(kinds, pa.int32()), pa.array(slot, pa.int32()), pa.array(load, pa.binary())],
                ["kind", "slot", "load"],
            )

        for batch in batches:
            docs, keys = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for doc, key, text in zip(docs, keys, batch.column(2).cast(pa.binary()).to_pylist()):
                if len(text) >= 2 * window - 1:
                    sender.add(doc, key, text)
                if sender.size > MERGED_BYTES:
                    yield packed()
        yield packed()

    def resolve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        loads: dict[tuple[int, int], list[bytes]] = {}
        for batch in batches:
            for kind, slot, load in zip(*(c.to_pylist() for c in batch.columns)):
                loads.setdefault((kind, slot), []).append(load)
        while loads:
            (kind, _), some = loads.popitem()
            blobs = [pickle.loads(load) for load in some]
            if kind == FLAGS:
                columns = tuple(np.concatenate(blobs).T)
            elif kind == TEXTS:
                columns = _flags(*_text_windows(blobs, window))
            else:
                columns = _flags(*_hash_windows(blobs))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in columns], ["doc", "key", "start", "n"]
            )

    sent = keyed.mapInArrow(tidy(send), "kind int, slot int, load binary")
    return sent.repartition(parts, "slot").mapInArrow(
        tidy(resolve), "doc long, key long, start long, n long"
    )


def remove_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW
) -> DataFrame:
    """Remove every word covered by a window of words that also starts earlier in the corpus.

    A window is ``window`` consecutive words of one document. Earlier is a smaller id, or the same
    id and an earlier start; windows are judged on the input. Ids are whole numbers; rows without
    one come last, beside the largest number there is, and are equals, and rows with the same id and start are equals too: none of
    them is earlier than the other. Returns one row per input row: the id column, ``n_words``,
    ``n_removed`` and ``kept_text`` (the kept words joined by one space). A null text has no
    words. Repeated rows and empty tables are no special case.

    Consecutive windows that share a minimiser travel as one packed string to the slot of the
    minimiser; equal strings of a task are merged first. The few minimisers that hold over
    HOT_SHARE of all strings would fill a slot alone: their windows travel one by one, as 128-bit
    hashes, to the slot of the hash. In each slot windows are sorted; of the packed ones, those of
    equal hashes are compared byte by byte.
    """
    keyed = _keyed(docs, id_col, text_col)
    found = cut(
        repeated_windows(keyed.drop("id"), window)
        .groupBy("doc", "key")
        .agg(F.collect_list(F.struct("start", "n")).alias("ranges")),
        "repeats",
    )

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            ranges = batch.column(2).to_pylist()
            for text, marks in zip(batch.column(1).cast(pa.binary()).to_pylist(), ranges):
                words = text.split()
                n = len(words)
                if marks:
                    steps = np.zeros(n + 1, np.int64)
                    for m in marks:
                        steps[m["start"]] += 1
                        steps[m["start"] + m["n"] + window - 1] -= 1
                    gone = np.cumsum(steps[:-1]) > 0
                    words = [words[k] for k in np.flatnonzero(~gone).tolist()]
                rows.append((n, n - len(words), b" ".join(words)))
            n, removed, kept = zip(*rows) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(n, pa.int64()),
                    pa.array(removed, pa.int64()),
                    pa.array(kept, pa.binary()).cast(pa.string()),
                ],
                ["id", "n_words", "n_removed", "kept_text"],
            )

    marked = keyed.join(found, ["doc", "key"], "left").select("id", "text", "ranges")
    out = marked.mapInArrow(keep, "id long, n_words long, n_removed long, kept_text string")
    return out.withColumnRenamed("id", id_col)
