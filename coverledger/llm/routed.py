"""Language-model scores of corpora whose counts no worker could hold: keys travel to the counts.

Texts are stored in chunks. The words and word pairs of a chunk go, packed, to segments whose
number follows the text; a segment counts its keys, and its answers go back to the chunk. Nothing
is left out, and a worker holds one segment or one chunk at a time.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coverledger.llm import scoring
from coverledger.llm.common import cut

#: Text of a chunk; it ends with the text that takes it over.
CHUNK_BYTES = 6 << 20
#: Segments at least, and text of a segment at most: a word and its blank take two bytes or more,
#: so a segment is sent under SEGMENT_BYTES / 2 keys on average, about a sixth in plain prose.
SEGMENTS, SEGMENT_BYTES = 256, 32 << 20
PAIRS, WORDS, TOTALS = 0, 1, 2
#: Bits of the keys by kind.
KEY_BITS = {PAIRS: 48, WORDS: 64}
#: Levels of the word before, the word and the pair in one number.
STEP = 128


class Segment(scoring.Filter):
    """A filter of one segment, of its own size."""

    @staticmethod
    def segment(keys: np.ndarray) -> np.ndarray:
        return np.zeros(len(keys), np.int64)


def segments_for(octets: int) -> int:
    return max(SEGMENTS, 1 << max(-(-octets // SEGMENT_BYTES) - 1, 0).bit_length())


def _pack(values: np.ndarray) -> bytes:
    """Unsigned numbers, byte plane after byte plane, in the least width that holds them."""
    top = int(values.max(initial=0))
    width = next(w for w in (1, 2, 4, 8) if top < 1 << 8 * w)
    planes = np.ascontiguousarray(values.astype(f"<u{width}").view(np.uint8).reshape(-1, width).T)
    return bytes([width]) + zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def _unpack(load: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(load[1:]), np.uint8)
    return np.ascontiguousarray(planes.reshape(load[0], -1).T).view(f"<u{load[0]}").reshape(-1).astype(np.int64)


def _chunks(rows: DataFrame) -> DataFrame:
    """``chunk``, ``ids``, ``held``, ``sizes``, ``texts``: the rows, many in one."""
    kind = rows.schema["id"].dataType.simpleString()

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk, size, ids, held, texts = TaskContext.get().partitionId() << 32, 0, [], [], []

        def send() -> pa.RecordBatch:
            own = pa.chunked_array(ids).combine_chunks()
            ends = pa.array([0, len(texts)], pa.int32())
            sizes = _pack(np.fromiter(map(len, texts), np.int64, len(texts)))
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([chunk], pa.int64()),
                    pa.ListArray.from_arrays(ends, own),
                    pa.array([held], pa.list_(pa.bool_())),
                    pa.array([sizes], pa.binary()),
                    pa.array([zstandard.ZstdCompressor(level=3).compress(b"".join(texts))], pa.binary()),
                ],
                ["chunk", "ids", "held", "sizes", "texts"],
            )

        for batch in batches:
            begin = 0
            for k, text in enumerate(batch.column(2)):
                texts.append(text.as_buffer().to_pybytes())
                size += len(texts[-1])
                if size > CHUNK_BYTES or k == batch.num_rows - 1:
                    ids.append(batch.column(0).slice(begin, k + 1 - begin))
                    held += batch.column(1).slice(begin, k + 1 - begin).to_pylist()
                    begin = k + 1
                if size > CHUNK_BYTES:
                    yield send()
                    chunk, size, ids, held, texts = chunk + 1, 0, [], [], []
        if texts:
            yield send()

    return rows.mapInArrow(
        scan, f"chunk long, ids array<{kind}>, held array<boolean>, sizes binary, texts binary"
    )


class Chunk:
    """The tokens of a chunk, its distinct words and pairs, and how often these are learned from."""

    def __init__(self, sizes: bytes, texts: bytes, held: list[bool]):
        ends = np.cumsum(_unpack(sizes)).tolist()
        text = zstandard.ZstdDecompressor().decompress(texts)
        numbers = scoring._Numbers()
        number_of, own, at = numbers.__getitem__, [], 0
        end = np.array([number_of(scoring.END)])
        for upto in ends:
            words = scoring.words_of(text[at:upto])
            own += [np.fromiter(map(number_of, words), np.int64, len(words)), end]
            at = upto
        self.lengths = np.array([len(w) + 1 for w in own[::2]])
        tokens = np.concatenate(own)
        hash_of = scoring.xxhash.xxh64_intdigest
        hashes = np.array([hash_of(w, 42) for w in numbers.new], np.uint64)
        words, rank = np.unique(hashes, return_inverse=True)
        self.tokens = rank[tokens]
        self.before = np.concatenate((self.tokens[:1], self.tokens[:-1]))
        self.before[np.cumsum(self.lengths) - self.lengths] = rank[0]
        with np.errstate(over="ignore"):
            keys = scoring._mix(words[self.before] * scoring._A + words[self.tokens]) >> np.uint64(16)
        pairs, self.pair = np.unique(keys, return_inverse=True)
        learned = np.repeat(~np.array(held, bool), self.lengths)
        self.keys = {PAIRS: pairs, WORDS: words}
        self.counts = {
            PAIRS: np.bincount(self.pair[learned], minlength=len(pairs)),
            WORDS: np.bincount(self.tokens[learned], minlength=len(words)),
        }


def _sent(chunks: DataFrame, segments: int) -> DataFrame:
    """``chunk``, ``kind``, ``segment``, ``keys``, ``counts``: the keys of a chunk in a segment."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.select(["chunk", "held", "sizes", "texts"]).to_pylist():
                chunk, out = Chunk(row["sizes"], row["texts"], row["held"]), []
                for kind, keys in chunk.keys.items():
                    shift = np.uint64(KEY_BITS[kind] - segments.bit_length() + 1)
                    own = (keys >> shift).astype(np.int64)
                    for part in np.split(np.arange(len(keys)), np.flatnonzero(np.diff(own)) + 1):
                        load = scoring._deltas(keys[part]), _pack(chunk.counts[kind][part])
                        out.append((row["chunk"], kind, int(own[part[0]]), *load))
                kinds = (pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary())
                names = ["chunk", "kind", "segment", "keys", "counts"]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)

    return chunks.select("chunk", "held", "sizes", "texts").mapInArrow(
        scan, "chunk long, kind int, segment int, keys binary, counts binary"
    )


def _answer(key: tuple, group: pa.Table) -> pa.Table:
    """The answers of a segment: exact counts of words, levels of pairs; and its totals."""
    kind, segment = (k.as_py() for k in key)
    keys = [scoring._undeltas(k) for k in group.column("keys").to_pylist()]
    counts = np.concatenate([_unpack(c) for c in group.column("counts").to_pylist()])
    cuts = np.cumsum([len(k) for k in keys])[:-1]
    distinct, inverse = np.unique(np.concatenate(keys), return_inverse=True)
    found = np.bincount(inverse, counts).astype(np.int64)
    tokens, seen, mass = int(found.sum()), int(np.count_nonzero(found)), 0.0
    if kind == WORDS:
        mass = float(middle(scoring.level_of(found[found > 0], scoring.WORD_BASE)).sum())
    else:
        own = found > 0
        entries = int(scoring.level_of(found[own], scoring.PAIR_BASE).sum())
        size = max(1 << 10, -(-entries * scoring.BITS_PER_ENTRY * 3 // 16) * 8)
        bits, least = scoring.build_segment(distinct[own], found[own], scoring.PAIR_BASE, size)
        if least > 1:
            raise ValueError("a filter segment has no room for its entries")
        found = Segment(np.frombuffer(bits, np.uint8)[None, :], scoring.PAIR_BASE).levels(distinct)
    loads = [_pack(v) for v in np.split(found[inverse], cuts)]
    n = len(loads)
    return pa.table(
        {
            "chunk": pa.array([*group.column("chunk").to_pylist(), None], pa.int64()),
            "kind": pa.array([kind] * n + [TOTALS], pa.int32()),
            "segment": pa.array([segment] * (n + 1), pa.int32()),
            "answers": pa.array([*loads, None], pa.binary()),
            "of": pa.array([None] * n + [kind], pa.int32()),
            "tokens": pa.array([None] * n + [tokens], pa.int64()),
            "seen": pa.array([None] * n + [seen], pa.int64()),
            "mass": pa.array([None] * n + [mass], pa.float64()),
        }
    )


ANSWERS = "chunk long, kind int, segment int, answers binary, of int, tokens long, seen long, mass double"


def middle(levels: np.ndarray) -> np.ndarray:
    return (scoring.least_count(levels, scoring.WORD_BASE) + scoring.most_count(levels, scoring.WORD_BASE)) / 2


def _coded(chunks: DataFrame, answers: DataFrame) -> DataFrame:
    """By chunk: per text ``n``, ``known`` and ``logs`` (sum of log10 of count + 1), and ``codes``."""
    kind = chunks.schema["ids"].dataType.simpleString()

    def read(key: tuple, own: pa.Table, back: pa.Table) -> pa.Table:
        row = own.select(["held", "sizes", "texts"]).to_pylist()[0]
        chunk = Chunk(row["sizes"], row["texts"], row["held"])
        found: dict[int, list] = {PAIRS: [], WORDS: []}
        for b in sorted(back.select(["kind", "segment", "answers"]).to_pylist(), key=lambda b: b["segment"]):
            found[b["kind"]].append(_unpack(b["answers"]))
        count, pair = np.concatenate(found[WORDS]), np.concatenate(found[PAIRS])
        if len(count) != len(chunk.keys[WORDS]) or len(pair) != len(chunk.keys[PAIRS]):
            raise ValueError("answers do not match the keys sent")
        level = np.where(count > 0, scoring.level_of(count, scoring.WORD_BASE), 0)
        codes = (level[chunk.before] * STEP + level[chunk.tokens]) * STEP + pair[chunk.pair]
        starts = np.cumsum(chunk.lengths) - chunk.lengths
        known = np.add.reduceat((count > 0)[chunk.tokens].astype(np.int64), starts)
        logs = np.add.reduceat(np.log10(count + 1)[chunk.tokens], starts)
        return pa.table(
            {
                "ids": own.column("ids"),
                "held": own.column("held"),
                "n": pa.array([chunk.lengths], pa.list_(pa.int64())),
                "known": pa.array([known], pa.list_(pa.int64())),
                "logs": pa.array([logs], pa.list_(pa.float64())),
                "codes": pa.array([_pack(codes)], pa.binary()),
            }
        )

    return (
        chunks.groupBy("chunk")
        .cogroup(answers.filter(F.col("kind") != TOTALS).select("chunk", "kind", "segment", "answers").groupBy("chunk"))
        .applyInArrow(
            read, f"ids {kind}, held array<boolean>, n array<long>, known array<long>, logs array<double>, codes binary"
        )
    )


def _parts(codes: np.ndarray, mass: float, distinct: int, without: int) -> tuple[np.ndarray, ...]:
    """Level of the word before, probability alone, and after the word before; see Model.parts."""
    context, word, pair = codes // STEP**2, codes // STEP % STEP, codes % STEP
    alone = (np.maximum(middle(word) - without, 0) + 1) / (mass - without + distinct + 1)
    seen = np.maximum(scoring.least_count(pair, scoring.PAIR_BASE) - without, 0)
    # A pair that a false answer gives to a word never learned counts for nothing.
    total = scoring.most_count(context, scoring.WORD_BASE) - without
    after = np.where(total > 0, np.minimum(seen / np.maximum(total, 1), 1.0), 0.0)
    return context, alone, after


def _weights(coded: DataFrame, mass: float, distinct: int) -> np.ndarray:
    """For each level of the first word, the weight of the pair model that makes all training
    texts likeliest, each token scored as if it had not been counted. What reaches the driver is
    a count for each combination of three levels."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                learned = np.repeat(~np.array(row["held"], bool), row["n"])
                code, n = np.unique(_unpack(row["codes"])[learned], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(code), pa.array(n, pa.int64())], ["code", "n"])

    rows = coded.select("held", "n", "codes").mapInArrow(scan, "code long, n long")
    rows = rows.groupBy("code").agg(F.sum("n").alias("n")).collect()
    codes = np.array([r["code"] for r in rows], np.int64)
    times = np.array([r["n"] for r in rows], np.int64)
    context, alone, after = _parts(codes, mass, distinct, 1)
    sums = np.zeros((scoring.LEVELS + 1, len(scoring.WEIGHTS)))
    for k, w in enumerate(scoring.WEIGHTS):
        np.add.at(sums[:, k], context, times * np.log10((1 - w) * alone + w * after))
    return np.where(np.isin(np.arange(len(sums)), context), scoring.WEIGHTS[sums.argmax(axis=1)], 0.0)


def score(rows: DataFrame, octets: int) -> DataFrame:
    """``rows`` has ``id``, ``held_out`` and ``text`` (no null); the columns of scoring.score, id as ``id``.

    Words and pairs are known by hashes of 64 and 48 bits. Words have exact counts; pairs have the
    levels that the filter of their segment gives, which has 1.5 times BITS_PER_ENTRY bits
    for each entry and holds every pair.
    """
    chunks = cut(_chunks(rows.select("id", "held_out", F.encode("text", "UTF-8").alias("text"))), "chunks")
    sent = _sent(chunks, segments_for(octets))
    answers = cut(sent.groupBy("kind", "segment").applyInArrow(_answer, ANSWERS), "answers")
    sums = answers.filter((F.col("kind") == TOTALS) & (F.col("of") == WORDS))
    sums = sums.agg(F.sum("tokens"), F.sum("seen"), F.sum("mass")).first()
    tokens, distinct, mass = sums[0] or 0, sums[1] or 0, sums[2] or 0.0
    coded = cut(_coded(chunks, answers), "coded")
    weights = _weights(coded, mass, distinct)
    kind = rows.schema["id"].dataType.simpleString()

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1)
                n = row.column(2).flatten().to_numpy()
                codes, number = np.unique(_unpack(row.column(5)[0].as_py()), return_inverse=True)
                context, alone, after = _parts(codes, mass, distinct, 0)
                weight = weights[context]
                logs = np.log10((1 - weight) * alone + weight * after)[number]
                base = row.column(4).flatten().to_numpy() - n * np.log10(tokens + distinct + 1)
                yield pa.RecordBatch.from_arrays(
                    [
                        row.column(0).flatten(),
                        row.column(1).flatten(),
                        pa.array(n),
                        row.column(3).flatten(),
                        pa.array(np.full(len(n), tokens, np.int64)),
                        pa.array(base),
                        pa.array(np.add.reduceat(logs, np.cumsum(n) - n)),
                    ],
                    ["id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
                )

    return coded.mapInArrow(
        scan,
        f"id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double",
    )
