"""Alignment of two tokenizers: each distinct text once, pair counts weighted by multiplicity."""

from __future__ import annotations

import functools
import re
from array import array
from collections.abc import Callable, Iterator
from itertools import accumulate, chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from coverledger.llm.common import cut, groups, tidy
from coverledger.llm.packing import _byte_ranks

#: Bytes of texts that are aligned together and share one list of id pairs.
CHUNK = 6 << 20
#: Parts of a text that a worker remembers in each of two generations, and their longest.
REMEMBERED, SHORT = 100_000, 48
#: Below this code point both libraries of byte-level patterns agree on every class.
SETTLED = "ɐ"

# A blank beside other white space, or at the end: there a text is not cut.
_UNEVEN = re.compile(r"\s | \s| \Z|\A\s")


def parts_of(text: str) -> list[str]:
    """A blank and the text, cut before single blanks between other characters than white space.

    Each part is given without its leading blank. Neither tokenizer joins anything across such a
    cut: the byte-level pattern starts a match there whatever came before, and no piece of the
    other has a blank after another character.
    """
    found = text.split(" ")
    if not _UNEVEN.search(text):
        return found
    out = found[:1]
    for before, part in zip(found, found[1:]):
        if before and part and not before[-1].isspace() and not part[0].isspace():
            out.append(part)
        else:
            out[-1] += " " + part
    return out


class Aligned:
    """What one part of a text gives: counts, its groups as text and its linked id pairs."""

    __slots__ = ("a", "b", "groups", "text", "pairs")

    def __init__(self, a_ids, b_ids, a_ends, b_ends):
        i = j = first_i = first_j = 0
        pairs, cuts = [], []
        while i < len(a_ids):
            pairs.append(a_ids[i] << 32 | b_ids[j])
            if a_ends[i] == b_ends[j]:
                i, j = i + 1, j + 1
                own = ",".join(map(str, a_ids[first_i:i])), ",".join(map(str, b_ids[first_j:j]))
                cuts.append("|".join(own))
                first_i, first_j = i, j
            elif a_ends[i] < b_ends[j]:
                i += 1
            else:
                j += 1
        self.a, self.b, self.groups = len(a_ids), len(b_ids), len(cuts)
        self.text, self.pairs = ";".join(cuts), array("q", pairs).tobytes()


class Tokenizers:
    """Both tokenizers, and the alignment of parts of texts, the latest ones remembered."""

    def __init__(self, a_file: str, b_file: str):
        import public_tokenizers
        import sentencepiece
        import tiktoken
        from tokenizers import Tokenizer

        ranks = _byte_ranks(a_file)
        self.a_bytes = {rank: token for token, rank in ranks.items()}
        self.quick = tiktoken.Encoding(
            "a", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
        )
        self.whole = Tokenizer.from_file(a_file)
        self.whole.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_file)
        pieces = [self.b.id_to_piece(k) for k in range(self.b.get_piece_size())]
        assert not any(re.search("[^▁]▁", p) for p in pieces), "a piece spans a cut"
        self.b_bytes = [
            bytes([int(p[3:5], 16)]) if self.b.is_byte(k) else p.replace("▁", " ").encode()
            for k, p in enumerate(pieces)
        ]
        self.young: dict[str, Aligned | None] = {}
        self.old: dict[str, Aligned | None] = {}

    def _a_ids(self, part: str) -> list[int]:
        if max(part, default="") < SETTLED:
            return self.quick.encode_ordinary(" " + part)
        return self.whole.encode(" " + part, add_special_tokens=False).ids

    def _align(self, part: str, b_ids: list[int]) -> Aligned | None:
        """None if the tokens' bytes are not the part's."""
        a_ids, held = self._a_ids(part), (" " + part).encode()
        b_tokens = [self.b_bytes[k] for k in b_ids]
        if b"".join(b_tokens) != held or b"".join([self.a_bytes[k] for k in a_ids]) != held:
            return None
        a_ends = list(accumulate([len(self.a_bytes[k]) for k in a_ids]))
        return Aligned(a_ids, b_ids, a_ends, list(accumulate(map(len, b_tokens))))

    def align(self, parts: list[str]) -> list[Aligned | None]:
        """The alignment of distinct parts, in their order."""
        out, todo = [], []
        for k, part in enumerate(parts):
            held = self.young.get(part, self)
            if held is self:
                held = self.old.get(part, self)
            if held is self:
                todo.append(k)
            out.append(held)
        for a in range(0, len(todo), 10_000):
            some = todo[a : a + 10_000]
            for k, b_ids in zip(some, self.b.encode([parts[k] for k in some], num_threads=1)):
                out[k] = self._align(parts[k], b_ids)
        for part, held in zip(parts, out):
            if len(part) <= SHORT:
                if len(self.young) >= REMEMBERED:
                    self.old, self.young = self.young, {}
                self.young[part] = held
        return out


@functools.lru_cache(maxsize=1)
def _tokenizers(a_file: str, b_file: str) -> Tokenizers:
    return Tokenizers(a_file, b_file)


class _Numbers(dict):
    """Numbers keys in the order in which they are first asked for."""

    def __missing__(self, key):
        self[key] = number = len(self)
        return number


def pack(*columns: np.ndarray) -> bytes:
    """Whole numbers below 2^32, one byte plane after another, compressed."""
    planes = [np.ascontiguousarray(c.astype("<u4").view(np.uint8).reshape(-1, 4).T) for c in columns]
    held = np.array([len(c) for c in columns], "<i8").tobytes() + b"".join(p.tobytes() for p in planes)
    return np.array([len(held)], "<i8").tobytes() + pa.compress(held, codec="zstd", asbytes=True)


def unpack(blob: bytes, columns: int) -> list[np.ndarray]:
    size = int(np.frombuffer(blob, "<i8", 1)[0])
    held = pa.decompress(blob[8:], size, codec="zstd", asbytes=True)
    out, at = [], 8 * columns
    for n in np.frombuffer(held, "<i8", columns).tolist():
        planes = np.frombuffer(held, np.uint8, 4 * n, at).reshape(4, n)
        out.append(np.ascontiguousarray(planes.T).view("<u4").ravel().astype(np.int64))
        at += 4 * n
    return out


def align_chunk(tokenizers: Tokenizers, texts: list[str], times: np.ndarray) -> dict:
    """Aligns distinct texts that stand for ``times`` documents each.

    ``kept``: which texts have tokens; ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``groups`` of
    those; ``pairs``: the id pairs they hold, ascending, and ``weights``, in how many documents;
    ``links``: packed, of each text the number of its pairs, of those their steps along ``pairs``
    and their occurrences.
    """
    split = [parts_of(t) for t in texts]
    number = _Numbers()
    which = np.fromiter(map(number.__getitem__, chain.from_iterable(split)), np.int64)
    until = np.append(0, np.cumsum([len(s) for s in split], dtype=np.int64))
    del split
    found = tokenizers.align(list(number))
    fine = np.fromiter((f is not None for f in found), bool, len(found))
    kept = np.flatnonzero(np.add.reduceat(~fine[which], until[:-1]) == 0) if texts else np.zeros(0, int)
    found = [f if f is not None else _NOTHING for f in found]
    total = lambda values: np.diff(np.append(0, np.cumsum(values[which]))[until])[kept]
    counts = {
        f"n_{name}": total(np.fromiter((getattr(f, name) for f in found), np.int64, len(found)))
        for name in ("a", "b", "groups")
    }
    counts["n_links"] = counts["n_a"] + counts["n_b"] - counts["n_groups"]

    per_part = np.fromiter((len(f.pairs) // 8 for f in found), np.int64, len(found))
    pool = np.frombuffer(b"".join([f.pairs for f in found]), np.int64)
    pairs, place = np.unique(pool, return_inverse=True)
    begin = np.cumsum(per_part) - per_part
    weights = np.zeros(len(pairs), np.int64)
    per_text, steps, times_met = [], [], []
    for a, b in groups(np.diff(until)[kept], 1 << 18):
        own = np.concatenate([which[until[k] : until[k + 1]] for k in kept[a:b]])
        text = np.repeat(np.arange(b - a), np.diff(until)[kept[a:b]])
        many = per_part[own]
        within = np.arange(int(many.sum())) - np.repeat(np.cumsum(many) - many, many)
        met = np.repeat(text, many) * len(pairs) + place[np.repeat(begin[own], many) + within]
        met, occurs = np.unique(met, return_counts=True)
        text, pair = met // len(pairs), met % len(pairs)
        np.add.at(weights, pair, times[kept[a:b]][text])
        first = np.append(True, text[1:] != text[:-1])
        steps.append(np.where(first, pair, pair - np.append(0, pair[:-1])))
        times_met.append(occurs)
        per_text.append(np.bincount(text, minlength=b - a))
    none = np.zeros(0, np.int64)
    links = pack(*(np.concatenate([none, *x]) for x in (per_text, steps, times_met)))
    there = np.flatnonzero(weights)  # pairs of texts without tokens go
    if len(there) < len(pairs):
        return align_chunk(tokenizers, [texts[k] for k in kept], times[kept]) | {"kept": kept}
    texts_of = [f.text for f in found]
    joined = (";".join([texts_of[p] for p in which[until[k] : until[k + 1]].tolist()]) for k in kept)
    return counts | {"kept": kept, "pairs": pairs, "weights": weights, "links": links, "groups": joined}


_NOTHING = Aligned([], [], [], [])

_STORED = (
    "chunk long, key string, n_a long, n_b long, n_groups long, n_links long, groups string, "
    "keys array<string>, pairs array<long>, weights array<long>, links binary"
)


def _aligned(texts: DataFrame, a_file: str, b_file: str) -> DataFrame:
    """For every distinct text its measures, and for every chunk of them its pairs and links."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizers, made = _tokenizers(a_file, b_file), 0
        names = [part.split()[0] for part in _STORED.split(", ")]
        types = [pa.int64(), pa.string(), *[pa.int64()] * 4, pa.string()]
        types += [pa.list_(pa.string()), *[pa.list_(pa.int64())] * 2, pa.binary()]
        schema = pa.schema(list(zip(names, types)))

        def rows(n: int, **held) -> pa.RecordBatch:
            columns = [held.get(name, pa.nulls(n, kind)) for name, kind in zip(names, types)]
            return pa.RecordBatch.from_arrays(columns, schema=schema)

        for batch in batches:
            texts = batch.column(1).to_pylist()
            sizes = np.fromiter(map(len, texts), np.int64, len(texts))
            for a, b in groups(sizes, CHUNK):
                times = np.asarray(batch.column(2), np.int64)[a:b]
                found = align_chunk(tokenizers, texts[a:b], times)
                kept, joined = found["kept"], found.pop("groups")
                if not len(kept):
                    continue
                chunk = TaskContext.get().partitionId() << 32 | made
                made += 1
                keys = batch.column(0).slice(a, b - a).take(pa.array(kept))
                measures = ("n_a", "n_b", "n_groups", "n_links")
                # Tokens are about as many as bytes, and a token takes some bytes more as text.
                for x, y in groups(sizes[a:b][kept], CHUNK // 8):
                    own = {name: pa.array(found[name][x:y], pa.int64()) for name in measures}
                    own["groups"] = pa.array([next(joined) for _ in range(x, y)], pa.string())
                    own["chunk"] = pa.array([chunk] * (y - x), pa.int64())
                    yield rows(y - x, key=keys.slice(x, y - x), **own)
                one = pa.array([0, len(found["pairs"])], pa.int32())
                yield rows(
                    1,
                    chunk=pa.array([chunk], pa.int64()),
                    keys=pa.ListArray.from_arrays(pa.array([0, len(keys)], pa.int32()), keys),
                    pairs=pa.ListArray.from_arrays(one, pa.array(found["pairs"], pa.int64())),
                    weights=pa.ListArray.from_arrays(one, pa.array(found["weights"], pa.int64())),
                    links=pa.array([found["links"]], pa.binary()),
                )

    return texts.select("key", "text", "times").mapInArrow(tidy(work), _STORED)


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``key``, ``n_best`` and ``count_sum`` of a chunk's texts from its pairs' counts."""
    for batch in batches:
        for k in range(batch.num_rows):
            keys, blob, answers = (batch.column(c)[k] for c in range(3))
            value = np.asarray(answers.values.field("value"), np.int64)
            per_text, steps, occurs = unpack(blob.as_py(), 3)
            until = np.append(0, np.cumsum(per_text))
            whole = np.cumsum(steps)
            before = np.append(0, whole)[until[:-1]]  # steps begin anew with every text
            value = value[whole - np.repeat(before, per_text)]
            sums = [
                np.diff(np.append(0, np.cumsum(occurs * what))[until])
                for what in (value & 1, value >> 1)
            ]
            columns = [keys.values, *(pa.array(s, pa.int64()) for s in sums)]
            yield pa.RecordBatch.from_arrays(columns, ["key", "n_best", "count_sum"])


def align(
    docs: DataFrame,
    a_file: str,
    b_file: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    groups_as: Callable[[Column], Column] = lambda groups: groups,
) -> DataFrame:
    """How two tokenizers cut every text: A, a byte-level BPE file, and B, a piece model.

    Both encode the text with a blank before it, special strings as plain text. Returns per input
    row the id column, ``n_a``, ``n_b`` (tokens), ``n_groups`` (between common token ends),
    ``n_links`` (pairs of an A and a B token that share bytes), ``n_best`` (links whose id pair is
    linked in as many documents as any pair of its A id), ``count_sum`` (over the links, how many
    documents hold their id pair linked) and ``groups`` (``a1,a2|b1;a3|b2``), or what ``groups_as``
    makes of it, so that it need not be moved in full.

    Null and empty texts, and texts that a tokenizer doesn't give back byte by byte, have no
    tokens: zeros and empty ``groups``. Every row is a document, also with a null or repeated id.
    Only the two columns are read, so others may have any name. Empty tables give empty results.

    One shuffle by the full text leaves each text once with its multiplicity; copies meet before
    they are sent. A chunk of texts sends each of its id pairs once, with the documents that hold
    it, and gets the pair's count over all chunks back; the pair lists of single texts stay in the
    chunk's row. Measures join the documents by the text's SHA-256.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    key = F.sha2("text", 256).alias("key")
    texts = rows.filter("text <> ''").groupBy("text").agg(F.count("*").alias("times"))
    found = _aligned(texts.select(key, "text", "times"), a_file, b_file)
    found = cut(found.withColumn("groups", groups_as(F.col("groups"))), "aligned")
    chunks = found.filter(F.col("keys").isNotNull())

    sent = chunks.select("chunk", F.explode(F.arrays_zip("pairs", "weights")).alias("p"))
    sent = sent.select("chunk", F.col("p.pairs").alias("pair"), F.col("p.weights").alias("weight"))
    over = F.sum("weight").over(Window.partitionBy("pair"))
    counts = cut(sent.select("chunk", "pair", over.alias("n")), "pairs")
    a_id = F.shiftright("pair", 32).alias("a_id")
    best = counts.groupBy(a_id).agg(F.max("n").alias("most"))  # a row for an id of A at most
    value = F.col("n") * 2 + (F.col("n") == F.col("most")).cast("int")
    answers = (
        counts.withColumn("a_id", a_id)
        .join(F.broadcast(best), "a_id")
        .groupBy("chunk")
        .agg(F.sort_array(F.collect_list(F.struct("pair", value.alias("value")))).alias("answers"))
    )
    sums = chunks.select("chunk", "keys", "links").join(answers, "chunk")
    sums = sums.select("keys", "links", "answers").mapInArrow(
        _summed, "key string, n_best long, count_sum long"
    )
    measures = found.filter(F.col("key").isNotNull()).drop("chunk", "keys", "pairs", "weights", "links")
    measures = measures.join(sums, "key")
    out = rows.select("id", key).join(measures, "key", "left")
    numbers = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")
    return out.select(
        F.col("id").alias(id_col),
        *(F.coalesce(name, F.lit(0)).alias(name) for name in numbers),
        F.coalesce("groups", F.lit("")).alias("groups"),
    )
