"""Exact, near and substring deduplication against plain Python."""

from __future__ import annotations

import hashlib
import random
import re
import sys
from collections import Counter, defaultdict
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest
import xxhash
import zstandard

from coverledger.llm import components, exact, simhash, substrings
from tests.llm.cases import SCHEMA, empty_docs, odd_docs, odd_rows, words

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def classes_of(pairs, nodes):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in pairs:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    return {n: find(n) for n in nodes}


def normal(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def test_exact_dedup(spark):
    rows = odd_rows()
    got = exact.exact_dedup(odd_docs(spark), counters=2).collect()
    assert len(got) == len(rows)
    sizes = Counter(normal(r[1]) for r in rows)
    least = {}
    for r in rows:
        if r[0] is not None:
            least[normal(r[1])] = min(r[0], least.get(normal(r[1]), r[0]))
    by_hash = {hashlib.sha256(t.encode()).digest(): t for t in sizes}
    for r in got:
        text = by_hash[bytes(r["digest"])]
        assert (r["group_size"], r["keep_id"]) == (sizes[text], least.get(text))
        assert not r["kept"] or r["doc_id"] == r["keep_id"]
    assert sum(r["kept"] for r in got) == len(sizes)
    kept = exact.drop_copies(odd_docs(spark))
    assert kept.columns == odd_docs(spark).columns and kept.count() == len(sizes)
    assert exact.drop_copies(empty_docs(spark)).count() == 0


def test_frequent_digests_are_found(spark):
    rng = random.Random(1)
    values = [b"hot"] * 4000 + [rng.randbytes(8) for _ in range(6000)] + [b"warm"] * 500
    rng.shuffle(values)
    df = spark.createDataFrame([(bytearray(v),) for v in values], "digest binary").repartition(5)
    found = {bytes(r["digest"]) for r in exact.frequent(df, 64).collect()}
    assert {b"hot", b"warm"} <= found and len(found) <= 65


def plain_fingerprint(text):
    ws = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not ws:
        return 0
    grams = [" ".join(ws[i : i + 3]) for i in range(max(1, len(ws) - 2))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash(spark):
    rows = odd_rows()
    fps = [plain_fingerprint(r[1]) for r in rows]
    assert fps == [simhash.fingerprint((r[1] or "").encode()) for r in rows]
    links = [
        (a, b)
        for a in range(len(fps))
        for b in range(a)
        if (fps[a] ^ fps[b]).bit_count() <= 2
    ]
    root = classes_of(links, range(len(fps)))
    ids = defaultdict(list)
    for k, r in enumerate(rows):
        ids[root[k]] += [r[0]] if r[0] is not None else []
    want = Counter((r[0], f, min(ids[root[k]], default=None)) for k, (r, f) in enumerate(zip(rows, fps)))
    got = simhash.near_duplicates(odd_docs(spark)).collect()
    assert Counter((r["doc_id"], r["fp"] % 2**64, r["component_id"]) for r in got) == want
    kept = simhash.drop_near_copies(odd_docs(spark))
    assert kept.columns == odd_docs(spark).columns and kept.count() == len(set(root.values()))
    assert simhash.near_duplicates(empty_docs(spark)).count() == 0


def test_simhash_links_of_dense_clusters(spark):
    """Hundreds of fingerprints around a few centres fill posting lists beyond the pair limit."""
    rng = random.Random(3)
    fps = {rng.getrandbits(64) for _ in range(300)}
    for centre in [rng.getrandbits(64) for _ in range(3)]:
        for _ in range(400):
            fp = centre
            for bit in rng.sample(range(64), rng.randint(0, 4)):
                fp ^= 1 << bit
            fps.add(fp)
    fps = sorted(f - (1 << 64) if f >> 63 else f for f in fps)
    values = np.array(fps)
    near = np.bitwise_count((values[:, None] ^ values[None, :]).view(np.uint64)) <= 2
    want = classes_of([(fps[a], fps[b]) for a, b in zip(*np.nonzero(np.triu(near, 1)))], fps)
    pairs = simhash.links(spark.createDataFrame([(f,) for f in fps], "fp long"))
    roots = {r["node"]: r["root"] for r in components.connected_components(pairs).collect()}
    assert {f: roots.get(f, f) for f in fps} == want


def test_components(spark):
    rng = random.Random(5)
    pairs = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)]
    pairs += [(1000, 1000 + k) for k in range(200)] + [(2000 + k, 2001 + k) for k in range(40)]
    want = classes_of(pairs, {n for p in pairs for n in p})
    linked = {n for a, b in pairs if a != b for n in (a, b)}
    df = spark.createDataFrame([*pairs, (None, 3), (4, None)], "a long, b long")
    got = {r["node"]: r["root"] for r in components.connected_components(df).collect()}
    assert got == {n: want[n] for n in linked}
    assert components.connected_components(df.limit(0)).count() == 0


def plain_removal(rows, window):
    order = lambda r: 1 << 63 if r[0] is None else r[0]
    texts = [WORD.findall(r[1] or "") for r in rows]
    first = {}
    for r, ws in zip(rows, texts):
        for i in range(len(ws) - window + 1):
            key = tuple(ws[i : i + window])
            first[key] = min(first.get(key, (order(r), i)), (order(r), i))
    out = Counter()
    for r, ws in zip(rows, texts):
        gone = set()
        for i in range(len(ws) - window + 1):
            if first[tuple(ws[i : i + window])] < (order(r), i):
                gone.update(range(i, i + window))
        kept = " ".join(w for i, w in enumerate(ws) if i not in gone)
        out[(r[0], len(ws), len(gone), kept)] += 1
    return out


@pytest.mark.parametrize("hot_share", [1e-4, 0.5, 0.0])
def test_substrings(spark, monkeypatch, hot_share):
    """With a share of 0.0 every minimiser that is met often is hot; with 0.5 none is."""
    monkeypatch.setattr(substrings, "HOT_SHARE", hot_share)
    rng = random.Random(11)
    line = words(rng, 25)
    rows = odd_rows() + [
        (100 + k, f"{words(rng, 9)} {line} {words(rng, rng.randint(0, 30))}", None, None, 0, None, 0)
        for k in range(60)
    ]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(4)
    got = substrings.remove_repeats(docs).collect()
    assert Counter(tuple(r) for r in got) == plain_removal(rows, 20)


def test_substrings_of_empty_tables(spark):
    assert substrings.remove_repeats(empty_docs(spark)).count() == 0


def test_substrings_keep_the_largest_id(spark):
    words = " ".join(f"w{k}" for k in range(25))
    rows = [((1 << 63) - 1, words), (None, words), (3, words)]
    got = substrings.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {(r["doc_id"], r["n_removed"]) for r in got} == {((1 << 63) - 1, 25), (None, 25), (3, 0)}


def test_substrings_of_odd_words(spark):
    """Words that differ in the last byte only, at lengths around whole eights, and all blanks."""
    rng = random.Random(13)
    lengths = [1, 2, 7, 8, 9, 15, 16, 17, 24, 127, 128, 129, 200, 1100]
    line = ["x" * (n - 1) + c for n in lengths for c in "ab\0"]
    texts = [" ".join(line)]
    for k in range(len(line)):  # the same passage with one word changed
        texts.append(" ".join([*line[:k], line[(k + 1) % len(line)], *line[k + 1 :]]))
    texts.append("".join(w + rng.choice(" \t\n\v\f\r") * rng.randint(1, 3) for w in line))
    texts += ["  ".join(line[20:]) + "\n", " " + " ".join(line[:19]), "a " * 50, "a" + " a" * 30]
    rows = [(k, t) for k, t in enumerate(texts)]
    got = substrings.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert Counter(tuple(r) for r in got) == plain_removal(rows, 20)


class Here:
    """Stands for the keyed documents; what is mapped over them runs, and is counted, here."""

    sparkSession = SimpleNamespace(conf=SimpleNamespace(get=lambda name: "3"))

    def __init__(self, parts, calls):
        self.parts, self.calls = parts, calls

    def repartition(self, n, column):
        sent = pa.Table.from_batches([b for part in self.parts for b in part])
        at = np.array(sent[column].to_pylist()) % n
        parts = [sent.take(np.flatnonzero(at == k)).to_batches() for k in range(n)]
        return Here(parts, self.calls)

    def mapInArrow(self, work, schema):
        def count(frame, event, arg):
            self.calls[0] += event in ("call", "c_call")

        sys.setprofile(count)
        try:
            parts = [list(work(iter(part))) for part in self.parts]
        finally:
            sys.setprofile(None)
        return Here(parts, self.calls)


def repeats_here(texts, monkeypatch):
    """The repeated windows that are found, those there are, and the calls for each word."""
    n_words = sum(len(t.split()) for t in texts)
    monkeypatch.setattr(substrings, "hot_minimisers", lambda *a: (np.zeros(0, np.uint64), n_words))
    columns = [pa.array(range(len(texts)), pa.int64())] * 2 + [pa.array(texts)]
    batch = pa.RecordBatch.from_arrays(columns, ["doc", "key", "text"])
    calls = [0]
    found = substrings.repeated_windows(Here([[batch]], calls))
    got = set()
    for b in (b for part in found.parts for b in part):
        for doc, _, start, n in zip(*(c.to_pylist() for c in b.columns)):
            got.update((doc, at) for at in range(start, start + n))
    seen, want = set(), set()
    for k, words_of in enumerate(t.split() for t in texts):
        for at in range(len(words_of) - 19):
            window = tuple(words_of[at : at + 20])
            if window in seen:
                want.add((k, at))
            seen.add(window)
    return got, want, calls[0] / n_words


def test_substrings_work_on_whole_arrays(monkeypatch):
    """Python calls are made for runs and texts, not for each word: CPU seconds a GB."""
    rng = random.Random(17)
    texts = [" ".join(f"w{rng.randrange(10**6)}" for _ in range(2000)) for _ in range(10)]
    texts += [texts[3], "new " + texts[5], " ".join(texts[7].split()[100:200])]
    got, want, calls = repeats_here(texts, monkeypatch)
    assert got == want and len(got) > 4000
    assert calls < 0.2


def test_substrings_of_words_with_one_hash(monkeypatch):
    """Equal hashes of other words remove nothing and hide nothing."""
    monkeypatch.setattr(
        substrings.Words, "_hashes", lambda self: (self.ends - self.starts).astype(np.uint64)
    )
    rng = random.Random(19)
    texts = [words(rng, 300) for _ in range(6)] + ["ab " * 40, "cd " * 40]
    texts += [texts[2], texts[4][9:], " ".join(reversed(texts[1].split()))]
    got, want, _ = repeats_here(texts, monkeypatch)
    assert got == want and got


def test_substrings_pack_numbers_small():
    """Ids, places and counts fill few of their bytes, whatever the keys: shuffle and disk."""
    rng = np.random.default_rng(23)
    keys = rng.integers(-(1 << 63), (1 << 63) - 1, 2000)
    columns = [np.arange(-1000, 1000), keys, rng.integers(0, 500, 2000), rng.integers(1, 19, 2000)]
    numbers = np.stack([*columns], 1)
    planes = substrings._planes(numbers[3:])
    assert (substrings._from_planes(planes) == numbers[3:]).all()
    assert len(zstandard.ZstdCompressor(level=1).compress(planes)) < 16 * 2000
