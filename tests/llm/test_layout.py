"""Mixing, sharding and packing."""

from __future__ import annotations

import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from coverledger.llm import mixing, packing, sharding
from tests.llm.cases import SCHEMA, empty_docs, odd_docs, odd_rows

FILE = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(FILE)


def test_mix_comes_near_its_targets(spark):
    rows = [(k, "w " * (k % 37), None, f"s{k % 5}" if k % 3 else None, 0, None, 0) for k in range(3000)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(4)
    got = mixing.mix(docs, shards=5).collect()
    assert len(got) == len(rows)
    taken, target, size, largest = Counter(), {}, Counter(), Counter()
    for r in got:
        assert r["_size"] == r["doc_id"] % 37 and len(r["_draws"]) <= 2
        taken[r["source"]] += len(r["_draws"]) * r["_size"]
        target[r["source"]], largest[r["source"]] = r["_target"], 36
        size[r["source"]] += r["_size"]
    assert sum(target.values()) == pytest.approx(1.5 * sum(size.values()))
    for s in target:
        assert abs(taken[s] - target[s]) <= largest[s] / 2 + 1e-6
        assert target[s] <= 2 * size[s] + 1e-6
    again = mixing.mix(docs.repartition(7), shards=5).collect()
    pick = lambda rs: sorted((r["doc_id"], [(d["rep"], d["shard"], d["place"]) for d in r["_draws"]]) for r in rs)
    assert pick(got) == pick(again)
    assert mixing.mixed_documents(docs).count() == sum(len(r["_draws"]) for r in got)


def test_quotas_are_split_exactly(spark):
    quotas = {0: 400, 1: 37, 2: 1, 3: 0, 4: 62}
    df = spark.createDataFrame(list(quotas.items()), "rank int, q long")
    rows = mixing.shard_quotas(df, 7, 1).collect()
    by_shard, by_rank = Counter(), Counter()
    for r in rows:
        by_shard[r["shard"]] += r["q"]
        by_rank[r["rank"]] += r["q"]
    assert by_rank == Counter({k: n for k, n in quotas.items() if n})
    assert len(by_shard) == 7 and max(by_shard.values()) - min(by_shard.values()) <= 3


def test_mix_of_odd_tables(spark):
    got = mixing.mix(odd_docs(spark)).collect()
    assert len(got) == len(odd_rows())
    assert mixing.mixed_documents(empty_docs(spark)).count() == 0
    blank = spark.createDataFrame([(1, None, None, None, None, None, None)], SCHEMA)
    assert mixing.mix(blank).collect()[0]["_target"] == 0


@pytest.mark.parametrize("rows", [1, 2, 3, 7, 24, 100, 1000])
def test_permutation(spark, rows):
    numbers = spark.range(rows).select(sharding.permuted(sharding.F.col("id"), rows, 42).alias("p"))
    places = [r["p"] for r in numbers.collect()]
    assert sorted(places) == list(range(rows))
    assert rows < 100 or places != sorted(places)


def test_sharding(spark):
    rows = odd_rows()
    got = sharding.shard_rows(odd_docs(spark), 5).collect()
    want = Counter(
        (r[0], len((r[1] or "").encode()) + 8, zlib.crc32((r[1] or "").encode())) for r in rows
    )
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == want
    slots = defaultdict(list)
    for r in got:
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    sizes = [len(slots[s]) for s in range(5)]
    assert max(sizes) - min(sizes) <= 1
    again = sharding.shard_rows(odd_docs(spark).repartition(7), 5).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))
    assert sharding.shard_rows(empty_docs(spark), 5).count() == 0


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(st.one_of(st.sampled_from(" \n\t\r\x0b\x1c\x85\xa0 ab'sÉ1.中<|>"), st.characters(codec="utf-8")), max_size=40), max_size=6))
def test_ids_are_the_tokenizers(texts):
    tokenizer = Tokenizer.from_file(FILE)
    found = packing._encoder(FILE).encode_all(texts)
    assert [f.tolist() for f in found] == [
        tokenizer.encode(t, add_special_tokens=False).ids for t in texts
    ]


def test_special_strings_are_their_tokens():
    texts = ["hello <|endoftext|> world", "<|endoftext|>", "<|endoftext|><|endoftext|> a", "x  <|endoftext|>", "<|end"]
    tokenizer = Tokenizer.from_file(FILE)
    found = packing._encoder(FILE).encode_all(texts)
    want = [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    assert [f.tolist() for f in found] == want and want[0] == [31373, 220, 50256, 995]


def test_every_code_point_has_the_class_of_the_tokenizer():
    points = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    text = "".join(f"a{c}1{c} {c}'s" for c in points[::11] + points[:0x3000])
    ids = Tokenizer.from_file(FILE).encode(text, add_special_tokens=False).ids
    assert packing._encoder(FILE).encode_all([text])[0].tolist() == ids


def check_packing(got, want_ids, length):
    by_sequence, by_doc = defaultdict(list), defaultdict(list)
    for r in got:
        by_sequence[r["sequence_id"]].append((r["offset"], r["length"]))
        by_doc[r["doc_id"]].append(r)
    for parts in by_sequence.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= length
    for doc, pieces in by_doc.items():
        ids = want_ids[doc]
        repeats = len([p for p in pieces if p["piece"] == 0])
        assert sum(p["length"] for p in pieces) == repeats * len(ids)
        for p in pieces:
            own = np.array(ids[p["start"] : p["start"] + p["length"]], "<u4").tobytes()
            assert p["ids_crc32"] == zlib.crc32(own)
            assert p["length"] == length or p["piece"] == 0
    return len(by_sequence)


def test_packing(spark, tokenizer):
    rows = [r for r in odd_rows() if r[0] is not None]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    packed = packing.pack_documents(docs, FILE, length=128, keep_ids=True)
    ids = {r[0]: tokenizer.encode(r[1] or "", add_special_tokens=False).ids + [2] for r in rows}
    got = packed.collect()
    used = check_packing(got, ids, 128)
    tokens = sum(r["length"] for r in got)
    assert used <= -(-tokens // 128) + 2
    joined = packing.sequences(packed).collect()
    assert sum(len(r["ids"]) for r in joined) == 4 * tokens
    assert packing.pack_documents(odd_docs(spark), FILE).count() >= len(odd_rows())
    assert packing.pack_documents(empty_docs(spark), FILE).count() == 0


def fewest(histogram, length):
    """No packing has fewer sequences: long pieces take one each, and those from ``p`` to half of
    it only fit beside pieces of up to length - p, in what these leave, or in further sequences."""
    best = 0
    for p in range(length // 2 + 1):
        tokens = lambda a, b: sum(k * n for k, n in histogram.items() if a < k <= b)
        count = lambda a, b: sum(n for k, n in histogram.items() if a < k <= b)
        half = length // 2
        room = count(half, length - p) * length - tokens(half, length - p)
        more = -(-(tokens(p - 1, half) - room) // length)
        best = max(best, count(half, length) + max(0, more))
    return best


def test_plan_is_near_the_least_number():
    rng = np.random.default_rng(2)
    for scale in (1, 40):
        lengths = rng.integers(1, 257, 400)
        histogram = Counter(int(n) for n in lengths)
        histogram = {k: n * scale for k, n in histogram.items()}
        planned = packing.plan(histogram, 256)
        used = Counter()
        for own, n in planned:
            assert sum(own) <= 256
            for size in own:
                used[size] += n
        assert used == histogram
        least = fewest(histogram, 256)
        assert sum(n for _, n in planned) <= least * 1.01 + 3
    assert packing.plan({}) == []
