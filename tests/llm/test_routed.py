"""Scores of corpora that no filter of a fixed size holds."""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash

from coverledger.llm import routed, scoring
from tests.llm.cases import odd_docs, odd_rows
from tests.llm.test_models import plain_base

SMALL = {"pair_bits": 1 << 16, "word_bits": 1 << 16}


def plain_scores(rows):
    """log10 probabilities by exact counts of words and pairs, weights from all training texts."""
    hash_of = lambda w: xxhash.xxh64_intdigest(w, 42)
    texts = [[hash_of(w) for w in (r[1] or "").encode().lower().split() + [b" "]] for r in rows]
    held = [zlib.crc32(b"" if r[0] is None else str(r[0]).encode()) % 7 == 2 for r in rows]
    pairs_of = lambda t: list(zip(t[-1:] + t[:-1], t))
    words = Counter(w for t, h in zip(texts, held) if not h for w in t)
    pairs = Counter(p for t, h in zip(texts, held) if not h for p in pairs_of(t))
    level = lambda n, base: int(scoring.level_of(np.array([n]), base)[0]) if n else 0
    mass = sum(float(routed.middle(np.array([level(n, 1.25)]))[0]) for n in words.values())

    def parts(p, without):
        a, b, c = (np.array([level(n, base)]) for n, base in ((words[p[0]], 1.25), (words[p[1]], 1.25), (pairs[p], 1.5)))
        alone = (max(routed.middle(b)[0] - without, 0) + 1) / (mass - without + len(words) + 1)
        total = scoring.most_count(a, 1.25)[0] - without
        seen = max(scoring.least_count(c, 1.5)[0] - without, 0)
        return int(a[0]), alone, min(seen / total, 1) if total > 0 else 0.0

    sums = np.zeros((scoring.LEVELS + 1, len(scoring.WEIGHTS)))
    for p, n in pairs.items():
        a, alone, after = parts(p, 1)
        sums[a] += n * np.log10((1 - scoring.WEIGHTS) * alone + scoring.WEIGHTS * after)
    weights = scoring.WEIGHTS[sums.argmax(axis=1)]

    def log(p):
        a, alone, after = parts(p, 0)
        return np.log10((1 - weights[a]) * alone + weights[a] * after)

    return [(r[0], sum(map(log, pairs_of(t)))) for r, t in zip(rows, texts)]


def test_nothing_is_left_out_of_filters_too_small(spark, monkeypatch):
    monkeypatch.setattr(routed, "CHUNK_BYTES", 2000)  # so that there are several chunks
    got = scoring.score(odd_docs(spark), **SMALL).collect()
    assert Counter((*r[:5], round(r["base_score"], 5)) for r in got) == plain_base(odd_rows())
    key = lambda r: (str(r[0]), r[1])
    want = sorted(plain_scores(odd_rows()), key=key)
    mine = sorted(((r["doc_id"], r["score"]) for r in got), key=key)
    assert [k for k, _ in mine] == [k for k, _ in want]
    assert [s for _, s in mine] == pytest.approx([s for _, s in want], rel=0.002)


def test_scores_do_not_depend_on_the_bits(spark, sf_dir):
    """Filters of 2^16 bits would hold 6500 of the pairs; the scores have to be those of all."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    large = {r["doc_id"]: r["score"] for r in scoring.score(docs).collect()}
    small = {r["doc_id"]: r["score"] for r in scoring.score(docs, **SMALL).collect()}
    assert large.keys() == small.keys()
    assert sum(small.values()) == pytest.approx(sum(large.values()), rel=0.01)


def test_one_model_at_all_sizes(spark, monkeypatch):
    """Neither the bits asked for nor the size of the text chooses another model."""
    seen = []
    routed_score = routed.score
    monkeypatch.setattr(routed, "score", lambda rows, octets: seen.append(octets) or routed_score(rows, octets))
    docs = spark.createDataFrame([(k, "a b a c " * (k + 1)) for k in range(20)], "doc_id long, text string")
    large = sorted(map(tuple, scoring.score(docs).collect()))
    assert large == sorted(map(tuple, scoring.score(docs, **SMALL).collect()))
    assert len(seen) == 2
    want = dict(plain_scores([(k, "a b a c " * (k + 1)) for k in range(20)]))
    assert {r[0]: r[6] for r in large} == pytest.approx(want, rel=0.002)


def test_probabilities_of_a_context_add_up_to_one_at_most():
    words = {"x": 4, "y": 2, "z": 2}
    level = {w: int(scoring.level_of(np.array([n]), scoring.WORD_BASE)[0]) for w, n in words.items()}
    two = int(scoring.level_of(np.array([2]), scoring.PAIR_BASE)[0])
    codes = np.array([(level["x"] * routed.STEP + level[w]) * routed.STEP + two for w in "yz"])
    assert routed._parts(codes, 8.0, 3, 0)[2].sum() <= 1.0


def test_segments_follow_the_text():
    assert routed.segments_for(0) == routed.segments_for(10**9) == 256
    assert routed.segments_for(10**12) * routed.SEGMENT_BYTES >= 10**12


def test_frequent_words_that_overfill_a_small_segment(spark):
    """A dozen levels of one word need more bits than a segment of a small filter has; left out,
    its pairs would have probability 1."""
    rows = [(k, "a b a c a d " * 400 + "x y x z") for k in range(12)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r["score"] for r in scoring.score(docs).collect()}
    want = dict(plain_scores(rows))
    assert got == pytest.approx(want, rel=0.002)
