"""The pipeline as a whole, and the checking SQL of single operators."""

from __future__ import annotations

import re

import pytest

import corpus_pipeline
from coverledger.llm.common import cut
from coverledger.llm.queries import QUERIES, tokenizer_file
from coverledger.llm.sql import ORACLE
from tests.compare import compare
from tests.llm.test_dedup import classes_of, normal, plain_fingerprint
from tests.llm.test_layout import Tokenizer, check_packing


@pytest.mark.parametrize("name", list(ORACLE))
def test_query_matches(spark, con, sf_dir, name):
    ok, note = compare(spark, con, name, QUERIES[name], ORACLE[name], sf_dir)
    assert ok, note


def test_stages_against_plain_python(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["language_id", "exact_dedup", "near_dedup", "mix", "pack"]

    told = cut(stages["language_id"](spark, docs, sf_dir))
    rows = told.collect()
    assert told.columns == docs.columns
    assert {r["doc_id"] for r in rows} == {
        r["doc_id"] for r in docs.collect() if re.search(r"[^\W\d_]", r["text"] or "")
    }

    exact = cut(stages["exact_dedup"](spark, told, sf_dir))
    first = {}
    for r in sorted(rows, key=lambda r: r["doc_id"]):
        first.setdefault(normal(r["text"]), r)
    assert sorted(exact.collect()) == sorted(first.values())

    near = cut(stages["near_dedup"](spark, exact, sf_dir))
    fps = {r["doc_id"]: plain_fingerprint(r["text"]) for r in first.values()}
    links = [(a, b) for a in fps for b in fps if a < b and (fps[a] ^ fps[b]).bit_count() <= 2]
    root = classes_of(links, fps)
    assert {r["doc_id"] for r in near.collect()} == {d for d in fps if root[d] == d}

    mixed = cut(stages["mix"](spark, near, sf_dir))
    assert mixed.columns == docs.columns
    sizes = lambda df: sum(len(r["text"].split()) for r in df.collect())
    assert sizes(mixed) == pytest.approx(1.5 * sizes(near), rel=0.05)

    packed = stages["pack"](spark, mixed, sf_dir).collect()
    tokenizer = Tokenizer.from_file(tokenizer_file())
    ids = {r["doc_id"]: tokenizer.encode(r["text"], add_special_tokens=False).ids + [2] for r in mixed.collect()}
    used = check_packing(packed, ids, 1024)
    assert used <= 1.02 * sum(r["length"] for r in packed) / 1024 + 2
