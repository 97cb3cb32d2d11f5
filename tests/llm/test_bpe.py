"""Byte-level BPE against the library of the rank file."""

from __future__ import annotations

import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import regex
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from coverledger.llm import bpe
from coverledger.llm.queries import QUERIES
from tests.llm.cases import empty_docs, odd_docs, odd_rows

FILE = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
ALPHABET = " \n\t\r\x0b\x1c\x85\xa0 　ab'sStmdrevl'’É1.²中<|>\0\U0001f600́"
TEXTS = st.text(st.one_of(st.sampled_from(ALPHABET), st.characters(codec="utf-8")), max_size=40)


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding(
        "file",
        pat_str=public_tokenizers.PATTERN,
        mergeable_ranks=bpe.read_ranks(FILE),
        special_tokens={},
    )


@pytest.fixture
def small_windows(monkeypatch):
    monkeypatch.setattr(bpe, "WINDOW", 5)
    monkeypatch.setattr(bpe, "AT_ONCE", 7)
    monkeypatch.setattr(bpe, "REMEMBERED", 3)
    monkeypatch.setattr(bpe, "LONG", 9)
    monkeypatch.setattr(bpe, "MERGED", 2)


def check(library, texts):
    encoder, decoder = bpe._encoder(FILE), bpe._decoder(FILE)
    ids, offsets, bounds = encoder.encode(texts)
    found, until = decoder.decode(ids, offsets, bounds)
    for k, text in enumerate(texts):
        own = ids[bounds[k] : bounds[k + 1]].tolist()
        assert own == library.encode_ordinary(text)
        assert found[until[k] : until[k + 1]].tobytes() == text.encode()
        sizes = [len(library.decode_single_token_bytes(i)) for i in own]
        assert offsets[bounds[k] : bounds[k + 1]].tolist() == (np.cumsum(sizes) - sizes).tolist()


@settings(max_examples=200, deadline=None)
@given(st.lists(TEXTS, max_size=6))
def test_ids_offsets_and_bytes(library, texts):
    if texts:
        check(library, texts)


def test_windows_and_forgetting(library, small_windows):
    bpe._encoder(FILE).merger._forget()
    rng = random.Random(3)
    for _ in range(60):
        check(library, ["".join(rng.choices(ALPHABET, k=rng.randint(0, 60))) for _ in range(4)])


def test_every_code_point_has_the_class_of_the_library(library):
    points = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    text = "".join(f"a{c}1{c} {c}'s" for c in points[::7] + points[:0x3000])
    held, begin, finish, _ = bpe.slices([text], bpe.classes())
    ids = [i for b, e in zip(begin, finish) for i in library.encode_ordinary(held[b:e].decode())]
    assert ids == library.encode_ordinary(text)


def test_slices_are_the_pattern_on_plain_text():
    text = "It's  we'll\n\n'tis 'll''s x're3've  \t y''ve'd"
    held, begin, finish, before = bpe.slices([text, "", text], bpe.classes())
    found = [held[b:e].decode() for b, e in zip(begin, finish)]
    assert found == 2 * regex.findall(public_tokenizers.PATTERN, text)
    assert before.tolist() == [0, len(found) // 2, len(found) // 2, len(found)]


def test_composition_is_associative():
    rng = np.random.default_rng(1)
    f, g, h = rng.integers(0, len(bpe._FUNCTIONS), (3, 1000))
    then = lambda a, b: bpe._THEN[a.astype(int) * len(bpe._FUNCTIONS) + b]
    assert (then(then(f, g), h) == then(f, then(g, h))).all()


def test_long_slices_merge_like_short_ones(library):
    rng = random.Random(5)
    texts = ["a" * 5000, "".join(rng.choices("abcdeé", k=4000)), "中文" * 700, "=" * 900]
    check(library, texts)


def test_tables(spark, library):
    got = bpe.decode(bpe.encode(odd_docs(spark), FILE), FILE).collect()
    want = Counter((r[0], (r[1] or "").encode()) for r in odd_rows())
    assert Counter((r["doc_id"], bytes(r["decoded"])) for r in got) == want
    ids = Counter((r[0], tuple(library.encode_ordinary(r[1] or ""))) for r in odd_rows())
    assert Counter((r["doc_id"], tuple(r["ids"])) for r in got) == ids
    assert bpe.decode(bpe.encode(empty_docs(spark), FILE), FILE).count() == 0
    clash = odd_docs(spark).withColumnsRenamed({"doc_id": "ids", "text": "decoded", "lang": "id"})
    assert bpe.encode(clash.select("ids", "decoded"), FILE, "ids", "decoded").count() == len(odd_rows())


def test_a_run_of_tokens_is_decoded_alone(spark, library):
    text = "the house thereafter, été 中文 it's"
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    some = bpe.encode(docs, FILE).selectExpr(
        "doc_id", "slice(ids, 3, 4) AS ids", "slice(offsets, 3, 4) AS offsets"
    )
    ids = library.encode_ordinary(text)[2:6]
    assert bytes(bpe.decode(some, FILE).collect()[0]["decoded"]) == library.decode_bytes(ids)


def test_query_against_the_library(spark, sf_dir, library):
    import hashlib

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    sha = lambda b: hashlib.sha256(b).hexdigest()
    want = set()
    for r in docs:
        ids = library.encode_ordinary(r["text"] or "")
        digits = sha(",".join(map(str, ids)).encode())
        want.add((r["doc_id"], len(ids), digits, sha((r["text"] or "").encode())))
    got = QUERIES["op11_byte_bpe"](spark, sf_dir).collect()
    assert {tuple(r) for r in got} == want and len(got) == len(docs)
