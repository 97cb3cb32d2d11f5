"""Alignment of two tokenizers against whole texts, token by token."""

from __future__ import annotations

import hashlib
import random
from bisect import bisect_right
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from coverledger.llm import alignment
from coverledger.llm.queries import QUERIES
from tests.llm.cases import empty_docs, odd_docs, odd_rows

A, B = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
NUMBERS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups")
ALPHABET = "   \n\t\x0b\x1c\x85\xa0　ab'sÉ1.中<|>\0▁\U0001f600x́"
TEXTS = st.text(st.one_of(st.sampled_from(ALPHABET), st.characters(codec="utf-8")), max_size=30)


@pytest.fixture(scope="module")
def plain():
    """The whole operator, text by text, with every pair of tokens compared by range."""
    a_tool, b_tool = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    a_tool.encode_special_tokens = True
    points = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letter = {chr(b): b for b in points}
    letter |= {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in points)}

    def b_bytes(i):
        piece = b_tool.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if b_tool.is_byte(i) else piece.replace("▁", " ").encode()

    def tokens(text):
        whole = (" " + text).encode()
        a = a_tool.encode(" " + text, add_special_tokens=False).ids
        b = b_tool.encode(text)
        a_held = [bytes(letter[c] for c in a_tool.id_to_token(i)) for i in a]
        b_held = [b_bytes(i) for i in b]
        if not text or b"".join(a_held) != whole or b"".join(b_held) != whole:
            return None
        return a, np.cumsum([len(x) for x in a_held]).tolist(), b, np.cumsum([len(x) for x in b_held]).tolist()

    def run(docs):
        links, cuts, count, held = {}, {}, Counter(), {}
        for text in {t for _, t in docs if t}:
            if (found := tokens(text)) is None:
                continue
            a, a_end, b, b_end = held[text] = found
            spans = [(x, y - 1) for x, y in zip([0, *a_end], a_end)], [(x, y - 1) for x, y in zip([0, *b_end], b_end)]
            j0, own = 0, []
            for i, (x, y) in enumerate(spans[0]):
                while spans[1][j0][1] < x:
                    j0 += 1
                for j in range(j0, len(b)):
                    if spans[1][j][0] > y:
                        break
                    own.append((a[i], b[j]))
            links[text] = own
            both, parts = sorted(set(a_end) & set(b_end)), []
            for x, y in zip([0, *both], both):
                ids = [
                    side[0][bisect_right(side[1], x) : bisect_right(side[1], y)]
                    for side in ((a, a_end), (b, b_end))
                ]
                parts.append("|".join(",".join(map(str, i)) for i in ids))
            cuts[text] = ";".join(parts)
        for _, text in docs:
            count.update(set(links.get(text, [])))
        most = defaultdict(int)
        for (x, _), n in count.items():
            most[x] = max(most[x], n)
        out = []
        for d, text in docs:
            own = links.get(text, [])
            a, _, b, _ = held.get(text, ([],) * 4)
            n_groups = cuts.get(text, "").count(";") + 1 if own else 0
            n_best = sum(count[p] == most[p[0]] for p in own)
            out.append((d, len(a), len(b), n_groups, len(own), n_best, sum(count[p] for p in own), cuts.get(text, "")))
        return Counter(out)

    return run


def ask(spark, docs, repartition=3):
    table = spark.createDataFrame([(*d, "x", 1) for d in docs], "doc_id long, text string, key string, pair int")
    rows = alignment.align(table.repartition(repartition), A, B)
    return Counter((r["doc_id"], *(r[n] for n in NUMBERS)) for r in rows.collect())


def test_odd_tables(spark, plain):
    got = alignment.align(odd_docs(spark), A, B).collect()
    want = plain([(r[0], r[1]) for r in odd_rows()])
    assert Counter((r["doc_id"], *(r[n] for n in NUMBERS)) for r in got) == want
    assert alignment.align(empty_docs(spark), A, B).count() == 0
    blank = odd_docs(spark).filter("text IS NULL OR text = ''")
    assert {tuple(r)[1:] for r in alignment.align(blank, A, B).collect()} == {(0,) * 6 + ("",)}


def test_chunks_and_forgetting(spark, plain, monkeypatch):
    """Many chunks, copies and strange characters give what whole texts give."""
    rng = random.Random(4)
    words = ["the", "house,", "été", "thouirou", "x\ny", "it's", "中文", "  ", "a\t", "<s>", "▁", "\0", "ﬁ"]
    docs = [(k, " ".join(rng.choices(words[: rng.choice([6, 9, 13])], k=rng.randint(0, 25)))) for k in range(150)]
    docs += [(k, docs[7][1]) for k in range(500, 560)] + [(1, None)]
    tools = alignment.Tokenizers(A, B)
    monkeypatch.setattr(alignment, "REMEMBERED", 5)
    assert ask(spark, docs) == plain(docs)
    texts = sorted({t for _, t in docs if t})
    whole = alignment.align_chunk(tools, texts, np.ones(len(texts), np.int64))
    again = alignment.align_chunk(tools, texts, np.ones(len(texts), np.int64))
    assert list(whole["groups"]) == list(again["groups"])


def test_small_chunks(monkeypatch, plain):
    """Chunk sums of pair weights are the counts of all texts, however the texts are cut up."""
    rng = random.Random(8)
    texts = sorted({" ".join(rng.choices(["the", "house", "été", "on.\nIt", "▁ b"], k=rng.randint(1, 9))) for _ in range(60)})
    tools, total = alignment.Tokenizers(A, B), Counter()
    for a in range(0, len(texts), 7):
        some = texts[a : a + 7]
        got = alignment.align_chunk(tools, some, np.ones(len(some), np.int64))
        total.update(dict(zip(got["pairs"].tolist(), got["weights"].tolist())))
    one = alignment.align_chunk(tools, texts, np.ones(len(texts), np.int64))
    assert total == Counter(dict(zip(one["pairs"].tolist(), one["weights"].tolist())))


@settings(max_examples=150, deadline=None)
@given(st.lists(TEXTS, min_size=1, max_size=4))
def test_parts_are_the_whole(plain, texts):
    texts = sorted({t for t in texts if t})
    tools = alignment._tokenizers(A, B)
    got = alignment.align_chunk(tools, texts, np.ones(len(texts), np.int64))
    want = {r[0]: r for r in plain(list(enumerate(texts)))}
    assert got["kept"].tolist() == sorted(k for k, r in want.items() if r[1])
    rows = zip(got["kept"].tolist(), got["n_a"], got["n_b"], got["n_groups"], got["n_links"], got["groups"])
    for k, *numbers, groups in rows:
        assert (*numbers, groups) == (*want[k][1:5], want[k][7])


def test_packed_numbers():
    columns = [np.array(c, np.int64) for c in ([1, 2, 70_000, 2**32 - 1], [], [0, 5])]
    assert [c.tolist() for c in alignment.unpack(alignment.pack(*columns), 3)] == [c.tolist() for c in columns]


def test_query_against_plain_python(spark, sf_dir, plain):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest() if s else ""
    want = Counter((*r[:-1], sha(r[-1])) for r in plain(docs).elements())
    rows = QUERIES["op13_cross_tokenizer_alignment"](spark, sf_dir).collect()
    names = ("doc_id", *NUMBERS[:-1], "groups_sha256")
    assert Counter(tuple(r[n] for n in names) for r in rows) == want
