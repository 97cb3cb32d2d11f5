"""Ranked lexical search against plain counting."""

from __future__ import annotations

import math
import random
import re
from collections import Counter, defaultdict

import pytest

from coverledger.llm import search
from tests.llm.cases import empty_docs, odd_docs, odd_rows

ITEM = "item_id long, text string, score int, rank string"


def terms(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(search.TERM, lower)


def plain(docs, items, top):
    """(item, rank, doc, score) by counting every term of every document."""
    held = [(d, Counter(terms(t))) for d, t in docs]
    n_docs, length = sum(1 for _, c in held if c), sum(c.total() for _, c in held)
    df = Counter(t for _, c in held for t in c)
    asked = defaultdict(Counter)
    for item, text in items:
        asked[item].update(terms(text))
    out = []
    for item, wanted in asked.items():
        found = []
        for d, c in held:
            m = 100 - 25 + (25 * c.total() * n_docs) // length if length else 0
            score = sum(
                r * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                * ((10**9 * c[t]) // (1000 * c[t] + 12 * m))
                for t, r in wanted.items() if c[t]
            )
            if score > 0:
                found.append((-score, d is None, d or 0))
        for k, (score, none, d) in enumerate(sorted(found)[:top]):
            out.append((item, k + 1, None if none else d, -score))
    return Counter(out)


def ask(spark, docs, items, **more):
    asked = spark.createDataFrame([(*i, None, None) for i in items], ITEM)
    return Counter(tuple(r) for r in search.search(docs, asked, **more).collect())


ITEMS = [
    (0, "The house, the TREE"), (1, "été straße niño"), (2, None), (3, "!!"), (4, "nowhere"),
    (5, "x1 one two"), (5, "and two more"), (None, "runs of house"), (7, "it's <|endoftext|>"),
]


def test_odd_tables(spark):
    want = plain([(r[0], r[1]) for r in odd_rows()], ITEMS, 20)
    assert ask(spark, odd_docs(spark), ITEMS) == want and want
    assert ask(spark, odd_docs(spark), []) == Counter()
    assert ask(spark, empty_docs(spark), ITEMS) == Counter()
    silent = odd_docs(spark).filter("doc_id IN (0, 1, 2)")
    assert ask(spark, silent, ITEMS) == Counter()


def test_blocks_groups_and_ties(spark, monkeypatch):
    """Many automata, small groups and copies that tie give the ranking of plain counting."""
    rng = random.Random(9)
    words = [f"w{k}" for k in range(60)] + ["É", "été", "中"]
    line = lambda n: " ".join(rng.choices(words, k=n)) + rng.choice(["", ".", "-W1", "\nW2"])
    docs = [(k, line(rng.randint(0, 30))) for k in range(300)] + [(k, "w1 w2 w3") for k in range(900, 960)]
    items = [(k, line(rng.randint(1, 8))) for k in range(25)] + [(99, "w1 w2")]
    monkeypatch.setattr(search, "BLOCK", 400)
    monkeypatch.setattr(search, "AT_ONCE", 300)
    monkeypatch.setattr(search, "SCORES", 500)
    table = spark.createDataFrame([(*d, "x") for d in docs], "doc_id long, text string, id string")
    got = ask(spark, table.repartition(5), items, top=7)
    assert got == plain(docs, items, 7)
    copies = [d for i, _, d, _ in sorted(got) if i == 99 and d >= 900]
    assert copies and copies == list(range(900, 900 + len(copies)))


@pytest.mark.parametrize("texts", [["a b a", "", "b\0é É a", "ab abc"], ["中a b", "a 中 b a"], [""]])
def test_counts(texts):
    wanted = ["a", "b", "é", "中", "abc"]
    n, at, term, tf = search.count_terms(search.automaton_of(wanted), [t.encode() for t in texts])
    plain_counts = [Counter(terms(t)) for t in texts]
    assert n.tolist() == [c.total() for c in plain_counts]
    got = {(a, wanted[t]): k for a, t, k in zip(at.tolist(), term.tolist(), tf.tolist())}
    assert got == {(k, t): c[t] for k, c in enumerate(plain_counts) for t in wanted if c[t]}
