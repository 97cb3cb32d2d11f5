"""Scoring, language identification, HTML extraction and embeddings."""

from __future__ import annotations

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from coverledger.llm import embeddings, html, language, scoring
from tests.llm.cases import SCHEMA, empty_docs, odd_docs, odd_rows
from tests.llm.test_dedup import classes_of


def test_levels():
    counts = np.arange(1, 5000)
    for base in (scoring.PAIR_BASE, scoring.WORD_BASE):
        level = scoring.level_of(counts, base)
        assert (scoring.least_count(level, base) <= counts).all()
        assert (counts <= scoring.most_count(level, base)).all()


def test_filter_never_underrates():
    rng = np.random.default_rng(1)
    keys = rng.integers(0, 2**63, 20_000).astype(np.uint64) * np.uint64(scoring.SEGMENTS)
    counts = rng.geometric(0.3, len(keys))
    bits, least = scoring.build_segment(keys, counts, 1.5, 1 << 20)
    assert least == 1
    table = np.zeros((scoring.SEGMENTS, 1 << 17), np.uint8)
    table[0] = np.frombuffer(bits, np.uint8)
    filter_ = scoring.Filter(table, 1.5)
    assert (filter_.levels(keys) >= scoring.level_of(counts, 1.5)).all()
    assert (filter_.levels(keys) > scoring.level_of(counts, 1.5)).mean() < 0.03
    assert (filter_.levels(keys + np.uint64(scoring.SEGMENTS)) > 0).mean() < 0.03
    _, small = scoring.build_segment(keys, counts, 1.5, 1 << 17)
    assert small > 1  # rarer keys stay out of a segment that is too small for all


def plain_base(rows):
    tokens = lambda t: (t or "").encode().lower().split() + [b" "]
    held = lambda r: zlib.crc32(b"" if r[0] is None else str(r[0]).encode()) % 7 == 2
    counts = Counter(w for r in rows if not held(r) for w in tokens(r[1]))
    n, v = counts.total(), len(counts)
    return Counter(
        (
            r[0],
            held(r),
            len(ws := tokens(r[1])),
            sum(counts[w] > 0 for w in ws),
            n,
            round(sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in ws), 5),
        )
        for r in rows
    )


def test_scores(spark, monkeypatch):
    monkeypatch.setattr(scoring, "COMMON", 6)  # so that most counts come by the join
    small = {"pair_bits": 1 << 22, "word_bits": 1 << 21}
    got = scoring.score(odd_docs(spark), **small).collect()
    found = Counter((*r[:5], round(r["base_score"], 5)) for r in got)
    assert found == plain_base(odd_rows())
    assert all(r["score"] < 0 and math.isfinite(r["score"]) for r in got)
    assert scoring.score(empty_docs(spark), **small).count() == 0


def test_scores_beat_words_alone(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = scoring.score(docs, pair_bits=1 << 24, word_bits=1 << 22).filter("held_out").collect()
    assert sum(r["score"] for r in rows) > sum(r["base_score"] for r in rows)


def test_probabilities_of_a_context_add_up_to_one_at_most(spark):
    text = "a b a c a b d a"
    df = spark.createDataFrame([(text,)], "text string")
    counted = scoring._counted(df).toPandas()
    pairs, least = scoring._pair_filter(scoring.cut(scoring._counted(df)), 1 << 22)
    words = counted[counted.word.notna()][["word", "n"]]
    frame = spark.createDataFrame(words)
    filter_ = scoring._word_filter(frame, 1 << 21)
    model = scoring.Model(9, 5, {}, filter_, pairs, least, 9.0, np.full(scoring.LEVELS + 1, 0.5))
    hashes = scoring.Hashes()
    for before in (b"a", b"b"):
        total = 0.0
        for after in (b"a", b"b", b"c", b"d", b" "):
            own = np.array([hashes[before], hashes[after]], np.uint64)
            total += 10 ** model.logs(own, filter_.levels(own))[1]
        assert 0.5 < total <= 1.0


def plain_viterbi(scores, switch):
    best, back = scores[0].astype(float), []
    for row in scores[1:]:
        came = [max(range(len(row)), key=lambda k: best[k] - switch * (k != j)) for j in range(len(row))]
        best = np.array([best[k] - switch * (k != j) + row[j] for j, k in enumerate(came)])
        back.append(came)
    state = int(best.argmax())
    score = best[state]
    path = [state]
    for came in reversed(back):
        path.append(came[path[-1]])
    return path[::-1], score


def test_viterbi():
    rng = np.random.default_rng(4)
    lengths = np.array([0, 1, 5, 40, 3, 0, 40])
    scores = -rng.integers(0, 9, (int(lengths.sum()), 3)).astype(np.float32)
    path = language.viterbi(scores, lengths, 6.0)
    at = 0
    for n in lengths:
        if n:
            own = scores[at : at + n]
            _, best = plain_viterbi(own, 6.0)
            mine = own[np.arange(n), path[at : at + n]].sum() - 6.0 * np.count_nonzero(np.diff(path[at : at + n]))
            assert mine == pytest.approx(best)
        at += n


def test_language_accuracy_and_spans(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = language.train(docs.filter(language.learned_from("doc_id")))
    rows = language.identify(docs, model).filter(~language.learned_from("doc_id")).collect()
    assert np.mean([r["lang"] == r["lang_pred"] for r in rows]) > 0.95
    texts = {r["lang"]: r["text"] for r in rows if len(r["text"].split()) > 60}
    mixed = " ".join(texts["en"].split()[:50] + texts["de"].split()[:60])
    pred, score, spans = language.Labeller(model).label([mixed])[0]
    assert pred == "de" and 0.4 < score < 0.7 and [s[0] for s in spans] == ["en", "de"]
    assert abs(spans[1][1] - 50) <= 3


def test_script_ranges_narrow_candidates():
    counts = np.ones((2, language.CELLS))
    scripts = np.zeros((2, len(language._NAMES)))
    scripts[0, 0], scripts[1, 2] = 100, 100
    model = language.Model(["la", "cy"], counts, scripts)
    assert model.scores(["abc", "где", "", "中"]).argmax(axis=1).tolist() == [0, 1, 0, 0]


def test_language_of_odd_tables(spark):
    docs = odd_docs(spark)
    model = language.train(docs)
    got = language.identify(docs, model)
    rows = got.collect()
    assert got.columns == [*docs.columns, "lang_pred", "score", "lang_spans"]
    assert len(rows) == len(odd_rows())
    for r in rows:
        none = not any(c.isalpha() for c in r["text"] or "")
        assert (r["lang_pred"] == "und") == none and 0 <= r["score"] <= 1
    kept = language.accepted_documents(docs)
    assert kept.columns == docs.columns
    assert kept.count() == sum(any(c.isalpha() for c in r["text"] or "") for r in rows)
    assert language.accepted_documents(empty_docs(spark)).count() == 0


PAGE = """<!DOCTYPE html><html><head><title>no</title><style>p{}</style></head><body>
<header class="top"><h1>Site</h1></header><nav><ul><li><a href="/">Home</a></li></ul></nav>
<div id="cookie-notice">We use cookies a lot and tell you so at length.</div>
<div class="wrap"><div class="content"><h2>Title &amp; more</h2>
<p>First <b>par</b>agraph with   enough words to count, and a <a href="x">link</a>.
<p>Second one,<br>broken line&nbsp;here &#8212; fine.</p><table><tr><td>a<td>b</table>
<script>var t = "</p>";</script><ul class="related"><li><a>x</a></ul><form>Your name</form></div></div>
<div class="comments"><p>A long reader comment that should never be part of the text.</p></div>
<aside>Side</aside><footer>&copy; foot</footer>"""


def test_main_text():
    assert html.main_text(PAGE) == (
        "Title & more\nFirst paragraph with enough words to count, and a link.\n"
        "Second one, broken line here — fine.\na\nb"
    )


@pytest.mark.parametrize("page", ["", "   ", "<p", "<!-- x", "<div class='", "<script>x", "</p></div>", "<p>" * 3000])
def test_broken_pages_give_no_text(page):
    assert html.main_text(page) == ""


def test_text_of_given_pages(spark, sf_dir):
    import re
    from html import unescape

    rows = html.extract(spark.read.parquet(f"{sf_dir}/pages.parquet")).collect()
    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    assert len(rows) == len(pages)
    for r in rows:
        inner = re.search("<article>(.*?)</article>", pages[r["page_id"]], re.S)[1].replace("<br>", " ")
        blocks = (unescape(re.sub("<[^>]+>", "", b)).split() for b in re.split("</?(?:p|h1)>", inner))
        assert r["text"] == "\n".join(" ".join(b) for b in blocks if b)
        assert r["n_chars"] == len(r["text"])


def test_odd_pages(spark):
    pages = spark.createDataFrame([(1, None, None), (None, "u", ""), (None, "u", "x")], "page_id long, url string, html string")
    got = sorted((str(r["page_id"]), r["url"], r["text"], r["n_chars"]) for r in html.extract(pages).collect())
    assert got == [("1", None, "", 0), ("None", "u", "", 0), ("None", "u", "x", 1)]
    assert html.extract(pages.limit(0)).count() == 0


def vectors():
    rng = np.random.default_rng(6)
    rows, k = [], 0
    for dim in (20, 7):
        for _ in range(12):
            centre = rng.standard_normal(dim)
            for _ in range(12):
                v = centre + rng.standard_normal(dim) * rng.choice([0.05, 0.12, 0.2])
                rows.append((k, v.astype(np.float32).tolist(), int(k % 2)))
                k += 1
    same = rows[0][1]
    rows += [(k + i, same, 0) for i in range(5)]
    odd = [None, [], [0.0] * 20, [float("nan")] * 20, [float("inf")] + [1.0] * 19, [None] + [1.0] * 19]
    rows += [(k + 10 + i, v, 0) for i, v in enumerate(odd)]
    rows += [(k + 30, same, None), (None, same, 0), (None, None, 0), (3, rows[3][1], rows[3][2])]
    return rows


def test_embeddings(spark, monkeypatch):
    monkeypatch.setattr(embeddings, "CELL", 40)  # grids of several dimensions
    monkeypatch.setattr(embeddings, "PART", 30)  # cells in parts
    rows = vectors()
    fine = [
        k
        for k, (_, v, label) in enumerate(rows)
        if label is not None and v and None not in v and np.isfinite(v).all() and any(v)
    ]
    links = []
    for a in fine:
        for b in fine:
            x, y = np.array(rows[a][1]), np.array(rows[b][1])
            if a < b and len(x) == len(y) and rows[a][2] == rows[b][2]:
                if x @ y / math.sqrt(x @ x) / math.sqrt(y @ y) >= 0.98:
                    links.append((a, b))
    degree = Counter(n for p in links for n in p)
    root = classes_of(links, range(len(rows)))
    least = {}
    for k, r in enumerate(rows):
        if r[0] is not None:
            least[root[k]] = min(r[0], least.get(root[k], r[0]))
    want = Counter(
        (r[0], degree[k], least.get(root[k]), r[0] == least.get(root[k])) for k, r in enumerate(rows)
    )
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").repartition(4)
    assert len(links) > 300
    assert Counter(tuple(r) for r in embeddings.near_vectors(df).collect()) == want
    assert embeddings.near_vectors(df.limit(0)).count() == 0


def test_every_pair_meets_in_the_grid():
    rng = random.Random(8)
    np_rng = np.random.default_rng(8)
    base = np_rng.standard_normal((300, 24))
    vectors_ = np.concatenate([base, base + np_rng.standard_normal(base.shape) * 0.12])
    norm = np.sqrt((vectors_**2).sum(1))
    near = (vectors_ @ vectors_.T / norm[:, None] / norm[None, :] >= 0.98) & ~np.eye(600, dtype=bool)
    found = Counter()
    for grid in (rng.randint(1, 3),):
        cells = {}
        for block, at, code, home in embeddings._tiles(embeddings.rotated(vectors_), grid, 0.98):
            for r, c in zip(at.tolist(), code.tolist()):
                cells.setdefault((block, c), ([], []))[not home].append(r)
        for (block, _), (own, visiting) in cells.items():
            if own:
                for a, b in embeddings.linked_pairs(np.array(own), np.array(visiting, int), vectors_, block, 0.98):
                    found.update(zip(np.minimum(a, b).tolist(), np.maximum(a, b).tolist()))
    assert found == Counter((int(a), int(b)) for a, b in zip(*np.nonzero(np.triu(near))))


def test_scripts_are_those_of_the_letters_names():
    import unicodedata

    words = {
        "Devanagari": "हिन्दी", "Tamil": "தமிழ்", "Bengali": "বাংলা", "Sinhala": "සිංහල", "Greek": "ἀρχῇ",
        "Arabic": "ﻋﺮﺑﻲ", "Hebrew": "שﬡ", "Cyrillic": "Ꙗзыкъ", "Han": "語豈𠀀", "Kana": "カナｶﾅ", "Latin": "straßeẞꜳ",
    }
    for script, word in words.items():
        points = np.array([ord(c) for c in word if c.isalpha()])
        found = language.SCRIPT_OF_RANGE[np.searchsorted(language.SCRIPTS, points, side="right") - 1]
        assert {language._NAMES[k] for k in found} == {script}
    assert list(language.SCRIPTS) == sorted(language.SCRIPTS) and len(language._NAMES) < 63
    for c in range(0x10000):
        name = unicodedata.name(chr(c), "")
        for script in ("TAMIL", "BENGALI", "DEVANAGARI", "CYRILLIC", "ARABIC", "GEORGIAN", "ETHIOPIC"):
            if chr(c).isalpha() and name.startswith(f"{script} ") and not 0x1D00 <= c < 0x1DC0:
                at = np.searchsorted(language.SCRIPTS, c, side="right") - 1
                assert language._NAMES[language.SCRIPT_OF_RANGE[at]].upper() == script, hex(c)


def test_copies_weigh_no_more_than_one_text(spark):
    rows = [("der hund und die katze", "de")] * 50 + [("der tag und die nacht", "de"), ("the dog and the cat", "en")]
    docs = spark.createDataFrame(rows, "text string, lang string")
    many, once = language.train(docs), language.train(docs.distinct())
    assert many.languages == once.languages and (many.table == once.table).all()
