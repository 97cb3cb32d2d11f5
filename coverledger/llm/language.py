"""Language identification: script ranges, n-gram scores per word, and Viterbi over the words."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from coverledger.llm.common import cut, scanned

#: Learned documents of a language on average, as a bound on the sample.
SAMPLE = 4000
#: Rows and characters that are labelled together, words whose scores a worker remembers, and new
#: words that are scored together.
TOGETHER, CHARACTERS, REMEMBERED, SCORED = 300, 2 << 20, 150_000, 20_000
#: Cells of the hashed n-gram table, and the longest n-gram in characters.
CELLS, LONGEST = 1 << 17, 4
#: Log-probability that a change of language costs, and the most a word can say for one language.
SWITCH, CLIP = 6.0, 8.0
#: A script counts for a language if so large a share of its letters is written in it.
SCRIPT_SHARE = 0.001
UNDETERMINED = "und"

#: First code points of ranges of Unicode blocks, and the script their letters are of.
RANGES = [
    (0x0000, "Latin"), (0x0370, "Greek"), (0x0400, "Cyrillic"), (0x0530, "Armenian"), (0x0590, "Hebrew"),
    (0x0600, "Arabic"), (0x0700, "Syriac"), (0x0750, "Arabic"), (0x0780, "Thaana"), (0x07C0, "Nko"),
    (0x0800, "Samaritan"), (0x0860, "Syriac"), (0x0870, "Arabic"), (0x0900, "Devanagari"),
    (0x0980, "Bengali"), (0x0A00, "Gurmukhi"), (0x0A80, "Gujarati"), (0x0B00, "Oriya"), (0x0B80, "Tamil"),
    (0x0C00, "Telugu"), (0x0C80, "Kannada"), (0x0D00, "Malayalam"), (0x0D80, "Sinhala"), (0x0E00, "Thai"),
    (0x0E80, "Lao"), (0x0F00, "Tibetan"), (0x1000, "Myanmar"), (0x10A0, "Georgian"), (0x1100, "Hangul"),
    (0x1200, "Ethiopic"), (0x13A0, "Cherokee"), (0x1400, "Syllabics"), (0x1680, "other"), (0x1780, "Khmer"),
    (0x1800, "Mongolian"), (0x18B0, "Syllabics"), (0x1900, "other"), (0x19E0, "Khmer"), (0x1A00, "other"),
    (0x1C80, "Cyrillic"), (0x1C90, "Georgian"), (0x1CC0, "other"), (0x1D00, "Latin"), (0x1F00, "Greek"),
    (0x2000, "other"), (0x2071, "Latin"), (0x20A0, "other"), (0x2C00, "Glagolitic"), (0x2C60, "Latin"),
    (0x2C80, "Coptic"), (0x2D00, "Georgian"), (0x2D30, "Tifinagh"), (0x2D80, "Ethiopic"),
    (0x2DE0, "Cyrillic"), (0x2E00, "other"), (0x2E80, "Han"), (0x3040, "Kana"), (0x3100, "Bopomofo"),
    (0x3130, "Hangul"), (0x3190, "Han"), (0x31A0, "Bopomofo"), (0x31C0, "Han"), (0x31F0, "Kana"),
    (0x3200, "other"), (0x3400, "Han"), (0xA000, "Yi"), (0xA4D0, "other"), (0xA640, "Cyrillic"),
    (0xA6A0, "other"), (0xA720, "Latin"), (0xA800, "other"), (0xA8E0, "Devanagari"), (0xA900, "other"),
    (0xA960, "Hangul"), (0xA980, "other"), (0xA9E0, "Myanmar"), (0xAA00, "other"), (0xAA60, "Myanmar"),
    (0xAA80, "other"), (0xAB00, "Ethiopic"), (0xAB30, "Latin"), (0xAB70, "Cherokee"), (0xABC0, "other"),
    (0xAC00, "Hangul"), (0xD800, "other"), (0xF900, "Han"), (0xFB00, "Latin"), (0xFB13, "Armenian"),
    (0xFB1D, "Hebrew"), (0xFB50, "Arabic"), (0xFE00, "other"), (0xFE70, "Arabic"), (0xFF00, "Latin"),
    (0xFF66, "Kana"), (0xFFA0, "Hangul"), (0xFFE0, "other"), (0x1B000, "Kana"), (0x1B170, "other"),
    (0x20000, "Han"), (0x323B0, "other"),
]
_NAMES = list(dict.fromkeys(name for _, name in RANGES))
SCRIPTS = np.array([first for first, _ in RANGES])
SCRIPT_OF_RANGE = np.array([_NAMES.index(name) for _, name in RANGES])


def letters(word: str) -> str:
    return "".join(filter(str.isalpha, word)).lower()


def features(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashed n-grams of letter-only words: word number, cell, and each word's script mask."""
    padded = " " + " ".join(words) + " "
    points = np.frombuffer(padded.encode("utf-32-le"), np.uint32).astype(np.uint64)
    blank = points == 32
    number = np.cumsum(blank) - 1
    of_word, cells = [], []
    with np.errstate(over="ignore"):
        for n in range(1, LONGEST + 1):
            gram = np.zeros(len(points) - n + 1, np.uint64)
            inner = np.zeros(len(gram), bool)
            for k in range(n):
                gram = gram * np.uint64(0x100000001B3) + points[k : k + len(gram)]
                if 0 < k < n - 1:
                    inner |= blank[k : k + len(gram)]
            gram = (gram + np.uint64(n)) * np.uint64(0x9E3779B97F4A7C15)
            own = ~inner & ~blank[: len(gram)] if n == 1 else ~inner
            if n == 2:
                own &= ~(blank[:-1] & blank[1:])
            at = np.flatnonzero(own)
            # An n-gram that starts with the blank before a word belongs to that word.
            of_word.append(number[at])
            cells.append((gram[at] >> np.uint64(40)) % np.uint64(CELLS))
    script = SCRIPT_OF_RANGE[np.searchsorted(SCRIPTS, points, side="right") - 1]
    masks = np.zeros(len(words), np.int64)
    np.bitwise_or.at(masks, number[~blank], 1 << script[~blank])
    return np.concatenate(of_word), np.concatenate(cells).astype(np.int64), masks


class Model:
    """Naive Bayes over the n-grams of a word, among the languages written in its scripts."""

    def __init__(self, languages: list[str], counts: np.ndarray, scripts: np.ndarray):
        self.languages = languages
        smooth = counts + 0.5
        self.table = np.log(smooth / smooth.sum(axis=1, keepdims=True)).T.astype(np.float32)
        share = scripts / np.maximum(scripts.sum(axis=1, keepdims=True), 1)
        self.uses = ((share >= SCRIPT_SHARE) << np.arange(scripts.shape[1])).sum(axis=1)

    def scores(self, words: list[str]) -> np.ndarray:
        """A row per word: log-odds of each language against the best one, CLIP below at most.

        Languages that use none of the word's scripts are out, unless none uses them. A word
        without letters says nothing.
        """
        out = np.zeros((len(words), len(self.languages)), np.float32)
        held = [k for k, w in enumerate(words) if w]
        if not held:
            return out
        number, cell, masks = features([words[k] for k in held])
        sums = np.zeros((len(held), len(self.languages)))
        for lang in range(len(self.languages)):
            sums[:, lang] = np.bincount(number, self.table[cell, lang], minlength=len(held))
        fits = (masks[:, None] & self.uses[None, :]) != 0
        fits |= ~fits.any(axis=1, keepdims=True)
        sums -= sums.max(axis=1, keepdims=True, where=fits, initial=-np.inf)
        out[held] = np.where(fits, np.maximum(sums, -CLIP), -2 * CLIP)
        return out


def viterbi(scores: np.ndarray, lengths: np.ndarray, switch: float = SWITCH) -> np.ndarray:
    """The best language of every word. ``scores`` holds the texts' words one after another.

    All texts go forward together, longest first, a word at a time: staying is free, changing
    costs ``switch``. Ties go to the language that comes first.
    """
    order = np.argsort(-lengths, kind="stable")
    size = lengths[order]
    begin = (np.cumsum(lengths) - lengths)[order]
    best = np.zeros((len(size), scores.shape[1]), np.float32)
    longest = int(size[0]) if len(size) else 0
    alive = np.searchsorted(-size, -np.arange(longest), side="left")
    came = np.zeros(scores.shape, np.int16)
    own = np.arange(scores.shape[1], dtype=np.int16)
    for t in range(longest):
        n = alive[t]
        at = begin[:n] + t
        if t:
            top = best[:n].argmax(axis=1)
            other = best[np.arange(n), top] - switch
            stay = best[:n] >= other[:, None]
            came[at] = np.where(stay, own, top[:, None].astype(np.int16))
            best[:n] = np.where(stay, best[:n], other[:, None]) + scores[at]
        else:
            best[:n] = scores[at]
    path = np.zeros(len(scores), np.int16)
    state = best.argmax(axis=1)
    for t in range(longest - 1, -1, -1):
        n = alive[t]
        at = begin[:n] + t
        path[at] = state[:n]
        state[:n] = came[at, state[:n]]
    return path


def train(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang") -> Model:
    """Fit the n-gram counts on a sample of about SAMPLE labelled documents of each language.

    The sample is chosen by a hash of the text, at a rate per language that makes its expected
    size SAMPLE at most; copies of a text count once, so a large group of them weighs no more. A task returns one table of counts per language, so what reaches the
    driver has the size of the model: languages x (cells + scripts).
    """
    known = labelled.filter(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    sizes = {r["lang"]: r["n"] for r in known.groupBy(F.col(lang_col).alias("lang")).agg(F.count("*").alias("n")).collect()}  # fmt: skip  # noqa: E501
    languages = sorted(sizes)
    if not languages:
        return Model([], np.zeros((0, CELLS)), np.zeros((0, len(_NAMES))))
    rates = F.create_map(*(x for k, n in sizes.items() for x in (F.lit(k), F.lit(min(1.0, SAMPLE / n)))))
    draw = F.shiftrightunsigned(F.xxhash64(F.lit("sample"), text_col), 11) / float(1 << 53)
    sample = known.filter(draw < F.element_at(rates, F.col(lang_col)))
    sample = sample.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text")).distinct()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = [w for w in map(letters, text.split()) if w]
                if words:
                    if lang not in tables:
                        tables[lang] = np.zeros(CELLS + len(_NAMES), np.int64)
                    number, cell, _ = features(words)
                    tables[lang][:CELLS] += np.bincount(cell, minlength=CELLS)
                    points = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
                    script = SCRIPT_OF_RANGE[np.searchsorted(SCRIPTS, points, side="right") - 1]
                    tables[lang][CELLS:] += np.bincount(script, minlength=len(_NAMES))
        rows = [(k, i, int(t[i])) for k, t in tables.items() for i in np.flatnonzero(t).tolist()]
        lang, cell, n = zip(*rows) if rows else ((), (), ())
        yield pa.RecordBatch.from_arrays(
            [pa.array(lang, pa.string()), pa.array(cell, pa.int32()), pa.array(n, pa.int64())],
            ["lang", "cell", "n"],
        )

    counted = scanned(sample, count, "lang string, cell int, n long")
    table = counted.groupBy("lang", "cell").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros((len(languages), CELLS + len(_NAMES)))
    counts[table["lang"].map({k: i for i, k in enumerate(languages)}), table["cell"]] = table["n"]
    return Model(languages, counts[:, :CELLS], counts[:, CELLS:])


class Labeller:
    """Labels the words of texts; remembers the scores of a bounded number of words."""

    def __init__(self, model: Model):
        self.model = model
        self.number: dict[str, int] = {}
        self.rows = np.zeros((0, len(model.languages)), np.float32)
        self.has_letters = np.zeros(0, bool)

    def words(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Lengths of the texts in words, and the number of every word."""
        if len(self.number) > REMEMBERED:
            self.__init__(self.model)
        split = [t.split() for t in texts]
        new = list({w for ws in split for w in ws if w not in self.number})
        if new:
            plain = list(map(letters, new))
            self.number.update(zip(new, range(len(self.number), len(self.number) + len(new))))
            parts = [self.model.scores(plain[k : k + SCORED]) for k in range(0, len(plain), SCORED)]
            self.rows = np.concatenate([self.rows, *parts])
            self.has_letters = np.concatenate([self.has_letters, np.array([bool(w) for w in plain])])
        lengths = np.array([len(ws) for ws in split])
        number = self.number.__getitem__
        ids = np.fromiter((number(w) for ws in split for w in ws), np.int64, int(lengths.sum()))
        return lengths, ids

    def label(self, texts: list[str], switch: float = SWITCH) -> list[tuple[str, float, list]]:
        """For each text: language, score, and spans (language, first word, words)."""
        lengths, ids = self.words(texts)
        if not self.model.languages:
            return [(UNDETERMINED, 0.0, [])] * len(texts)
        path = viterbi(self.rows[ids], lengths, switch)
        counted = self.has_letters[ids]
        out, begin = [], 0
        for n in lengths.tolist():
            own, real = path[begin : begin + n], counted[begin : begin + n]
            votes = np.bincount(own[real], minlength=len(self.model.languages))
            if votes.sum():
                top = int(votes.argmax())
                starts = np.concatenate(([0], np.flatnonzero(np.diff(own)) + 1))
                spans = [
                    (self.model.languages[own[a]], int(a), int(b - a))
                    for a, b in zip(starts, np.append(starts[1:], n))
                ]
                out.append((self.model.languages[top], float(votes[top] / votes.sum()), spans))
            else:
                out.append((UNDETERMINED, 0.0, []))
            begin += n
        return out


SPANS = "array<struct<lang:string,first:int,words:int>>"


def identify(docs: DataFrame, model: Model, text_col: str = "text", switch: float = SWITCH) -> DataFrame:
    """Adds ``lang_pred``, ``score`` (share of the words with letters) and ``lang_spans``.

    Text and model alone decide. A null text, one without letters, and every text under a model
    that has learned no language are UNDETERMINED with score 0 and no spans. All other columns
    pass unchanged, whatever their names; rows keep their order and number. A text is labelled
    whole; texts of one batch go together, in groups of a bounded number of words.
    """
    names = [f"c{k}" for k in range(len(docs.columns))]
    plain = docs.toDF(*names)
    at = docs.columns.index(text_col)
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in plain.schema.fields)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labeller = Labeller(model)
        pieces = (b.slice(k, TOGETHER) for b in batches for k in range(0, b.num_rows, TOGETHER))
        for batch in pieces:
            texts = [t or "" for t in batch.column(at).to_pylist()]
            found, group, size = [], [], 0
            for text in texts:
                group.append(text)
                size += len(text)
                if size > CHARACTERS:
                    found += labeller.label(group, switch)
                    group, size = [], 0
            if group:
                found += labeller.label(group, switch)
            lang, score, spans = zip(*found) if found else ((), (), ())
            fields = [("lang", pa.string()), ("first", pa.int32()), ("words", pa.int32())]
            spans = [[dict(zip(("lang", "first", "words"), s)) for s in own] for own in spans]
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns,
                    pa.array(lang, pa.string()),
                    pa.array(score, pa.float64()),
                    pa.array(spans, pa.list_(pa.struct(fields))),
                ],
                [*names, "lang_pred", "score", "lang_spans"],
            )

    labelled = scanned(plain, scan, f"{kinds}, lang_pred string, score double, lang_spans {SPANS}")
    return labelled.toDF(*docs.columns, "lang_pred", "score", "lang_spans")


def learned_from(id_col: str = "doc_id") -> Column:
    """Whether a document may be learned from: its fold by checksum is not the held-out one."""
    return F.crc32(F.encode(F.col(id_col).cast("string"), "UTF-8")) % 3 != 1


def accepted_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:  # fmt: skip  # noqa: E501
    """The documents whose language can be told, with that language in ``lang_col``.

    Learns from the documents that carry a language (without the held-out fold). Rejects texts
    that are null or have no letters; if nothing is labelled, no document can be told.
    """
    model = train(docs.filter(learned_from(id_col)), text_col, lang_col)
    labelled = identify(docs, model, text_col).filter(F.col("lang_pred") != UNDETERMINED)
    return labelled.select(*(F.col("lang_pred").alias(c) if c == lang_col else c for c in docs.columns))
