"""Ranked lexical search: one automaton of all queries' terms scans the documents' texts."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from coverledger.llm.common import cut, groups, scanned

#: Letters and digits of ASCII and everything beyond it; only A-Z is lower-cased.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: Documents of a ranking.
TOP = 20
#: Bytes of queries, and a few for each, that go into one automaton and one broadcast; more go by
#: further scans.
BLOCK, EACH = 2 << 20, 64
#: Bytes of text that are scanned at once, and additions or numbers of a score table made at once.
AT_ONCE, SCORES = 1 << 20, 1 << 20
#: Parts into which a query's candidates are dealt before the last ranking.
PARTS = 64

# What a byte becomes: a letter or digit itself in lower case, what parts terms a blank.
_GUARD = bytes(
    b | 0x20 if 0x41 <= b <= 0x5A else b if b >= 0x80 or chr(b).isalnum() else 0x20
    for b in range(256)
)


def _terms(text_col: str):
    """The terms of a text, with A-Z lower-cased."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    text = F.translate(F.coalesce(F.col(text_col), F.lit("")), upper, lower)
    return F.regexp_extract_all(text, F.lit(TERM), F.lit(0))


def _blocks(items: DataFrame, item_col: str, text_col: str) -> tuple[DataFrame, int]:
    """The queries with a block number, and how many blocks there are.

    Blocks are dealt by a hash of the query's id and made more until each holds at most ``BLOCK``
    bytes, or one query that is larger by itself.
    """
    size = F.octet_length(F.coalesce(F.col(text_col), F.lit(""))) + EACH
    items = items.select(F.col(item_col).alias("item"), F.col(text_col).alias("text"), size.alias("size"))
    per_item = items.groupBy("item").agg(F.sum("size").alias("size"))
    count = max(1, -(-(per_item.agg(F.sum("size")).collect()[0][0] or 0) // BLOCK))
    while True:
        block = F.pmod(F.xxhash64("item"), F.lit(count))
        held = per_item.groupBy(block.alias("block")).agg(F.sum("size").alias("size"), F.count("*").alias("n"))
        if held.filter((F.col("size") > BLOCK) & (F.col("n") > 1)).isEmpty():
            return items.withColumn("block", block), count
        count *= 2


def _postings(items: DataFrame) -> tuple[list, list[str], np.ndarray, np.ndarray, np.ndarray]:
    """A block's items, distinct terms, and for every term the items that hold it, as index rows.

    Returns the items' ids, the terms, where each term's rows begin, and the rows' item and count.
    """
    rows = items.select("item", F.explode(_terms("text")).alias("term"))
    found = rows.groupBy("term", "item").agg(F.count("*").alias("n")).collect()  # of one block
    ids = list(dict.fromkeys(r["item"] for r in found))
    number = {item: k for k, item in enumerate(ids)}
    found.sort(key=lambda r: r["term"])
    terms = list(dict.fromkeys(r["term"] for r in found))
    place = {t: k for k, t in enumerate(terms)}
    per_term = np.bincount([place[r["term"]] for r in found], minlength=len(terms))
    begin = np.append(0, np.cumsum(per_term))
    item = np.array([number[r["item"]] for r in found], np.int64)
    return ids, terms, begin, item, np.array([r["n"] for r in found], np.int64)


def automaton_of(terms: list[str]):
    """An automaton of the terms between blanks, which gives a term's number."""
    import ahocorasick

    found = ahocorasick.Automaton()
    for k, term in enumerate(terms):
        found.add_word(f" {term} ", k)
    found.make_automaton()
    return found


def count_terms(automaton, texts: list[bytes]) -> tuple[np.ndarray, ...]:
    """Term counts of UTF-8 texts: the number of all terms of each text, and of each text and
    automaton term that meet, the text's place, the term's number and its occurrences.

    Texts are guarded by blanks on both sides and joined; what the automaton finds in the joined
    text is dealt to the texts by place.
    """
    joined = b" " + b" ".join(t.translate(_GUARD) + b" " for t in texts)
    data = np.frombuffer(joined, np.uint8)
    begun = np.flatnonzero((data[:-1] == 0x20) & (data[1:] != 0x20)) + 1
    sizes = np.fromiter((len(t) + 2 for t in texts), np.int64, len(texts))
    bounds = np.append(0, np.cumsum(sizes))
    n = np.diff(np.searchsorted(begun, bounds))
    text = joined.decode("utf-8")
    if len(text) != len(joined):  # places are code points' there
        ahead = np.cumsum((data & 0xC0) != 0x80)
        bounds = np.append(0, ahead)[bounds]
    hits = np.fromiter(automaton.iter(text), np.dtype((np.int64, 2)))
    at = np.searchsorted(bounds, hits[:, 0], side="right") - 1
    key, tf = np.unique(at * len(automaton) + hits[:, 1], return_counts=True)
    return n, key // len(automaton), key % len(automaton), tf


def counted(docs: DataFrame, automaton, id_col: str, text_col: str) -> DataFrame:
    """``id``, ``n``, ``terms`` and ``tfs`` of every document, counted from its text."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).cast(pa.binary()).to_pylist()
            sizes = np.fromiter(map(len, texts), np.int64, len(texts))
            for a, b in groups(sizes, AT_ONCE):
                n, at, term, tf = count_terms(automaton.value, texts[a:b])
                bounds = pa.array(np.searchsorted(at, np.arange(b - a + 1)), pa.int32())
                columns = [
                    batch.column(0).slice(a, b - a),
                    pa.array(n, pa.int64()),
                    pa.ListArray.from_arrays(bounds, pa.array(term, pa.int32())),
                    pa.ListArray.from_arrays(bounds, pa.array(tf, pa.int64())),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["id", "n", "terms", "tfs"])

    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(text_col, F.lit("")).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    return scanned(rows, work, f"id {kind}, n long, terms array<int>, tfs array<long>")


def weights(df: np.ndarray, documents: int) -> np.ndarray:
    return np.floor(1000 * np.log((2 * documents + 2) / (2 * df + 1))).astype(np.int64)


def _best(rows: pa.Table, top: int) -> pa.Table:
    """The first ``top`` rows of every item: highest score, then smallest id, null ids last."""
    keys = [("item", "ascending"), ("score", "descending"), ("id", "ascending")]
    rows = rows.take(pc.sort_indices(rows, sort_keys=keys, null_placement="at_end"))
    item = np.asarray(rows["item"])
    first = np.append(True, item[1:] != item[:-1]) if len(item) else np.zeros(0, bool)
    begun = np.maximum.accumulate(np.where(first, np.arange(len(item)), 0))
    return rows.filter(pa.array(np.arange(len(item)) - begun < top))


def _scored(
    counts: DataFrame,
    weight: np.ndarray,
    postings: tuple[np.ndarray, np.ndarray, np.ndarray],
    n_items: int,
    documents: int,
    length: int,
    top: int,
) -> DataFrame:
    """Each task's best documents of every item: ``item`` (its place), ``id``, ``score``."""
    spark = counts.sparkSession
    shared = spark.sparkContext.broadcast((weight, *postings))
    kind = counts.schema["id"].dataType

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weight, begin, item_of, repeats = shared.value
        per_term = np.diff(begin)
        held, least = None, np.zeros(n_items, np.int64)
        for batch in batches:
            n = np.asarray(batch.column(1), np.int64)
            m = 100 - 25 + (25 * n * documents) // length
            per_doc = np.asarray(batch.column(2).value_lengths(), np.int64)
            doc = np.repeat(np.arange(len(n)), per_doc)
            term, tf = (np.asarray(batch.column(k).flatten(), np.int64) for k in (2, 3))
            gain = weight[term] * ((1_000_000_000 * tf) // (1000 * tf + 12 * m[doc]))
            steps = np.bincount(doc, per_term[term], len(n)).astype(np.int64)
            for a, b in groups(np.maximum(steps, n_items), SCORES):
                rows = b - a
                x, y = np.searchsorted(doc, [a, b])
                many = per_term[term[x:y]]
                within = np.arange(int(many.sum())) - np.repeat(np.cumsum(many) - many, many)
                post = np.repeat(begin[term[x:y]], many) + within
                score = np.zeros(rows * n_items, np.int64)
                cell = np.repeat(doc[x:y] - a, many) * n_items + item_of[post]
                np.add.at(score, cell, np.repeat(gain[x:y], many) * repeats[post])
                score = score.reshape(rows, n_items)
                at, item = np.nonzero((score > 0) & (score >= least))
                if len(at):
                    new = pa.table(
                        {
                            "item": pa.array(item, pa.int64()),
                            "id": batch.column(0).take(pa.array(a + at)),
                            "score": pa.array(score[at, item], pa.int64()),
                        }
                    )
                    held = _best(new if held is None else pa.concat_tables([held, new]), top)
                    places, first, count = np.unique(
                        np.asarray(held["item"]), return_index=True, return_counts=True
                    )
                    full = count == top
                    least[places[full]] = np.asarray(held["score"])[(first + top - 1)[full]]
        if held is not None:
            yield from held.combine_chunks().to_batches()

    return counts.mapInArrow(work, f"item long, id {kind.simpleString()}, score long")


def _ranked(rows: DataFrame, top: int) -> DataFrame:
    """The ranks within an item; first within parts of its candidates, then among the best of those."""
    order = [F.desc("score"), F.asc_nulls_last("id")]
    parts = rows.withColumn("part", F.pmod(F.xxhash64("id", "score"), F.lit(PARTS)))
    inside = F.row_number().over(Window.partitionBy("item", "part").orderBy(*order))
    few = parts.withColumn("rank", inside).filter(F.col("rank") <= top).drop("rank", "part")
    last = F.row_number().over(Window.partitionBy("item").orderBy(*order))
    return few.withColumn("rank", last).filter(F.col("rank") <= top)


def search(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    top: int = TOP,
) -> DataFrame:
    """The ``top`` best documents of every item: the item and id columns, ``rank`` and ``score``.

    Items go in blocks of a checked size; a block's terms make one automaton, broadcast with the
    rows that lead from a term to its items. One scan counts the terms in the documents' texts;
    the counts are stored and read twice, for document frequencies and for scores. A task keeps
    ``top`` documents of every item, so what is shuffled follows tasks and items, not documents.

    Rows of one item id, a null id among them, are one item whose terms add up. A document's row
    is a document even if its id repeats. A null or empty text has no terms: such a document is
    no answer and such an item has no rows. Equal scores rank by ascending id, null ids last;
    repeats of a row rank one after another. Without documents or items the result is empty.
    Only the named columns are read, so others may have any name.
    """
    spark = docs.sparkSession
    blocked, count = _blocks(items, item_col, item_text_col)
    item_kind = blocked.schema["item"].dataType.simpleString()
    id_kind = docs.select(id_col).schema[0].dataType.simpleString()
    out = spark.createDataFrame([], f"item {item_kind}, rank int, id {id_kind}, score long")
    for block in range(count):
        ids, terms, *postings = _postings(blocked.filter(F.col("block") == block))
        if not terms:
            continue
        shared = spark.sparkContext.broadcast(automaton_of(terms))
        counts = cut(counted(docs, shared, id_col, text_col), "terms")
        total = counts.agg(F.count(F.when(F.col("n") > 0, 1)), F.sum("n")).collect()[0]
        documents, length = total[0], total[1] or 0
        if not length:
            break
        met = counts.select(F.explode("terms").alias("term")).groupBy("term")
        df = np.zeros(len(terms), np.int64)  # one number a term of the block
        for r in met.agg(F.count("*").alias("n")).collect():
            df[r["term"]] = r["n"]
        best = _scored(counts, weights(df, documents), postings, len(ids), documents, length, top)
        names = spark.createDataFrame(list(enumerate(ids)), f"item long, name {item_kind}")
        ranked = _ranked(best, top).join(names, "item")
        out = out.unionByName(ranked.select(F.col("name").alias("item"), "rank", "id", "score"))
    return out.select(F.col("item").alias(item_col), "rank", F.col("id").alias(id_col), "score")
