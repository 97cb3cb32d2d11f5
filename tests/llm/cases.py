"""Small tables with the odd cases every operator has to bear."""

from __future__ import annotations

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size string, row int"


def words(rng: random.Random, n: int) -> str:
    return " ".join(rng.choice("the of and runs tree house Été straße niño x1".split()) for _ in range(n))


def odd_rows() -> list[tuple]:
    """Nulls in any column, empty, blank and very long texts, ties, repeats, clashing names."""
    rng = random.Random(7)
    passage = words(rng, 40)
    texts = [
        None, "", "  \n\t ", "one", "two words", "Two  words", passage, passage.replace(" ", "\n"),
        words(rng, 60) + " " + passage, passage + " " + words(rng, 30), words(rng, 20_000),
        "!!! 123 ...", "\x1c\x85 a b", words(rng, 200), passage + " tail", "<|endoftext|> it's",
    ]
    rows = [
        (k, t, ["en", "de", None][k % 3], ["a", "b", None, "a"][k % 4], None, "s", None)
        for k, t in enumerate(texts)
    ]
    rows += [(None, "two words", None, None, 1, None, 1), (None, None, "en", "a", 1, None, 1)]
    return rows + rows[4:6] + rows[-2:]  # repeated rows


def odd_docs(spark):
    return spark.createDataFrame(odd_rows(), SCHEMA).repartition(3)


def empty_docs(spark):
    return spark.createDataFrame([], SCHEMA)
