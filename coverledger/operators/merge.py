"""Putting measures from several tables side by side on shared keys."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F


def merge_measures(
    sources: list[tuple[DataFrame, dict[str, Column]]],
    keys: dict[str, Column] | list[str],
    null_keys: str = "zero",
) -> DataFrame:
    """Sum each measure per key over all sources, 0 where a source has no rows.

    Same answer as building a key spine with UNION and left joining every aggregated
    source to it, but as one tagged union and one aggregation: partial sums run before
    a single shuffle, however many sources there are.

    A row with a null key never equals another in a join, and ``null_keys`` says which
    join is being replaced: ``zero`` keeps one row of zeros per null key, as a spine
    does; ``separate`` keeps each source's own row, as a full outer join does.
    """
    if null_keys not in ("zero", "separate"):
        raise ValueError(f"unknown null_keys: {null_keys}")
    names: list[str] = []
    parts = []
    for position, (df, measures) in enumerate(sources):
        exprs = keys if isinstance(keys, dict) else {k: F.col(k) for k in keys}
        key_names = list(exprs)
        keyed = df.select(*[e.alias(k) for k, e in exprs.items()], *[m.alias(n) for n, m in measures.items()])
        any_null = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in key_names])
        if null_keys == "zero":
            keyed = keyed.select(*key_names, *[F.when(~any_null, F.col(n)).alias(n) for n in measures])
        else:
            keyed = keyed.withColumn("_own_row", F.when(any_null, F.lit(position)))
        parts.append(keyed)
        names += [n for n in measures if n not in names]
    union = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    group = key_names + ([] if null_keys == "zero" else ["_own_row"])
    out = union.groupBy(*group).agg(*[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in names])
    return out.select(*key_names, *names)


def key_spine(frames: list[DataFrame], keys: list[str]) -> DataFrame:
    """Distinct keys found in any frame."""
    return reduce(lambda a, b: a.unionByName(b), [f.select(*keys) for f in frames]).distinct()


def expand_categories(df: DataFrame, categories: dict[str, Column], category: str, value: str) -> DataFrame:
    """One row per category from each input row, reading the input once."""
    kept = df.columns
    items = F.array(*[F.struct(F.lit(k).alias(category), e.alias(value)) for k, e in categories.items()])
    return df.select(*kept, F.inline(items)).select(*kept, category, value)
