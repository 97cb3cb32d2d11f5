"""Latest-wins, upsert and slice replacement over whole tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def latest_wins(df: DataFrame, keys: list[str], order: list[Column | str]) -> DataFrame:
    """Keep the row with the greatest order values per key.

    An aggregate and not a ranking: each task reduces its rows to one per key before
    the shuffle, so a key with very many versions is no hot spot. Spark runs it as a
    sort aggregate: a local, spillable sort per task, then one row per key and task.
    Give enough order columns to make the winner unique.
    """
    rest = [c for c in df.columns if c not in keys]
    winner = F.max_by(F.struct(*rest), F.struct(*order)).alias("_row")
    return df.groupBy(*keys).agg(winner).select(*keys, "_row.*").select(*df.columns)


def upsert(stored: DataFrame, incoming: DataFrame, keys: list[str], order: list[str] | None = None) -> DataFrame:
    """Incoming rows replace stored rows with the same keys; new keys are added.

    ``order`` decides between several incoming (or stored) rows of one key.
    """
    both = stored.withColumn("_side", F.lit(0)).unionByName(
        incoming.withColumn("_side", F.lit(1)), allowMissingColumns=True
    )
    return latest_wins(both, keys, ["_side", *(order or [])]).drop("_side")


def replace_slice(stored: DataFrame, incoming: DataFrame, by: list[str], slices: DataFrame | None = None) -> DataFrame:
    """Drop every stored row of the slices being loaded, then add the incoming rows.

    ``slices`` lists the slices to clear; by default those present in the incoming rows.
    """
    cleared = (incoming if slices is None else slices).select(*by).distinct()
    return stored.join(cleared, by, "left_anti").select(*stored.columns).unionByName(
        incoming, allowMissingColumns=True
    )
