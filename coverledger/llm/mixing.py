"""Mixing sources to target weights by a splitting tree. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from coverledger.llm.common import cut
from coverledger.llm.exact import normalised

#: Weights of the sources in their order, repeating.
WEIGHTS = (5, 2, 1)
#: The mix holds so many times the words of all sources, and of one source this much at most.
SHARE, MOST = 1.5, 2
#: Output shards, documents of a cell on average, and blocks of a source at most.
SHARDS, CELL_ROWS, BLOCKS = 16, 256, 4096


def word_count(text: str) -> Column:
    """Words of a text: the spaces between them, plus one. Null: 0."""
    plain = F.trim(normalised(text))
    spaces = F.octet_length(plain) - F.octet_length(F.replace(plain, F.lit(" "), F.lit("")))
    return F.when(plain == "", 0).otherwise(spaces + 1).cast("long")


def source_targets(sizes: DataFrame) -> DataFrame:
    """One row per source of ``sizes`` (``source``, ``size``): rank, size, target, cells, blocks.

    Sources rank by code point, null last. A target is weight x level, but 2 x size at most; the
    level is where all targets add up to the share of all sizes. Sharing the excess out again by
    weight until no source is above its limit ends at the same level. Sources enter in the order
    of limit / weight; those whose limit is under the level reached so far stay at it.
    """
    sums = sizes.groupBy("source").agg(
        F.sum("size").alias("source_size"), F.count("*").alias("n_rows")
    )
    order = Window.orderBy(F.col("source").asc_nulls_last())
    weights = F.array(*(F.lit(w) for w in WEIGHTS))
    ranked = sums.withColumn("rank", F.row_number().over(order) - 1).withColumn(
        "weight", F.element_at(weights, (F.col("rank") % len(WEIGHTS) + 1).cast("int"))
    )
    limit = F.col("source_size") * MOST
    by_limit = Window.orderBy(limit / F.col("weight"), "rank")
    before = by_limit.rowsBetween(Window.unboundedPreceding, -1)
    after = by_limit.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    whole = Window.partitionBy()
    used = F.coalesce(F.sum(limit).over(before), F.lit(0))
    wanted = F.sum("source_size").over(whole) * F.lit(SHARE)
    level = (wanted - used) / F.sum("weight").over(after)
    leveled = ranked.withColumn("_level", level).withColumn(
        "_level",
        F.coalesce(
            F.max(F.when(limit / F.col("weight") > F.col("_level"), F.col("_level"))).over(whole),
            F.lit(0.0),
        ),
    )
    target = F.least(limit.cast("double"), F.col("weight") * F.col("_level"))
    full = F.when(F.col("source_size") > 0, F.floor(target / F.col("source_size"))).otherwise(0)
    cells = F.ceil(F.col("n_rows") / CELL_ROWS)
    return leveled.select(
        "source",
        "rank",
        "source_size",
        target.alias("target"),
        full.cast("int").alias("full"),
        (target - full * F.col("source_size")).alias("more"),
        cells.alias("cells"),
        F.least(cells, F.lit(BLOCKS)).alias("blocks"),
    )


def _order_key(id_col: str, text_col: str, seed: int) -> Column:
    """What a source's documents are ordered by: a hash of the id, without one of the text."""
    name = F.coalesce(F.col(id_col).cast("string"), F.concat(F.lit("t"), F.xxhash64(text_col)))
    return F.md5(F.concat_ws(":", F.lit(str(seed)), name))


def _placed(docs: DataFrame, sources: DataFrame) -> DataFrame:
    """Join each row with its source and give it a cell, and the cell's block, by its ``key``."""
    known = sources.withColumnRenamed("source", "_source")
    at = F.conv(F.substring("key", 1, 8), 16, 10).cast("long")
    cell = F.floor(at * F.col("cells") / F.lit(1 << 32)).cast("long")
    joined = docs.join(known, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    return joined.withColumn("cell", cell).withColumn(
        "block", F.floor(F.col("cell") * F.col("blocks") / F.col("cells")).cast("int")
    )


def _split(node: DataFrame, seed: int) -> DataFrame:
    """One level of the tree: deal each node's quotas out to its two halves.

    The left half gets its exact share of the node's blocks. Going through the blocks, each goes
    left with the chance that the places still free on the left have among all still free; the
    counts by source are then multivariate hypergeometric.
    """
    items = F.sort_array(F.collect_list(F.struct("rank", "q")))
    nodes = node.groupBy("lo", "hi").agg(items.alias("items"), F.sum("q").alias("total"))
    nodes = nodes.withColumn("mid", F.floor((F.col("lo") + F.col("hi")) / 2).cast("int"))
    share = F.round(F.col("total") * (F.col("mid") - F.col("lo")) / (F.col("hi") - F.col("lo")))

    def chance(rank: Column, i: Column) -> Column:
        bits = F.xxhash64(F.lit(seed), F.col("lo"), F.col("hi"), rank, i)
        return F.shiftrightunsigned(bits, 11) / F.lit(float(1 << 53))

    def source(state: Column, item: Column) -> Column:
        def block(s: Column, i: Column) -> Column:
            goes = (chance(item["rank"], i) * s["open"] < s["left"]).cast("long")
            return F.struct(
                (s["left"] - goes).alias("left"),
                (s["open"] - 1).alias("open"),
                (s["got"] + goes).alias("got"),
            )

        start = F.struct(
            state["left"].alias("left"),
            state["open"].alias("open"),
            F.lit(0).cast("long").alias("got"),
        )
        done = F.aggregate(F.sequence(F.lit(1).cast("long"), item["q"]), start, block)
        one = F.struct(item["rank"].alias("rank"), item["q"].alias("q"), done["got"].alias("got"))
        return F.struct(
            done["left"].alias("left"),
            done["open"].alias("open"),
            F.concat(state["out"], F.array(one)).alias("out"),
        )

    none = F.array().cast("array<struct<rank:int,q:bigint,got:bigint>>")
    start = F.struct(
        share.cast("long").alias("left"), F.col("total").alias("open"), none.alias("out")
    )
    halves = F.flatten(
        F.transform(
            F.aggregate("items", start, source)["out"],
            lambda x: F.array(
                F.struct(
                    F.col("lo"), F.col("mid").alias("hi"), x["rank"].alias("rank"), x["got"].alias("q")
                ),
                F.struct(
                    F.col("mid").alias("lo"),
                    F.col("hi"),
                    x["rank"].alias("rank"),
                    (x["q"] - x["got"]).alias("q"),
                ),
            ),
        )
    )
    return nodes.select(F.explode(halves).alias("h")).select("h.*").filter("q > 0")


def shard_quotas(quotas: DataFrame, shards: int, seed: int) -> DataFrame:
    """Split ``quotas`` (``rank``, ``q`` blocks) among shards: ``shard``, ``rank``, ``q``."""
    node = quotas.filter("q > 0").select(
        F.lit(0).alias("lo"), F.lit(shards).alias("hi"), F.col("rank"), F.col("q").cast("long")
    )
    for _ in range(max(shards - 1, 0).bit_length()):
        done, open_ = node.filter("hi - lo = 1"), node.filter("hi - lo > 1")
        node = done.unionByName(_split(open_, seed))
    return node.select(F.col("lo").alias("shard"), "rank", "q")


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    shards: int = SHARDS,
    seed: int = 42,
) -> DataFrame:
    """Give every document the draws that the mix makes of it.

    Returns the input rows with ``_size`` (words), ``_source_size``, ``_target`` and ``_draws``:
    for each time the document is taken, the round ``rep``, the output ``shard`` and a key
    ``place`` to shuffle the shard by. Null texts have size 0; null sources are one source, the
    last. A document is taken twice at most. Reruns give the same mix; repeated rows may swap.

    Each source is laid out in the order of a hash of its ids, cut into blocks. It is drawn whole
    as often as its target holds it, then block after block up to the rest, ending with the
    document in whose middle the target lies. The blocks to draw from each source are split among
    the output shards by a tree (see ``shard_quotas``), and each shard takes its number of blocks
    from the source's blocks in permuted order, so no block is drawn twice in a round.

    Words before a document are sums over blocks, over the cells of its block and within its cell
    of about CELL_ROWS documents, so no task holds a source.
    """
    key = _order_key(id_col, text_col, seed)
    narrow = docs.select(
        F.col(source_col).alias("source"), word_count(text_col).alias("size"), key.alias("key")
    )
    narrow = cut(narrow, "sizes")
    sources = cut(source_targets(narrow), "sources")
    cells = cut(
        _placed(narrow, sources)
        .groupBy("rank", "block", "cell", "full", "more")
        .agg(F.sum("size").alias("size")),
        "cells",
    )
    earlier = Window.partitionBy("rank").orderBy("block")
    earlier = earlier.rowsBetween(Window.unboundedPreceding, -1)
    blocks = cells.groupBy("rank", "block", "full", "more").agg(F.sum("size").alias("size"))
    blocks = blocks.withColumn("before", F.coalesce(F.sum("size").over(earlier), F.lit(0)))
    reps = F.col("full") + (F.col("before") < F.col("more")).cast("int")
    blocks = cut(blocks.withColumn("reps", reps), "blocks")

    shares = shard_quotas(blocks.groupBy("rank").agg(F.sum("reps").alias("q")), shards, seed)
    upto = Window.partitionBy("rank").orderBy("shard")
    shares = shares.withColumn("to", F.sum("q").over(upto)).select(
        "rank", "shard", (F.col("to") - F.col("q")).alias("from"), "to"
    )
    shuffled = Window.partitionBy("rank").orderBy(
        F.xxhash64(F.lit(seed), "rank", "block", "rep"), "block", "rep"
    )
    draws = (
        blocks.filter("reps > 0")
        .select("rank", "block", F.explode(F.sequence(F.lit(0), F.col("reps") - 1)).alias("rep"))
        .withColumn("turn", F.row_number().over(shuffled) - 1)
        .join(shares, "rank")
        .filter((F.col("turn") >= F.col("from")) & (F.col("turn") < F.col("to")))
        .groupBy("rank", "block")
        .agg(F.sort_array(F.collect_list(F.struct("rep", "shard"))).alias("draws"))
    )
    within = Window.partitionBy("rank", "block").orderBy("cell")
    within = within.rowsBetween(Window.unboundedPreceding, -1)
    starts = blocks.select("rank", "block", "before").join(draws, ["rank", "block"], "left")
    starts = cells.select("rank", "block", "cell", "size").join(starts, ["rank", "block"])
    starts = cut(
        starts.select(
            "rank",
            "cell",
            (F.col("before") + F.coalesce(F.sum("size").over(within), F.lit(0))).alias("before"),
            "draws",
        ),
        "starts",
    )

    rows = docs.select(
        F.struct(*(docs[c] for c in docs.columns)).alias("doc"),
        F.col(source_col).alias("source"),
        key.alias("key"),
        word_count(text_col).alias("size"),
    )
    known = sources.select("source", "rank", "source_size", "target", "full", "more", "cells", "blocks")
    placed = _placed(rows, known).join(starts, ["rank", "cell"])
    inside = Window.partitionBy("rank", "cell").orderBy("key", "size")
    inside = inside.rowsBetween(Window.unboundedPreceding, -1)
    start = F.col("before") + F.coalesce(F.sum("size").over(inside), F.lit(0))
    again = (start < F.col("more")) & (2 * start + F.col("size") <= 2 * F.col("more"))
    taken = F.filter(
        F.coalesce("draws", F.array().cast("array<struct<rep:int,shard:int>>")),
        lambda d: (d["rep"] < F.col("full")) | F.col("again"),
    )
    place = lambda d: F.struct(
        d["rep"].alias("rep"),
        d["shard"].alias("shard"),
        F.xxhash64(F.lit(seed), d["shard"], d["rep"], F.col("key")).alias("place"),
    )
    return (
        placed.withColumn("again", again)
        .withColumn("draws", F.transform(taken, place))
        .select(
            "doc.*",
            F.col("size").alias("_size"),
            F.col("source_size").alias("_source_size"),
            F.col("target").alias("_target"),
            F.col("draws").alias("_draws"),
        )
    )


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The documents of the mix with their own columns, repeated as often as they are taken."""
    drawn = mix(docs, **options)
    return drawn.select(*docs.columns, F.explode("_draws").alias("_draw")).drop("_draw")


def write_mix(docs: DataFrame, path: str, **options) -> None:
    """Write the mix as one folder per output shard, each file in shuffled order."""
    drawn = mix(docs, **options).select(*docs.columns, F.explode("_draws").alias("_draw"))
    drawn = drawn.select(*docs.columns, "_draw.shard", "_draw.place")
    drawn = drawn.repartition("shard", F.pmod("place", F.lit(64))).sortWithinPartitions(
        "shard", "place"
    )
    drawn.drop("place").write.partitionBy("shard").parquet(path)
