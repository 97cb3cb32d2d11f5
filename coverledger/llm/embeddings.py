"""Near-duplicate vectors by a pigeonhole join over rotated subspaces."""

from __future__ import annotations

import functools
from collections.abc import Iterator
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coverledger.llm.common import cut
from coverledger.llm.components import connected_components

#: Least cosine of a link, dimensions of a block.
COSINE, BLOCK = 0.98, 8
#: Vectors that a grid cell should hold; dimensions are gridded until cells are about that small.
CELL = 2000
#: Rows of a cell that are compared in one piece; larger cells are split into pairs of parts.
PART = 4096
#: Rounding allowed for in squared distances before the exact check.
SLACK = 1e-9
_ODD = np.uint64(0x9E3779B97F4A7C15)


@functools.lru_cache(maxsize=8)
def rotation(dim: int) -> np.ndarray:
    """A fixed random rotation: it spreads a vector's differences evenly over the blocks."""
    q, r = np.linalg.qr(np.random.default_rng(dim).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def block_starts(dim: int) -> np.ndarray:
    return np.arange(0, dim, BLOCK)


def budgets(dim: int, cosine: float) -> np.ndarray:
    """Squared distance that a block may have: its share, by dimensions, of that of a link."""
    sizes = np.diff(block_starts(dim), append=dim)
    return (2 - 2 * cosine + SLACK) * sizes / dim


def rotated(vectors: np.ndarray) -> np.ndarray:
    """Unit vectors, rotated; a row's result does not depend on the rows around it."""
    unit = vectors / np.sqrt(np.einsum("ij,ij->i", vectors, vectors))[:, None]
    return np.einsum("ij,kj->ik", unit, rotation(vectors.shape[1]))


def _tiles(points: np.ndarray, grid: int, cosine: float) -> Iterator[tuple]:
    """For every block: rows, cells, and whether the cell is the row's own.

    Cells are twice the block's radius wide in the first ``grid`` dimensions of the block. A row
    visits those later neighbours of its own cell that its radius reaches, so any two rows within
    the radius meet in just one cell, of which it is the own cell of one at least.
    """
    dim = points.shape[1]
    for block, (start, budget) in enumerate(zip(block_starts(dim), budgets(dim, cosine))):
        radius = np.sqrt(budget)
        part = points[:, start : start + min(grid, BLOCK, dim - start)]
        cell = np.floor(part / (2 * radius)).astype(np.int64)
        inside = part - cell * (2 * radius)
        steps = [s for s in product((-1, 0, 1), repeat=part.shape[1]) if s >= (0,) * part.shape[1]]
        for step in steps:
            reach = np.ones(len(part), bool)
            for d, s in enumerate(step):
                if s > 0:
                    reach &= 2 * radius - inside[:, d] <= radius * (1 + 1e-9)
                elif s < 0:
                    reach &= inside[:, d] <= radius * (1 + 1e-9)
            rows = np.flatnonzero(reach)
            if len(rows):
                code = np.zeros(len(rows), np.uint64)
                with np.errstate(over="ignore"):
                    for d, s in enumerate(step):
                        code = (code ^ (cell[rows, d] + s).astype(np.uint64)) * _ODD
                        code ^= code >> np.uint64(29)
                yield block, rows, code.view(np.int64), not any(step)


def linked_pairs(
    own: np.ndarray, visiting: np.ndarray, vectors: np.ndarray, block: int, cosine: float
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of rows (own with own, own with visiting) whose cosine reaches the limit.

    Only pairs of which ``block`` is the first block within its budget count, so that each pair
    counts once although it may meet in several blocks. The block's distances of all pairs come
    from one matrix product, with slack; those near enough are computed anew.
    """
    points = rotated(vectors)
    dim = points.shape[1]
    starts, limits = block_starts(dim), budgets(dim, cosine)
    part = points[:, starts[block] : starts[block] + BLOCK]
    square = np.einsum("ij,ij->i", part, part)
    norm = np.sqrt(np.einsum("ij,ij->i", vectors, vectors))
    others = np.concatenate((own, visiting))
    for k in range(0, len(own), 256):
        rows = own[k : k + 256]
        near = square[rows][:, None] + square[others][None, :] - 2 * part[rows] @ part[others].T
        i, j = np.nonzero(near <= limits[block] + SLACK)
        later = j > i + k  # pairs of own rows once, none with itself
        a, b = rows[i[later]], others[j[later]]
        for at in range(0, len(a), 100_000):
            x, y = a[at : at + 100_000], b[at : at + 100_000]
            apart = points[x] - points[y]
            apart = np.add.reduceat(apart * apart, starts, axis=1)
            first = (apart <= limits).argmax(axis=1)
            mine = (apart <= limits).any(axis=1) & (first == block)
            x, y = x[mine], y[mine]
            cosines = np.einsum("ij,ij->i", vectors[x], vectors[y]) / (norm[x] * norm[y])
            yield x[cosines >= cosine], y[cosines >= cosine]


def _smallest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest row linked with each row, over any number of links."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _classes(vectors: DataFrame, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """Equal vectors of a label as one: ``node``, ``label``, ``vec``, ``least`` id, ``n``."""
    vec = F.col("vec")
    fine = (
        F.col("label").isNotNull()
        & vec.isNotNull()
        & F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        & F.exists(vec, lambda x: x != 0)
    )
    rows = vectors.select(
        F.col(id_col).alias("id"),
        F.col(label_col).alias("label"),
        F.col(vector_col).cast("array<double>").alias("vec"),
    )
    grouped = rows.filter(fine).groupBy("label", "vec").agg(F.min("id").alias("least"), F.count("*").alias("n"))
    return cut(grouped.withColumn("node", F.monotonically_increasing_id()), "classes")


def _links(classes: DataFrame, cosine: float) -> DataFrame:
    """``node``, ``links`` (vectors linked with it) and ``root``, a row for each cell and node
    with links there; nodes and roots of one cell are connected."""
    sizes = classes.groupBy("label", F.size("vec").alias("dim")).agg(F.count("*").alias("rows"))
    grid = F.ceil(F.log(F.greatest(F.col("rows") / CELL, F.lit(1.0))) / F.log(F.lit(3.0)))
    sizes = cut(
        sizes.select("label", "dim", F.greatest(F.least(grid, F.lit(BLOCK)), F.lit(1)).alias("grid")),
        "grids",
    )
    rows = classes.withColumn("dim", F.size("vec")).join(sizes, ["label", "dim"])
    rows = rows.select("node", F.xxhash64("label").alias("label"), "grid", "vec")

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            node, label = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            grids = batch.column(2).to_numpy()
            vectors = batch.column(3)
            dims = pa.compute.list_value_length(vectors).to_numpy()
            flat, ends = vectors.flatten().to_numpy(), np.cumsum(dims)
            for dim, grid in sorted(set(zip(dims.tolist(), grids.tolist()))):
                own = np.flatnonzero((dims == dim) & (grids == grid))
                points = flat[(ends[own] - dim)[:, None] + np.arange(dim)]
                for block, at, code, home in _tiles(rotated(points), grid, cosine):
                    n = len(at)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(node[own[at]]),
                            pa.array(label[own[at]]),
                            pa.array(np.full(n, dim, np.int32)),
                            pa.array(np.full(n, block, np.int32)),
                            pa.array(code),
                            pa.array(np.full(n, home)),
                        ],
                        ["node", "label", "dim", "block", "cell", "home"],
                    )

    tiles = cut(
        rows.mapInArrow(
            place, "node long, label long, dim int, block int, cell long, home boolean"
        ),
        "tiles",
    )
    key = ["label", "dim", "block", "cell"]
    large = cut(
        tiles.groupBy(*key)
        .agg(F.count("*").alias("rows"))
        .filter(F.col("rows") > PART)
        .select(*key, F.ceil(F.col("rows") / PART).cast("int").alias("parts")),
        "large",
    )
    parts = F.coalesce("parts", F.lit(1))
    part = F.pmod(F.xxhash64("node"), parts).cast("int")
    pairs = F.transform(
        F.sequence(F.lit(0), F.col("of") - 1),
        lambda o: F.struct(F.least(o, F.col("part")).alias("i"), F.greatest(o, F.col("part")).alias("j")),
    )
    dealt = (
        tiles.join(large, key, "left")
        .withColumn("of", parts.cast("int"))
        .withColumn("part", part)
        .withColumn("pair", F.explode(pairs))
        .select(
            "node",
            "block",
            "home",
            "part",
            F.xxhash64(*key, "pair.i", "pair.j").alias("tile"),
            F.col("label").alias("label"),
            F.col("dim").alias("dim"),
            (F.col("pair.i") == F.col("pair.j")).alias("alone"),
        )
    )
    full = dealt.join(classes.select("node", "n", "vec"), "node")
    full = full.repartition("tile").sortWithinPartitions("tile", "label", "dim", "node")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def done(table: pa.Table) -> pa.RecordBatch:
            node, n = table.column("node").to_numpy(), table.column("n").to_numpy()
            home, part = table.column("home").to_numpy(), table.column("part").to_numpy()
            flat = table.column("vec").combine_chunks().flatten().to_numpy()
            vectors = flat.reshape(len(node), -1)
            alone, block = table.column("alone")[0].as_py(), table.column("block")[0].as_py()
            own, visiting = np.flatnonzero(home), np.flatnonzero(~home)
            found = [(np.zeros(0, np.int64),) * 2]
            for a, b in linked_pairs(own, visiting, vectors, block, cosine):
                keep = np.full(len(a), alone) | (part[a] != part[b])
                found.append((a[keep], b[keep]))
            a, b = (np.concatenate(c) for c in zip(*found))
            links = np.bincount(a, n[b], len(node)) + np.bincount(b, n[a], len(node))
            root = node[_smallest(len(node), a, b)]
            at = np.flatnonzero(links)
            return pa.RecordBatch.from_arrays(
                [pa.array(node[at]), pa.array(links[at].astype(np.int64)), pa.array(root[at])],
                ["node", "links", "root"],
            )

        def groups() -> Iterator[pa.Table]:
            """The rows of one tile after another; they arrive sorted."""
            for batch in batches:
                table = pa.Table.from_batches([batch])
                tile, label, dim = (table.column(c).to_numpy() for c in ("tile", "label", "dim"))
                change = (tile[1:] != tile[:-1]) | (label[1:] != label[:-1]) | (dim[1:] != dim[:-1])
                bounds = [0, *(np.flatnonzero(change) + 1).tolist(), len(tile)]
                for a, b in zip(bounds, bounds[1:]):
                    piece = table.slice(a, b - a)
                    if held and any(held[-1].column(c)[0] != piece.column(c)[0] for c in ("tile", "label", "dim")):
                        yield pa.concat_tables(held)
                        held.clear()
                    if b > a:
                        held.append(piece)
            if held:
                yield pa.concat_tables(held)

        for table in groups():
            yield done(table)

    return full.mapInArrow(compare, "node long, links long, root long")


def near_vectors(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    cosine: float = COSINE,
) -> DataFrame:
    """Links between vectors of one label whose cosine, in double precision, is ``cosine`` or more.

    Returns one row per input row: the id column, ``n_links`` (other vectors linked directly),
    ``component_id`` (smallest id reachable, itself included) and ``kept``. Vectors that are null,
    empty or zero, or hold null or non-finite numbers, and those without a label, link with
    nothing; vectors of different lengths do not link. Repeated rows and equal vectors are other
    vectors to each other. Null ids are never smallest. An empty table gives an empty result.

    Equal vectors are one node. Unit vectors with that cosine are at most sqrt(2 - 2 cosine)
    apart; after a rotation, the squared distance falls to blocks of BLOCK dimensions, of which
    one at least stays within its share. For each block, nodes are sent to the cells of a grid,
    as fine as the label has rows, and compared with those they meet there; a pair counts in the
    first block it fits. No pair leaves a task: nodes leave with their number of links and the
    smallest node they are connected with there.
    """
    classes = _classes(vectors, id_col, vector_col, label_col)
    links = cut(_links(classes, cosine), "links")
    edges = links.select(F.col("node").alias("a"), F.col("root").alias("b"))
    roots = cut(connected_components(edges), "roots")
    counts = links.groupBy("node").agg(F.sum("links").alias("links"))
    rooted = classes.select("node", "least", "label", "vec", "n").join(roots, "node", "left")
    rooted = rooted.withColumn("root", F.coalesce("root", "node"))
    smallest = rooted.groupBy("root").agg(F.min("least").alias("component"))
    known = cut(
        rooted.join(smallest, "root")
        .join(counts, "node", "left")
        .select(
            "label",
            "vec",
            (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
            "component",
        ),
        "known",
    )
    rows = vectors.select(
        F.col(id_col).alias("id"),
        F.col(label_col).alias("label"),
        F.col(vector_col).cast("array<double>").alias("vec"),
    )
    joined = rows.join(known, ["label", "vec"], "left")
    component = F.coalesce("component", "id")
    return joined.select(
        F.col("id").alias(id_col),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        component.eqNullSafe(F.col("id")).alias("kept"),
    )
