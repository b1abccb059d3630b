"""Exact near-duplicate vectors by traversing pairs of cover trees.

Equal vectors are one point with a count. A bounded sample gives the pivots of the tree's top; every point goes to its
nearest pivot's cell: to the cell's core if it lies within half the threshold of the pivot (any two points of a core
link, so a core is counted whole), else to its rim. Pairs of cells whose covering radii keep them apart are dropped;
large cells are dealt into blocks. Each block gets nested levels of nodes with halving radii, once; a pair of blocks is
traversed from the coarsest common level down: a pair of nodes is dropped when its distance exceeds the threshold by more
than both radii, counted whole when distance and radii stay below the threshold, and opened otherwise. Single precision
only drops pairs, with a margin above its error; links are decided by cosine in double precision, so they are exactly
those of comparing everything.

Distances are chords of unit vectors: cosine c is chord sqrt(2 - 2c). Vectors that are null, zero or hold null or
non-finite components link with nothing and are their own component; vectors of different lengths don't link. Points are
named by the digest of their vector, so repeated rows are separate vectors that link with each other, and rows that share
a vec_id keep their own links. A null vec_id is never the smallest of a component unless all its ids are null; kept is
never null. An empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from disclosa.llm.common import materialise
from disclosa.llm.components import components
from disclosa.llm.simhash import roots

#: Production threshold.
LEAST = 0.95
#: Points of a block, cells, rows of the bounded sample, bytes of all pivots, and lengths of vectors that get pivots, at most.
BLOCK, CELLS, SAMPLE, PIVOT_BYTES, DIMS = 8192, 4096, 16384, 8 << 20, 16
#: Slack of the radius bounds, far above rounding; within it points are compared themselves.
SLACK = 1e-9
#: Levels of a block's nodes; wider nodes hold points too far apart to be dropped or counted whole.
LEVELS = 4
#: Pairs of nodes looked at in one go, about.
CHUNK = 1 << 18


def binary(rows: np.ndarray) -> pa.Array:
    """The rows of a matrix as bytes."""
    rows = np.ascontiguousarray(rows)
    ends = np.arange(len(rows) + 1, dtype=np.int32) * (rows.shape[1] * rows.itemsize)
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(ends), pa.py_buffer(rows)])


def keyed_vectors(vectors: DataFrame) -> DataFrame:
    """vec_id, key (a digest of the vector, null if it links with nothing), dim, raw (its bytes, single precision if that is exact)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(1)
            ends, values = np.asarray(column.offsets), column.values.to_numpy(zero_copy_only=False).astype(np.float64)
            size = np.diff(ends) * column.is_valid().to_numpy(zero_copy_only=False)
            keys: list[str | None] = [None] * len(batch)
            raws: list[bytes | None] = [None] * len(batch)
            for dim in np.unique(size[size > 0]):
                at = np.flatnonzero(size == dim)
                v = values[ends[at][:, None] + np.arange(dim)] + 0.0
                good = np.isfinite(v).all(axis=1) & (v != 0).any(axis=1)
                at, v = at[good], v[good]
                with np.errstate(over="ignore"):
                    single = v.astype(np.float32)
                short = (single == v).all(axis=1)
                for k, row, low, exact in zip(at, v, single, short, strict=True):
                    keys[k], raws[k] = hashlib.blake2b(row.tobytes(), digest_size=16).hexdigest(), (low if exact else row).tobytes()
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(keys, pa.string()), pa.array(size.astype(np.int32)), pa.array(raws, pa.binary())], names=["vec_id", "key", "dim", "raw"]
            )

    ids = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v"))
    return ids.mapInArrow(run, "vec_id long, key string, dim int, raw binary")


def units(raw: pa.Array, dim: int) -> np.ndarray:
    """The unit vectors, in double precision, of raw vectors of one length."""
    out = np.zeros((len(raw), dim))
    for k, x in enumerate(raw):
        out[k] = np.frombuffer(x.as_buffer(), dtype=np.float32 if len(x.as_buffer()) == 4 * dim else np.float64)
    out /= np.abs(out).max(axis=1, keepdims=True, initial=0.0)
    return out / np.sqrt(np.einsum("nd,nd->n", out, out))[:, None]


def chord(cosine: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0.0, 2.0 - 2.0 * cosine))


def distance(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return chord(np.einsum("nd,nd->n", x, y))


def spread(sample: np.ndarray, n: int) -> np.ndarray:
    """n pivots of the sample, each the farthest from those before it."""
    chosen, near = [0], chord(sample @ sample[0])
    while len(chosen) < min(n, len(sample)) and near.max() > SLACK:
        chosen.append(int(near.argmax()))
        near = np.minimum(near, chord(sample @ sample[chosen[-1]]))
    return sample[chosen]


def cover(points: np.ndarray, threshold: float) -> tuple[list[np.ndarray], np.ndarray]:
    """(for each level above the points the node that a point lies in, the highest level that a point is a centre of)."""
    n = len(points)
    single = points.astype(np.float32)
    under, node, below, centre = np.arange(n), np.arange(n), [], np.zeros(n, dtype=np.int32)
    for level in range(1, LEVELS + 1):
        inside_cos = 1.0 - (threshold / 4 * 2 ** (level - 1)) ** 2 / 2
        x = single[under]
        owner, open_, chosen = np.full(len(under), -1), np.arange(len(under)), []
        while len(open_):
            cand = open_[:256]
            cos = x[cand] @ x[open_].T
            cos[np.arange(len(cand)), np.arange(len(cand))] = 1.0
            near = cos[:, : len(cand)] >= inside_cos
            take, taken = [], np.zeros(len(cand), dtype=bool)
            for k in range(len(cand)):
                if not taken[k]:
                    take.append(k)
                    taken |= near[k]
            own = cos if len(take) == len(cand) else cos[take]
            nearest = own.argmax(axis=0)
            inside = own[nearest, np.arange(len(open_))] >= inside_cos
            owner[open_[inside]] = len(chosen) + nearest[inside]
            chosen += [int(cand[k]) for k in take]
            open_ = open_[~inside]
        joined = len(chosen) <= 0.95 * len(under)
        node, under = owner[node], under[np.array(chosen, dtype=np.int64)]
        below.append(node)
        centre[under] = level
        if not joined and level > 1:
            break  # a level that hardly joins nodes costs more than it saves
    return below, centre


class Tree:
    """Levels of a block's cover, the points first: centres, covering radii, weights, and each node's members in the level below."""

    def __init__(self, points: np.ndarray, weights: np.ndarray, below: list[np.ndarray], centre: np.ndarray) -> None:
        self.points, self.weights = points, weights
        n = len(points)
        self.below, self.centres, self.radii, self.weight, self.members = [np.arange(n), *below], [np.arange(n)], [np.zeros(n)], [weights], [None]
        self.above: list[np.ndarray] = []
        for level, node in enumerate(below, 1):
            at = np.flatnonzero(centre >= level)
            centres = np.empty(len(at), dtype=np.int64)
            centres[node[at]] = at
            radii = np.zeros(len(at))
            np.maximum.at(radii, node, distance(points, points[centres[node]]))
            above = node[self.centres[-1]]
            self.above.append(above)
            order = np.argsort(above, kind="stable")
            self.members.append((order, np.searchsorted(above[order], np.arange(len(at) + 1))))
            self.centres.append(centres)
            self.radii.append(radii)
            self.weight.append(np.bincount(node, weights=weights, minlength=len(at)).astype(np.int64))

    def children(self, level: int, node: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The members of each node in the level below, one after another, and how many each node has."""
        order, starts = self.members[level]
        n = starts[node + 1] - starts[node]
        at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(starts[node], n)
        return order[at], n


def first_pairs(a: Tree, b: Tree, top: int, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of nodes of a level that their radii don't keep apart. Nodes of like radii share one bound."""
    xa, xb = a.points[a.centres[top]].astype(np.float32), b.points[b.centres[top]].astype(np.float32)
    margin = 1e-6 + 2e-7 * xa.shape[1]
    width = np.digitize(b.radii[top], [threshold / 64, threshold / 8, threshold / 4, threshold / 2, threshold])
    found = [(np.zeros(0, dtype=np.int64),) * 2]
    for kind in np.unique(width):
        at = np.flatnonzero(width == kind)
        y, widest = xb[at].T.copy(), b.radii[top][at].max()
        for k in range(0, len(xa), 512):
            bound = 1.0 - (threshold + SLACK + a.radii[top][k : k + 512] + widest) ** 2 / 2 - margin
            i, j = np.nonzero(xa[k : k + 512] @ y >= bound[:, None].astype(np.float32))
            found.append((i + k, at[j]))
    i, j = (np.concatenate(x) for x in zip(*found, strict=True))
    return i, j


def traverse(a: Tree, b: Tree, same: bool, least: float) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(links of a's points, links of b's points, and link ends i, j that connect the same points as all links do).

    Trees may differ in depth: the walk begins at the highest level that both have.
    """
    threshold = float(chord(np.float64(least)))
    count_a, count_b = np.zeros(len(a.points), dtype=np.int64), np.zeros(len(b.points), dtype=np.int64)
    ends: list[tuple[np.ndarray, np.ndarray]] = []
    top = min(len(a.centres), len(b.centres)) - 1
    i, j = first_pairs(a, b, top, threshold)
    if same:
        i, j = i[i <= j], j[i <= j]
    # Depth first, in chunks: what is open at once stays small however many pairs of points link.
    todo = [(top, True, i[k : k + CHUNK], j[k : k + CHUNK]) for k in range(0, len(i), CHUNK)]
    while todo:
        level, test, p, q = todo.pop()
        if test:
            own = (p == q) & same
            cos = np.einsum("nd,nd->n", a.points[a.centres[level][p]], b.points[b.centres[level][q]])
            if not level:
                whole = (cos >= least) & ~own
                _count(a, b, same, level, p[whole], q[whole], count_a, count_b, ends)
                continue
            d, r = np.where(own, 0.0, chord(cos)), a.radii[level][p] + b.radii[level][q]
            whole = d + r <= threshold - SLACK
            keep = ~whole & (d - r <= threshold + SLACK)
            _count(a, b, same, level, p[whole], q[whole], count_a, count_b, ends)
            x, n = a.children(level, p[keep])
            y = np.repeat(q[keep], n)
            cut = np.flatnonzero(np.diff(np.cumsum(np.diff(b.members[level][1])[y]) // CHUNK)) + 1
            todo += [(level, False, *ends_of) for ends_of in zip(np.split(x, cut), np.split(y, cut), strict=True) if len(ends_of[0])]
        else:
            own = (a.above[level - 1][p] == q) & same
            y, n = b.children(level, q)
            x, own = np.repeat(p, n), np.repeat(own, n)
            if same:  # a node's own pair gives both orders of its members
                x, y = x[~own | (x <= y)], y[~own | (x <= y)]
                x, y = np.minimum(x, y), np.maximum(x, y)
            todo += [(level - 1, True, x[k : k + CHUNK], y[k : k + CHUNK]) for k in range(0, len(x), CHUNK)]
    none = np.zeros(0, dtype=np.int64)
    return count_a, count_b, np.concatenate([none, *(x for x, _ in ends)]), np.concatenate([none, *(y for _, y in ends)])


def _count(a: Tree, b: Tree, same: bool, level: int, p: np.ndarray, q: np.ndarray, count_a: np.ndarray, count_b: np.ndarray, ends: list) -> None:
    """Adds the links of node pairs whose points all link, and for connection a star around each node's centre."""
    if not len(p):
        return
    own = (p == q) & same
    add_a = np.bincount(p[~own], weights=b.weight[level][q[~own]], minlength=len(a.centres[level])).astype(np.int64)
    add_b = np.bincount(q[~own], weights=a.weight[level][p[~own]], minlength=len(b.centres[level])).astype(np.int64)
    count_a += add_a[a.below[level]]
    count_b += add_b[b.below[level]]
    inner = np.bincount(p[own], weights=a.weight[level][p[own]], minlength=len(a.centres[level])).astype(np.int64)[a.below[level]]
    count_a += np.where(inner > 0, inner - a.weights, 0)
    shift = 0 if same else len(a.points)
    ends.append((a.centres[level][p], b.centres[level][q] + shift))
    if level:
        for tree, nodes, by in ((a, p, 0), (b, q, shift)):
            used = np.zeros(len(tree.centres[level]), dtype=bool)
            used[nodes] = True
            at = np.flatnonzero(used[tree.below[level]])
            ends.append((at + by, tree.centres[level][tree.below[level][at]] + by))


def own_links(tree: Tree, least: float) -> tuple[np.ndarray, np.ndarray]:
    """(links of each point, the first point it is connected with) within one block."""
    count, back, i, j = traverse(tree, tree, True, least)
    return count + back, roots(len(tree.points), i, j)


def pair_links(a: Tree, b: Tree, least: float) -> tuple[np.ndarray, np.ndarray]:
    """(links of each point, the first point it is connected with) between two blocks, a's points first."""
    count_a, count_b, i, j = traverse(a, b, False, least)
    return np.concatenate([count_a, count_b]), roots(len(a.points) + len(b.points), i, j)


def cells(points: DataFrame, block: int = BLOCK) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(points with dim, cell, block; pairs of cells that may hold links; the cells' sizes) of points(key, weight, dim, raw).

    A cell is twice its pivot, plus one for the rim. Pivots come from a bounded sample; radii are those of all points.
    On the driver: pivots (PIVOT_BYTES) and the radii of their cells. Lengths that few vectors have are a cell each.
    """
    spark = points.sparkSession
    threshold = float(chord(np.float64(LEAST)))
    dims = points.groupBy("dim").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "dim").limit(DIMS).collect()
    pivots = {}
    for dim, n in dims:
        room = PIVOT_BYTES // (8 * dim * len(dims))
        most = max(1, min(CELLS, room, -(-n // block)))
        sample = points.where(F.col("dim") == dim).orderBy(F.xxhash64("key"), "key").limit(max(1, min(SAMPLE, 4 * most))).select("raw").toArrow()
        pivots[dim] = spread(units(sample.column(0).combine_chunks(), dim), most)
    shipped = spark.sparkContext.broadcast(pivots)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size = batch.column(2).to_numpy()
            cell, far = np.ones(len(batch), dtype=np.int32), np.full(len(batch), 2.0)
            for dim in np.unique(size):
                if int(dim) in shipped.value:
                    at = np.flatnonzero(size == dim)
                    cos = units(batch.column(3).take(pa.array(at)), int(dim)) @ shipped.value[int(dim)].T
                    far[at] = chord(cos.max(axis=1))
                    cell[at] = 2 * cos.argmax(axis=1) + (far[at] > threshold / 2 - SLACK)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell), pa.array(far)], names=["key", "weight", "dim", "raw", "cell", "far"])

    placed = materialise(points.select("key", "weight", "dim", "raw").mapInArrow(assign, "key string, weight long, dim int, raw binary, cell int, far double"), "placed")
    sums = [F.count("*").alias("n"), F.max("far").alias("far"), F.sum("weight").alias("whole"), F.min("key").alias("least")]
    sizes = materialise(placed.groupBy("dim", "cell").agg(*sums).withColumn("blocks", F.ceil(F.col("n") / block).cast("int")), "cells")
    known: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for dim in pivots:
        got = sizes.where(F.col("dim") == dim).select("cell", "far").orderBy("cell").toArrow()
        known[dim] = got.column("cell").to_numpy(), got.column("far").to_numpy()
    radii = spark.sparkContext.broadcast(known)

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for dim, cell in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                other = np.array([cell], dtype=np.int32)
                if dim in radii.value:
                    (ids, far), top = radii.value[dim], shipped.value[dim]
                    gap = chord(top[ids // 2] @ top[cell // 2]) - far - far[ids == cell]
                    other = ids[(gap <= threshold + SLACK) & (ids >= cell)]
                other = other[(other != cell) | (cell % 2 == 1)]  # a core is counted whole
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(other), x, dtype=np.int32)) for x in (dim, cell)] + [pa.array(other)], names=["dim", "x", "y"])

    pairs = sizes.select("dim", "cell").mapInArrow(meet, "dim int, x int, y int")
    dealt = placed.join(sizes.select("dim", "cell", "blocks"), ["dim", "cell"]).withColumn("block", F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int"))
    return dealt.drop("blocks", "far"), pairs, sizes


def links(points: DataFrame, block: int = BLOCK) -> DataFrame:
    """key, links, root: for points(key, weight, dim, raw) with links how many (weights of others), in parts, and a point each is connected with."""
    threshold = float(chord(np.float64(LEAST)))
    dealt, pairs, sizes = cells(points, block)

    def tree_of(held: pa.Table) -> Tree:
        path = held.column("path").combine_chunks()
        below = np.asarray(path.values).reshape(len(path), -1).T if len(path) else np.zeros((0, 0), dtype=np.int64)
        raw = held.column("raw").combine_chunks()
        return Tree(units(raw, held.column("dim")[0].as_py()), held.column("weight").to_numpy(), [x.astype(np.int64) for x in below], held.column("centre").to_numpy())

    def build(held: pa.Table) -> pa.Table:
        raw, weights = held.column("raw").combine_chunks(), held.column("weight").to_numpy()
        points = units(raw, held.column("dim")[0].as_py())
        below, centre = cover(points, threshold)
        count, root = np.zeros(len(points), dtype=np.int64), np.arange(len(points))
        if held.column("cell")[0].as_py() % 2:
            count, root = own_links(Tree(points, weights, below, centre), LEAST)
        keys = held.column("key").combine_chunks()
        path = pa.array(list(np.stack(below, axis=1).astype(np.int32)), pa.list_(pa.int32()))
        columns = {"dim": held.column("dim"), "cell": held.column("cell"), "block": held.column("block"), "key": keys, "weight": held.column("weight"), "raw": raw}
        return pa.table(columns | {"path": path, "centre": pa.array(centre), "links": pa.array(count), "root": keys.take(pa.array(root))})

    made = "dim int, cell int, block int, key string, weight long, raw binary, path array<int>, centre int, links long, root string"
    trees = materialise(dealt.select("dim", "cell", "block", "key", "weight", "raw").groupBy("dim", "cell", "block").applyInArrow(build, made), "trees")
    of = sizes.select("dim", "cell", "blocks")
    x, y = (of.select("dim", F.col("cell").alias(c), F.col("blocks").alias(f"n{c}")) for c in ("x", "y"))
    meets = (
        pairs.join(x, ["dim", "x"]).join(y, ["dim", "y"])
        .withColumn("bx", F.explode(F.expr("sequence(0, nx - 1)")))
        .withColumn("by", F.explode(F.expr("sequence(0, ny - 1)")))
        .where("x < y or bx < by")
        .withColumn("pair", F.concat_ws(".", "dim", "x", "bx", "y", "by"))
    )
    sides = F.explode(F.array(F.struct(F.col("x").alias("cell"), F.col("bx").alias("block"), F.lit(0).alias("side")), F.struct(F.col("y").alias("cell"), F.col("by").alias("block"), F.lit(1).alias("side"))))
    seats = materialise(meets.select("pair", "dim", sides.alias("s")).select("pair", "dim", "s.*"), "seats")
    seated = trees.join(seats, ["dim", "cell", "block"]).select("pair", "side", "dim", "key", "weight", "raw", "path", "centre")

    def compare(held: pa.Table) -> pa.Table:
        side = held.column("side").to_numpy()
        first, second = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        count, root = pair_links(tree_of(held.take(first)), tree_of(held.take(second)), LEAST)
        keys = held.column("key").combine_chunks().take(pa.array(np.concatenate([first, second])))
        at = np.flatnonzero(count > 0)
        return pa.table({"key": keys.take(pa.array(at)), "links": pa.array(count[at]), "root": keys.take(pa.array(root[at]))})

    across = materialise(seated.groupBy("pair").applyInArrow(compare, "key string, links long, root string"), "across")
    cores = trees.where("cell % 2 = 0").join(sizes.select("dim", "cell", "whole", "least"), ["dim", "cell"])
    within = trees.where("links > 0").select("key", "links", "root")
    return within.unionByName(across).unionByName(cores.select("key", (F.col("whole") - F.col("weight")).alias("links"), F.col("least").alias("root")).where("links > 0"))


def near_duplicates(vectors: DataFrame, block: int = BLOCK) -> DataFrame:
    """vec_id, n_links, component_id, kept for every row of vectors(vec_id, embedding) at cosine LEAST or more."""
    rows = materialise(keyed_vectors(vectors), "vectors")
    points = rows.where("key is not null").groupBy("key").agg(F.first("dim").alias("dim"), F.first("raw").alias("raw"), F.count("*").alias("weight"))
    found = materialise(links(materialise(points, "points"), block), "found")
    labels = components(found.select(F.col("key").alias("a"), F.col("root").alias("b"))).select(F.col("node").alias("key"), "component")
    counts = found.groupBy("key").agg(F.sum("links").alias("links"))
    least = rows.where("key is not null").groupBy("key").agg(F.min("vec_id").alias("least"), F.count("*").alias("weight"))
    of = materialise(least.join(labels, "key", "left").withColumn("component", F.coalesce("component", "key")), "of")
    smallest = materialise(of.groupBy("component").agg(F.min("least").alias("component_id")), "smallest")
    linked = of.join(smallest, "component").join(counts, "key", "left")
    linked = materialise(linked.select("key", (F.col("weight") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), "component_id"), "linked")
    named = rows.select("vec_id", "key").join(linked, "key", "left")
    own = F.when(F.col("key").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    out = named.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), own.alias("component_id"))
    return out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
