"""Exact join of texts whose sets of word shingles have a Jaccard similarity of 0.8 or more.

Equal sets are one node. All sets are sorted by one order of the shingles, frequent ones last; two similar sets then share
a shingle among the first n - ceil(0.8 n) + 1 of each, so nodes meet on an equal key and no pair is lost. The order's
frequencies come from a sample of texts: they change what is compared, never what is found. In a few rounds the
nodes of a key are compared with one of them only, first with the one that shares most keys (the text that others were
copied from), then with drawn ones; after that only nodes of a key that are still in different components are compared,
in blocks where a key has many. Pairs that meet by chance go first by their sketches, one parity bit or two a shingle, whose
differing bits are never more than the sets' differing shingles; every link is then tested on the whole sets.

A text of five words or fewer is one shingle; texts without words are one node; words are those of the fingerprint.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from disclosa.llm.common import discard, free_shuffles, materialise, pieces, thrifty
from disclosa.llm.components import components

#: Words of a shingle, its seed. Two sets are similar if the shared shingles are 4/5 of all of theirs.
SHINGLE, SEED = 5, 42
#: Texts whose shingles are counted for the order, about, and counted shingles held at most.
SAMPLE, HELD = 20_000, 500_000
#: Rounds of stars, and the centres that a node is compared with in a round.
ROUNDS, STARS = 1, 4
#: Ids of texts that are sent to every task, at most; more are joined by an exchange.
SENT = 500_000
#: Nodes of a key that are compared in one task's block, about.
BLOCK = 1024
#: Bits of a sketch, at least and at most; a set of more shingles shares bits out among them.
LEAST_BITS, MOST_BITS = 64, 1 << 16
#: Nodes of a key from which on a pair is compared only where it meets first in the order, as far as can be told from
#: the places of KNOWN of each node's keys: a row stays small however long its text, and a pair may come up again.
MANY, KNOWN = 8, 32


def shingle_set(text: str) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's shingles."""
    w = text.encode("utf-8", "surrogatepass").lower().split()
    if not w:
        return np.zeros(0, dtype=np.uint64)
    digest = xxhash.xxh64_intdigest
    parts = zip(*(w[i:] for i in range(SHINGLE)), strict=False) if len(w) > SHINGLE else [w]
    return np.unique(np.fromiter((digest(b" ".join(s), SEED) for s in parts), dtype=np.uint64))


def node_of(hashes: np.ndarray) -> int:
    """The set's digest as a signed long."""
    return int(np.uint64(xxhash.xxh64_intdigest(hashes.tobytes(), SEED)).view(np.int64))


def sketch(hashes: np.ndarray) -> bytes:
    """For each of b places how many hashes fall on it, modulo 2; b is the power of two from the set's size on, within its bounds."""
    bits = min(MOST_BITS, max(LEAST_BITS, 1 << max(0, len(hashes) - 1).bit_length()))
    return np.packbits(np.bincount((hashes & np.uint64(bits - 1)).astype(np.int64), minlength=bits).astype(np.uint8) & 1).tobytes()


def differing(a: bytes, b: bytes) -> int:
    """Differing bits of two sketches, the longer one folded to the other's places: at most the sets' differing shingles."""
    x, y = (np.frombuffer(s, dtype=np.uint64) for s in (a, b))
    n = min(len(x), len(y))
    return int(np.bitwise_count(np.bitwise_xor.reduce(x.reshape(-1, n)) ^ np.bitwise_xor.reduce(y.reshape(-1, n))).sum())


def prefix(hashes: np.ndarray, known: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The first n - ceil(0.8 n) + 1 of a set, by count, then by hash."""
    n = len(hashes)
    if not n:
        return hashes
    c = np.zeros(n, dtype=np.int64)
    if len(known):
        at = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
        c = np.where(known[at] == hashes, counts[at], 0)
    return hashes[np.argsort(c, kind="stable")][: n - (4 * n + 4) // 5 + 1]


def frequencies(texts: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Shingles that stand in two texts of the sample or more, sorted, and their counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, 0):
            found = [shingle_set(t.as_py() or "") for t in batch.column(0)]
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([np.zeros(0, dtype=np.uint64), *found]).view(np.int64))], names=["h"])

    every = max(1, texts.count() // SAMPLE)
    sample = texts.select("text").where(F.pmod(F.xxhash64("text"), F.lit(every)) == 0)
    often = sample.mapInArrow(thrifty(run), "h long").groupBy("h").count().where("count > 1").orderBy(F.desc("count"), "h").limit(HELD).toArrow()
    known = often.column("h").to_numpy().view(np.uint64)
    order = np.argsort(known)
    return known[order], often.column("count").to_numpy()[order]


def prints(documents: DataFrame, fingerprint) -> DataFrame:  # noqa: ANN001
    """doc_id, fp, node, size, keys, sketch of every row: its fingerprint, its set, the keys on which similar sets meet, its sketch."""
    kind = documents.schema["doc_id"].dataType.simpleString()
    texts = documents.select("doc_id", F.col("text").cast("string").alias("text"))
    order = documents.sparkSession.sparkContext.broadcast(frequencies(texts))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, counts = order.value
        for batch in pieces(batches, 1):
            said = [t.as_py() or "" for t in batch.column(1)]
            fps = np.array([fingerprint(t) for t in said], dtype=np.uint64).view(np.int64)
            nodes, sizes, keys, sketches = [], [], [], []
            for t in said:
                h = shingle_set(t)
                nodes.append(node_of(h))
                sizes.append(len(h))
                keys.append(prefix(h, known, counts).view(np.int64))
                sketches.append(sketch(h))
            held = pa.array(keys, type=pa.list_(pa.int64()))
            columns = [batch.column(0), pa.array(fps), pa.array(nodes, type=pa.int64()), pa.array(sizes, type=pa.int64()), held, pa.array(sketches, type=pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "fp", "node", "size", "keys", "sketch"])

    return texts.mapInArrow(thrifty(run), f"doc_id {kind}, fp long, node long, size long, keys array<long>, sketch binary")


def may_reach(size_a, size_b, pos_a, pos_b):  # noqa: ANN001, ANN201
    """Whether sets that meet first at these places can still be similar; for columns and for arrays."""
    a, b = size_a - pos_a, size_b - pos_b
    return (5 * size_a >= 4 * size_b) & (5 * size_b >= 4 * size_a) & (9 * a >= 4 * (size_a + size_b)) & (9 * b >= 4 * (size_a + size_b))


def met_before(keys: np.ndarray, places: np.ndarray, owner: np.ndarray, pos: np.ndarray, x: int, others: np.ndarray) -> np.ndarray:
    """For each of others, whether it shares one of the known keys with x before the places on which the two meet.

    keys, places and owner list the known keys of all nodes; pos has the place of the key they meet on.
    """
    early = places < pos[owner]
    hit = early & np.isin(keys, keys[early & (owner == x)])
    return np.bincount(owner[hit], minlength=len(pos))[others] > 0


def blocks(held: DataFrame) -> DataFrame:
    """Rows of held(key, node, component, ...) whose key meets several components, with the groups i, j they are compared in.

    n: nodes of the key; main: whether a row is of the key's largest component. Pairs of main rows are linked already, so
    only the others meet them: block i of the others meets block j of the main ones (j >= 0; at 0 also itself), and block
    -1 - j of the others. While the others of a key fit in one block, a main row comes once however many there are.
    """
    counts = held.groupBy("key", "component").agg(F.count("*").alias("c"))
    sums = counts.groupBy("key").agg(F.sum("c").alias("n"), F.max(F.struct("c", "component")).alias("top"), F.count("*").alias("parts")).where("parts > 1")
    rows = held.drop("n").join(sums.select("key", "n", "top"), "key").withColumn("main", F.col("component") == F.col("top.component"))
    of_main, of_others = (F.ceil(n / BLOCK).cast("int") for n in (F.col("top.c"), F.col("n") - F.col("top.c")))
    rows = rows.withColumns({"_m": of_main, "_o": of_others}).withColumn("_b", F.expr("cast(pmod(xxhash64(node), if(main, _m, _o)) as int)"))
    groups = """if(main, transform(sequence(0, _o - 1), k -> struct(k as i, _b as j)), concat(
        transform(sequence(0, _m - 1), k -> struct(_b as i, k as j)),
        transform(filter(sequence(0, _o - 1), k -> k <> _b), k -> struct(least(_b, k) as i, -1 - greatest(_b, k) as j))))"""
    return rows.withColumn("_g", F.explode(F.expr(groups))).select("*", "_g.i", "_g.j").drop("_g", "_m", "_o", "_b", "top")


def apart(held: DataFrame, nodes: DataFrame) -> DataFrame:
    """a, b: nodes of held(key, node, size, pos, component) that meet on a key, in different components.

    Nodes of a key that many have carry KNOWN of their keys with their places (the smallest, so that two nodes which
    share many keys know some of the same): a pair that met on one of these before is left to that key.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for j, many, row in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                node, size, pos, component, main = (row.values.field(k).to_numpy(zero_copy_only=False) for k in ("node", "size", "pos", "component", "main"))
                if main.all():
                    continue
                if many:
                    known = row.values.field("known")
                    keys, places = (known.flatten().field(k).to_numpy() for k in ("k", "p"))
                    owner = np.repeat(np.arange(len(node)), known.value_lengths().to_numpy())
                among = j <= 0
                for x in np.flatnonzero(~main):
                    y = np.flatnonzero((component != component[x]) & (main | (among & (np.arange(len(node)) > x))) & may_reach(size[x], size, pos[x], pos))
                    if len(y) and many:
                        y = y[~met_before(keys, places, owner, pos, x, y)]
                    if len(y):
                        ends = np.full(len(y), node[x]), node[y]
                        yield pa.RecordBatch.from_arrays([pa.array(np.minimum(*ends)), pa.array(np.maximum(*ends))], names=["a", "b"])

    rows = blocks(held)
    none = F.array().cast("array<struct<k:long,p:int>>")
    few = rows.where(F.col("n") <= MANY).withColumn("known", none)
    places = F.transform("keys", lambda k, p: F.struct(k.alias("k"), p.alias("p")))
    known = nodes.select("node", F.slice(F.sort_array(places), 1, KNOWN).alias("known"))
    many = rows.where(F.col("n") > MANY).join(known, "node")
    rows = few.unionByName(many).select("key", "i", "j", (F.col("n") > MANY).alias("many"), F.struct("node", "size", "pos", "component", "main", "known").alias("row"))
    lists = rows.groupBy("key", "i", "j", "many").agg(F.collect_list("row").alias("rows")).where(F.size("rows") > 1)
    return lists.select("j", "many", "rows").mapInArrow(thrifty(run), "a long, b long").distinct()


def likely(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """The pairs(a, b) of nodes(node, size, sketch) whose sketches allow a Jaccard similarity of 0.8 or more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            total, one, two = batch.column(2).to_numpy(), batch.column(3), batch.column(4)
            yield batch.select([0, 1]).filter(pa.array([9 * differing(x.as_py(), y.as_py()) <= n for n, x, y in zip(total, one, two, strict=True)], pa.bool_()))

    one = nodes.select(F.col("node").alias("a"), F.col("size").alias("_n"), F.col("sketch").alias("_a"))
    two = nodes.select(F.col("node").alias("b"), F.col("size").alias("_m"), F.col("sketch").alias("_b"))
    both = pairs.join(one, "a").join(two, "b").select("a", "b", (F.col("_n") + F.col("_m")).alias("_n"), "_a", "_b")
    return both.mapInArrow(thrifty(run), "a long, b long")


def similar(pairs: DataFrame, documents: DataFrame, nodes: DataFrame) -> DataFrame:
    """The pairs(a, b) of nodes(node, least, size, sketch) whose whole sets have a Jaccard similarity of 0.8 or more.

    Sets are made anew from the texts of the ends of likely pairs: the texts of all others stay where they are.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, 0):
            found = [shingle_set(t.as_py() or "") for t in batch.column(0)]
            out = [pa.array([node_of(h) for h in found], type=pa.int64()), pa.array([h.view(np.int64) for h in found], type=pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(out, names=["node", "hashes"])

    pairs = materialise(likely(pairs, nodes), "likely")
    free_shuffles(documents.sparkSession)
    ends = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    wanted = materialise(nodes.join(ends, "node", "left_semi").select(F.col("least").alias("_least")).distinct(), "wanted")
    few = wanted.schema["_least"].dataType.simpleString() in ("bigint", "int") and wanted.count() <= SENT
    texts = documents.select("doc_id", F.col("text").cast("string").alias("text"))
    texts = texts.join(F.broadcast(wanted) if few else wanted, texts["doc_id"].eqNullSafe(wanted["_least"]), "left_semi").select("text")
    sets = materialise(texts.mapInArrow(thrifty(run), "node long, hashes array<long>"), "sets")
    one = sets.select(F.col("node").alias("a"), F.col("hashes").alias("_a"))
    two = sets.select(F.col("node").alias("b"), F.col("hashes").alias("_b"))
    shared = F.size(F.array_intersect("_a", "_b"))
    both = pairs.join(one, "a").join(two, "b")  # texts that share an id may give a node twice
    out = materialise(both.where(9 * shared >= 4 * (F.size("_a") + F.size("_b"))).select("a", "b").distinct(), "similar")
    discard(pairs, wanted, sets)
    free_shuffles(documents.sparkSession)
    return out


def links(documents: DataFrame, held_prints: DataFrame) -> DataFrame:
    """a, b: nodes of prints that are similar, at least so many that the components are those of all similar pairs.

    held_prints is deleted as soon as its nodes are written.
    """
    nodes = held_prints.groupBy("node").agg(F.min("doc_id").alias("least"), *(F.first(c).alias(c) for c in ("size", "keys", "sketch")))
    nodes = materialise(nodes, "nodes")
    discard(held_prints)
    free_shuffles(documents.sparkSession)
    rows = nodes.select("node", "size", F.posexplode("keys").alias("pos", "key"))
    shared = rows.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    held = materialise(rows.join(shared, "key"), "held")
    free_shuffles(documents.sparkSession)
    degrees = held.groupBy("node").agg(F.sum("n").alias("degree"))
    found, labels = None, None
    for k in range(ROUNDS):
        graded = held.withColumn("component", F.col("node")) if labels is None else held.join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))
        order = F.xxhash64("node", "key", F.lit(k))
        if not k:
            graded = graded.join(degrees, "node")
        centre = F.max(F.struct(*([] if k else ["degree"]), order.alias("h"), "node", "size", "pos", "component")).alias("c")
        met = graded.join(graded.groupBy("key").agg(centre), "key").where(
            (F.col("component") != F.col("c.component")) & may_reach(F.col("size"), F.col("c.size"), F.col("pos"), F.col("c.pos"))
        )
        met = met.select("node", F.col("c.node").alias("other")).distinct()
        met = met.withColumn("_n", F.row_number().over(Window.partitionBy("node").orderBy(F.xxhash64("node", "other")))).where(F.col("_n") <= STARS)
        stars = materialise(met.select(F.least("node", "other").alias("a"), F.greatest("node", "other").alias("b")).distinct(), "stars")
        free_shuffles(documents.sparkSession)
        near = similar(stars, documents, nodes)
        found = near if found is None else found.unionByName(near)
        labels = components(found)
        discard(stars)
    left = held.join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))
    pairs = materialise(apart(left, nodes), "apart")
    free_shuffles(documents.sparkSession)
    out = found.unionByName(similar(pairs, documents, nodes))
    discard(pairs, held, nodes)
    return out
