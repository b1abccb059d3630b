"""SimHash near-duplicates through a Gray-order hierarchical index.

Fingerprints are made once per row; equal ones are one node. Every pair of distinct fingerprints within two bits agrees
on one of three parts of the bits (the index's top: shared masked patterns), so a fingerprint goes to three buckets. A
bucket with more than BUCKET of them is divided again by three parts of its free bits, and again; no pair is lost and no
bucket is cut. Within a bucket fingerprints are sorted by Gray rank; groups of neighbours keep the bits they share, and
two groups are dropped when those bits already differ in more than two places, level by level down to the fingerprints.

Null and empty texts have fingerprint zero and are linked like any other; texts are taken whole; repeated rows link with
each other; an empty table gives an empty result; further columns of the input are kept by one_of_each() and ignored
otherwise.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from disclosa.llm import similar
from disclosa.llm.common import materialise
from disclosa.llm.components import components

SHINGLE, SEED, BITS = 3, 42, 64
#: Fingerprints compared in one go, at most; a fuller bucket is divided first.
BUCKET = 2048
LEAF, FAN = 16, 8


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    """Bit b is set if it is in over half the hashes of the text's shingles, repeats included."""
    w = text.encode("utf-8", "surrogatepass").lower().split()  # bytes: only A-Z and the six ASCII spaces
    if not w:
        return 0
    digest = xxhash.xxh64_intdigest
    if len(w) <= shingle:
        return digest(b" ".join(w), SEED)
    counts, total = np.zeros(BITS, dtype=np.int64), len(w) - shingle + 1
    for k in range(0, total, 8192):
        part = w[k : k + 8192 + shingle - 1]
        h = np.array([digest(b" ".join(s), SEED) for s in zip(*(part[i:] for i in range(shingle)), strict=False)], dtype="<u8")
        counts += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int32)
    return int(np.packbits(2 * counts > total, bitorder="little").view("<u8")[0])


def fingerprints(documents: DataFrame) -> DataFrame:
    """doc_id, fp (the 64 bits as a signed long)."""
    kind = documents.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(t.as_py() or "") for t in batch.column(1)], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view(np.int64))], names=["doc_id", "fp"])

    return documents.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(run, f"doc_id {kind}, fp long")


def gray_rank(x: np.ndarray) -> np.ndarray:
    """Where a code word stands in Gray order."""
    out = x.copy()
    for k in (1, 2, 4, 8, 16, 32):
        out ^= out >> np.uint64(k)
    return out


def index_levels(fps: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """(pattern, shared mask) of the groups at each level, from the fingerprints' leaves up; fps in Gray order."""
    full = ~np.zeros(len(fps), dtype=np.uint64)
    levels, width = [(fps, full)], LEAF
    while len(levels[-1][0]) > 1:
        pattern, mask = levels[-1]
        starts = np.arange(0, len(pattern), width)
        all_and, all_or = np.bitwise_and.reduceat(pattern, starts), np.bitwise_or.reduceat(pattern, starts)
        shared = np.bitwise_and.reduceat(mask, starts) & ~(all_and ^ all_or)
        levels.append((all_and & shared, shared))
        width = FAN
    return levels


def near_pairs(fps: np.ndarray, most: int = 2) -> tuple[np.ndarray, np.ndarray]:
    """Places i < j of all pairs of fps (sorted by Gray rank) that differ in at most `most` bits."""
    levels = index_levels(fps)
    i = j = np.zeros(1, dtype=np.int64)
    for depth in range(len(levels) - 2, -1, -1):
        pattern, mask = levels[depth]
        width = LEAF if depth == 0 else FAN
        steps = np.arange(width)
        i = np.repeat(i * width, width * width) + np.tile(np.repeat(steps, width), len(i))
        j = np.repeat(j * width, width * width) + np.tile(np.tile(steps, width), len(j))
        ok = (i < len(pattern)) & (j < len(pattern)) & (i <= j if depth else i < j)
        i, j = i[ok], j[ok]
        ok = np.bitwise_count((pattern[i] ^ pattern[j]) & mask[i] & mask[j]) <= most
        i, j = i[ok], j[ok]
    return (i, j) if len(levels) > 1 else (i[:0], j[:0])


def roots(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The smallest place reachable from each of n places over the pairs."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[i], root[j])
        new = root.copy()
        np.minimum.at(new, i, low)
        np.minimum.at(new, j, low)
        np.minimum.at(new, root[i], low)
        np.minimum.at(new, root[j], low)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def _parts(free: int) -> list[int]:
    """Three masks that share out the set bits of free."""
    bits = [b for b in range(BITS) if free >> b & 1]
    return [sum(1 << b for b in bits[k::3]) for k in range(3)]


def _signed(x: int) -> Column:
    return F.lit(x - (1 << BITS) if x >> (BITS - 1) else x).cast("long")


def buckets(nodes: DataFrame, most: int = BUCKET) -> DataFrame:
    """way, bits, fps: every bucket of nodes(fp) with two fingerprints or more, none with over `most`.

    A way is a chain of choices among three parts; its mask is what these parts fix. With eleven free bits or fewer a
    bucket of distinct fingerprints is small enough by itself.
    """
    masks = {str(k): m for k, m in enumerate(_parts((1 << BITS) - 1))}
    rows = nodes.select("fp", F.explode(F.array(*(F.struct(F.lit(w).alias("way"), F.col("fp").bitwiseAND(_signed(m)).alias("bits")) for w, m in masks.items()))).alias("k"))
    rows = rows.select("fp", "k.way", "k.bits")
    out = None
    while True:
        sizes = rows.groupBy("way", "bits").count()
        full = materialise(sizes.where(F.col("count") > most).select("way", "bits"), "full")
        ready = rows.join(full, ["way", "bits"], "left_anti").groupBy("way", "bits").agg(F.collect_list("fp").alias("fps")).where(F.size("fps") > 1)
        out = ready if out is None else out.unionByName(ready)
        if not full.limit(1).count():
            return out
        deeper = {w + str(k): m | part for w, m in masks.items() for k, part in enumerate(_parts(~m & ((1 << BITS) - 1)))}
        choice = lambda w: F.array(*(F.struct(F.lit(w + str(k)).alias("way"), F.col("fp").bitwiseAND(_signed(deeper[w + str(k)])).alias("bits")) for k in range(3)))
        chosen = F.coalesce(*(F.when(F.col("way") == w, choice(w)) for w in masks))
        rows = materialise(rows.join(full, ["way", "bits"], "left_semi").select("fp", F.explode(chosen).alias("k")).select("fp", "k.way", "k.bits"), "deeper")
        masks = deeper


def links(nodes: DataFrame) -> DataFrame:
    """a, b: for the linked fingerprints of every bucket a star around one of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = [], []
            for held in batch.column(0):
                fps = np.array(held.values, dtype=np.int64).view(np.uint64)
                fps = fps[np.argsort(gray_rank(fps))]
                i, j = near_pairs(fps)
                if len(i):
                    root = roots(len(fps), i, j)
                    at = np.flatnonzero(root != np.arange(len(fps)))
                    a.append(fps[at].view(np.int64))
                    b.append(fps[root[at]].view(np.int64))
            none = np.zeros(0, dtype=np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([none, *a])), pa.array(np.concatenate([none, *b]))], names=["a", "b"])

    return buckets(nodes).select("fps").mapInArrow(run, "a long, b long")


def same_texts(documents: DataFrame, prints: DataFrame) -> DataFrame:
    """a, b: fingerprints of prints(doc_id, fp, node, ...) whose texts have equal or similar sets of shingles."""
    of = materialise(prints.groupBy("node", "fp").agg(F.lit(1)).select("node", "fp"), "fp-of")
    least = of.groupBy("node").agg(F.min("fp").alias("least"))
    equal = of.join(least, "node").where("fp <> least").select(F.col("least").alias("a"), F.col("fp").alias("b"))
    near = similar.links(documents, prints)
    one, two = (least.select(F.col("node").alias(n), F.col("least").alias(f"_{n}")) for n in ("a", "b"))
    return equal.unionByName(near.join(one, "a").join(two, "b").select(F.col("_a").alias("a"), F.col("_b").alias("b")))


def grouped(documents: DataFrame, shingles: bool) -> tuple[DataFrame, DataFrame]:
    """(doc_id, fp of every row; fp, component, component_id of every fingerprint)."""
    whole = materialise(similar.prints(documents, fingerprint) if shingles else fingerprints(documents), "prints")
    prints = materialise(whole.select("doc_id", "fp"), "fps") if shingles else whole
    nodes = prints.groupBy("fp").agg(F.min("doc_id").alias("least"))
    found = links(nodes.select("fp"))
    if shingles:
        found = found.unionByName(same_texts(documents, whole))  # whole, with keys and sketches, is deleted there
    labels = components(found).select(F.col("node").alias("fp"), "component")
    named = materialise(nodes.join(labels, "fp", "left").select("fp", "least", F.coalesce("component", "fp").alias("component")), "named")
    smallest = materialise(named.groupBy("component").agg(F.min("least").alias("component_id")), "smallest")
    return prints.select("doc_id", "fp"), materialise(named.join(smallest, "component").select("fp", "component", "component_id"), "of")


def near_duplicates(documents: DataFrame, shingles: bool = True) -> DataFrame:
    """doc_id, fp, component_id (smallest doc_id reachable over links) for every row.

    Links are fingerprints of at most two bits' distance and, with shingles, texts whose sets of five-word shingles have
    a Jaccard similarity of 0.8 or more.
    """
    prints, of = grouped(documents, shingles)
    return prints.join(of, "fp").select("doc_id", "fp", "component_id")


def one_of_each(documents: DataFrame) -> DataFrame:
    """One row of each component of near copies, with all its columns: the one with the smallest doc_id.

    Of rows without an id or that share one, those go whose component has another row to stay; else the first by id
    (null last) and text stays. While the ids that go are few, the texts are not shuffled.
    """
    prints, of = grouped(documents, shingles=True)
    rows = prints.join(of, "fp")
    ids = materialise(rows.groupBy("doc_id").agg(F.count("*").alias("n"), F.min("component_id").alias("component_id"), F.min("component").alias("component")), "ids")
    odd = ids.where("n > 1 or doc_id is null")
    gone = materialise(ids.where("doc_id is not null and (n > 1 or doc_id <> component_id)").select("doc_id"), "gone")
    plain = documents.where("doc_id is not null").join(gone, "doc_id", "left_anti").select(*documents.columns)
    if not odd.limit(1).count():
        return plain
    names = odd.select(F.col("doc_id").alias("_odd"))
    held = documents.select(F.struct("*").alias("row"), F.col("doc_id").alias("_id"), F.col("text").cast("string").alias("_text"))
    held = held.join(names, held["_id"].eqNullSafe(names["_odd"]), "left_semi")
    kind = held.schema["row"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(t.as_py() or "") for t in batch.column(1)], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view(np.int64))], names=["row", "fp"])

    led = ids.where("n = 1 and doc_id = component_id").select("component")
    left = held.select("row", "_text").mapInArrow(run, f"row {kind}, fp long").join(of, "fp").join(led, "component", "left_anti")
    first = F.struct(F.col("row.doc_id").isNull(), F.col("row.doc_id"), F.col("row.text"))
    return plain.unionByName(left.groupBy("component").agg(F.min_by("row", first).alias("row")).select("row.*"))
