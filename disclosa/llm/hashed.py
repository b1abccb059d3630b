"""What the two text classifiers share: hashed words, bounded labelled samples, batches of codes."""

from __future__ import annotations

import pickle
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from disclosa.llm.common import pieces, thrifty

#: Words whose hashes a Python worker keeps.
KEPT = 150_000
#: Bits of the map that tells which documents may be labelled.
MAP_BITS = 1 << 24


class Codes(dict):
    """word -> 63-bit hash, computed once and kept for KEPT words."""

    def __missing__(self, word: str) -> int:
        if len(self) >= KEPT:
            self.clear()
        self[word] = code = xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass")) >> 1
        return code


def coder(pattern: str, lower: bool) -> Callable[[str | None], np.ndarray]:
    """A function from a text to the hashes of its words, in order."""
    find, codes = re.compile(pattern).findall, Codes()

    def run(text: str | None) -> np.ndarray:
        words = find(text.lower() if lower else text) if text else []
        return np.fromiter(map(codes.__getitem__, words), dtype=np.int64, count=len(words))

    return run


def training_rows(documents: DataFrame, labels: DataFrame, label: str, learn: tuple[int, int], per_class: int | None) -> DataFrame:
    """doc_id, y, lang, text of at most per_class labelled documents of either class, in a keyed random order; None: of all.

    learn: (modulus, remainder): rows whose crc32(doc_id as text) mod modulus equals the remainder are held out. Ids
    labelled both ways teach nothing and are left out; of rows with the same id the one with the smallest hash of its
    text is taken, so the sample is at most 2 * per_class rows whatever repeats, and its ids may be broadcast; all rows are joined as Spark chooses.
    """
    modulus, remainder = learn
    usable = labels.select("doc_id", F.col(label).cast("int").alias("y")).where(F.col("y").isin(0, 1) & F.col("doc_id").isNotNull())
    usable = usable.where(fold(modulus) != remainder).groupBy("doc_id").agg(F.min("y").alias("y"), F.max("y").alias("_y")).where("y = _y")
    if per_class is None:
        chosen = usable.select("doc_id", "y")
    else:
        usable = usable.withColumn("_order", F.xxhash64("doc_id", F.lit(label)))
        parts = [usable.where(F.col("y") == y).orderBy("_order", "doc_id").limit(per_class).select("doc_id", "y") for y in (0, 1)]
        chosen = F.broadcast(parts[0].unionByName(parts[1]))
    named = documents if "lang" in documents.columns else documents.withColumn("lang", F.lit(None).cast("string"))
    held = named.select("doc_id", "text", "lang")
    held = (held if per_class is not None else perhaps(held, chosen)).join(chosen, "doc_id")
    one = F.min(F.struct(F.xxhash64("text").alias("h"), "text", "lang")).alias("one")
    return held.groupBy("doc_id", "y").agg(one).select("doc_id", "y", "one.lang", "one.text")


def perhaps(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """rows without most of those whose doc_id is not in ids, before they are shuffled: by a bitmap of the ids' hashes.

    The bitmap has at most MAP_BITS / 64 rows, so it may be broadcast; no row with an id of ids goes.
    """
    place = lambda c: F.pmod(F.xxhash64(F.col(c).cast("string")), F.lit(MAP_BITS))
    word = lambda p: F.shiftright(p, 6)
    bit = lambda p: F.call_function("shiftleft", F.lit(1).cast("long"), p.bitwiseAND(F.lit(63)).cast("int"))
    marks = ids.groupBy(word(place("doc_id")).alias("_word")).agg(F.bit_or(bit(place("doc_id"))).alias("_bits"))
    at = rows.withColumn("_at", place("doc_id")).withColumn("_word", word(F.col("_at")))
    return at.join(F.broadcast(marks), "_word").where(F.col("_bits").bitwiseAND(bit(F.col("_at"))) != 0).select(*rows.columns)


def held_out(modulus: int, remainder: int) -> Column:
    """Whether a row belongs to the held-out fold; one without an id does not."""
    return F.coalesce(fold(modulus) == remainder, F.lit(False))


def fold(modulus: int) -> Column:
    """crc32 of the doc_id as text, modulo."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % modulus


def trained(rows: DataFrame, code: Callable[[str | None], np.ndarray], longest: int, learn: Callable[[list[np.ndarray], np.ndarray, list], object]) -> object:
    """learn(hashes, labels, languages) of rows(doc_id, y, text, lang), sorted by doc_id, made by one task.

    The rows are training_rows(), a bounded sample; texts of more than `longest` words are left out of it, so that task
    holds at most so many hashes a row. Only the model, of fixed size, comes to the driver.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [code(t.as_py()) for t in batch.column(3)]
            keep = pa.array([len(g) <= longest for g in got])
            made = pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(got, pa.list_(pa.int64()))], names=["doc_id", "y", "lang", "codes"])
            yield made.filter(keep)

    def fit(held: pa.Table) -> pa.Table:
        held = held.sort_by([("doc_id", "ascending")])
        codes = [np.asarray(x.values, dtype=np.int64) for x in held.column("codes")]
        return pa.table({"model": pa.array([pickle.dumps(learn(codes, held.column("y").to_numpy().astype(np.float64), held.column("lang").to_pylist()))], pa.binary())})

    shaped = rows.select(F.col("doc_id").cast("long").alias("doc_id"), "y", "lang", "text")
    found = shaped.mapInArrow(run, "doc_id long, y int, lang string, codes array<long>").withColumn("one", F.lit(1)).groupBy("one").applyInArrow(fit, "model binary").collect()
    return pickle.loads(found[0].model) if found else learn([], np.zeros(0), [])


def scored(documents: DataFrame, columns: str, score: Callable[[list[str | None]], np.ndarray], extra: list[str]) -> DataFrame:
    """documents' doc_id and extra columns with a score of every whole text, a piece of a batch at a time."""
    kinds = {f.name: f.dataType.simpleString() for f in documents.schema}
    keep = ["doc_id", *extra]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, len(keep)):
            got = score([t.as_py() for t in batch.column(len(keep))])
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], pa.array(got, pa.float64())], names=[*keep, columns])

    schema = ", ".join([*(f"`{c}` {kinds[c]}" for c in keep), f"{columns} double"])
    return documents.select(*keep, F.col("text").cast("string").alias("_scored")).mapInArrow(thrifty(run, keep=True), schema)
