"""Mixing sources to target weights with a low-discrepancy schedule.

Slot i of the mix goes to the source whose share of the cumulative targets holds the golden-ratio point frac(i / phi);
the r-th slot of a source takes the r-th block of equal word count from the source's documents in a keyed random order,
read twice over where the target asks for it. Ranks and places are prefix sums in levels (small buckets, chunks of
buckets, chunks of a source), so no source is ever sorted or summed in one task.

A null text has size 0 and is never taken; the null source is a source of its own and comes last; repeated rows and ids
are separate documents (rows with the same id and text are placed as one run and told apart by their number in it); an
empty table gives an empty result; further columns of the input, whatever their names, are carried by mixed_rows() and
ignored otherwise.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from disclosa.llm.common import materialise, words

#: The weights of the sources in turn, the share of all words in the mix, and the most a source repeats.
WEIGHTS, SHARE, MOST = (5, 2, 1), 1.5, 2
#: Words of a block at most, and slots of a mix at least (small corpora get smaller blocks).
BLOCK_WORDS, SLOTS = 4096, 16384
#: Rows of a bucket of documents, and slots of a bucket of slots, about.
BUCKET_ROWS, BUCKET_SLOTS = 512, 256
#: Buckets whose sums are added up in one window.
CHUNK = 4096
#: Fixed value: 2^32 over the golden ratio.
GOLDEN, UNIT = 2654435769, 1 << 32
KEY = "mix-1"


def source_key(source: Column) -> Column:
    """A non-null key that sorts as the source does, null last."""
    return F.when(source.isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), source))


def targets(sizes: DataFrame) -> DataFrame:
    """key, source_size, target of sizes(key, source_size): SHARE of all words by weight, filled up to MOST times a source.

    Sources in order of cap over weight fill up one after another; the first that does not fill gives the level of the
    rest. Windows over the whole table: it has one row for each source.
    """
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), (F.row_number().over(Window.orderBy("key")) - 1) % len(WEIGHTS) + 1)
    capped = sizes.select("key", "source_size", weight.alias("w"), (F.col("source_size") * MOST).alias("cap"))
    order = Window.orderBy(F.col("cap").cast("double") / F.col("w"), "key")
    everything = Window.partitionBy(F.lit(1))
    before, after = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing)
    level = (SHARE * F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0))) / F.sum("w").over(after)
    filled = capped.withColumn("level", level).withColumn("full", F.col("cap") < F.col("w") * F.col("level"))
    open_level = F.max(F.when(~F.col("full"), F.col("level"))).over(everything)
    return filled.select(
        "key", "source_size", F.when(F.col("full"), F.col("cap").cast("double")).otherwise(F.col("w") * open_level).alias("target")
    )


def order_hash(doc_id: Column, text: Column) -> Column:
    """60 bits of a keyed digest of a document as a long."""
    named = F.concat(F.lit(KEY + ":"), F.coalesce(doc_id.cast("string"), F.lit("null")), F.lit(":"), F.md5(F.coalesce(text, F.lit(""))))
    return F.conv(F.substring(F.md5(named), 1, 15), 16, 10).cast("long")


def two_level(rows: DataFrame, bucket: str, amount: Column, order: list[Column]) -> DataFrame:
    """rows(key, bucket, ...) with row (its number in the bucket) and before (the amounts of a key's earlier rows)."""
    within = Window.partitionBy("key", bucket).orderBy(*order)
    sums = rows.groupBy("key", bucket).agg(F.sum(amount).alias("amount")).withColumn("_chunk", F.expr(f"{bucket} div {CHUNK}"))
    earlier = Window.partitionBy("key", "_chunk").orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    above = Window.partitionBy("key").orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    chunks = sums.groupBy("key", "_chunk").agg(F.sum("amount").alias("_sum")).select("key", "_chunk", F.coalesce(F.sum("_sum").over(above), F.lit(0)).alias("_above"))
    starts = sums.join(chunks, ["key", "_chunk"]).select("key", bucket, (F.col("_above") + F.coalesce(F.sum("amount").over(earlier), F.lit(0))).alias("start"))
    inside = F.coalesce(F.sum(amount).over(within.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = rows.withColumns({"row": F.row_number().over(within), "inside": inside})
    return placed.join(starts, ["key", bucket]).withColumn("before", F.col("start") + F.col("inside")).drop("start", "inside")


@dataclass
class Mix:
    """placed: a row for each document with its place in its source's order; pieces: which words of it fill which slot."""

    placed: DataFrame
    pieces: DataFrame


def slots(quotas: DataFrame, block: int, n: int) -> DataFrame:
    """key, rank, slot: n golden-ratio slots, and one at the end for each block of quotas(key, quota, target) left over."""
    bits = max(4, min(20, (n // 4096).bit_length()))
    total = Window.partitionBy(F.lit(1))
    upto = Window.orderBy("key").rowsBetween(Window.unboundedPreceding, 0)
    edge = lambda c: F.floor(c / F.sum("target").over(total) * UNIT)
    spans = (
        quotas.where("target > 0")
        .select("key", edge(F.sum("target").over(upto) - F.col("target")).alias("lo"), edge(F.sum("target").over(upto)).alias("hi"))
        .withColumn("lo", F.coalesce(F.lag("hi").over(Window.orderBy("key")), F.lit(0)))
        .where("hi > lo")
        .withColumn("cell", F.explode(F.expr(f"sequence(lo div {UNIT >> bits}, (hi - 1) div {UNIT >> bits})")))
    )
    drawn = quotas.sparkSession.range(n).select(F.col("id").alias("slot"), F.expr(f"pmod(pmod(id, {1 << 31}) * {GOLDEN}, {UNIT})").alias("u"))
    drawn = drawn.withColumn("cell", F.expr(f"u div {UNIT >> bits}"))
    sent = drawn.join(spans, (drawn.cell == spans.cell) & (drawn.u >= spans.lo) & (drawn.u < spans.hi)).select("key", "slot")
    ranked = two_level(sent.withColumn("chunk", F.expr(f"slot div {BUCKET_SLOTS}")), "chunk", F.lit(1), [F.col("slot")])
    ranked = materialise(ranked.select("key", F.col("before").alias("rank"), "slot"), "slots")
    given = ranked.groupBy("key").agg(F.count("*").alias("given"))
    need = F.ceil(F.col("quota") / block)
    short = quotas.join(given, "key", "left").select("key", F.coalesce("given", F.lit(0)).alias("given"), need.alias("need")).where("given < need")
    earlier = F.sum(F.col("need") - F.col("given")).over(Window.orderBy("key").rowsBetween(Window.unboundedPreceding, -1))
    late = short.withColumn("start", F.lit(n) + F.coalesce(earlier, F.lit(0)) - F.col("given"))
    late = late.select("key", F.col("start"), F.explode(F.expr("sequence(given, need - 1)")).alias("rank"))
    return ranked.unionByName(late.select("key", "rank", (F.col("start") + F.col("rank")).alias("slot")))


def one_by_one(runs: DataFrame) -> DataFrame:
    """A row for each of the `copies` documents of a run, with `copy` and its own `before`; long runs are dealt out first."""
    many = runs.where("copies > 1").withColumn("part", F.explode(F.expr("sequence(0, (copies - 1) div 1024)")))
    many = many.repartition("key", "bucket", "row", "part").withColumn("copy", F.explode(F.expr("sequence(part * 1024, least(copies, part * 1024 + 1024) - 1)"))).drop("part")
    return runs.where("copies = 1").withColumn("copy", F.lit(0).cast("long")).unionByName(many).withColumn("before", F.expr("before + copy * size"))


def keyed(documents: DataFrame) -> DataFrame:
    return documents.select("doc_id", source_key(F.col("source")).alias("key"), F.size(words(F.col("text"))).cast("long").alias("size"), order_hash(F.col("doc_id"), F.col("text")).alias("h"))


def mix(documents: DataFrame) -> Mix:
    """Schedules documents(doc_id, text, source)."""
    rows = materialise(keyed(documents), "sizes")
    sizes = rows.groupBy("key").agg(F.sum("size").alias("source_size"))
    quotas = materialise(targets(sizes).withColumn("quota", F.round("target").cast("long")), "quotas")
    n, total = rows.count(), quotas.agg(F.sum("quota")).first()[0] or 0
    block = max(1, min(BLOCK_WORDS, total // SLOTS))
    buckets = max(1, -(-n // BUCKET_ROWS))
    runs = rows.groupBy("key", "h", "doc_id", "size").agg(F.count("*").alias("copies"))
    bucketed = runs.withColumn("bucket", F.expr(f"(shiftright(h, 28) * {buckets}) div {UNIT}"))
    placed = two_level(bucketed, "bucket", F.col("size") * F.col("copies"), [F.col("h"), F.col("doc_id"), F.col("size")])
    placed = materialise(one_by_one(placed).join(quotas, "key"), "placed")
    passes = placed.withColumn("pass", F.explode(F.expr(f"sequence(0, {MOST - 1})")))
    start = F.col("before") + F.col("pass") * F.col("source_size")
    taken = passes.withColumns({"lo": start, "hi": F.least(start + F.col("size"), F.col("quota"))}).where("hi > lo")
    cut = taken.withColumn("rank", F.explode(F.expr(f"sequence(lo div {block}, (hi - 1) div {block})")))
    first, last = F.greatest(F.col("lo"), F.col("rank") * block), F.least(F.col("hi"), (F.col("rank") + 1) * block)
    named = ["key", "bucket", "row", "copy", "copies", "doc_id", "h", "size"]
    parts = cut.select("rank", *named, (first - F.col("lo")).alias("from_word"), (last - first).alias("n_words"))
    pieces = parts.join(slots(quotas, block, -(-total // block)), ["key", "rank"])
    return Mix(placed, pieces.select("slot", *named, "from_word", "n_words"))


def taken_words(m: Mix) -> DataFrame:
    """doc_id, size, source_size, target, taken, first_slot (null: not taken) for every document of a mix."""
    at = ["key", "bucket", "row", "copy"]
    sums = m.pieces.groupBy(*at).agg(F.sum("n_words").alias("taken"), F.min("slot").alias("first_slot"))
    return m.placed.join(sums, at, "left").select(
        "doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"), F.col("first_slot").cast("long").alias("first_slot")
    )


def mixed_rows(documents: DataFrame) -> DataFrame:
    """Whole documents in the order of the schedule: one row for each slot in which a pass through a source begins a document.

    Rows keep their columns. Rows with the same id and text are numbered in one task, by all their columns.
    """
    pieces = mix(documents).pieces
    starts = materialise(pieces.where("from_word = 0").select("slot", "key", "h", "doc_id", "size", "copy", "copies"), "starts")
    same = ["_key", "_h", "_id", "_size"]
    names = [F.col("key").alias("_key"), F.col("h").alias("_h"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null")).alias("_id"), F.col("size").alias("_size")]
    held = documents.select(F.struct("*").alias("_row")).select("_row", *(F.col(f"_row.{c}").alias(c) for c in ("doc_id", "text", "source")))
    held = held.select("_row", source_key(F.col("source")).alias("key"), order_hash(F.col("doc_id"), F.col("text")).alias("h"), "doc_id", F.size(words(F.col("text"))).cast("long").alias("size"))
    held = held.select("_row", *names)
    once = starts.where("copies = 1").select(*names, "slot").groupBy(*same).agg(F.collect_list("slot").alias("_slots"))  # a slot for each pass
    single = held.join(once, same).select("_row", F.explode("_slots").alias("_slot"))
    often = starts.where("copies > 1").select(*names, F.col("copy").alias("_copy"), F.col("slot").alias("_slot"))
    text = F.to_json("_row")
    again = held.join(often.select(*same).distinct(), same, "left_semi").withColumn("_copy", F.row_number().over(Window.partitionBy(*same).orderBy(text)).cast("long") - 1)
    again = again.join(often, [*same, "_copy"]).select("_row", "_slot")
    return single.unionByName(again).orderBy("_slot").select("_row.*")
