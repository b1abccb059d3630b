"""Quality rules as a short-circuit cascade.

Base measures are computed for every text, as they are part of the result. The further rules are tried in order of
rejections per cost, both estimated on a sample: the cost of a rule is the work it does on a row (characters its patterns
read, one for comparing measures), so the order is the same each time. A row stops at the first rule that rejects it
(CASE WHEN), and the verdict is the same in any order.
Main path: DataFrame functions only.

Null and empty texts have no words and fail the base rule; repeated rows each get their verdict; an empty table gives
an empty result; further columns of the input are kept out of the way (measures() takes the text column alone).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from disclosa.llm.common import let, words

#: Words in a repeated window.
WINDOW = 5
#: Bits of a packed entry that hold a window's place; longer texts are compared as text.
PLACE_BITS = 20
#: Rows that the costs and selectivities are estimated on, about.
SAMPLE_ROWS = 2000


def repeated_words(array: Column) -> Column:
    """Words within windows of five that occur twice or more in the array, the first occurrence included.

    64-bit hashes stand for the windows (in a text of 20,000 words two differ wrongly once in 1e11 texts). The
    array is bound once, so that a filter pushed below its projection cannot split the text anew for every window.
    """
    return let(array, _repeated)


def _repeated(w: Column) -> Column:
    none = F.lit(0).cast("long")

    def shifted(h: Column, k: int) -> Column:
        return F.slice(h, F.lit(k + 1), F.size(h))

    def windows(h: Column) -> Column:
        """64-bit hashes of the windows, from hashes of 1, 2 and 4 words."""
        two = F.zip_with(h, shifted(h, 1), lambda a, b: F.xxhash64(a, b))
        four = let(two, lambda t: F.zip_with(t, shifted(t, 2), lambda a, b: F.xxhash64(a, b)))
        five = F.zip_with(four, shifted(h, 4), lambda a, b: F.xxhash64(a, b))
        return F.slice(five, F.lit(1), F.size(h) - (WINDOW - 1))

    def covered(pos: Column) -> Column:
        steps = F.zip_with(pos, shifted(pos, 1), lambda a, b: F.least(F.lit(WINDOW), F.coalesce(b - a, F.lit(WINDOW))).cast("long"))
        return F.aggregate(steps, none, lambda acc, x: acc + x)

    def twice(s: Column, same: Callable[[Column, Column], Column], at: Callable[[Column], Column]) -> Column:
        """Sorted positions of the entries of s that equal a neighbour."""
        near = lambda x, j: F.coalesce(same(x, F.get(s, j)), F.lit(False))
        return F.array_sort(F.transform(F.filter(s, lambda x, j: near(x, j + 1) | near(x, j - 1)), at))

    def by_hash(h: Column) -> Column:
        """Sorts hash and position in one long; 44 bits of a hash order the windows."""
        packed = F.array_sort(F.transform(h, lambda x, i: F.shiftleft(x, PLACE_BITS).bitwiseOR(i.cast("long"))))
        place = F.lit(2**PLACE_BITS - 1)
        return let(packed, lambda s: twice(s, lambda x, y: F.shiftrightunsigned(x.bitwiseXOR(y), PLACE_BITS) == 0, lambda x: x.bitwiseAND(place).cast("int")))

    def false_pair(h: Column, pos: Column) -> Column:
        """Whether the positions hold a 64-bit hash once only: then 44 bits agreed by chance."""
        held = F.transform(pos, lambda i: F.get(h, i))
        return let(F.array_sort(held), lambda s: F.exists(F.transform(s, lambda x, j: F.coalesce(x == F.get(s, j - 1), F.lit(False)) | F.coalesce(x == F.get(s, j + 1), F.lit(False))), lambda ok: ~ok))

    keys = F.transform(
        F.sequence(F.lit(0), F.size(w) - WINDOW), lambda i: F.struct(F.concat_ws(" ", *(F.get(w, i + k) for k in range(WINDOW))).alias("key"), i.alias("at"))
    )
    by_text = let(F.array_sort(keys), lambda s: twice(s, lambda x, y: x["key"] == y["key"], lambda x: x["at"]))

    def places(h: Column) -> Column:
        quick = let(by_hash(h), lambda pos: F.when(~false_pair(h, pos), pos).otherwise(by_text))
        return F.when(F.size(h) < 2**PLACE_BITS, quick).otherwise(by_text)

    found = let(
        let(F.transform(w, lambda x: F.xxhash64(x)), windows),
        lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), none).otherwise(let(places(h), covered)),
    )
    return F.when(F.size(w) >= WINDOW, found).otherwise(none)


def line_repeats(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    return let(lines, lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("long"))


def measures(documents: DataFrame) -> DataFrame:
    """doc_id, text and the base measures of every whole text, with base_failed."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return (
        documents.select("doc_id", text.alias("text"), words(text).alias("w"))
        .select(
            "doc_id",
            "text",
            F.size("w").cast("long").alias("n_words"),
            F.length(F.array_join("w", "")).cast("long").alias("word_chars"),
            F.length(F.regexp_replace("text", r"[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
            line_repeats(F.col("text")).alias("n_dup_lines"),
            repeated_words(F.col("w")).alias("n_repeat_words"),
        )
        .withColumn("base_failed", (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words")))
    )


@dataclass(frozen=True)
class Rule:
    """A rejecting condition over the columns of measures(), and the characters that it reads of a row."""

    name: str
    rejects: Callable[[], Column]
    reads: Callable[[], Column] = lambda: F.lit(0)


#: Fixed thresholds; a rule rejects where its condition holds.
RULES = (
    Rule("symbols", lambda: F.col("n_symbols") * 10 > F.col("n_words")),
    Rule("word_length", lambda: (F.col("word_chars") < 2 * F.col("n_words")) | (F.col("word_chars") > 14 * F.col("n_words"))),
    Rule("dup_lines", lambda: F.col("n_dup_lines") * 3 > F.size(F.split("text", "\n")), lambda: F.length("text")),
    Rule("shouting", lambda: F.length(F.regexp_replace("text", "[^A-Z]+", "")) * 2 > F.col("word_chars"), lambda: F.length("text")),
    Rule("exclaiming", lambda: F.length(F.regexp_replace("text", "[^!]+", "")) * 4 > F.col("n_words"), lambda: F.length("text")),
)


def order_rules(measured: DataFrame, rules: tuple[Rule, ...] = RULES) -> list[Rule]:
    """The rules by rejections per unit of work over a sample of measured; rows that the base rule rejects don't count."""
    open_ = ~F.col("base_failed")
    sums = [x for k, r in enumerate(rules) for x in (F.count_if(open_ & F.coalesce(r.rejects(), F.lit(False))).alias(f"hits_{k}"), F.sum(F.when(open_, r.reads() + 1)).alias(f"work_{k}"))]
    found = measured.agg(*sums).first()
    rate = {k: (found[f"hits_{k}"] + 0.5) / max(1, found[f"work_{k}"] or 0) for k in range(len(rules))}
    return [rules[k] for k in sorted(rate, key=lambda k: (-rate[k], k))]


def verdict(ordered: list[Rule]) -> Column:
    """True unless the base rule or a rule of the cascade rejects; later rules are not evaluated after a rejection."""
    out = F.when(F.col("base_failed"), F.lit(False))
    for rule in ordered:
        out = out.when(F.coalesce(rule.rejects(), F.lit(False)), F.lit(False))
    return out.otherwise(F.lit(True))


def judge(documents: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """measures() of every row with kept."""
    few = documents.select("doc_id", "text")
    rows = few.count()
    ordered = order_rules(measures(few.where(F.rand(7) < min(1.0, SAMPLE_ROWS / max(rows, 1)))), rules)
    return measures(few).withColumn("kept", verdict(ordered)).drop("text")
