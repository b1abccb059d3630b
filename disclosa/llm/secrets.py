"""Secret scans over an incremental ledger of content-addressed texts.

Every version of every path is named by the SHA-256 of its text. A ledger row says which rule versions a blob has been
scanned with and which spans each of them found. A run scans only (blob, rule version) pairs that the ledger lacks, each
distinct text once, appends them to the stored ledger, and joins the findings of the rules in force back to all paths:
findings of an older version or of a withdrawn rule stay in the ledger and leave the result. Main path: DataFrame
functions only.

Null and empty texts are the blob of the empty string and have no spans; repeated rows each get their row back; an
empty table gives an empty result; further columns of the input are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from disclosa.llm.common import digest, exists, let, materialise


@dataclass(frozen=True)
class Rule:
    """kind, version, pattern; a match counts if its group has at_least characters. gate: a cheap necessary pattern."""

    kind: str
    version: int
    pattern: str
    group: int = 0
    at_least: int = 1

    @property
    def name(self) -> str:
        return f"{self.kind}@{self.version}"


#: The base kinds in their order, then the kinds this operator adds.
BASE_RULES = (
    Rule("assign", 1, r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    Rule("access", 1, r"AKIA[A-Z0-9]+", 0, 16),
    Rule("hex", 1, r"[0-9a-f]{32,}", 0, 32),  # maximal runs, so the length can stand in the pattern
)
ADDED_RULES = (
    Rule("pem", 1, r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----"),
    Rule("jwt", 1, r"eyJ[A-Za-z0-9_-]{8,1000}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("vcs", 1, r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("chat", 1, r"xox[abprs]-[A-Za-z0-9-]{10,}"),
)
RULES = BASE_RULES + ADDED_RULES

#: A span in the ledger, and one in the result: rank is the rule's place among the rules in force.
FOUND, SPAN = "struct<rule:string,start:int,end:int>", "struct<rank:int,kind:string,start:int,end:int>"
LEDGER = f"blob_id string, rules array<string>, spans array<{FOUND}>"


#: Matches that are put in place in one go; the spans of a text are appended so many at a time.
STEP = 256


def rule_spans(text: Column, rule: Rule) -> Column:
    """Leftmost non-overlapping matches as FOUND spans in code points, end exclusive; too short ones dropped after matching."""
    none = F.array().cast(f"array<{FOUND}>")

    def place(acc: Column, steps: Column) -> Column:
        def step(acc: Column, x: Column) -> Column:
            start = acc["at"] + F.length(x["gap"])
            end = start + F.length(x["found"])
            span = F.struct(F.lit(rule.name).alias("rule"), start.alias("start"), end.alias("end"))
            return F.struct(end.alias("at"), F.when(F.length(x["held"]) >= rule.at_least, F.concat(acc["out"], F.array(span))).otherwise(acc["out"]).alias("out"))

        return F.aggregate(steps, F.struct(acc["at"].alias("at"), none.alias("out")), step)

    def walk(parts: Column) -> Column:
        n = F.size(parts["found"])
        chunks = F.transform(
            F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0)), F.lit(STEP)),
            lambda i: F.arrays_zip(F.slice(F.slice(parts["gaps"], F.lit(1), n), i + 1, F.lit(STEP)).alias("gap"), F.slice(parts["found"], i + 1, F.lit(STEP)).alias("found"), F.slice(parts["held"], i + 1, F.lit(STEP)).alias("held")),
        )
        first = F.struct(F.lit(0).alias("at"), none.alias("out"))
        return F.aggregate(
            chunks, first, lambda acc, c: let(place(acc, c), lambda p: F.struct(p["at"].alias("at"), F.concat(acc["out"], p["out"]).alias("out"))), lambda acc: acc["out"]
        )

    parts = F.struct(
        F.split(text, rule.pattern, -1).alias("gaps"),
        F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0)).alias("found"),
        F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group)).alias("held"),
    )
    return F.when(text.rlike(rule.pattern), let(parts, walk)).otherwise(none)


def scan_blobs(blobs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """LEDGER rows for blobs(blob_id, text, todo): each is scanned with the rules named in todo."""
    spans = F.concat(*(F.when(F.array_contains("todo", r.name), rule_spans(F.col("text"), r)).otherwise(F.array().cast(f"array<{FOUND}>")) for r in rules))
    return blobs.select("blob_id", F.col("todo").alias("rules"), spans.alias("spans"))


def unseen(paths: DataFrame, ledger: DataFrame | None, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Each distinct text of paths(text) once, with the rule versions that the ledger has not yet applied to it."""
    names = F.array(*(F.lit(r.name) for r in rules))
    text = F.coalesce(F.col("text"), F.lit(""))
    blobs = paths.select(digest(text).alias("blob_id"), text.alias("text"))
    if ledger is None:
        return blobs.groupBy("blob_id").agg(F.first("text").alias("text")).withColumn("todo", names)
    seen = ledger.groupBy("blob_id").agg(F.array_distinct(F.flatten(F.collect_list("rules"))).alias("seen"))
    todo = F.array_except(names, F.coalesce("seen", F.array().cast("array<string>")))
    open_ids = (
        blobs.select("blob_id").distinct().join(seen, "blob_id", "left").select("blob_id", todo.alias("todo")).where(F.size("todo") > 0)
    )
    return blobs.join(open_ids, "blob_id").groupBy("blob_id").agg(F.first("text").alias("text"), F.first("todo").alias("todo"))


def in_force(ledger: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """blob_id, spans (SPAN) that the rules in force found, whatever run and order of rules they come from."""
    names = F.array(*(F.lit(r.name) for r in rules))
    kinds = F.array(*(F.lit(r.kind) for r in rules))

    def shown(s: Column) -> Column:
        rank = F.array_position(names, s["rule"]).cast("int")
        return F.struct((rank - 1).alias("rank"), F.element_at(kinds, rank).alias("kind"), s["start"].alias("start"), s["end"].alias("end"))

    held = F.transform(F.filter("spans", lambda s: F.array_contains(names, s["rule"])), shown)
    return ledger.where(F.arrays_overlap("rules", names)).select("blob_id", held.alias("spans"))


def scan(
    documents: DataFrame, ledger: DataFrame | None = None, rules: tuple[Rule, ...] = RULES, by: tuple[str, ...] = ("doc_id",)
) -> tuple[DataFrame, DataFrame]:
    """(findings, additions): per row of documents(*by, text) its spans, and what is to be appended to the ledger.

    by: the columns that name a version of a path. The additions are written to the shared folder before they are
    joined, so a lost executor rescans nothing.
    """
    paths = documents.select(*by, "text")
    additions = materialise(scan_blobs(unseen(paths, ledger, rules), rules), "secrets")
    if ledger is None:
        whole = in_force(additions, rules)
    else:  # several rows of a blob: one for each set of rules it was scanned with
        rows = in_force(ledger.unionByName(additions), rules)
        whole = materialise(rows.groupBy("blob_id").agg(F.array_distinct(F.flatten(F.collect_list("spans"))).alias("spans")), "secrets-all")
    keyed = paths.select(*by, digest(F.coalesce("text", F.lit(""))).alias("_blob"))
    found = whole.select(F.col("blob_id").alias("_blob"), F.col("spans").alias("_spans"))
    return keyed.join(found, "_blob").select(*by, F.col("_blob").alias("blob_id"), F.col("_spans").alias("spans")), additions


def scan_stored(documents: DataFrame, store: str, rules: tuple[Rule, ...] = RULES, by: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The findings of scan() with the ledger kept at `store`, which gets this run's additions."""
    spark = documents.sparkSession
    ledger = spark.read.schema(LEDGER).parquet(store) if exists(spark, store) else None
    found, additions = scan(documents, ledger, rules, by)
    additions.write.mode("append").parquet(store)
    return found


def joined(spans: Column) -> Column:
    """kind:start:end by start, then the kinds' order, joined by commas."""
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"], s["rank"], s["end"], s["kind"])))
    return F.array_join(F.transform(ordered, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
