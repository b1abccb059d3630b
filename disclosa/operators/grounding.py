"""Answers and case packs held against their sources: quotations, numbers, periods, judgements, references, dates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from disclosa.functions.text import allowed_numbers, collapse, fabricated, foreign_years, iso_date, judgements, later_dates, let, numbers

SUPPORTED, PARTLY, NOT = "SUPPORTED", "PARTIALLY_SUPPORTED", "UNSUPPORTED"


def status(hard, soft):  # noqa: ANN001, ANN201
    return F.when(hard, NOT).when(soft, PARTLY).otherwise(SUPPORTED)


def verdicts(answers: DataFrame, citations: DataFrame, sources: DataFrame) -> DataFrame:
    """A row for each of answers(answer_id, answer): the four checks and the status.

    citations(answer_id, document_id, quote), sources(answer_id, document_id, at, text). All joins are on answer_id; the
    texts of one answer's sources (the few that a question retrieves) are joined in order.
    """
    texts = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "text"))), lambda x: x["text"]), "\n")
    of_doc = sources.groupBy("answer_id", "document_id").agg(collapse(texts).alias("scope"))
    whole = sources.groupBy("answer_id").agg(texts.alias("sources"))
    held = answers.join(whole, "answer_id", "left").withColumn("sources", F.coalesce("sources", F.lit(""))).withColumn("hay", collapse(F.col("sources")))
    quote = collapse(F.coalesce("quote", F.lit("")))
    cited = citations.select("answer_id", "document_id", quote.alias("quote")).join(held.select("answer_id", "hay"), "answer_id").join(of_doc, ["answer_id", "document_id"], "left")
    real = F.col("quote") != ""
    judged = cited.select("answer_id", (real & F.col("hay").contains(F.col("quote"))).alias("anywhere"), (real & F.coalesce(F.col("scope").contains(F.col("quote")), F.lit(False))).alias("in_doc"))
    quotes = judged.groupBy("answer_id").agg(F.bool_or(~F.col("anywhere")).alias("lost"), F.bool_or(F.col("anywhere") & ~F.col("in_doc")).alias("misplaced"), F.count("*").alias("n_citations"))
    no = F.lit(False)
    out = held.join(quotes, "answer_id", "left").select(
        "answer_id", F.coalesce("n_citations", F.lit(0)).alias("n_citations"), F.coalesce("lost", no).alias("quote_lost"), F.coalesce("misplaced", no).alias("quote_misplaced"),
        fabricated(F.col("answer"), F.col("sources")).alias("fabricated"), foreign_years(F.col("answer"), F.col("hay")).alias("years"), judgements(F.col("answer"), F.col("hay")).alias("inferences"),
    )
    hard = F.col("quote_lost") | (F.size("fabricated") > 0)
    soft = F.col("quote_misplaced") | (F.size("years") > 0) | (F.size("inferences") > 0)
    return out.withColumn("status", status(hard, soft))


def degrade(drafts: DataFrame, extracts: DataFrame) -> DataFrame:
    """answer_id, answer, degraded: the draft unless it is UNSUPPORTED, then the extract."""
    bad = F.col("status") == NOT
    return drafts.join(extracts.withColumnRenamed("answer", "extract"), "answer_id", "left").select("answer_id", F.when(bad, F.col("extract")).otherwise(F.col("answer")).alias("answer"), bad.alias("degraded"))


def _cut(n: int):  # noqa: ANN202
    return lambda i: F.substring(F.col("text"), i, F.lit(n))


def containing(texts: DataFrame, needles: DataFrame, text_id: str, needle_id: str) -> DataFrame:
    """text_id, needle_id of texts(text_id, text) that hold needles(needle_id, needle) whole.

    Containment has no key of its own. A needle's second to fourth word, between white space, is a run of words of every
    text that holds it, so candidates meet on that run and are then compared whole. Needles without three inner words
    meet on their first three characters (fewer: all of them), which costs a text its distinct runs of characters; that
    way is taken only where there are such needles.
    """
    run = r"^\S*\s+(\S+)\s+(\S+)\s+(\S+)\s"
    part = lambda k: F.regexp_extract("needle", run, k)
    key = F.when(F.col("needle").rlike(run), F.concat_ws(" ", part(1), part(2), part(3)))
    held = needles.where("needle is not null").select(needle_id, "needle", key.alias("key"))
    three = let(
        F.split("text", r"\s+"),
        lambda w: F.array_distinct(F.transform(F.sequence(F.lit(0), F.greatest(F.size(w) - 3, F.lit(0))), lambda i: F.concat_ws(" ", F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)))),
    )
    keyed = texts.where("text is not null").select(text_id, F.explode(three).alias("key")).join(held.where("key is not null"), "key")
    short = held.where("key is null").select(needle_id, "needle", F.substring("needle", 1, 3).alias("key"))
    sizes = [r[0] for r in short.select(F.length("key")).distinct().collect()]  # four at most
    starts = lambda n: F.sequence(F.lit(1), F.greatest(F.length("text") - n + 1, F.lit(1)))
    for n in sizes:
        runs = F.array(F.lit("")) if not n else F.array_distinct(F.transform(starts(n), _cut(n)))
        met = texts.where("text is not null").select(text_id, F.explode(runs).alias("key")).join(short.where(F.length("key") == n), "key")
        keyed = keyed.unionByName(met)
    whole = keyed.select(text_id, needle_id, "needle").join(texts.select(text_id, "text"), text_id)
    return whole.where(F.col("text").contains(F.col("needle"))).select(text_id, needle_id).distinct()


def newly_grounded(evidence: DataFrame, found: DataFrame) -> DataFrame:
    """Evidence whose source text stands in one of the texts found for the same case; equi-join on case_id first."""
    pair = evidence.join(found.select("case_id", "text").withColumnRenamed("text", "_text"), "case_id")
    return pair.where(F.col("_text").contains(F.col("source_text"))).select("case_id", "evidence_id").distinct()


def grounding(evidence: DataFrame, documents: DataFrame) -> DataFrame:
    """case_id, evidence_id, problem (null: grounded) of every evidence: dangling, not in the document, made-up numbers."""
    both = evidence.join(documents.select("case_id", "document_id", "original_text"), ["case_id", "document_id"], "left")
    invented = F.size(F.array_except(numbers(F.col("text")), allowed_numbers(F.col("source_text")))) > 0
    problem = F.when(F.col("original_text").isNull(), "ref").when(~F.col("original_text").contains(F.col("source_text")), "grounding").when(invented, "numbers")
    return both.select("case_id", "evidence_id", problem.alias("problem"))


def grounding_summary(judged: DataFrame) -> DataFrame:
    good = F.col("problem").isNull()
    return judged.groupBy("case_id").agg(F.count("*").alias("n_evidence"), F.count_if(good).alias("n_evidence_grounded"), F.bool_and(good).alias("all_evidence_grounded"))


def dangling(users: DataFrame, evidence: DataFrame) -> DataFrame:
    """References of users(case_id, user_id, evidence_ids) to evidence that does not exist."""
    refs = users.select("case_id", "user_id", F.explode("evidence_ids").alias("evidence_id"))
    return refs.join(evidence.select("case_id", "evidence_id"), ["case_id", "evidence_id"], "left_anti")


def leakage(cases: DataFrame, documents: DataFrame, futures: DataFrame) -> DataFrame:
    """case_id, kind, what: documents after the case's date, future events not after it, their names in earlier text.

    cases(case_id, simulation_date, pre_play), documents(case_id, document_id, document_date), futures(case_id, date,
    source_document_id). A later date within the text is only a warning (kind future-date).
    """
    day = cases.select("case_id", "simulation_date")
    late = documents.join(day, "case_id").where("document_date > simulation_date").select("case_id", F.lit("document").alias("kind"), F.col("document_id").alias("what"))
    early = futures.join(day, "case_id").where("date <= simulation_date").select("case_id", F.lit("event").alias("kind"), F.col("source_document_id").alias("what"))
    tail = F.when(F.col("source_document_id").contains("_"), F.regexp_extract("source_document_id", "^[^_]*_(.*)$", 1))
    names = futures.select("case_id", F.explode(F.array_compact(F.array("source_document_id", tail))).alias("what")).distinct()
    told = names.join(cases.select("case_id", "pre_play"), "case_id").where(F.col("pre_play").contains(F.col("what"))).select("case_id", F.lit("name").alias("kind"), "what")
    dates = cases.select("case_id", F.lit("future-date").alias("kind"), F.explode(later_dates(F.col("pre_play"), F.to_date("simulation_date"))).alias("what"))
    return late.unionByName(early).unionByName(told).unionByName(dates)


def manifest_consistency(documents: DataFrame, manifest: DataFrame, companies: DataFrame) -> DataFrame:
    """case_id, doc_id, problem of documents(case_id, doc_id, document_date) that the manifest contradicts.

    companies(case_id, corp_code)
    """
    real = manifest.select("doc_id", "rcept_dt", F.col("corp_code").alias("_corp"))
    both = documents.join(companies, "case_id").join(real, "doc_id", "left")
    found = F.array(
        F.when(F.col("_corp").isNull(), "missing"), F.when(iso_date(F.col("rcept_dt")) != F.col("document_date"), "date"), F.when(F.col("_corp") != F.col("corp_code"), "company")
    )
    return both.select("case_id", "doc_id", F.explode(F.array_compact(found)).alias("problem"))
