"""Cases: what is visible when, building and checking packs, briefings, terms, aspects of a question, evidence maps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: What a question can be about, by words that it contains, and the aspects of one that holds none of them.
ASPECTS = {"money": ("cash", "현금", "자금"), "purpose": ("why", "왜", "목적"), "size": ("how much", "얼마", "규모"), "when": ("when", "언제", "일정"), "risk": ("risk", "위험", "리스크")}
USUAL = ("money", "purpose")
#: Characters of a cell of an evidence map.
CELL = 90


def visible(documents: DataFrame, cases: DataFrame) -> DataFrame:
    """documents(case_id, document_date, ...) up to their case's simulation_date: an equi-join, then the dates."""
    return documents.join(cases.select("case_id", "simulation_date"), "case_id").where("document_date <= simulation_date").drop("simulation_date")


def latest(documents: DataFrame, cases: DataFrame) -> DataFrame:
    """case_id and the document visible last: latest date, then smallest id. One pass, no sort of a case."""
    order = F.max(F.struct("document_date", F.col("document_id"))).alias("x")
    return visible(documents, cases).groupBy("case_id").agg(order).select("case_id", "x.document_date", "x.document_id")


def filtered(manifest: DataFrame, since: str | None = None, until: str | None = None, **equal: str | list[str]) -> DataFrame:
    """Rows of the manifest before any search: columns equal to a value or one of several, rcept_dt within dates (YYYYMMDD)."""
    for column, value in equal.items():
        manifest = manifest.where(F.col(column).isin(value) if isinstance(value, list) else F.col(column) == value)
    if since is not None:
        manifest = manifest.where(F.col("rcept_dt") >= since)
    return manifest if until is None else manifest.where(F.col("rcept_dt") <= until)


def future_events(events: DataFrame) -> DataFrame:
    """case_id, events by date, then their place in the case."""
    held = F.array_sort(F.collect_list(F.struct("date", "ordinal", "title", "source_document_id")))
    return events.groupBy("case_id").agg(F.transform(held, lambda x: F.struct(x["date"].alias("date"), x["title"].alias("title"), x["source_document_id"].alias("source_document_id"))).alias("future_events"))


def briefing(cases: DataFrame) -> DataFrame:
    """A case without what must not be known at its start."""
    return cases.drop("future_events", "evidence", "validation")


def pack_checks(documents: DataFrame, evidence: DataFrame, futures: DataFrame, cases: DataFrame) -> DataFrame:
    """case_id, counts, last document and first future date, and the invariants that a case breaks.

    documents(case_id, document_date), evidence(case_id, importance), futures(case_id, date), cases(case_id, simulation_date)
    """
    d = documents.groupBy("case_id").agg(F.count("*").alias("n_documents"), F.max("document_date").alias("last_document"))
    e = evidence.groupBy("case_id").agg(F.count("*").alias("n_evidence"), F.count_if(F.col("importance") == "critical").alias("n_critical"))
    f = futures.groupBy("case_id").agg(F.count("*").alias("n_future"), F.min("date").alias("first_future"))
    whole = cases.select("case_id", "simulation_date").join(d, "case_id", "left").join(e, "case_id", "left").join(f, "case_id", "left").na.fill(0)
    broken = F.array_compact(
        F.array(
            F.when(~F.col("n_documents").between(4, 8), "documents"),
            F.when(F.col("n_evidence") < 5, "evidence"),
            F.when(F.col("n_critical") < 1, "critical"),
            F.when(F.col("n_future") < 1, "futures"),
            F.when(F.col("last_document") > F.col("simulation_date"), "future document"),
            F.when(F.col("first_future") <= F.col("simulation_date"), "past event"),
        )
    )
    return whole.withColumn("broken", broken)


def assert_sound(checks: DataFrame) -> DataFrame:
    """checks; reading a case that breaks an invariant ends the job."""
    guard = F.assert_true(F.size("broken") == 0, F.concat_ws(" ", F.lit("case"), "case_id", F.lit("breaks:"), F.array_join("broken", ", ")))
    return checks.where(guard.isNull())


def declared_differs(declared: DataFrame, actual: DataFrame, key: str) -> DataFrame:
    """key, field, declared, actual where two tables of the same columns disagree."""
    fields = [c for c in declared.columns if c != key]
    both = declared.select(key, F.struct(*fields).alias("d")).join(actual.select(key, F.struct(*fields).alias("a")), key)
    rows = F.array(*(F.struct(F.lit(c).alias("field"), F.col(f"d.{c}").cast("string").alias("declared"), F.col(f"a.{c}").cast("string").alias("actual")) for c in fields))
    return both.select(key, F.explode(rows).alias("r")).select(key, "r.*").where(~F.col("declared").eqNullSafe(F.col("actual")))


def unlocked(terms: DataFrame, found: DataFrame) -> DataFrame:
    """session_id, term, by: terms(case_id, term, source_evidence_ids) of which found(session_id, case_id, evidence_ids) holds a source."""
    both = terms.join(found, "case_id").withColumn("by", F.array_intersect("source_evidence_ids", "evidence_ids"))
    return both.where(F.size("by") > 0).select("session_id", "term", "by")


def aspects(question: Column) -> Column:
    """The aspects whose words a question contains, in their order; the usual ones if there is none."""
    hit = lambda words: F.coalesce(*(F.when(F.lower(question).contains(w), True) for w in words), F.lit(False))
    found = F.array_compact(F.array(*(F.when(hit(w), F.lit(a)) for a, w in ASPECTS.items())))
    return F.when(F.size(found) > 0, found).otherwise(F.array(*map(F.lit, USUAL)))


def aspect_queries(questions: DataFrame) -> DataFrame:
    """question_id, query_id, case_id, query of questions(question_id, case_id, question): the question, and it with each aspect's words."""
    words = F.create_map(*(F.lit(x) for a, w in ASPECTS.items() for x in (a, " ".join(w))))
    wide = F.concat(F.array(F.col("question")), F.transform(aspects(F.col("question")), lambda a: F.concat_ws(" ", F.col("question"), words[a])))
    parts = questions.select("question_id", "case_id", F.posexplode(wide).alias("at", "query"))
    return parts.select("question_id", F.concat_ws("#", "question_id", "at").alias("query_id"), "case_id", "query")


def session_stats(turns: DataFrame) -> DataFrame:
    """session_id, turns, accepted, first and last seq, actions by kind."""
    return turns.groupBy("session_id").agg(F.count("*").alias("n_turns"), F.count_if("accepted").alias("n_accepted"), F.min("seq").alias("first_seq"), F.max("seq").alias("last_seq"), F.count_distinct("action").alias("n_kinds"))


def escaped(text: Column, most: int = CELL) -> Column:
    """A cell of a Markdown table: bars escaped, line breaks as blanks, cut to `most` characters with an ellipsis."""
    flat = F.regexp_replace(F.coalesce(text, F.lit("")), r"[\r\n]+", " ")
    cut = F.when(F.length(flat) > most, F.concat(F.substring(flat, 1, most), F.lit("…"))).otherwise(flat)
    return F.replace(cut, F.lit("|"), F.lit("\\|"))


def evidence_map(evidence: DataFrame) -> DataFrame:
    """case_id, markdown: a table row for each evidence(case_id, ordinal, evidence_id, category, text, source_text) in its order."""
    row = F.concat(F.lit("| "), F.concat_ws(" | ", "evidence_id", "category", escaped(F.col("text")), escaped(F.col("source_text"))), F.lit(" |"))
    lines = F.transform(F.array_sort(F.collect_list(F.struct("ordinal", row.alias("row")))), lambda x: x["row"])
    head = F.array(F.lit("| id | category | evidence | source |"), F.lit("|---|---|---|---|"))
    return evidence.groupBy("case_id").agg(F.array_join(F.concat(head, lines), "\n").alias("markdown"))


def totals(facts: DataFrame, *by: str) -> DataFrame:
    """SUM: the sum of facts(..., value), null if one is missing."""
    return facts.groupBy(*by).agg(F.when(F.count("value") == F.count("*"), F.sum("value")).alias("total"))


def compared(facts: DataFrame, key: str, one: str, two: str) -> DataFrame:
    """COMPARE: key, both values and which is larger ('=': equal, null: one is missing) of facts(key, fact, value)."""
    pick = lambda f: F.max(F.when(F.col("fact") == f, F.col("value")))
    both = facts.where(F.col("fact").isin(one, two)).groupBy(key).agg(pick(one).alias("one"), pick(two).alias("two"))
    return both.withColumn("larger", F.when(F.col("one") > F.col("two"), one).when(F.col("one") < F.col("two"), two).when(F.col("one") == F.col("two"), "="))


def running_number(df: DataFrame, by: str, *order: str) -> DataFrame:
    return df.withColumn("ordinal", F.row_number().over(Window.partitionBy(by).orderBy(*order)))
