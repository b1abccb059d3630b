"""Queries of gates, hashes, histograms, samples and references over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from disclosa.operators import corpus, documents, grounding
from disclosa.plans.catalog import query, table

#: Documents stand in for audits: the group is the language, the tier follows from flags of the number.
FLAGS = "doc_id % 11 = 0 AS failed, doc_id % 3 = 0 AS sanitized, doc_id % 29 = 0 AS pdf"
TIER = "CASE WHEN pdf THEN 'partial' WHEN failed THEN 'fallback' WHEN sanitized THEN 'partial' ELSE 'structured' END"
AUDIT_SQL = f"a AS (SELECT doc_id, lang AS doc_group, {TIER} AS tier, sanitized, pdf FROM (SELECT *, {FLAGS} FROM documents))"


def audits(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("doc_id")
    return table(spark, sf_dir, "documents").select("doc_id", F.col("lang").alias("doc_group"), documents.tier(n % 11 == 0, n % 3 == 0, n % 29 == 0).alias("tier"), (n % 3 == 0).alias("used_sanitizer"), F.when(n % 29 == 0, "pdf+html").otherwise("xml").alias("file_format"))


@query(f"WITH {AUDIT_SQL} SELECT tier, count(*) AS n FROM a GROUP BY 1")
def tier_classify(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus.histogram(audits(spark, sf_dir), "tier")


@query(f"WITH {AUDIT_SQL} SELECT coalesce(doc_group, '*') AS doc_group, coalesce(tier, '*') AS tier, count(*) AS n FROM a GROUP BY CUBE (doc_group, tier)")
def tier_cube(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = audits(spark, sf_dir).cube("doc_group", "tier").agg(F.count("*").alias("n"))
    return c.select(F.coalesce("doc_group", F.lit("*")).alias("doc_group"), F.coalesce("tier", F.lit("*")).alias("tier"), "n")


@query(f"WITH {AUDIT_SQL} SELECT CASE WHEN pdf THEN 'pdf+html' WHEN sanitized THEN 'sanitized' ELSE 'other' END AS cause, count(*) AS n FROM a WHERE tier = 'partial' GROUP BY 1")
def partial_causes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus.partial_causes(audits(spark, sf_dir))


@query("SELECT event_type AS code, count(DISTINCT user_id) AS n FROM events GROUP BY 1")
def warning_hist_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents (users) with each code (event type)."""
    codes = table(spark, sf_dir, "events").select("user_id", F.col("event_type").alias("code")).distinct()
    return corpus.histogram(codes, "code")


@query("SELECT event_type AS code, count(*) AS n FROM events GROUP BY 1")
def warning_hist_occurrences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus.histogram(table(spark, sf_dir, "events").select(F.col("event_type").alias("code")), "code")


@query("SELECT user_id, string_agg(DISTINCT event_type, ' ' ORDER BY event_type) AS codes FROM events GROUP BY 1")
def warning_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").groupBy("user_id").agg(F.array_join(F.array_sort(F.collect_set("event_type")), " ").alias("codes"))


@query("""SELECT count(*) AS n_manifest, (SELECT count(*) FROM customer) AS n_universe, bool_and(length(lpad(o_custkey::VARCHAR, 8, '0')) = 8) AND bool_or(starts_with(lpad(o_custkey::VARCHAR, 8, '0'), '0')) AS codes_ok,
 CASE WHEN count(*) <> 4204 THEN 'manifest rows ' ELSE '' END || CASE WHEN (SELECT count(*) FROM customer) <> 70 THEN 'universe rows ' ELSE '' END AS problems FROM orders""")
def gate_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = table(spark, sf_dir, "orders").select(F.lpad(F.col("o_custkey").cast("string"), 8, "0").alias("corp_code"), F.lit("major").alias("doc_group"), F.lit("").alias("doc_subtype"))
    universe = table(spark, sf_dir, "customer")
    g = corpus.gate_report(m, universe, universe.where("c_custkey < 0"))
    return g.select("n_manifest", "n_universe", "codes_ok", F.concat(F.array_join("problems", " "), F.lit(" ")).alias("problems"))


@query("SELECT doc_id, sha256(text) AS sha FROM documents")
def doc_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", corpus.sha(F.col("text")).alias("sha"))


@query("""WITH h AS (SELECT lpad(doc_id::VARCHAR, 9, '0') AS id, lang, sha256(text) AS sha FROM documents)
 SELECT coalesce(lang, '*') AS doc_group, count(*) AS n, sha256('[' || string_agg('["' || id || '","' || sha || '"]', ',' ORDER BY id) || ']') AS sha256 FROM h GROUP BY GROUPING SETS ((lang), ())""")
def group_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The digest of each language and of everything."""
    h = table(spark, sf_dir, "documents").select(F.lpad(F.col("doc_id").cast("string"), 9, "0").alias("doc_id"), F.col("lang").alias("doc_group"), corpus.sha(F.col("text")).alias("hash"))
    return corpus.group_hashes(h).select(F.coalesce("doc_group", F.lit("*")).alias("doc_group"), "n", "sha256")


@query("""SELECT doc_id, sha256('{"doc_id":' || doc_id::VARCHAR || ',"lang":"' || lang || '","n_chars":' || n_chars::VARCHAR || '}') AS sha FROM documents""")
def canonical_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", corpus.sha(corpus.canonical(F.struct("doc_id", "lang", "n_chars"))).alias("sha"))


@query("SELECT doc_id, 'snap_' || substr(sha256(sha256(text) || '|' || sha256(source)), 1, 16) AS snapshot_id FROM documents")
def snapshot_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", corpus.snapshot_id(corpus.sha(F.col("text")), corpus.sha(F.col("source"))).alias("snapshot_id"))


@query(f"""WITH {AUDIT_SQL}, s AS (SELECT doc_group, tier, count(*) AS size, 90::DOUBLE * count(*) / (SELECT count(*) FROM a) AS share FROM a GROUP BY 1, 2),
 b AS (SELECT *, greatest(1, floor(share))::BIGINT AS base FROM s), o AS (SELECT sum(base)::BIGINT - least(90, sum(size)::BIGINT) AS over FROM b),
 u AS (SELECT b.*, over, unnest(range(1, greatest(base, least(size, base - least(over, 0))) + 1)) AS unit FROM b, o),
 e AS (SELECT doc_group, tier, row_number() OVER (ORDER BY unit - base, share - floor(share) DESC, doc_group, tier) <= -over AS has FROM u WHERE unit > base),
 t AS (SELECT doc_group, tier, row_number() OVER (ORDER BY unit DESC, doc_group, tier) > over AS has FROM u WHERE unit > 1 AND unit <= base),
 q AS (SELECT doc_group, tier, 1 + (SELECT count(*) FROM e WHERE has AND e.doc_group = s.doc_group AND e.tier = s.tier) + (SELECT count(*) FROM t WHERE has AND t.doc_group = s.doc_group AND t.tier = s.tier) AS quota FROM s),
 r AS (SELECT *, row_number() OVER (PARTITION BY doc_group, tier ORDER BY sha256('0:' || doc_id::VARCHAR), doc_id) AS nth FROM a)
 SELECT r.doc_group, r.tier, r.doc_id, q.quota FROM r JOIN q ON q.doc_group = r.doc_group AND q.tier = r.tier WHERE nth <= quota""")
def strat_allocation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stratified draw of 90 documents, each with its stratum's allocation."""
    return corpus.stratified(audits(spark, sf_dir)).select("doc_group", "tier", "doc_id", F.col("quota").cast("long").alias("quota"))


@query(f"WITH {AUDIT_SQL}, r AS (SELECT *, row_number() OVER (PARTITION BY doc_group ORDER BY sha256('0:' || doc_id::VARCHAR), doc_id) AS nth FROM a) SELECT doc_group, doc_id FROM r WHERE nth <= 20")
def strat_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus.fixed_sample(audits(spark, sf_dir), "doc_group", 20).select("doc_group", "doc_id")


@query("SELECT o_orderkey FROM orders LEFT JOIN customer ON c_custkey = o_custkey + 75 WHERE c_custkey IS NULL")
def dangling_refs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """References of orders to customers that do not exist."""
    users = table(spark, sf_dir, "orders").select(F.lit("C1").alias("case_id"), F.col("o_orderkey").alias("user_id"), F.array(F.col("o_custkey") + 75).alias("evidence_ids"))
    there = table(spark, sf_dir, "customer").select(F.lit("C1").alias("case_id"), F.col("c_custkey").alias("evidence_id"))
    return grounding.dangling(users, there).select(F.col("user_id").alias("o_orderkey"))


@query("SELECT o_orderkey::VARCHAR AS doc_id, unnest(list_filter([CASE WHEN c_custkey IS NULL THEN 'missing' END, CASE WHEN c_custkey IS NOT NULL AND o_orderkey % 7 = 0 THEN 'date' END, CASE WHEN c_nationkey <> 3 THEN 'company' END], lambda x: x IS NOT NULL)) AS problem FROM orders LEFT JOIN customer ON c_custkey = o_orderkey")
def manifest_consistency(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders held against a manifest made of customers."""
    k = F.col("o_orderkey")
    docs = table(spark, sf_dir, "orders").select(F.lit("C1").alias("case_id"), k.cast("string").alias("doc_id"), F.when(k % 7 == 0, "2024-01-02").otherwise("2024-01-01").alias("document_date"))
    real = table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("doc_id"), F.lit("20240101").alias("rcept_dt"), F.col("c_nationkey").cast("string").alias("corp_code"))
    case = spark.createDataFrame([("C1", "3")], "case_id string, corp_code string")
    return grounding.manifest_consistency(docs, real, case).select("doc_id", "problem")


@query("SELECT d.doc_id, b.item_id FROM documents d JOIN benchmark b ON contains(d.text, b.text)")
def grounding_contains(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold a whole benchmark item."""
    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return grounding.containing(docs.select("doc_id", "text"), items.select("item_id", F.col("text").alias("needle")), "doc_id", "item_id")


FACTS = ("현금및현금성자산 239,036,839,774", "투자금액 473,200,000,000 2023년")
SAYS = (("S1", "현금은 239,036,839,774이다"), ("S2", "현금이 부족하다"), ("S3", "매출 999,999,999,999"), ("S4", "투자는 4,732억원"), ("S5", "2026년 전망"), ("S6", "인용"), ("S7", "다른 문서"))


@query("SELECT * FROM (VALUES ('S1', 'SUPPORTED'), ('S2', 'PARTIALLY_SUPPORTED'), ('S3', 'UNSUPPORTED'), ('S4', 'SUPPORTED'), ('S5', 'PARTIALLY_SUPPORTED'), ('S6', 'UNSUPPORTED'), ('S7', 'PARTIALLY_SUPPORTED')) AS v(answer_id, status)")
def verdict_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    answers = spark.createDataFrame(list(SAYS), "answer_id string, answer string")
    sources = spark.createDataFrame([(a, f"D{k}", k, x) for a, _ in SAYS for k, x in enumerate(FACTS)], "answer_id string, document_id string, at int, text string")
    quotes = [("S1", "D0", "현금및현금성자산  239,036,839,774"), ("S6", "D0", "없는 인용"), ("S7", "D1", "현금및현금성자산")]
    citations = spark.createDataFrame(quotes, "answer_id string, document_id string, quote string")
    return grounding.verdicts(answers, citations, sources).select("answer_id", "status")


@query("""WITH q AS (SELECT conv_id, turn, text FROM conversations WHERE role = 'user'), s AS (SELECT conv_id, turn - 1 AS turn, text FROM conversations WHERE role = 'assistant')
 SELECT q.conv_id, q.turn, contains(trim(regexp_replace(s.text, '\\s+', ' ', 'g')), trim(regexp_replace(substr(q.text, 1, 30), '\\s+', ' ', 'g'))) AS in_doc FROM q JOIN s USING (conv_id, turn)""")
def quote_scope_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether the answer of the next turn quotes the start of a question."""
    from disclosa.functions.text import collapse

    c = table(spark, sf_dir, "conversations")
    q = c.where("role = 'user'").select("conv_id", "turn", collapse(F.substring("text", 1, 30)).alias("quote"))
    s = c.where("role = 'assistant'").select("conv_id", (F.col("turn") - 1).alias("turn"), collapse(F.col("text")).alias("scope"))
    return q.join(s, ["conv_id", "turn"]).select("conv_id", "turn", F.col("scope").contains(F.col("quote")).alias("in_doc"))


@query("SELECT * FROM (VALUES ('document', 'D2'), ('event', 'periodic_1'), ('name', '9'), ('name', '1'), ('name', 'major_9'), ('future-date', '2025-01-01')) AS v(kind, what)")
def future_id_leak(spark: SparkSession, sf_dir: str) -> DataFrame:
    cases = spark.createDataFrame([("C1", "2023-05-23", "see major_9, due 2025-01-01 and 2025-02-31")], "case_id string, simulation_date string, pre_play string")
    docs = spark.createDataFrame([("C1", "D1", "2023-05-23"), ("C1", "D2", "2023-05-24")], "case_id string, document_id string, document_date string")
    futures = spark.createDataFrame([("C1", "2023-06-01", "major_9"), ("C1", "2023-05-23", "periodic_1")], "case_id string, date string, source_document_id string")
    return grounding.leakage(cases, docs, futures).select("kind", "what")


@query("SELECT * FROM (VALUES ('E1', CAST(NULL AS VARCHAR)), ('E2', 'ref'), ('E3', 'grounding'), ('E4', 'numbers')) AS v(evidence_id, problem)")
def evidence_grounding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.createDataFrame([("C1", "D1", "자본 1,000,000 원\n부채 5")], "case_id string, document_id string, original_text string")
    rows = [("C1", "E1", "D1", "자본 1000000, 100만", "자본 1,000,000 원"), ("C1", "E2", "D9", "x", "x"), ("C1", "E3", "D1", "x", "없는 글"), ("C1", "E4", "D1", "부채 7", "부채 5")]
    ev = spark.createDataFrame(rows, "case_id string, evidence_id string, document_id string, text string, source_text string")
    return grounding.grounding(ev, docs).select("evidence_id", "problem")


@query("SELECT doc_id, lang, source, n_chars FROM documents")
def metadata_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A projection that reads four columns."""
    return table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars")


@query("SELECT d.doc_id, d.lang FROM documents d JOIN labels l USING (doc_id) WHERE l.quality = 0")
def point_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents named by a list of ids: a semi join."""
    wanted = table(spark, sf_dir, "labels").where("quality = 0").select("doc_id")
    return table(spark, sf_dir, "documents").select("doc_id", "lang").join(wanted, "doc_id", "left_semi")
