"""Queries of retrieval: BM25 at a point in time, chunks, answers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from disclosa.functions.text import line_windows, tokens
from disclosa.operators import search
from disclosa.plans.catalog import query, table

DAY = "2023-09-01"
QUESTIONS = (("Q1", "the thing of Information and the"), ("Q2", "password token 2023"), ("Q3", "ciónmente que la"), ("Q4", "zzzz"))
ASPECTS = (("A1", "Q1", "the thing of"), ("A2", "Q1", "license version"), ("A3", "Q2", "leau que"), ("A4", "Q2", "the apache"))
DATED = "SELECT doc_id, text, source, lang, strftime(DATE '2023-01-01' + (doc_id % 730)::INTEGER, '%Y-%m-%d') AS day FROM documents"
SQL_TOKENS = "regexp_extract_all(lower(text), '[a-z]+|[0-9][0-9,.]*')"


def chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents as chunks of one case, dated by their number."""
    day = F.date_format(F.date_add(F.lit("2023-01-01").cast("date"), (F.col("doc_id") % 730).cast("int")), "yyyy-MM-dd")
    docs = table(spark, sf_dir, "documents")
    return docs.select(F.lit("C1").alias("case_id"), F.lpad(F.col("doc_id").cast("string"), 9, "0").alias("chunk_id"), "doc_id", day.alias("document_date"), "text", "source", "lang")


def asked(spark: SparkSession, rows: tuple = QUESTIONS) -> DataFrame:
    return spark.createDataFrame([(q, "C1", t) for q, t in rows], "query_id string, case_id string, query string")


def values(rows: tuple) -> str:
    return "(VALUES " + ", ".join("(" + ", ".join("'" + x.replace("'", "''") + "'" for x in r) + ")" for r in rows) + ")"


def bm25_sql(rows: str, filtered: bool, k: int) -> str:
    """Ranked hits: statistics over everything, then the date, then the k best."""
    return f"""
    d AS ({DATED}),
    q AS (SELECT * FROM {rows} AS v(query_id, query)),
    qt AS (SELECT query_id, term, count(*) AS times FROM (SELECT query_id, unnest(regexp_extract_all(lower(query), '[a-z]+|[0-9][0-9,.]*')) AS term FROM q) GROUP BY 1, 2),
    t AS (SELECT doc_id, day, {SQL_TOKENS} AS toks FROM d),
    s AS (SELECT count(*) AS n, avg(len(toks)) AS avgdl FROM t),
    tf AS (SELECT doc_id, day, dl, term, count(*) AS tf FROM (SELECT doc_id, day, len(toks) AS dl, unnest(toks) AS term FROM t) WHERE term IN (SELECT term FROM qt) GROUP BY 1, 2, 3, 4),
    df AS (SELECT term, count(*) AS df FROM tf GROUP BY 1),
    sc AS (SELECT qt.query_id, lpad(tf.doc_id::VARCHAR, 9, '0') AS chunk_id, tf.day, sum(qt.times * ln(1 + (s.n - df.df + 0.5::DOUBLE) / (df.df + 0.5::DOUBLE)) * tf.tf * 2.5::DOUBLE / (tf.tf + 1.5::DOUBLE * (0.25::DOUBLE + 0.75::DOUBLE * greatest(tf.dl, 1) / s.avgdl))) AS score
           FROM tf JOIN qt USING (term) JOIN df USING (term) CROSS JOIN s {"WHERE tf.day <= '" + DAY + "'" if filtered else ""} GROUP BY 1, 2, 3),
    r AS (SELECT query_id, chunk_id, day, round(score, 4) AS score, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, chunk_id) AS rank FROM sc WHERE score > 0),
    hits AS (SELECT * FROM r WHERE rank <= {k})"""


@query(f"WITH {bm25_sql(values(QUESTIONS), True, 10)} SELECT query_id, chunk_id, day AS document_date, rank, score FROM hits")
def pit_bm25_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = search.search(chunks(spark, sf_dir), asked(spark), DAY, 10)
    return found.select("query_id", "chunk_id", "document_date", F.col("rank").cast("long").alias("rank"), "score")


@query(f"WITH {bm25_sql(values(QUESTIONS), False, 10)} SELECT query_id, count(*) AS n_hits, count(*) FILTER (day > '{DAY}') AS n_future FROM hits GROUP BY 1")
def pit_negative_control(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Without the date filter the later documents do come up."""
    found = search.search(chunks(spark, sf_dir), asked(spark), None, 10)
    return found.groupBy("query_id").agg(F.count("*").alias("n_hits"), F.count_if(F.col("document_date") > DAY).alias("n_future"))


@query(f"WITH {bm25_sql(values(QUESTIONS), True, 10)} SELECT count(*) AS n_leaks FROM hits WHERE day > '{DAY}'")
def pit_no_future_assert(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.leaks(search.search(chunks(spark, sf_dir), asked(spark), DAY, 10), DAY).agg(F.count("*").alias("n_leaks"))


@query(f"SELECT count(*) AS n_chunks, count(*) FILTER (day <= '{DAY}') AS n_past_chunks, count(*) FILTER (day > '{DAY}') AS n_future_chunks FROM ({DATED})")
def pit_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.retriever_stats(chunks(spark, sf_dir), DAY).drop("case_id")


@query("SELECT event_id, user_id FROM events WHERE ts <= TIMESTAMP '2024-01-10 00:00:00'")
def pit_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The date filter reaches the scan."""
    return table(spark, sf_dir, "events").where("ts <= TIMESTAMP_NTZ '2024-01-10 00:00:00'").select("event_id", "user_id")


@query(f"SELECT term, count(*) AS df, sum(tf)::BIGINT AS cf, max(tf) AS max_tf FROM (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest({SQL_TOKENS}) AS term FROM documents) GROUP BY 1, 2) GROUP BY 1")
def bm25_term_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = search.postings(chunks(spark, sf_dir))
    return p.groupBy("term").agg(F.count("*").alias("df"), F.sum("tf").alias("cf"), F.max("tf").alias("max_tf"))


@query(f"SELECT count(*) AS n, round(avg(len(toks)), 4) AS avgdl FROM (SELECT {SQL_TOKENS} AS toks FROM documents)")
def bm25_corpus_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.corpus_stats(chunks(spark, sf_dir)).select("n", F.round("avgdl", 4).alias("avgdl"))


GATHER = f"""WITH {bm25_sql(values(tuple((a, t) for a, _, t in ASPECTS)), True, 3)},
    b AS (SELECT m.question_id, h.chunk_id, max(h.score) AS score FROM hits h JOIN {values(tuple((a, q) for a, q, _ in ASPECTS))} AS m(query_id, question_id) USING (query_id) GROUP BY 1, 2),
    g AS (SELECT *, row_number() OVER (PARTITION BY question_id ORDER BY score DESC, chunk_id) AS rank FROM b)"""


def gathered(spark: SparkSession, sf_dir: str) -> DataFrame:
    queries = spark.createDataFrame([(q, a, "C1", t) for a, q, t in ASPECTS], "question_id string, query_id string, case_id string, query string")
    return search.gather(chunks(spark, sf_dir), queries, DAY)


@query(GATHER + " SELECT question_id, chunk_id, score, rank FROM g WHERE rank <= 6")
def multi_query_gather(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gathered(spark, sf_dir).select("question_id", "chunk_id", "score", F.col("rank").cast("long").alias("rank"))


@query()
def extractive_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines quoted in the answer to each question; a greedy pass that SQL does not express."""
    texts = chunks(spark, sf_dir).select("chunk_id", "text")
    terms = spark.createDataFrame([(q, t) for _, q, t in ASPECTS], "question_id string, query string").groupBy("question_id").agg(F.array_distinct(F.flatten(F.collect_list(tokens(F.col("query"))))).alias("terms"))
    found = gathered(spark, sf_dir).join(texts, "chunk_id")
    return search.answer_lines(found, terms).select("question_id", F.col("at").cast("long").alias("at"), "chunk_id", "line")


WINDOWS = """l AS (SELECT doc_id, day, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\\s]')) AS lines FROM d),
    w AS (SELECT doc_id, day, lines, unnest(range(0, CAST(greatest(0, ceil((len(lines) - 12) / 8.0)) AS BIGINT) + 1)) AS win FROM l WHERE len(lines) > 0)"""


@query(f"WITH d AS ({DATED}), {WINDOWS} SELECT doc_id, win AS \"at\", sha256(array_to_string(list_slice(lines, win * 8 + 1, win * 8 + 12), chr(10))) AS sha FROM w")
def chunk_lines_12_8(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = chunks(spark, sf_dir).select("doc_id", F.posexplode(line_windows(F.col("text"))).alias("at", "piece"))
    return cut.select("doc_id", F.col("at").cast("long").alias("at"), F.sha2(F.col("piece").cast("binary"), 256).alias("sha"))


PARTS = f"""d0 AS ({DATED}), d AS (SELECT *, CASE WHEN day <= '{DAY}' THEN 'D' || lpad(doc_id::VARCHAR, 6, '0') ELSE 'FUT' || lpad((row_number() OVER (PARTITION BY source, day <= '{DAY}' ORDER BY day, doc_id))::VARCHAR, 6, '0') END AS part FROM d0)"""


@query(f"WITH d AS ({DATED}), {WINDOWS}, c AS (SELECT doc_id, day <= '{DAY}' AS past, count(*) AS n FROM w GROUP BY 1, 2) SELECT past, count(*) AS n_documents, sum(n)::BIGINT AS n_chunks FROM c GROUP BY 1")
def index_union_past_future(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = chunks(spark, sf_dir).withColumns({"document_id": F.when(F.col("document_date") <= DAY, F.concat(F.lit("D"), F.lpad(F.col("doc_id").cast("string"), 6, "0"))), "title": F.col("source"), "source_type": F.col("lang")})
    index = search.index_chunks(docs).withColumn("past", F.col("document_id").isNotNull())
    return index.groupBy("past").agg(F.count_distinct("doc_id").alias("n_documents"), F.count("*").alias("n_chunks"))


@query(f"WITH d AS ({DATED}), {WINDOWS} SELECT 'C1:D' || lpad(doc_id::VARCHAR, 6, '0') || ':' || lpad(win::VARCHAR, 3, '0') AS chunk_id, doc_id FROM w WHERE day <= '{DAY}'")
def chunk_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = chunks(spark, sf_dir).where(F.col("document_date") <= DAY).withColumns({"document_id": F.concat(F.lit("D"), F.lpad(F.col("doc_id").cast("string"), 6, "0")), "title": F.col("source"), "source_type": F.col("lang")})
    return search.index_chunks(docs).select("chunk_id", "doc_id")
