"""Queries of the planned operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from disclosa.functions.text import amount, day_text
from disclosa.operators import corpus, planned, search
from disclosa.plans.catalog import query, table
from disclosa.plans.text import literal, out

DOT = "list_sum(list_transform(range(1, 65), lambda i: e.embedding[i]::DOUBLE * q.embedding[i]::DOUBLE)) / (sqrt(list_sum(list_transform(e.embedding, lambda x: x::DOUBLE * x::DOUBLE))) * sqrt(list_sum(list_transform(q.embedding, lambda x: x::DOUBLE * x::DOUBLE))))"
#: The query set: every vector whose id is divisible by 20, against all.
TWENTIETH = "vec_id % 20 = 0"
NEAR = f"n AS (SELECT q.vec_id AS query_id, e.vec_id, {DOT} AS score FROM embeddings e, (SELECT * FROM embeddings WHERE {TWENTIETH}) q), r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM n)"


def near(spark: SparkSession, sf_dir: str, k: int) -> DataFrame:
    e = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return planned.nearest(e, e.where(TWENTIETH).withColumnRenamed("vec_id", "query_id"), k)


@query(f"WITH {NEAR} SELECT query_id, vec_id, round(score, 4) AS score, rank FROM r WHERE rank <= 10")
def cosine_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near(spark, sf_dir, 10).select("query_id", "vec_id", F.round("score", 4).alias("score"), F.col("rank").cast("long").alias("rank"))


@query(f"WITH {NEAR}, m AS (SELECT query_id, vec_id AS item, rank FROM r WHERE rank <= 10 UNION ALL SELECT query_id, vec_id, row_number() OVER (PARTITION BY query_id ORDER BY vec_id) FROM r WHERE rank <= 10) SELECT query_id, item, round(sum(1.0::DOUBLE / (60 + rank)), 6) AS score FROM m GROUP BY 1, 2")
def rrf_fuse(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = near(spark, sf_dir, 10).select("query_id", F.col("vec_id").alias("item"), "rank")
    b = a.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy("item")))
    return search.fuse(a.unionByName(b)).select("query_id", "item", F.round("score", 6).alias("score"))


@query(f"WITH {NEAR}, t AS (SELECT q.vec_id AS query_id, e.vec_id FROM embeddings e JOIN embeddings q ON q.{TWENTIETH} AND e.label = q.label), h AS (SELECT t.query_id, count(r.rank)::DOUBLE / count(*) AS recall, coalesce(1.0::DOUBLE / min(r.rank), 0) AS rr FROM t LEFT JOIN r ON r.query_id = t.query_id AND r.vec_id = t.vec_id AND r.rank <= 10 GROUP BY 1) SELECT round(avg(recall), 4) AS recall_at_k, round(avg(rr), 4) AS mrr FROM h")
def recall_mrr(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A query's truth are all vectors of its label; they are counted by label, not listed by query."""
    e = table(spark, sf_dir, "embeddings").select("vec_id", "label")
    sizes = e.groupBy("label").agg(F.count("*").alias("n"))
    q = e.where(TWENTIETH).withColumnRenamed("vec_id", "query_id").join(sizes, "label")
    right = near(spark, sf_dir, 10).select("query_id", "vec_id", "rank").join(e.withColumnRenamed("label", "_label"), "vec_id").join(q.select("query_id", "label"), "query_id").where("label = _label")
    hits = right.groupBy("query_id").agg(F.count("*").alias("hits"), F.min("rank").alias("first"))
    each = q.join(hits, "query_id", "left").select((F.coalesce("hits", F.lit(0)) / F.col("n")).alias("recall"), F.coalesce(1 / F.col("first"), F.lit(0.0)).alias("rr"))
    return each.agg(F.round(F.avg("recall"), 4).alias("recall_at_k"), F.round(F.avg("rr"), 4).alias("mrr"))


@query("""WITH m AS (SELECT o_orderkey, o_custkey, o_orderpriority, strftime(o_orderdate, '%Y%m%d') AS day, o_orderkey % 4 = 0 AS corr FROM orders),
 c AS (SELECT a.o_orderkey, count(b.o_orderkey) AS n FROM m a LEFT JOIN m b ON NOT b.corr AND a.o_custkey = b.o_custkey AND a.o_orderpriority = b.o_orderpriority AND b.day < a.day WHERE a.corr GROUP BY 1)
 SELECT o_orderkey AS doc_id, n AS n_candidates, CASE n WHEN 1 THEN 'linked' WHEN 0 THEN 'unlinked' ELSE 'ambiguous' END AS status FROM c""")
def correction_link(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("doc_id"), F.col("o_custkey").alias("corp_code"), F.col("o_orderpriority").alias("derived_subtype"), F.date_format("o_orderdate", "yyyyMMdd").alias("rcept_dt"), (F.col("o_orderkey") % 4 == 0).alias("is_correction"))
    return corpus.correction_links(m).select("doc_id", "n_candidates", "status")


@query("WITH a AS (SELECT c_custkey AS k, unnest(list_distinct([c_name, c_mktsegment, c_custkey::VARCHAR])) AS alias FROM customer) SELECT alias, min(lpad(k::VARCHAR, 8, '0')) AS corp_code, count(DISTINCT k) > 1 AS ambiguous FROM a WHERE length(alias) <> 8 GROUP BY 1")
def alias_resolve(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    key = F.lpad(F.col("c_custkey").cast("string"), 8, "0")
    u = c.select(key.alias("corp_code"), F.col("c_custkey").cast("string").alias("stock_code"), F.col("c_name").alias("corp_name"), F.col("c_mktsegment").alias("listed_name"), F.lit(None).cast("string").alias("corp_eng_name"))
    found = corpus.alias_index(u)
    return found.where(F.length("alias") != 8)


AMOUNTS = ("1,234 원", "-5,000", "-", "", "△ 77", "없음")


@query("SELECT * FROM (VALUES (0, 1234), (1, -5000), (2, NULL), (3, NULL), (4, 77), (5, NULL)) AS v(id, n)")
def parse_amount(spark: SparkSession, sf_dir: str) -> DataFrame:
    return out(literal(spark, *AMOUNTS), n=amount(F.col("x")))


@query("SELECT * FROM (VALUES (0, '2023-05-03'), (1, '2024-12-31'), (2, NULL)) AS v(id, day)")
def parse_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return out(literal(spark, "2023년 5월 3일", "2024.12.31", "미정"), day=day_text(F.col("x")))


@query("WITH m AS (SELECT o_custkey AS k, year(o_orderdate) AS y, sum(o_totalprice) AS v FROM orders GROUP BY 1, 2) SELECT k, y, round(v - lag(v) OVER (PARTITION BY k ORDER BY y), 2) AS diff, round(100 * (v - lag(v) OVER (PARTITION BY k ORDER BY y)) / nullif(lag(v) OVER (PARTITION BY k ORDER BY y), 0), 4) AS pct_change FROM m")
def calc_pct_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("k"), F.year("o_orderdate").cast("long").alias("y")).agg(F.sum("o_totalprice").alias("v"))
    return planned.changes(s, "k", "y", "v").select("k", "y", F.round("diff", 2).alias("diff"), "pct_change")


@query("SELECT 0 AS at, 'corpus' AS stage, count(*) AS n FROM documents UNION ALL SELECT 1, 'language', count(*) FROM documents WHERE lang = 'en' UNION ALL SELECT 2, 'source', count(*) FROM documents WHERE lang = 'en' AND source = 'src1' UNION ALL SELECT 3, 'text', count(*) FROM documents WHERE lang = 'en' AND source = 'src1' AND contains(text, 'the')")
def funnel_trace(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    en = d.where("lang = 'en'")
    one = en.where("source = 'src1'")
    stages = [("corpus", d), ("language", en), ("source", one), ("text", one.where(F.col("text").contains("the")))]
    return planned.funnel(stages, spark).select(F.col("at").cast("long").alias("at"), "stage", "n")
