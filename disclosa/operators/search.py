"""Point-in-time BM25: statistics over all chunks, candidates up to a date, many queries in one job."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from disclosa.functions.text import let, line_windows, overlap, strip, tokens

K1, B = 1.5, 0.75
#: Hits of one query, and documents of one question.
PER_QUERY, FUSED = 3, 6
#: Extractive answers: shortest line, lines of one chunk, lines in all.
SHORTEST, PER_CHUNK, LINES = 6, 2, 5


def index_chunks(documents: DataFrame, window: int = 12, stride: int = 8) -> DataFrame:
    """Chunks of documents(case_id, document_id, doc_id, document_date, title, source_type, text), past and future alike.

    A chunk's name holds the case, the document's name within the case (future ones are counted FUT01, FUT02 by date)
    and its number.
    """
    order = Window.partitionBy("case_id").orderBy("document_date", "doc_id")
    later = documents.where("document_id is null").withColumn("part", F.concat(F.lit("FUT"), F.lpad(F.row_number().over(order), 2, "0")))
    both = documents.where("document_id is not null").withColumn("part", F.col("document_id")).unionByName(later)
    cut = both.select("*", F.posexplode(line_windows(F.col("text"), window, stride)).alias("at", "piece"))
    name = F.concat_ws(":", "case_id", "part", F.lpad(F.col("at").cast("string"), 3, "0"))
    return cut.select(name.alias("chunk_id"), "case_id", "doc_id", "document_id", "document_date", "title", "source_type", F.col("piece").alias("text"))


def postings(chunks: DataFrame) -> DataFrame:
    """case_id, chunk_id, term, tf, dl: one shuffle by chunk and term, combined before it."""
    held = chunks.select("case_id", "chunk_id", tokens(F.col("text")).alias("t")).withColumn("dl", F.size("t"))
    return held.select("case_id", "chunk_id", "dl", F.explode("t").alias("term")).groupBy("case_id", "chunk_id", "dl", "term").agg(F.count("*").alias("tf"))


def corpus_stats(chunks: DataFrame) -> DataFrame:
    """case_id, n, avgdl over all chunks of a case, also those after any date."""
    return chunks.groupBy("case_id").agg(F.count("*").alias("n"), F.avg(F.size(tokens(F.col("text")))).alias("avgdl"))


def query_terms(queries: DataFrame) -> DataFrame:
    """query_id, case_id, term, times of queries(query_id, case_id, query): repeated terms count again."""
    return queries.select("query_id", "case_id", F.explode(tokens(F.col("query"))).alias("term")).groupBy("query_id", "case_id", "term").agg(F.count("*").alias("times"))


def scores(chunks: DataFrame, queries: DataFrame, day: str | None) -> DataFrame:
    """query_id, chunk columns and score of every chunk up to `day` (None: all) with a positive score.

    Only terms of a query leave the scan: a chunk's tokens are cut down to wanted ones before they are exploded, and
    their frequencies over all chunks give df. The date cuts candidates, never the statistics.
    """
    wanted = query_terms(queries)
    of_case = wanted.groupBy("case_id").agg(F.collect_set("term").alias("wanted"))
    held = chunks.join(F.broadcast(of_case), "case_id").select("case_id", "chunk_id", "document_date", "wanted", tokens(F.col("text")).alias("t"))
    sized = held.select("case_id", "chunk_id", "document_date", F.size("t").alias("dl"), let(F.col("wanted"), lambda w: F.filter("t", lambda x: F.array_contains(w, x))).alias("t"))
    tf = sized.select("case_id", "chunk_id", "document_date", "dl", F.explode("t").alias("term")).groupBy("case_id", "chunk_id", "document_date", "dl", "term").agg(F.count("*").alias("tf"))
    df = tf.groupBy("case_id", "term").agg(F.count("*").alias("df"))
    stats = sized.groupBy("case_id").agg(F.count("*").alias("n"), F.avg("dl").alias("avgdl"))
    weights = wanted.join(df, ["case_id", "term"]).join(stats, "case_id")
    idf = F.ln(1 + (F.col("n") - F.col("df") + 0.5) / (F.col("df") + 0.5))
    weights = weights.select("query_id", "case_id", "term", (F.col("times") * idf).alias("w"), "avgdl")
    near = tf if day is None else tf.where(F.col("document_date") <= day)
    part = F.col("w") * F.col("tf") * (K1 + 1) / (F.col("tf") + K1 * (1 - B + B * F.greatest("dl", F.lit(1)) / F.col("avgdl")))
    summed = near.join(weights, ["case_id", "term"]).groupBy("query_id", "case_id", "chunk_id", "document_date").agg(F.sum(part).alias("score"))
    return summed


def search(chunks: DataFrame, queries: DataFrame, day: str | None, k: int = 5, min_score: float = 0.0) -> DataFrame:
    """The k best chunks of every query by score, then chunk_id; score is rounded after ranking."""
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "chunk_id")
    ranked = scores(chunks, queries, day).where(F.col("score") > min_score).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.withColumn("score", F.round("score", 4))


def leaks(results: DataFrame, day: str) -> DataFrame:
    """Results after the day: to be empty."""
    return results.where(F.col("document_date") > day)


def checked(results: DataFrame, day: str) -> DataFrame:
    """results; reading a row after the day ends the job."""
    guard = F.assert_true(F.col("document_date") <= day, F.concat(F.lit("future leakage: "), F.col("chunk_id")))
    return results.where(guard.isNull())


def gather(chunks: DataFrame, queries: DataFrame, day: str) -> DataFrame:
    """question_id, chunk_id, score: per query the PER_QUERY best, a chunk's best rounded score, FUSED in all.

    queries(question_id, query_id, case_id, query)
    """
    hits = search(chunks, queries, day, PER_QUERY).join(queries.select("question_id", "query_id"), "query_id")
    best = hits.groupBy("question_id", "case_id", "chunk_id", "document_date").agg(F.max("score").alias("score"))
    order = Window.partitionBy("question_id").orderBy(F.desc("score"), "chunk_id")
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= FUSED)


def answer_lines(found: DataFrame, wanted: DataFrame) -> DataFrame:
    """question_id, at, chunk_id, line: at most LINES lines that share tokens with the question, best first.

    found(question_id, chunk_id, rank, score, text), wanted(question_id, terms). One greedy pass in score order, kept
    exact with a fold: a line left out because its chunk is full may still come from another chunk. A question has
    FUSED chunks at most, so the fold is over few lines.
    """
    lines = found.join(wanted, "question_id").select("question_id", "chunk_id", "rank", "score", "terms", F.posexplode(F.transform(F.split("text", "\n"), strip)).alias("line_no", "line"))
    scored = lines.where(F.length("line") >= SHORTEST).withColumn("weight", overlap(F.col("line"), F.col("terms")) * F.col("score")).where("weight > 0")
    entry = F.struct((-F.col("weight")).alias("w"), "rank", "line_no", "chunk_id", "line")
    sets = scored.groupBy("question_id").agg(F.array_sort(F.collect_list(entry)).alias("all"))
    taken = "array<struct<chunk_id:string,line:string>>"

    def take(acc, x):  # noqa: ANN001, ANN202
        fits = (
            (F.size(acc) < LINES)
            & ~F.exists(acc, lambda y: y["line"] == x["line"])
            & (F.size(F.filter(acc, lambda y: y["chunk_id"] == x["chunk_id"])) < PER_CHUNK)
        )
        return F.when(fits, F.concat(acc, F.array(F.struct(x["chunk_id"].alias("chunk_id"), x["line"].alias("line"))))).otherwise(acc)

    kept = F.aggregate("all", F.array().cast(taken), take)
    return sets.select("question_id", F.posexplode(kept).alias("at", "x")).select("question_id", "at", "x.chunk_id", "x.line")


def retriever_stats(chunks: DataFrame, day: str) -> DataFrame:
    past = F.count_if(F.col("document_date") <= day)
    return chunks.groupBy("case_id").agg(F.count("*").alias("n_chunks"), past.alias("n_past_chunks"), (F.count("*") - past).alias("n_future_chunks"))


def fuse(ranked: DataFrame, constant: int = 60) -> DataFrame:
    """query_id, item, score: reciprocal ranks of several rankings(query_id, method, item, rank) added up."""
    return ranked.groupBy("query_id", "item").agg(F.sum(1.0 / (constant + F.col("rank"))).alias("score"))


def recall_and_rank(ranked: DataFrame, truth: DataFrame, k: int) -> DataFrame:
    """recall_at_k and mrr of ranked(query_id, item, rank) against truth(query_id, item)."""
    hits = truth.join(ranked.where(F.col("rank") <= k), ["query_id", "item"], "left")
    each = hits.groupBy("query_id").agg((F.count("rank") / F.count("*")).alias("recall"), F.coalesce(1 / F.min("rank"), F.lit(0.0)).alias("rr"))
    return each.agg(F.avg("recall").alias("recall_at_k"), F.avg("rr").alias("mrr"))
