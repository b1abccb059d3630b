"""Operators that filings need next: vector search, label/value facts, calculations, staged retrieval."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from disclosa.functions.text import amount, strip

#: Queries and vectors of a block, about.
QUERIES, VECTORS = 512, 4096


def cosine(a: Column, b: Column) -> Column:
    total = lambda x: F.aggregate(x, F.lit(0.0), lambda s, v: s + v)
    dot = total(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")))
    norm = lambda v: F.sqrt(total(F.transform(v, lambda x: x.cast("double") * x.cast("double"))))
    return dot / (norm(a) * norm(b))


def _scores(q: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Cosines of all rows of q and v, added up in the order of the dimensions, so that equal vectors give equal scores."""
    total = lambda a, b: sum((a[d] * b[d] for d in range(len(a))), start=np.zeros(1))
    norm = lambda x: np.sqrt(total(x.T, x.T))
    return total(q.T[:, :, None], v.T[:, None, :]) / (norm(q)[:, None] * norm(v)[None, :])


def nearest(vectors: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """query_id, vec_id, score, rank: the k most similar vectors of each query.

    Every block of queries meets every block of vectors; each pair of blocks gives k vectors a query at most, and only
    those are ranked. Vectors without a cosine (null, empty, with a null, of length 0 or not finite) are left out, and
    vectors of different dimensions do not meet.
    """
    clean = F.transform("embedding", lambda x: x.cast("double"))
    good = F.aggregate(clean, F.lit(0.0), lambda s, x: s + x * x).between(F.lit(5e-324), F.lit(1.7976931348623157e308))
    ids = {"vec_id": vectors.schema["vec_id"].dataType.simpleString(), "query_id": queries.schema["query_id"].dataType.simpleString()}

    def side(df: DataFrame, key: str, size: int, other: str, n_other: int) -> tuple[DataFrame, int]:
        held = df.select(key, clean.alias("x")).where(good)
        n = max(1, -(-df.count() // size))
        block = F.pmod(F.xxhash64(key), F.lit(n)).cast("int")
        return held.withColumns({"dim": F.size("x"), key[0]: block, other: F.explode(F.sequence(F.lit(0), F.lit(n_other - 1)))}), n

    n_queries = max(1, -(-queries.count() // QUERIES))
    v, n_vectors = side(vectors, "vec_id", VECTORS, "q", n_queries)
    q, _ = side(queries, "query_id", QUERIES, "v", n_vectors)

    def best(one: pa.Table, two: pa.Table) -> pa.Table:
        found = [[], [], []]
        if one.num_rows and two.num_rows:
            two = two.sort_by("vec_id")
            matrix = lambda t: t.column("x").combine_chunks().flatten().to_numpy().reshape(t.num_rows, -1)
            x, y = matrix(one), matrix(two)
            for at in range(0, len(x), 32):
                scores = _scores(x[at : at + 32], y)
                top = np.argsort(-scores, axis=1, kind="stable")[:, :k]
                found[0].append(np.repeat(np.arange(at, at + len(top)), top.shape[1]))
                found[1].append(top.ravel())
                found[2].append(np.take_along_axis(scores, top, axis=1).ravel())
        i, j, score = (np.concatenate(f) if f else np.zeros(0, dtype=np.int64) for f in found)
        return pa.table({"query_id": one.column("query_id").take(pa.array(i)), "vec_id": two.column("vec_id").take(pa.array(j)), "score": pa.array(score, type=pa.float64())})

    met = ["v", "q", "dim"]
    scored = q.groupBy(*met).cogroup(v.groupBy(*met)).applyInArrow(best, f"query_id {ids['query_id']}, vec_id {ids['vec_id']}, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def label_value(cells: Column) -> Column:
    """struct(label, value) of a table row: the last cell, and the one before it if there is one."""
    return F.struct(F.try_element_at(cells, F.lit(-2)).alias("label"), F.try_element_at(cells, F.lit(-1)).alias("value"))


def facts(rows: DataFrame, aliases: DataFrame) -> DataFrame:
    """doc_id, fact, value of table rows(doc_id, cells) whose label is one of aliases(fact, label)."""
    held = rows.select("doc_id", label_value(F.col("cells")).alias("lv"))
    named = held.select("doc_id", strip(F.col("lv.label")).alias("label"), amount(F.col("lv.value")).alias("value"))
    return named.join(aliases, "label").select("doc_id", "fact", "value")


def changes(series: DataFrame, key: str, at: str, value: str) -> DataFrame:
    """series with diff and pct_change against the row before it of the same key."""
    before = F.lag(value).over(Window.partitionBy(key).orderBy(at))
    return series.withColumns({"diff": F.col(value) - before, "pct_change": F.round(100 * (F.col(value) - before) / F.nullif(before, F.lit(0.0)), 4)})


def funnel(stages: list[tuple[str, DataFrame]], spark) -> DataFrame:  # noqa: ANN001
    """stage, n: how many rows each stage kept."""
    out = None
    for k, (name, df) in enumerate(stages):
        one = df.agg(F.count("*").alias("n")).select(F.lit(k).alias("at"), F.lit(name).alias("stage"), "n")
        out = one if out is None else out.unionByName(one)
    return out


def context(hits: DataFrame, chunks: DataFrame) -> DataFrame:
    """Hits with the other chunks of their document and section."""
    around = chunks.select("doc_id", "section", F.col("chunk_id").alias("near"))
    return hits.join(around, ["doc_id", "section"]).where("near <> chunk_id")
