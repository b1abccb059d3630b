"""Queries of documents assembled, corpus summaries, chunk sets and cases, over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from disclosa.operators import assembly, cases
from disclosa.operators import documents as docs
from disclosa.plans.catalog import query, table
from disclosa.plans.documents import parsed_pages

#: Orders stand in for documents, their lines for paragraphs; the order of lines that share a number is settled by further columns.
LINES = "SELECT l_orderkey, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_shipdate) - 1 AS pos, l_returnflag || ' ' || l_partkey::VARCHAR AS t FROM lineitem"
NULLS = ('"title_text":null,"level":null,"level_confident":null,"section_hierarchy":[],"parent_section_id":null,"end_order_index":null,', '"is_footnote_like":false,"raw_rows":null,"normalized_rows":null,"header_row_indices":null,"n_declared_cols":null,"actual_col_counts":null,"title_guess":null,"unit_text":null,"period_text":null,"consolidation_basis":null,"consolidation_reason":null}')


def order_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import Window

    number = F.row_number().over(Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate")) - 1
    rows = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").cast("string").alias("doc_id"), number.alias("order_index"), F.concat_ws(" ", "l_returnflag", "l_partkey").alias("text"))
    null = {c: F.lit(None) for c in ("title_text", "level", "level_confident", "parent_section_id", "end_order_index", "raw_rows", "normalized_rows", "header_row_indices", "n_declared_cols", "actual_col_counts", "title_guess", "unit_text", "period_text", "consolidation_basis", "consolidation_reason")}
    held = {"rel_path": F.lit("m.xml"), "kind": F.lit("paragraph"), "node_id": F.concat_ws("::", "doc_id", F.concat(F.lit("n"), "order_index")), "section_hierarchy": F.array().cast("array<string>"), "is_footnote_like": F.lit(False)}
    nodes = rows.withColumns(null | held)
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("string").alias("doc_id"), F.col("o_orderstatus").alias("doc_group"))
    quality = orders.withColumns({"tier": F.lit("structured"), "schema_version": F.lit(None).cast("string"), "router_matched_expected_parser": F.lit(True)} | {c: F.lit(0) for c in assembly.QUALITY[2:5]})
    files = orders.select("doc_id", F.lit("m.xml").alias("rel_path"), F.lit(False).alias("is_attachment"), F.lit("dart_xml").alias("content_format"), *(F.lit(None).cast("string").alias(c) for c in assembly.SOURCE[3:]))
    none = files.where("false").select("doc_id", "rel_path", *(F.lit("").alias(c) for c in ("code", "severity", "message")))
    return assembly.document_irs(files, nodes, none, quality)


@query(f"""WITH l AS ({LINES}), n AS (SELECT l_orderkey, string_agg('{{"node_id":"' || l_orderkey::VARCHAR || '::n' || pos::VARCHAR || '","kind":"paragraph","rel_path":"m.xml","order_index":' || pos::VARCHAR || ',{NULLS[0]}"text":"' || t || '",{NULLS[1]}', ',' ORDER BY pos) AS nodes FROM l GROUP BY 1)
 SELECT o_orderkey::VARCHAR AS doc_id, sha256('{{"doc_id":"' || o_orderkey::VARCHAR || '","doc_group":"' || o_orderstatus || '","source_files":[{{"rel_path":"m.xml","is_attachment":false,"content_format":"dart_xml","schema_version":null,"content_sha256":null,"declared_encoding":null,"actual_encoding_used":null}}],"nodes":[' || coalesce(nodes, '') || '],"warnings":[],"parse_quality":{{"tier":"structured","schema_version":null,"n_sanitized_entities":0,"n_unresolved_section_depth":0,"n_tables_with_merged_cells":0,"router_matched_expected_parser":true}}}}') AS sha
 FROM orders LEFT JOIN n ON l_orderkey = o_orderkey""")
def document_ir_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order as a document's JSON line, by digest."""
    return assembly.to_line(order_documents(spark, sf_dir)).select("doc_id", F.sha2(F.col("line").cast("binary"), 256).alias("sha"))


@query("SELECT o_orderkey::VARCHAR AS doc_id, (SELECT count(*) FROM lineitem WHERE l_orderkey = o_orderkey) AS n_nodes, true AS same FROM orders")
def document_ir_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents written as JSON lines and read back."""
    made = assembly.to_line(order_documents(spark, sf_dir))
    back = made.select(F.from_json("line", assembly.schemas.DOCUMENT).alias("d"), "line", "doc_id")
    again = F.to_json("d", {"ignoreNullFields": "false"})
    return back.select("doc_id", F.size("d.nodes").cast("long").alias("n_nodes"), (again == F.col("line")).alias("same"))


@query("SELECT page_id::VARCHAR AS doc_id, 'structured' AS tier, 1 AS n_files FROM pages")
def document_ir_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page parsed and assembled: all stay structured, with one source file each."""
    parsed = parsed_pages(spark, sf_dir)
    manifest = parsed.select("doc_id", F.lit("exchange").alias("doc_group"), F.lit("page").alias("rcept_no"), F.lit("xml").alias("file_format"))
    nodes = docs.nodes(parsed)
    warned = docs.warnings(parsed, nodes)
    made = assembly.document_irs(parsed.withColumn("is_attachment", F.lit(False)), assembly.shaped_nodes(nodes), warned, docs.quality(parsed, warned, manifest))
    return made.select("doc_id", "parse_quality.tier", F.size("source_files").alias("n_files"))


@query("""WITH a AS (SELECT CASE WHEN doc_id % 3 = 0 THEN 'partial' ELSE 'structured' END AS tier, CASE WHEN doc_id % 5 <> 0 THEN n_chars::DOUBLE / 50000 END AS ratio, doc_id % 2 = 0 AS odd FROM documents)
 SELECT count(*) AS n_documents, 0 AS n_failed, count(ratio) AS n_with_ratio, round(avg(ratio), 6) AS mean_text_ratio, (SELECT string_agg(tier || ':' || n::VARCHAR, ',' ORDER BY tier) FROM (SELECT tier, count(*) AS n FROM a GROUP BY 1)) AS tiers, coalesce(nullif('x:' || count(*) FILTER (odd)::VARCHAR, 'x:0'), '') AS codes FROM a""")
def corpus_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The summary of a run; ratios that are missing are left out of the mean."""
    n = F.col("doc_id")
    audits = table(spark, sf_dir, "documents").select("doc_id", F.when(n % 3 == 0, "partial").otherwise("structured").alias("tier"), F.when(n % 5 != 0, F.col("n_chars") / 50000.0).alias("text_preservation_ratio"), F.when(n % 2 == 0, F.array(F.lit("x"))).otherwise(F.array().cast("array<string>")).alias("warning_codes"))
    shown = lambda c, key: F.array_join(F.transform(c, lambda x: F.concat_ws(":", x[key], x["n"])), ",")
    got = assembly.summary(audits)
    return got.select("n_documents", "n_failed", "n_with_ratio", F.round("mean_text_ratio", 6).alias("mean_text_ratio"), shown(F.col("tiers"), "tier").alias("tiers"), shown(F.col("warning_codes"), "code").alias("codes"))


@query("""WITH w AS (SELECT doc_id, list_filter(string_split_regex(text, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS t FROM documents),
 i AS (SELECT doc_id, t, unnest(range(0, greatest(0, ceil((len(t) - 512) / 448.0)::BIGINT) + 1)) AS k FROM w WHERE len(t) > 0)
 SELECT doc_id, doc_id::VARCHAR || '::words-512-64::' || k::VARCHAR AS chunk_id, len(list_slice(t, k * 448 + 1, k * 448 + 512)) AS token_count, sha256(array_to_string(list_slice(t, k * 448 + 1, k * 448 + 512), ' ')) AS sha FROM i""")
def chunk_tokens_512_64(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = F.array_remove(F.split("text", r"[\x20\x09-\x0D]+"), "")
    made = assembly.chunk_sets(table(spark, sf_dir, "documents").select("doc_id", "text"), words, "words-512-64")
    return made.select("doc_id", "chunk_id", F.col("token_count").cast("long").alias("token_count"), F.sha2(F.col("text").cast("binary"), 256).alias("sha"))


@query("SELECT c_custkey AS case_id, max(o_orderdate)::DATE::VARCHAR AS document_date FROM orders JOIN customer ON c_custkey = o_custkey WHERE o_orderdate::DATE <= DATE '1994-01-01' + (c_custkey % 1000)::INT GROUP BY 1")
def latest_visible(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last order of every customer up to a day of the customer's own."""
    o = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("case_id"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("document_date"), F.col("o_orderkey").alias("document_id"))
    day = F.date_add(F.lit("1994-01-01").cast("date"), (F.col("c_custkey") % 1000).cast("int")).cast("string")
    return cases.latest(o, table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("case_id"), day.alias("simulation_date"))).select("case_id", "document_date")


@query("SELECT o_orderkey FROM orders WHERE o_orderstatus IN ('F', 'P') AND o_orderpriority = '1-URGENT' AND strftime(o_orderdate, '%Y%m%d') >= '19940101' AND strftime(o_orderdate, '%Y%m%d') <= '19961231'")
def metadata_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").withColumn("rcept_dt", F.date_format("o_orderdate", "yyyyMMdd"))
    return cases.filtered(o, "19940101", "19961231", o_orderstatus=["F", "P"], o_orderpriority="1-URGENT").select("o_orderkey")


@query("SELECT item_id, CASE WHEN length(f) > 90 THEN replace(substr(f, 1, 90) || '…', '|', '\\|') ELSE replace(f, '|', '\\|') END AS cell FROM (SELECT item_id, regexp_replace(text, '[\\r\\n]+', ' ', 'g') AS f FROM benchmark)")
def escaped_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "benchmark").select("item_id", cases.escaped(F.col("text")).alias("cell"))


@query("SELECT o_custkey AS c, sum(o_totalprice) AS total FROM orders GROUP BY 1")
def calc_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cases.totals(table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c"), F.col("o_totalprice").alias("value")), "c")


@query("SELECT l_suppkey AS s, CASE WHEN a > r THEN 'A' WHEN a < r THEN 'R' WHEN a = r THEN '=' END AS larger FROM (SELECT l_suppkey, max(l_quantity) FILTER (l_returnflag = 'A' AND l_linenumber = 1) AS a, max(l_quantity) FILTER (l_returnflag = 'R' AND l_linenumber = 1) AS r FROM lineitem WHERE l_returnflag IN ('A', 'R') AND l_linenumber = 1 GROUP BY 1)")
def calc_compare(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts = table(spark, sf_dir, "lineitem").where("l_linenumber = 1").select(F.col("l_suppkey").alias("s"), F.col("l_returnflag").alias("fact"), F.col("l_quantity").alias("value"))
    return cases.compared(facts, "s", "A", "R").select("s", "larger")


@query("""SELECT conv_id, turn, CASE WHEN a <> '' THEN a ELSE 'money,purpose' END AS aspects FROM (SELECT conv_id, turn, concat_ws(',', CASE WHEN contains(t, 'cash') THEN 'money' END, CASE WHEN contains(t, 'why') THEN 'purpose' END, CASE WHEN contains(t, 'how much') THEN 'size' END, CASE WHEN contains(t, 'when') THEN 'when' END, CASE WHEN contains(t, 'risk') THEN 'risk' END) AS a
 FROM (SELECT conv_id, turn, lower(text) AS t FROM conversations WHERE text IS NOT NULL))""")
def question_aspects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "conversations").where("text is not null").select("conv_id", "turn", F.array_join(cases.aspects(F.col("text")), ",").alias("aspects"))


@query("""WITH d AS (SELECT o_custkey AS c, count(*) AS n, max(o_orderdate) AS last FROM orders WHERE o_orderstatus = 'F' GROUP BY 1), f AS (SELECT o_custkey AS c, count(*) AS n, min(o_orderdate) AS first FROM orders WHERE o_orderstatus = 'O' GROUP BY 1), e AS (SELECT o_custkey AS c, count(*) AS n, count(*) FILTER (o_orderpriority = '1-URGENT') AS k FROM orders GROUP BY 1)
 SELECT c_custkey AS case_id, concat_ws(',', CASE WHEN coalesce(d.n, 0) NOT BETWEEN 4 AND 8 THEN 'documents' END, CASE WHEN coalesce(e.n, 0) < 5 THEN 'evidence' END, CASE WHEN coalesce(e.k, 0) < 1 THEN 'critical' END, CASE WHEN coalesce(f.n, 0) < 1 THEN 'futures' END, CASE WHEN last > TIMESTAMP '1995-06-17' THEN 'future document' END, CASE WHEN first <= TIMESTAMP '1995-06-17' THEN 'past event' END) AS broken
 FROM customer LEFT JOIN d ON d.c = c_custkey LEFT JOIN e ON e.c = c_custkey LEFT JOIN f ON f.c = c_custkey""")
def pack_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Invariants of cases made of customers: finished orders are documents, open ones future events."""
    o = table(spark, sf_dir, "orders").withColumn("case_id", F.col("o_custkey"))
    d = o.where("o_orderstatus = 'F'").select("case_id", F.col("o_orderdate").alias("document_date"))
    f = o.where("o_orderstatus = 'O'").select("case_id", F.col("o_orderdate").alias("date"))
    e = o.select("case_id", F.when(F.col("o_orderpriority") == "1-URGENT", "critical").alias("importance"))
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("case_id"), F.lit("1995-06-17").cast("timestamp_ntz").alias("simulation_date"))
    return cases.pack_checks(d, e, f, c).select("case_id", F.array_join("broken", ",").alias("broken"))
