"""Queries of parsing, sections, table grids and audits; node streams and cells are derived from lineitem."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from disclosa.functions import grid, sections
from disclosa.functions.text import distinct_neighbours, let, row_line, title_level
from disclosa.operators import documents as docs
from disclosa.plans.catalog import query, table
from disclosa.sources import parser

#: A file is an order, its titles are line items in an order that holds for repeated keys too.
KEY_ORDER = ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"]
NAMES = """CASE CAST(l_partkey AS BIGINT) % 5 WHEN 0 THEN 'II. ' WHEN 1 THEN '1. ' WHEN 2 THEN '2-1. ' WHEN 3 THEN '' ELSE '3 ' END || 'part ' || CAST(l_partkey AS VARCHAR)"""
SQL_T = f"""t AS (SELECT l_orderkey AS f, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice) - 1 AS pos, {NAMES} AS title, CASE CAST(l_partkey AS BIGINT) % 5 WHEN 0 THEN 1 WHEN 1 THEN 2 WHEN 2 THEN 3 WHEN 3 THEN 0 ELSE 2 END AS own FROM lineitem),
 g AS (SELECT *, sum(CASE WHEN own > 0 THEN 1 ELSE 0 END) OVER (PARTITION BY f ORDER BY pos) AS grp FROM t),
 l AS (SELECT f, pos, title, own > 0 AS confident, first_value(own) OVER (PARTITION BY f, grp ORDER BY pos) + row_number() OVER (PARTITION BY f, grp ORDER BY pos) - CASE WHEN grp = 0 THEN 0 ELSE 1 END AS level FROM g)"""


def titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """f, at, title, own; dealt by f, so what is gathered or ordered by f next needs no further shuffle."""
    li = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("f"), *KEY_ORDER)
    at = F.row_number().over(Window.partitionBy("f").orderBy(*KEY_ORDER)) - 1
    named = li.select("f", at.alias("at"), F.expr(NAMES.replace("VARCHAR", "STRING")).alias("title"))
    return named.withColumn("own", title_level(F.col("title")).cast("int"))


def trees(spark: SparkSession, sf_dir: str, ends: bool = False) -> DataFrame:
    held = titles(spark, sf_dir).groupBy("f").agg(F.array_sort(F.collect_list(F.struct("at", "title", "own"))).alias("t"), F.count("*").cast("int").alias("n"))
    return held.select("f", sections.fold(F.col("t"), F.col("n") if ends else None).alias("r"))


@query(f"WITH {SQL_T} SELECT a.f, a.pos AS \"at\", a.level, a.confident, max(b.pos) AS parent FROM l a LEFT JOIN l b ON a.f = b.f AND b.pos < a.pos AND b.level < a.level GROUP BY 1, 2, 3, 4")
def section_tree_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = trees(spark, sf_dir).select("f", F.explode("r.sections").alias("s"))
    # The nearest earlier title of a smaller level is the innermost open one.
    return s.select("f", F.col("s.at").cast("long").alias("at"), F.col("s.level").cast("long").alias("level"), F.col("s.confident").alias("confident"), F.col("s.parent").cast("long").alias("parent"))


@query(f"WITH {SQL_T} SELECT a.f, a.pos AS \"at\", coalesce(min(b.pos) - 1, max(n.n) - 1) AS end_at FROM l a LEFT JOIN l b ON a.f = b.f AND b.pos > a.pos AND b.level <= a.level JOIN (SELECT f, count(*) AS n FROM l GROUP BY 1) n ON n.f = a.f GROUP BY 1, 2")
def section_end(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = trees(spark, sf_dir, ends=True).select("f", F.explode("r.ends").alias("e"))
    return e.select("f", F.col("e.at").cast("long").alias("at"), F.col("e.end").cast("long").alias("end_at"))


@query(f"""WITH RECURSIVE {SQL_T}, p AS (SELECT a.f, a.pos, max(b.pos) AS parent FROM l a LEFT JOIN l b ON a.f = b.f AND b.pos < a.pos AND b.level < a.level GROUP BY 1, 2),
 r AS (SELECT f, pos, parent, '' AS path FROM p WHERE parent IS NULL UNION ALL SELECT p.f, p.pos, p.parent, CASE WHEN r.path = '' THEN '' ELSE r.path || ' / ' END || l.title FROM p JOIN r ON p.f = r.f AND p.parent = r.pos JOIN l ON l.f = r.f AND l.pos = r.pos) SELECT f, pos AS "at", path FROM r""")
def hierarchy_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Paths are joined before sections become rows, so rows carry nothing else of them.
    paths = F.transform("r.sections", lambda s: F.struct(s["at"].cast("long").alias("at"), F.array_join(s["hierarchy"], " / ").alias("path")))
    return trees(spark, sf_dir).select("f", F.inline(paths))


@query(f"""WITH RECURSIVE {SQL_T}, p AS (SELECT a.f, a.pos, max(b.pos) AS parent FROM l a LEFT JOIN l b ON a.f = b.f AND b.pos < a.pos AND b.level < a.level GROUP BY 1, 2),
 r AS (SELECT p.f, p.pos, p.parent, l.title AS path FROM p JOIN l ON l.f = p.f AND l.pos = p.pos WHERE parent IS NULL UNION ALL SELECT p.f, p.pos, p.parent, r.path || ' / ' || l.title FROM p JOIN r ON p.f = r.f AND p.parent = r.pos JOIN l ON l.f = p.f AND l.pos = p.pos),
 k AS (SELECT f, pos, row_number() OVER (PARTITION BY f ORDER BY pos) AS nth FROM r WHERE contains(path, 'part 1') OR contains(path, 'II. ')) SELECT f, pos AS "at" FROM k WHERE nth <= 3""")
def section_keyword_select(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first three nodes of each file whose hierarchy or own title holds a keyword."""

    def hit(s: Column) -> Column:
        return let(F.array_join(F.array_append(s["hierarchy"], s["title"]), " / "), lambda path: path.contains("part 1") | path.contains("II. "))

    # The sections of a file are in order already.
    first = trees(spark, sf_dir).select("f", F.explode(F.slice(F.filter("r.sections", hit), 1, 3)["at"]).alias("at"))
    return first.select("f", F.col("at").cast("long").alias("at"))


#: A table is an order: rows are quantities modulo 4, a tag and spans come from the line.
SQL_C = """c AS (SELECT l_orderkey AS f, CAST(l_partkey AS BIGINT) % 4 AS r, row_number() OVER (PARTITION BY l_orderkey, CAST(l_partkey AS BIGINT) % 4 ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice) - 1 AS k,
 CASE WHEN l_suppkey % 2 = 0 THEN 'TH' ELSE 'TD' END AS tag, 1 + CAST(l_partkey AS BIGINT) % 3 % 2 AS rs, 1 + CAST(l_suppkey AS BIGINT) % 3 % 2 AS cs FROM lineitem)"""


def tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """f, cells, rows of every table."""
    r = (F.col("l_partkey") % 4).cast("int")
    k = F.row_number().over(Window.partitionBy("l_orderkey", r).orderBy(*KEY_ORDER)) - 1
    li = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("f"), r.alias("row"), k.alias("col"), F.concat(F.lit("c"), F.col("l_partkey").cast("string")).alias("text"),
        (1 + F.col("l_partkey") % 3 % 2).cast("int").alias("rowspan"), (1 + F.col("l_suppkey") % 3 % 2).cast("int").alias("colspan"), F.when(F.col("l_suppkey") % 2 == 0, "TH").otherwise("TD").alias("tag"),
    )
    cells = li.groupBy("f").agg(F.collect_list(F.struct("row", "col", "text", "rowspan", "colspan", "tag")).alias("cells"))
    return cells.withColumn("rows", grid.rows_of(F.col("cells")))


@query(f"WITH {SQL_C}, m AS (SELECT f, max(r) AS top FROM c GROUP BY 1), x AS (SELECT f, unnest(range(0, top + 1)) AS r FROM m) SELECT x.f, x.r, count(c.f) AS n_cells, coalesce(sum(c.cs), 0)::BIGINT AS width FROM x LEFT JOIN c ON c.f = x.f AND c.r = x.r GROUP BY 1, 2")
def grid_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = tables(spark, sf_dir).select("f", F.posexplode(F.arrays_zip(F.col("rows").alias("cells"), grid.widths(F.col("rows")).alias("w"))).alias("r", "x"))
    return t.select("f", F.col("r").cast("long").alias("r"), F.size("x.cells").cast("long").alias("n_cells"), F.col("x.w").cast("long").alias("width"))


SQL_W = f"{SQL_C}, m AS (SELECT f, max(r) AS top FROM c GROUP BY 1), x AS (SELECT f, unnest(range(0, top + 1)) AS r FROM m), w AS (SELECT x.f, x.r, coalesce(sum(c.cs), 0)::BIGINT AS width FROM x LEFT JOIN c ON c.f = x.f AND c.r = x.r GROUP BY 1, 2), n AS (SELECT f, width, count(*) AS n, min(r) AS first FROM w GROUP BY 1, 2), u AS (SELECT f, width AS mode FROM (SELECT *, row_number() OVER (PARTITION BY f ORDER BY n DESC, first) AS k FROM n) WHERE k = 1)"


@query(f"WITH {SQL_W} SELECT f, mode AS n_declared_cols FROM u")
def grid_mode_width(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables(spark, sf_dir).select("f", grid.usual_width(grid.widths(F.col("rows"))).cast("long").alias("n_declared_cols"))


@query(f"WITH {SQL_W} SELECT w.f, string_agg(w.r::VARCHAR, ' ' ORDER BY w.r) AS odd FROM w JOIN u ON u.f = w.f WHERE width <> mode GROUP BY 1")
def grid_ragged(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = tables(spark, sf_dir).select("f", grid.odd_rows(grid.widths(F.col("rows"))).alias("o")).where(F.size("o") > 0)
    return t.select("f", F.array_join(F.transform("o", lambda x: x.cast("string")), " ").alias("odd"))


@query(f"WITH {SQL_C}, h AS (SELECT f, r FROM c GROUP BY 1, 2 HAVING count(*) FILTER (tag = 'TH') * 2 > count(*)) SELECT f, string_agg(r::VARCHAR, ' ' ORDER BY r) AS header FROM h GROUP BY 1")
def grid_header_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = tables(spark, sf_dir).select("f", grid.header_rows(F.col("rows")).alias("h")).where(F.size("h") > 0)
    return t.select("f", F.array_join(F.transform("h", lambda x: x.cast("string")), " ").alias("header"))


@query(f"WITH {SQL_C} SELECT f, bool_or(rs > 1 OR cs > 1) AS merged FROM c GROUP BY 1")
def grid_merged_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables(spark, sf_dir).select("f", grid.has_merged(F.col("cells")).alias("merged"))


@query("SELECT * FROM (VALUES (0, '구분|금액|금액'), (1, '구분|당기|전기')) AS v(r, line)")
def grid_expand(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = [(0, 0, "구분", 2, 1, "TH"), (0, 1, "금액", 1, 2, "TH"), (1, 1, "당기", 1, 1, "TD"), (1, 2, "전기", 1, 1, "TD")]
    one = spark.createDataFrame([(cells,)], f"cells array<{grid.CELL}>")
    wide = one.select(F.posexplode(grid.rectangle(grid.rows_of(F.col("cells")))).alias("r", "x"))
    return wide.select(F.col("r").cast("long").alias("r"), F.array_join("x", "|").alias("line"))


@query()
def grid_expand_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every derived table as a rectangle: placing spans is sequential, which SQL does not express."""
    t = tables(spark, sf_dir).select("f", F.posexplode(grid.rectangle(F.col("rows"))).alias("r", "x"))
    return t.select("f", F.col("r").cast("long").alias("r"), F.array_join("x", "|").alias("line"))


@query("WITH o AS (SELECT l_orderkey AS f, l_returnflag AS x, row_number() OVER w AS pos, lag(l_returnflag) OVER w AS before FROM lineitem WINDOW w AS (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice)) SELECT f, string_agg(x, '|' ORDER BY pos) AS line FROM o WHERE before IS NULL OR before <> x GROUP BY 1")
def dedup_adjacent(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = F.array_sort(F.collect_list(F.struct(*KEY_ORDER, "l_returnflag")))
    rows = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("f")).agg(F.transform(held, lambda x: x["l_returnflag"]).alias("cells"))
    return rows.select("f", F.array_join(distinct_neighbours(F.col("cells")), "|").alias("line"))


@query("WITH o AS (SELECT l_orderkey AS f, l_returnflag AS x, row_number() OVER w AS pos, lag(l_returnflag) OVER w AS before FROM lineitem WINDOW w AS (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice)) SELECT f, string_agg(x, ' | ' ORDER BY pos) AS line FROM o WHERE before IS NULL OR before <> x GROUP BY 1")
def table_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = F.array_sort(F.collect_list(F.struct(*KEY_ORDER, "l_returnflag")))
    rows = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("f")).agg(F.transform(held, lambda x: x["l_returnflag"]).alias("cells"))
    return rows.select("f", row_line(F.col("cells")).alias("line"))


def parsed_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    files = pages.select(F.col("page_id").cast("string").alias("doc_id"), F.lit("page.html").alias("rel_path"), F.col("html").cast("binary").alias("content"), F.lit("kind_html").alias("expected"))
    return parser.parse_files(files)


@query("SELECT page_id::VARCHAR AS doc_id, length(regexp_replace(regexp_replace(html, '<[^>]+>', '', 'g'), '\\s+', '', 'g')) AS raw_chars, len(regexp_extract_all(lower(html), '<table[\\s>]')) = 0 AS no_table FROM pages")
def html_event_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The parser over all pages."""
    p = parsed_pages(spark, sf_dir)
    return p.select("doc_id", "raw_chars", (F.size(F.filter("events", lambda e: e["kind"] == "table")) == 0).alias("no_table"))


@query("SELECT sha256(html) AS sha, count(*) AS n FROM pages GROUP BY 1")
def source_hashes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parsed_pages(spark, sf_dir).groupBy(F.col("content_sha256").alias("sha")).agg(F.count("*").alias("n"))


SAMPLES = {
    "D1": '<?xml version="1.0" encoding="utf-8"?><DOCUMENT noNamespaceSchemaLocation="dart4.xsd"><TITLE>I. 개요</TITLE><P>당사는 <Great Idea> 회사</P><TITLE>1. 현황</TITLE><TABLE-GROUP><TITLE ATOC="N">표 (단위 : 원) 제 3 기</TITLE><TABLE><TR><TH ROWSPAN="2">구분</TH><TH COLSPAN="2">금액</TH></TR><TR><TD>당기</TD><TD>전기</TD></TR></TABLE></TABLE-GROUP><TITLE>세부</TITLE><P>※ 끝</P></DOCUMENT>',
    "D2": "<DOCUMENT><P>a<TABLE-GROUP></P></TABLE-GROUP></DOCUMENT>",
    "D3": "<html><body><table><tr><td>x</td><td colspan='2'>y</td></tr></table></body></html>",
    "D4": "%PDF-1.4",
}


def sample_corpus(spark: SparkSession) -> tuple[DataFrame, DataFrame]:
    rows = [(k, f"{k}.xml", bytearray(v.encode()), "kind_html" if k == "D3" else "dart_xml") for k, v in SAMPLES.items()]
    files = spark.createDataFrame(rows, "doc_id string, rel_path string, content binary, expected string")
    manifest = spark.createDataFrame([(k, "exchange" if k == "D3" else "periodic", k, "pdf+html" if k == "D4" else "xml") for k in SAMPLES], "doc_id string, doc_group string, rcept_no string, file_format string")
    return parser.parse_files(files), manifest


@query("SELECT * FROM (VALUES ('D1', 'partial', 3, 1, 2), ('D2', 'fallback', 0, 0, 1), ('D3', 'structured', 0, 1, 0), ('D4', 'partial', 0, 0, 0)) AS v(doc_id, tier, n_sections, n_tables, n_paragraphs)")
def parse_audit_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed, manifest = sample_corpus(spark)
    nodes = docs.nodes(parsed)
    q = docs.quality(parsed, docs.warnings(parsed, nodes), manifest)
    return docs.audit(q, nodes).select("doc_id", "tier", "n_sections", "n_tables", "n_paragraphs")


@query("SELECT * FROM (VALUES ('D1', 'sanitized_entity', 1), ('D1', 'unknown_section_depth', 1), ('D1', 'table_merged_cell_ignored', 1), ('D1', 'table_shape_mismatch', 1), ('D2', 'parse_failed', 1), ('D3', 'table_merged_cell_ignored', 1), ('D3', 'table_metadata_uncertain', 1)) AS v(doc_id, code, n)")
def parse_warnings(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed, _ = sample_corpus(spark)
    return docs.warnings(parsed, docs.nodes(parsed)).groupBy("doc_id", "code").agg(F.count("*").alias("n"))


@query("SELECT * FROM (VALUES ('D1', 0, 0, '## I. 개요'), ('D1', 1, 0, '당사는 <Great Idea> 회사'), ('D1', 2, 0, '## 1. 현황'), ('D1', 3, 0, '구분 | 금액'), ('D1', 3, 1, '구분 | 당기 | 전기'), ('D1', 4, 0, '## 세부'), ('D1', 5, 0, '※ 끝'), ('D2', 0, 0, 'a'), ('D3', 0, 0, 'x | y')) AS v(doc_id, order_index, line_no, line)")
def render_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed, _ = sample_corpus(spark)
    lines = docs.lines(docs.nodes(parsed))
    return lines.select("doc_id", F.col("order_index").cast("long").alias("order_index"), F.col("line_no").cast("long").alias("line_no"), "line")
