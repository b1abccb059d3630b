"""Queries of scalar functions, on the documents or on literal rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from disclosa.functions import text as t
from disclosa.plans.catalog import query, table


def literal(spark: SparkSession, *rows: str) -> DataFrame:
    return spark.createDataFrame(list(enumerate(rows)), "id long, x string")


def sql_rows(*rows: str) -> str:
    return "(VALUES " + ", ".join(f"({k}, '{r.replace(chr(39), chr(39) * 2)}')" for k, r in enumerate(rows)) + ") AS v(id, x)"


def out(df: DataFrame, **cols: Column) -> DataFrame:
    return df.select("id", *(c.alias(k) for k, c in cols.items()))


@query("SELECT doc_id, len(regexp_extract_all(lower(text), '[a-z]+|[0-9][0-9,.]*')) AS n, array_to_string(regexp_extract_all(lower(text), '[a-z]+|[0-9][0-9,.]*'), ' ') AS toks FROM documents")
def tokenize_ascii(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").select("doc_id", t.tokens(F.col("text")).alias("k"))
    return d.select("doc_id", F.size("k").cast("long").alias("n"), F.array_join("k", " ").alias("toks"))


HANGUL = ("현금및현금성자산 239,036 원", "값 하나 KRW 1.5", "공시", "abc 가 나다라", "")


@query(f"SELECT id, array_to_string(list_concat(regexp_extract_all(lower(x), '[a-z]+|[0-9][0-9,.]*'), flatten(list_transform(regexp_extract_all(lower(x), '[가-힣]+'), lambda w: CASE WHEN length(w) = 1 THEN [w] ELSE list_transform(range(1, length(w)), lambda i: substr(w, i, 2)) END))), '|') AS toks FROM {sql_rows(*HANGUL)}")
def tokenize_hangul_bigram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return out(literal(spark, *HANGUL), toks=F.array_join(t.tokens(F.col("x")), "|"))


TITLES = ("III. 재무", "1. 회사", "2-1. 연결", "【대표이사】", "Ⅳ 사업", "기타", " 3 개요", "12)")


@query(f"SELECT id, CASE WHEN regexp_matches(trim(x), '^[0-9]+-[0-9]+') THEN 3 WHEN regexp_matches(trim(x), '^([IVXLCDM]+\\.|[ⅠⅡⅢⅣⅤⅥⅦⅧⅨⅩ]+\\.?|【)') THEN 1 WHEN regexp_matches(trim(x), '^[0-9]+[.\\s]') THEN 2 ELSE 0 END::BIGINT AS level FROM {sql_rows(*TITLES)}")
def title_level(spark: SparkSession, sf_dir: str) -> DataFrame:
    return out(literal(spark, *TITLES), level=t.title_level(F.col("x")).cast("long"))


CAPTIONS = ("요약재무 (단위 : 백만원) 제 54 기말", "제3기(당기) (단위: 원)", "없음", "( 단위：천주 )")


@query(f"SELECT id, nullif(trim(regexp_extract(x, '\\(\\s*단위\\s*[:：]\\s*([^)]+)\\)', 1)), '') AS unit, nullif(trim(regexp_extract(x, '제\\s*[0-9]+\\s*기[^,)\\]\\s]*')), '') AS period FROM {sql_rows(*CAPTIONS)}")
def caption_unit_period(spark: SparkSession, sf_dir: str) -> DataFrame:
    return out(literal(spark, *CAPTIONS), unit=t.unit_text(F.col("x")), period=t.period_text(F.col("x")))


PATHS = ("재무|연결재무제표|주석", "별도|연결 및 별도 비교", "개요|사업", "연결|별도재무제표")


@query(f"WITH p AS (SELECT id, list_filter(list_reverse(string_split(x, '|')), lambda s: contains(s, '연결') OR contains(s, '별도'))[1] AS h FROM {sql_rows(*PATHS)}) SELECT id, CASE WHEN contains(h, '연결') AND contains(h, '별도') THEN NULL WHEN contains(h, '연결') THEN '연결' WHEN contains(h, '별도') THEN '별도' END AS basis FROM p")
def consolidation_basis(spark: SparkSession, sf_dir: str) -> DataFrame:
    return out(literal(spark, *PATHS), basis=t.consolidation(F.split("x", r"\|"))["basis"])


REPORTS = ("주요사항보고서(유상증자결정)", "[기재정정]주요사항보고서(회사합병결정) ", "[첨부추가]사업보고서", "분기보고서 (2023.03)")


@query(f"WITH c AS (SELECT id, trim(regexp_replace(x, '^\\[기재정정\\]|\\[첨부추가\\]', '', 'g')) AS y FROM {sql_rows(*REPORTS)}) SELECT id, coalesce(nullif(regexp_extract(y, '\\(([^()]+)\\)\\s*$', 1), ''), y) AS subtype FROM c")
def derive_subtype(spark: SparkSession, sf_dir: str) -> DataFrame:
    return out(literal(spark, *REPORTS), subtype=t.derived_subtype(F.col("x"), F.lit("")))


SQL_NUM = "list_transform(regexp_extract_all({}, '[0-9][0-9,.]*'), lambda n: regexp_replace(regexp_replace(replace(n, ',', ''), '\\.+$', ''), '\\.0$', ''))"


@query(f"SELECT doc_id, array_to_string({SQL_NUM.format('text')}, ' ') AS nums FROM documents")
def numbers_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", F.array_join(t.numbers(F.col("text")), " ").alias("nums"))


@query(f"""WITH n AS (SELECT doc_id, unnest({SQL_NUM.format('text')}) AS tok FROM documents),
 a AS (SELECT DISTINCT doc_id, tok FROM n UNION SELECT doc_id, (tok::HUGEINT // u)::VARCHAR FROM n, (VALUES (10000), (1000000), (100000000), (1000000000000)) AS v(u) WHERE regexp_matches(tok, '^[0-9]+$') AND tok::HUGEINT >= u)
 SELECT doc_id, count(*) AS n_allowed, string_agg(tok, ' ' ORDER BY tok) AS allowed FROM a GROUP BY 1""")
def allowed_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").select("doc_id", t.allowed_numbers(F.col("text")).alias("a")).where(F.size("a") > 0)
    return d.select("doc_id", F.size("a").cast("long").alias("n_allowed"), F.array_join(F.array_sort("a"), " ").alias("allowed"))


@query(f"""WITH p AS (SELECT a.doc_id, a.text AS answer, b.text AS source FROM documents a JOIN documents b ON b.doc_id = a.doc_id + 1),
 x AS (SELECT DISTINCT doc_id, unnest({SQL_NUM.format('answer')}) AS tok FROM p), n AS (SELECT doc_id, unnest({SQL_NUM.format('source')}) AS tok FROM p),
 ok AS (SELECT doc_id, tok FROM n UNION SELECT doc_id, (tok::HUGEINT // u)::VARCHAR FROM n, (VALUES (10000), (1000000), (100000000), (1000000000000)) AS v(u) WHERE regexp_matches(tok, '^[0-9]+$') AND tok::HUGEINT >= u)
 SELECT doc_id, string_agg(tok, ' ' ORDER BY tok) AS fabricated FROM x WHERE NOT regexp_full_match(tok, '(19|20)[0-9]{{2}}') AND NOT EXISTS (SELECT 1 FROM ok WHERE ok.doc_id = x.doc_id AND ok.tok = x.tok) GROUP BY 1""")
def fabricated_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers of each document that the next one does not support."""
    d = table(spark, sf_dir, "documents").select("doc_id", "text")
    nxt = d.select((F.col("doc_id") - 1).alias("doc_id"), F.col("text").alias("source"))
    both = d.join(nxt, "doc_id").select("doc_id", t.fabricated(F.col("text"), F.col("source")).alias("f")).where(F.size("f") > 0)
    return both.select("doc_id", F.array_join(F.array_sort("f"), " ").alias("fabricated"))


YEARS = ("2021년 매출 2023", "20199 그리고 1999", "없음")


@query(f"SELECT id, array_to_string(list_sort(list_distinct(list_filter(regexp_extract_all(x, '(?:19|20)[0-9]{{2}}'), lambda y: NOT contains('2023 1999', y)))), ' ') AS years FROM {sql_rows(*YEARS)}")
def period_grounded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return out(literal(spark, *YEARS), years=F.array_join(t.foreign_years(F.col("x"), F.lit("2023 1999")), " "))


CLAIMS = ("현금이 부족하다", "위험이 있다", "매출이 개선되었고 여유가 있다", "중립")


@query(f"WITH j AS (SELECT unnest(['{"', '".join(t.JUDGEMENT)}']) AS w) SELECT id, count(w) AS n FROM {sql_rows(*CLAIMS)} LEFT JOIN j ON contains(x, w) AND NOT contains('위험 요인', w) GROUP BY 1")
def judgment_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return out(literal(spark, *CLAIMS), n=F.size(t.judgements(F.col("x"), F.lit("위험 요인"))).cast("long"))


@query("""WITH l AS (SELECT doc_id, text, list_filter([strpos(text, 'the'), strpos(text, 'er '), strpos(text, '. ')], lambda p: p > 0) AS p FROM documents) SELECT doc_id, len(p) AS n_found, coalesce(list_min(p) - 1, -1) AS first_start FROM l""")
def highlight_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").select("doc_id", F.filter(F.array(F.instr("text", "the"), F.instr("text", "er "), F.instr("text", ". ")), lambda p: p > 0).alias("p"))
    return d.select("doc_id", F.size("p").cast("long").alias("n_found"), F.coalesce(F.array_min("p") - 1, F.lit(-1)).cast("long").alias("first_start"))


@query()
def highlight_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans to mark in each document, overlaps dropped: a greedy pass."""
    d = table(spark, sf_dir, "documents").select("doc_id", F.explode(t.highlight(F.col("text"), F.array(F.lit("the"), F.lit("er th"), F.lit(". ")))).alias("s"))
    return d.select("doc_id", F.col("s.start").cast("long").alias("start"), F.col("s.end").cast("long").alias("end"))


@query("""SELECT page_id, CASE WHEN regexp_matches(substr(html, 1, 512), '^\\s*%PDF') THEN 'pdf' WHEN regexp_matches(substr(html, 1, 512), '(?i)^\\s*<(!doctype\\s+html|html\\b)') THEN 'kind_html' WHEN regexp_matches(substr(html, 1, 512), '(?i)^\\s*<\\?xml\\b') OR regexp_matches(substr(html, 1, 2000), '(?i)<DOCUMENT\\b') THEN 'dart_xml' ELSE 'unknown' END AS kind FROM pages""")
def sniff_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", t.sniffed(F.col("html")).alias("kind"))


@query("""SELECT page_id, coalesce(nullif(lower(regexp_extract(substr(html, 1, 512), '(?i)<\\?xml[^>]*\\bencoding="([^"]+)"', 1)), ''), nullif(lower(regexp_extract(substr(html, 1, 512), '(?i)charset=["'']?([A-Za-z0-9_-]+)', 1)), '')) AS declared FROM pages""")
def declared_encoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", t.declared_encoding(F.col("html")).alias("declared"))


HEADS = ('<?xml version="1.0"?><DOCUMENT xsi:noNamespaceSchemaLocation="dart4.xsd">', " <html><body>", "<!DOCTYPE html>", "plain")


@query(f"""SELECT id, CASE WHEN regexp_extract(substr(x, 1, 400), 'noNamespaceSchemaLocation="([^"]+)"', 1) <> '' THEN regexp_extract(substr(x, 1, 400), 'noNamespaceSchemaLocation="([^"]+)"', 1) WHEN regexp_matches(substr(x, 1, 400), '^\\s*(<html|<!)') THEN 'n/a_html' ELSE 'unknown' END AS version FROM {sql_rows(*HEADS)}""")
def schema_peek(spark: SparkSession, sf_dir: str) -> DataFrame:
    return out(literal(spark, *HEADS), version=t.schema_peek(F.col("x")))


@query("SELECT page_id, length(regexp_replace(regexp_replace(html, '<[^>]+>', '', 'g'), '\\s+', '', 'g')) AS n_text, round(length(regexp_replace(regexp_replace(html, '<[^>]+>', '', 'g'), '\\s+', '', 'g'))::DOUBLE / length(regexp_replace(html, '\\s+', '', 'g')), 4) AS ratio FROM pages")
def text_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.length(t.squeeze(t.without_tags(F.col("html"))))
    return table(spark, sf_dir, "pages").select("page_id", n.cast("long").alias("n_text"), F.round(n / F.length(t.squeeze(F.col("html"))), 4).alias("ratio"))


@query("SELECT page_id, (length(html) - length(replace(html, '&', '')) - len(regexp_extract_all(html, '&(?:amp|lt|gt|quot|apos|#[0-9]+|#x[0-9a-fA-F]+);'))) AS n_bare FROM pages")
def bare_amp_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", F.regexp_count("html", F.lit(t.BARE_AMP)).cast("long").alias("n_bare"))


@query("SELECT page_id, array_to_string(list_sort(list_distinct(regexp_extract_all(upper(html), '</([A-Z][A-Z0-9_-]*)>', 1))), ' ') AS tags FROM pages")
def known_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", F.array_join(t.known_tags(F.upper("html")), " ").alias("tags"))


MARKUP = ("<P>a <IP x> b & c &amp; d</P>", "<P>1 < 2</P>", "no tags < & >", "<DOC><P>당사는 <Great Idea> 다</P></DOC>")
MARKUP_DONE = ("<P>a &lt;IP x> b &amp; c &amp; d</P>", "<P>1 &lt; 2</P>", "no tags &lt; &amp; >", "<DOC><P>당사는 &lt;Great Idea> 다</P></DOC>")


@query(f"SELECT id, x AS clean FROM {sql_rows(*MARKUP_DONE)}")
def sanitize_markup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return out(literal(spark, *MARKUP), clean=t.escaped_markup(F.col("x")))


@query("SELECT page_id, substr(trim(regexp_replace(regexp_replace(html, '<[^>]+>', ' ', 'g'), '\\s+', ' ', 'g')), 1, 20000) AS body FROM pages")
def fallback_paragraph(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", t.fallback_text(F.col("html")).alias("body"))


@query("WITH d AS (SELECT doc_id, unnest(regexp_extract_all(text || ' 2031-02-03 2031-02-31 1999-01-01', '[0-9]{4}-[0-9]{2}-[0-9]{2}')) AS x FROM documents) SELECT doc_id, count(DISTINCT x) AS n_later FROM d WHERE TRY_CAST(x AS DATE) > DATE '2023-05-23' GROUP BY 1")
def later_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = F.concat("text", F.lit(" 2031-02-03 2031-02-31 1999-01-01"))
    return table(spark, sf_dir, "documents").select("doc_id", F.size(t.later_dates(x, F.lit("2023-05-23").cast("date"))).cast("long").alias("n_later"))


@query("SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS day FROM orders")
def iso_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select("o_orderkey", t.iso_date(F.date_format("o_orderdate", "yyyyMMdd")).alias("day"))


WON = ("473,200,000,000", "금액 99,999,999원", "없음")


@query("SELECT * FROM (VALUES (0, '4,732억원'), (1, '0억원'), (2, '')) AS v(id, eok)")
def won_to_eok(spark: SparkSession, sf_dir: str) -> DataFrame:
    return out(literal(spark, *WON), eok=t.eok(F.col("x")))


NOTES = ("※ 참고", "주1) 설명", "주) 설명", "본문 주1)")


@query(f"SELECT id, (starts_with(x, '※') OR regexp_matches(x, '^주[0-9]*\\)')) AS note FROM {sql_rows(*NOTES)}")
def footnotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return out(literal(spark, *NOTES), note=t.is_footnote(F.col("x")))


@query("""WITH l AS (SELECT doc_id, string_split(text, chr(10)) AS lines FROM documents), f AS (SELECT doc_id, lines, list_position(list_transform(lines, lambda x: contains(x, 'the') AND contains(x, '.')), true) AS pos FROM l)
 SELECT doc_id, array_to_string(list_slice(lines, pos, pos + 1), chr(10)) AS block FROM f WHERE pos > 0""")
def first_match_block(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", t.block(F.col("text"), ["the", "."], 2).alias("block")).where("block is not null")


@query("""WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM documents),
 s AS (SELECT *, sum(length(line) + 1) OVER (PARTITION BY doc_id ORDER BY pos) AS total FROM l) SELECT doc_id, count(*) AS n_lines, max(total)::BIGINT AS n_chars FROM s WHERE total <= 2000 GROUP BY 1""")
def prefix_budget(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of each document that fit a budget of characters: a fold over the document's own lines, without a shuffle."""
    lines = F.split("text", "\n")
    acc = F.aggregate(lines, F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("c"), F.lit(True).alias("open")), lambda a, x: F.struct((a["n"] + F.when(a["open"] & (a["c"] + F.length(x) + 1 <= 2000), 1).otherwise(0)).alias("n"), (a["c"] + F.when(a["open"] & (a["c"] + F.length(x) + 1 <= 2000), F.length(x) + 1).otherwise(0)).alias("c"), (a["open"] & (a["c"] + F.length(x) + 1 <= 2000)).alias("open")))
    return table(spark, sf_dir, "documents").select("doc_id", acc.alias("a")).where("a.n > 0").select("doc_id", F.col("a.n").alias("n_lines"), F.col("a.c").alias("n_chars"))
