"""Functions, parser, documents, search, grounding, samples, sessions on literal rows."""

import pytest
from pyspark.sql import functions as F

from disclosa.functions import grid, sections, text
from disclosa.operators import assembly, cases, corpus, documents, grounding, search, sessions
from disclosa.sources import corpus as sources
from disclosa.sources import parser

CELLS = "cells array<struct<row:int,col:int,text:string,rowspan:int,colspan:int,tag:string>>"


def column(spark, f, *values):
    return [r[0] for r in spark.createDataFrame([(k, v) for k, v in enumerate(values)], "k int, x string").orderBy("k").select(f(F.col("x"))).collect()]


def test_white_space_of_any_script(spark):
    assert column(spark, text.strip, "　a b ", None) == ["a b", None]
    assert column(spark, text.squeeze, "a　b \n c") == ["abc"]
    assert column(spark, text.collapse, " a　\n b ") == ["a b"]


def test_tokens_and_numbers(spark):
    assert column(spark, text.tokens, "현금 A1,000.5 가") == [["a", "1,000.5", "현금", "가"]]
    assert column(spark, text.numbers, "1,000. 2.0 3.50", "") == [["1000", "2", "3.50"], []]
    assert set(column(spark, text.allowed_numbers, "473,200,000,000")[0]) == {"473200000000", "47320000", "473200", "4732"}
    assert column(spark, text.allowed_numbers, "9" * 40) == [["9" * 40]]


@pytest.mark.parametrize(
    ("cells", "want"),
    [
        ([(0, 0, "구분", 2, 1, "TH"), (0, 1, "금액", 1, 2, "TH"), (1, 1, "당기", 1, 1, "TD"), (1, 2, "전기", 1, 1, "TD")], [["구분", "금액", "금액"], ["구분", "당기", "전기"]]),
        ([(0, 0, "a", 1, 1, "TD"), (2, 0, "b", 1, 2, "TD")], [["a", ""], ["", ""], ["b", "b"]]),
        ([(0, 0, "a", 2, 1, "TD"), (0, 1, "b", 1, 1, "TD"), (1, 0, "c", 1, 1, "TD"), (1, 1, "cut", 1, 1, "TD")], [["a", "b"], ["a", "c"]]),
        ([(0, 0, "", 2, 1, "TD"), (0, 1, "b", 1, 1, "TD"), (1, 0, "c", 1, 1, "TD")], [["", "b"], ["", "c"]]),
        ([], []),
    ],
)
def test_rectangle(spark, cells, want):
    df = spark.createDataFrame([(cells,)], CELLS)
    assert df.select(grid.rectangle(grid.rows_of(F.col("cells")))).first()[0] == want


def test_shape(spark):
    rows = [(0, 0, "h", 1, 1, "TH"), (0, 1, "h", 1, 1, "TH"), (1, 0, "x", 1, 1, "TH"), (1, 1, "x", 1, 1, "TD"), (2, 0, "y", 1, 1, "TD")]
    df = spark.createDataFrame([(rows,)], CELLS).select(grid.rows_of(F.col("cells")).alias("r"), "cells")
    w = grid.widths(F.col("r"))
    got = df.select(grid.header_rows(F.col("r")), w, grid.usual_width(w), grid.shape_note(w), grid.has_merged(F.col("cells"))).first()
    assert tuple(got) == ([0], [2, 2, 1], 2, "1/3 rows have column count != mode(2) — rows [2]", False)


XML = '<?xml version="1.0" encoding="utf-8"?><DOCUMENT>%s</DOCUMENT>'


@pytest.mark.parametrize(
    ("raw", "kind", "ok"),
    [
        ((XML % "<P>당사는 <Great Idea> 다</P>").encode(), "dart_xml", True),
        ((XML % "<P><IP 비즈니스> 다</P>").encode(), "dart_xml", True),
        (b"<DOCUMENT><P>a<TABLE-GROUP></P></TABLE-GROUP></DOCUMENT>", "dart_xml", False),
        (b'<DOCUMENT><P ENG=""Other"">a</P></DOCUMENT>', "dart_xml", False),
        (b"<html><table><tr><td>a</td></tr></table></html>", "kind_html", True),
        (b"%PDF-1.7", "pdf", True),
        (b"garbage", "unknown", False),
    ],
)
def test_parse_file(raw, kind, ok):
    row = parser.parse_file("d", "f.xml", raw)
    assert (row["content_format"], row["ok"]) == (kind, ok)


def test_decode():
    assert parser.decode("가".encode())[2] == "utf-8"
    euc = '<meta charset="euc-kr">가'.encode("euc-kr")
    assert parser.decode(euc)[1:] == ("euc-kr", "euc-kr")
    assert parser.decode('<meta charset="euc-kr">가'.encode())[1:] == ("euc-kr", "utf-8") and parser.differs("euc-kr", "utf-8")
    assert parser.decode(b"\xff\xfe\xff")[2] == "utf-8(replace)" and not parser.differs(None, "utf-8")
    assert not parser.differs("UTF_8", "utf-8(replace)")


def test_nested_html_tables():
    events, n = parser.html_events("<table><tr><td>a<table><tr><td rowspan=2>b</td></tr></table></td><td>c<br>d</td></tr></table>")
    assert n == 2 and [[(c["text"], c["rowspan"]) for c in e["cells"]] for e in events] == [[("ab", 1), ("cd", 1)], [("b", 2)]]


def files(spark, *rows):
    return spark.createDataFrame([(d, f, bytearray(b), None) for d, f, b in rows], "doc_id string, rel_path string, content binary, expected string")


def test_sections_and_nodes(spark):
    body = "".join(f"<TITLE>{t}</TITLE><P>x</P>" for t in ("III. a", "1. b", "2. c", "2-1. d", "e", "f", "3. g"))
    nodes = documents.nodes(parser.parse_files(files(spark, ("d", "r.xml", (XML % body).encode())))).orderBy("order_index").collect()
    titles = [n for n in nodes if n.kind == "section"]
    assert [n.level for n in titles] == [1, 2, 2, 3, 4, 5, 2]
    assert [n.end_order_index for n in titles] == [13, 3, 11, 11, 11, 11, 13]
    assert [n.parent_section_id for n in titles][:4] == ["ROOT", "d::r.xml::n0", "d::r.xml::n0", "d::r.xml::n4"]
    assert nodes[7].section_hierarchy == ["III. a", "2. c", "2-1. d"]


def test_fold_of_long_files_against_a_stack(spark):
    import random

    draw, files = random.Random(7), [[]]
    for n in (1, 2, 40, 300):
        files += [[draw.choice((0, 0, 1, 2, 3)) for _ in range(n)], [0] * n, [draw.choice((2, 3)) for _ in range(n)]]

    def wanted(owns):
        rows, ends, held, level = [], {}, [], 0
        for k, own in enumerate(owns):
            level = own or level + 1
            while held and held[-1][0] >= level:
                ends[held.pop()[1]] = 2 * k - 1
            rows.append((2 * k, f"t{k}", level, own > 0, held[-1][1] if held else None, [f"t{at // 2}" for _, at in held]))
            held.append((level, 2 * k))
        return rows, ends | {at: 2 * len(owns) for _, at in held}

    given = spark.createDataFrame([(f, [(2 * k, f"t{k}", own) for k, own in enumerate(owns)], 2 * len(owns) + 1) for f, owns in enumerate(files)], "f int, t array<struct<at:int,title:string,own:int>>, n int")
    got = given.select("f", sections.fold(F.col("t"), F.col("n")).alias("r"), sections.fold(F.col("t")).alias("bare")).collect()
    for row in got:
        rows, ends = wanted(files[row.f])
        assert [tuple(x) for x in row.r.sections] == rows and [tuple(x) for x in row.bare.sections] == rows
        assert {x.at: x.end for x in row.r.ends} == ends and len(row.r.ends) == len(ends)


def test_broken_rows_are_quarantined(spark):
    bad = b"<html><table><tr><td rowspan='x'>a</td></tr></table></html>"
    good, failed = sources.quarantine(parser.parse_files(files(spark, ("d", "a.xml", bad), ("e", "b.xml", b"%PDF"))))
    assert [r.doc_id for r in good.collect()] == ["e"] and failed.first().error.startswith("ValueError")


def test_manifest_and_files(spark, tmp_path):
    import unicodedata

    name = unicodedata.normalize("NFD", "가나")
    (tmp_path / "docs" / name).mkdir(parents=True)
    (tmp_path / "docs" / name / "1.xml").write_text(XML % "<P>x</P>")
    line = '{"doc_id":"major_1","corp_code":"00012345","stock_code":"000001","doc_group":"major","doc_subtype":null,"report_nm":"[기재정정]주요(유상증자)","rcept_no":"1","file_path":"docs/가나","file_format":"xml","n_files":2}'
    (tmp_path / "m.jsonl").write_text(line + "\n\n" + line.replace("major_1", "major_2").replace("가나", "없음") + "\n")
    manifest = sources.read_manifest(spark, str(tmp_path / "m.jsonl"))
    assert {(r.derived_subtype, r.corp_code) for r in manifest.collect()} == {("유상증자", "00012345")}
    found, missing = sources.located(manifest, sources.read_files(spark, str(tmp_path), "*.xml"), str(tmp_path))
    assert [r.doc_id for r in sources.to_parse(found).collect()] == ["major_1"] and [r.doc_id for r in missing.collect()] == ["major_2"]
    assert [(r.doc_id, r.n_found) for r in corpus.file_count_mismatches(manifest, found).orderBy("doc_id").collect()] == [("major_1", 1), ("major_2", 0)]


def test_universe_has_a_byte_order_mark(spark, tmp_path):
    head = "corp_code,stock_code,corp_name,listed_name,corp_eng_name,market,industry,sector_no,sector,listing_date,fiscal_month,market_cap,n_periodic,n_major,n_exchange,n_holding,note"
    (tmp_path / "u.csv").write_text("﻿" + head + "\n00000001,000001,a,a,A,K,i,1,s,2000-01-01,12,43867615524480,1,2,3,4,\n", encoding="utf-8")
    row = sources.read_universe(spark, str(tmp_path / "u.csv")).first()
    assert (row.corp_code, row.market_cap, row.note) == ("00000001", 43867615524480, "")


def test_point_in_time(spark):
    rows = [("C:D01:000", "C", "d", "D01", "2023-05-23", "t", "s", "현금 cash flow"), ("C:FUT01:000", "C", "e", None, "2024-01-01", "t", "s", "cash cash cash")]
    chunks = spark.createDataFrame(rows, "chunk_id string, case_id string, doc_id string, document_id string, document_date string, title string, source_type string, text string")
    q = spark.createDataFrame([("q", "C", "cash")], "query_id string, case_id string, query string")
    assert [r.chunk_id for r in search.search(chunks, q, "2023-05-23").collect()] == ["C:D01:000"]
    assert [r.chunk_id for r in search.search(chunks, q, None).orderBy("rank").collect()] == ["C:FUT01:000", "C:D01:000"]
    assert tuple(search.retriever_stats(chunks, "2023-05-23").first())[1:] == (2, 1, 1)
    with pytest.raises(Exception, match="future leakage"):
        search.checked(search.search(chunks, q, None), "2023-05-23").collect()


@pytest.mark.parametrize("n", [0, 1, 12, 13, 20, 21, 39])
def test_line_windows(spark, n):
    lines = [f"l{k}" for k in range(n)]
    want, start = [], 0
    while start < n:
        want.append("\n".join(lines[start : start + 12]))
        if start + 12 >= n:
            break
        start += 8
    assert column(spark, text.line_windows, "\n \n".join(lines)) == [want]


def test_answer_lines_keep_a_line_from_another_chunk(spark):
    found = spark.createDataFrame([("q", "a", 1, 2.0, "cash one\ncash two\ncash three"), ("q", "b", 2, 1.0, "cash three\nother line")], "question_id string, chunk_id string, rank int, score double, text string")
    terms = spark.createDataFrame([("q", ["cash"])], "question_id string, terms array<string>")
    got = [(r.chunk_id, r.line) for r in search.answer_lines(found, terms).orderBy("at").collect()]
    assert got == [("a", "cash one"), ("a", "cash two"), ("b", "cash three")]


def plain_allocation(sizes, total):
    """The rule of allocation(), a unit at a time."""
    whole = sum(sizes.values())
    share = {k: total * n / whole for k, n in sizes.items()}
    got = {k: max(1, int(share[k])) for k in sorted(sizes)}
    missing = min(total, whole) - sum(got.values())
    by_rest = sorted(got, key=lambda k: (int(share[k]) - share[k], k))
    while missing > 0:
        for k in [k for k in by_rest if got[k] < sizes[k]][:missing]:
            got[k] += 1
            missing -= 1
    while missing < 0 and max(got.values()) > 1:
        got[min(k for k in got if got[k] == max(got.values()))] -= 1
        missing += 1
    return got


def test_allocation(spark):
    tables = [{(g, t): 10 for g in "abcd" for t in "xyz"}, {("a", "x"): 2}, {(f"{k:02d}", "x"): 1 + 100 * (k == 0) for k in range(50)}, {("a", "x"): 7, ("a", "y"): 1, ("b", "x"): 500, ("c", "z"): 33, ("d", "z"): 33}]
    for total in (90, 20, 3):
        for sizes in tables:
            rows = spark.createDataFrame([(*k, n) for k, n in sizes.items()], "doc_group string, tier string, stratum_size long")
            assert {(r.doc_group, r.tier): r.quota for r in corpus.allocation(rows, total).collect()} == plain_allocation(sizes, total)
    assert corpus.allocation(rows.limit(0), 90).count() == 0


def test_containing_finds_every_needle(spark):
    texts = ["one two three four five six", "a  b\tc d e f", "x", "", None, "日本語テキスト", "tone two three four fives"]
    needles = ["one two three four five", "e two three four fi", "b\tc d e f", "b", "", "本語", "nope", None, "four five", " two three four "]
    t = spark.createDataFrame(list(enumerate(texts)), "t long, text string")
    n = spark.createDataFrame(list(enumerate(needles)), "n long, needle string")
    got = sorted(map(tuple, grounding.containing(t, n, "t", "n").collect()))
    assert got == sorted((i, j) for i, a in enumerate(texts) for j, b in enumerate(needles) if a is not None and b is not None and b in a)


def test_stratified_sample_does_not_depend_on_order(spark):
    rows = [(f"d{k}", "abcd"[k % 4], "xyz"[k % 3]) for k in range(120)]
    a = corpus.stratified(spark.createDataFrame(rows, "doc_id string, doc_group string, tier string")).select("doc_id")
    b = corpus.stratified(spark.createDataFrame(rows[::-1], "doc_id string, doc_group string, tier string").repartition(3)).select("doc_id")
    assert a.count() == 90 and sorted(a.collect()) == sorted(b.collect())


@pytest.mark.parametrize(
    ("actions", "errors", "left"),
    [
        (["research", "hint", "term", "nope"], [None, None, None, "unknown_action"], 75),
        (["hint"] * 7, [None] * 6 + ["no_points"], 10),
        (["replay", "decision", "replay"], ["replay_locked", None, None], 100),
    ],
)
def test_points(spark, actions, errors, left):
    rows = spark.createDataFrame([(1, k, a) for k, a in enumerate(actions)], "session_id long, seq long, action string")
    got = sessions.points(rows).orderBy("seq").collect()
    assert [r.error for r in got] == errors and got[-1].points == left


def test_streamed_points_equal_the_batch(spark, tmp_path):
    from disclosa.streaming import sessions as streaming

    rows = spark.createDataFrame([(s, k, a) for s in (1, 2) for k, a in enumerate(["research", "replay", "decision", "replay", "oops"])], "session_id long, seq long, action string")
    rows.coalesce(1).write.parquet(str(tmp_path / "in"))
    streaming.run_once(streaming.points(spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in"))), str(tmp_path / "out"), str(tmp_path / "c"), one_batch=True)
    assert sorted(spark.read.parquet(str(tmp_path / "out")).collect()) == sorted(sessions.points(rows).collect())


def test_pack_mutations(spark):
    docs = spark.createDataFrame([("C", "D1", "자본 1,000 원")], "case_id string, document_id string, original_text string")
    make = lambda *r: spark.createDataFrame([("C", "E", *r)], "case_id string, evidence_id string, document_id string, text string, source_text string")
    problem = lambda *r: grounding.grounding(make(*r), docs).first().problem
    assert [problem("D1", "1000", "자본 1,000"), problem("D2", "1", "x"), problem("D1", "1", "없음"), problem("D1", "2000", "자본 1,000")] == [None, "ref", "grounding", "numbers"]


def test_every_twentieth_vector_is_a_query(spark, sf_dir, monkeypatch):
    import numpy as np

    from disclosa.operators import planned
    from disclosa.plans import catalog

    monkeypatch.setattr(planned, "QUERIES", 4)
    monkeypatch.setattr(planned, "VECTORS", 64)  # many blocks
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()
    v = {r.vec_id: np.array(r.embedding, dtype=float) for r in rows}
    cos = lambda a, b: float(a @ b / np.sqrt(a @ a) / np.sqrt(b @ b))
    want = {q: sorted((-round(cos(v[q], x), 9), k) for k, x in v.items())[:10] for q in v if q % 20 == 0}
    got = catalog.queries()["cosine_topk"](spark, sf_dir).collect()
    assert len(want) > 5 and {(r.query_id, r["rank"]): r.vec_id for r in got} == {(q, n): k for q, top in want.items() for n, (_, k) in enumerate(top, 1)}


def test_vectors_without_a_cosine_are_left_out(spark):
    from disclosa.operators import planned

    vectors = spark.createDataFrame([(1, [1.0, 0.0]), (2, [1.0, 1.0]), (3, [0.0, 0.0]), (4, None), (5, [1.0, None]), (6, [1.0]), (7, [float("nan"), 1.0])], "vec_id long, embedding array<double>")
    got = planned.nearest(vectors, vectors.withColumnRenamed("vec_id", "query_id"), 5).collect()
    assert sorted((r.query_id, r["rank"], r.vec_id) for r in got) == [(1, 1, 1), (1, 2, 2), (2, 1, 2), (2, 2, 1), (6, 1, 6)]


def test_a_corpus_run_writes_documents_audits_failures_and_summary(spark, tmp_path):
    from disclosa.plans.documents import sample_corpus

    parsed, manifest = sample_corpus(spark)
    got = assembly.run_corpus(parsed, manifest, str(tmp_path)).first()
    failed = spark.read.json(f"{tmp_path}/failures").count() if got.n_failed else 0
    assert got.n_documents + got.n_failed == 4 and failed == got.n_failed
    assert sum(r.n for r in got.tiers) == got.n_documents and {r.code for r in got.warning_codes} >= {"sanitized_entity"}
    held = {r.doc_id: r for r in spark.read.schema(assembly.schemas.DOCUMENT).json(f"{tmp_path}/documents").collect()}
    assert held["D1"].doc_group == "periodic" and [n.order_index for n in held["D1"].nodes] == list(range(len(held["D1"].nodes)))
    section, table = next(n for n in held["D1"].nodes if n.kind == "section"), next(n for n in held["D1"].nodes if n.kind == "table")
    assert section.title_text == "I. 개요" and section.text is None and table.normalized_rows and table.text is None
    assert held["D3"].source_files[0].content_format == "kind_html"


def test_chunk_text_windows_and_sheet(spark):
    one = spark.createDataFrame([("  T ", [["a ", " b"], ["c", ""]], [str(k) for k in range(10)])], "t string, r array<array<string>>, w array<string>")
    assert one.select(assembly.chunk_text(F.col("t"), F.col("r"))).first()[0] == "T\na | b\nc | "
    assert one.select(assembly.token_windows(F.col("w"), 4, 1)).first()[0] == [["0", "1", "2", "3"], ["3", "4", "5", "6"], ["6", "7", "8", "9"]]
    assert one.select(assembly.token_windows(F.array().cast("array<string>"))).first()[0] == []
    sheet = assembly.annotation_sheet(one.select("t"), ("label", "note"))
    assert sheet.columns == ["\ufefft", "label", "note"] and sheet.first()[1:] == ("", "")


def test_cases_show_only_what_is_visible_and_sound(spark):
    c = spark.createDataFrame([("C1", "2023-05-23", "x")], "case_id string, simulation_date string, intro string")
    d = spark.createDataFrame([("C1", "D1", "2023-05-23"), ("C1", "D2", "2023-05-24"), ("C1", "D0", "2023-05-23")], "case_id string, document_id string, document_date string")
    assert sorted(r.document_id for r in cases.visible(d, c).collect()) == ["D0", "D1"] and cases.latest(d, c).first().document_id == "D1"
    e = spark.createDataFrame([("C1", k, f"E{k}", "money", "a|b" if k else "x" * 95, "s\nt", "critical" if k == 1 else "minor") for k in range(5)], "case_id string, ordinal int, evidence_id string, category string, text string, source_text string, importance string")
    f = spark.createDataFrame([("C1", "2023-06-02", 0, "b", "D9"), ("C1", "2023-06-01", 1, "a", "D8")], "case_id string, date string, ordinal int, title string, source_document_id string")
    checks = cases.pack_checks(d, e, f, c)
    assert checks.first().broken == ["documents", "future document"]
    with pytest.raises(Exception, match="breaks"):
        cases.assert_sound(checks).collect()
    assert [x.title for x in cases.future_events(f).first().future_events] == ["a", "b"]
    lines = cases.evidence_map(e).first().markdown.split("\n")
    assert len(lines) == 7 and lines[2] == f"| E0 | money | {'x' * 90}… | s t |" and "a\\|b" in lines[3]
    assert cases.briefing(c.withColumn("future_events", F.lit(1))).columns == c.columns
    terms = spark.createDataFrame([("C1", "t1", ["E1", "E2"]), ("C1", "t2", ["E9"])], "case_id string, term string, source_evidence_ids array<string>")
    found = spark.createDataFrame([("S", "C1", ["E2"])], "session_id string, case_id string, evidence_ids array<string>")
    assert [tuple(r) for r in cases.unlocked(terms, found).collect()] == [("S", "t1", ["E2"])]
    q = spark.createDataFrame([("Q1", "C1", "Why this risk?"), ("Q2", "C1", "hello")], "question_id string, case_id string, question string")
    assert sorted((r.question_id, r.query) for r in cases.aspect_queries(q).collect())[:2] == [("Q1", "Why this risk?"), ("Q1", "Why this risk? risk 위험 리스크")]
    a = spark.createDataFrame([("C1", 1, "x")], "case_id string, n int, s string")
    assert [tuple(r) for r in cases.declared_differs(a, a.withColumn("n", F.lit(2)), "case_id").collect()] == [("C1", "n", "1", "2")]
    turns = spark.createDataFrame([("S", 1, "hint", True), ("S", 2, "hint", False)], "session_id string, seq int, action string, accepted boolean")
    assert tuple(cases.session_stats(turns).first()) == ("S", 2, 1, 1, 2, 1)
