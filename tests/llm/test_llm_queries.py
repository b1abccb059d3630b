"""Each query with SQL gives the SQL's rows; the pipeline runs stage by stage."""

import duckdb  # noqa: F401
import pytest
from oracle import compare, connect

import corpus_pipeline
from disclosa.llm import pii, queries, simhash, toxicity


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_sql(spark, sf_dir, con, name):
    assert compare(queries.QUERIES[name](spark, sf_dir), con, queries.ORACLES[name]) == ""


def test_every_operator_has_one_query():
    assert sorted(int(q.split("_")[0][2:]) for q in queries.QUERIES) == list(range(1, 11))


def test_pipeline_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, stage(spark, docs, sf_dir)
        kept[name] = (before, docs)
    cols = corpus_pipeline.COLUMNS
    assert all(out.columns == cols for name, (_, out) in kept.items() if name != "bpe")
    before, out = kept["toxicity"]
    model = toxicity.fit(before, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    good = {r.doc_id for r in toxicity.score_table(before, model).collect() if not r.flagged}
    assert sorted(r.doc_id for r in out.collect()) == sorted(good)
    before, out = kept["simhash_near_dedup"]
    assert sorted(r.doc_id for r in out.collect()) == sorted({r.component_id for r in simhash.near_duplicates(before).collect()})
    before, out = kept["pii"]
    assert out.count() == before.count() and out.where(f"text rlike '{pii.EMAIL}' and not text rlike '@[a-z]+[.]example'").count() == 0
    before, out = kept["source_mixing"]
    texts = {r.doc_id: r.text for r in before.collect()}
    assert all(texts[r.doc_id] == r.text for r in out.collect())
    before, out = kept["bpe"]
    assert sorted((r.doc_id, r.decoded) for r in out.collect()) == sorted((r.doc_id, r.text) for r in before.collect())


def test_stages_take_nulls_repeats_clashing_columns_and_nothing(spark, sf_dir):
    names = ["_row", "_text", "row", "e", "blob", "score", "slot", "copies", "fp", "_slot", "h", "key", "kinds"]
    base = "one two three four five six seven, mail jane@corp.org or call 415-555-2671"
    rows = [(1, base, "en", "a", 9), (1, base, "en", "a", 9), (None, base + " x", None, None, None), (None, None, None, None, None), (2, "", "en", "b", 0), (3, "w " * 20000, "xx", "b", 4)]
    docs = spark.createDataFrame([(*r, *range(len(names))) for r in rows], "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{n}` int" for n in names))
    for table, some in ((docs, True), (docs.limit(0), False)):
        for name, stage in corpus_pipeline.STAGES:
            got = stage(spark, table, sf_dir)
            assert got.columns == corpus_pipeline.COLUMNS or name == "bpe"
            assert (got.count() > 0) == some, name


def test_pipeline_equals_a_plain_one(spark, sf_dir):
    """The last stage's rows by brute force from the rows that the mix took, and every document's way through the first stages."""
    import public_tokenizers
    from tokenizers import Tokenizer

    ref = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, sf_dir)
    want = sorted((r.doc_id, tuple(e.ids)) for r, e in ((r, ref.encode(r.text, add_special_tokens=False)) for r in docs.collect()))
    assert sorted((r.doc_id, tuple(r.tokens)) for r in corpus_pipeline.run(spark, sf_dir).collect()) == want
