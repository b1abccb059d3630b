"""Documents assembled from their nodes, warnings and files; a corpus run with its sinks; chunk sets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from disclosa.functions.text import let, strip
from disclosa.operators import corpus, documents
from disclosa.sources import corpus as sources
from disclosa.sources import schemas

SOURCE = ("rel_path", "is_attachment", "content_format", "schema_version", "content_sha256", "declared_encoding", "actual_encoding_used")
NODE = (
    "node_id", "kind", "rel_path", "order_index", "title_text", "level", "level_confident", "section_hierarchy", "parent_section_id", "end_order_index", "text", "is_footnote_like",
    "raw_rows", "normalized_rows", "header_row_indices", "n_declared_cols", "actual_col_counts", "title_guess", "unit_text", "period_text", "consolidation_basis", "consolidation_reason",
)
QUALITY = ("tier", "schema_version", "n_sanitized_entities", "n_unresolved_section_depth", "n_tables_with_merged_cells", "router_matched_expected_parser")


def document_irs(files: DataFrame, node_rows: DataFrame, warning_rows: DataFrame, quality_rows: DataFrame) -> DataFrame:
    """schemas.DOCUMENT rows: one a document, nodes by file and order, warnings by file and code.

    files has SOURCE columns, node_rows NODE columns. A document is one row, as its readers need it.
    """
    listed = lambda df, cols, order, name: df.groupBy("doc_id").agg(F.transform(F.array_sort(F.collect_list(F.struct(*order, F.struct(*cols).alias("x")))), lambda s: s["x"]).alias(name))
    held = quality_rows.select("doc_id", "doc_group", F.struct(*QUALITY).alias("parse_quality"))
    held = held.join(listed(files, SOURCE, ("rel_path",), "source_files"), "doc_id", "left").join(listed(node_rows, NODE, ("rel_path", "order_index"), "nodes"), "doc_id", "left")
    held = held.join(listed(warning_rows, ("doc_id", "rel_path", "code", "severity", "message"), ("rel_path", "code", "message"), "warnings"), "doc_id", "left")
    kinds = {f.name: f.dataType.simpleString() for f in held.sparkSession.createDataFrame([], schemas.DOCUMENT).schema}
    filled = {c: F.coalesce(F.col(c), F.array()) for c in ("source_files", "nodes", "warnings")}
    return held.withColumns(filled).select(*(F.col(c).cast(t).alias(c) for c, t in kinds.items()))


def shaped_nodes(node_rows: DataFrame) -> DataFrame:
    """documents.nodes() with the names and columns of a document's nodes."""
    section, table = F.col("kind") == "section", F.col("kind") == "table"
    none = F.lit(None).cast("string")
    return node_rows.withColumns(
        {
            "title_text": F.when(section, F.col("text")),
            "title_guess": F.when(table, F.col("caption")),
            "consolidation_basis": F.when(table, F.col("consolidation.basis")) if "basis" in _fields(node_rows) else none,
            "consolidation_reason": F.when(table, F.col("consolidation.reason")) if "reason" in _fields(node_rows) else none,
        }
    ).withColumn("text", F.when(F.col("kind") == "paragraph", F.col("text")))


def _fields(node_rows: DataFrame) -> list[str]:
    kind = node_rows.schema["consolidation"].dataType
    return kind.fieldNames() if hasattr(kind, "fieldNames") else []


def to_line(documents_: DataFrame) -> DataFrame:
    """doc_id, line: a document as JSON, keys in the schema's order, nulls written out."""
    return documents_.select("doc_id", F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("line"))


def from_line(lines: DataFrame) -> DataFrame:
    """The documents of lines(line)."""
    return lines.select(F.from_json("line", schemas.DOCUMENT, {"mode": "FAILFAST"}).alias("d")).select("d.*")


def with_metadata(documents_: DataFrame, manifest: DataFrame) -> DataFrame:
    """Documents with the exported columns of their manifest row."""
    return documents_.join(sources.export_metadata(manifest).drop("doc_group"), "doc_id")


def summary(audits: DataFrame, failures: DataFrame | None = None) -> DataFrame:
    """One row: documents, failures, tiers, documents by warning code, mean share of text kept (null: no document has one)."""
    total = audits.agg(F.count("*").alias("n_documents"), F.avg("text_preservation_ratio").alias("mean_text_ratio"), F.count("text_preservation_ratio").alias("n_with_ratio"))
    listed = lambda df, key, name: df.agg(F.array_sort(F.collect_list(F.struct(key, "n"))).alias(name))
    tiers = listed(corpus.histogram(audits, "tier"), "tier", "tiers")
    codes = listed(corpus.histogram(audits.select(F.explode("warning_codes").alias("code")), "code"), "code", "warning_codes")
    failed = (failures if failures is not None else audits.limit(0)).agg(F.count("*").alias("n_failed"))
    one = lambda df: df.withColumn("_one", F.lit(1))  # noqa: E731  # tables of one row each
    return one(total).join(one(failed), "_one").join(one(tiers), "_one").join(one(codes), "_one").drop("_one")


def run_corpus(parsed: DataFrame, manifest: DataFrame, out: str) -> DataFrame:
    """Documents (in folders by doc_group), audits, failures and the summary of PARSED files, written below `out`; the summary."""
    good, failures = sources.quarantine(parsed)
    node_rows = documents.nodes(good)
    warning_rows = documents.warnings(good, node_rows)
    quality = documents.quality(good, warning_rows, manifest)
    audits = documents.audit(quality, node_rows)
    files = good.withColumn("is_attachment", F.lit(False))
    sources.write_jsonl(document_irs(files, shaped_nodes(node_rows), warning_rows, quality), f"{out}/documents", "doc_group")
    sources.write_jsonl(audits, f"{out}/audits")
    sources.write_jsonl(failures, f"{out}/failures")
    spark = parsed.sparkSession
    written = summary(spark.read.schema(audits.schema).json(f"{out}/audits"), spark.read.schema(failures.schema).json(f"{out}/failures"))
    sources.write_jsonl(written, f"{out}/summary")
    return spark.read.schema(written.schema).json(f"{out}/summary")


def chunk_text(title: Column, rows: Column) -> Column:
    """A table node as a chunk's text: its title, then a line for each row, stripped cells joined by bars."""
    lines = F.transform(rows, lambda r: F.array_join(F.transform(r, lambda c: strip(c)), " | "))
    return F.array_join(F.concat(F.when(strip(title) != "", F.array(strip(title))).otherwise(F.array().cast("array<string>")), lines), "\n")


def token_windows(tokens: Column, size: int = 512, over: int = 64) -> Column:
    """array<array>: windows of `size` tokens that share `over` with the one before; the last one ends with the tokens."""
    step = size - over

    def cut(t: Column) -> Column:
        last = F.greatest(F.lit(0), F.ceil((F.size(t) - size) / float(step)).cast("int")) * step
        return F.when(F.size(t) == 0, F.filter(F.array(t), lambda x: F.lit(False))).otherwise(F.transform(F.sequence(F.lit(0), last, F.lit(step)), lambda s: F.slice(t, s + 1, F.lit(size))))

    return let(tokens, cut)


def chunk_sets(texts: DataFrame, tokens: Column, strategy: str, size: int = 512, over: int = 64) -> DataFrame:
    """doc_id, chunk_id, strategy_name, index, text, token_count of texts(doc_id, ...): tokens joined by blanks."""
    parts = texts.select("doc_id", F.posexplode(token_windows(tokens, size, over)).alias("index", "t"))
    name = F.concat_ws("::", F.col("doc_id").cast("string"), F.lit(strategy), F.col("index").cast("string"))
    return parts.select("doc_id", name.alias("chunk_id"), F.lit(strategy).alias("strategy_name"), "index", F.array_join("t", " ").alias("text"), F.size("t").alias("token_count"))


def annotation_sheet(candidates: DataFrame, blanks: tuple[str, ...]) -> DataFrame:
    """Candidates as strings with empty columns to be filled in; the first name carries the byte order mark of the file."""
    columns = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c if k else "﻿" + c) for k, c in enumerate(candidates.columns)]
    return candidates.select(*columns, *(F.lit("").alias(b) for b in blanks))


def describe(audits: DataFrame, *by: str) -> DataFrame:
    """Least, mean and most nodes, tables and sections of a document."""
    sums = [f(c).alias(f"{n}_{c}") for c in ("n_nodes", "n_tables", "n_sections") for n, f in (("min", F.min), ("avg", F.avg), ("max", F.max))]
    return audits.groupBy(*by).agg(F.count("*").alias("n_documents"), *sums)
