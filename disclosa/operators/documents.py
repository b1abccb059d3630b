"""Parsed files to documents: node numbers, section tree, table grids, warnings, quality tiers, audit."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from disclosa.functions import grid, sections
from disclosa.functions.text import consolidation, is_footnote, let, period_text, squeeze, strip, title_level, unit_text


def nodes(parsed: DataFrame) -> DataFrame:
    """One row for each node of PARSED files: node_id, order_index within the file, kind and the kind's columns.

    The section tree is one fold over a file's titles; every node finds the section that holds it through the last
    title before it, a window over the file.
    """
    events = parsed.select("doc_id", "rel_path", F.explode("events").alias("e")).select("doc_id", "rel_path", "e.*")
    file = Window.partitionBy("doc_id", "rel_path")
    numbered = events.withColumn("order_index", F.row_number().over(file.orderBy("seq")) - 1).withColumns(
        {"total": F.count("*").over(file), "kind": F.when(F.col("kind") == "fallback", "paragraph").otherwise(F.col("kind")), "plain": F.col("kind") != "fallback", "text": F.when(F.col("kind") == "fallback", F.col("text")).otherwise(strip(F.col("text")))}
    )
    titles = F.array_sort(F.collect_list(F.when(F.col("kind") == "section", F.struct(F.col("order_index").alias("at"), F.col("text").alias("title"), title_level(F.col("text")).cast("int").alias("own")))))
    trees = numbered.groupBy("doc_id", "rel_path").agg(titles.alias("titles"), F.max("total").cast("int").alias("total"))
    tree = trees.select("doc_id", "rel_path", sections.fold(F.col("titles"), F.col("total")).alias("t"))
    ends = F.map_from_entries("t.ends")
    held = tree.select("doc_id", "rel_path", F.explode("t.sections").alias("s"), ends.alias("ends")).select(
        "doc_id", "rel_path", F.col("s.at").alias("last_title"), "s.level", "s.confident", "s.parent", "s.hierarchy", "s.title", F.element_at("ends", F.col("s.at")).alias("end_order_index")
    )
    at = F.last(F.when(F.col("kind") == "section", F.col("order_index")), ignorenulls=True).over(file.orderBy("order_index"))
    joined = numbered.withColumn("last_title", at).join(held, ["doc_id", "rel_path", "last_title"], "left")
    is_section = F.col("kind") == "section"
    above = F.coalesce(F.when(is_section, F.col("hierarchy")).otherwise(F.concat("hierarchy", F.array("title"))), F.array().cast("array<string>"))
    node_id = lambda at: F.concat_ws("::", "doc_id", "rel_path", F.concat(F.lit("n"), at))
    placed = joined.select(
        "doc_id", "rel_path", "order_index", "kind", "text", "caption", "cells", node_id(F.col("order_index")).alias("node_id"), above.alias("section_hierarchy"),
        F.when(is_section, F.col("level")).alias("level"), F.when(is_section, F.col("confident")).alias("level_confident"),
        F.when(is_section, F.when(F.col("parent").isNull(), "ROOT").otherwise(node_id(F.col("parent")))).alias("parent_section_id"),
        F.when(is_section, F.col("end_order_index")).alias("end_order_index"),
        F.when(F.col("kind") == "paragraph", is_footnote(F.col("text")) & F.col("plain")).alias("is_footnote_like"),
    )
    is_table = F.col("kind") == "table"
    shaped = placed.withColumn("raw_rows", F.when(is_table, grid.rows_of(F.col("cells"))))
    counted = shaped.withColumns(
        {"normalized_rows": F.when(is_table, grid.rectangle(F.col("raw_rows"))), "header_row_indices": F.when(is_table, grid.header_rows(F.col("raw_rows"))), "actual_col_counts": F.when(is_table, grid.widths(F.col("raw_rows")))}
    )
    basis = consolidation(F.col("section_hierarchy"))
    return counted.withColumns(
        {
            "n_declared_cols": grid.usual_width(F.col("actual_col_counts")),
            "has_merged": F.when(is_table, grid.has_merged(F.col("cells"))),
            "unit_text": F.when(is_table, unit_text(F.col("caption"))),
            "period_text": F.when(is_table, period_text(F.col("caption"))),
            "consolidation": F.when(is_table, basis),
        }
    )


def warnings(parsed: DataFrame, node_rows: DataFrame) -> DataFrame:
    """doc_id, rel_path, code, severity, message: those of the parser, of titles without a number, of tables."""
    own = parsed.select("doc_id", "rel_path", F.explode("notes").alias("n")).select("doc_id", "rel_path", "n.*")
    note = lambda code, cond, message: F.when(cond, F.struct(F.lit(code).alias("code"), F.lit("info").alias("severity"), message.alias("message")))
    table, name = F.col("kind") == "table", F.concat(F.lit("table "), F.col("node_id"))
    odd = grid.shape_note(F.col("actual_col_counts"))
    unsure = F.col("caption").isNull() | F.col("unit_text").isNull() | F.col("period_text").isNull()
    found = F.array(
        note("unknown_section_depth", ~F.col("level_confident"), F.concat(F.lit("section "), F.col("node_id"), F.lit(" has no known number; level "), F.col("level"))),
        note("table_merged_cell_ignored", F.col("has_merged"), F.concat(name, F.lit(" has merged cells, expanded into normalized_rows"))),
        note("table_shape_mismatch", table & odd.isNotNull(), F.concat(name, F.lit(": "), odd)),
        note("table_metadata_uncertain", table & unsure, F.concat(name, F.lit(": title, unit or period not found"))),
    )
    made = node_rows.select("doc_id", "rel_path", F.explode(F.filter(found, lambda x: x.isNotNull())).alias("n")).select("doc_id", "rel_path", "n.*")
    return own.unionByName(made)


def tier(any_failed, any_sanitized, is_pdf):  # noqa: ANN001, ANN201
    """partial for PDF filings; else fallback if a file failed, partial if one was sanitised, structured otherwise."""
    return F.when(is_pdf, "partial").when(any_failed, "fallback").when(any_sanitized, "partial").otherwise("structured")


def quality(parsed: DataFrame, warning_rows: DataFrame, manifest: DataFrame) -> DataFrame:
    """doc_id, doc_group and the parse quality of every document with a parsed file."""
    main = F.col("rel_path").startswith(F.col("rcept_no")) & (F.length("rel_path") == F.length("rcept_no") + 4)
    files = parsed.join(manifest.select("doc_id", "doc_group", "rcept_no", "file_format"), "doc_id").groupBy("doc_id", "doc_group").agg(
        (~F.bool_and("ok")).alias("failed"),
        F.bool_or(F.col("file_format") == "pdf+html").alias("pdf"),
        F.max(F.when(main & (F.col("content_format") == "dart_xml"), F.col("schema_version"))).alias("schema_version"),
        F.bool_or(F.col("actual_encoding_used").endswith("(replace)")).alias("used_encoding_recovery"),
        F.sum("raw_chars").alias("raw_chars"),
    )
    by = lambda code: F.count_if(F.col("code") == code)
    counts = warning_rows.groupBy("doc_id").agg(
        by("sanitized_entity").alias("n_sanitized_entities"),
        by("unknown_section_depth").alias("n_unresolved_section_depth"),
        by("table_merged_cell_ignored").alias("n_tables_with_merged_cells"),
        by("content_type_mismatch").alias("n_mismatched"),
        F.array_sort(F.collect_set("code")).alias("warning_codes"),
        F.bool_or(F.col("code").isin("parse_failed", "router_fallback_parser")).alias("warned_failed"),
    )
    zero = lambda c: F.coalesce(c, F.lit(0))
    return files.join(counts, "doc_id", "left").select(
        "doc_id", "doc_group", tier(F.col("failed"), zero("n_sanitized_entities") > 0, F.col("pdf")).alias("tier"), "schema_version",
        *(zero(c).alias(c) for c in ("n_sanitized_entities", "n_unresolved_section_depth", "n_tables_with_merged_cells")),
        (zero("n_mismatched") == 0).alias("router_matched_expected_parser"),
        F.coalesce("warning_codes", F.array().cast("array<string>")).alias("warning_codes"),
        (zero("n_sanitized_entities") > 0).alias("used_sanitizer"), F.coalesce("used_encoding_recovery", F.lit(False)).alias("used_encoding_recovery"),
        (F.col("failed") | F.coalesce("warned_failed", F.lit(False))).alias("used_fallback_parser"), "raw_chars",
    )


def audit(quality_rows: DataFrame, node_rows: DataFrame) -> DataFrame:
    """quality() with node counts and the share of the source's characters that the nodes keep, white space aside."""
    held = F.when(F.col("kind") == "table", F.aggregate(F.coalesce("cells", F.array().cast(f"array<{grid.CELL}>")), F.lit(0), lambda a, c: a + F.length(squeeze(c["text"])))).otherwise(F.length(squeeze(F.col("text"))))
    kinds = {k: F.count_if(F.col("kind") == k).alias(f"n_{k}s") for k in ("section", "table", "paragraph")}
    counts = node_rows.groupBy("doc_id").agg(F.count("*").alias("n_nodes"), *kinds.values(), F.sum(held).alias("node_chars"))
    ratio = F.coalesce("node_chars", F.lit(0)) / F.nullif(F.col("raw_chars"), F.lit(0))
    filled = {c: F.coalesce(c, F.lit(0)) for c in ("n_nodes", "n_sections", "n_tables", "n_paragraphs")}
    return quality_rows.join(counts, "doc_id", "left").withColumns(filled).withColumn("text_preservation_ratio", ratio).drop("node_chars", "raw_chars")


def lines(node_rows: DataFrame) -> DataFrame:
    """doc_id, rel_path, order_index, line_no, line: nodes as lines of text ('## ' before titles, a line a table row)."""
    from disclosa.functions.text import row_line

    shown = (
        F.when(F.col("kind") == "section", F.array(F.concat(F.lit("## "), F.nullif(strip(F.col("text")), F.lit("")))))
        .when(F.col("kind") == "paragraph", F.array(F.nullif(strip(F.col("text")), F.lit(""))))
        .otherwise(F.transform("normalized_rows", row_line))
    )
    kept = let(shown, lambda x: F.filter(x, lambda t: t.isNotNull()))
    return node_rows.select("doc_id", "rel_path", "order_index", F.posexplode(kept).alias("line_no", "line"))
