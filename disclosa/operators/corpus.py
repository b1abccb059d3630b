"""Gates, hashes, histograms and samples over the whole corpus."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Rows that the corpus is to have.
DOCUMENTS, COMPANIES = 4204, 70


def gate_report(manifest: DataFrame, universe: DataFrame, unresolved: DataFrame) -> DataFrame:
    """One row: counts, whether they are as expected, and the list of problems."""
    major = F.col("doc_group") == "major"
    m = manifest.agg(
        F.count("*").alias("n_manifest"),
        F.coalesce(F.bool_and(F.when(major, F.coalesce("doc_subtype", F.lit("")) == "")), F.lit(False)).alias("major_blank"),
        (F.coalesce(F.bool_and(F.length("corp_code") == 8), F.lit(False)) & F.coalesce(F.bool_or(F.col("corp_code").startswith("0")), F.lit(False))).alias("codes_ok"),
    )
    counts = m.select("*", F.lit(1).alias("_k")).join(universe.agg(F.count("*").alias("n_universe")).withColumn("_k", F.lit(1)), "_k").join(unresolved.agg(F.count("*").alias("n_unresolved")).withColumn("_k", F.lit(1)), "_k").drop("_k")
    problems = F.array_compact(
        F.array(
            F.when(F.col("n_manifest") != DOCUMENTS, "manifest rows"),
            F.when(F.col("n_universe") != COMPANIES, "universe rows"),
            F.when(F.col("n_unresolved") > 0, "unresolved paths"),
            F.when(~F.col("major_blank"), "major subtypes"),
            F.when(~F.col("codes_ok"), "leading zeros"),
        )
    )
    return counts.withColumn("problems", problems)


def histogram(df: DataFrame, *by: str) -> DataFrame:
    return df.groupBy(*by).agg(F.count("*").alias("n"))


def file_count_mismatches(manifest: DataFrame, files: DataFrame) -> DataFrame:
    """XML documents whose number of files is not the declared one."""
    counted = files.where(F.lower("rel_path").endswith(".xml")).groupBy("doc_id").agg(F.count("*").alias("n"))
    return manifest.where("file_format = 'xml'").join(counted, "doc_id", "left").where(F.coalesce("n", F.lit(0)) != F.col("n_files")).select("doc_id", "n_files", F.coalesce("n", F.lit(0)).alias("n_found"))


def schema_versions(manifest: DataFrame, files: DataFrame) -> DataFrame:
    """Histogram of the schema named in each XML document's main file: the one named like its receipt, else the first."""
    from disclosa.functions.text import schema_peek

    stem = F.regexp_replace("rel_path", r"\.[^.]*$", "")
    first = Window.partitionBy("doc_id").orderBy((stem == F.col("rcept_no")).desc(), "rel_path")
    kept = manifest.where("file_format = 'xml'").where(F.col("doc_group").isin("periodic", "major", "holding", "exchange"))
    xml = kept.join(files.where(F.lower("rel_path").endswith(".xml")), "doc_id").withColumn("nth", F.row_number().over(first)).where("nth = 1")
    return xml.groupBy(schema_peek(F.decode(F.substring("content", 1, 1600), "UTF-8")).alias("schema_version")).agg(F.count("*").alias("n"))


def sha(c: Column) -> Column:
    return F.sha2(c.cast("binary"), 256)


def canonical(row: Column) -> Column:
    """JSON of a struct whose fields are in alphabetical order, nulls written."""
    return F.to_json(row, {"ignoreNullFields": "false"})


def group_hashes(hashes: DataFrame) -> DataFrame:
    """doc_group (null: all), n, sha256 over the sorted [doc_id, hash] pairs of hashes(doc_id, doc_group, hash).

    The pairs of a group meet in one row, as the definition of the digest has it: 100 bytes a document.
    """
    pairs = F.array_sort(F.collect_list(F.struct("doc_id", "hash")))
    text = F.concat(F.lit("["), F.array_join(F.transform(pairs, lambda p: F.concat(F.lit('["'), p["doc_id"], F.lit('","'), p["hash"], F.lit('"]'))), ","), F.lit("]"))
    return hashes.groupingSets([["doc_group"], []], "doc_group").agg(F.count("*").alias("n"), sha(text).alias("sha256"))


def snapshot_id(manifest_sha: Column, universe_sha: Column) -> Column:
    return F.concat(F.lit("snap_"), F.substring(sha(F.concat_ws("|", manifest_sha, universe_sha)), 1, 16))


def allocation(strata: DataFrame, total: int) -> DataFrame:
    """strata(doc_group, tier, stratum_size) with quota: the rows to draw from each.

    A stratum gets its share rounded down, one at least. Rows that are still missing are single units handed out in
    rounds, larger remainders first within a round; where the minimum of one gave too many, the highest units go first.
    Windows without partitions: the table has a row for each stratum (group times tier), and total * strata units.
    """
    every = Window.partitionBy(F.lit(1))
    order = ["doc_group", "tier"]
    whole = F.sum("stratum_size").over(every)
    share = F.col("stratum_size") * total / whole
    first = strata.where("stratum_size > 0").withColumns({"share": share, "goal": F.least(whole, F.lit(total))})
    first = first.withColumn("base", F.greatest(F.lit(1), F.floor("share"))).withColumn("over", F.sum("base").over(every) - F.col("goal"))
    units = first.withColumn("unit", F.explode(F.expr("sequence(1, greatest(base, least(stratum_size, base - least(over, 0))))")))
    extra = units.where("unit > base").withColumn("nth", F.row_number().over(Window.orderBy(F.col("unit") - F.col("base"), F.desc(F.col("share") - F.floor("share")), *order)))
    spare = units.where("unit > 1 and unit <= base").withColumn("nth", F.row_number().over(Window.orderBy(F.desc("unit"), *order)))
    kept = units.where("unit = 1").withColumn("nth", F.lit(0)).unionByName(extra.where("nth <= -over")).unionByName(spare.where("nth > over"))
    return kept.groupBy("doc_group", "tier").agg(F.max("stratum_size").alias("stratum_size"), F.count("*").cast("int").alias("quota"))


def stratified(audits: DataFrame, total: int = 90, seed: int = 0) -> DataFrame:
    """Documents of audits(doc_id, doc_group, tier) to review: of every stratum as many as allocation() says.

    Members are drawn by a keyed hash, so they do not depend on order or partitions.
    """
    quota = allocation(histogram(audits, "doc_group", "tier").withColumnRenamed("n", "stratum_size"), total)
    drawn = Window.partitionBy("doc_group", "tier").orderBy(sha(F.concat(F.lit(f"{seed}:"), F.col("doc_id").cast("string"))), "doc_id")
    return audits.join(quota, ["doc_group", "tier"]).withColumn("nth", F.row_number().over(drawn)).where("nth <= quota").drop("nth")


def fixed_sample(df: DataFrame, by: str, n: int, seed: int = 0) -> DataFrame:
    drawn = Window.partitionBy(by).orderBy(sha(F.concat(F.lit(f"{seed}:"), F.col("doc_id").cast("string"))), "doc_id")
    return df.withColumn("nth", F.row_number().over(drawn)).where(F.col("nth") <= n).drop("nth")


def partial_causes(quality: DataFrame) -> DataFrame:
    """Why documents are partial: PDF filings, sanitised ones, others."""
    cause = F.when(F.col("file_format") == "pdf+html", "pdf+html").when(F.col("used_sanitizer"), "sanitized").otherwise("other")
    return quality.where("tier = 'partial'").groupBy(cause.alias("cause")).agg(F.count("*").alias("n"))


def structure_check(files: DataFrame, audits: DataFrame) -> DataFrame:
    """doc_id, whether section and table counts equal the TITLE and TABLE-GROUP tags of the source."""
    tag = lambda t: F.regexp_count(F.decode("content", "ISO-8859-1"), F.lit(rf"<{t}[\s>]"))
    raw = files.groupBy("doc_id").agg(F.sum(tag("TITLE")).alias("titles"), F.sum(tag("TABLE-GROUP")).alias("groups"))
    return audits.join(raw, "doc_id").select("doc_id", (F.col("n_sections") == F.col("titles")).alias("sections_ok"), (F.col("n_tables") == F.col("groups")).alias("tables_ok"))


def correction_links(manifest: DataFrame) -> DataFrame:
    """Corrections with the original they correct: same company and subtype, earlier; linked, ambiguous or unlinked."""
    first = manifest.where("not is_correction").select("corp_code", "derived_subtype", F.col("doc_id").alias("original"), F.col("rcept_dt").alias("day"))
    both = manifest.where("is_correction").join(first, ["corp_code", "derived_subtype"], "left").withColumn("hit", F.col("day") < F.col("rcept_dt"))
    n = F.count_if(F.coalesce("hit", F.lit(False)))
    return both.groupBy("doc_id").agg(n.alias("n_candidates"), F.max_by("original", F.when(F.col("hit"), F.col("day"))).alias("latest"), F.when(n == 1, "linked").when(n == 0, "unlinked").otherwise("ambiguous").alias("status"))


def alias_index(universe: DataFrame) -> DataFrame:
    """alias, corp_code, ambiguous: the names and codes a company goes by."""
    names = universe.select("corp_code", F.explode(F.array_distinct(F.array_compact(F.array("corp_code", "stock_code", "corp_name", "listed_name", "corp_eng_name")))).alias("alias"))
    return names.groupBy("alias").agg(F.min("corp_code").alias("corp_code"), (F.count_distinct("corp_code") > 1).alias("ambiguous"))
