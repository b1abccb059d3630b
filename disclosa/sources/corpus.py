"""Readers and writers of the corpus: manifest, company list, raw files, documents, chunks, cases."""

from __future__ import annotations

import os
import unicodedata

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from disclosa.functions.text import derived_subtype
from disclosa.sources import schemas

#: Fixed value: formats that are read from XML files.
SUPPORTED = ("xml",)
#: Groups whose files are XML by contract.
XML_GROUPS = ("periodic", "major", "holding")
#: The columns of the metadata export.
EXPORT = ("doc_id", "corp_code", "corp_name", "stock_code", "industry", "sector", "doc_group", "doc_subtype", "derived_subtype", "report_nm", "rcept_no", "rcept_dt", "is_correction")


def corpus_root(spark: SparkSession, default: str | None = None) -> str:
    """The folder named by the session's disclosa.corpus.root, or by the environment's CORPUS_ROOT."""
    root = spark.conf.get("disclosa.corpus.root", None) or os.environ.get("CORPUS_ROOT") or default
    if not root:
        raise ValueError("set disclosa.corpus.root or CORPUS_ROOT")
    return root


def with_derived(manifest: DataFrame) -> DataFrame:
    blank = lambda c: F.coalesce(c, F.lit(""))
    named = manifest.withColumns({c: blank(F.col(c)) for c in ("doc_subtype", "report_nm", "flr_nm")})
    return named.withColumn("derived_subtype", derived_subtype(F.col("report_nm"), F.col("doc_subtype")))


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """One row a line; blank lines are skipped, broken ones end the read; unsupported formats are kept."""
    return with_derived(spark.read.schema(schemas.MANIFEST).json(path, mode="FAILFAST"))


def unsupported(manifest: DataFrame) -> DataFrame:
    return manifest.where(~F.col("file_format").isin(*SUPPORTED))


def read_universe(spark: SparkSession, path: str) -> DataFrame:
    """The company list; the byte order mark before the header goes with the header."""
    return spark.read.schema(schemas.UNIVERSE).csv(path, header=True, enforceSchema=True).withColumn("note", F.coalesce("note", F.lit("")))


def composed(path: Column) -> Column:
    """Unicode normal form C, which Spark has no function for; used on paths only, in Arrow batches."""

    def run(held: pd.Series) -> pd.Series:
        return held.map(lambda x: None if x is None else unicodedata.normalize("NFC", x))

    return F.pandas_udf(run, StringType())(path)


def read_files(spark: SparkSession, root: str, glob: str = "*") -> DataFrame:
    """path, folder and name (normal form C) and content of the files below root."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob).load(root)
    # Only a path that holds anything but ASCII needs the Python function.
    clean = F.regexp_replace(F.url_decode(F.replace("path", F.lit("+"), F.lit("%2B"))), "^file:/+", "/")
    norm = F.when(clean.rlike(r"[^\x00-\x7F]"), composed(clean)).otherwise(clean)
    return files.select(norm.alias("path"), F.regexp_extract(norm, r"([^/]+)$", 1).alias("rel_path"), F.regexp_replace(norm, "/[^/]+$", "").alias("folder"), "content")


def located(manifest: DataFrame, files: DataFrame, root: str) -> tuple[DataFrame, DataFrame]:
    """(manifest rows with their files, manifest rows whose folder has none): an equi-join on normalised paths."""
    want = F.concat(F.lit(root.rstrip("/") + "/"), F.regexp_replace("file_path", "^/+|/+$", ""))
    keyed = manifest.withColumn("folder", F.when(want.rlike(r"[^\x00-\x7F]"), composed(want)).otherwise(want))
    missing = keyed.join(files.select("folder").distinct(), "folder", "left_anti").drop("folder")
    return keyed.join(files, "folder").drop("folder"), missing


def is_xml(name: Column) -> Column:
    return F.lower(name).endswith(".xml")


def to_parse(found: DataFrame) -> DataFrame:
    """Input of the parser from located rows: XML files, and the viewer (with the PDF, kept as a hash) of PDF filings."""
    name, pdf = F.col("rel_path"), F.col("file_format") == "pdf+html"
    wanted = F.when(pdf, (name == F.concat("rcept_no", F.lit("_viewer.html"))) | (name == F.concat("rcept_no", F.lit(".pdf")))).otherwise(is_xml(name))
    expected = F.when(~pdf, F.when(F.col("doc_group").isin(*XML_GROUPS), "dart_xml").otherwise("kind_html"))
    return found.where(wanted).select("doc_id", "rel_path", "content", expected.alias("expected"))


def read_jsonl(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """A table of JSON lines: kind is a name of disclosa.sources.schemas."""
    return spark.read.schema(getattr(schemas, kind)).json(path)


def read_case_chunks(spark: SparkSession, path: str, case_id: str) -> DataFrame:
    """One case's chunks, pruned by the case_id folders; an error if there are none."""
    chunks = spark.read.schema(schemas.SEARCH_CHUNK).parquet(path).where(F.col("case_id") == case_id)
    if not chunks.limit(1).count():
        raise ValueError(f"no chunk of case {case_id} in {path}")
    return chunks


def read_cases(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.CASE).json(path, multiLine=True)


def pick(documents: DataFrame, wanted: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows of documents with the ids of wanted(doc_id, at) in its order, ids that are missing)."""
    found = documents.join(wanted, "doc_id").orderBy("at").drop("at")
    return found, wanted.join(documents.select("doc_id"), "doc_id", "left_anti")


def export_metadata(manifest: DataFrame) -> DataFrame:
    return manifest.select(*EXPORT)


def write_jsonl(df: DataFrame, path: str, by: str | None = None) -> None:
    """JSON lines with nulls written out, in folders by a column."""
    w = df.write.option("ignoreNullFields", "false")
    (w.partitionBy(by) if by else w).json(path)


def write_table(df: DataFrame, path: str, *by: str) -> None:
    (df.write.partitionBy(*by) if by else df.write).parquet(path)


def quarantine(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(parsed files, failed ones with their error)."""
    return parsed.where("error is null"), parsed.where("error is not null").select("doc_id", "rel_path", "error")
