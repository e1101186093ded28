"""Readers: hits, dimension tables, sequences and segment files; schemas are given, never inferred."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MMSEQS = "query string, target string, alnlen int, mismatch int, qstart int, qend int, tstart int, tend int, evalue double, bits double, qaln string, taln string, qlen int, taxid int, qheader string, fident double, qcov double"
BLASTP = "qseqid string, sseqid string, length int, mismatch int, qstart int, qend int, sstart int, send int, evalue double, bitscore double, qseq string, sseq string, qlen int, staxid int, pident double, qcovs double"


def _tsv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).option("sep", "\t").csv(path)


def _part(c: str | Column, sep: str, n: int) -> Column:
    return F.split_part(F.col(c) if isinstance(c, str) else c, F.lit(sep), F.lit(n))


def read_hits(spark: SparkSession, path: str, format: str = "mmseqs") -> DataFrame:
    """Hits of either search tool in one shape; an empty file gives no rows."""
    if format == "mmseqs":
        t = _tsv(spark, path, MMSEQS)
        return t.select(
            F.lower(_part("query", "-", 1)).alias("entry"), _part("query", "-", 2).alias("entity"), F.col("target").alias("accession"), F.col("alnlen").alias("alignment_len"), "mismatch",
            F.col("qstart").alias("query_start"), F.col("qend").alias("query_end"), F.col("tstart").alias("target_start"), F.col("tend").alias("target_end"), "evalue", F.col("bits").alias("bit_score"),
            F.col("qaln").alias("query_aligned"), F.col("taln").alias("target_aligned"), F.col("qlen").alias("query_len"), _part("qheader", "=", -1).try_cast("int").alias("query_tax_id"),
            F.col("taxid").alias("target_tax_id"), F.col("fident").alias("identity"), F.col("qcov").alias("coverage"),
        )
    if format == "blastp":
        t, key = _tsv(spark, path, BLASTP), _part("qseqid", "|", 2)
        return t.select(
            F.lower(_part(key, "-", 1)).alias("entry"), _part(key, "-", 2).cast("int").cast("string").alias("entity"), _part("sseqid", "|", 2).alias("accession"), F.col("length").alias("alignment_len"), "mismatch",
            F.col("qstart").alias("query_start"), F.col("qend").alias("query_end"), F.col("sstart").alias("target_start"), F.col("send").alias("target_end"), "evalue", F.col("bitscore").alias("bit_score"),
            F.col("qseq").alias("query_aligned"), F.col("sseq").alias("target_aligned"), F.col("qlen").alias("query_len"), _part("qseqid", "=", 2).try_cast("int").alias("query_tax_id"),
            F.col("staxid").alias("target_tax_id"), (F.col("pident") / 100.0).alias("identity"), (F.col("qcovs") / 100.0).alias("coverage"),
        )
    raise ValueError(f"unknown format {format}")


def read_accession_metadata(spark: SparkSession, path: str) -> DataFrame:
    t = spark.read.option("header", True).csv(path)
    return t.select("accession", "provenance", F.col("annotation_score").cast("double").alias("annotation_score"))


def read_xref_counts(spark: SparkSession, path: str) -> DataFrame:
    t = spark.read.option("header", True).option("comment", "#").option("sep", "\t").csv(path)
    return t.select(F.col("SP_PRIMARY").alias("accession"), F.array_size(F.split("PDB", ";")).cast("long").alias("pdb_cross_references"))


def read_tax_override(spark: SparkSession, path: str) -> DataFrame:
    return _tsv(spark, path, "entry string, entity string, tax_id int")


def read_entity_tax_override(spark: SparkSession, path: str, entry: str | None = None) -> DataFrame:
    """(entry, entity, tax_id) for segments; a file of two columns holds the entities of the one entry named."""
    if entry is None:
        return _tsv(spark, path, "entry string, entity string, tax_id int")
    return _tsv(spark, path, "entity string, tax_id int").select(F.lit(entry.lower()).alias("entry"), "entity", "tax_id")


def read_tax_mapping(spark: SparkSession, path: str) -> DataFrame:
    return _tsv(spark, path, "accession string, tax_id int")


def read_nodes(spark: SparkSession, path: str) -> DataFrame:
    return _tsv(spark, path, "tax_id int, parent int")


def read_fasta(spark: SparkSession, path: str) -> DataFrame:
    """(header, sequence): records split at '>' on a new line, wrapped lines joined."""
    t = spark.read.option("lineSep", "\n>").text(path).select(F.regexp_replace("value", "^>", "").alias("r")).where("trim(r) <> ''")
    return t.select(F.trim(F.split_part("r", F.lit("\n"), F.lit(1))).alias("header"), F.regexp_replace(F.expr("substring(r, instr(r || '\n', '\n') + 1)"), r"\s", "").alias("sequence"))


def query_header(header: Column) -> list[Column]:
    """entry, entity and tax_id of 'pdb|entry-entity|OX=tax'."""
    key = _part(header, "|", 2)
    return [_part(key, "-", 1).alias("entry"), _part(key, "-", 2).alias("entity"), _part(header, "=", 2).try_cast("int").alias("tax_id")]


def custom_header(header: Column) -> list[Column]:
    """entry, chain, accession and name of 'entry|chain|accession|name'; without an accession the chain stands for it, without a name it is empty."""
    chain = _part(header, "|", 2)
    return [F.lower(_part(header, "|", 1)).alias("entry"), chain.alias("chain"), F.coalesce(F.nullif(_part(header, "|", 3), F.lit("")), chain).alias("accession"), _part(header, "|", 4).alias("name")]


def chain_header(records: DataFrame, header: str = "header") -> DataFrame:
    """records with entity and chain, a row for each chain of 'entity|chain,chain'."""
    chains = F.split(_part(header, "|", 2), ",")
    return records.withColumn("entity", _part(header, "|", 1)).withColumn("chain", F.explode(chains)).withColumn("chain", F.trim("chain"))


def read_segment_files(spark: SparkSession, folder: str, schema: str, suffix: str = "seg", recursive: bool = False) -> DataFrame:
    """Positional gzip CSV files of a folder, without those of the reduced mode."""
    t = spark.read.schema(schema).option("quote", "|").option("pathGlobFilter", f"*_{suffix}.csv.gz").option("recursiveFileLookup", recursive).csv(folder)
    return t.where(~F.col("_metadata.file_name").contains("_nf90_"))


def entry_of_path(path: Column) -> Column:
    return F.regexp_replace(F.regexp_extract(path, r"([^/]+)$", 1), r"(?i)(\.cif\.gz|\.cif|\.fasta|\.fa|\.faa|\.txt)$", "")
