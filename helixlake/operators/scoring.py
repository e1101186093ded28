"""Hits: filters, dimension joins, scores and ranks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .tables import cut

MIN_IDENTITY = 0.9
ENTITY = ("entry", "entity")


def identity_filter(hits: DataFrame, cutoff: float = MIN_IDENTITY) -> DataFrame:
    """Hits of at least this identity."""
    if not 0 <= cutoff <= 1:
        raise ValueError(f"identity cutoff {cutoff} is outside 0 to 1")
    return hits.where(F.col("identity") >= cutoff)


def adjusted_score() -> Column:
    """identity * coverage * (1 - mismatch / query_len) * 1000; 0 if a part is missing or the length is 0."""
    share = F.lit(1.0) - F.try_divide(F.col("mismatch").cast("double"), F.col("query_len").cast("double"))
    return F.coalesce(F.col("identity") * F.col("coverage") * share * 1000, F.lit(0.0))


def dataset_score() -> Column:
    """0 without an annotation score, 20 times it for reviewed accessions, else 10 times it less 50."""
    a = F.col("annotation_score").cast("double")
    return F.when(a.isNull(), F.lit(0.0)).when(F.col("provenance") == "Swiss-Prot", 20 * a).otherwise(10 * a - 50)


def provenance(review_type: Column) -> Column:
    return F.when(F.contains(review_type, F.lit("Swiss-Prot")), F.lit("Swiss-Prot")).otherwise(F.lit("TrEMBL"))


def total_score() -> Column:
    return F.coalesce("adjusted_score", F.lit(0.0)) + F.coalesce("tax_score", F.lit(0.0)) + F.coalesce("dataset_score", F.lit(0.0))


def tax_lineage(nodes: DataFrame, max_depth: int = 64) -> DataFrame:
    """(tax_id, ancestor, depth) of every node, itself at depth 0; a root is its own parent or has none.

    Jumps double: the ancestors within 2^k steps and the node 2^k steps up give those within 2^(k + 1), so a tree 60
    deep takes six rounds. A lineage deeper than ``max_depth``, such as one in a circle, is an error.
    """
    own = nodes.select("tax_id")
    unknown = nodes.select(F.col("parent").alias("tax_id")).where("tax_id IS NOT NULL").distinct().join(own, "tax_id", "left_anti")  # parents that are no nodes
    found = own.unionByName(unknown).select("tax_id", F.col("tax_id").alias("ancestor"), F.lit(0).alias("depth"))
    jump = cut(nodes.select("tax_id", F.col("parent").alias("to")).where("to IS NOT NULL AND to <> tax_id"))
    step = 1
    while not jump.isEmpty():
        if step > max_depth:
            raise ValueError(f"a lineage is deeper than {max_depth}")
        further = jump.join(found.select(F.col("tax_id").alias("to"), "ancestor", "depth"), "to").select("tax_id", "ancestor", (F.col("depth") + step).alias("depth"))
        found = cut(found.unionByName(further))
        jump = cut(jump.join(jump.select(F.col("tax_id").alias("to"), F.col("to").alias("further")), "to").select("tax_id", F.col("further").alias("to")))
        step *= 2
    if not found.where(F.col("depth") > max_depth).isEmpty():
        raise ValueError(f"a lineage is deeper than {max_depth}")
    return found.join(own.distinct(), "tax_id", "left_semi")


def tax_pairs(hits: DataFrame) -> DataFrame:
    """Distinct pairs of taxa, so that each is scored once."""
    return hits.select("query_tax_id", "target_tax_id").where("query_tax_id IS NOT NULL AND target_tax_id IS NOT NULL").distinct()


def tax_score(pairs: DataFrame, lineage: DataFrame) -> DataFrame:
    """Equal taxa 200; else by the depth, in the query's lineage, of the nearest shared ancestor: 100, 50, 25; else 0.

    Only the depths that score are joined, so a pair meets three ancestors at most.
    """
    query = lineage.where("depth <= 2").select(F.col("tax_id").alias("query_tax_id"), "ancestor", "depth")
    target = lineage.select(F.col("tax_id").alias("target_tax_id"), "ancestor")
    near = pairs.join(query, "query_tax_id").join(target, ["target_tax_id", "ancestor"]).groupBy("query_tax_id", "target_tax_id").agg(F.min("depth").alias("depth"))
    known = lineage.select("tax_id").distinct()
    both = pairs.join(known.select(F.col("tax_id").alias("query_tax_id")), "query_tax_id", "left_semi").where("query_tax_id = target_tax_id").select("query_tax_id", "target_tax_id", F.lit(True).alias("same"))
    joined = pairs.join(near, ["query_tax_id", "target_tax_id"], "left").join(both, ["query_tax_id", "target_tax_id"], "left")
    points = F.when(F.col("same"), 200.0).when(F.col("depth") == 0, 100.0).when(F.col("depth") == 1, 50.0).when(F.col("depth") == 2, 25.0).otherwise(0.0)
    return joined.select("query_tax_id", "target_tax_id", points.alias("tax_score"))


def accession_info(*sources: DataFrame) -> DataFrame:
    """One row for each accession: of earlier sources first, and of several rows the best annotated."""
    out = None
    for source in sources:
        own = source.groupBy("accession").agg(F.max_by("provenance", F.struct(F.coalesce("annotation_score", F.lit(float("-inf"))), "provenance")).alias("provenance"), F.max("annotation_score").alias("annotation_score"))
        out = own if out is None else with_new_metadata(out, own)
    return out


def with_new_metadata(info: DataFrame, more: DataFrame) -> DataFrame:
    """info and the rows of ``more`` whose accession it lacks; a null accession in either keeps no other row out."""
    return info.unionByName(more.join(info, "accession", "left_anti"))


def missing_accessions(hits: DataFrame, info: DataFrame) -> DataFrame:
    return hits.select("accession").distinct().join(info, "accession", "left_anti")


def xref_counts(xrefs: DataFrame) -> DataFrame:
    """(accession, pdb_xref) from a ';' list."""
    return xrefs.select("accession", F.array_size(F.split("pdb", ";")).cast("long").alias("pdb_cross_references"))


def with_tax_override(hits: DataFrame, override: DataFrame) -> DataFrame:
    """The override's tax id wins over the hit's; of several for an entity the largest."""
    own = override.groupBy("entry", "entity").agg(F.max("tax_id").alias("__tax"))
    return hits.join(own, list(ENTITY), "left").withColumn("query_tax_id", F.coalesce("__tax", "query_tax_id")).drop("__tax")


def score(hits: DataFrame, info: DataFrame, lineage: DataFrame, xrefs: DataFrame, cutoff: float = MIN_IDENTITY) -> DataFrame:
    """All scores of the hits that pass the filter; dimensions join on their own keys, made unique first, and Spark broadcasts small ones."""
    hits = identity_filter(hits, cutoff).withColumn("adjusted_score", adjusted_score())
    hits = hits.join(tax_score(tax_pairs(hits), lineage), ["query_tax_id", "target_tax_id"], "left")
    hits = hits.join(accession_info(info).withColumn("dataset_score", dataset_score()).select("accession", "dataset_score"), "accession", "left")
    counts = xrefs.groupBy("accession").agg(F.max("pdb_cross_references").alias("pdb_cross_references"))
    return hits.join(counts, "accession", "left").withColumn("total_score", total_score())


def ranked(hits: DataFrame) -> DataFrame:
    """hit_rank within (entry, entity); equal scores share a rank."""
    w = Window.partitionBy(*ENTITY).orderBy(F.desc_nulls_last("total_score"), F.desc_nulls_last("pdb_cross_references"))
    return hits.withColumn("hit_rank", F.dense_rank().over(w))


def curated_top(hits: DataFrame) -> DataFrame:
    """The one hit of each (entry, entity) that five keys put first."""
    keys = [F.desc_nulls_last(c) for c in ("total_score", "pdb_cross_references", "adjusted_score", "dataset_score")]
    w = Window.partitionBy(*ENTITY).orderBy(*keys, F.asc("accession"))
    return hits.withColumn("__n", F.row_number().over(w)).where("__n = 1").drop("__n")
