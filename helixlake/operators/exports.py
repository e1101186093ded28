"""Published tables: numbered segments, residue and atom cross-references."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .residues import rounded
from .walks import covering


def number_segments(segments: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """segment_id grows behind ranges seen once, instance_id behind each copy of a range seen more often.

    Ranges go by their first appearance, the copies of a range one behind the other.
    """
    same = Window.partitionBy(*keys, "start", "end")
    seen = segments.withColumn("__n", F.count(F.lit(1)).over(same)).withColumn("__first", F.min(F.struct(*order)).over(same))
    w = Window.partitionBy(*keys).orderBy("__first", *order).rowsBetween(Window.unboundedPreceding, -1)
    before = {c: F.coalesce(F.sum(F.when(cond, 1).otherwise(0)).over(w), F.lit(0)) + 1 for c, cond in (("segment_id", F.col("__n") == 1), ("instance_id", F.col("__n") > 1))}
    return seen.select(*segments.columns, before["segment_id"].cast("long").alias("segment_id"), before["instance_id"].cast("long").alias("instance_id"))


def expand(segments: DataFrame, keys: list[str], carry: list[str]) -> DataFrame:
    """A row for each position of each segment. Where only the segments of given positions are asked for, see :func:`walks.covering`."""
    return segments.select(*keys, *carry, F.explode(F.sequence("start", "end")).alias("seq_id"))


def unambiguous(rows: DataFrame, keys: list[str], value: list[str]) -> DataFrame:
    """The value of each key if its rows agree on it, else null."""
    v = F.struct(*value)
    out = rows.groupBy(*keys).agg(F.count_distinct(v).alias("__n"), F.min(v).alias("__v"))
    return out.select(*keys, *[F.when(F.col("__n") == 1, F.col(f"__v.{c}")).alias(c) for c in value])


def atom_xrefs(atoms: DataFrame, residues: DataFrame, keys: list[str]) -> DataFrame:
    """Atoms with the cross-reference of their residue; the database name only where there is one."""
    one = unambiguous(residues, keys, ["letter", "accession", "number"])
    return atoms.join(one, keys, "left").withColumn("db_name", F.when(F.col("accession").isNotNull(), F.lit("UNP")))


def residue_xrefs(residues: DataFrame, numbered: DataFrame, observed: DataFrame, keys: list[str]) -> DataFrame:
    """Mapped residues with segment numbers (the last segment that holds them), observed flag and ordinal."""
    held = covering(residues.select(*keys, "accession", "seq_id").distinct(), numbered.select(*keys, "accession", "start", "end", "segment_id", "instance_id"), [*keys, "accession"], "seq_id", "start", "end")
    last = held.groupBy(*keys, "accession", "seq_id").agg(F.max(F.struct("segment_id", "instance_id")).alias("s"))
    joined = residues.join(last, [*keys, "accession", "seq_id"], "left").join(observed.select(*keys, "seq_id", "auth_seq_num"), [*keys, "seq_id"], "left")
    nth = F.row_number().over(Window.partitionBy(*keys, "seq_id").orderBy("accession"))
    return joined.select(*keys, "seq_id", "accession", "s.segment_id", "s.instance_id", F.when(F.col("auth_seq_num").isNull(), "n").otherwise("y").alias("observed"), nth.alias("ordinal"))


# The columns of the exports.
UNP_SEGMENTS = ["entity_id", "asym_id", "unp_acc", "segment_id", "instance_id", "unp_start", "unp_end", "seq_id_start", "seq_id_end", "best_mapping", "identity"]
#: A table that a caller may have; its rows are compared between releases, none are made here.
XREF_DB_SEGMENTS = "entry string, entity_id string, asym_id string, xref_db string, xref_db_acc string, domain_name string, segment_id long, instance_id long, seq_id_start long, seq_id_end long"
XREF_DB = ["entity_id", "asym_id", "seq_id_ordinal", "seq_id", "mon_id", "mon_id_one_letter_code", "unp_res", "unp_num", "unp_acc", "unp_segment_id", "unp_instance_id", "res_type", "observed", "mh_id"]
XREF_DB_EMPTY = ["xref_db_name", "xref_db_acc", "xref_domain_name", "xref_db_segment_id", "xref_db_instance_id"]
ATOMS = ["id", "pdbx_label_index", "xref_db_name", "xref_db_acc", "xref_db_num", "xref_db_res"]


def best_segments(segments: DataFrame) -> DataFrame:
    """Rows of the segment table that are mapped and best."""
    return segments.where("best_mapping AND accession IS NOT NULL")


def unp_segments(segments: DataFrame) -> DataFrame:
    """The exported segments of every entry: numbered by reference range, best as y or n, identity in three decimals.

    Rows come from the segment table; a blank has no accession and is no segment. They are numbered in the order
    of their ids and structure ranges.
    """
    rows = segments.where("accession IS NOT NULL").select(
        F.col("entry_id").alias("entry"), "entity_id", F.col("struct_asym_id").alias("asym_id"), F.col("accession").alias("unp_acc"), F.col("unp_start").alias("start"), F.col("unp_end").alias("end"),
        F.col("pdb_start").alias("seq_id_start"), F.col("pdb_end").alias("seq_id_end"), F.when(F.col("best_mapping"), "y").otherwise("n").alias("best_mapping"), rounded(F.col("identity"), 3).alias("identity"), "id",
    )
    numbered = number_segments(rows, ["entry", "entity_id", "asym_id", "unp_acc"], ["id", "seq_id_start", "seq_id_end"])
    return numbered.withColumnsRenamed({"start": "unp_start", "end": "unp_end"}).select("entry", *UNP_SEGMENTS)


def blank_to_null(c: str) -> Column:
    return F.nullif(F.trim(F.col(c).cast("string")), F.lit("")).alias(c)


def xref_db(residues: DataFrame, segments: DataFrame) -> DataFrame:
    """The 19 exported columns of every residue that the best mapping maps.

    residues: rows of the residue table; segments: :func:`unp_segments`. Of segments of an accession that share
    a residue the last one counts. The last five columns are for other databases and are null.
    """
    rows = residues.where("best_mapping AND accession IS NOT NULL").select(
        F.col("entry_id").alias("entry"), "entity_id", F.col("struct_asym_id").alias("asym_id"), F.col("pdb_seq_id").alias("seq_id"), F.col("chem_comp_id").alias("mon_id"), F.col("pdb_one_letter_code").alias("mon_id_one_letter_code"),
        F.col("unp_one_letter_code").alias("unp_res"), F.col("unp_seq_id").alias("unp_num"), F.col("accession").alias("unp_acc"), F.col("type").alias("res_type"), F.lower("observed").alias("observed"), "mh_id",
    )
    key = ["entry", "entity_id", "asym_id", "unp_acc"]
    spread = segments.select(*key, "segment_id", "instance_id", F.explode(F.sequence("seq_id_start", "seq_id_end")).alias("seq_id"))
    last = spread.groupBy(*key, "seq_id").agg(F.max(F.struct("segment_id", "instance_id")).alias("s"))
    nth = F.row_number().over(Window.partitionBy("entry", "entity_id", "asym_id", "seq_id").orderBy("unp_acc", "mh_id", "unp_num"))
    joined = rows.join(last, [*key, "seq_id"], "left").withColumn("seq_id_ordinal", nth).withColumn("unp_segment_id", F.col("s.segment_id")).withColumn("unp_instance_id", F.col("s.instance_id"))
    text = ("mon_id_one_letter_code", "unp_res", "unp_acc", "res_type")
    return joined.select("entry", *[blank_to_null(c) if c in text else F.col(c) for c in XREF_DB], *[F.lit(None).cast("string").alias(c) for c in XREF_DB_EMPTY])


def atom_site_xref(atoms: DataFrame, xrefs: DataFrame) -> DataFrame:
    """The six exported columns of every atom; id and label index alone where its residue has no single cross-reference.

    atoms (entry, entity_id, asym_id, seq_id, id, pdbx_label_index); xrefs: :func:`xref_db`.
    """
    key = ["entry", "entity_id", "asym_id", "seq_id"]
    rows = xrefs.select(*key, F.col("unp_res").alias("letter"), F.col("unp_acc").alias("accession"), F.col("unp_num").alias("number"))
    found = atom_xrefs(atoms, rows, key)
    return found.select("entry", "id", "pdbx_label_index", F.col("db_name").alias("xref_db_name"), F.col("accession").alias("xref_db_acc"), F.col("number").alias("xref_db_num"), F.col("letter").alias("xref_db_res"))
