"""Sequence records in XML: one row for each entry, read in parallel by Spark's own XML source."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.accessions import accession_of
from ..operators.residues import splice
from ..operators.tables import written

_END = "struct<_position:int,_status:string>"
_TEXT = "array<struct<_VALUE:string,_evidence:string>>"
ENTRY = f"""_dataset string, _created date, _modified date, _version int, accession array<string>, name array<string>,
organism struct<dbReference:array<struct<_type:string,_id:string>>>,
keyword array<struct<_VALUE:string,_id:string>>,
comment array<struct<_type:string,text:{_TEXT},link:array<struct<_uri:string>>,subcellularLocation:array<struct<location:{_TEXT}>>,
  isoform:array<struct<id:array<string>,name:{_TEXT},sequence:struct<_type:string,_ref:string>>>>>,
evidence array<struct<_key:string,_category:string,_type:string,_attribute:string,_date:string>>,
feature array<struct<_type:string,_id:string,_description:string,_evidence:string,original:string,variation:array<string>,
  location:struct<begin:{_END},end:{_END},position:{_END}>>>,
dbReference array<struct<_type:string,_id:string>>,
sequence struct<_VALUE:string,_length:int,_mass:string,_checksum:string,_modified:string,_version:string>"""


def _range(feature: Column) -> tuple[Column, Column]:
    point = feature.location.position._position
    return F.coalesce(feature.location.begin._position, point), F.coalesce(feature.location.end._position, point)


def _list(c: Column | str) -> Column:
    """An array that is empty where there is none."""
    c = F.col(c) if isinstance(c, str) else c
    return F.coalesce(c, F.array())


def _comment(c: Column) -> Column:
    """What a comment says: its first text, its first link and the first place it names, each with its type and evidence."""
    none = F.lit(None).cast("string")
    said = lambda value, evidence: F.when(value.isNotNull(), F.struct(c._type.alias("type"), value.alias("text"), evidence.alias("evidence")))
    text, place = F.get(c.text, 0), F.get(F.get(c.subcellularLocation, 0).location, 0)
    return F.array_compact(F.array(said(text._VALUE, text._evidence), said(F.get(c.link, 0)._uri, none), said(place._VALUE, place._evidence)))


def _isoforms(comments: Column) -> Column:
    """The isoforms of the alternative products, each under its first id, with the ids of the variants that make it."""
    products = F.flatten(F.transform(F.filter(comments, lambda c: c._type == "alternative products"), lambda c: _list(c.isoform)))
    refs = lambda i: F.filter(F.split(F.coalesce(i.sequence._ref, F.lit("")), r"\s+"), lambda x: x != "")
    made = lambda i: F.struct(F.get(i.id, 0).alias("isoform"), F.transform(_list(i["name"]), lambda n: n._VALUE).alias("names"), i.sequence._type.alias("kind"), refs(i).alias("variants"))
    return F.filter(F.transform(products, made), lambda i: i.isoform.isNotNull())


def _entries(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The entries of all files; files are split, and need not be one document each."""
    return spark.read.schema(schema).option("rowTag", "entry").option("columnNameOfCorruptRecord", "__corrupt").option("useLegacyXMLParser", True).xml(path)


def corrupt_records(spark: SparkSession, path: str) -> DataFrame:
    """(record): the text of each entry that does not fit the schema; such an entry is a row here and may lack columns elsewhere."""
    t = _entries(spark, path, f"{ENTRY}, __corrupt string")
    whole = F.xxhash64(*[c for c in t.columns if c != "__corrupt"])  # a column that is not read cannot be found corrupt
    return written(t.select(F.col("__corrupt").alias("record"), whole.alias("entry")), "entries").where("record IS NOT NULL").select("record")


def isoform_sequences(records: DataFrame) -> DataFrame:
    """(accession, isoform, sequence): each record's own sequence under its accession, and its isoforms with their variants put in.

    Isoforms that belong to another accession are left out. A variant without an original is a deletion; of several
    with one id the first counts; those without a place are passed over.
    """
    variants = F.filter("features", lambda f: (f.type == "splice variant") & f.begin.isNotNull() & f.end.isNotNull())
    change = lambda f: F.struct(f.begin.alias("begin"), f.end.alias("end"), F.when(f.original.isNull(), F.lit("")).otherwise(F.coalesce(f.variation, F.lit(""))).alias("variation"))
    known = records.select("accession", "sequence", _list(variants).alias("__v"), F.explode_outer("isoforms").alias("__i"))
    named = F.transform(_list("__i.variants"), lambda ref: F.get(F.filter("__v", lambda f: f.id == ref), 0))
    changes = F.transform(F.filter(named, lambda f: f.isNotNull()), change)
    own = known.where(accession_of(F.col("__i.isoform")) == F.col("accession")).select("accession", F.col("__i.isoform").alias("isoform"), splice(F.col("sequence"), changes).alias("sequence"))
    return records.select("accession", F.col("accession").alias("isoform"), "sequence").unionByName(own)


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """accession, its secondary ones, sequence with its attributes, taxonomy ids, keywords, features, references, comments,
    isoforms, evidences and the range of the signal peptide.

    Keywords are in capitals, null where there are none; an entry without a sequence or accession is left out.
    """
    t = _entries(spark, path, ENTRY).where("sequence._VALUE IS NOT NULL AND size(accession) > 0")
    comments = _list("comment")
    signal = F.get(F.filter(_list("feature"), lambda f: f._type == "signal peptide"), 0)
    known = lambda end, at: F.when(~end._status.eqNullSafe("unknown"), at)  # noqa: E731  null where the file says unknown
    begin_end = lambda f: [c.alias(n) for c, n in zip(_range(f), ("begin", "end"), strict=True)]
    return t.select(
        F.element_at("accession", 1).alias("accession"),
        F.slice("accession", F.lit(2), F.size("accession")).alias("secondary_accessions"),
        F.element_at("name", 1).alias("name"),
        F.regexp_replace("sequence._VALUE", r"\s", "").alias("sequence"),
        F.col("sequence._length").alias("seq_length"),
        F.col("sequence._mass").alias("seq_mass"),
        F.col("sequence._checksum").alias("seq_checksum"),
        F.col("sequence._version").alias("seq_version"),
        F.col("sequence._modified").alias("seq_modified"),
        F.col("_dataset").alias("dataset"),
        F.col("_created").alias("created"),
        F.col("_modified").alias("modified"),
        F.transform(F.filter("organism.dbReference", lambda r: r._type == "NCBI Taxonomy"), lambda r: r._id.try_cast("int")).alias("tax_ids"),
        F.transform("keyword", lambda k: F.upper(k._VALUE)).alias("keywords"),
        F.transform(
            "feature",
            lambda f: F.struct(f._type.alias("type"), f._id.alias("id"), f._description.alias("description"), f._evidence.alias("evidence"), f.original.alias("original"), F.element_at(f.variation, 1).alias("variation"), *begin_end(f)),
        ).alias("features"),
        F.transform("dbReference", lambda r: F.struct(r._type.alias("database"), r._id.alias("id"))).alias("references"),
        F.flatten(F.transform(comments, _comment)).alias("comments"),
        _isoforms(comments).alias("isoforms"),
        F.transform(_list("evidence"), lambda e: F.struct(e._key.alias("key"), e._category.alias("category"), e._type.alias("type"), e._attribute.alias("attribute"), e._date.alias("date"))).alias("evidences"),
        F.when(signal.isNotNull(), F.struct(known(signal.location.begin, _range(signal)[0]).alias("begin"), known(signal.location.end, _range(signal)[1]).alias("end"))).alias("signal"),
    )
