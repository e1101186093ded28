"""Entities, chains and residues: lookups, precedence, pairing, and the ranges and mappings users give."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .walks import covering

# The twenty standard residues.
STANDARD = {
    "ALA": "A", "ARG": "R", "ASN": "N", "ASP": "D", "CYS": "C", "GLN": "Q", "GLU": "E", "GLY": "G", "HIS": "H", "ILE": "I",
    "LEU": "L", "LYS": "K", "MET": "M", "PHE": "F", "PRO": "P", "SER": "S", "THR": "T", "TRP": "W", "TYR": "Y", "VAL": "V",
}


def of_type(rows: DataFrame, entities: DataFrame, keys: list[str], word: str = "peptide") -> DataFrame:
    """Rows of the entities whose type holds the word; rows of unknown entities go."""
    return rows.join(entities.where(F.contains(F.lower("type"), F.lit(word))).select(*keys), keys, "left_semi")


def capitalised(c: Column) -> Column:
    """First letter upper, all others lower (not each word's first)."""
    return F.concat(F.upper(F.substring(c, F.lit(1), F.lit(1))), F.lower(F.substring(c, F.lit(2), F.length(c))))


def one_letter(component: Column, codes: dict[str, str] | None = None) -> Column:
    """Three letters to one in either case; unknown ones are X, null stays null."""
    known = F.create_map(*[F.lit(x) for pair in (codes or STANDARD).items() for x in pair])
    return F.when(component.isNotNull(), F.coalesce(F.try_element_at(known, F.upper(component)), F.lit("X")))


def missing_standard(codes: DataFrame) -> DataFrame:
    """Standard residues that a component table (three, one) lacks or names otherwise."""
    own = codes.sparkSession.createDataFrame(list(STANDARD.items()), "three string, one string")
    return own.join(codes.select("three", "one").distinct(), ["three", "one"], "left_anti")


def terminals(atoms: DataFrame) -> DataFrame:
    """Each component's terminal N and C with their ordinals; both are needed, the last row of either wins."""
    out = atoms.groupBy("comp_id").agg(
        *[F.max_by(F.struct("atom_id", "ordinal"), F.when((F.col(flag) == "Y") & (F.col("type_symbol") == e), F.col("row_no"))).alias(e.lower()) for e, flag in (("N", "n_terminal"), ("C", "c_terminal"))]
    )
    return out.where("n IS NOT NULL AND c IS NOT NULL").selectExpr("comp_id", "n.atom_id AS n_atom", "n.ordinal AS n_ord", "c.atom_id AS c_atom", "c.ordinal AS c_ord")


def taxonomy(*sources: Column) -> Column:
    """The first source whose comma list begins with a whole number."""
    return F.coalesce(*[F.trim(F.split_part(s, F.lit(","), F.lit(1))).try_cast("int") for s in sources])


def first_sequence(*sources: Column) -> Column:
    """The first source that isn't null or empty once white space is stripped."""
    return F.coalesce(*[F.nullif(F.regexp_replace(s, r"\s", ""), F.lit("")) for s in sources])


def ec_numbers(c: Column) -> Column:
    return F.filter(F.transform(F.split(c, ","), lambda x: F.trim(x)), lambda x: ~x.isin("?", ".", ""))


def fan_out(mapping: DataFrame, chains: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Entity mappings on every chain of the entity; entities without a chain; chains without a mapping."""
    return mapping.join(chains, keys), mapping.join(chains, keys, "left_anti"), chains.join(mapping, keys, "left_anti")


def preferred(candidates: DataFrame, keys: list[str], priority: str = "priority") -> DataFrame:
    """All rows of the source that comes first for each key."""
    return candidates.withColumn("__r", F.rank().over(Window.partitionBy(*keys).orderBy(priority))).where("__r = 1").drop("__r")


def chain_inventory(scheme: DataFrame) -> DataFrame:
    """The first (entity, asym) of each author chain."""
    return scheme.groupBy("entry", "chain").agg(F.min_by(F.struct("entity", "asym"), "row_no").alias("f")).select("entry", "chain", "f.entity", "f.asym")


def pair_chains(poly: DataFrame, asyms: DataFrame, keys: list[str]) -> DataFrame:
    """The k-th asym of an entity with the k-th name in its comma list of author chains."""
    names = poly.select(*keys, F.posexplode(F.split("strands", ",")).alias("k", "strand"))
    nth = asyms.withColumn("k", F.row_number().over(Window.partitionBy(*keys).orderBy("row_no")) - 1)
    return nth.join(names, [*keys, "k"]).select(*keys, "asym", F.trim("strand").alias("strand"))


def ordinals(rows: DataFrame, chain: list[str], residue: list[str], order: list[str]) -> DataFrame:
    """residue_ordinal numbers residues of a chain, mh_id the rows that share a residue."""
    nth = F.row_number().over(Window.partitionBy(*chain, *residue).orderBy(*order))
    return rows.withColumn("residue_ordinal", F.dense_rank().over(Window.partitionBy(*chain).orderBy(*residue))).withColumn("mh_id", nth)


def next_release(day: Column) -> Column:
    """The Wednesday on or after a day."""
    return F.next_day(F.date_sub(day, 1), "WED")


def ranges(c: Column) -> Column:
    """'a-b,c-d' as an array of (start, end)."""
    return F.transform(F.split(c, ","), lambda x: F.struct(F.trim(F.split_part(x, F.lit("-"), F.lit(1))).cast("int").alias("start"), F.trim(F.split_part(x, F.lit("-"), F.lit(2))).cast("int").alias("end")))


def user_mapping(rows: DataFrame, given: str) -> DataFrame:
    """A row for each 'chain:accession' of a comma list."""
    each = rows.withColumn("__m", F.explode(F.split(given, ",")))
    part = lambda n: F.trim(F.split_part("__m", F.lit(":"), F.lit(n)))
    return each.withColumn("chain", part(1)).withColumn("accession", part(2)).drop("__m", given)


def features_at(features: DataFrame, positions: DataFrame, keys: list[str]) -> DataFrame:
    """Features with the positions they cover, each a row: all columns of both."""
    return covering(positions, features, keys, "pos", "begin", "end")


def variant(sequence: Column, begin: Column, end: Column, variation: Column) -> Column:
    """The sequence with [begin, end] replaced."""
    return F.concat(F.substring(sequence, F.lit(1), begin - 1), variation, F.substring(sequence, end + 1, F.length(sequence)))


def best(rows: DataFrame, keys: list[str], order: list[Column], n: int | str = 1) -> DataFrame:
    """The first n rows of each key (n may be a column); the order should end in a key that settles ties."""
    return rows.withColumn("__r", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("__r") <= (F.col(n) if isinstance(n, str) else F.lit(n))).drop("__r")


def poly_seq_scheme(canonical: DataFrame, mapped: DataFrame, coordinates: DataFrame, keys: list[str]) -> DataFrame:
    """Every position of the canonical sequence with the coordinate residue aligned to it; '?' where none was seen.

    canonical (keys, sequence), mapped (keys, pdb_pos, unp_pos: the canonical place), coordinates (keys, pdb_pos, auth_seq_id).
    """
    every = canonical.select(*keys, F.posexplode(F.split("sequence", "")).alias("p", "letter")).where("letter <> ''").select(*keys, (F.col("p") + 1).cast("long").alias("seq_id"), "letter")
    seen = mapped.join(coordinates, [*keys, "pdb_pos"]).select(*keys, F.col("unp_pos").alias("seq_id"), F.col("auth_seq_id").cast("string").alias("auth"))
    return every.join(seen, [*keys, "seq_id"], "left").withColumn("auth", F.coalesce("auth", F.lit("?")))


SCHEME = ["asym_id", "entity_id", "seq_id", "mon_id", "ndb_seq_num", "pdb_seq_num", "auth_seq_num", "pdb_mon_id", "auth_mon_id", "pdb_strand_id", "pdb_ins_code", "hetero"]


def rebuilt_scheme(canonical: DataFrame, chains: DataFrame, mapped: DataFrame, coordinates: DataFrame) -> DataFrame:
    """The 12 columns of the residue scheme for every chain of every entry; what was not seen is '?'.

    canonical (entry, entity, seq_id, mon_id); chains (entry, entity, chain, asym); mapped (entry, chain, pdb_pos,
    unp_pos): the k-th coordinate residue against the canonical place; coordinates (entry, chain, pdb_pos,
    auth_seq_id, comp, ins_code, hetero).
    """
    every = canonical.join(chains, ["entry", "entity"])
    seen = mapped.join(coordinates, ["entry", "chain", "pdb_pos"]).select("entry", "chain", F.col("unp_pos").alias("seq_id"), F.col("auth_seq_id").cast("string").alias("auth"), "comp", "ins_code", "hetero")
    rows = every.join(seen, ["entry", "chain", "seq_id"], "left")
    auth, comp, n = F.coalesce("auth", F.lit("?")), F.coalesce("comp", "mon_id"), F.col("seq_id").cast("string")
    return rows.select("entry", F.coalesce("asym", F.lit("?")).alias("asym_id"), F.col("entity").alias("entity_id"), n.alias("seq_id"), "mon_id", n.alias("ndb_seq_num"), auth.alias("pdb_seq_num"), auth.alias("auth_seq_num"), comp.alias("pdb_mon_id"), comp.alias("auth_mon_id"), F.col("chain").alias("pdb_strand_id"), F.coalesce("ins_code", F.lit(".")).alias("pdb_ins_code"), F.coalesce("hetero", F.lit("n")).alias("hetero"))


def updated_scheme(canonical: DataFrame, chains: DataFrame, mapped: DataFrame, coordinates: DataFrame) -> DataFrame:
    """The other form of :func:`rebuilt_scheme`: the alignment of an entity's first chain (row_no) serves all its chains; what was not seen is '.'.

    mapped (entry, chain, pdb_pos, unp_pos) need hold the first chains alone.
    """
    first = chains.groupBy("entry", "entity").agg(F.min_by("chain", "row_no").alias("chain"))
    shared = mapped.join(first, ["entry", "chain"]).select("entry", "entity", "pdb_pos", F.col("unp_pos").alias("seq_id"))
    every = canonical.join(chains, ["entry", "entity"]).join(shared, ["entry", "entity", "seq_id"], "left")
    rows = every.join(coordinates.select("entry", "chain", "pdb_pos", F.col("auth_seq_id").cast("string").alias("auth")), ["entry", "chain", "pdb_pos"], "left")
    seen = lambda c: F.when(F.col("auth").isNotNull(), F.col(c)).otherwise(F.lit("."))
    n = F.col("seq_id").cast("string")
    return rows.select("entry", F.col("asym").alias("asym_id"), F.col("entity").alias("entity_id"), n.alias("seq_id"), "mon_id", n.alias("ndb_seq_num"), n.alias("pdb_seq_num"), seen("auth").alias("auth_seq_num"), seen("mon_id").alias("pdb_mon_id"), seen("mon_id").alias("auth_mon_id"), F.col("chain").alias("pdb_strand_id"), F.lit(".").alias("pdb_ins_code"), F.lit("n").alias("hetero"))


def relabelled_atoms(atoms: DataFrame, shared: DataFrame) -> DataFrame:
    """atoms (entry, asym, entity, auth_seq_id, comp_id, row_no, ...) with label_seq_id: the place of the residue's alignment partner, '.' without one.

    Residues of an asym are counted as the author's number or the component changes in file order; shared
    (entry, entity, pdb_pos, seq_id) maps that count.
    """
    w = Window.partitionBy("entry", "asym").orderBy("row_no")
    here = F.struct("auth_seq_id", "comp_id")
    new = F.when(here.eqNullSafe(F.lag(here).over(w)), 0).otherwise(1)
    rows = atoms.withColumn("__new", new).withColumn("pdb_pos", F.sum("__new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    found = rows.join(shared.withColumnRenamed("seq_id", "__seq"), ["entry", "entity", "pdb_pos"], "left")
    return found.select(*atoms.columns, F.coalesce(F.col("__seq").cast("string"), F.lit(".")).alias("label_seq_id"))


def modified_names(raw: Column) -> Column:
    """The names in brackets of a raw one-letter sequence with their places: an array of (name, seq_id)."""
    tokens = F.regexp_extract_all(F.regexp_replace(raw, r"\s", ""), F.lit(r"(\([A-Za-z0-9]+\)|[^()])"))
    named = F.transform(tokens, lambda x, i: F.struct(F.when(F.length(x) > 1, F.translate(x, "()", "")).alias("name"), (i + 1).cast("long").alias("seq_id")))
    return F.filter(named, lambda x: x["name"].isNotNull())
