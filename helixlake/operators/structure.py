"""Atoms: bonds between neighbours, and how far chains run on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BOND = 1.42
NOT_LINKED = ("Insertion", "Linker", "Chromophore", "See remark 999")


def distance(x1: Column, y1: Column, z1: Column, x2: Column, y2: Column, z2: Column) -> Column:
    """Two decimals, cut off."""
    square = (x1 - x2) * (x1 - x2) + (y1 - y2) * (y1 - y2) + (z1 - z2) * (z1 - z2)
    return F.floor(F.sqrt(square) * 100) / 100


def bond_table(atoms: DataFrame, keys: list[str], order: str, limit: float = BOND) -> DataFrame:
    """Each residue with its next one, their distance and whether it is a bond; atoms that lack make none."""
    w = Window.partitionBy(*keys).orderBy(order)
    nxt = atoms.withColumn("next", F.lead(F.struct(F.col(order).alias("o"), "x", "y", "z")).over(w)).where("next IS NOT NULL")
    d = distance(F.col("x"), F.col("y"), F.col("z"), F.col("next.x"), F.col("next.y"), F.col("next.z"))
    return nxt.select(*keys, order, F.col("next.o").alias("next_order"), d.alias("distance"), F.coalesce(d <= limit, F.lit(False)).alias("bonded"))


def valid_residue() -> Column:
    return F.col("observed") & F.col("ins_code").isNull() & ~F.coalesce(F.col("rtype").isin(*NOT_LINKED), F.lit(False))


def atom_ordinals(atoms: DataFrame, keys: list[str], order: str) -> DataFrame:
    return atoms.withColumn("ordinal", F.row_number().over(Window.partitionBy(*keys).orderBy(order)))


def look_ahead(bonds: DataFrame, keys: list[str], order: str, steps: int = 10) -> DataFrame:
    """For each residue the first broken bond among the next ``steps``."""
    w = Window.partitionBy(*keys).orderBy(order).rowsBetween(0, steps - 1)
    return bonds.withColumn("first_break", F.min(F.when(~F.col("bonded"), F.col(order))).over(w))


def atoms_of(atoms: DataFrame, groups: tuple[str, ...] = ("ATOM",), model: int = 1) -> DataFrame:
    """Atoms of these groups of records, of one model."""
    return atoms.where(F.col("group").isin(*groups) & (F.col("model") == model))


RESIDUE = ["entry", "asym", "seq_id"]


def backbone(residues: DataFrame, atoms: DataFrame, terminals: DataFrame) -> DataFrame:
    """residues (entry, asym, seq_id, observed, ins_code, rtype) with n and c, the places of their terminal atoms, and valid.

    An atom is terminal by its name and by its place in the residue, in file order (row_no), as the component's
    table of terminal atoms (comp_id, n_atom, n_ord, c_atom, c_ord) has it. An atom that isn't there is null.
    """
    placed = atom_ordinals(atoms, RESIDUE, "row_no").withColumn("xyz", F.struct("x", "y", "z")).join(terminals, "comp_id")
    own = lambda e: F.max(F.when((F.col("atom_id") == F.col(f"{e}_atom")) & (F.col("ordinal") == F.col(f"{e}_ord")), F.col("xyz"))).alias(e)
    found = placed.groupBy(*RESIDUE).agg(own("n"), own("c"))
    return residues.join(found, RESIDUE, "left").withColumn("valid", valid_residue())


def nearer(a: str, b: str) -> Column:
    """The shorter of the distances from N to C and from C to N of two residues, cut off at two decimals; null if one of the four atoms lacks."""
    d = lambda x, y: distance(*[F.col(f"{v}.{i}") for v in (x, y) for i in "xyz"])
    all_ = F.col(f"{a}_n").isNotNull() & F.col(f"{a}_c").isNotNull() & F.col(f"{b}_n").isNotNull() & F.col(f"{b}_c").isNotNull()
    return F.when(all_, F.least(d(f"{a}_n", f"{b}_c"), d(f"{a}_c", f"{b}_n")))


def terminal_bonds(spine: DataFrame, limit: float = BOND) -> DataFrame:
    """Each residue of a :func:`backbone` with the next one of its chain, their distance and whether they are bonded; residues that aren't valid have no bonds."""
    w = Window.partitionBy("entry", "asym").orderBy("seq_id")
    nxt = spine.withColumn("o", F.lead(F.struct("seq_id", "n", "c", "valid")).over(w)).where("o IS NOT NULL")
    pairs = nxt.select("entry", "asym", "seq_id", F.col("o.seq_id").alias("next_id"), F.col("n").alias("a_n"), F.col("c").alias("a_c"), F.col("o.n").alias("b_n"), F.col("o.c").alias("b_c"), (F.col("valid") & F.col("o.valid")).alias("valid"))
    d = F.when(F.col("valid"), nearer("a", "b"))
    return pairs.select("entry", "asym", "seq_id", "next_id", d.alias("distance"), F.coalesce(d <= limit, F.lit(False)).alias("bonded"))


def bonded_pairs(pairs: DataFrame, spine: DataFrame, limit: float = BOND) -> DataFrame:
    """pairs (entry, asym, seq_id, next_id) of any two residues of a chain, such as the ends of segments, with bonded.

    Both residues must be valid, and so must the one behind the first and the one before the second.
    """
    w = Window.partitionBy("entry", "asym").orderBy("seq_id")
    rows = spine.select("entry", "asym", "seq_id", "n", "c", "valid", F.coalesce(F.lead("valid").over(w), F.col("valid")).alias("after"), F.coalesce(F.lag("valid").over(w), F.col("valid")).alias("before"))
    a = rows.select("entry", "asym", "seq_id", F.col("n").alias("a_n"), F.col("c").alias("a_c"), (F.col("valid") & F.col("after")).alias("a_ok"))
    b = rows.select("entry", "asym", F.col("seq_id").alias("next_id"), F.col("n").alias("b_n"), F.col("c").alias("b_c"), (F.col("valid") & F.col("before")).alias("b_ok"))
    met = pairs.join(a, RESIDUE, "left").join(b, ["entry", "asym", "next_id"], "left")
    return met.select(*pairs.columns, F.coalesce(F.col("a_ok") & F.col("b_ok") & (nearer("a", "b") <= limit), F.lit(False)).alias("bonded"))
