"""Alignments to position maps, contiguous segments and their complement."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def letters(text: str | Column) -> Column:
    """The letters of a string: going through them takes time in proportion to it, unlike substrings by place."""
    return F.filter(F.split(text, ""), lambda x: x != "")


def matches(a: Column, b: Column) -> Column:
    """Columns of two gapped strings that agree, up to the shorter's end."""
    agree = F.zip_with(letters(a), letters(b), lambda x, y: F.coalesce(x == y, F.lit(False)))
    return F.size(F.filter(agree, lambda x: x))


def rounded(x: Column, digits: int = 2) -> Column:
    """Half up on the binary value, so that it can be said in any SQL."""
    return F.floor(x * 10**digits + 0.5) / 10**digits


def identity(unp: Column, pdb: Column) -> Column:
    """Agreeing columns over the length of the gapped structure string, in two decimals."""
    return rounded(F.try_divide(matches(unp, pdb).cast("double"), F.length(pdb).cast("double")))


def conflicts(unp: Column, pdb: Column) -> Column:
    return F.least(F.length(unp), F.length(pdb)) - matches(unp, pdb)


def coverage(pdb: Column, canonical_length: Column) -> Column:
    """Letters of the structure over the canonical length, in two decimals; 0 without a canonical sequence."""
    return F.coalesce(rounded(F.try_divide(F.length(F.replace(pdb, F.lit("-"), F.lit(""))).cast("double"), canonical_length.cast("double"))), F.lit(0.0))


def _codes(text: str | None) -> np.ndarray:
    return np.frombuffer((text or "").encode("utf-32-le", "surrogatepass"), np.uint32)


def aligned_columns(alignments: DataFrame, key: str = "aln", mapped: bool = False) -> DataFrame:
    """One row for each column: letters and running positions on both sides (starts are 1 unless given).

    An alignment is one row before and is gone through in its own task, so nothing is shuffled; the counts are
    cumulative sums over its code points. With ``mapped`` only columns with a letter on both sides.
    """
    start = lambda c: F.coalesce(F.col(c), F.lit(1)).cast("long") if c in alignments.columns else F.lit(1).cast("long")
    cols = alignments.select(key, "unp_aln", "pdb_aln", start("unp_start").alias("unp_start"), start("pdb_start").alias("pdb_start"))
    kind = alignments.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sides = zip(*(batch.column(c).to_pylist() for c in range(1, 5)), strict=True)
            for k, (unp, pdb, u0, p0) in enumerate(sides):
                u, p = _codes(unp), _codes(pdb)
                n = min(len(u), len(p))
                u, p = u[:n], p[:n]
                at_u, at_p = np.cumsum(u != 45) + u0 - 1, np.cumsum(p != 45) + p0 - 1
                take = np.flatnonzero((u != 45) & (p != 45)) if mapped else np.arange(n)
                same = batch.column(0).take(pa.array(np.full(len(take), k)))
                if mapped:
                    yield pa.RecordBatch.from_arrays([same, pa.array(at_p[take]), pa.array(at_u[take])], [key, "pdb_pos", "unp_pos"])
                else:
                    yield pa.RecordBatch.from_arrays([same, pa.array(take + 1), pa.array(list(unp[:n])), pa.array(list(pdb[:n])), pa.array(at_u), pa.array(at_p)], [key, "i", "u", "p", "unp_pos", "pdb_pos"])

    places = "pdb_pos long, unp_pos long" if mapped else "i long, u string, p string, unp_pos long, pdb_pos long"
    return cols.where("unp_aln IS NOT NULL AND pdb_aln IS NOT NULL").mapInArrow(run, f"`{key}` {kind}, {places}")


def residue_map(alignments: DataFrame, key: str = "aln") -> DataFrame:
    """(key, pdb_pos, unp_pos) of columns with a letter on both sides."""
    return aligned_columns(alignments, key, mapped=True)


def without_excluded(mapped: DataFrame, residues: DataFrame, keys: list[str]) -> DataFrame:
    """Positions of a map without those of residues that never map (see :func:`excluded_types`)."""
    good = excluded_types(residues).select(*keys, F.col("seq_id").alias("pdb_pos"))
    return mapped.join(good, [*keys, "pdb_pos"], "left_semi")


def with_long_letters(mapped: DataFrame, residues: DataFrame, keys: list[str]) -> DataFrame:
    """A map whose columns count letters as one of residues: a residue of several letters has several columns.

    residues (keys, seq_id, letters). Position k of the structure's letters belongs to the residue that holds
    the k-th letter, so such a residue maps to several positions of the reference.
    """
    w = Window.partitionBy(*keys).orderBy("seq_id").rowsBetween(Window.unboundedPreceding, -1)
    own = residues.select(*keys, "seq_id", F.coalesce(F.sum(F.length("letters")).over(w), F.lit(0)).alias("before"), F.length("letters").alias("n")).where("n > 0")
    places = own.select(*keys, "seq_id", F.explode(F.sequence(F.col("before") + 1, F.col("before") + F.col("n"))).alias("pdb_pos"))
    return mapped.join(places, [*keys, "pdb_pos"]).select(*keys, F.col("seq_id").alias("pdb_pos"), "unp_pos")


def preferred_positions(mapped: DataFrame, keys: list[str], rank: str = "rank") -> DataFrame:
    """Of several alignments of a chain, position by position the one of the smallest rank."""
    best = F.rank().over(Window.partitionBy(*keys, "pdb_pos").orderBy(rank))
    return mapped.withColumn("__r", best).where("__r = 1").select(*keys, "pdb_pos", "unp_pos")


def aligned_islands(alignments: DataFrame, key: str = "aln") -> DataFrame:
    """:func:`islands` of :func:`residue_map`, found inside the row of each alignment: only whole runs leave it.

    A run ends where the structure's position, counted over columns with a letter on both sides, takes more than one step.
    """
    start = lambda c: F.coalesce(F.col(c), F.lit(1)).cast("long") if c in alignments.columns else F.lit(1).cast("long")
    cols = alignments.where("unp_aln IS NOT NULL AND pdb_aln IS NOT NULL").select(key, "unp_aln", "pdb_aln", start("unp_start").alias("u0"), start("pdb_start").alias("p0"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: list[list[np.ndarray]] = []
            for k, (unp, pdb, u0, p0) in enumerate(zip(*(batch.column(c).to_pylist() for c in range(1, 5)), strict=True)):
                n = min(len(unp), len(pdb))
                u, p = _codes(unp)[:n] != 45, _codes(pdb)[:n] != 45
                both = np.flatnonzero(u & p)
                if not len(both):
                    continue
                at_u, at_p = (np.cumsum(u) + (u0 - 1))[both], (np.cumsum(p) + (p0 - 1))[both]
                border = np.flatnonzero(at_p[1:] != at_p[:-1] + 1)
                first, last = np.concatenate([[0], border + 1]), np.concatenate([border, [len(both) - 1]])
                found.append([np.full(len(first), k), at_p[first], at_p[last], at_u[first], at_u[last]])
            if found:
                rows, *ranges = (np.concatenate(c) for c in zip(*found, strict=True))
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows)), *map(pa.array, ranges)], [key, "pdb_start", "pdb_end", "unp_start", "unp_end"])

    return cols.mapInArrow(run, f"`{key}` {alignments.schema[key].dataType.simpleString()}, pdb_start long, pdb_end long, unp_start long, unp_end long")


def excluded_types(residues: DataFrame, types: tuple[str, ...] = ("Insertion", "Linker", "Expression tag")) -> DataFrame:
    """Residues that may be mapped: none of the types, and no initiating methionine before the first expression tag."""
    w = Window.partitionBy("entry", "chain")
    tag = F.min(F.when(F.col("rtype") == "Expression tag", F.col("seq_id"))).over(w)
    early = (F.col("rtype") == "Initiating methionine") & F.coalesce(F.col("seq_id") < tag, F.lit(False))
    return residues.withColumn("__out", F.coalesce(F.col("rtype").isin(*types), F.lit(False)) | F.coalesce(early, F.lit(False))).where(~F.col("__out")).drop("__out")


def islands(positions: DataFrame, keys: list[str]) -> DataFrame:
    """Runs without a gap in the structure's positions; gaps of the reference don't split them."""
    per = positions.groupBy(*keys, "pdb_pos").agg(F.min("unp_pos").alias("low"), F.max("unp_pos").alias("high"))
    w = Window.partitionBy(*keys).orderBy("pdb_pos")
    runs = per.withColumn("run", F.col("pdb_pos") - F.row_number().over(w))
    out = runs.groupBy(*keys, "run").agg(
        F.min("pdb_pos").alias("pdb_start"), F.max("pdb_pos").alias("pdb_end"), F.min_by("low", "pdb_pos").alias("unp_start"), F.max_by("high", "pdb_pos").alias("unp_end")
    )
    return out.drop("run")


def blanks(chains: DataFrame, mapped: DataFrame, keys: list[str]) -> DataFrame:
    """Ranges of chains (keys, length) that no mapped range (keys, pdb_start, pdb_end), or position (pdb_pos), covers.

    Ranges are subtracted as such: a blank lies between the farthest end so far and the next start.
    """
    ranges = mapped.select(*keys, F.col("pdb_pos").alias("pdb_start"), F.col("pdb_pos").alias("pdb_end")) if "pdb_pos" in mapped.columns else mapped.select(*keys, "pdb_start", "pdb_end")
    ends = chains.select(*keys, (F.col("length") + 1).cast("long").alias("pdb_start"), (F.col("length") + 1).cast("long").alias("pdb_end"), F.col("length").cast("long").alias("__n"))
    rows = ends.unionByName(ranges.join(chains.select(*keys, F.col("length").cast("long").alias("__n")), keys))
    before = F.coalesce(F.max("pdb_end").over(Window.partitionBy(*keys).orderBy("pdb_start", "pdb_end").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    out = rows.select(*keys, (F.greatest(before, F.lit(0)) + 1).alias("a"), F.least(F.col("pdb_start") - 1, F.col("__n")).alias("b"))
    return out.where("a <= b").select(*keys, F.col("a").alias("pdb_start"), F.col("b").alias("pdb_end"))


def align_chunk(alignments: DataFrame, key: str = "aln") -> DataFrame:
    """Slices (start, stop by ungapped positions of the structure): outer gaps go, inner gaps stay; '' for a slice without letters.

    Each alignment is cut inside its own row.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for unp, pdb, a, b in zip(*(batch.column(c).to_pylist() for c in range(1, 5)), strict=True):
                n = min(len(unp), len(pdb))
                at = np.flatnonzero(_codes(pdb)[:n] != 45)[max(a - 1, 0) : max(b, 0)]
                low, high = (int(at[0]), int(at[-1]) + 1) if len(at) else (0, 0)
                found.append((pdb[low:high], unp[low:high]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([x for x, _ in found], pa.string()), pa.array([x for _, x in found], pa.string())], [key, "pdb_chunk", "unp_chunk"])

    cols = alignments.where("unp_aln IS NOT NULL AND pdb_aln IS NOT NULL AND start IS NOT NULL AND stop IS NOT NULL").select(key, "unp_aln", "pdb_aln", F.col("start").cast("long"), F.col("stop").cast("long"))
    return cols.mapInArrow(run, f"`{key}` {alignments.schema[key].dataType.simpleString()}, pdb_chunk string, unp_chunk string")


def merge_connected(segments: DataFrame, keys: list[str], apart: str | None = None) -> DataFrame:
    """Join segments whose border is bonded (bonded_next: the end of this one with the start of the next).

    ``apart`` names a boolean column: segments of chimeras and of accessions that repeat stay as they are.
    """
    w = Window.partitionBy(*keys).orderBy("pdb_start")
    joined = F.coalesce(F.lag("bonded_next").over(w), F.lit(False))
    begins = F.when(joined & ~F.coalesce(F.col(apart), F.lit(False)) if apart else joined, 0).otherwise(1)
    runs = segments.withColumn("__new", begins).withColumn("__run", F.sum("__new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    out = runs.groupBy(*keys, "__run").agg(F.min("pdb_start").alias("pdb_start"), F.max("pdb_end").alias("pdb_end"), F.min_by("unp_start", "pdb_start").alias("unp_start"), F.max_by("unp_end", "pdb_start").alias("unp_end"))
    return out.drop("__run")


def chimera_flags(mapping: DataFrame) -> DataFrame:
    """(entry, chain, chimera, repeated): chimera with several accessions; repeated where the one accession has several
    ranges and a later one starts no later than an earlier one, or meets it, or lies beyond a large gap.

    The gap rule looks at the first two ranges: a gap longer than three times (half the second range less five).
    """
    w = Window.partitionBy("entry", "chain").orderBy("row_no")
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    gap = F.col("unp_start") - F.lag("unp_end").over(w) - 1
    extra = F.col("unp_end") - F.col("unp_start") + 1
    far = (F.row_number().over(w) == 2) & (gap > 3 * (extra / 2 - 5))
    met = F.greatest(F.max("unp_start").over(before), F.max("unp_end").over(before)) >= F.col("unp_start")
    again = mapping.withColumn("__bad", F.coalesce(far | met, F.lit(False)))
    several = F.countDistinct("accession") > 1
    return again.groupBy("entry", "chain").agg(several.alias("chimera"), (F.bool_or("__bad") & ~several).alias("repeated"))


def alignment_letter() -> Column:
    """The letter that a residue is aligned with: J for added ones, the original or X for changed ones."""
    t = F.col("rtype")
    return F.when(t.isin("Insertion", "Linker", "Expression tag"), F.lit("J")).when(t.isin("Engineered mutation", "Conflict", "Cloning artifact"), F.coalesce("original", F.lit("X"))).otherwise(F.col("letter"))


def assembled(rows: DataFrame, keys: list[str], position: str = "pos", letter: str = "letter", row_no: str = "row_no") -> DataFrame:
    """The sequence: the first row's letter of each position, in the order of positions."""
    first = rows.groupBy(*keys, position).agg(F.min_by(letter, row_no).alias("__c"))
    ordered = F.sort_array(F.collect_list(F.struct(F.col(position).alias("p"), F.col("__c").alias("c"))))
    return first.groupBy(*keys).agg(F.array_join(F.transform(ordered, lambda x: x.c), "").alias("sequence"))


def difference_runs(changes: DataFrame, keys: list[str]) -> DataFrame:
    """Runs of consecutive positions with one detail; rows without a position go, and repeated ones count once."""
    changes = changes.select(*keys, "pos", "detail").distinct()
    w = Window.partitionBy(*keys).orderBy("pos", "detail")
    same = (F.col("detail").eqNullSafe(F.lag("detail").over(w))) & (F.col("pos") == F.lag("pos").over(w) + 1)
    runs = changes.where("pos IS NOT NULL").withColumn("__new", F.when(F.coalesce(same, F.lit(False)), 0).otherwise(1))
    runs = runs.withColumn("__run", F.sum("__new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return runs.groupBy(*keys, "__run").agg(F.first("detail").alias("detail"), F.min("pos").alias("start"), F.max("pos").alias("end")).drop("__run")


def splice(sequence: Column, variants: Column) -> Column:
    """Replace [begin, end] by variation, the last range first, so earlier places stay valid.

    A range that begins behind the end of the sequence puts its variation there; ranges before it are applied to that.
    """
    latest = F.reverse(F.array_sort(variants))
    return F.aggregate(latest, sequence, lambda s, v: F.concat(F.substring(s, F.lit(1), v.begin - 1), v.variation, F.substring(s, v.end + 1, F.length(s))))


def heterogeneous(residues: DataFrame) -> DataFrame:
    """Positions that more than one component shares."""
    return residues.groupBy("entry", "chain", "seq_id", "ins_code").agg((F.countDistinct("comp") > 1).alias("hetero"))
