"""Entries made chain by chain against the operators over rows of single residues, and what their plans shuffle."""

import random

from pyspark.sql import functions as F

from helixlake import bindings, bindings_entries, jobs
from helixlake.operators import assembly, residues

SF = "/root/testdata/sf0.001"


def by_rows(aligned, table, chains, records):
    key = ["entry", "chain", "accession"]
    own = aligned.select(F.struct(*key).alias("aln"), "unp_aln", "pdb_aln", F.col("unp_at").alias("unp_start"), F.col("pdb_at").alias("pdb_start"))
    positions = residues.without_excluded(residues.residue_map(own).select("aln.*", "pdb_pos", "unp_pos"), table, ["entry", "chain"])
    scored = aligned.withColumn("score", residues.identity(F.col("unp_aln"), F.col("pdb_aln"))).withColumn("pdb_from", F.col("pdb_at")).withColumn("pdb_to", F.col("pdb_at") + F.length(F.replace("pdb_aln", F.lit("-"), F.lit(""))) - 1)
    info = aligned.groupBy(*key).agg(F.bool_or("best").alias("best"), F.bool_or("canonical").alias("canonical")).join(records.select("accession", "name", "tax_id"), "accession", "left")
    seg = assembly.segment_rows(residues.islands(positions, key), chains, scored, records.select("accession", "name", "seq_version"), table)
    return seg, assembly.residue_rows(table, positions, chains, info, assembly.reference_letters(positions, records))


def tables(spark):
    r = random.Random(7)
    aligned, table, chains, records = [], [], [], []
    for k in range(40):
        sequence = "".join(r.choice("MKLTW") for _ in range(r.randrange(0, 30)))
        chains.append((f"e{k % 30}", f"A{k // 30}", "1", "X", sequence, k % 4 == 0, r.choice([None, 7])))
        for n, x in enumerate(sequence, 1):
            for m in range(r.choice([1, 1, 1, 2])):
                kind = r.choice([None, None, None, "Conflict", "Linker", "Expression tag", "Initiating methionine"])
                table.append((f"e{k % 30}", f"A{k // 30}", n, m + 1, x * 3, r.choice([x, "J", None, "MK"]), kind, r.choice([str(n + 5), "7A", None]), r.choice([None, "B"]), r.choice([True, False])))
        for a in range(r.randrange(0, 4)):
            accession, at = f"P{k}{a % 3}", 1
            for _ in range(r.choice([1, 1, 2])):  # ranges of one accession that don't overlap
                length = r.randrange(1, 12)
                unp, pdb = ("".join(r.choice("MKLTW-") for _ in range(length + r.randrange(2))) for _ in range(2))
                aligned.append((f"e{k % 30}", f"A{k // 30}", accession, at, r.randrange(1, 5), unp, pdb, r.choice([True, False]), r.choice([True, False, False])))
                at += length + 2
            if a % 3 != 2:
                records.append((accession, f"N{k}", a, "".join(r.choice("MKLTW") for _ in range(r.randrange(3, 25))), r.choice([9, None])))
    records = list({x[0]: x for x in records}.values())
    return (
        spark.createDataFrame(aligned, "entry string, chain string, accession string, pdb_at int, unp_at int, unp_aln string, pdb_aln string, best boolean, canonical boolean"),
        spark.createDataFrame(table, "entry string, chain string, seq_id long, mh_id int, comp string, letter string, rtype string, auth string, ins_code string, observed boolean"),
        spark.createDataFrame(chains, "entry string, chain string, entity string, asym string, sequence string, chimera boolean, tax_id int"),
        spark.createDataFrame(records, "accession string, name string, seq_version int, sequence string, tax_id int"),
    )


def test_chains_agree_with_rows(spark):
    given = tables(spark)
    for mine, theirs in zip(jobs.mapped_entries(*given), by_rows(*given), strict=True):
        assert mine.schema.simpleString() == theirs.schema.simpleString()
        a, b = (sorted(map(str, x.collect())) for x in (mine, theirs))
        assert a == b and len(a) > 100


def test_no_row_of_a_residue_is_shuffled(spark):
    for name in ("m9_chains_without_canonical", "b8_exported_segments", "i15_segment_rows", "i17_residue_rows", "b10_exported_residues"):
        plan = getattr(bindings_entries, name)(spark, SF)._jdf.queryExecution().optimizedPlan().toString()
        assert "posexplode" not in plan and "RDD" not in plan, name


def test_assembled_letters_stay_where_their_text_is(spark):
    plan = bindings.e3_sequence_assembly(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "ENSURE_REQUIREMENTS" not in plan
