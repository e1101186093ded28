"""Schemes made chain by chain against the operators over rows of single residues, and what their plans shuffle."""

import random

import pyarrow as pa
from pyspark.sql import functions as F

from helixlake import bindings_entities, bindings_entries
from helixlake.operators import entities, residues, schemes

SF = "/root/testdata/sf0.001"


def test_schemes_agree_with_rows(spark):
    r = random.Random(3)
    canonical, chains, aligned, seen = [], [], [], []
    for k in range(30):
        names = [r.choice(["ALA", "GLY", "MET"]) for _ in range(r.randrange(1, 20))]
        canonical.append((k, "1", names))
        for row_no, c in enumerate(r.sample("ABC", 2)):
            chains.append((k, "1", c, c * 2, row_no))
            unp = "".join(r.choice("MK-") for _ in range(30))
            while len(unp.replace("-", "")) > len(names):
                unp = unp[:-1]
            pdb = "".join(r.choice("MK-") for _ in unp)
            aligned.append((k, c, unp, pdb))
            seen.append((k, c, [(n, n + 50, r.choice(["MSE", None]), r.choice(["A", None]), "n") for n in range(1, 30) if r.random() < 0.6]))
    canonical = spark.createDataFrame(canonical, "entry long, entity string, sequence array<string>")
    chains = spark.createDataFrame(chains, "entry long, entity string, chain string, asym string, row_no int")
    aligned = spark.createDataFrame(aligned, "entry long, chain string, unp_aln string, pdb_aln string")
    seen = spark.createDataFrame(seen, "entry long, chain string, coordinates array<struct<pdb_pos: long, auth_seq_id: int, comp: string, ins_code: string, hetero: string>>")
    rows = canonical.select("entry", "entity", F.posexplode("sequence").alias("k", "mon_id")).select("entry", "entity", (F.col("k") + 1).cast("long").alias("seq_id"), "mon_id")
    mapped = residues.residue_map(aligned.select(F.struct("entry", "chain").alias("aln"), "unp_aln", "pdb_aln")).select("aln.*", "pdb_pos", "unp_pos")
    places = seen.select("entry", "chain", F.inline("coordinates"))
    for shared, theirs, columns in ((False, entities.rebuilt_scheme, ["pdb_seq_num", "auth_mon_id", "mon_id"]), (True, entities.updated_scheme, ["auth_seq_num", "pdb_mon_id", "mon_id"])):

        def made(x, columns=columns, shared=shared):
            c = x.updated() if shared else x.rebuilt()
            n = len(x)
            yield pa.RecordBatch.from_arrays([pa.array([x.own["entry"]] * n, pa.int64()), pa.array([x.own["chain"]] * n), pa.array([str(i + 1) for i in range(n)]), *[c[k] for k in columns]], ["entry", "chain", "seq_id", *columns])

        mine = schemes.each_scheme(schemes.entry_rows(canonical, chains, aligned, seen), made, "entry long, chain string, seq_id string, " + ", ".join(f"{c} string" for c in columns), each=lambda x, shared=shared: schemes.chains_of(x, shared))
        want = theirs(rows, chains, mapped, places).select("entry", F.col("pdb_strand_id").alias("chain"), "seq_id", *columns)
        assert sorted(map(str, mine.collect())) == sorted(map(str, want.collect()))


def test_no_row_of_a_residue_is_shuffled(spark):
    for f in (bindings_entities.i23_poly_seq_scheme, bindings_entries.i23_rebuilt_scheme, bindings_entries.i24_updated_scheme):
        assert "posexplode" not in f(spark, SF)._jdf.queryExecution().optimizedPlan().toString()
