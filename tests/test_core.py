import gzip

import pytest
from pyspark.sql import functions as F

from helixlake.operators import delta, exports, quality, residues, scoring, structure
from helixlake.sources import readers, snapshots, writers
from helixlake.streaming import incremental


def rows(df, *order):
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]


@pytest.mark.parametrize(
    "identity,coverage,mismatch,length,want",
    [(1.0, 0.8, 0, 41, 800.0), (0.95, 0.5, 20, 200, 427.5), (None, 1.0, 0, 10, 0.0), (1.0, 1.0, 0, 0, 0.0), (1.0, 1.0, None, 10, 0.0)],
)
def test_adjusted_score(spark, identity, coverage, mismatch, length, want):
    df = spark.createDataFrame([(identity, coverage, mismatch, length)], "identity double, coverage double, mismatch int, query_len int")
    assert df.select(scoring.adjusted_score()).first()[0] == pytest.approx(want)


@pytest.mark.parametrize("prov,score,want", [("Swiss-Prot", 3.5, 70.0), ("TrEMBL", 6.0, 10.0), (None, 2.0, -30.0), ("Swiss-Prot", None, 0.0)])
def test_dataset_score(spark, prov, score, want):
    assert spark.createDataFrame([(prov, score)], "provenance string, annotation_score double").select(scoring.dataset_score()).first()[0] == want


def test_tax_score(spark):
    nodes = spark.createDataFrame([(1, None), (2, 1), (3, 2), (4, 3), (5, 3), (6, 2), (7, 1)], "tax_id int, parent int")
    pairs = spark.createDataFrame([(4, 4), (4, 3), (4, 5), (4, 6), (4, 7), (4, 99)], "query_tax_id int, target_tax_id int")
    got = {r["target_tax_id"]: r["tax_score"] for r in scoring.tax_score(pairs, scoring.tax_lineage(nodes)).collect()}
    assert got == {4: 200.0, 3: 50.0, 5: 50.0, 6: 25.0, 7: 0.0, 99: 0.0}


def test_cutoff(spark):
    with pytest.raises(ValueError):
        scoring.identity_filter(spark.range(1), 1.5)


def test_hits_readers(spark, tmp_path):
    p = tmp_path / "m.tsv"
    p.write_text("7qax-1\tQ5ZZ01\t52\t1\t3\t54\t9\t60\t2.5E-31\t140\tPN\tPN\t52\t4932\tpdb|7qax-1|OX=4932\t1.000\t1.000\n")
    r = readers.read_hits(spark, str(p)).first()
    assert (r["entry"], r["entity"], r["accession"], r["query_tax_id"], r["identity"]) == ("7qax", "1", "Q5ZZ01", 4932, 1.0)
    p = tmp_path / "b.tsv"
    p.write_text("pdb|7qax-1|OX=x\tsp|Q5ZZ01|OWN1_YEAST\t52\t1\t3\t54\t9\t60\t1e-9\t140\tPN\tPN\t52\t4932\t100.0\t50.0\n")
    r = readers.read_hits(spark, str(p), "blastp").first()
    assert (r["entity"], r["accession"], r["query_tax_id"], r["coverage"]) == ("1", "Q5ZZ01", None, 0.5)
    (tmp_path / "empty.tsv").write_text("")
    assert readers.read_hits(spark, str(tmp_path / "empty.tsv")).isEmpty()


def test_fasta(spark, tmp_path):
    writers.write_fasta(spark.createDataFrame([("7qax", 1, 4932, "MSTRW"), ("7qay", 1, None, "MK")], "entry string, entity int, tax_id int, sequence string"), str(tmp_path / "o"))
    back = readers.read_fasta(spark, str(tmp_path / "o"))
    assert rows(back.select(*readers.query_header(F.col("header")), "sequence"), "entry") == [("7qax", "1", 4932, "MSTRW"), ("7qay", "1", None, "MK")]
    (tmp_path / "w.fa").write_text(">a b\nAC\nGT\n>c\nTT\n")
    assert rows(readers.read_fasta(spark, str(tmp_path / "w.fa"))) == [("a b", "ACGT"), ("c", "TT")]


def test_islands_and_blanks(spark):
    a = spark.createDataFrame([(1, "AB--CDE", "ABXYC-E")], "aln long, unp_aln string, pdb_aln string")
    m = residues.residue_map(a)
    assert rows(m, "pdb_pos") == [(1, 1, 1), (1, 2, 2), (1, 5, 3), (1, 6, 5)]
    assert rows(residues.islands(m, ["aln"]), "pdb_start") == [(1, 1, 2, 1, 2), (1, 5, 6, 3, 5)]
    chains = spark.createDataFrame([(1, 7), (2, 3)], "aln long, length int")
    assert rows(residues.blanks(chains, m, ["aln"]), "aln", "pdb_start") == [(1, 3, 4), (1, 7, 7), (2, 1, 3)]


def test_merge_connected(spark):
    s = spark.createDataFrame([("A", 1, 5, 1, 5, True), ("A", 6, 9, 8, 11, False), ("A", 12, 15, 12, 15, False)], "c string, pdb_start int, pdb_end int, unp_start int, unp_end int, bonded_next boolean")
    assert rows(residues.merge_connected(s, ["c"]), "pdb_start") == [("A", 1, 9, 1, 11), ("A", 12, 15, 12, 15)]


def test_bond_distance_is_cut_off(spark):
    df = spark.createDataFrame([("A", 1, 0.0, 0.0, 0.0), ("A", 2, 1.429, 0.0, 0.0), ("A", 3, 2.859, 0.0, 0.0)], "c string, i int, x double, y double, z double")
    assert [(r["distance"], r["bonded"]) for r in structure.bond_table(df, ["c"], "i").orderBy("i").collect()] == [(1.42, True), (1.43, False)]


def test_number_segments(spark):
    df = spark.createDataFrame([("k", 1, 5, 1), ("k", 7, 9, 2), ("k", 7, 9, 3), ("k", 20, 22, 4)], "k string, start int, end int, n int")
    assert [tuple(r)[3:] for r in exports.number_segments(df, ["k"], ["n"]).orderBy("n").collect()] == [(1, 1, 1), (2, 2, 1), (3, 2, 2), (4, 2, 3)]


def test_identifiers(spark):
    df = spark.createDataFrame([("7qax", "Q5ZZ01"), ("../x", "Q5ZZ01-2"), ("a" * 65, "x"), ("a\n", "A0A024R1X8"), (None, None)], "e string, a string")
    assert rows(df.select(quality.valid_entry(F.col("e")), quality.valid_accession(F.col("a")))) == [(True, True), (False, True), (False, False), (False, True), (False, False)]


def test_typed_delta_and_stream(spark, tmp_path):
    schema = "entry string, chain string, accession string, pdb_start int, pdb_end int, unp_start int, unp_end int, row_no int"
    inbox = tmp_path / "in"
    inbox.mkdir()
    args = (str(inbox), schema, str(tmp_path / "t"), str(tmp_path / "log"), str(tmp_path / "ck"))
    with gzip.open(inbox / "a_seg.csv.gz", "wt") as f:
        f.write("1abc,A,P1,1,5,1,5,1\n2abc,A,P2,1,5,1,5,1\n")
    incremental.load_new_segments(spark, *args)
    with gzip.open(inbox / "b_seg.csv.gz", "wt") as f:
        f.write("1abc,A,P1,1,6,1,6,1\n")
    incremental.load_new_segments(spark, *args)
    assert snapshots.read(spark, args[2]).count() == 2
    log = spark.read.parquet(args[3])
    assert rows(log.select("entry", "delta_type"), "batch", "entry") == [("1abc", "new_mapping"), ("2abc", "new_mapping"), ("1abc", "changed_segments")]


def test_registered_queries_match_sql(spark):
    import duckdb

    from helixlake.bindings import QUERIES, SQL

    d = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for t in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "documents", "embeddings", "pages", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{d}/{t}.parquet'")
    for name in ("c1_identity_filter", "f2_curated_top", "i6_islands", "i12_number_segments", "h4_typed_delta", "c10_release_gate", "i9_merge_connected"):
        got = QUERIES[name](spark, d)
        cols = sorted(got.columns)
        mine = sorted(repr(tuple(r[c] for c in cols)) for r in got.collect())
        found = con.execute(SQL[name])
        names = [c[0] for c in found.description]
        assert mine == sorted(repr(tuple(dict(zip(names, r, strict=True))[c] for c in cols)) for r in found.fetchall()), name


def test_delta_short_circuit(spark):
    a = spark.range(3)
    assert delta.same_rows(a, spark.range(3)) and not delta.same_rows(a, spark.range(2))
