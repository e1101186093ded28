import random
from datetime import date

from pyspark.sql import functions as F

from helixlake.operators import entities, gaps, residues


def test_letters_and_types(spark):
    df = spark.createDataFrame([("ala", "engineered MUTATION"), ("MSE", ""), (None, None)], "c string, t string")
    got = df.select(entities.one_letter(F.col("c")).alias("l"), entities.capitalised(F.col("t")).alias("t")).collect()
    assert [tuple(r) for r in got] == [("A", "Engineered mutation"), ("X", ""), (None, None)]


def test_taxonomy_and_ec(spark):
    df = spark.createDataFrame([("?", "9606,10090", "1"), (None, None, "x")], "a string, b string, c string")
    got = df.select(entities.taxonomy(F.col("a"), F.col("b"), F.col("c")).alias("t"), entities.ec_numbers(F.lit("1.1.1.1, ?,2.3.-.- ,.")).alias("e")).collect()
    assert [r.t for r in got] == [9606, None] and got[0].e == ["1.1.1.1", "2.3.-.-"]


def test_terminals_need_both(spark):
    rows = [("ALA", "N", 1, "N", "Y", "N", 1), ("ALA", "C", 3, "C", "N", "Y", 2), ("HOH", "O", 1, "O", "N", "N", 1), ("GLY", "N", 1, "N", "Y", "N", 1)]
    df = spark.createDataFrame(rows, "comp_id string, atom_id string, ordinal int, type_symbol string, n_terminal string, c_terminal string, row_no int")
    assert [tuple(r) for r in entities.terminals(df).collect()] == [("ALA", "N", 1, "C", 3)]


def test_standard_residues(spark):
    codes = spark.createDataFrame([(k, v) for k, v in entities.STANDARD.items() if k != "TRP"], "three string, one string")
    assert [r.three for r in entities.missing_standard(codes).collect()] == ["TRP"]


def test_precedence_and_fan_out(spark):
    c = spark.createDataFrame([("A", 2, "db"), ("A", 1, "user1"), ("A", 1, "user2"), ("B", 2, "db")], "chain string, priority int, acc string")
    assert sorted(r.acc for r in entities.preferred(c, ["chain"]).collect()) == ["db", "user1", "user2"]
    m, ch = spark.createDataFrame([(1, "P"), (2, "Q")], "entity int, acc string"), spark.createDataFrame([(1, "A"), (1, "B"), (3, "C")], "entity int, chain string")
    both, alone, bare = entities.fan_out(m, ch, ["entity"])
    assert sorted(r.chain for r in both.collect()) == ["A", "B"] and [r.acc for r in alone.collect()] == ["Q"] and [r.chain for r in bare.collect()] == ["C"]


def test_next_release(spark):
    days = [date(2024, 5, d) for d in range(6, 13)]
    got = spark.createDataFrame([(d,) for d in days], "d date").select("d", entities.next_release(F.col("d")).alias("r")).collect()
    assert all(r.r.weekday() == 2 and 0 <= (r.r - r.d).days < 7 for r in got)


def test_ranges_and_user_mapping(spark):
    one = spark.createDataFrame([("5-9, 12-20", "A:P1,B:P2")], "r string, m string")
    assert [tuple(x) for x in one.select(entities.ranges(F.col("r")).alias("x")).first().x] == [(5, 9), (12, 20)]
    assert [(r.chain, r.accession) for r in entities.user_mapping(one.select("m"), "m").collect()] == [("A", "P1"), ("B", "P2")]


def test_gap_moves(spark):
    df = spark.createDataFrame([("ABC---DEF",)], "s string")
    left, right, short = df.select(*[gaps.moved_gap(F.col("s"), F.lit(4), F.lit(6), n, side) for n, side in ((1, True), (2, False), (4, True))]).first()
    assert (left, right, short) == ("AB---CDEF", "ABCDE---F", None)


def test_merged_chunks(spark):
    df = spark.createDataFrame([(1, 1, 2, "AAAA", 8), (1, 2, 4, "BB", 8)], "k int, chunk_no int, start int, letters string, length int")
    assert gaps.merged_chunks(df, ["k"]).first().sequence == "-AABB---"


def test_disjoint_chunks(spark):
    rng, rows = random.Random(3), []
    for k in range(20):
        for _ in range(rng.randrange(1, 9)):
            p, u = rng.randrange(30), rng.randrange(30)
            rows.append((k, float(rng.randrange(5)), p, p + rng.randrange(6), u, u + rng.randrange(6)))
    want = []
    for k in range(20):
        kept = []
        for r in sorted((r for r in rows if r[0] == k), key=lambda r: (-r[1], *r[2:])):
            if all((r[3] < o[2] or o[3] < r[2]) and (r[5] < o[4] or o[5] < r[4]) for o in kept):
                kept.append(r)
        want += kept
    got = gaps.disjoint_chunks(spark.createDataFrame(rows, "k int, score double, p0 int, p1 int, u0 int, u1 int"), ["k"]).collect()
    assert sorted(map(tuple, got)) == sorted(want)


def test_resolved_chimera(spark):
    rows = [("c", 1, "P", 1, True), ("c", 1, "Q", 9, False), ("c", 2, "P", 7, True), ("c", 2, "Q", 10, True), ("c", 3, "P", 8, None), ("c", 3, "Q", 3, None), ("c", 4, "Q", 4, None)]
    df = spark.createDataFrame(rows, "chain string, pdb_pos int, accession string, unp_pos int, agrees boolean")
    got = gaps.resolved_chimera(df, ["chain"]).orderBy("pdb_pos").collect()
    assert [(r.accession, r.unp_pos) for r in got] == [("P", 1), ("P", 7), ("P", 8), ("Q", 4)]


def test_letters_of_unequal_strings(spark):
    df = spark.createDataFrame([(1, "AB-D", "ABCDE"), (2, "", "A"), (3, None, "A")], "aln int, unp_aln string, pdb_aln string")
    assert [(r.aln, r.pdb_pos, r.unp_pos) for r in residues.residue_map(df).orderBy("aln", "pdb_pos").collect()] == [(1, 1, 1), (1, 2, 2), (1, 4, 3)]
