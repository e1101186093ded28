"""Walks in order and range joins against plain loops, and how they grow."""

import random
import time

import pytest
from pyspark.sql import functions as F

from helixlake.operators import gaps, residues, walks


def test_covering_against_all_pairs(spark, monkeypatch):
    r = random.Random(21)
    points = [(r.randrange(3), r.randrange(-40, 40), k) for k in range(120)] + [(None, 3, -1), (1, None, -2)]
    ranges = [(r.randrange(3), (a := r.randrange(-40, 40)), a + r.randrange(-3, 30), k) for k in range(80)] + [(None, 1, 9, -1), (1, None, 5, -2), (0, -40, 40, -3), (0, -40, 40, -3)]
    p = spark.createDataFrame(points, "k int, pos int, p int")
    g = spark.createDataFrame(ranges, "k int, begin int, finish int, r int")
    want = sorted((k, x, i, a, b, j) for k, x, i in points for m, a, b, j in ranges if k is not None and k == m and x is not None and a is not None and a <= x <= b)
    for width in (1, 7, 256):
        monkeypatch.setattr(walks, "BIN", width)
        assert sorted(tuple(x) for x in walks.covering(p, g, ["k"], "pos", "begin", "finish").collect()) == want
    assert walks.covering(p.where("k > 9"), g, ["k"], "pos", "begin", "finish").count() == 0


def test_a_long_range_has_a_row_for_each_bin(spark):
    g = spark.createDataFrame([(1, 1, 1_000_000_000)], "k int, begin long, finish long")
    p = spark.createDataFrame([(1, 5), (1, 999_999_999), (1, 1_000_000_001)], "k int, pos long")
    assert sorted(x["pos"] for x in walks.covering(p, g.withColumn("finish", F.col("finish")), ["k"], "pos", "begin", "finish").collect()) == [5, 999_999_999]


def test_long_chains_are_gone_through_in_seconds(spark):
    n = 100_000
    both = spark.range(n).select(F.lit("c").alias("chain"), F.col("id").alias("pdb_pos"), F.explode(F.array(F.lit("P"), F.lit("Q"))).alias("accession"), F.col("id").alias("unp_pos"), (F.col("id") % 1000 == 0).alias("good"))
    rows = both.withColumn("agrees", F.col("good") & (F.col("accession") == F.when(F.col("pdb_pos") % 2000 == 0, "Q").otherwise("P")))
    began = time.time()
    got = gaps.resolved_chimera(rows, ["chain"]).groupBy("accession").count().collect()
    assert sorted(tuple(x) for x in got) == [("P", n // 2), ("Q", n // 2)]
    apart = spark.range(n).select(F.lit(1).alias("k"), (F.col("id") % 97).alias("score"), (F.col("id") * 3).alias("p0"), (F.col("id") * 3 + 1).alias("p1"), (F.col("id") * 3).alias("u0"), (F.col("id") * 3 + 1).alias("u1"))
    assert gaps.disjoint_chunks(apart, ["k"]).count() == n
    assert gaps.without_overlaps(apart.withColumnsRenamed({"p0": "pdb_start", "p1": "pdb_end"}), ["k"], ["score", "pdb_start"]).count() == n
    text = spark.range(1).select(F.lit(1).alias("aln"), F.repeat(F.lit("AAC-G"), n).alias("unp_aln"), F.repeat(F.lit("A-CGT"), n).alias("pdb_aln"))
    assert residues.aligned_islands(text).count() == residues.islands(residues.residue_map(text), ["aln"]).count() > n
    assert time.time() - began < 60


@pytest.mark.parametrize("seed", range(4))
def test_islands_are_those_of_the_map(spark, seed):
    r = random.Random(seed)
    rows = [(k, "".join(r.choice("AC-") for _ in range(r.randrange(0, 40))), "".join(r.choice("AC-") for _ in range(r.randrange(0, 40))), r.randrange(1, 9), r.randrange(1, 9)) for k in range(40)] + [(90, None, "A", 1, 1), (91, "", "", 1, 1)]
    df = spark.createDataFrame(rows, "aln int, unp_aln string, pdb_aln string, unp_start int, pdb_start int")
    want = residues.islands(residues.residue_map(df), ["aln"])
    cols = ["aln", "pdb_start", "pdb_end", "unp_start", "unp_end"]
    assert sorted(tuple(x) for x in residues.aligned_islands(df).select(*cols).collect()) == sorted(tuple(x) for x in want.select(*cols).collect())


def test_overlaps_and_choices_against_loops(spark):
    r = random.Random(23)
    rows = [(k % 7, r.randrange(60), a := r.randrange(200), a + r.randrange(0, 9), k) for k in range(300)]
    df = spark.createDataFrame(rows, "k int, o int, pdb_start int, pdb_end int, row int")
    want = []
    for k in range(7):
        own = sorted((x for x in rows if x[0] == k), key=lambda x: (x[1], x[4]))
        want += [x for i, x in enumerate(own) if all(x[3] < y[2] or y[3] < x[2] for y in own[:i])]
    assert sorted(tuple(x) for x in gaps.without_overlaps(df, ["k"], ["o", "row"]).collect()) == sorted(want)


def test_repeated_changes_count_once_and_ranges_beyond_the_end_append(spark):
    changes = spark.createDataFrame([(1, 3, "R"), (1, 4, "R"), (1, 3, "A"), (1, 3, "R"), (1, None, "R"), (1, 5, None), (1, 6, None)], "chain int, pos int, detail string")
    assert sorted((x["detail"] or "", x["start"], x["end"]) for x in residues.difference_runs(changes, ["chain"]).collect()) == [("", 5, 6), ("A", 3, 3), ("R", 3, 4)]
    variants = F.array(*[F.struct(F.lit(b).alias("begin"), F.lit(e).alias("end"), F.lit(v).alias("variation")) for b, e, v in ((5, 7, "AB"), (20, 22, "C"))])
    text = spark.createDataFrame([("Osra",), ("abcdefghijklmnopqrstuvwxyz",)], "t string")
    assert [x[0] for x in text.select(residues.splice(F.col("t"), variants)).collect()] == ["OsraAB", "abcdABhijklmnopqrsCwxyz"]
