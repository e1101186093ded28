"""The reference store and gapped alignments against plain loops."""

import random
import re
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from helixlake.operators import anchors, chaining, residues, search


def made_up(r, letters="abcd"):
    return "".join(r.choice(letters) for _ in range(r.randrange(0, 90)))


def plain_candidates(queries, refs, k, least):
    out = {}
    for q, x in queries:
        for t, y in refs:
            for i in range(len(x or "") - k + 1):
                for j in range(len(y or "") - k + 1):
                    if x[i : i + k] == y[j : j + k]:
                        out.setdefault((q, t, j - i), []).append(i + 1)
    return sorted((*key, len(at), min(at), max(at)) for key, at in out.items() if len(at) >= least)


@pytest.fixture(scope="module")
def texts():
    r = random.Random(11)
    shared = [made_up(r) for _ in range(4)]
    queries = [(k, made_up(r) + r.choice(shared) + "é\U0001f600" * (k % 2)) for k in range(9)] + [(90, ""), (91, None), (92, "aaaaaaaaaaaaaaaaaaaa")]
    refs = [(f"r{k}", r.choice(shared) + made_up(r) + "é\U0001f600" * (k % 3)) for k in range(12)] + [("e", ""), ("n", None), ("a", "aaaaaaaaaaaaaaaaaaaaaaaaaaa"), ("b", "aaaaaaaaab")]
    return queries, refs


@pytest.fixture(scope="module")
def frames(spark, texts):
    q = spark.createDataFrame(texts[0], "query long, sequence string").withColumn("anchor", F.lit(1)).withColumn("key", F.lit(2)).repartition(3)
    return q, spark.createDataFrame(texts[1], "ref string, sequence string").withColumn("at", F.lit(1)).withColumn("part", F.lit(2)).repartition(3)


@pytest.mark.parametrize(("k", "hot"), [(1, 10_000), (2, 10_000), (5, 10_000), (5, 3), (12, 10_000)])
def test_candidates_and_store_find_every_shared_letter_run(spark, texts, frames, tmp_path, monkeypatch, k, hot):
    monkeypatch.setattr(anchors, "HOT", hot)
    monkeypatch.setattr(anchors, "BLOCK", 16)
    want = plain_candidates(*texts, k, 2)
    found = lambda d: sorted(tuple(x) for x in d.collect())
    assert found(search.candidates(*frames, k=k)) == want and want
    name = f"set_{k}_{hot}"
    taxa = spark.createDataFrame([("r1", 9), ("r1", 7)], "accession string, tax_id int")
    anchors.write_reference_set(frames[1], taxa, name, str(tmp_path / name), k=k, buckets=4)
    assert found(anchors.search_store(frames[0], name)) == want
    assert spark.table(f"{name}_sequences").where("ref = 'r1'").collect()[0]["tax_id"] == 9
    assert spark.table(f"{name}_hot").count() > 0 if hot == 3 else True
    monkeypatch.setattr(anchors, "ASKED", 1)
    assert found(anchors.search_store(frames[0], name)) == want
    assert anchors.search_store(frames[0].where("query < 0"), name).count() == 0


def plan_of(df):
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def test_a_search_leaves_the_references_where_they_are(spark, frames, tmp_path, monkeypatch):
    anchors.write_reference_set(frames[1], spark.createDataFrame([], "accession string, tax_id int"), "still", str(tmp_path / "still"), k=5, buckets=16)
    own = spark.createDataFrame([(1, "abcdab")], "query long, sequence string")
    plan = plan_of(anchors.search_store(own, "still"))
    count = int(re.search(r"SelectedBucketsCount: (\d+) out of 16", plan)[1])
    assert 1 <= count <= 2 and "SortMergeJoin" in plan
    tree = plan[: plan.index("\n\n")]
    lines = tree.splitlines()
    scan = next(i for i, x in enumerate(lines) if "still_pieces" in x)
    join = next(i for i, x in enumerate(lines) if "SortMergeJoin" in x)
    depth = lambda x: len(x) - len(x.lstrip(" :+-|"))
    branch = [lines[scan]]
    for x in reversed(lines[join + 1 : scan]):
        if depth(x) < depth(branch[-1]):
            branch.append(x)
    assert not any("Exchange" in x for x in branch)


def plain_chain(pieces):
    best = None
    pieces = sorted(pieces)
    for n in range(1, len(pieces) + 1):
        for c in combinations(range(len(pieces)), n):
            own = [pieces[k] for k in c]
            if all(b[0] > a[2] and b[1] > a[3] for a, b in zip(own, own[1:], strict=False)):
                key = (-sum(p[4] for p in own), c)
                best = min(best or (key, own), (key, own))
    return best[1]


def test_chains_against_all_chains():
    r = random.Random(12)
    for _ in range(300):
        pieces = set()
        for _ in range(r.randrange(1, 9)):
            a, b, n = r.randrange(1, 25), r.randrange(1, 25), r.randrange(0, 8)
            pieces.add((a, b, a + n, b + n, r.randrange(1, 6)))
        assert chaining.best_chain(list(pieces)) == plain_chain(list(pieces))


def test_many_pieces_chain_in_seconds():
    pieces = [(3 * k + 1, 3 * ((k * 7919) % 50_000) + 1, 3 * k + 2, 3 * ((k * 7919) % 50_000) + 2, 1 + k % 5) for k in range(50_000)]
    chain = chaining.best_chain(pieces)
    assert all(b[0] > a[2] and b[1] > a[3] for a, b in zip(chain, chain[1:], strict=False)) and len(chain) > 100


def test_a_gapped_pair_has_the_letters_of_its_stretch(spark):
    left, right = "the quick brown fox jumps", "over a lazy dog that sleeps"
    q = spark.createDataFrame([("q", left + "XYZ" + right), ("s", "abcde")], "query string, sequence string")
    t = spark.createDataFrame([("t", "..." + left + "w" + right + "..."), ("u", left[::-1])], "ref string, sequence string")
    hits = search.diagonal_align(search.candidates(q, t, k=6), q, t)
    (row,) = chaining.gapped_alignments(hits, q, t).collect()
    assert (row["qaln"], row["taln"]) == (left + "XYZ-" + right, left + "---w" + right)
    assert (row["segments"], row["gapopen"], row["mismatch"], row["qstart"], row["qend"], row["tstart"], row["tend"]) == (2, 2, 0, 1, len(left + right) + 3, 4, len(left + right) + 4)
    assert row["identity"] == pytest.approx(len(left + right) / (len(left + right) + 4)) and row["coverage"] == 1
    pair = chaining.gapped_alignments(hits, q, t).select(F.lit(1).alias("aln"), F.col("qaln").alias("pdb_aln"), F.col("taln").alias("unp_aln"), F.col("qstart").alias("pdb_start"), F.col("tstart").alias("unp_start"))
    got = sorted((x["pdb_pos"], x["unp_pos"]) for x in residues.residue_map(pair).collect())
    n = len(left)
    assert got == [(k, k + 3) for k in range(1, n + 1)] + [(n + 3 + k, n + 4 + k) for k in range(1, len(right) + 1)]
    assert chaining.gapped_alignments(hits.where("score < 0"), q, t).count() == 0


def test_reference_pieces_without_a_query_anchor_do_not_travel(spark):
    r = random.Random(11)
    text = lambda n: "".join(r.choice("ACDEFGHIKLMN") for _ in range(n))
    refs = [(k, text(400)) for k in range(60)]
    queries = [(k, refs[k][1][50:110] + text(40)) for k in range(3)] + [(9, text(80)), (10, None), (11, "AC")]
    q, t = spark.createDataFrame(queries, "query int, sequence string"), spark.createDataFrame(refs, "ref int, sequence string")
    own = anchors.pieces(q, "query", "sequence", 12)
    every, sifted = anchors.pieces(t, "ref", "sequence", 12), anchors.pieces(t, "ref", "sequence", 12, anchors.sieve(own))
    met = every.join(own.select("anchor").distinct(), "anchor", "left_semi")
    assert sifted.count() < every.count() / 10 and met.select(*every.columns).exceptAll(sifted).isEmpty()
    got, want = (sorted(search.candidates(q, t, 12, max_refs=m).collect()) for m in (None, 1000))
    assert got == want and len(got) == 3
    assert search.candidates(q.where("query > 9"), t, 12).isEmpty()
