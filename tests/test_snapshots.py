"""Loads that die at each step, fingerprints against multisets, and writes that check what they write."""

import gzip
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from helixlake.operators import delta, quality
from helixlake.sources import snapshots, writers
from helixlake.streaming import incremental

STEPS = ["rows", "marks", "manifest", "rename", "expire"]


class Died(RuntimeError):
    pass


@pytest.fixture
def dying(monkeypatch):
    """A function that makes the next load die before the named step, None for none."""
    at: list = [None]

    def step(name):
        if name == at[0]:
            raise Died(name)

    monkeypatch.setattr(snapshots, "step", step)
    return lambda name: at.__setitem__(0, name)


def held(spark, path):
    return sorted(tuple(r) for r in snapshots.read(spark, path, "e string, v int").collect())


@pytest.mark.parametrize("at", STEPS)
def test_a_load_counts_as_a_whole_or_not_at_all(spark, tmp_path, dying, at):
    path = str(tmp_path / "t")
    make = lambda rows: spark.createDataFrame(rows, "e string, v int")
    assert writers.write_changed(make([("a", 1), ("b", 1), ("c", 1)]), path, "e")
    old, new = [("a", 1), ("b", 1), ("c", 1)], [("a", 1), ("b", 2), ("b", 3), ("c", 1), ("d", 1)]
    run = make([("a", 1), ("b", 2), ("b", 3), ("d", 1)])
    dying(at)
    with pytest.raises(Died):
        writers.write_changed(run, path, "e")
    dying(None)
    assert held(spark, path) == (new if at == "expire" else old)
    assert writers.write_changed(run, path, "e") == (at != "expire")  # what counts already is no change
    assert held(spark, path) == new
    assert not writers.write_changed(run, path, "e")
    marks = {r["entry"]: r["n"] for r in snapshots.marks(spark, path).collect()}
    assert marks == {"a": 1, "b": 2, "c": 1, "d": 1}
    snapshots.expire(spark, path, keep=1)
    assert held(spark, path) == new and len(list((tmp_path / "t/versions").glob("*.json"))) == 1


@pytest.mark.parametrize("at", ["log", *STEPS])
def test_a_batch_that_died_is_loaded_and_logged_once(spark, tmp_path, dying, at):
    schema = "entry string, chain string, accession string, pdb_start int, pdb_end int, unp_start int, unp_end int, row_no int"
    inbox = tmp_path / "in"
    inbox.mkdir()
    args = (str(inbox), schema, str(tmp_path / "t"), str(tmp_path / "log"), str(tmp_path / "ck"))
    with gzip.open(inbox / "a_seg.csv.gz", "wt") as f:
        f.write("1abc,A,P1,1,5,1,5,1\n2abc,A,P2,1,5,1,5,1\n")
    incremental.load_new_segments(spark, *args)
    with gzip.open(inbox / "b_seg.csv.gz", "wt") as f:
        f.write("1abc,A,P1,1,6,1,6,1\n")
    dying(at)
    with pytest.raises(Exception):  # noqa: B017  the stream wraps it
        incremental.load_new_segments(spark, *args)
    dying(None)
    incremental.load_new_segments(spark, *args)
    assert sorted(tuple(r)[:5] for r in snapshots.read(spark, args[2]).select("entry", "chain", "accession", "pdb_start", "pdb_end").collect()) == [("1abc", "A", "P1", 1, 6), ("2abc", "A", "P2", 1, 5)]
    log = spark.read.parquet(args[3]).orderBy("batch", "entry")
    assert [(r["entry"], r["delta_type"]) for r in log.collect()] == [("1abc", "new_mapping"), ("2abc", "new_mapping"), ("1abc", "changed_segments")]


def test_two_loads_cannot_make_one_version(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    rows = spark.createDataFrame([("a", 1)], "e string, v int")

    def step(name):
        if name == "rename":
            monkeypatch.setattr(snapshots, "step", lambda name: None)
            snapshots.replace(spark, path, rows, "e", [])

    monkeypatch.setattr(snapshots, "step", step)
    with pytest.raises(RuntimeError, match="another load"):
        snapshots.replace(spark, path, rows.withColumn("v", F.lit(2)), "e", [])
    assert held(spark, path) == [("a", 1)]


def test_fingerprints_tell_multisets_apart(spark):
    r = random.Random(5)
    values = [None, "", "a", "b", "-"]
    rows = [(k, r.choice(values), r.choice(values), r.choice([None, 0, 1])) for k in range(400) for _ in range(r.randrange(1, 4))]
    df = spark.createDataFrame(rows, "k int, x string, y string, z int")
    bags = {k: frozenset(Counter(x[1:] for x in rows if x[0] == k).items()) for k in range(400)}
    key = F.col("k").alias("key")
    of: dict = {}
    for m in delta.fingerprints(df.select(key, "x", "y", "z").repartition(3).withColumn("key", F.col("key")), ["key"]).collect():
        assert m["n"] == sum(n for _, n in bags[m["key"]])
    groups: dict = {}
    for k, bag in bags.items():
        groups.setdefault(bag, []).append(k)
    for bag, ks in list(groups.items())[:6]:
        own = [delta.fingerprints(df.where(F.col("k") == k).drop("k")).first() for k in ks[:2]]
        assert len(set(own)) == 1
        of[own[0]] = bag
    assert len(of) == 6
    assert delta.same_rows(df, df.repartition(5).select("z", "y", "x", "k")) and not delta.same_rows(df, df.limit(len(rows) - 1).unionAll(df.limit(1)).where("k <> 399"))
    a, b = spark.createDataFrame([(None, "a"), ("a", None), ("a", None)], "x string, y string"), spark.createDataFrame([("a", None), (None, "a"), (None, "a")], "x string, y string")
    assert not delta.same_rows(a, b) and delta.same_rows(a.where("false"), b.where("false")) and not delta.same_rows(a, a.drop("y"))
    new = df.where("k <> 3").unionByName(spark.createDataFrame([(500, "q", None, 1), (7, "q", None, 1)], df.schema))
    changed = delta.changed_keys(delta.fingerprints(df, ["k"]), delta.fingerprints(new, ["k"]), ["k"]).collect()
    count = Counter(x[0] for x in rows)
    assert sorted((c["k"], c["n_old"], c["n_new"]) for c in changed) == [(3, count[3], 0), (7, count[7], count[7] + 1), (500, 0, 1)]


def test_a_checked_write_runs_its_plan_once(spark, tmp_path):
    seen = tmp_path / "seen"
    seen.mkdir()

    def marked(batches):
        for batch in batches:
            (seen / str(len(list(seen.iterdir())))).touch()
            yield batch

    rows = spark.createDataFrame([(1, "x"), (2, None)], "k int, v string").coalesce(1)
    own = rows.mapInArrow(marked, "k int, v string")
    assert quality.written_checked(own, "own", ["k"], rows=True).count() == 2 and len(list(seen.iterdir())) == 1
    with pytest.raises(ValueError, match="nulls in v"):
        quality.written_checked(own, "own", ["k", "v"])
    with pytest.raises(ValueError, match="own is empty"):
        quality.written_checked(own.where("k > 5"), "own", ["k"], rows=True)
    where = str(tmp_path / "o")
    assert writers.load_table(own, where) and len(list(seen.iterdir())) == 4
    writers.write_delimited(rows, str(tmp_path / "d"), ["k"])
    with pytest.raises(ValueError, match="nulls in v"):
        writers.write_delimited(rows.withColumn("k", F.lit(9)), str(tmp_path / "d"), ["v"])
    assert sorted(r[0] for r in spark.read.csv(str(tmp_path / "d")).collect()) == ["1", "2"]  # what was there stays
    assert not writers.load_table(rows.where("k > 5"), where) and spark.read.parquet(where).count() == 2
    with pytest.raises(ValueError, match="empty"):
        writers.write_fasta(spark.createDataFrame([], "entry string, entity int, tax_id int, sequence string"), str(tmp_path / "f"))
    assert {p.name for p in tmp_path.iterdir()} == {"seen", "o", "d"}


def test_a_replacement_that_died_is_undone(spark, tmp_path):
    where = str(tmp_path / "l")
    assert writers.load_table(spark.range(3), where)
    (tmp_path / "l").rename(tmp_path / "l.before")  # died while the old folder stood aside
    assert not writers.load_table(spark.range(0), where) and spark.read.parquet(where).count() == 3
    assert writers.load_table(spark.range(4), where) and spark.read.parquet(where).count() == 4


def test_published_change_log(spark, tmp_path):
    rows = [("1abc", 'a "quoted", text', None), ("2abc", "", "1_2;3_4")]
    df = spark.createDataFrame(rows, "entry string, old string, new string")
    where = str(tmp_path / "c")
    assert writers.write_delta_csv(df.coalesce(1), where) and not writers.write_delta_csv(df.where("entry = 'x'"), where)
    part = next(p for p in (tmp_path / "c").iterdir() if p.name.endswith(".csv.gz"))
    with gzip.open(part, "rt") as f:
        assert f.readline() == '"entry","old","new"\n' and f.readline().startswith('"1abc","a ""quoted"", text",')
    back = spark.read.option("header", True).option("escape", '"').csv(where)
    assert sorted((r["entry"], r["old"] or "", r["new"] or "") for r in back.collect()) == [("1abc", 'a "quoted", text', ""), ("2abc", "", "1_2;3_4")]
