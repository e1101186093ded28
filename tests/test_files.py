"""Readers, writers and tables on small synthetic files."""

import gzip
import os

import pytest
from pyspark.sql import functions as F

from helixlake.operators import assembly, quality, tables
from helixlake.sources import readers, snapshots, writers


def rows(df, *order):
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]


def test_dimension_readers(spark, tmp_path):
    (tmp_path / "info.csv").write_text(",accession,provenance,pdb_xref,annotation_score\n0,P1,Swiss-Prot,3,5.0\n1,P2,TrEMBL,,\n")
    assert rows(readers.read_accession_metadata(spark, str(tmp_path / "info.csv")), "accession") == [("P1", "Swiss-Prot", 5.0), ("P2", "TrEMBL", None)]
    with gzip.open(tmp_path / "x.tsv.gz", "wt") as f:
        f.write("# 2024\nSP_PRIMARY\tPDB\nP1\t1abc;2abc;3abc\nP2\t1abc\n")
    assert rows(readers.read_xref_counts(spark, str(tmp_path / "x.tsv.gz")), "accession") == [("P1", 3), ("P2", 1)]
    (tmp_path / "tax.tsv").write_text("1abc\t1\t77\n")
    assert rows(readers.read_tax_override(spark, str(tmp_path / "tax.tsv"))) == rows(readers.read_entity_tax_override(spark, str(tmp_path / "tax.tsv"))) == [("1abc", "1", 77)]
    (tmp_path / "entity.tsv").write_text("1\t77\n2\t78\n")
    assert rows(readers.read_entity_tax_override(spark, str(tmp_path / "entity.tsv"), "1ABC"), "entity") == [("1abc", "1", 77), ("1abc", "2", 78)]
    (tmp_path / "map.tsv").write_text("P1\t77\n")
    assert rows(readers.read_tax_mapping(spark, str(tmp_path / "map.tsv"))) == [("P1", 77)]
    (tmp_path / "nodes.tsv").write_text("2\t1\n1\t1\n")
    assert rows(readers.read_nodes(spark, str(tmp_path / "nodes.tsv")), "tax_id") == [(1, 1), (2, 1)]


def test_headers_and_names(spark):
    df = spark.createDataFrame([("9XYZ|A|P1|own",), ("9xyz|B",)], "h string")
    assert rows(df.select(*readers.custom_header(F.col("h")))) == [("9xyz", "A", "P1", "own"), ("9xyz", "B", "B", "")]
    assert rows(readers.chain_header(spark.createDataFrame([("1|A, B",)], "header string")).select("entity", "chain")) == [("1", "A"), ("1", "B")]
    paths = spark.createDataFrame([("/d/9xyz.cif.gz",), ("s3://b/x.FASTA",), ("y.txt",)], "p string")
    assert [r[0] for r in paths.select(readers.entry_of_path(F.col("p"))).collect()] == ["9xyz", "x", "y"]


def segments(spark, *entries):
    names = [c.split()[0] for c in assembly.SEGMENT.split(",")]
    made = [{n: None for n in names} | {"entry_id": e, "entity_id": "1", "id": k, "auth_asym_id": "A", "struct_asym_id": "X", "name": "a,b", "pdb_start": p, "pdb_end": p + 5, "best_mapping": True, "canonical_acc": False} for e, k, p in entries]
    return spark.createDataFrame([tuple(m[n] for n in names) for m in made], assembly.SEGMENT)


def test_segment_files_round_trip(spark, tmp_path):
    writers.write_segments(segments(spark, ("e", 1, 1), ("e", 2, 9)).coalesce(1), str(tmp_path / "o"))
    part = next(p for p in os.listdir(tmp_path / "o") if p.endswith(".csv.gz"))
    for name in ("e_seg.csv.gz", "e_nf90_seg.csv.gz"):
        (tmp_path / name).write_bytes((tmp_path / "o" / part).read_bytes())
    with gzip.open(tmp_path / "e_seg.csv.gz", "rt") as f:
        assert f.readline().startswith("e,1,1,A,X,") and "a;b" in f.readline()
    back = readers.read_segment_files(spark, str(tmp_path), assembly.SEGMENT.replace("boolean", "int"))
    assert rows(back.select("id", "pdb_start", "best_mapping", "canonical_acc"), "id") == [(1, 1, 1, 0), (2, 9, 1, 0)]
    with pytest.raises(ValueError, match="struct_asym_id"):
        writers.write_segments(segments(spark, ("e", 1, 1)).withColumn("struct_asym_id", F.lit(None).cast("string")), str(tmp_path / "p"))
    with pytest.raises(ValueError, match="columns"):
        writers.write_residues(segments(spark, ("e", 1, 1)), str(tmp_path / "p"))


def test_only_changed_entries_are_written(spark, tmp_path):
    where = str(tmp_path / "t")
    assert writers.write_changed(segments(spark, ("e", 1, 1), ("f", 1, 1), ("g", 1, 1)), where)
    assert not writers.write_changed(segments(spark, ("e", 1, 1), ("f", 1, 1)), where)  # what is not in the run stays
    failed = spark.createDataFrame([("g",)], "entry string")
    assert writers.write_changed(segments(spark, ("e", 1, 2), ("f", 1, 1), ("g", 1, 8)), where, failed=failed)
    assert rows(snapshots.read(spark, where).select("entry_id", "pdb_start"), "entry_id") == [("e", 2), ("f", 1)]
    got = writers.changed_entries(segments(spark, ("e", 1, 1), ("f", 1, 1)), segments(spark, ("e", 1, 2), ("f", 1, 1), ("h", 1, 1)))
    assert rows(got, "entry_id") == [("e",), ("h",)]


def test_hits_replace_a_folder(spark, tmp_path):
    (tmp_path / "r").mkdir()
    (tmp_path / "r/old.txt").write_text("x")
    writers.write_hits(spark.range(3), f"file://{tmp_path}/r")
    assert not (tmp_path / "r/old.txt").exists() and spark.read.parquet(f"{tmp_path}/r/hits").count() == 3


def test_releases_are_kept_by_number(spark, tmp_path):
    where = str(tmp_path / "log")
    for day in range(1, 6):
        assert writers.write_release(spark.range(day).withColumn("delta_type", F.lit("new_mapping")), where, f"2024-01-0{day}", keep=3)
    assert not writers.write_release(spark.range(0), where, "2024-01-09", keep=3)
    assert [str(r[0]) for r in spark.read.parquet(where).groupBy("release_date").count().orderBy("release_date").collect()] == ["2024-01-03", "2024-01-04", "2024-01-05"]


def test_tables_are_made_filled_and_attached(spark, tmp_path):
    tables.create(spark, "own_rows", "a INT, b STRING", replace=True)
    tables.create(spark, "own_rows", "a INT, b STRING")
    tables.insert(spark.createDataFrame([(1,)], "a int"), "own_rows")
    tables.insert(spark.createDataFrame([("x", 2)], "b string, a int"), "own_rows")
    assert rows(spark.table("own_rows"), "a") == [(1, None), (2, "x")]
    tables.create(spark, "own_rows", "a INT", replace=True)
    assert spark.table("own_rows").columns == ["a"] and spark.table("own_rows").isEmpty()
    spark.range(2).write.parquet(str(tmp_path / "other.parquet"))
    assert tables.attached(spark, str(tmp_path), "other").count() == 2
    assert writers.load_table(spark.range(2), str(tmp_path / "l")) and not writers.load_table(spark.range(0), str(tmp_path / "l"))
    assert spark.read.parquet(str(tmp_path / "l")).count() == 2


def test_checks(spark):
    a = spark.createDataFrame([(1, "x"), (1, "x"), (2, None)], "k int, v string")
    assert quality.preserved(a, a.withColumn("more", F.lit(1))) and not quality.preserved(a, a.distinct()) and not quality.preserved(a, a.drop("v"))
    assert rows(quality.lost_rows(a, a.distinct())) == [(1, "x")]
    with pytest.raises(ValueError, match="v"):
        quality.require(a, ["k", "v"])
    with pytest.raises(ValueError, match="own"):
        quality.require_rows(a.where("k > 5"), "own")
    with pytest.raises(ValueError):
        quality.same_schema(a, ["v", "k"])
