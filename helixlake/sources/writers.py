"""Writers: sequences, delimited exports, tables and dated change logs."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators import delta
from ..operators.assembly import RESIDUE, RESIDUE_REQUIRED, SEGMENT, SEGMENT_REQUIRED
from ..operators.quality import raise_for, same_schema
from ..operators.tables import written
from . import snapshots


def write_fasta(entities: DataFrame, path: str) -> None:
    """'>pdb|entry-entity|OX=tax' and the sequence; nothing to write is an error."""
    head = F.concat(F.lit(">pdb|"), "entry", F.lit("-"), F.col("entity").cast("string"), F.lit("|OX="), F.coalesce(F.col("tax_id").cast("string"), F.lit("")))
    lines = F.concat_ws("\n", head, "sequence").alias("value")
    staged(entities, path, lambda df, where: df.select(lines).write.text(where), needed=True)


def _moved(spark: SparkSession, held: str, path: str) -> None:
    """Put a finished folder in the place of another, which stands aside until it is there."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    new, where, aside = (jvm.org.apache.hadoop.fs.Path(p) for p in (held, path, f"{path}.before"))
    fs = where.getFileSystem(conf)
    if fs.exists(where):
        fs.delete(aside, True)
        fs.rename(where, aside)
    if not fs.rename(new, where):
        raise RuntimeError(f"{held} could not be moved to {path}")
    fs.delete(aside, True)


def _recovered(spark: SparkSession, path: str) -> None:
    """Undo a replacement that died while the old folder stood aside."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    where, aside = (jvm.org.apache.hadoop.fs.Path(p) for p in (path, f"{path}.before"))
    fs = where.getFileSystem(conf)
    if fs.exists(aside) and not fs.exists(where):
        fs.rename(aside, where)


def _dropped(spark: SparkSession, path: str) -> None:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def staged(rows: DataFrame, path: str, put: Callable[[DataFrame, str], None], required: Sequence[str] = (), needed: bool = False) -> int:
    """Write rows by ``put`` to a folder beside ``path`` and, if what the write observed is good, in place of it; returns their number.

    The rows are worked out once: the write counts them and the nulls of their required columns. Without rows, where
    they are not ``needed``, or with nulls, which is an error, the old folder stays as it is.
    """
    spark, held, seen = rows.sparkSession, f"{path}.{uuid.uuid4().hex}", Observation()
    _recovered(spark, path)
    try:
        put(rows.observe(seen, F.count(F.lit(1)).alias("__rows"), *[F.count_if(F.col(c).isNull()).alias(c) for c in required]), held)
        n = raise_for(seen, path, required, needed)
        if n:
            _moved(spark, held, path)
        return n
    finally:
        _dropped(spark, held)


def write_delimited(rows: DataFrame, path: str, required: Sequence[str] = ()) -> None:
    """Headerless gzip CSV: commas in strings become semicolons, booleans 0 and 1. Nulls in required columns are an error."""
    kinds = dict(rows.dtypes)
    cols = [F.regexp_replace(c, ",", ";").alias(c) if kinds[c] == "string" else F.col(c).cast("int").alias(c) if kinds[c] == "boolean" else F.col(c) for c in rows.columns]

    def put(checked: DataFrame, where: str) -> None:
        checked.select(*cols).write.option("quote", "|").option("compression", "gzip").csv(where)

    if not staged(rows, path, put, required):
        put(rows.limit(0), f"{path}.none")
        _moved(rows.sparkSession, f"{path}.none", path)


def load_table(rows: DataFrame, path: str) -> bool:
    """Replace a table by the rows; without rows it stays as it is. The old table stands until the new one is whole."""
    return staged(rows, path, lambda df, where: df.write.parquet(where)) > 0


def write_delta(changes: DataFrame, path: str) -> bool:
    """Add a non-empty change log to the releases under ``path``, one folder for each release date."""
    spark, held, seen = changes.sparkSession, f"{path}.{uuid.uuid4().hex}", Observation()
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    try:
        changes.observe(seen, F.count(F.lit(1)).alias("__rows")).write.partitionBy("release_date").parquet(held)
        if not raise_for(seen, path, ()):
            return False
        where = jvm.org.apache.hadoop.fs.Path(path)
        fs = where.getFileSystem(conf)
        fs.mkdirs(where)
        for each in fs.listStatus(jvm.org.apache.hadoop.fs.Path(held)):  # the dates of a run
            if each.isDirectory():
                date = jvm.org.apache.hadoop.fs.Path(where, each.getPath().getName())
                if fs.exists(date):  # more of a date that has been logged before
                    for part in fs.listStatus(each.getPath()):
                        fs.rename(part.getPath(), jvm.org.apache.hadoop.fs.Path(date, part.getPath().getName()))
                else:
                    fs.rename(each.getPath(), date)
        return True
    finally:
        _dropped(spark, held)


def write_delta_csv(changes: DataFrame, path: str) -> bool:
    """A non-empty change log in its published form: gzip CSV with a header and every string quoted; without rows what is there stays."""
    return staged(changes, path, lambda df, where: df.write.option("header", True).option("quoteAll", True).option("escape", '"').option("compression", "gzip").csv(where)) > 0


def write_hits(hits: DataFrame, folder: str) -> None:
    """Replace what an earlier run left, the table and all else in its folder."""
    jvm, context = hits.sparkSession.sparkContext._jvm, hits.sparkSession.sparkContext
    path = jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)
    hits.write.parquet(f"{folder}/hits")


def _columns(schema: str) -> list[str]:
    return [c.split()[0] for c in schema.split(",")]


def write_segments(rows: DataFrame, path: str) -> None:
    """The 26 columns of segments, checked, as headerless files."""
    write_delimited(same_schema(rows, _columns(SEGMENT)), path, SEGMENT_REQUIRED)


def write_residues(rows: DataFrame, path: str) -> None:
    """The 24 columns of residues, checked, as headerless files."""
    write_delimited(same_schema(rows, _columns(RESIDUE)), path, RESIDUE_REQUIRED)


def changed_entries(old: DataFrame, new: DataFrame, entry: str = "entry_id") -> DataFrame:
    """Entries of ``new`` whose rows are not just those of ``old``; one that is there for the first time is among them."""
    return delta.changed_keys(delta.fingerprints(old, [entry]), delta.fingerprints(new, [entry]), [entry]).where("n_new > 0").select(entry)


def write_changed(rows: DataFrame, path: str, entry: str = "entry_id", failed: DataFrame | None = None) -> bool:
    """Write entries that changed and take out those that failed; the others stay as they are. False: nothing to do.

    The table is one of :mod:`snapshots`, whose version changes at once. What changed is told by the fingerprints kept
    with it; only buckets that are touched are read. ``failed`` (entry) had a chain without accessions or a file that
    could not be read, so what an earlier run wrote of them goes.
    """
    spark = rows.sparkSession
    now = snapshots.latest(spark, path)
    key = F.col(entry).cast("string") == F.col("__entry")
    named = lambda entries: entries.select(F.col("entry").alias("__entry"))
    gone = failed.select(F.col(failed.columns[0]).cast("string").alias("entry")).distinct() if failed is not None else spark.createDataFrame([], "entry string")
    rows = written(rows.join(named(gone), key, "left_anti"), "run")
    before, after = snapshots.marks(spark, path, version=now), snapshots.entry_marks(rows, entry)
    changed = delta.changed_keys(before, after, ["entry"]).where("n_new > 0").select("entry")
    touched = written(changed.union(before.join(gone, "entry", "left_semi").select("entry")).distinct(), "touched")
    buckets = [r["b"] for r in touched.select(snapshots.bucket("entry").alias("b")).distinct().collect()]  # BUCKETS at most
    if not buckets:
        return False
    kept = snapshots.read(spark, path, rows.schema, buckets, now).join(named(touched), key, "left_anti")
    marks = snapshots.marks(spark, path, buckets, now).join(touched, "entry", "left_anti").unionByName(after.join(touched, "entry", "left_semi"))
    snapshots.replace(spark, path, kept.unionByName(rows.join(named(touched), key, "left_semi")), entry, buckets, marks)
    return True


def write_release(changes: DataFrame, path: str, release: str, keep: int = 10) -> bool:
    """Append a release's changes to the log and drop releases beyond the newest ones."""
    if not write_delta(changes.withColumn("release_date", F.lit(release)), path):
        return False
    spark = changes.sparkSession
    log = spark.read.option("basePath", path).parquet(path).withColumn("release_date", F.col("release_date").cast("string"))
    kept = delta.newest_releases(log.select("release_date").distinct(), keep)
    for r in log.select("release_date").distinct().join(kept, "release_date", "left_anti").collect():  # a few dates
        part = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/release_date={r['release_date']}")
        part.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(part, True)
    return True
