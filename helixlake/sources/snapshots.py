"""Versioned tables: a load is all or nothing.

Rows lie in buckets of entries under ``data/<a folder of its own for each load>``, and beside them a fingerprint of
each entry. A manifest says in which load's folder each bucket is; a load writes its buckets to a new folder and then
a new manifest, which counts from the moment it is renamed into place. Whoever reads takes the newest manifest, so a
load that dies leaves the table as it was, and what it wrote is in nobody's way. The manifest also holds the number
of the last batch of each source: a batch that is tried again after its manifest counts is told so. One load of a
table runs at a time; one that finds its version taken fails.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.delta import MARKS, fingerprints

BUCKETS = 64
KEPT = 2  # versions that stay readable


@dataclass
class Version:
    number: int = 0
    parts: dict[str, str] = field(default_factory=dict)  # bucket to folder
    batches: dict[str, int] = field(default_factory=dict)  # source to its last batch


def bucket(entry: str) -> Column:
    return F.pmod(F.xxhash64(F.col(entry).cast("string")), F.lit(BUCKETS)).cast("int")


def entry_marks(rows: DataFrame, entry: str) -> DataFrame:
    """(entry, n, low, high): the fingerprint of each entry's rows."""
    return fingerprints(rows, [entry]).select(F.col(entry).cast("string").alias("entry"), "n", "low", "high")


def _fs(spark: SparkSession, path: str):
    """Hadoop's path and the file system that holds it."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _names(spark: SparkSession, path: str) -> list[str]:
    where, fs = _fs(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(where)) if fs.exists(where) else []


def latest(spark: SparkSession, path: str) -> Version:
    """The newest version of a table; number 0 if there is none yet."""
    names = [n for n in _names(spark, f"{path}/versions") if n.endswith(".json")]
    if not names:
        return Version()
    return Version(**json.loads(spark.read.text(f"{path}/versions/{names[-1]}", wholetext=True).first()["value"]))


def _read(spark: SparkSession, path: str, version: Version, kind: str, schema, buckets: list[int] | None) -> DataFrame:
    wanted = version.parts if buckets is None else {str(b): version.parts[str(b)] for b in buckets if str(b) in version.parts}
    folders = [f"{path}/{folder}/{kind}/bucket={b}" for b, folder in wanted.items()]
    if not folders:
        return spark.createDataFrame([], schema)
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(*folders)


def read(spark: SparkSession, path: str, schema=None, buckets: list[int] | None = None, version: Version | None = None) -> DataFrame:
    """Rows of a table, or of some of its buckets, in its newest version or the given one. Without a schema the table must have rows."""
    return _read(spark, path, version or latest(spark, path), "rows", schema, buckets)


def marks(spark: SparkSession, path: str, buckets: list[int] | None = None, version: Version | None = None) -> DataFrame:
    """(entry, n, low, high): the fingerprint of every entry, none of its rows being read."""
    return _read(spark, path, version or latest(spark, path), "marks", f"entry string, {MARKS}", buckets)


def step(name: str) -> None:
    """Called before each step of a load by its name; tests make one fail here."""


def replace(spark: SparkSession, path: str, rows: DataFrame, entry: str, buckets: list[int], own_marks: DataFrame | None = None, batch: tuple[str, int] | None = None) -> Version:
    """A new version with these rows in place of the given buckets; the other buckets stay where they are.

    own_marks: fingerprints of the entries, where they are at hand; batch: the source and the number of what is loaded.
    """
    now, folder = latest(spark, path), f"data/{uuid.uuid4().hex}"
    step("rows")
    rows.withColumn("bucket", bucket(entry)).write.partitionBy("bucket").parquet(f"{path}/{folder}/rows")
    step("marks")
    own_marks = entry_marks(rows, entry) if own_marks is None else own_marks
    own_marks.withColumn("bucket", bucket("entry")).write.partitionBy("bucket").parquet(f"{path}/{folder}/marks")
    there = {n.partition("=")[2] for n in _names(spark, f"{path}/{folder}/rows") if n.startswith("bucket=")}
    parts = {b: f for b, f in now.parts.items() if int(b) not in set(buckets)} | {b: folder for b in there}
    new = Version(now.number + 1, parts, now.batches | ({batch[0]: batch[1]} if batch else {}))
    step("manifest")
    held, fs = _fs(spark, f"{path}/versions/.{uuid.uuid4().hex}")
    out = fs.create(held)
    try:
        out.write(json.dumps(new.__dict__).encode())
    finally:
        out.close()
    step("rename")
    target, _ = _fs(spark, f"{path}/versions/{new.number:012d}.json")
    if fs.exists(target) or not fs.rename(held, target):
        raise RuntimeError(f"version {new.number} of {path} has been made by another load")
    step("expire")
    expire(spark, path)
    return new


def expire(spark: SparkSession, path: str, keep: int = KEPT) -> None:
    """Take away versions before the newest ``keep``, and folders that no version left names, such as those of loads that died."""
    names = [n for n in _names(spark, f"{path}/versions") if n.endswith(".json")]
    used: set[str] = set()
    for name in names[-keep:]:
        used |= set(json.loads(spark.read.text(f"{path}/versions/{name}", wholetext=True).first()["value"])["parts"].values())
    gone = [f"{path}/versions/{n}" for n in names[:-keep]] + [f"{path}/data/{n}" for n in _names(spark, f"{path}/data") if f"data/{n}" not in used]
    for each in gone:
        where, fs = _fs(spark, each)
        fs.delete(where, True)
