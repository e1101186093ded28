"""What the training-data operators share: folds, scratch tables, Arrow slices and word hashes."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextvars import ContextVar

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

#: A word is a run of anything but space, tab, line feed, vertical tab, form feed and carriage return.
WORD = r"[^\x20\x09-\x0D]+"
SLICE_BYTES = 4 << 20
#: One owner in SAMPLE tells which keys are hot, of which there are SHARES at most; each is counted in SALTS parts.
SAMPLE, SHARES, SALTS = 64, 10_000, 64
#: Whether Spark removes the shuffle files of a query when it ends, not only when the driver collects its garbage.
FREED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

#: The tables that are written inside of :func:`settled`.
_written: ContextVar[list[str] | None] = ContextVar("written", default=None)
_WS = np.zeros(256, bool)
_WS[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_U = np.uint64


def fold(column: str, mod: int) -> Column:
    """crc32 of the id as text, modulo ``mod``; a null id falls in fold 0."""
    return F.coalesce(F.crc32(F.col(column).cast("string")), F.lit(0)) % mod


def bounded(df: DataFrame, key: str, most: int) -> DataFrame:
    """A repeatable sample of about ``most`` rows: those whose hashed key falls under most / count."""
    n = df.count()
    if n <= most:
        return df
    return df.where(F.pmod(F.xxhash64(F.col(key), F.lit("sample")), F.lit(1 << 30)) < int((1 << 30) * most / n))


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors see; one is made up only on a single machine, for tests."""
    where = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not where:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors see")
        where = "file://" + tempfile.mkdtemp(prefix="helixlake-")
        spark.conf.set("spark.checkpoint.dir", where)
    return where.rstrip("/")


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back: lineage ends here, and what it has shuffled is freed."""
    spark, path = df.sparkSession, f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    was = spark.conf.get(FREED, "false")
    spark.conf.set(FREED, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(FREED, was)
    if (written := _written.get()) is not None:
        written.append(path)
    return spark.read.schema(df.schema).parquet(path)


def settled(make: Callable[[], DataFrame], name: str) -> DataFrame:
    """materialise(make()); the tables that ``make`` has written on the way are deleted then, as nothing reads them any more."""
    outer = _written.set([])
    try:
        df = make()
        passing = _written.get()
    finally:
        _written.reset(outer)
    out = materialise(df, name)
    jvm, conf = out.sparkSession._jvm, out.sparkSession._jsc.hadoopConfiguration()
    for path in passing:
        where = jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(conf).delete(where, True)
    return out


def put_file(spark: SparkSession, name: str, content: bytes) -> str:
    """Write a small file to the shared folder by Hadoop's file system, whatever its kind; returns its path."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(f"{shared_folder(spark)}/{name}")
    out = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(path)
    try:
        out.write(content)
    finally:
        out.close()
    return path.toString()


def merged(left: DataFrame, right: DataFrame, on: str | list[str], how: str = "inner") -> DataFrame:
    """A join by sorting and merging at any size: for sides that grow with the corpus, so the plan that is tried is the one that scales."""
    return left.join(right.hint("merge"), on, how)


def in_one_task(rows: DataFrame, work: Callable[[pa.Table], bytes]) -> bytes:
    """work(rows), done by one task: for samples of bounded size, so that the driver holds the outcome alone."""
    empty = pa.RecordBatch.from_pylist([], to_arrow_schema(rows.schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        yield pa.RecordBatch.from_arrays([pa.array([work(pa.Table.from_batches(held or [empty]))], pa.binary())], ["made"])

    made = rows.repartition(1).mapInArrow(run, "made binary").first()
    return bytes(made[0]) if made else work(pa.Table.from_batches([empty]))


def told(owner: str) -> Column:
    """The one owner in SAMPLE that tells which keys are hot."""
    return F.pmod(F.xxhash64(owner, F.lit("hot")), F.lit(SAMPLE)) == 0


def hot_keys(some: DataFrame, key: str) -> DataFrame:
    """(key, __hot): the keys of very many rows, SHARES at most, with an estimate of how many; ``some`` are the rows of the owners that :func:`told` picks."""
    often = materialise(some.groupBy(key).agg(F.count(F.lit(1)).alias("__n")).where("__n >= 16"), "often")
    least = (often.agg(F.sum("__n")).first()[0] or 0) / SHARES
    return often.where(F.col("__n") >= least).select(key, (F.col("__n") * SAMPLE).alias("__hot"))


def counted(rows: DataFrame, some: DataFrame, key: str, owner: str, more: dict[str, Column]) -> DataFrame:
    """rows with n, how many of its rows a key has, and further aggregates over the key, each under its name.

    ``some`` are the rows of the owners that :func:`told` picks. They tell the keys of very many rows, no more
    than SHARES, so those are shipped to all tasks. Such a key is counted in SALTS parts, for no task has to hold
    it whole; its n is the estimate, the same on all of its rows, and its further aggregates are null.
    """
    hot = hot_keys(some, key)
    w = Window.partitionBy(key, F.when(F.col("__hot").isNotNull(), F.pmod(F.xxhash64(owner), F.lit(SALTS))))
    found = rows.join(F.broadcast(hot), key, "left")  # SHARES rows at most
    every = [F.when(F.col("__hot").isNull(), c.over(w)).alias(name) for name, c in more.items()]
    return found.select(*rows.columns, F.coalesce("__hot", F.count(F.lit(1)).over(w)).alias("n"), *every)


def most_frequent(counts: DataFrame, most: int) -> DataFrame:
    """Of counts (.., n) those of the largest n, ``most`` rows at most; rows of like counts go together.

    The bound comes from a histogram of 64 classes for each doubling: a top-k would gather k rows of every task.
    """
    classed = counts.withColumn("__like", F.floor(F.log2("n") * 64))
    taken, least = 0, 1 << 30
    for r in classed.groupBy("__like").agg(F.count(F.lit(1)).alias("c")).orderBy(F.desc("__like")).collect():
        taken += r["c"]
        if taken > most:
            break
        least = r["__like"]
    return classed.where(F.col("__like") >= least).drop("__like")


def parted(rows: DataFrame, key: str, owner: str, most: int) -> DataFrame:
    """rows with part: a key of n rows is dealt into parts of about ``most``, each key in a way of its own."""
    return rows.withColumn("part", F.pmod(F.xxhash64(owner, key), F.ceil(F.col("n") / most).cast("long")))


def across(rows: DataFrame, key: str, owner: str, most: int) -> DataFrame:
    """rows (key, owner, label, ...) under the pairs of parts (p, q) in which rows of different labels meet.

    Only keys with several labels are left. Rows outside a key's largest label are few, as a rule; they are the
    ones that ask: those of part p meet all rows of part q. With m that ask among n, a row is copied
    m / most + 1 times and one that asks n / most + 1 times more, so a group that has become one label costs
    nothing and a stray row in it little. ``asks`` says which.
    """
    per = rows.groupBy(key, "label").agg(F.count(F.lit(1)).alias("__c"))
    per = per.groupBy(key).agg(F.sum("__c").alias("__n"), F.max_by("label", F.struct("__c", "label")).alias("__main"), F.max("__c").alias("__c"))
    per = per.where("__n > __c").select(key, "__main", F.ceil((F.col("__n") - F.col("__c")) / most).cast("long").alias("__a"), F.ceil(F.col("__n") / most).cast("long").alias("__b"))
    found = rows.join(per, key).withColumn("__asks", F.col("label") != F.col("__main"))
    own = F.xxhash64(owner, F.lit(2))
    every = lambda n, asks: F.transform(F.sequence(F.lit(0).cast("long"), n - 1), asks)
    met = every(F.col("__a"), lambda p: F.struct(p.alias("p"), F.pmod(own, F.col("__b")).alias("q"), F.lit(False).alias("asks")))
    ask = every(F.col("__b"), lambda q: F.struct(F.pmod(own, F.col("__a")).alias("p"), q.alias("q"), F.lit(True).alias("asks")))
    # in its own pair of parts a row that asks is there once, asking
    both = F.concat(ask, F.filter(met, lambda x: x.p != F.pmod(own, F.col("__a"))))
    return found.select(*rows.columns, F.explode(F.when(F.col("__asks"), both).otherwise(met)).alias("__x")).select(*rows.columns, "__x.p", "__x.q", "__x.asks")


def slices(batches: Iterator[pa.RecordBatch], text: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that the texts of each piece stay near ``most`` bytes (one row at least)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        column = batch.column(batch.schema.get_field_index(text))
        _, offsets = text_bytes(column)
        start = 0
        while start < batch.num_rows:
            end = max(start + 1, int(np.searchsorted(offsets, offsets[start] + most, side="right")) - 1)
            yield batch.slice(start, end - start)
            start = end


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column and the n + 1 offsets of its rows; a null is an empty text."""
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    n = len(column)
    offsets = np.frombuffer(column.buffers()[1], np.int64, n + 1, column.offset * 8)
    if column.buffers()[2] is None:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    data = np.frombuffer(column.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64 over unsigned 64-bit values."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def coefficients(n: int, seed: int = 0) -> np.ndarray:
    """n odd pseudo-random 64-bit numbers, the same in every process."""
    return mix((np.arange(n, dtype=_U) + _U(1)) * _U(0x9E3779B97F4A7C15) + _U(seed)) | _U(1)


def word_spans(data: np.ndarray, offsets: np.ndarray, gap: np.ndarray = _WS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each word, and the first word of each document (n + 1 values); gap: which bytes part words."""
    solid = np.empty(len(data) + 1, bool)
    solid[-1] = False
    np.logical_not(gap[data], out=solid[:-1])
    cut = np.zeros(len(data) + 1, bool)
    cut[offsets] = True
    begin = solid[:-1].copy()
    begin[1:] &= ~solid[:-2] | cut[1:-1]
    end = solid[:-1] & (~solid[1:] | cut[1:])
    starts, ends = np.flatnonzero(begin), np.flatnonzero(end) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 0) -> np.ndarray:
    """A 64-bit multilinear hash of each word, A-Z as a-z."""
    if not len(starts):
        return np.zeros(0, _U)
    lens = ends - starts
    first = np.cumsum(lens) - lens
    place = np.arange(int(lens.sum())) - np.repeat(first, lens)
    letters = _LOWER[data[place + np.repeat(starts, lens)]].astype(_U) + _U(1)
    letters *= coefficients(int(lens.max()), seed)[place]
    return mix(np.add.reduceat(letters, first) + lens.astype(_U))


#: Sets a whole short sequence apart from a shingle of full width.
_SHORT = coefficients(64, 5)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, width: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct hashes of the word shingles of each document, and n + 1 offsets.

    A document of fewer words has its whole sequence as its only shingle; one without words has none.
    """
    starts, ends, first = word_spans(data, offsets)
    words = word_hashes(data, starts, ends)
    n = np.diff(first)
    factors = coefficients(width, 77)
    full = np.zeros(len(words), _U)
    for j in range(width):
        full[: len(words) - j] += words[j:] * factors[j]
    full = mix(full)
    count = np.where(n >= width, n - width + 1, (n > 0).astype(n.dtype))
    base = np.concatenate([[0], np.cumsum(count)])
    take = np.arange(base[-1]) - np.repeat(base[:-1] - first[:-1], count)
    out = full[take]
    for d in np.flatnonzero((n > 0) & (n < width)):
        w = words[first[d] : first[d + 1]]
        out[base[d] : base[d] + 1] = mix(np.add.reduce(w * factors[: len(w)], keepdims=True) + _SHORT[len(w) : len(w) + 1])
    for a, b in zip(base[:-1], base[1:], strict=True):
        if b - a > 1:
            out[a:b].sort()
    keep = np.ones(len(out), bool)
    keep[1:] = out[1:] != out[:-1]
    keep[base[:-1][count > 0]] = True
    kept = np.concatenate([[0], np.cumsum(keep)])
    return out[keep], kept[base]


def groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Runs of equal keys in sorted batches, one after the other, across batch borders."""
    held: list[pa.Table] = []
    last: tuple | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        cols = [table.column(k).to_numpy(zero_copy_only=False) for k in keys]
        change = np.zeros(batch.num_rows, bool)
        for c in cols:
            change[1:] |= c[1:] != c[:-1]
        head = tuple(c[0] for c in cols)
        change[0] = last is not None and head != last
        edges = [0, *np.flatnonzero(change).tolist()] if not change[0] else np.flatnonzero(change).tolist()
        edges.append(batch.num_rows)
        for a, b in zip(edges[:-1], edges[1:], strict=True):
            if change[a] and held:
                yield pa.concat_tables(held)
                held = []
            held.append(table.slice(a, b - a))
        last = tuple(c[-1] for c in cols)
    if held:
        yield pa.concat_tables(held)


def dealt(df: DataFrame, keys: list[str], *sort: str) -> DataFrame:
    """Rows of a key together and in order, for :func:`groups`."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(n, *keys).sortWithinPartitions(*keys, *sort)


def components(links: DataFrame) -> DataFrame:
    """(node, label) of every node of the links (a, b); label is the smallest node it reaches.

    Labels spread along links and jump to their own label's label, so the number of rounds follows the
    logarithm of the longest chain. Each round ends in a table in the shared folder.
    """
    edges = materialise(
        links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a <> b").distinct(), "edges"
    )
    labels = materialise(edges.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("a")).alias("label")), "labels")
    while True:
        near = (
            edges.join(labels.select(F.col("node").alias("b"), "label"), "b")
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("label").alias("near"))
        )
        step = labels.join(near, "node").select("node", F.least("label", "near").alias("next"), F.col("label").alias("was"))
        jump = labels.select(F.col("node").alias("next"), F.col("label").alias("far"))
        grown = materialise(
            step.join(jump, "next", "left").select("node", F.least("next", F.coalesce("far", "next")).alias("label"), "was"), "labels"
        )
        labels = grown.select("node", "label")
        if grown.where("label <> was").isEmpty():
            return labels
