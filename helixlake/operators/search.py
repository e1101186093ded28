"""Sequence search: k-mer candidates on diagonals, and ungapped alignments along them. ``chaining`` makes gapped ones of these."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import anchors

CHUNK = 256
HOT = 10_000  # places of a k-mer in the references, above which it is dealt into parts


def kmers(sequences: DataFrame, key: str, sequence: str, k: int) -> DataFrame:
    """(key, pos, kmer) from 1 on. Finding a place in a string takes time in proportion to it, so the string
    is first cut into overlapping chunks."""
    n = F.length(sequence)
    parts = sequences.where(n >= k).select(key, sequence, F.explode(F.sequence(F.lit(0), (n - k).cast("int"), F.lit(CHUNK))).alias("__at"))
    parts = parts.select(key, "__at", F.substring(sequence, F.col("__at") + 1, F.lit(CHUNK + k - 1)).alias("__part"))
    rows = parts.select(key, "__at", "__part", F.explode(F.sequence(F.lit(1), F.length("__part") - k + 1)).alias("__i"))
    return rows.select(key, (F.col("__at") + F.col("__i")).alias("pos"), F.substring("__part", F.col("__i"), F.lit(k)).alias("kmer"))


def candidates(queries: DataFrame, refs: DataFrame, k: int = 12, min_shared: int = 2, max_refs: int | None = None) -> DataFrame:
    """(query, ref, diagonal, shared, qstart, qlast): k-mers that a query and a reference share on one diagonal, the first and the last.

    All k-mers count, found through their anchors (see :mod:`anchors`). A caller who gives ``max_refs`` has k-mers
    that more references hold left out; then each k-mer travels by itself.
    """
    if max_refs is None:
        return anchors.candidates(queries, refs, k, min_shared)
    q, r = kmers(queries, "query", "sequence", k), kmers(refs, "ref", "sequence", k)
    common = r.groupBy("kmer").agg(F.countDistinct("ref").alias("n")).where(F.col("n") > max_refs)
    q = q.join(common, "kmer", "left_anti")
    hot = r.groupBy("kmer").agg(F.ceil(F.count(F.lit(1)) / HOT).alias("parts")).where("parts > 1").join(q.select("kmer"), "kmer", "left_semi")
    parts = F.coalesce("parts", F.lit(1).cast("long"))
    q = q.join(hot, "kmer", "left").withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), parts - 1))).drop("parts")
    r = r.join(hot, "kmer", "left").withColumn("part", F.pmod(F.xxhash64("ref"), parts)).drop("parts")
    met = q.withColumnRenamed("pos", "qpos").join(r.withColumnRenamed("pos", "rpos"), ["kmer", "part"])
    return met.groupBy("query", "ref", (F.col("rpos") - F.col("qpos")).cast("long").alias("diagonal")).agg(F.count(F.lit(1)).alias("shared"), F.min("qpos").alias("qstart"), F.max("qpos").alias("qlast")).where(F.col("shared") >= min_shared)


MISMATCH = 3  # what a mismatch costs, a match gaining one
LEAST = 10  # letters that a query is filled up to with X
HIT = "query {q}, ref {r}, diagonal long, qstart long, qend long, tstart long, tend long, alnlen long, mismatch long, score long, identity double, coverage double, qlen long, qaln string, taln string"


def diagonal_align(candidates: DataFrame, queries: DataFrame, refs: DataFrame) -> DataFrame:
    """The best ungapped local alignment along the diagonal of each candidate (query, ref, diagonal).

    A match gains one, a mismatch costs MISMATCH; of equal sums the one that ends first and, of those, begins
    first is taken. identity: matches over the columns; coverage: columns over the query. Queries of fewer than
    LEAST letters are filled up with X.
    """
    q = queries.select("query", F.when(F.length("sequence") < LEAST, F.rpad("sequence", LEAST, "X")).otherwise(F.col("sequence")).alias("q"))
    both = candidates.select("query", "ref", "diagonal").join(q, "query").join(refs.select("ref", F.col("sequence").alias("t")), "ref")
    kinds = {k: candidates.schema[n].dataType.simpleString() for k, n in (("q", "query"), ("r", "ref"))}

    def codes(x: str) -> np.ndarray:
        return np.frombuffer(x.encode("utf-32-le", "surrogatepass"), np.uint32)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, keep = [], []
            for k, (d, q, t) in enumerate(zip(*(batch.column(c).to_pylist() for c in (2, 3, 4)), strict=True)):
                a = max(0, -d)  # place in the query where the diagonal enters
                n = min(len(q) - a, len(t) - a - d)
                if n <= 0:
                    continue
                same = codes(q)[a : a + n] == codes(t)[a + d : a + d + n]
                total = np.concatenate([[0], np.cumsum(np.where(same, 1, -MISMATCH))])
                low = np.minimum.accumulate(total)
                end = int((total[1:] - low[:-1]).argmax()) + 1
                begin = int(np.flatnonzero(total[:end] == low[end - 1])[0])
                score, length = int(total[end] - low[end - 1]), end - begin
                if score <= 0:
                    continue
                miss = int((~same[begin:end]).sum())
                u, v = a + begin, a + d + begin
                keep.append(k)
                rows.append((d, u + 1, u + length, v + 1, v + length, length, miss, score, (length - miss) / length, length / len(q), len(q), q[u : u + length], t[v : v + length]))
            if keep:
                cols = [pa.array(c) for c in zip(*rows, strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(keep)), batch.column(1).take(pa.array(keep)), *cols], [c.split()[0] for c in HIT.split(", ")])

    return both.select("query", "ref", "diagonal", "q", "t").mapInArrow(run, HIT.format(**kinds))
