"""Mixing sources to target weights by the cube method.

Targets come from the weights by filling: every source gets its share of all words, those that would need
more than three copies of themselves stop there, and what they leave is shared by weight among the others. A
document is then wanted target / size of its source times: the whole part of that for certain, the rest with
that probability. The cube method moves these probabilities through the null space of the constraints (the
number of documents and of words of the source), so both totals stay as they are, until each is 0 or 1 but
for as many as there are constraints.

Documents of a source are dealt into blocks of bounded size, each balanced by one task. What a block leaves
open (two documents at most) goes to the next level, in blocks again, until one block holds a source's rest;
there a dozen documents wait for the landing, which takes of all choices among them and the last two open ones the
one that misses the word total the least. Nothing depends on
the order of rows, so reruns agree.

A null text has no words; a null source is a source of its own and the last one; rows with equal or null ids are
balanced one by one, those with equal texts being interchangeable. Texts are counted in full, however long. A
source without words takes each document as it is. Documents may have columns of any name. An empty table gives
an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, dealt, groups, materialise

WEIGHTS, COPIES = (5, 2, 1), 3
BLOCK = 5000  # documents that one block balances
LANDED = 12  # open documents that are kept for the landing, besides the two that a flight leaves


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, copies: int = COPIES) -> DataFrame:
    """(source, source_size, target) from (source, size); one row for each source, so the windows are small.

    Sources fill up in the order of copies * size / weight; one is full if the rest of the words, shared by
    the weight of those not before it, would give it as much.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").isNull(), F.encode("source", "utf-8"))
    nth = (F.row_number().over(order) - 1) % len(weights)
    per = per.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), nth + 1)).withColumn("most", F.col("source_size") * F.lit(float(copies)))
    ratio, every = [F.col("most") / F.col("weight"), F.col("source").isNull(), F.col("source")], Window.partitionBy()
    before = Window.orderBy(*ratio).rowsBetween(Window.unboundedPreceding, -1)
    onward = Window.orderBy(*ratio).rowsBetween(0, Window.unboundedFollowing)
    left = F.sum("source_size").over(every) - F.coalesce(F.sum("most").over(before), F.lit(0.0))
    full = left * F.col("weight") >= F.col("most") * F.sum("weight").over(onward)
    per = per.withColumn("full", full)
    spare = F.sum("source_size").over(every) - F.sum(F.when(F.col("full"), F.col("most")).otherwise(0.0)).over(every)
    share = F.sum(F.when(F.col("full"), 0.0).otherwise(F.col("weight"))).over(every)
    return per.select("source", "source_size", F.when(F.col("full"), F.col("most")).otherwise(F.col("weight") * F.try_divide(spare, share)).alias("target"))


def flight(p: np.ndarray, size: np.ndarray, u: np.ndarray) -> np.ndarray:
    """Move probabilities of one block along null vectors of (1, size) until two at most are between 0 and 1.

    Three open documents have one null vector; it is followed to the nearer or the farther wall, chosen with
    the probability that keeps each expectation.
    """
    p, eps = p.tolist(), 1e-9
    size = size.tolist()
    live: list[int] = []
    for k in range(len(p)):
        if not eps < p[k] < 1 - eps:
            p[k] = round(p[k])
            continue
        live.append(k)
        if len(live) < 3:
            continue
        a, b, c = live
        v = (size[b] - size[c], size[c] - size[a], size[a] - size[b])
        if not any(v):
            v = (1.0, -1.0, 0.0)
        up = min((1 - p[i]) / d if d > 0 else -p[i] / d for i, d in zip(live, v, strict=True) if d)
        down = min(p[i] / d if d > 0 else (p[i] - 1) / d for i, d in zip(live, v, strict=True) if d)
        step = up if u[k] * (up + down) < down else -down
        for i, d in zip(live, v, strict=True):
            p[i] += step * d
        live = [i for i in live if eps < p[i] < 1 - eps]
        for i in (a, b, c):
            if i not in live:
                p[i] = float(round(p[i]))
    return np.array(p, float)


def landing(p: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Set the last few open documents so that their words come nearest to what they stood for, then their number."""
    open_ = np.flatnonzero((p > 0) & (p < 1))
    words, number = np.zeros(1), np.zeros(1)
    for k in open_:  # subset m of those so far at place m
        words, number = np.concatenate([words, words + size[k]]), np.concatenate([number, number + 1])
    best = np.lexsort((np.abs(number - p[open_].sum()), np.abs(words - (p[open_] * size[open_]).sum())))[0]
    p = p.copy()
    p[open_] = int(best) >> np.arange(len(open_)) & 1
    return p


def settled(p: np.ndarray, size: np.ndarray, u: np.ndarray) -> np.ndarray:
    """The last level: all but LANDED open documents fly, and landing chooses among them and what the flight leaves open."""
    open_ = np.flatnonzero((p > 1e-9) & (p < 1 - 1e-9))
    flying = np.setdiff1d(np.arange(len(p)), open_[max(0, len(open_) - LANDED) :])
    p = p.copy()
    p[flying] = flight(p[flying], size[flying], u[flying])
    return landing(p, size)


def draw(docs: DataFrame, last: bool) -> DataFrame:
    """One level: (key, source, block, size, p) with p moved; the last level lands."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in groups(batches, ["source_key", "block"]):
            size = table.column("size").to_numpy().astype(float)
            p = (settled if last else flight)(table.column("p").to_numpy(), size, table.column("u").to_numpy())
            yield from table.set_column(table.schema.get_field_index("p"), "p", pa.array(p)).combine_chunks().to_batches()

    return dealt(docs, ["source_key", "block"], "u", "row", "size", "print").mapInArrow(run, docs.schema)


def _size(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _print(text: Column) -> Column:
    return F.xxhash64(text)


def mix(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", weights: tuple[int, ...] = WEIGHTS, copies: int = COPIES) -> DataFrame:
    """doc_id, source, size, source_size, target, copies (how often the mix takes the document) and the hash of its text, of every row."""
    sizes = materialise(
        docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(source).alias("source"), _size(F.col(text)).alias("size"), _print(F.col(text)).alias("print")), "sizes"
    )
    per = targets(sizes, weights, copies)
    counts = sizes.groupBy("source").agg(F.count(F.lit(1)).alias("n"))
    per = materialise(per.join(counts, per.source.eqNullSafe(counts.source)).select(per.source.alias("of"), "source_size", "target", "n"), "targets")
    wanted = F.coalesce(F.try_divide(F.col("target"), F.col("source_size").cast("double")), F.lit(1.0))
    # equal rows get ranks through a count of their own, so that their draws differ
    alike = Window.partitionBy("doc_id", "source", "print").orderBy("size")
    rows = (
        sizes.join(per, F.col("source").eqNullSafe(F.col("of")))
        .select("doc_id", "source", "size", "print", "source_size", "target", "n", F.row_number().over(alike).alias("row"))
        .withColumn("whole", F.floor(wanted + F.lit(1e-12)).cast("long"))
        .withColumn("p", F.greatest(F.lit(0.0), wanted - F.floor(wanted + F.lit(1e-12))))
        .withColumn("source_key", F.xxhash64(F.coalesce("source", F.lit("")), F.col("source").isNull()))
        .withColumn("u", F.pmod(F.xxhash64("doc_id", "print", "row", F.lit("u")), F.lit(1 << 30)) / F.lit(float(1 << 30)))
        .withColumn("blocks", F.ceil(F.col("n") / F.lit(BLOCK)))
        .withColumn("block", F.pmod(F.xxhash64("doc_id", "print", "row", F.lit("b")), F.col("blocks")))
    )
    done, level = None, 0
    blocks = max([r[0] for r in per.agg(F.max(F.ceil(F.col("n") / F.lit(BLOCK)))).collect() if r[0]], default=1)
    rows = rows.drop("n")
    while True:
        rows = materialise(draw(rows, last=blocks <= 1), f"level{level}")
        settled = rows.where("p = 0 OR p = 1")
        done = settled if done is None else done.unionByName(settled)
        if blocks <= 1:
            break
        level += 1
        blocks = -(-2 * blocks // BLOCK)  # two open documents of each block
        rows = rows.where("p > 0 AND p < 1").withColumn("blocks", F.ceil(F.col("blocks") * 2 / F.lit(BLOCK))).withColumn("block", F.pmod(F.xxhash64("doc_id", "print", "row", F.lit(f"b{level}")), F.col("blocks")))
    return done.select("doc_id", "source", "size", "source_size", "target", (F.col("whole") + F.col("p").cast("long")).alias("copies"), "print", "row")


def mixed(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """The documents, each as often as the mix takes it, with their own columns."""
    key = ["id", "source", "print"]
    take = mix(docs, doc_id, text, source).withColumnRenamed("doc_id", "id").groupBy(*key).agg(F.sum("copies").alias("copies"), F.count(F.lit(1)).alias("alike"))
    own = docs.select(F.struct("*").alias("doc"), F.col(doc_id).cast("long").alias("id"), F.col(source).alias("source"), _print(F.col(text)).alias("print"))
    same = [own[c].eqNullSafe(take[c]) for c in key]
    joined = own.join(take, same[0] & same[1] & same[2]).select("doc", *[own[c] for c in key], "copies", "alike")
    # rows that agree in id, source and text share their copies out, the first ones getting one more
    nth = F.when(F.col("alike") > 1, F.row_number().over(Window.partitionBy(*key).orderBy("doc"))).otherwise(1)
    each = F.floor(F.col("copies") / F.col("alike")).cast("long") + F.when(nth <= F.col("copies") % F.col("alike"), 1).otherwise(0)
    return joined.withColumn("n", each).where("n > 0").select("doc", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n")))).select("doc.*")
