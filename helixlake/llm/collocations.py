"""Phrase collocation mining from sorted count streams.

Counting. Words are numbered by 64-bit hashes, which are checked: should two words of a group share one, all are
hashed anew with another seed. Single words and pairs are counted first. Then every place at which a pair of
enough occurrences begins opens a window of up to four words, as far as its pairs go on to be frequent; a word or
pair that is rare cannot be part of a frequent phrase. Whether a pair is frequent a task reads off a bitmap of
bounded size made of the frequent pairs, which may let a rare pair through, but never holds back a frequent one:
counts are exact, and beyond that size more windows travel. Windows are dealt by ranges and sorted, which is the
prefix order: a phrase of k words is a run of windows with these first words, and its count is the run's sum. Runs
inside a batch are done there; only those at its ends are added up across tasks, so no word or pair gathers anywhere.

Joining. The counts are kept in prefix order (first words first) and in suffix order (last words first), and are
joined by sorting and merging: a phrase with the counts of its first parts in the one, with those of its last parts
in the other, and with the largest count of a phrase that is one word longer, on its right and on its left. Longer
ones than that need no look: what holds a phrase within two more words has a part one word longer that is at
least as frequent.

Null texts are empty, null groups are 'und', and texts without words count nothing. Repeated rows count again. Texts
may be of any length. An empty table gives an empty result; columns beyond the two named ones are not read.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import coefficients, dealt, materialise, merged, mix, put_file, slices, text_bytes, word_hashes, word_spans

LEAST, LONGEST, TOP = 30, 4, 2000
CONTAINED = 80  # per cent of its count at which a longer phrase takes a shorter one's place
MAX_BITS = 28  # the bitmap of frequent pairs has 2^28 bits at most, 32 MB; 32 for each pair below that
BLOCK_BITS = 15
SALTS = 32
#: Distinct words and pairs that a task holds before it passes their counts on, and bytes of text that it takes at a time.
HELD, SLICE = 400_000, 1 << 20
_U = np.uint64
_BREAK, _GAP = np.zeros(256, bool), np.zeros(256, bool)
_BREAK[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
_GAP[[0x20, 0x09]] = True
_GAP |= _BREAK
WORDS = [f"h{k}" for k in range(1, LONGEST + 1)]


class Pieces:
    """The words of a slice of texts, by hash, and whether each goes on to the next one in the same piece."""

    def __init__(self, column: pa.Array, group: np.ndarray, seed: int):
        self.data, offsets = text_bytes(column)
        self.starts, self.ends, first = word_spans(self.data, offsets, _GAP)
        self.words = word_hashes(self.data, self.starts, self.ends, seed) | _U(1)  # 0 stands for no word
        self.group = np.repeat(group, np.diff(first))
        breaks = np.concatenate([[0], np.cumsum(_BREAK[self.data])])[self.starts] if len(self.data) else np.zeros(0, np.int64)
        doc = np.repeat(np.arange(len(group)), np.diff(first))
        self.goes_on = np.zeros(len(self.words), bool)
        self.goes_on[:-1] = (doc[1:] == doc[:-1]) & (breaks[1:] == breaks[:-1])

    def pairs(self) -> np.ndarray:
        """A hash of each word with the next one and the group; 0 where its piece ends."""
        out = np.zeros(len(self.words), _U)
        a, b, c = coefficients(3, 31)
        out[:-1] = mix(self.words[:-1] * a + self.words[1:] * b + mix(self.group[:-1].astype(_U) + c))
        out[~self.goes_on] = 0
        return out

    def letters(self, k: int) -> str:
        word = bytes(self.data[self.starts[k] : self.ends[k]])
        return bytes(b + 32 if 65 <= b <= 90 else b for b in word).decode("utf-8", "replace")


def summed(keys: list[np.ndarray], n: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Distinct rows of ``keys``, in order, with the sums of n."""
    order = np.lexsort(keys[::-1])
    keys, n = [k[order] for k in keys], n[order]
    new = np.ones(len(n), bool)
    new[1:] = False
    for k in keys:
        new[1:] |= k[1:] != k[:-1]
    at = np.flatnonzero(new)
    return [k[at] for k in keys], np.add.reduceat(n, at) if len(at) else n


def counts(texts: DataFrame, seed: int) -> DataFrame:
    """(g, pair, h, n, low, high): how often each word and pair of a group g occurs; low and high: second hashes of a word, which differ if words share h."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = []

        def flush() -> pa.RecordBatch:
            cols = [np.concatenate(c) for c in zip(*held, strict=True)] if held else [np.zeros(0, np.int64) for _ in range(5)]
            held.clear()
            keys, n = summed(cols[:4], cols[4])
            g, pair, h, other = keys
            return pa.RecordBatch.from_arrays([pa.array(g.astype(np.int64)), pa.array(pair.astype(bool)), *(pa.array(c.astype(np.uint64).view(np.int64)) for c in (h, other)), pa.array(n)], ["g", "pair", "h", "other", "n"])

        size = 0
        for part in slices(batches, "text", SLICE):
            p = Pieces(part.column(1), part.column(0).to_numpy(), seed)
            if not len(p.words):
                continue
            pairs = p.pairs()
            met = np.flatnonzero(pairs)
            other = word_hashes(p.data, p.starts, p.ends, seed + 1_000_003)
            rows = ((p.group, np.zeros(len(p.words), np.int64), p.words, other), (p.group[met], np.ones(len(met), np.int64), pairs[met], np.zeros(len(met), _U)))
            for keys in rows:
                k, n = summed(list(keys), np.ones(len(keys[0]), np.int64))
                held.append([*k, n])
                size += len(n)
            if size > HELD:
                yield flush()
                size = 0
        yield flush()

    made = texts.mapInArrow(run, "g long, pair boolean, h long, other long, n long")
    return made.groupBy("g", "pair", "h").agg(F.sum("n").alias("n"), F.min("other").alias("low"), F.max("other").alias("high"))


def bitmap(pairs: DataFrame) -> tuple[bytes, int]:
    """The bits of the frequent pairs (h), 2^bits of them; each task sets the bits of its blocks."""
    n = pairs.count()
    bits = min(MAX_BITS, max(BLOCK_BITS, (32 * n).bit_length()))
    place = F.shiftrightunsigned("h", 64 - bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks: dict[int, np.ndarray] = {}
        for batch in batches:
            at = batch.column(0).to_numpy()
            for k in np.unique(at >> BLOCK_BITS).tolist():
                own = blocks.setdefault(k, np.zeros(1 << BLOCK_BITS, bool))
                own[at[at >> BLOCK_BITS == k] & ((1 << BLOCK_BITS) - 1)] = True
        yield pa.RecordBatch.from_arrays([pa.array(list(blocks), pa.int64()), pa.array([np.packbits(b).tobytes() for b in blocks.values()], pa.binary())], ["block", "bits"])

    made = pairs.select(place.alias("at"), F.shiftright(place, BLOCK_BITS).alias("block"))
    spread = made.repartition(int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions")), "block").select("at").mapInArrow(run, "block long, bits binary")
    out = np.zeros((1 << (bits - BLOCK_BITS), (1 << BLOCK_BITS) // 8), np.uint8)
    for r in spread.collect():  # 2^MAX_BITS bits at most
        out[r["block"]] = np.frombuffer(r["bits"], np.uint8)
    return out.tobytes(), bits


@lru_cache(maxsize=1)
def bits_of(path: str) -> np.ndarray:
    return np.asarray(np.memmap(path, np.uint8, "r"))


def windows(texts: DataFrame, seed: int, file: str, bits: int) -> DataFrame:
    """(g, h1 to h4, n, word): windows of two to four words whose pairs all may be frequent, 0 behind their end; and, with n 0, the letters of each word h1 in one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent, known = bits_of(SparkFiles.get(file)), set()
        for part in slices(batches, "text", SLICE):
            p = Pieces(part.column(1), part.column(0).to_numpy(), seed)
            pairs = p.pairs()
            at = (pairs >> _U(64 - bits)).astype(np.int64)
            on = (pairs != 0) & (frequent[at >> 3] >> (7 - (at & 7)).astype(np.uint8) & 1).astype(bool)
            first = np.flatnonzero(on)
            if not len(first):
                continue
            cols, going = [p.group[first].astype(_U), p.words[first], p.words[first + 1]], np.ones(len(first), bool)
            for k in range(2, LONGEST):
                beyond = np.minimum(first + k - 1, len(on) - 1)
                going &= on[beyond]
                cols.append(np.where(going, p.words[np.minimum(first + k, len(on) - 1)], _U(0)))
            keys, n = summed(cols, np.ones(len(first), np.int64))
            inside = np.unique(np.concatenate([first, first + 1]))
            inside = inside[np.lexsort((p.words[inside], p.group[inside]))]
            values, group = p.words[inside], p.group[inside]
            change = np.ones(len(inside), bool)
            change[1:] = (values[1:] != values[:-1]) | (group[1:] != group[:-1])
            inside, values, group = inside[change], values[change], group[change]
            new = [k for k, x in enumerate(zip(values.tolist(), group.tolist(), strict=True)) if x not in known]
            known.update((int(values[k]), int(group[k])) for k in new)
            letters = [p.letters(inside[k]) for k in new]
            as_long = lambda x: pa.array(x.astype(_U).view(np.int64))
            yield pa.RecordBatch.from_arrays([*map(as_long, keys), pa.array(n), pa.nulls(len(n), pa.string())], ["g", *WORDS, "n", "word"])
            if new:
                none = np.zeros(len(new), np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(group[new].astype(np.int64)), as_long(values[new]), *(pa.array(none) for _ in range(LONGEST)), pa.array(letters)], ["g", *WORDS, "n", "word"])

    return texts.mapInArrow(run, "g long, h1 long, h2 long, h3 long, h4 long, n long, word string")


def prefix_counts(rows: DataFrame, least: int) -> DataFrame:
    """(g, size, h1 to h4, n) of the phrases of two words or more with n of at least ``least``, from windows dealt by ranges and sorted: runs of first words.

    A run that a batch holds whole is complete; the first and the last of a batch may go on in another.
    """
    keys = ["g", *WORDS]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            cols, n = [batch.column(k).to_numpy() for k in range(len(keys))], batch.column(len(keys)).to_numpy()
            new = np.zeros(len(n), bool)
            new[0] = True
            new[1:] = (cols[0][1:] != cols[0][:-1]) | (cols[1][1:] != cols[1][:-1])
            for size in range(2, LONGEST + 1):
                new[1:] |= cols[size][1:] != cols[size][:-1]
                at = np.flatnonzero(new)
                total = np.add.reduceat(n, at)
                keep = total >= least
                keep[[0, -1]] = True
                keep &= cols[size][at] != 0  # a window that has ended before has no such phrase
                at, total = at[keep], total[keep]
                words = [pa.array(cols[k][at] if k <= size else np.zeros(len(at), np.int64)) for k in range(1, LONGEST + 1)]
                yield pa.RecordBatch.from_arrays([pa.array(cols[0][at]), pa.array(np.full(len(at), size)), *words, pa.array(total)], ["g", "size", *WORDS, "n"])

    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    streams = rows.select(*keys, "n").repartitionByRange(n, *keys).sortWithinPartitions(*keys)
    found = streams.mapInArrow(run, "g long, size long, h1 long, h2 long, h3 long, h4 long, n long")
    return found.groupBy("g", "size", *WORDS).agg(F.sum("n").alias("n")).where(F.col("n") >= least)


def _part(size: Column, begin: Column | int, reverse: bool) -> list[Column]:
    """The words of a part of a phrase, from ``begin`` (0 on) on and ``size`` many, first or last word first, 0 behind them."""
    words = F.array(*WORDS)
    at = lambda k: (F.lit(begin) if isinstance(begin, int) else begin) + (size - 1 - k if reverse else k)
    return [F.when(F.lit(k) < size, F.get(words, at(k).cast("int"))).otherwise(F.lit(0)).cast("long").alias(f"w{k + 1}") for k in range(LONGEST)]


def stream(phrases: DataFrame, reverse: bool) -> DataFrame:
    """(g, w1 to w4, n): the counts in prefix order, or in suffix order, the last word first."""
    keys = ["g", *[f"w{k}" for k in range(1, LONGEST + 1)]]
    rows = phrases.select("g", *_part(F.col("size"), 0, reverse), "n")
    return materialise(dealt(rows, keys), "suffix" if reverse else "prefix")


def scored(phrases: DataFrame) -> DataFrame:
    """(g, size, h1 to h4, a, l, r, score, longer): every phrase of two words or more with its lowest-scoring cut, and the largest count of a phrase one word longer."""
    keys = ["g", *[f"w{k}" for k in range(1, LONGEST + 1)]]
    prefix, suffix = stream(phrases, False), stream(phrases, True)
    own = phrases.where("size > 1")
    cuts = own.withColumn("k", F.explode(F.sequence(F.lit(1).cast("long"), F.col("size") - 1)))
    cuts = materialise(merged(cuts.select("*", *_part(F.col("k"), 0, False)), prefix.withColumnRenamed("n", "l"), keys).drop(*keys[1:]), "cuts")
    cuts = merged(cuts.select("*", *_part(F.col("size") - F.col("k"), F.col("k"), True)), suffix.withColumnRenamed("n", "r"), keys).drop(*keys[1:])
    score = F.expr("(CAST(2000000 AS DECIMAL(38, 0)) * CAST(n AS DECIMAL(20, 0))) DIV (CAST(l AS DECIMAL(20, 0)) + CAST(r AS DECIMAL(20, 0)))").alias("score")
    best = cuts.withColumn("score", score).groupBy("g", "size", *WORDS, F.col("n").alias("a")).agg(F.min(F.struct("score", "k", "l", "r")).alias("b"))
    one = own.where("size > 2")
    first = one.select("g", *_part(F.col("size") - 1, 0, False), "n")
    last = one.select("g", *_part(F.col("size") - 1, 1, False), "n")
    longer = first.union(last).groupBy(*keys).agg(F.max("n").alias("longer"))
    best = merged(best.select("*", *_part(F.col("size"), 0, False)), longer, keys, "left")
    return best.select("g", "size", *WORDS, "a", "b.l", "b.r", "b.score", "longer")


def collocations(docs: DataFrame, group: str, text: str = "text", least: int = LEAST, top: int = TOP) -> DataFrame:
    """group, rank, phrase, a, l, r, n and score of the first ``top`` phrases of each group."""
    spark = docs.sparkSession
    name = F.coalesce(F.col(group).cast("string"), F.lit("und"))
    # groups are told by a number, so that streams are of numbers alone; a hash would do, but is checked to be one
    names = materialise(docs.select(name.alias("name")).distinct().withColumn("g", F.xxhash64("name")), "groups")
    if names.groupBy("g").count().where("count > 1").limit(1).count():
        raise ValueError("two groups share a hash")
    texts = docs.select(F.xxhash64(name).alias("g"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    seed = 0
    while True:
        found = materialise(counts(texts, seed).where((F.col("n") >= least) | ~F.col("pair")), "counts")
        if found.where("low <> high").isEmpty():
            break
        seed += 1
    content, bits = bitmap(found.where(f"pair AND n >= {least}").select("h"))
    where = put_file(spark, f"pairs-{uuid.uuid4().hex}.bin", content)
    spark.sparkContext.addFile(where)
    made = materialise(windows(texts, seed, where.rsplit("/", 1)[-1], bits), "windows")
    single = found.where(~F.col("pair") & (F.col("n") >= least)).select("g", F.lit(1).cast("long").alias("size"), F.col("h").alias("h1"), *[F.lit(0).cast("long").alias(c) for c in WORDS[1:]], "n")
    phrases = materialise(prefix_counts(made.where("word IS NULL"), least).unionByName(single), "phrases")
    best = scored(phrases).where(f"longer IS NULL OR 100 * longer < {CONTAINED} * a")
    letters = materialise(made.where("word IS NOT NULL").select("g", "h1", "word").distinct(), "letters")
    for k, c in enumerate(WORDS):
        own = letters.select("g", F.col("h1").alias(c), F.col("word").alias(f"t{k}"))
        best = best.join(own, ["g", c], "left")
    best = best.select("g", F.concat_ws(" ", *[f"t{k}" for k in range(LONGEST)]).alias("phrase"), "a", "l", "r", "score")
    order = [F.desc("score"), F.desc("a"), "phrase"]
    nth = lambda *by: F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    some = best.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS))).withColumn("rank", nth("g", "salt")).where(F.col("rank") <= top).drop("rank", "salt")
    first = some.withColumn("rank", nth("g")).where(F.col("rank") <= top)
    total = found.where(~F.col("pair")).groupBy("g").agg(F.sum("n").alias("total")).join(names, "g")
    return first.join(total, "g").select(F.col("name").alias(group), F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", F.col("total").alias("n"), "score")
