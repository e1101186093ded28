"""N-gram Jaccard join: which documents share at least four fifths of their five-word shingles.

Method: a count-vector R-tree. Shingles are hashed into groups, the counts by group make a document a point,
and the sum of coordinate minima of two points (or of the upper corners of two tree nodes) bounds the
overlap of their sets from above; pairs that survive are verified on the sets themselves.

One tree over everything would not prune: its bound is shared out over all coordinates, so wide nodes never
part. Documents are therefore first dealt into cells, in which every linked pair meets: with sets sorted by
one fixed order, rare shingles first, two sets that are similar enough share a shingle among the first
n - ceil(0.8 n) + 1 of each. Each cell gets a small R-tree of its own. A cell of many documents is dealt
into pairs of parts, so none outgrows a task. Documents with equal sets stand in for one another from the
start.

The cells are read twice. A first look takes a few cells of each document, large ones in parts, and gives each
document the smallest partner there that the bound leaves it; these pairs are verified, and what they connect
becomes one component. A group of copies is one component then, as a rule. The second look takes every cell
that still holds several components and all pairs across them that the bound leaves, and verifies those: one
by one, or, where a cell has very many, within the cell, which its documents then reach with their texts. In a
large cell only the documents outside its largest component meet all others, part by part. So a large group
of copies costs rows in proportion to it, and no link between components is lost.

Nulls: a null or empty text, or one without words, has the empty set and links with nothing; rows with a
null doc_id are returned with a null component. Rows that share a doc_id count as linked. A text of fewer
than five words has its whole sequence as its one shingle. Tables may be empty; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import across, components, counted, dealt, groups, in_one_task, materialise, merged, mix, most_frequent, parted, shingle_sets, slices, text_bytes, told

WIDTH, SIMILARITY = 5, 80  # words of a shingle; per cent
GROUPS, MOST_GROUPS = 256, 4096  # coordinates of a point: half as many as shingles, within these
PAGE = 32  # points of a leaf, and children of a node
CELL = 1500  # documents of a cell, above which it is dealt into parts
FIRST = 4  # cells of a document that the first look takes
FEW = 4  # pairs for each document of a cell that are verified one by one
OFTEN = 1 << 19  # shingles of the table of frequencies: 5 MB, whatever the input
_U = np.uint64


def frequent_shingles(docs: DataFrame, text: str) -> tuple[np.ndarray, np.ndarray]:
    """The most frequent shingles, sorted, and for each four times the logarithm of how often it was met.

    It sets the order of shingles alone; any table gives the same links. One text in SAMPLE is read, each distinct
    one once, so a shingle of some two hundred documents is met three times and counts as frequent.
    """

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            yield pa.RecordBatch.from_arrays([pa.array(shingle_sets(*text_bytes(part.column(0)), WIDTH)[0].view(np.int64))], ["s"])

    def packed(table: pa.Table) -> bytes:
        found, n = table.column("s").to_numpy().view(_U), table.column("n").to_numpy().astype(np.float64)
        order = np.argsort(found)
        return found[order].tobytes() + (4 * np.log2(n[order])).astype(np.uint8).tobytes()

    some = docs.select(F.col(text).alias("text")).where(told("text")).distinct()
    counts = materialise(some.mapInArrow(spread, "s long").groupBy("s").agg(F.count(F.lit(1)).alias("n")).where("n >= 3"), "often")
    made = in_one_task(most_frequent(counts, OFTEN), packed)
    n = len(made) // 9
    return np.frombuffer(made, _U, n), np.frombuffer(made, np.uint8, n, 8 * n)


def sketches(docs: DataFrame, often: tuple[np.ndarray, np.ndarray], doc_id: str, text: str) -> DataFrame:
    """doc_id, n_shingles, fingerprint of the set (16 bytes), its point and the prefix: the shingles that make its cells."""
    shipped = docs.sparkSession.sparkContext.broadcast(often)  # OFTEN shingles at most

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, rank = shipped.value
        for part in slices(batches, text):
            found, at = shingle_sets(*text_bytes(part.column(1)), WIDTH)
            place = np.minimum(np.searchsorted(known, found), len(known) - 1) if len(known) else np.zeros(len(found), np.int64)
            own = np.where(known[place] == found, rank[place], 0) if len(known) else place
            n = np.diff(at)
            prints = np.zeros((len(n), 2), _U)
            full = np.flatnonzero(n)
            if len(full):
                prints[full, 0] = np.add.reduceat(mix(found ^ _U(0x5851F42D4C957F2D)), at[:-1][full])
                prints[full, 1] = np.add.reduceat(mix(found + _U(0x14057B7EF767814F)), at[:-1][full])
            order = (own.astype(_U) << _U(56)) | (mix(found) >> _U(8))
            prefix = []
            for a, b in zip(at[:-1], at[1:], strict=True):
                keep = b - a - -(-SIMILARITY * (b - a) // 100) + 1 if b > a else 0
                prefix.append(found[a:b][np.argpartition(order[a:b], keep - 1)[:keep]] if keep < b - a else found[a:b])
            mixed = mix(found)
            points = [packed_point(mixed[a:b]) for a, b in zip(at[:-1], at[1:], strict=True)]
            sizes = np.concatenate([[0], np.cumsum([len(x) for x in prefix])]).astype(np.int32)
            flat = np.concatenate(prefix).view(np.int64) if prefix else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(n.astype(np.int64)), pa.array([x.tobytes() for x in prints], pa.binary()), pa.array(points, pa.binary()), pa.ListArray.from_arrays(pa.array(sizes), pa.array(flat))],
                ["doc_id", "n_shingles", "print", "point", "prefix"],
            )

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias(text)).mapInArrow(run, "doc_id long, n_shingles long, print binary, point binary, prefix array<long>")


def packed_point(mixed: np.ndarray) -> bytes:
    """Counts of a set by group: a letter for their width, then the counts."""
    dims = min(MOST_GROUPS, max(GROUPS, 1 << max(0, len(mixed) // 2).bit_length()))
    counts = np.bincount((mixed & _U(dims - 1)).astype(np.int64), minlength=dims)
    small = counts.max(initial=0) < 256
    return (b"b" if small else b"i") + counts.astype(np.uint8 if small else np.int32).tobytes()


def points_of(raw: list[bytes]) -> np.ndarray:
    """(sets, groups) counts; those in more groups are folded onto the fewest that one of them has."""
    points = [np.frombuffer(x[1:], np.uint8 if x[:1] == b"b" else np.int32) for x in raw]
    dims = min(map(len, points))
    return np.array([x if len(x) == dims else x.reshape(-1, dims).sum(axis=0) for x in points], np.int32)


def similar(s: np.ndarray, t: np.ndarray) -> bool:
    """Whether two sorted sets reach the similarity."""
    if len(s) > len(t):
        s, t = t, s
    if not len(s) or 100 * len(s) < SIMILARITY * len(t):
        return False
    both = int((t[np.minimum(np.searchsorted(t, s), len(t) - 1)] == s).sum())
    return 100 * both >= SIMILARITY * (len(s) + len(t) - both)


class RTree:
    """Points packed into pages of neighbours by size, page corners packed into nodes, and so on up.

    With labels, points of one label are packed together and pairs of one label are left out.
    """

    def __init__(self, points: np.ndarray, size: np.ndarray, label: np.ndarray | None = None):
        own = np.zeros(len(size), np.int64) if label is None else label
        self.labelled = label is not None
        self.order = np.lexsort((points[:, 0], size, own)) if len(size) > 2 else np.arange(len(size))
        tops, sizes, own = points[self.order], size[self.order], own[self.order]
        self.levels = [(tops, sizes, sizes, own, own)]  # upper corner, smallest and largest set and label; of points, pages, nodes
        while len(self.levels[-1][0]) > PAGE:
            tops, low, high, first, last = self.levels[-1]
            cut = np.arange(0, len(tops), PAGE)
            self.levels.append((np.maximum.reduceat(tops, cut), np.minimum.reduceat(low, cut), np.maximum.reduceat(high, cut), np.minimum.reduceat(first, cut), np.maximum.reduceat(last, cut)))

    def near(self, level: int, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of all entries a with all entries b of a level, the pairs (a <= b) that the bound doesn't part."""
        tops, low, high, first, last = self.levels[level]
        ok = (100 * high[a][:, None] >= SIMILARITY * low[b][None, :]) & (100 * high[b][None, :] >= SIMILARITY * low[a][:, None])
        if self.labelled:
            ok &= (first[a][:, None] != last[b][None, :]) | (last[a][:, None] != first[b][None, :])
        i, j = np.nonzero(ok & (a[:, None] <= b[None, :] if level else a[:, None] < b[None, :]))
        a, b = a[i], b[j]
        # |A n B| >= s |A u B| means (1 + s) |A n B| >= s (|A| + |B|)
        ok = (100 + SIMILARITY) * np.minimum(tops[a], tops[b]).sum(axis=1) >= SIMILARITY * (low[a] + low[b])
        return a[ok], b[ok]

    def pairs(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs of points that survive, a leaf of the join at a time."""
        top = len(self.levels) - 1
        every = np.arange(len(self.levels[top][0]))
        stack = [(top, every, every)]
        while stack:
            level, a, b = stack.pop()
            p, q = self.near(level, a, b)
            if level == 0:
                yield self.order[p], self.order[q]
                continue
            below = len(self.levels[level - 1][0])
            for i, j in zip(p, q, strict=True):
                stack.append((level - 1, np.arange(i * PAGE, min((i + 1) * PAGE, below)), np.arange(j * PAGE, min((j + 1) * PAGE, below))))


def cells(sketch: DataFrame) -> DataFrame:
    """(cell, n, doc_id) of the cells with two documents or more; cells with the same documents count once."""
    entries = sketch.select("doc_id", F.explode("prefix").alias("cell"))
    own, other = F.xxhash64("doc_id"), F.xxhash64("doc_id", F.lit(1))
    met = counted(entries, entries.where(told("doc_id")), "cell", "doc_id", {"x": F.bit_xor(own), "y": F.bit_xor(other)})
    met = materialise(met.where("n > 1"), "cells")
    first = met.where("x IS NOT NULL").groupBy("n", "x", "y").agg(F.min("cell").alias("cell"))
    single = met.where("x IS NOT NULL").join(first.select("cell"), "cell", "left_semi").unionByName(met.where("x IS NULL"))
    return single.select("cell", "n", "doc_id")


def first_look(met: DataFrame) -> DataFrame:
    """(cell, part, doc_id) of the FIRST cells of each document by hash, an order that its near copies share."""
    order = Window.partitionBy("doc_id").orderBy(F.xxhash64("cell"), "cell")
    some = met.withColumn("nth", F.row_number().over(order)).where(f"nth <= {FIRST}").drop("nth")
    # the smallest document of a large cell goes to all of its parts, so that a group of copies becomes one component
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.ceil(F.col("n") / CELL).cast("long") - 1))
    lead = some.where(F.col("n") > CELL).groupBy("cell", "n").agg(F.min("doc_id").alias("doc_id")).select("cell", every.alias("part"), "doc_id")
    return parted(some, "cell", "doc_id", CELL).select("cell", "part", "doc_id").unionByName(lead)


def partners(rows: DataFrame) -> DataFrame:
    """(doc_id, partner) of each document that the bound leaves a smaller one in a part of a cell: the smallest of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, int] = {}

        def flush() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(list(best), pa.int64()), pa.array(list(best.values()), pa.int64())], ["doc_id", "partner"])
            best.clear()
            return out

        for table in groups(batches, ["cell", "part"]):
            ids = table.column("doc_id").to_numpy()
            least = ids.copy()
            for i, j in RTree(points_of(table.column("point").to_pylist()), table.column("n_shingles").to_numpy()).pairs():
                np.minimum.at(least, np.where(ids[i] < ids[j], j, i), np.minimum(ids[i], ids[j]))
            met = least < ids
            for a, b in zip(ids[met].tolist(), least[met].tolist(), strict=True):
                best[a] = min(best.get(a, b), b)
            if len(best) > 100_000:
                yield flush()
        yield flush()

    found = dealt(rows, ["cell", "part"], "doc_id").mapInArrow(run, "doc_id long, partner long")
    return found.groupBy("doc_id").agg(F.min("partner").alias("partner"))


def verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """(a, b) of the pairs whose sets are similar."""
    both = merged(pairs, texts, "doc_id").select("doc_id", "partner", F.col("text").alias("own"))
    both = merged(both, texts.select(F.col("doc_id").alias("partner"), F.col("text").alias("other")), "partner").select("partner", "doc_id", "own", "other")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "own"):
            (s, at), (t, to) = (shingle_sets(*text_bytes(part.column(c)), WIDTH) for c in (2, 3))
            ok = [similar(s[at[k] : at[k + 1]], t[to[k] : to[k + 1]]) for k in range(part.num_rows)]
            yield pa.RecordBatch.from_arrays([part.column(0).filter(pa.array(ok)), part.column(1).filter(pa.array(ok))], ["a", "b"])

    return both.mapInArrow(run, "a long, b long")


def apart(rows: DataFrame) -> DataFrame:
    """Pairs (doc_id, partner) of different components that the bound leaves and that weren't tried before.

    A cell with more than FEW such pairs for each of its documents gives its documents instead (partner null).
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in groups(batches, ["cell", "p", "q"]):
            label, ids, tried = (table.column(c).to_numpy() for c in ("label", "doc_id", "tried"))
            asks = table.column("asks").to_numpy(zero_copy_only=False)
            if (label == label[0]).all() or not asks.any():
                continue
            out, a, b, n = np.zeros(len(label), bool), [], [], 0
            for i, j in RTree(points_of(table.column("point").to_pylist()), table.column("n_shingles").to_numpy(), label).pairs():
                open_ = (label[i] != label[j]) & (asks[i] | asks[j]) & (tried[i] != ids[j]) & (tried[j] != ids[i])
                i, j = i[open_], j[open_]
                out[i] = out[j] = True
                if n <= FEW * len(label):
                    a.append(ids[i])
                    b.append(ids[j])
                    n += len(i)
            if n > FEW * len(label):
                held = table.select(["cell", "p", "q", "doc_id", "label"]).filter(pa.array(out))
                yield from held.append_column("partner", pa.nulls(len(held), pa.int64())).to_batches()
            elif n:
                x, y = np.concatenate(a), np.concatenate(b)
                none = np.zeros(len(x), np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(v) for v in (none, none, none, np.maximum(x, y), none, np.minimum(x, y))], ["cell", "p", "q", "doc_id", "label", "partner"])

    return dealt(rows, ["cell", "p", "q"], "doc_id").mapInArrow(run, "cell long, p long, q long, doc_id long, label long, partner long")


def last_links(rows: DataFrame) -> DataFrame:
    """(a, b): links between different components, enough of them to connect what is linked in a cell."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = [], []

        def flush() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])
            a.clear()
            b.clear()
            return out

        for table in groups(batches, ["cell", "p", "q"]):
            ids, label = table.column("doc_id").to_pylist(), table.column("label").to_numpy().copy()
            found, at = shingle_sets(*text_bytes(table.column("text").combine_chunks()), WIDTH)
            sets = np.split(found, at[1:-1])
            for i, j in RTree(points_of(table.column("point").to_pylist()), table.column("n_shingles").to_numpy(), label).pairs():
                for x, y in zip(i[label[i] != label[j]].tolist(), j[label[i] != label[j]].tolist(), strict=True):
                    if label[x] != label[y] and similar(sets[x], sets[y]):
                        a.append(ids[x])
                        b.append(ids[y])
                        label[label == label[y]] = label[x]
            if len(a) > 10_000:
                yield flush()
        yield flush()

    return dealt(rows, ["cell", "p", "q"], "doc_id").mapInArrow(run, "a long, b long").distinct()


def classes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_shingles and component_id (the smallest doc_id that links reach) of every row."""
    sketch = materialise(sketches(docs, frequent_shingles(docs, text), doc_id, text), "sketches")
    known = sketch.where("doc_id IS NOT NULL AND n_shingles > 0")
    stands = materialise(known.groupBy("print").agg(F.min("doc_id").alias("rep")), "stands")
    reps = merged(sketch, stands.select(F.col("rep").alias("doc_id"), "print"), ["doc_id", "print"], "left_semi")
    met = materialise(cells(reps), "met")
    points = merged(reps.select("doc_id", "point", "n_shingles"), met.select("doc_id").distinct(), "doc_id", "left_semi")
    pairs = materialise(partners(merged(first_look(met), points, "doc_id")), "pairs")
    own = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    texts_of = lambda ids: merged(own, ids.distinct(), "doc_id", "left_semi")
    either = lambda p: p.select("doc_id").union(p.select("partner"))
    links = materialise(verified(pairs, texts_of(either(pairs))), "links")
    label = components(links).withColumnRenamed("node", "doc_id")
    tried = pairs.withColumnRenamed("partner", "tried")
    state = met.select("cell", "doc_id").join(label, "doc_id", "left").withColumn("label", F.coalesce("label", "doc_id"))
    state = materialise(across(state, "cell", "doc_id", CELL), "across")
    state = merged(state, points, "doc_id").join(tried, "doc_id", "left").withColumn("tried", F.coalesce("tried", "doc_id"))
    more = materialise(apart(state), "apart")
    single = materialise(more.where("partner IS NOT NULL").select("doc_id", "partner").distinct(), "single")
    crowded = more.where("partner IS NULL").drop("partner")
    held = merged(merged(crowded, points, "doc_id"), texts_of(crowded.select("doc_id")), "doc_id").select("cell", "p", "q", "doc_id", "label", "point", "n_shingles", "text")
    last = materialise(verified(single, texts_of(either(single))).unionByName(last_links(held)), "last")
    label = components(links.unionByName(last)).withColumnRenamed("node", "rep")
    of_rep = stands.join(label, "rep", "left").select("print", F.least("rep", F.coalesce("label", "rep")).alias("component_id"))
    return (
        sketch.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0), F.col("print")).alias("print"))
        .join(of_rep, "print", "left")
        .select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))
    )
