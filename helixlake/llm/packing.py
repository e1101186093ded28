"""Best-fit packing of tokenised documents into sequences by minimum bin slack.

Every document becomes its token ids and one end id, and is cut into pieces of the capacity; the last may be shorter.
What matters for packing is how many pieces there are of each length, and that is a table of CAPACITY rows at
most, however large the corpus. One task fills bin after bin from it: the longest piece left opens a bin, and a
subset-sum over the lengths still available, a bitset of reachable sums, finds the fullest feasible rest, which is
removed. The same bin is filled again as long as its pieces last, so the number of different bins follows the
number of lengths, and the plan stays small: at most 1 + CAPACITY / l of them end because length l runs out.

Pieces learn their place from the plan by their number among the pieces of their length. That number is made of
counts by task, so no length, hot or not, ever meets in one place.

Null and empty texts are one end id. Rows are packed one by one, repeated ones and those with null ids, too; equal
lengths go in the order of the table. Texts may be of any length. An empty table gives an empty result; columns
beyond the two named ones are not read.
"""

from __future__ import annotations

import io
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .bpe import Encoder, Memo
from .common import in_one_task, materialise, merged, slices

CAPACITY, END = 4096, 1
MEMO_WORDS = 150_000  # words whose ids a worker remembers, and as many of those before


class Ids(Encoder):
    """An encoder whose words stand for their ids as little-endian unsigned 32-bit numbers."""

    def __init__(self, path: str):
        super().__init__(path, None)
        self.memo = Memo(MEMO_WORDS)

    def entry(self, ids: list[int]) -> bytes:
        return np.array(ids, "<u4").tobytes()

    def learn(self, pieces: list[str]) -> None:
        """As before, but the ids of a word are cut out of the ids of all new ones."""
        memo = self.memo
        new = memo.missing(pieces)
        odd = self.bpe.by_library(new)
        memo.update((x, self.entry(ids)) for x, ids in odd.items())
        split = {x: self.bpe.pieces(x) for x in new if x not in odd}
        words = list({w for x in split.values() for w in x})
        ids, offsets = self.bpe.merge_flat(words)
        flat, at = ids.astype("<u4").tobytes(), (offsets * 4).tolist()
        found = {w: flat[a:b] for w, a, b in zip(words, at[:-1], at[1:], strict=True)}
        for x, parts in split.items():
            memo[x] = found[parts[0]] if len(parts) == 1 else b"".join([found[w] for w in parts])

    def ids(self, texts: list[str | None]) -> Iterator[bytes]:
        """The ids of each text, gathered at once for all places of all words."""
        apart, offsets, which, entries = self.numbered(texts)
        flat, size = np.frombuffer(b"".join(entries), "<u4"), np.array([len(x) // 4 for x in entries], np.int64)
        first, n = np.cumsum(size) - size, size[which]
        ends = np.cumsum(n)
        ids = flat[np.repeat(first[which] - (ends - n), n) + np.arange(n.sum())].tobytes()
        borders = np.concatenate([[0], ends])[offsets] * 4
        for k, (a, b) in enumerate(zip(borders[:-1].tolist(), borders[1:].tolist(), strict=True)):
            yield b"".join(next(self.entries([apart[k]]))) if k in apart else ids[a:b]


@lru_cache(maxsize=1)
def worker_encoder(path: str) -> Ids:
    """One for each Python worker, so that tasks find the words of earlier ones."""
    return Ids(path)


def pieces(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text", capacity: int = CAPACITY, end: int = END) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, part, nth): pieces of at most ``capacity`` ids; nth counts those of a length in a task, part."""
    tail = np.array([end], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part, seen = worker_encoder(path), TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)
        for rows in slices(batches, text):
            ids = [x + tail for x in encoder.ids(rows.column(1).to_pylist())]
            total = np.array([len(x) // 4 for x in ids], np.int64)
            count = -(-total // capacity)
            doc = np.repeat(np.arange(len(ids)), count)
            piece = np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)
            start = piece * capacity
            length = np.minimum(total[doc] - start, capacity)
            crc = [zlib.crc32(memoryview(ids[d])[4 * a : 4 * (a + n)]) for d, a, n in zip(doc.tolist(), start.tolist(), length.tolist(), strict=True)]
            order = np.argsort(length, kind="stable")
            first = np.searchsorted(length[order], length[order])
            nth = np.empty(len(doc), np.int64)
            nth[order] = seen[length[order]] + np.arange(len(doc)) - first
            seen += np.bincount(length, minlength=capacity + 1)
            cols = [rows.column(0).take(pa.array(doc)), *(pa.array(c, pa.int64()) for c in (piece, start, length, crc, np.full(len(doc), part), nth))]
            yield pa.RecordBatch.from_arrays(cols, ["doc_id", "piece", "start", "length", "ids_crc32", "part", "nth"])

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias(text))
    return rows.mapInArrow(run, "doc_id long, piece long, start long, length long, ids_crc32 long, part long, nth long")


def fullest(count: dict[int, int], room: int) -> dict[int, int]:
    """Of the lengths with their counts the combination whose sum comes nearest to ``room`` from below.

    Bit s of ``reach`` says that a sum of s can be made. Each length joins in lots of 1, 2, 4, ... pieces. Longer
    ones come first, and the search ends once the room is filled.
    """
    mask, reach, lots = (1 << (room + 1)) - 1, 1, []
    for length in sorted((x for x in count if x <= room), reverse=True):
        left, lot = min(count[length], room // length), 1
        while left and not reach >> room & 1:
            n = min(lot, left)
            lots.append((length, n, reach))
            reach |= reach << (length * n) & mask
            left, lot = left - n, lot * 2
        if reach >> room & 1:
            break
    total, taken = reach.bit_length() - 1, {}
    for length, n, before in reversed(lots):
        if not before >> total & 1:
            taken[length] = taken.get(length, 0) + n
            total -= length * n
    return taken


def packed(count: dict[int, int], capacity: int = CAPACITY) -> list[tuple[dict[int, int], int]]:
    """[(pieces of each length in a bin, how many such bins)] for all pieces, by minimum bin slack."""
    count, bins = {k: n for k, n in count.items() if n}, []
    while count:
        longest = max(count)
        count[longest] -= 1
        taken = fullest({k: n for k, n in count.items() if n}, capacity - longest)
        count[longest] += 1
        taken[longest] = taken.get(longest, 0) + 1
        times = min(count[k] // n for k, n in taken.items())
        for k, n in taken.items():
            count[k] -= n * times
            if not count[k]:
                del count[k]
        bins.append((taken, times))
    return bins


def plan(counts: DataFrame, capacity: int = CAPACITY) -> dict[str, np.ndarray]:
    """From (length, n) the places of pieces: those of a length from number ``low`` on lie, ``each`` in a bin, from ``bin`` and ``offset`` on.

    One task works it out of ``capacity`` rows at most.
    """

    def work(table: pa.Table) -> bytes:
        used: dict[int, int] = {}
        rows, at = [], 0
        for taken, times in packed(dict(zip(table.column("length").to_pylist(), table.column("n").to_pylist(), strict=True)), capacity):
            offset = 0
            for length, each in sorted(taken.items(), reverse=True):
                rows.append((length, used.get(length, 0), at, each, offset))
                used[length] = used.get(length, 0) + each * times
                offset += length * each
            at += times
        out = io.BytesIO()
        np.save(out, np.array(sorted(rows), np.int64).reshape(-1, 5))
        return out.getvalue()

    made = np.load(io.BytesIO(in_one_task(counts, work)))
    return dict(zip(("length", "low", "bin", "each", "offset"), made.T, strict=True))


def pack(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text", capacity: int = CAPACITY, end: int = END) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id and offset of every piece."""
    made = materialise(pieces(docs, path, doc_id, text, capacity, end), "pieces")
    counts = made.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = counts.withColumn("before", before).select("part", "length", "before")
    places = plan(made.groupBy("length").agg(F.count(F.lit(1)).alias("n")), capacity)
    shift = 1 << 48  # more pieces than there can be of a length

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = places["length"] * shift + places["low"]
        for rows in batches:
            length, number = (rows.column(c).to_numpy() for c in (3, 5))
            k = np.searchsorted(key, length * shift + number, "right") - 1
            nth = number - places["low"][k]
            bins, inside = places["bin"][k] + nth // places["each"][k], places["offset"][k] + nth % places["each"][k] * length
            yield pa.RecordBatch.from_arrays([*rows.columns[:5], pa.array(bins), pa.array(inside)], [*rows.schema.names[:5], "sequence_id", "offset"])

    numbered = merged(made, offsets, ["part", "length"]).select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("nth") + F.col("before")).alias("number"))
    out = numbered.mapInArrow(run, "doc_id long, piece long, start long, length long, ids_crc32 long, sequence_id long, offset long")
    return out.withColumn("piece", F.col("piece").cast("int"))
