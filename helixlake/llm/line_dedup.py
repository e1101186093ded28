"""Line dedup: of lines that are equal or few edits apart, the first in the corpus stays.

How many edits are few is a rule on the length of the shorter line. :func:`two_edits`, the rule of
op8_line_dedup and its SQL, lets two edits pass from 20 code points on. :func:`by_length`, the rule of the
pipeline, lets one pass for each 20 code points, two at least, and one below 20. :func:`by_spots` lets as many pass,
where the edits of lines of 60 code points or more lie in one or two spots, such as an exchanged word, or else
leave a run of three tenths of the line. Copies go at any length; only blank lines always stay.

Method: a segment-partition edit join over distinct lines. Every line is cut into segments, one more than its
edits. If a line is within the edits of another, one of its substrings equals a segment of it, near the
segment's own place; which lengths and places can match follows from the lengths alone (multi-match-aware
selection). Segments and substrings meet by hash, and pairs are verified by a banded bit-parallel edit distance
over code points. Where the edits grow with the line, from 60 code points on, the number of substrings would
grow with the square of the edits. There the lines meet by winnowing instead. Under by_length two lines within
the edits share a run of 15 code points (up to 19 in longer ones), under by_spots a run of three tenths of their
class of lengths, and of every such run both choose the same gram, near the same place of the line. Lengths, places
and counts of code points leave few of those pairs, which bit-parallel columns verify. No pair that the rule names is lost. by_spots is far cheaper:
long runs have few chosen grams, and those are rare.

Lines that links connect make a class. Its first line, by doc_id and line number, stays. Equal lines are told by
two independent hashes of 64 bits.

Lines part at line feeds. Documents keep all their other columns, whatever their names; a text that loses every
line becomes empty, a null text stays null. Rows with a null doc_id pass unchanged. Rows that share doc_id and
text are one document, kept or cut alike. Texts and lines may be of any length. An empty table gives an empty
result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import SALTS, WORD, across, coefficients, components, counted, dealt, groups, hot_keys, materialise, merged, mix, parted, settled, slices, told

EDITS, SHORTEST = 2, 20
WINNOWED = 60  # code points of a shorter line from which by_length and by_spots have their lines meet by winnowing
GRAM, RUN, BINS = 10, 0.3, 32
EDGES = np.array([int(WINNOWED * 1.25**c) for c in range(73)])  # classes of lengths
PLACE = 4  # half code points of a stretch of a line in which grams meet, in edits of the class
ROUNDS = 3  # in which winnowed keys are counted, so that only a share of them is on disk at once
FEW, MANY = 32, 64  # rows of a key, up to which its pairs are listed, and above which its rows aren't told apart
BUCKET = 1500  # lines of a bucket, above which it is dealt into parts
FIRST, STEPS = 4, 16  # keys of a line that the first look takes, and lines of like length that each is compared with there
WIDEST, PAIRS = 31, 2048  # edits that a band of one word holds, and pairs that are verified together
GRAMS = 2048  # bins of the grams of three code points, whose counts leave few pairs of more edits than that
_U = np.uint64
_INVERSE = pow(0x9E3779B97F4A7C15 | 1, -1, 1 << 64)
_BASE = 0x9E3779B97F4A7C15 | 1


def within(a: str, b: str, edits: int = EDITS) -> bool:
    """Whether a becomes b by at most ``edits`` insertions, deletions or substitutions.

    Common ends go first. Then, for each number of errors, a bit vector over the diagonals of the band says
    which prefixes match; all diagonals move at once.
    """
    if abs(len(a) - len(b)) > edits:
        return False
    n, i = min(len(a), len(b)), 0
    while i < n and a[i] == b[i]:
        i += 1
    j = 0
    while j < n - i and a[len(a) - 1 - j] == b[len(b) - 1 - j]:
        j += 1
    a, b = a[i : len(a) - j], b[i : len(b) - j]
    if not a or not b:
        return len(a) + len(b) <= edits
    band, mid, width = (1 << (2 * edits + 1)) - 1, edits, 2 * edits + 1
    state = [1 << mid]
    for _ in range(edits):
        state.append(state[-1] | (state[-1] << 1) & band)
    for i, x in enumerate(a):
        match = 0
        for k in range(width):
            if 0 <= i + k - mid < len(b) and b[i + k - mid] == x:
                match |= 1 << k
        before, state[0] = state[0], state[0] & match
        for e in range(1, edits + 1):
            now = (state[e] & match) | before | (before >> 1)
            before, state[e] = state[e], (now | (state[e - 1] << 1)) & band
        if not state[edits]:
            return False
    return bool(state[edits] >> (len(b) - len(a) + mid) & 1)


def two_edits(size: np.ndarray) -> np.ndarray:
    """Two edits, none for lines of fewer than 20 code points."""
    return np.where(size >= SHORTEST, EDITS, 0)


def by_length(size: np.ndarray) -> np.ndarray:
    """One edit for each 20 code points of the shorter line, two at least; one below 20 code points, none below 10."""
    return np.where(size >= SHORTEST, np.maximum(EDITS, size // 20), size // 10)


def by_spots(size: np.ndarray) -> np.ndarray:
    """As many edits as :func:`by_length`; from 60 code points on, lines that share a run of RUN of the shorter one are found."""
    return by_length(size)


def window(allowed: Callable, kind: int) -> tuple[int, int]:
    """Code points of a gram, and grams of a window, for a class of lengths: together a run that near copies share."""
    if allowed is by_length:
        edits = int(EDGES[kind]) // 20
        return GRAM, -(-19 * edits // (edits + 1)) - GRAM + 1  # of 20 * edits code points 19 * edits are left in edits + 1 runs
    run = int(RUN * EDGES[kind])
    gram = min(24, 2 * run // 3)
    return gram, run - gram + 1


def near(a: str, b: str, edits: int) -> bool:
    """:func:`within` for many edits: the columns of the edit matrix as bit vectors of the length of ``a``."""
    if abs(len(a) - len(b)) > edits:
        return False
    if edits <= EDITS or not a:
        return within(a, b, edits)
    at: dict[str, int] = {}
    for i, x in enumerate(a):
        at[x] = at.get(x, 0) | 1 << i
    full, top = (1 << len(a)) - 1, len(a) - 1
    up, down, score = full, 0, len(a)
    for left, x in zip(range(len(b) - 1, -1, -1), b, strict=True):
        same = at.get(x, 0)
        across = (((same & up) + up) ^ up) | same
        more, less = down | full & ~(across | up), up & across
        score += (more >> top & 1) - (less >> top & 1)
        if score - left > edits:
            return False
        more, less = (more << 1 | 1) & full, less << 1 & full
        same |= down
        up, down = less | full & ~(same | more), more & same
    return score <= edits


class Lines:
    """Texts whose pairs are verified many at a time."""

    def __init__(self, texts: list[str]):
        self.texts, self.size = texts, np.array([len(x) for x in texts], np.int64)
        self.flat = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
        self.first = np.cumsum(self.size) - self.size

    def grams(self, k: int, known: dict[int, np.ndarray]) -> np.ndarray:
        """How many grams of three code points of text ``k`` fall in each of GRAMS bins."""
        if k not in known:
            if len(known) > 1000:
                known.clear()
            codes = self.flat[self.first[k] : self.first[k] + self.size[k]].astype(_U)
            known[k] = np.bincount((mix((codes[:-2] << _U(42)) | (codes[1:-1] << _U(21)) | codes[2:]) % _U(GRAMS)).astype(np.int64), minlength=GRAMS)
        return known[k]

    def near(self, i: np.ndarray, j: np.ndarray, edits: np.ndarray) -> np.ndarray:
        """:func:`near` of the pairs (i, j), each with its edits.

        A band of 64 diagonals of the edit matrix is one word of each pair. It moves down a row with every column, and
        the words of all pairs move together. The distance is followed down the lowest diagonal of the band to the
        pattern's last letter and from there along its row. Pairs of more edits than fit the band go one by one.
        """
        good, size, first = np.zeros(len(i), bool), self.size, self.first
        alone = (edits > WIDEST) | (size[i] <= edits) | (size[j] <= edits)
        grams: dict[int, np.ndarray] = {}
        for k in np.flatnonzero(alone):
            if edits[k] > WIDEST:  # an edit takes three grams of three at most from a text, and adds as many
                apart = self.grams(i[k], grams) - self.grams(j[k], grams)
                if max(np.maximum(apart, 0).sum(), np.maximum(-apart, 0).sum()) > 3 * edits[k]:
                    continue
            good[k] = near(self.texts[i[k]], self.texts[j[k]], int(edits[k]))
        fit = np.flatnonzero(~alone & (np.abs(size[i] - size[j]) <= edits))
        fit = fit[np.argsort(size[i[fit]], kind="stable")]
        for a in range(0, len(fit), PAIRS):
            own = fit[a : a + PAIRS]
            good[own] = _banded(self.flat, first[i[own]], size[i[own]], first[j[own]], size[j[own]], edits[own])
        return good


def _laid(flat: np.ndarray, first: np.ndarray, size: np.ndarray, at: np.ndarray, width: int) -> np.ndarray:
    """A row for each text, its letters from column ``at`` on, 0 elsewhere."""
    out = np.zeros((len(first), width), np.uint32)
    step = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
    out[np.repeat(np.arange(len(first)), size), np.repeat(at, size) + step] = flat[np.repeat(first, size) + step] + np.uint32(1)
    return out


def _banded(flat: np.ndarray, pfirst: np.ndarray, m: np.ndarray, tfirst: np.ndarray, n: np.ndarray, edits: np.ndarray) -> np.ndarray:
    columns = int(n.max())
    pattern = _laid(flat, pfirst, m, 63 - edits, columns + 64 + int(max(0, (63 - edits + m).max() - columns - 64)))
    text = _laid(flat, tfirst, n, np.zeros(len(n), np.int64), columns)
    live, distance, turn = np.arange(len(n)), edits.copy(), m - edits  # turn: the column in which the lowest diagonal meets the last letter
    out = np.zeros(len(n), bool)
    up, down = ~_U(0) << (63 - edits).astype(_U), np.zeros(len(n), _U)
    one, top = _U(1), _U(63)
    for c in range(columns):
        done = n[live] == c
        if done.any() or c % 32 == 31:
            out[live[done]] = distance[done] <= edits[live[done]]
            keep = np.flatnonzero(~done & (distance <= edits[live] + np.maximum(0, n[live] - np.maximum(turn[live], c))))
            live, distance, up, down = live[keep], distance[keep], up[keep], down[keep]
            if not len(live):
                return out
        same = np.packbits(pattern[live, c : c + 64] == text[live, c][:, None], axis=1, bitorder="little").view("<u8").ravel()
        diagonal = (((same & up) + up) ^ up) | same | down
        more, less = down | ~(diagonal | up), diagonal & up
        before = turn[live] > c
        place = np.where(before, 0, 62 - (c - turn[live])).astype(_U)
        distance = distance + np.where(before, (~diagonal >> top & one).astype(np.int64), (more >> place & one).astype(np.int64) - (less >> place & one).astype(np.int64))
        diagonal >>= one
        up, down = less | ~(diagonal | more), diagonal & more
    out[live] = distance <= edits[live]
    return out


def places(size: np.ndarray, shorter: int, segment: int, edits: int = EDITS) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(rows, start, length) of the substrings of lines of these sizes that can equal the given segment of a line shorter by ``shorter``."""
    base = size - shorter
    cut = base // (edits + 1)
    long = base - cut * (edits + 1)  # so many of the last segments have one code point more
    plain = edits + 1 - long
    length = cut + (segment >= plain)
    start = segment * cut + np.maximum(0, segment - plain)
    low = np.maximum(start - segment, start + shorter - (edits - segment))
    high = np.minimum(start + segment, start + shorter + (edits - segment))
    low, high = np.maximum(low, 0), np.minimum(high, size - length)
    out = []
    for step in range(2 * edits + 1):
        at = np.flatnonzero(low + step <= high)
        if len(at):
            out.append((at, (low + step)[at], length[at]))
    return out


class Hashed:
    """Texts of a slice as code points, with the hash of any substring."""

    def __init__(self, part: pa.RecordBatch):
        lines = dict(zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True))
        self.ids, self.size = np.array(list(lines), np.int64), np.array([len(x) for x in lines.values()], np.int64)
        self.codes = np.frombuffer("".join(lines.values()).encode("utf-32-le", "surrogatepass"), np.uint32)
        n = len(self.codes) + 1
        power, self.back = np.full(n, _BASE, _U), np.full(n, _INVERSE, _U)
        power[0] = self.back[0] = 1
        power, self.back = np.multiply.accumulate(power), np.multiply.accumulate(self.back)
        self.total = np.concatenate([np.zeros(1, _U), np.cumsum((mix(self.codes.astype(_U) + _U(1))) * power[:-1])])
        self.first = np.cumsum(self.size) - self.size

    def at(self, s: np.ndarray, length: np.ndarray | int) -> np.ndarray:
        return (self.total[s + length] - self.total[s]) * self.back[s]


def segment_keys(lines: DataFrame, allowed: Callable = two_edits) -> DataFrame:
    """(key, line, indexed): hashed segments and substrings of every line; indexed says that the key is one of its own segments."""
    factors = coefficients(64, 9)
    most = 1 << 40 if allowed is two_edits else WINNOWED

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "line"):
            text = Hashed(part)
            for edits in range(1, EDITS + 1):
                for shorter in range(edits + 1):
                    base = text.size - shorter
                    fit = np.flatnonzero((allowed(base) == edits) & (base < most))
                    size, base = text.size[fit], base[fit]
                    for segment in range(edits + 1):
                        own = segment * (base // (edits + 1)) + np.maximum(0, segment - (edits + 1 - base % (edits + 1)))
                        for rows, start, length in places(size, shorter, segment, edits):
                            key = mix(text.at(text.first[fit[rows]] + start, length) + base[rows].astype(_U) * factors[segment] + length.astype(_U))
                            yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(text.ids[fit[rows]]), pa.array((start == own[rows]) & (shorter == 0))], ["key", "line", "indexed"])

    return lines.mapInArrow(run, "key long, line long, indexed boolean")


def least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each window of ``width`` values, by windows of doubling width."""
    out, step = values, 1
    while 2 * step <= width:
        out = np.minimum(out[:-step], out[step:])
        step *= 2
    return np.minimum(out[: len(values) - width + 1], out[width - step :][: len(values) - width + 1])


def chosen(values: np.ndarray, inside: np.ndarray, width: int) -> np.ndarray:
    """Places that hold the least value of a window of ``width``, of the windows that begin where ``inside`` says."""
    low = np.where(inside, least(values, width), 0)
    pad = np.zeros(width - 1, low.dtype)
    # a value is the least of a window that holds it, if the largest of their least ones is the value
    most = ~least(~np.concatenate([pad, low, pad]), width)
    return np.flatnonzero(most == values)


def winnowed_keys(lines: DataFrame, allowed: Callable = by_length, nth: int = 0, rounds: int = 1) -> DataFrame:
    """(key, line, spot): of every window of grams of a long line the gram of the smallest hash, under each class of lengths that the shorter line of a pair can have.

    A key also has the gram's stretch of the line, told from the middle: a run that two lines share within e edits
    is shifted by e / 2 against their middles at most, as what shifts it further has to be made up for behind it.
    Each gram goes by all stretches within half of that. spot has the line's length in the upper 32 bits and in the
    lower ones the gram's place from the middle, doubled. Of the keys those of round ``nth`` of ``rounds`` are made.
    """
    factors, stretches = coefficients(len(EDGES), 21), coefficients(1, 22)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            size = pc.utf8_length(part.column(1)).to_numpy().astype(np.int64)
            # a line of n code points is at most a twentieth longer than the shorter one
            high, low = (np.searchsorted(EDGES, n, "right") - 1 for n in (size, size * 20 // 21))
            for kind in np.unique(np.concatenate([high, low])):
                if kind < 0:
                    continue
                text, (k, w) = Hashed(part.take(pa.array(np.flatnonzero((high == kind) | (low == kind))))), window(allowed, kind)
                if len(text.codes) < k + w - 1:
                    continue
                grams = mix(text.at(np.arange(len(text.codes) - k + 1), k)) | _U(1)
                ends = np.repeat(text.first + text.size, text.size)
                at = chosen(grams, np.arange(len(grams) - w + 1) + w + k - 1 <= ends[: len(grams) - w + 1], w)
                owner = np.repeat(np.arange(len(text.ids)), text.size)[at]
                edits = int(allowed(EDGES[kind + 1 : kind + 2] - 1)[0])
                middle = 2 * (at - text.first[owner]) - text.size[owner]
                # two lines that share the run lie in one stretch if each reaches out by half of the edits
                before, after = ((2 * middle + x) // (2 * PLACE * edits) for x in (-edits, edits))
                twice = np.flatnonzero(after > before)
                row, stretch = np.concatenate([np.arange(len(at)), twice]), np.concatenate([before, after[twice]])
                keys = mix(grams[at[row]] + factors[kind] + stretch.astype(_U) * stretches)
                take = np.flatnonzero(keys % _U(rounds) == nth)
                row, keys = row[take], keys[take]
                spot = (text.size[owner[row]] << 32) | (middle[row] & 0xFFFFFFFF)
                yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(text.ids[owner[row]]), pa.array(spot)], ["key", "line", "spot"])

    return lines.mapInArrow(run, "key long, line long, spot long")


def winnowed_met(lines: DataFrame, bags: DataFrame, allowed: Callable) -> DataFrame:
    """(key, line, n, other) of the winnowed keys under which a line has another that may be within the edits.

    First length and place have to leave the edits, then the counts of code points. Keys are counted in ROUNDS, one
    after the other. Of a key of up to FEW such rows there is each pair, as line and other; else other is null. Those of
    more than MANY rows stay as they are, those of very many with their estimated n.
    """
    n = int(lines.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        key, line, spot, hot = (c.to_numpy() for c in pa.Table.from_batches(held).columns)
        order = np.argsort(key)
        same = key[order[1:]] == key[order[:-1]]
        order = order[np.append(same, False) | np.append(False, same)]  # rows of keys that come once go before the finer order
        order = order[np.lexsort((line[order], spot[order], key[order]))]
        key, line, spot, hot = key[order], line[order], spot[order], hot[order]
        size, middle = spot >> 32, spot.astype(np.int32).astype(np.int64)
        most, (first, count) = allowed(size), np.unique(key, return_index=True, return_counts=True)[1:]
        good = (hot > 0) | np.repeat(count > MANY, count)
        at, step = np.flatnonzero(~good), 1
        while len(at := at[at + step < len(key)]):
            to = at + step
            open_ = (key[to] == key[at]) & (size[to] <= size[at] + most[at])
            at, to = at[open_], to[open_]
            near_ = (line[at] != line[to]) & (np.abs(middle[at] - middle[to]) <= most[at])
            good[at[near_]] = good[to[near_]] = True
            step += 1
        rows = pa.table({"key": key[good], "line": line[good], "hot": hot[good]}).group_by(["key", "line"]).aggregate([("hot", "max")])
        per = rows.group_by("key").aggregate([("line", "count")])
        rows = rows.join(per, "key")
        own = np.maximum(rows.column("hot_max").to_numpy(), rows.column("line_count").to_numpy())
        yield from pa.table({"key": rows.column("key"), "line": rows.column("line"), "n": own}).to_batches()

    def closer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches):
            good, pairs = np.zeros(table.num_rows, bool), [(np.zeros(0, np.int64),) * 2]
            for i, j in close_pairs(table, ["key"], allowed):
                good[i] = good[j] = True
                pairs.append((i, j))
            line, (back, count) = table.column("line").to_numpy(), np.unique(table.column("key").to_numpy(), return_inverse=True, return_counts=True)[1:]
            n = np.bincount(back, good, len(count)).astype(np.int64)[back]
            i, j = (np.concatenate(x) for x in zip(*pairs, strict=True))
            i, j = i[n[i] <= FEW], j[n[i] <= FEW]
            few = pa.table({"line": np.minimum(line[i], line[j]), "other": np.maximum(line[i], line[j])}).group_by(["line", "other"]).aggregate([])
            more, none = good & (n > FEW), pa.nulls(len(few), pa.int64())
            yield from pa.table({"key": none, "line": few.column("line"), "n": none, "other": few.column("other")}).to_batches()
            yield from pa.table({"key": table.column("key").to_numpy()[more], "line": line[more], "n": n[more], "other": pa.nulls(int(more.sum()), pa.int64())}).to_batches()

    hot = hot_keys(winnowed_keys(lines.where(told("line")), allowed), "key").withColumnRenamed("__hot", "hot")

    def met(nth: int) -> DataFrame:
        rows = winnowed_keys(lines, allowed, nth, ROUNDS).join(F.broadcast(hot), "key", "left")  # SHARES rows at most
        rows = rows.select("key", "line", "spot", F.coalesce("hot", F.lit(0).cast("long")).alias("hot"))
        salt = F.when(F.col("hot") > 0, F.pmod(F.xxhash64("line"), F.lit(SALTS)))
        found = materialise(rows.repartition(n, "key", salt).mapInArrow(run, "key long, line long, n long"), "winnowed")
        few = merged(found.where(F.col("n") <= MANY), bags, "line").select("key", "line", "size", "bag")
        close = dealt(few, ["key"], "size", "line").mapInArrow(closer, "key long, line long, n long, other long")
        return close.unionByName(found.where(F.col("n") > MANY).withColumn("other", F.lit(None).cast("long")))

    return reduce(DataFrame.unionByName, [settled(lambda k=k: met(k), "close") for k in range(ROUNDS)])


def signed(texts: DataFrame) -> DataFrame:
    """(line, size, bag): the length of every line and how often its code points fall in each of BINS bins."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bags = []
            for x in batch.column(1).to_pylist():
                codes = np.frombuffer(x.encode("utf-32-le", "surrogatepass"), np.uint32)
                bags.append(np.minimum(np.bincount(codes % BINS, minlength=BINS), 65535).astype(np.uint16).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(bags, pa.binary())], ["line", "size", "bag"])

    return texts.select("line", "text", F.char_length("text").alias("size")).mapInArrow(run, "line long, size int, bag binary")


def lines_of(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """doc_id, the hash of the text, line_no (from 0), line and its two hashes, of the lines that aren't blank."""
    whole = docs.where(F.col(doc_id).isNotNull()).select(F.col(doc_id).cast("long").alias("doc_id"), F.xxhash64(text).alias("print"), F.posexplode(F.split(F.col(text), "\n", -1)).alias("line_no", "line"))
    return whole.where(F.col("line").rlike(WORD)).select("doc_id", "print", "line_no", "line", F.xxhash64("line").alias("h1"), F.xxhash64(F.lit(1), "line").alias("h2"))


def met_by(keys: Callable[[DataFrame], DataFrame], lines: DataFrame) -> DataFrame:
    """(key, line, indexed, n) of the keys that several lines have, one of them as a segment."""
    more = {"low": F.min("line"), "high": F.max("line"), "own": F.bool_or("indexed")}
    met = counted(keys(lines), keys(lines.where(told("line"))), "key", "line", more).where("low < high OR low IS NULL")
    return met.where("own OR own IS NULL").groupBy("key", "line").agg(F.bool_or("indexed").alias("indexed"), F.max("n").alias("n"))


def near_links(met: DataFrame, texts: DataFrame, allowed: Callable = two_edits) -> DataFrame:
    """(a, b): lines that are within the edits, enough of them to connect every class.

    Keys of many lines are dealt into parts first. What is still apart then meets across the parts.
    """

    def linked(rows: DataFrame, part: list[str]) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            a, b = [], []

            def flush() -> pa.RecordBatch:
                out = pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])
                a.clear()
                b.clear()
                return out

            for table in groups(batches, ["key", *part]):
                ids, text = table.column("line").to_pylist(), table.column("text").to_pylist()
                size, own = np.array([len(x) for x in text]), np.flatnonzero(table.column("indexed").to_numpy(zero_copy_only=False))
                label, asks = table.column("label").to_numpy().copy(), table.column("asks").to_numpy(zero_copy_only=False)
                most = allowed(size)
                for i in own:
                    open_ = (label != label[i]) & (size >= size[i]) & (size <= size[i] + most[i]) & (asks | asks[i])
                    for j in np.flatnonzero(open_):
                        if label[j] != label[i] and within(text[i], text[j], int(most[i])):
                            a.append(ids[i])
                            b.append(ids[j])
                            label[label == label[j]] = label[i]
                if len(a) > 10_000:
                    yield flush()
            yield flush()

        names = ["key", "line", "indexed", "label", "asks", *part]
        return dealt(merged(rows.select(*names), texts, "line"), ["key", *part], "line").mapInArrow(run, "a long, b long").distinct()

    alone = parted(met, "key", "line", BUCKET).withColumn("label", F.col("line")).withColumn("asks", F.lit(True))
    first = materialise(linked(alone, ["part"]), "links")
    large = met.where(F.col("n") > BUCKET)
    if large.isEmpty():
        return first
    state = large.join(components(first).withColumnRenamed("node", "line"), "line", "left").withColumn("label", F.coalesce("label", "line"))
    rest = across(state.select("key", "line", "indexed", "label"), "key", "line", BUCKET)
    return first.unionByName(linked(rest, ["p", "q"]))


def close_pairs(table: pa.Table, groups_: list[str], allowed: Callable, steps: int = 1 << 40) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places (i, j) of rows of one group whose lengths and counts of code points leave the edits of the shorter line, i.

    Rows come by group and size. All rows look at the one behind them, then at the next but one, and so on, until
    the lengths of a row's group have gone too far, or for so many steps.
    """
    keys = [table.column(c).to_numpy() for c in groups_]
    size = table.column("size").to_numpy()
    bag = np.frombuffer(b"".join(table.column("bag").to_pylist()), np.uint16).reshape(-1, BINS).astype(np.int32)
    at, most, step = np.arange(len(size)), allowed(size), 1
    while step <= steps and len(at := at[at + step < len(size)]):
        to = at + step
        open_ = size[to] <= size[at] + most[at]
        for k in keys:
            open_ &= k[at] == k[to]
        at, to = at[open_], to[open_]
        for c in range(0, len(at), 1 << 16):
            i, j = at[c : c + (1 << 16)], to[c : c + (1 << 16)]
            apart = bag[i] - bag[j]
            near_ = (np.maximum(apart, 0).sum(1) <= most[i]) & (np.maximum(-apart, 0).sum(1) <= most[i])
            yield i[near_], j[near_]
        step += 1


def whole_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Tables of sorted batches that end where their first column changes."""
    held: list[pa.Table] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.concat_tables([*held, pa.Table.from_batches([batch])])
        key = table.column(0).to_numpy()
        change = np.flatnonzero(key[1:] != key[:-1])
        cut = int(change[-1]) + 1 if len(change) else 0
        if cut:
            yield table.slice(0, cut)
        held = [table.slice(cut)]
    yield from held


def verified(pairs: DataFrame, texts: DataFrame, allowed: Callable) -> DataFrame:
    """(a, b) of the pairs that are within the edits."""
    both = merged(merged(pairs, texts.select(F.col("line").alias("a"), F.col("text").alias("x")), "a"), texts.select(F.col("line").alias("b"), F.col("text").alias("y")), "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            xs, ys = batch.column(2).to_pylist(), batch.column(3).to_pylist()
            at = np.arange(len(xs))
            good = Lines([*xs, *ys]).near(at, at + len(xs), allowed(np.array([min(len(x), len(y)) for x, y in zip(xs, ys, strict=True)], np.int64)))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(good, pa.bool_()))

    return both.select("a", "b", "x", "y").mapInArrow(run, "a long, b long")


def winnowed_links(met: DataFrame, texts: DataFrame, bags: DataFrame, allowed: Callable = by_length) -> DataFrame:
    """(a, b): lines of one class, enough of them to connect every class of lines that share a key and are within the edits.

    A first look takes a few keys of each line, those of FEW rows apart, large ones in parts, and compares each line there with those next to it
    by length: a pair that is connected by others isn't verified. What is connected is one class; then every key that
    still holds several classes is gone through for all pairs across them, each of which is verified once. A crowd of
    near copies that are connected costs pairs in proportion to its lines; a line that stays apart costs as many as it is close to.
    """
    def inside(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches):
            text, most = table.column("text").to_pylist(), allowed(table.column("size").to_numpy())
            root, lines = list(range(len(text))), Lines(text)

            def top(k: int, root: list[int] = root) -> int:
                while root[k] != k:
                    root[k] = k = root[root[k]]
                return k

            for i, j in close_pairs(table, ["key", "part"], allowed, STEPS):
                tops = np.array([top(k) for k in range(len(root))]) if len(i) > len(root) // 8 else None
                apart = tops[i] != tops[j] if tops is not None else np.array([top(x) != top(y) for x, y in zip(i.tolist(), j.tolist(), strict=True)], bool)
                i, j = i[apart], j[apart]
                near_ = lines.near(i, j, most[i])
                for x, y in zip(i[near_].tolist(), j[near_].tolist(), strict=True):
                    p, q = top(x), top(y)
                    if p != q:
                        root[q] = p
            ids, tops = table.column("line").to_numpy(), table.column("line").to_numpy()[[top(k) for k in range(len(root))]]
            # each to the one line of its class, so that no long chains are left to components()
            yield pa.RecordBatch.from_arrays([pa.array(np.minimum(ids, tops)), pa.array(np.maximum(ids, tops))], ["a", "b"])

    order = Window.partitionBy("line").orderBy(F.xxhash64("key"), "key")
    few = met.where("other IS NOT NULL").select(F.col("line").alias("a"), F.col("other").alias("b")).distinct()
    met = met.where("other IS NULL").drop("other")
    some = met.withColumn("nth", F.row_number().over(order)).where(f"nth <= {FIRST}").drop("nth")
    # the smallest line of a large key goes to all of its parts
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.ceil(F.col("n") / BUCKET).cast("long") - 1))
    lead = some.where(F.col("n") > BUCKET).groupBy("key", "n").agg(F.min("line").alias("line")).select("key", every.alias("part"), "line")
    dealt_ = parted(some, "key", "line", BUCKET).select("key", "part", "line").unionByName(lead).join(bags, "line").select("key", "part", "line", "size", "bag")
    dealt_ = merged(dealt_, texts, "line").select("key", "part", "line", "size", "bag", "text")
    first = materialise(dealt(dealt_, ["key", "part"], "size", "line").mapInArrow(inside, "a long, b long").where("a <> b").distinct(), "links")

    def others(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches):
            line, label, asks = table.column("line").to_numpy(), table.column("label").to_numpy(), table.column("asks").to_numpy(zero_copy_only=False)
            for i, j in close_pairs(table, ["key", "p", "q"], allowed):
                take = (label[i] != label[j]) & (asks[i] | asks[j])
                low, high = np.minimum(line[i], line[j])[take], np.maximum(line[i], line[j])[take]
                yield pa.RecordBatch.from_arrays([pa.array(low), pa.array(high)], ["a", "b"])

    labels = components(first)
    state = met.select("key", "line").join(labels.withColumnRenamed("node", "line"), "line", "left").withColumn("label", F.coalesce("label", "line"))
    for end in ("a", "b"):
        few = few.join(labels.select(F.col("node").alias(end), F.col("label").alias(f"{end}_label")), end, "left")
    few = few.where("coalesce(a_label, a) <> coalesce(b_label, b)").select("a", "b")
    rest = across(state, "key", "line", BUCKET).join(bags, "line").select("key", "p", "q", "line", "size", "bag", "label", "asks")
    pairs = materialise(dealt(rest, ["key", "p", "q"], "size", "line").mapInArrow(others, "a long, b long").unionByName(few).distinct(), "pairs")
    return first.unionByName(materialise(verified(pairs, texts, allowed), "verified"))  # components() reads its links twice


def going_lines(lines: DataFrame, allowed: Callable) -> DataFrame:
    """h1, h2 and kept (doc_id, line_no) of the lines of classes that have several: all but the one at ``kept`` go."""
    distinct = lines.groupBy("h1", "h2").agg(F.min(F.struct("doc_id", "line_no")).alias("first"), F.count(F.lit(1)).alias("copies"), F.min("line").alias("text"))
    distinct = materialise(distinct.withColumn("line", F.monotonically_increasing_id()), "distinct")
    own = distinct.select("line", "text")
    keyed = own.select("line", F.col("text").alias("line_text"))
    inner = lambda d: d.select(F.col("line").alias("id"), F.col("line_text").alias("line"))
    met = materialise(met_by(lambda d: segment_keys(inner(d), allowed), keyed), "met")
    wanted = met.select("line")
    if allowed is not two_edits:
        long_lines = own.where(F.char_length("text") >= WINNOWED)
        bags = materialise(signed(long_lines), "bags")
        long = winnowed_met(long_lines, bags, allowed)
        wanted = wanted.union(long.select("line")).union(long.where("other IS NOT NULL").select("other"))
    texts = materialise(merged(own, wanted.distinct(), "line", "left_semi"), "texts")
    links = near_links(met, texts, allowed)
    if allowed is not two_edits:
        links = links.union(winnowed_links(long, texts, bags, allowed))
    labels = components(links).withColumnRenamed("node", "line")
    classed = merged(distinct.drop("text"), labels, "line", "left").withColumn("label", F.coalesce("label", "line"))
    kept = classed.groupBy("label").agg(F.min("first").alias("kept"), F.sum("copies").alias("copies")).where("copies > 1")
    return classed.select("h1", "h2", "label").join(kept, "label").select("h1", "h2", "kept")


def dropped(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", allowed: Callable = two_edits) -> DataFrame:
    """doc_id, the hash of the text and gone: the numbers of the lines that go."""
    lines = lines_of(docs, doc_id, text)
    places_ = materialise(lines.drop("line"), "places")
    going = settled(lambda: going_lines(lines, allowed), "going")
    out = merged(places_, going, ["h1", "h2"]).where(~((F.col("doc_id") == F.col("kept.doc_id")) & (F.col("line_no") == F.col("kept.line_no"))))
    return out.groupBy("doc_id", "print").agg(F.collect_set("line_no").alias("gone"))


def dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", allowed: Callable = two_edits) -> DataFrame:
    """The documents with later copies of lines taken out; columns as they came. allowed: two_edits, by_length or by_spots."""
    gone = dropped(docs, doc_id, text, allowed)
    own = docs.select(F.struct("*").alias("doc"), F.col(doc_id).cast("long").alias("doc_id"), F.xxhash64(text).alias("print"))
    joined = merged(own, gone, ["doc_id", "print"], "left")
    whole = F.col("doc").getField(text)
    lines = F.split(whole, "\n", -1)
    stay = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("gone"))
    left = F.transform(stay, lambda i: F.get(lines, i))
    cut = F.when(F.col("gone").isNull(), whole).otherwise(F.array_join(left, "\n"))
    return joined.select(*[(cut if c == text else F.col("doc").getField(c)).alias(c) for c in docs.columns])
