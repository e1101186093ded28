"""Gapped alignments from diagonals: the best colinear chain of a pair's ungapped pieces, stitched into one gapped pair."""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Piece = tuple[int, int, int, int, int]  # qstart, tstart, qend, tend, score


class _Best:
    """The largest value put at a place or beyond it: a Fenwick tree over the places from the last to the first."""

    def __init__(self, size: int):
        self.size, self.top = size, [(0, 0)] * (size + 1)

    def put(self, place: int, value: tuple[int, int]) -> None:
        k = self.size - place
        while k <= self.size:
            self.top[k] = max(self.top[k], value)
            k += k & -k

    def beyond(self, place: int) -> tuple[int, int]:
        k, found = self.size - place, (0, 0)
        while k > 0:
            found = max(found, self.top[k])
            k -= k & -k
        return found


def best_chain(pieces: list[Piece]) -> list[Piece]:
    """The pieces of the largest sum of scores in which each begins behind the end of the one before on both sequences.

    Scores are positive. Of chains of one sum the one whose pieces come first in order is taken. From the end of
    the query to its start, a piece asks, where it ends, for the best chain that begins behind it, and is put in
    where it begins, so a pair of n pieces takes n log n.
    """
    pieces = sorted(pieces)
    places = sorted({p[1] for p in pieces})
    tree, total, behind = _Best(len(places)), [0] * len(pieces), [-1] * len(pieces)
    # at one place of the query pieces ask before any is put in
    events = sorted([(-p[2], 0, k) for k, p in enumerate(pieces)] + [(-p[0], 1, k) for k, p in enumerate(pieces)])
    for _, put, k in events:
        if put:
            tree.put(bisect_left(places, pieces[k][1]), (total[k], -k - 1))
        else:
            most, nth = tree.beyond(bisect_left(places, pieces[k][3] + 1))
            total[k], behind[k] = pieces[k][4] + most, -nth - 1
    out, k = [], max(range(len(pieces)), key=lambda k: (total[k], -k))
    while k >= 0:
        out.append(pieces[k])
        k = behind[k]
    return out


def stitched(query: str, target: str, chain: list[Piece]) -> tuple[str, str]:
    """The gapped pair of a chain: its pieces letter by letter; between two the query's letters stand over gaps, then the target's under gaps."""
    q, t, at, to = [], [], chain[0][0], chain[0][1]
    for qstart, tstart, qend, tend, _ in chain:
        over, under = query[at - 1 : qstart - 1], target[to - 1 : tstart - 1]
        q += [over, "-" * len(under), query[qstart - 1 : qend]]
        t += ["-" * len(over), under, target[tstart - 1 : tend]]
        at, to = qend + 1, tend + 1
    return "".join(q), "".join(t)


GAPPED = "query {query}, ref {ref}, qstart long, qend long, tstart long, tend long, segments long, score long, alnlen long, mismatch long, gapopen long, identity double, coverage double, qlen long, qaln string, taln string"


def gapped_alignments(hits: DataFrame, queries: DataFrame, refs: DataFrame, least: int = 10) -> DataFrame:
    """One gapped alignment of each (query, ref) from the hits of ``search.diagonal_align``.

    Hits of a pair are no more than the diagonals of its two sequences. Queries of fewer than ``least`` letters are
    filled up with X, as there. identity: equal letters over all columns; coverage: the query from the chain's
    start to its end.
    """
    own = hits.groupBy("query", "ref").agg(F.collect_list(F.struct("qstart", "tstart", "qend", "tend", "score")).alias("pieces"))
    q = queries.select("query", F.when(F.length("sequence") < least, F.rpad("sequence", least, "X")).otherwise(F.col("sequence")).alias("q"))
    both = own.join(q, "query").join(refs.select("ref", F.col("sequence").alias("t")), "ref").select("query", "ref", "pieces", "q", "t")
    schema = GAPPED.format(**{c: hits.schema[c].dataType.simpleString() for c in ("query", "ref")})
    names = [c.split()[0] for c in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for pieces, q, t in zip(*(batch.column(c).to_pylist() for c in (2, 3, 4)), strict=True):
                chain = best_chain([(p["qstart"], p["tstart"], p["qend"], p["tend"], p["score"]) for p in pieces])
                a, b = stitched(q, t, chain)
                same = sum(x == y for x, y in zip(a, b, strict=True))
                inner = sum(y[0] - x[2] + y[1] - x[3] - 2 for x, y in zip(chain, chain[1:], strict=False))  # columns with a gap
                (qs, ts, *_), (_, _, qe, te, _) = chain[0], chain[-1]
                rows.append((qs, qe, ts, te, len(chain), sum(p[4] for p in chain), len(a), len(a) - same - inner, opened(chain), same / len(a), (qe - qs + 1) / len(q), len(q), a, b))
            if rows:
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *(pa.array(c) for c in zip(*rows, strict=True))], names)

    return both.mapInArrow(run, schema)


def opened(chain: list[Piece]) -> int:
    """Gaps between the pieces of a chain, on either side."""
    return sum((b[0] > a[2] + 1) + (b[1] > a[3] + 1) for a, b in zip(chain, chain[1:], strict=False))
