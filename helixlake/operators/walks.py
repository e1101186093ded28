"""Two ways through positions: rows of a key gone through once in order, and points met with the ranges that cover them."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import chain, groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructField, StructType

FLUSH = 10_000  # rows that a walk holds before it passes them on
BIN = 256  # positions of a bin


def walked(rows: DataFrame, keys: list[str], order: list[str | Column], given: list[str], work: Callable[[Iterator[tuple]], Iterator[tuple]], made: str | StructType, keyed: bool = True) -> DataFrame:
    """What ``work`` makes of the rows of each key, which it gets one by one in order, as tuples of the columns ``given``.

    Rows of a key lie together and sorted, so they stream by, across the batches of a task; what is held of them is
    up to ``work``. keyed: the key's columns stand before those of ``made``.
    """
    fields = [StructField(k, rows.schema[k].dataType) for k in keys] if keyed else []
    schema = StructType([*fields, *(StructType.fromDDL(made) if isinstance(made, str) else made)])
    arrow, n = to_arrow_schema(schema), len(keys)
    sorted_ = rows.repartition(*keys).sortWithinPartitions(*keys, *order).select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)], *given)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []

        def batch() -> pa.RecordBatch:
            cols = zip(*held, strict=True) if held else [()] * len(arrow)
            out = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, arrow, strict=True)], schema=arrow)
            held.clear()
            return out

        flat = chain.from_iterable(zip(*(c.to_pylist() for c in b.columns), strict=True) for b in batches)
        for key, own in groupby(flat, key=lambda r: r[:n]):
            for x in work(r[n:] for r in own):
                held.append((*key, *x) if keyed else x)
                if len(held) >= FLUSH:
                    yield batch()
        yield batch()

    return sorted_.mapInArrow(run, schema)


def covering(points: DataFrame, ranges: DataFrame, keys: list[str], point: str, start: str, end: str) -> DataFrame:
    """Points with the ranges of their key that cover them: all columns of the points, and those of the ranges besides the keys.

    A range has a row for each bin of positions that it reaches, a point lies in one bin, so they meet by equal keys
    and bins, a pair once at most; the test of the range follows. A range that ends before it begins covers nothing.
    """
    at = lambda c: F.floor(F.col(c) / BIN).cast("long")
    more = [c for c in ranges.columns if c not in keys]
    bins = F.explode(F.sequence(at(start), at(end))).alias("__rbin")
    theirs = ranges.where(F.col(start) <= F.col(end)).select(bins, *[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)], *[F.col(c).alias(f"__r{i}") for i, c in enumerate(more)])
    name = {c: f"__r{i}" for i, c in enumerate(more)}
    same = [F.col(k) == F.col(f"__k{i}") for i, k in enumerate(keys)] + [F.col("__bin") == F.col("__rbin")]
    inside = F.col(point).between(F.col(name[start]), F.col(name[end]))
    joined = points.withColumn("__bin", at(point)).join(theirs, [*same, inside])
    return joined.select(*points.columns, *[F.col(name[c]).alias(c) for c in more])
