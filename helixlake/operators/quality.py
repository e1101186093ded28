"""Checks of tables and identifiers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from .tables import written

# Forms of identifiers.
ENTRY_ID = r"^[a-zA-Z0-9][a-zA-Z0-9_-]{0,63}\z"
ACCESSION = r"^([OPQ][0-9][A-Z0-9]{3}[0-9]|[A-NR-Z][0-9]([A-Z][A-Z0-9]{2}[0-9]){1,2})(-[0-9]+)?\z"


def valid_entry(c: Column) -> Column:
    return F.coalesce(c.rlike(ENTRY_ID), F.lit(False))


def valid_accession(c: Column) -> Column:
    return F.coalesce(c.rlike(ACCESSION), F.lit(False))


def null_counts(df: DataFrame, required: list[str]) -> DataFrame:
    """(column, nulls) of the required columns, in one pass."""
    one = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in required])
    return one.select(F.explode(F.map_from_arrays(F.array(*[F.lit(c) for c in required]), F.array(*[F.col(c) for c in required]))).alias("column", "nulls"))


def require(df: DataFrame, required: list[str]) -> DataFrame:
    bad = [r["column"] for r in null_counts(df, required).where("nulls > 0").collect()]
    if bad:
        raise ValueError(f"nulls in {', '.join(bad)}")
    return df


def written_checked(df: DataFrame, name: str, required: list[str], rows: bool = False) -> DataFrame:
    """df written to the shared folder and read back, its required columns counted for nulls by the write itself.

    rows: it must have some, too. What fails the check is an error; its plan runs once in any case.
    """
    seen = Observation()
    watched = df.observe(seen, F.count(F.lit(1)).alias("__rows"), *[F.count_if(F.col(c).isNull()).alias(c) for c in required])
    out = written(watched, name)
    raise_for(seen, name, required, rows)
    return out


def raise_for(seen: Observation, name: str, required: Sequence[str], rows: bool = False) -> int:
    """Wait for what a write observed, and fail it for nulls or, with ``rows``, for emptiness; returns the number of rows."""
    counts = seen.get
    bad = [c for c in required if counts[c]]
    if bad:
        raise ValueError(f"nulls in {', '.join(bad)}")
    if rows and not counts["__rows"]:
        raise ValueError(f"{name} is empty")
    return counts["__rows"]


def same_schema(df: DataFrame, names: list[str]) -> DataFrame:
    if df.columns != names:
        raise ValueError(f"columns {df.columns}, wanted {names}")
    return df


def require_rows(df: DataFrame, name: str) -> DataFrame:
    if df.isEmpty():
        raise ValueError(f"{name} is empty")
    return df


def lost_rows(before: DataFrame, after: DataFrame) -> DataFrame:
    """Rows of ``before``, as often as they are there, that ``after`` lacks in the columns they share."""
    shared = [c for c in before.columns if c in after.columns]
    return before.select(*shared).exceptAll(after.select(*shared))


def preserved(before: DataFrame, after: DataFrame) -> bool:
    """Whether the output holds all that the input held: no fewer rows, all columns, every row."""
    return set(before.columns) <= set(after.columns) and before.count() <= after.count() and lost_rows(before, after).isEmpty()


def without_canonical(segments: DataFrame) -> DataFrame:
    """(entry, chain) of the chains none of whose segments is canonical."""
    return segments.groupBy("entry", "chain").agg(F.bool_or("canonical_acc").alias("__any")).where("NOT coalesce(__any, false)").select("entry", "chain")
