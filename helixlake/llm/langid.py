"""Language ID by rank-order profiles of character n-grams.

The profile of a language, or of a document, is the list of its most frequent n-grams of one to three
letters (lower-cased, a word border counts as a letter at either end), ties by the n-gram itself. A document
goes to the language whose profile has the smallest out-of-place distance to its own; equal distances go to
the language that sorts first. A text that is null or has no letter is ``und`` with score 0, as is every
text when nothing was learned. Repeated rows are predicted alike; an empty table gives an empty result;
columns beyond the named ones are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import slices

PROFILE = 300
#: Bound of the sample that a profile is learned from: documents of each language.
MAX_TRAIN_DOCS = 1000


@cache
def letters() -> np.ndarray:
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


def grams(texts: list[str | None]) -> Iterator[np.ndarray]:
    """For each text its n-grams as packed code points (21 bits each), with repeats."""
    joined = "\0".join((x or "").lower().replace("\0", " ") for x in texts)
    codes = np.frombuffer(("\0" + joined + "\0").encode("utf-32-le", "surrogatepass"), np.uint32)
    border = np.flatnonzero(codes == 0)  # of documents
    c = np.where(letters()[codes], codes, 0).astype(np.int64)
    one, solid = c, c > 0
    two = (c[:-1] << 21) | c[1:]
    three = (c[:-2] << 42) | two[1:]
    ok2, ok3 = solid[:-1] | solid[1:], solid[1:-1]
    at1, at2, at3 = np.flatnonzero(solid), np.flatnonzero(ok2), np.flatnonzero(ok3)
    one, two, three = one[at1], two[at2] | (1 << 62), three[at3]
    # a bigram keeps a mark of its own: a trigram that starts at a word border would pack to the same number
    b1, b2, b3 = (np.searchsorted(at, border) for at in (at1, at2, at3))
    for d in range(len(border) - 1):
        yield np.concatenate([one[b1[d] : b1[d + 1]] | (1 << 61), two[b2[d] : b2[d + 1]], three[b3[d] : b3[d + 1]]])


def ranked(found: np.ndarray, most: int = PROFILE) -> np.ndarray:
    """The most frequent values, most frequent first, ties by value."""
    found.sort()
    new = np.flatnonzero(np.concatenate([[True], found[1:] != found[:-1]]))
    counts = np.diff(np.concatenate([new, [len(found)]]))
    return found[new][np.argsort(-counts, kind="stable")[:most]]


def fit(docs: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id", max_docs: int = MAX_TRAIN_DOCS) -> list[tuple[str, list[int]]]:
    """(language, profile) of every language of the rows that have both; ``max_docs`` documents of each are read."""
    known = docs.where(F.col(text).isNotNull() & F.col(lang).isNotNull()).select(F.col(text).alias("text"), F.col(lang).alias("lang"), F.col(key).alias("key"))
    share = known.groupBy("lang").agg(F.expr(f"least(1.0D, {max_docs} / count(1))").alias("share"))
    taken = known.join(F.broadcast(share), "lang").where(F.pmod(F.xxhash64("key", F.lit("sample")), F.lit(1 << 30)) < F.col("share") * (1 << 30))  # share: a row for each language

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            by: dict[str, list[np.ndarray]] = {}
            for name, found in zip(part.column(0).to_pylist(), grams(part.column(1).to_pylist()), strict=True):
                by.setdefault(name, []).append(found)
            for name, found in by.items():
                values, counts = np.unique(np.concatenate(found), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array([name] * len(values), pa.string()), pa.array(values), pa.array(counts)], ["lang", "gram", "n"])

    totals = taken.select("lang", "text").mapInArrow(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    top = totals.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram"))).where(f"rank <= {PROFILE}")
    rows = top.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("rank", "gram"))).alias("p")).orderBy("lang").collect()  # PROFILE values of each language
    return [(r["lang"], [x["gram"] for x in r["p"]]) for r in rows]


class Profiles:
    """All profiles side by side: the rank of each n-gram in each language, PROFILE where it has none."""

    def __init__(self, profiles: list[tuple[str, list[int]]]):
        self.names = [name for name, _ in profiles]
        self.grams = np.unique(np.concatenate([np.array(p, np.int64) for _, p in profiles] or [np.zeros(0, np.int64)]))
        self.rank = np.full((len(self.grams), len(profiles)), -1, np.int64)
        for k, (_, p) in enumerate(profiles):
            self.rank[np.searchsorted(self.grams, p), k] = np.arange(len(p))

    def predict(self, found: np.ndarray) -> tuple[str, float]:
        if not len(found) or not self.names:
            return "und", 0.0
        own = ranked(found)
        at = np.minimum(np.searchsorted(self.grams, own), len(self.grams) - 1)
        hit = self.grams[at] == own
        rank = self.rank[at[hit]]
        off = np.where(rank < 0, PROFILE, np.abs(rank - np.flatnonzero(hit)[:, None])).sum(axis=0) + PROFILE * (len(own) - int(hit.sum()))
        best = int(off.argmin())
        return self.names[best], 1 - float(off[best]) / (PROFILE * len(own))


def predict(docs: DataFrame, profiles: list[tuple[str, list[int]]], doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, lang_pred and score (0 to 1: one less the mean distance, as a share of the largest)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Profiles(profiles)
        for part in slices(batches, text, 1 << 20):
            out = [known.predict(found) for found in grams(part.column(1).to_pylist())]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array([x[0] for x in out], pa.string()), pa.array([x[1] for x in out], pa.float64())], ["doc_id", "lang_pred", "score"])

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias(text)).mapInArrow(run, "doc_id long, lang_pred string, score double")
