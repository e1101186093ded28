"""Approximate nearest neighbours by additive quantisation.

Vectors are normalised to length one. Codebooks of full-dimensional codewords are learned one after the
other on the residuals of a bounded sample; a vector is encoded by beam search as one codeword of each, and
the norm of their sum is stored beside the codes. A query is compared with all codes through tables of its
inner products with the codewords; the best of each block of codes are reranked exactly, in double precision,
on the original vectors. The k-th score so found is a floor: a second pass computes the exact score of every
vector whose inner product by its code, plus the length of what the code leaves over, can reach the floor, so
nothing is lost to the number of codes reranked, however many vectors crowd in one direction.

The index holds every distinct vector once, with the few smallest ids that share it (as many as a result
can use), so thousands of copies cannot crowd a shortlist. Codes travel in packs. A task takes a block of queries
through all packs of one part of the index and keeps each query's best on the way; the number of parts grows with
the index.

Scores that agree in twelve decimals are ties. Null vectors, zero vectors and those with a null or non-finite component take no part; so do rows with a
null id. Ties go to the smaller id. Rows with equal ids count as one vector each. With fewer candidates than
neighbours asked for, all are returned; an empty table gives an empty result.
"""

from __future__ import annotations

import io
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import dealt, in_one_task, materialise

BOOKS, WORDS, BEAM = 16, 256, 8
#: Bound of the sample that codebooks are learned on.
MAX_TRAIN = 12_000
#: Codes of each part of the index that are reranked exactly for a query; they give it a floor.
RERANKED = 64
PACK, SCAN, PARTS, QUERY_BLOCK = 512, 4096, 2, 512  # codes of a row, codes scored at once, parts of the index at least, queries of a task
#: Vectors of a part of the index; what an inner product in single precision may be off; decimals of a score.
PART, SLACK, DECIMALS = 65_536, 1e-4, 12


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def encode(x: np.ndarray, books: np.ndarray, beam: int = BEAM) -> np.ndarray:
    """(vectors, books) codes by beam search over the residuals."""
    n = len(x)
    codes, left = np.zeros((n, 1, len(books)), np.uint8), x[:, None, :].astype(np.float32)
    for m, book in enumerate(books):
        norm = (book * book).sum(1)
        # |r - c|^2 less |r|^2, plus what the beam has so far: |r|^2
        cost = (left * left).sum(2)[:, :, None] - 2 * left @ book.T + norm
        wide = cost.shape[1]
        cost = cost.reshape(n, -1)
        keep = min(beam, cost.shape[1])
        best = np.argpartition(cost, keep - 1, axis=1)[:, :keep]
        best = np.take_along_axis(best, np.take_along_axis(cost, best, 1).argsort(1), 1)
        at, word = best // len(book), best % len(book)
        rows = np.arange(n)[:, None]
        codes = codes[rows, np.minimum(at, wide - 1)].copy()
        codes[:, :, m] = word
        left = left[rows, np.minimum(at, wide - 1)] - book[word]
    return codes[:, 0]


def encoded(x: np.ndarray, books: np.ndarray, beam: int = BEAM) -> np.ndarray:
    """:func:`encode` a few rows at a time, so that the beams stay small."""
    return np.concatenate([encode(x[a : a + 512], books, beam) for a in range(0, len(x), 512)])


def learn(x: np.ndarray, seed: int = 3, rounds: int = 6) -> np.ndarray:
    """(books, words, dims): k-means on the residuals, book after book, then two joint least-squares passes."""
    r = np.random.default_rng(seed)
    books = np.zeros((BOOKS, WORDS, x.shape[1]), np.float32)
    left = x.astype(np.float32)
    for m in range(BOOKS):
        book = left[r.choice(len(left), WORDS, replace=len(left) < WORDS)].copy()
        for _ in range(rounds):
            near = ((book * book).sum(1) - 2 * left @ book.T).argmin(1)
            count = np.bincount(near, minlength=WORDS)
            total = np.zeros_like(book)
            np.add.at(total, near, left)
            some = count > 0
            book[some] = total[some] / count[some, None]
        books[m] = book
        left = left - book[((book * book).sum(1) - 2 * left @ book.T).argmin(1)]
    for _ in range(2):
        codes = encoded(x, books, 4).astype(np.int64)
        # codewords that together fit the sample best, given its codes: conjugate gradients on the normal equations
        flat = codes + np.arange(BOOKS) * WORDS
        gram = np.zeros((BOOKS * WORDS, BOOKS * WORDS), np.float32)
        for a in range(BOOKS):
            for b in range(BOOKS):
                pair = np.bincount(codes[:, a] * WORDS + codes[:, b], minlength=WORDS * WORDS)
                gram[a * WORDS : (a + 1) * WORDS, b * WORDS : (b + 1) * WORDS] = pair.reshape(WORDS, WORDS)
        right = np.zeros((BOOKS * WORDS, x.shape[1]), np.float32)
        for a in range(BOOKS):
            np.add.at(right, flat[:, a], x)
        gram[np.diag_indices(len(gram))] += 0.1
        books = np.linalg.solve(gram, right + 0.1 * books.reshape(-1, x.shape[1])).reshape(books.shape).astype(np.float32)
    return books


class Nearest:
    """The best codes of each query of a block, kept while packs go by."""

    def __init__(self, books: np.ndarray, depth: int):
        self.books, self.depth, self.key = books, depth, None
        self.start(None)

    def start(self, key: tuple[int, int] | None) -> None:
        self.key, self.queries, self.tables = key, np.zeros(0, np.int64), None
        self.score, self.node = np.zeros((0, 0), np.float32), np.zeros((0, 0), np.int64)

    def ask(self, queries: np.ndarray, vectors: np.ndarray) -> None:
        """Queries to the block; they all come before its packs."""
        table = np.einsum("qd,mwd->mwq", unit(vectors).astype(np.float32), self.books, optimize=True)
        self.queries = np.concatenate([self.queries, queries])
        self.tables = table if self.tables is None else np.concatenate([self.tables, table], axis=2)
        self.score, self.node = np.zeros((len(self.queries), 0), np.float32), np.zeros((len(self.queries), 0), np.int64)

    def meet(self, ids: np.ndarray, codes: np.ndarray, norms: np.ndarray) -> None:
        if not len(self.queries):
            return
        codes = codes.reshape(-1, len(self.books))
        found = self.tables[0][codes[:, 0]]
        for m in range(1, len(self.books)):
            found += self.tables[m][codes[:, m]]
        found /= np.maximum(norms, 1e-12)[:, None]
        score = np.concatenate([self.score, found.T], axis=1)
        node = np.concatenate([self.node, np.broadcast_to(ids, (len(self.queries), len(ids)))], axis=1)
        if score.shape[1] > self.depth:
            top = np.argpartition(-score, self.depth - 1, axis=1)[:, : self.depth]
            score, node = np.take_along_axis(score, top, 1), np.take_along_axis(node, top, 1)
        self.score, self.node = score, node

    def rows(self) -> Iterator[pa.RecordBatch]:
        if self.node.size:
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(self.queries, self.node.shape[1])), pa.array(self.node.ravel()), pa.array(self.score.ravel().astype(np.float64))], ["query_id", "node", "near"])


class Reaching:
    """The ``keep`` best vectors of each query of a block, of those whose bound reaches the query's floor."""

    def __init__(self, books: np.ndarray, keep: int):
        self.books, self.keep = books, keep
        self.start(None)

    def start(self, key: tuple[int, int] | None) -> None:
        self.key, self.queries, self.best = key, [], []
        self.unit, self.floor, self.tables = None, np.zeros(0), None

    def ask(self, queries: list[int], vectors: np.ndarray, floor: np.ndarray) -> None:
        own = unit(vectors)
        self.unit = own if self.unit is None else np.concatenate([self.unit, own])
        self.queries += queries
        self.floor = np.concatenate([self.floor, floor])
        self.best += [(np.zeros(0), np.zeros(0, np.int64)) for _ in queries]
        self.tables = np.einsum("qd,mwd->mwq", self.unit.astype(np.float32), self.books, optimize=True)

    def meet(self, ids: np.ndarray, codes: np.ndarray, gaps: np.ndarray, vectors: np.ndarray) -> None:
        if not self.queries:
            return
        codes = codes.reshape(-1, len(self.books))
        bound = self.tables[0][codes[:, 0]]
        for m in range(1, len(self.books)):
            bound += self.tables[m][codes[:, m]]
        bound += gaps[:, None] + np.float32(SLACK)
        some = np.flatnonzero((bound >= self.floor).any(1))
        if not len(some):
            return
        score = np.round(self.unit @ vectors.reshape(len(ids), -1)[some].T, DECIMALS)
        open_ = score >= self.floor[:, None]
        for q in np.flatnonzero(open_.any(1)):
            at = np.flatnonzero(open_[q])
            value, node = np.concatenate([self.best[q][0], score[q, at]]), np.concatenate([self.best[q][1], ids[some[at]]])
            top = np.lexsort((node, -value))[: self.keep]
            self.best[q] = value[top], node[top]
            if len(top) == self.keep:
                self.floor[q] = max(self.floor[q], value[top[-1]])

    def rows(self) -> Iterator[pa.RecordBatch]:
        if self.queries:
            query = np.repeat(np.array(self.queries, np.int64), [len(v) for v, _ in self.best])
            yield pa.RecordBatch.from_arrays([pa.array(query), pa.array(np.concatenate([n for _, n in self.best])), pa.array(np.concatenate([v for v, _ in self.best]))], ["query_id", "node", "score"])


def _runs(batch: pa.RecordBatch, keys: list[str]) -> Iterator[pa.RecordBatch]:
    """Pieces of a sorted batch with equal keys."""
    change = np.zeros(batch.num_rows, bool)
    for k in keys:
        c = batch.column(batch.schema.get_field_index(k)).to_numpy()
        change[1:] |= c[1:] != c[:-1]
    edges = [0, *np.flatnonzero(change).tolist(), batch.num_rows]
    for a, b in zip(edges[:-1], edges[1:], strict=True):
        yield batch.slice(a, b - a)


def usable(vector: Column) -> Column:
    """True for a vector without null or non-finite parts that isn't zero throughout."""
    bad = F.exists(vector, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return F.coalesce(~bad & F.exists(vector, lambda v: v != 0), F.lit(False))


def distinct_vectors(vectors: DataFrame, k: int) -> DataFrame:
    """(vector, ids): each distinct vector with the k + 1 smallest ids that have it; tasks merge copies before the shuffle."""

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: dict[bytes, list[int]] = {}
            raw = batch.column(1).to_pylist()
            for i, x in zip(batch.column(0).to_pylist(), raw, strict=True):
                seen.setdefault(x, []).append(i)
            yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.binary()), pa.array([sorted(x)[: k + 1] for x in seen.values()], pa.list_(pa.int64()))], ["vector", "ids"])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.column(1).to_pylist()
            # 0.0 is added so that both signs of zero are one vector
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([(np.array(x, np.float64) + 0.0).tobytes() for x in rows], pa.binary())], ["vec_id", "vector"])

    packed = vectors.mapInArrow(pack, "vec_id long, vector binary").mapInArrow(merge, "vector binary, ids array<long>")
    return packed.groupBy("vector").agg(F.slice(F.sort_array(F.flatten(F.collect_list("ids"))), 1, k + 1).alias("ids"))


def learned(sample: DataFrame, dims: int) -> np.ndarray:
    """The codebooks of a sample of bounded size, learned by one task."""

    def work(table: pa.Table) -> bytes:
        known = np.array([np.frombuffer(v) for v in table.sort_by("node").column("vector").to_pylist()] or [np.ones(dims)])
        out = io.BytesIO()
        np.save(out, learn(unit(known)).astype(np.float32))
        return out.getvalue()

    return np.load(io.BytesIO(in_one_task(sample.select("node", "vector"), work)))


def search(vectors: DataFrame, is_query: Column, k: int = 5, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """query_id, rank (from 1), vec_id, score (cosine): the k nearest found of every row that ``is_query`` picks.

    ``is_query`` is a condition on a column named vec_id.
    """
    spark = vectors.sparkSession
    good = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("vector")).where(F.col("vec_id").isNotNull() & usable(F.col("vector")))
    index = materialise(distinct_vectors(good, k).withColumn("node", F.array_min("ids")).withColumn("dims", F.octet_length("vector")), "vectors")
    n = index.count()
    if not n:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    sample = index if n <= MAX_TRAIN else index.where(F.pmod(F.xxhash64("node", F.lit("sample")), F.lit(1 << 30)) < int((1 << 30) * MAX_TRAIN / n))
    by_dims = index.groupBy("dims").agg(F.count(F.lit(1)).alias("n")).orderBy("dims").collect()  # lengths of vectors: normally one
    found = []
    for row in by_dims:
        own = index.where(F.col("dims") == row["dims"])
        books = learned(sample.where(F.col("dims") == row["dims"]), row["dims"] // 8)
        found.append(_search_index(own, row["n"], good.where(is_query & (F.size("vector") * 8 == row["dims"])), books, k))
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def _search_index(index: DataFrame, n: int, queries: DataFrame, books: np.ndarray, k: int) -> DataFrame:
    spark = index.sparkSession
    shipped = spark.sparkContext.broadcast(books)  # BOOKS * WORDS codewords

    parts = max(PARTS, -(-n // PART))

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = shipped.value
        for batch in batches:
            if not batch.num_rows:
                continue
            x = unit(np.array([np.frombuffer(v) for v in batch.column(1).to_pylist()]))
            codes = encoded(x, books)
            whole = sum(books[m][codes[:, m]] for m in range(len(books)))
            norm, nodes = np.linalg.norm(whole, axis=1).astype(np.float32), batch.column(0).to_numpy()
            gap = np.linalg.norm(x - whole, axis=1).astype(np.float32)
            packs = [(int(nodes[a]), *(v[a : a + PACK].tobytes() for v in (nodes, codes, norm, gap, x))) for a in range(0, len(x), PACK)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*packs, strict=True)], ["pack", "ids", "codes", "norms", "gaps", "units"])

    coded = materialise(index.select("node", "vector").mapInArrow(code, "pack long, ids binary, codes binary, norms binary, gaps binary, units binary"), "codes")
    ask_blocks = max(1, -(-queries.count() // QUERY_BLOCK))
    asked = queries.select(F.col("vec_id").alias("query_id"), "vector").distinct().withColumn("asked", F.pmod(F.xxhash64("query_id", F.lit("q")), F.lit(ask_blocks)))
    asked = materialise(asked, "queries")
    # every block of queries meets every pack of codes, the packs of a part in one task
    kinds = "cast(asked as int) asked", "cast(part as int) part"
    packs = coded.select(F.explode(F.sequence(F.lit(0), F.lit(ask_blocks - 1))).alias("asked"), F.pmod(F.xxhash64("pack"), F.lit(parts)).alias("part"), "pack", "ids", "codes", "norms")
    packs = packs.selectExpr(*kinds, "1 kind", "pack id", "ids", "codes", "norms", "cast(null as array<double>) vector")
    asks = asked.select("asked", "query_id", "vector", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"))
    asks = asks.selectExpr(*kinds, "0 kind", "query_id id", "cast(null as binary) ids", "cast(null as binary) codes", "cast(null as binary) norms", "vector")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = Nearest(shipped.value, RERANKED)
        for batch in batches:
            if not batch.num_rows:
                continue
            for part in _runs(batch, ["asked", "part", "kind"]):
                key, kind = (part.column(0)[0].as_py(), part.column(1)[0].as_py()), part.column(2)[0].as_py()
                if key != best.key:
                    yield from best.rows()
                    best.start(key)
                if kind == 0:
                    best.ask(part.column(3).to_numpy(), np.array(part.column(7).to_pylist(), np.float64))
                else:
                    for a in range(0, part.num_rows, SCAN // PACK):
                        ids, codes, norms = (b"".join(part.column(c).slice(a, SCAN // PACK).to_pylist()) for c in (4, 5, 6))
                        best.meet(np.frombuffer(ids, np.int64), np.frombuffer(codes, np.uint8), np.frombuffer(norms, np.float32))
        yield from best.rows()

    near = dealt(packs.unionByName(asks), ["asked", "part"], "kind", "id").mapInArrow(scan, "query_id long, node long, near double")
    full = near.select("query_id", "node").join(index.select("node", "ids", F.col("vector").alias("found")), "node").join(asked.select("query_id", "vector"), "query_id")

    def rerank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            a = np.array(batch.column(2).to_pylist(), np.float64)
            b = np.array([np.frombuffer(v) for v in batch.column(1).to_pylist()])
            score = (a * b).sum(1) / (np.sqrt((a * a).sum(1)) * np.sqrt((b * b).sum(1)))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(3), pa.array(score)], ["query_id", "ids", "score"])

    scored = full.select("query_id", "found", "vector", "ids").mapInArrow(rerank, "query_id long, ids array<long>, score double")
    every = scored.select("query_id", "score", F.explode("ids").alias("vec_id")).where("vec_id <> query_id")
    rank = Window.partitionBy("query_id").orderBy(F.desc(F.round("score", DECIMALS)), "vec_id")
    first = every.withColumn("rank", F.row_number().over(rank)).where(F.col("rank") == k).select("query_id", (F.col("score") - 10.0**-DECIMALS).alias("floor"))
    every = _reaching(index, coded, asked.join(materialise(first, "floors"), "query_id", "left"), ask_blocks, parts, shipped, k)
    return every.withColumn("rank", F.row_number().over(rank)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _reaching(index: DataFrame, coded: DataFrame, asked: DataFrame, ask_blocks: int, parts: int, shipped, k: int) -> DataFrame:
    """query_id, score, vec_id: of all vectors that can reach a query's floor the best, enough for k of them; the query itself is left out."""
    kinds = "cast(asked as int) asked", "cast(part as int) part"
    packs = coded.select(F.explode(F.sequence(F.lit(0), F.lit(ask_blocks - 1))).alias("asked"), F.pmod(F.xxhash64("pack"), F.lit(parts)).alias("part"), "pack", "ids", "codes", "gaps", "units")
    packs = packs.selectExpr(*kinds, "1 kind", "pack id", "ids", "codes", "gaps", "units", "cast(null as array<double>) vector", "cast(null as double) floor")
    asks = asked.select("asked", "query_id", "vector", F.coalesce("floor", F.lit(-2.0)).alias("floor"), F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"))
    asks = asks.selectExpr(*kinds, "0 kind", "query_id id", *[f"cast(null as binary) {c}" for c in ("ids", "codes", "gaps", "units")], "vector", "floor")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = Reaching(shipped.value, k + 1)
        for batch in batches:
            if not batch.num_rows:
                continue
            for part in _runs(batch, ["asked", "part", "kind"]):
                key, kind = (part.column(0)[0].as_py(), part.column(1)[0].as_py()), part.column(2)[0].as_py()
                if key != best.key:
                    yield from best.rows()
                    best.start(key)
                if kind == 0:
                    best.ask(part.column(3).to_pylist(), np.array(part.column(8).to_pylist(), np.float64), part.column(9).to_numpy())
                else:
                    for a in range(0, part.num_rows, SCAN // PACK):
                        ids, codes, gaps, units = (b"".join(part.column(c).slice(a, SCAN // PACK).to_pylist()) for c in (4, 5, 6, 7))
                        best.meet(np.frombuffer(ids, np.int64), np.frombuffer(codes, np.uint8), np.frombuffer(gaps, np.float32), np.frombuffer(units))
        yield from best.rows()

    near = dealt(packs.unionByName(asks), ["asked", "part"], "kind", "id").mapInArrow(scan, "query_id long, node long, score double")
    return near.join(index.select("node", "ids"), "node").select("query_id", "score", F.explode("ids").alias("vec_id")).where("vec_id <> query_id")
