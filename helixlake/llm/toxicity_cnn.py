"""Toxicity: a convolutional text classifier over hashed word embeddings, in numpy.

A word (a run of letters or digits, lower-cased) is hashed whole and by its first 4, 5 and 6 bytes to rows of one
table of embeddings; its embedding is the sum of theirs. Any word has a row, whether it was seen in fitting or
not; rows that were not seen are zero. Filters one, two and three words wide are max-pooled over the whole
document, at the places where they fit in it, and combined into a logit. The language of a text is guessed from
its words, and a threshold calibrated for that language on documents apart from the fitted ones is where the
score is one half. The documents of all languages count a little for each, so a language with few of them has a
threshold near the common one, and a text without known words has the common one itself.

Every labelled document is learned from. Spark counts the words of all of them; the filters and embeddings are
fitted to parts of the documents at once, in tasks, and averaged over the parts after each of a few rounds, an
embedding over those parts alone that moved it; thresholds come from the counts of all scores, in steps of 1 / FINE.

Null texts count as empty and get the score of a text without any filter firing; texts are read in full, however
long. Rows are scored one by one (repeated rows alike); an empty table gives an empty result; columns beyond the
named ones are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import coefficients, groups, materialise, merged, mix, slices, text_bytes, word_hashes, word_spans

BITS = 18  # rows of the embedding table: 2 ** BITS, 8 MB
DIM, WIDTHS, FILTERS = 8, (1, 2, 3), 6
PREFIXES = (4, 5, 6)
#: Labelled documents that are fitted together, rounds after which the parts are averaged, and steps of a score in the calibration.
PART, ROUNDS, FINE = 4000, 3, 256
#: Documents that the common calibration counts for in that of a language.
SHARED = 10
_GAP = np.ones(256, bool)
_GAP[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False


def features(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(words, 4) hashed ids, 0 where a word is too short for a prefix, and the n + 1 offsets of documents."""
    data, offsets = text_bytes(pc.utf8_lower(column.cast(pa.large_string())))
    starts, ends, first = word_spans(data, offsets, _GAP)
    out = np.zeros((len(starts), 1 + len(PREFIXES)), np.int64)
    if not len(starts):
        return out, first
    low = np.uint64((1 << BITS) - 1)
    out[:, 0] = (word_hashes(data, starts, ends) & low) | np.uint64(1)
    factors = coefficients(max(PREFIXES), 31)
    padded = np.concatenate([data, np.zeros(max(PREFIXES), np.uint8)])
    h = np.zeros(len(starts), np.uint64)
    for k in range(max(PREFIXES)):
        h += (padded[starts + k].astype(np.uint64) + np.uint64(1)) * factors[k]
        if k + 1 in PREFIXES:
            out[:, 1 + PREFIXES.index(k + 1)] = np.where(ends - starts >= k + 1, (mix(h + np.uint64(k)) & low) | np.uint64(1), 0)
    return out, first


def convolved(x: np.ndarray, p: dict, width: int) -> np.ndarray:
    """Filter outputs at every word; those of a filter that reaches over the end are not meant to be used."""
    y = x @ p[f"conv{width}"][:DIM]
    for j in range(1, width):
        y[:-j] += x[j:] @ p[f"conv{width}"][j * DIM : (j + 1) * DIM]
    return y


def forward(rows: np.ndarray, first: np.ndarray, p: dict) -> np.ndarray:
    """Logits of documents; rows: the embedding rows of each word. A filter counts where it fits in its document."""
    n, words = len(first) - 1, np.diff(first)
    x = p["emb"][rows].sum(axis=1)
    pooled = np.zeros((n, FILTERS * len(WIDTHS)), np.float32)
    left = np.repeat(first[1:], words) - np.arange(len(x))  # words from each one to the end of its document
    for i, width in enumerate(WIDTHS):
        full = np.flatnonzero(words >= width)
        if not len(full):
            break
        y = convolved(x, p, width)
        y[left < width] = -np.inf
        pooled[full, i * FILTERS : (i + 1) * FILTERS] = np.maximum.reduceat(y, first[:-1][words > 0], axis=0)[words[words > 0] >= width]
    return np.maximum(pooled + p["bias"], 0) @ p["out"] + p["c"]


def tallies(rows: np.ndarray, doc: np.ndarray, label: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The rows that documents hold, how many documents hold each, and how many of those are of class 1; doc: that of each word."""
    pairs = np.unique(np.stack([rows.ravel(), np.repeat(doc, rows.shape[1])], 1), axis=0)
    at, back = np.unique(pairs[:, 0], return_inverse=True)
    return at, np.bincount(back, minlength=len(at)), np.bincount(back, weights=label[pairs[:, 1]], minlength=len(at)).astype(np.int64)


def started(at: np.ndarray, seen: np.ndarray, ones: np.ndarray, n1: int, n0: int, r: np.random.Generator) -> dict:
    """Parameters before the first step: a row starts with the log odds of the documents that hold it, drawn to 0 the fewer they are."""
    n1, n0 = max(1, n1), max(1, n0)
    odds = (np.log((ones + 0.5) / (n1 + 1)) - np.log((seen - ones + 0.5) / (n0 + 1))) * (seen / (seen + 4))
    p = {"emb": np.zeros((1 << BITS, DIM), np.float32), "bias": np.full(FILTERS * len(WIDTHS), -0.5, np.float32), "c": np.zeros(1, np.float32)}
    known = at > 0
    p["emb"][at[known]] = r.normal(0, 0.01, (known.sum(), DIM))
    p["emb"][at[known], 0] = np.clip(odds[known], -4, 4) / 4
    for w in WIDTHS:
        p[f"conv{w}"] = r.normal(0, 0.1, (w * DIM, FILTERS)).astype(np.float32)
        p[f"conv{w}"][0] = np.abs(p[f"conv{w}"][0]) + 0.5
    p["out"] = np.full(FILTERS * len(WIDTHS), 0.3, np.float32)
    return p


def tongues(at: np.ndarray, of: np.ndarray, words: np.ndarray, n: int) -> np.ndarray:
    """Naive Bayes over whole words, which guesses the language of a text: the log share of each row in each of n languages."""
    spoken = np.full((1 << BITS, max(1, n)), 0.5)
    np.add.at(spoken, (at, of), words)
    heard = (spoken > 0.5).any(axis=1)
    return np.where(heard[:, None], np.log(spoken / spoken.sum(0)), 0).astype(np.float32)


def calibrated(logit: np.ndarray, label: np.ndarray, count: np.ndarray, guess: np.ndarray, n: int) -> np.ndarray:
    """Thresholds of n languages and the common one, of scores that occur so often."""
    common = count * (SHARED / max(SHARED, count.sum()))
    cuts = [threshold(np.concatenate([logit, logit[own]]), np.concatenate([label, label[own]]), np.concatenate([common, count[own]])) for own in (guess == g for g in range(n))]
    return np.array([*cuts, threshold(logit, label, common)])


def train(texts: list[str | None], label: np.ndarray, lang: list[str | None], epochs: int = 6, seed: int = 5) -> dict:
    """:func:`fit` for documents at hand, as one part; a quarter of them is kept for the calibration."""
    rows, first = features(pa.array(texts, pa.large_string()))
    n, r = len(texts), np.random.default_rng(seed)
    both = n > 0 and label.min() != label.max()
    doc = np.repeat(np.arange(n), np.diff(first))
    fitted = r.random(n) < 0.75 if both and min(label.sum(), n - label.sum()) >= 12 else np.ones(n, bool)
    p = started(*tallies(rows[fitted[doc]], doc[fitted[doc]], label), int(label[fitted].sum()), int((1 - label[fitted]).sum()), r)
    if both:
        fit_steps(p, rows, first, label, np.flatnonzero(fitted), max(epochs, min(60, -(-600 * 16 // fitted.sum()))), label[fitted].mean(), r)
    names = sorted({x for x in lang if x is not None})
    of = np.array([names.index(x) if x is not None else -1 for x in lang], np.int64)[doc]
    spoken = tongues(rows[of >= 0, 0], of[of >= 0], np.ones((of >= 0).sum()), len(names))
    apart = ~fitted if (~fitted).any() else fitted
    if both and label[apart].min() != label[apart].max():
        cut = calibrated(forward(rows, first, p)[apart], label[apart], np.ones(apart.sum()), guessed(rows, first, spoken)[apart], len(names))
    else:
        cut = uncalibrated(both, label.any(), len(names))
    return {"p": p, "spoken": spoken, "cut": cut, "names": names}


def uncalibrated(both: bool, any_one: bool, n: int) -> np.ndarray:
    """Thresholds without documents of both classes to set them by: with one class alone every document is of it."""
    return np.full(n + 1, 0.0 if both else 1e3 * (1 - 2 * float(any_one)))


def fit_steps(p: dict, rows: np.ndarray, first: np.ndarray, label: np.ndarray, docs: np.ndarray, epochs: int, share: float, r: np.random.Generator) -> None:
    """Adam on batches of documents; the gradient of a max-pool goes to the words where the filter peaked.

    Of the embeddings a step moves those alone that its batch touched. share: that of class 1 among all documents.
    """
    m, v, t, batch = {k: np.zeros_like(x) for k, x in p.items()}, {k: np.zeros_like(x) for k, x in p.items()}, 0, 16
    weight = np.where(label == 1, 0.5 / share, 0.5 / (1 - share))
    for _ in range(epochs):
        order = r.permutation(docs)
        for a in range(0, len(order), batch):
            grads = {k: np.zeros_like(x) for k, x in p.items() if k != "emb"}
            touched, moved = [], []
            for d in order[a : a + batch]:
                own = rows[first[d] : first[d + 1]]
                x, peaks = p["emb"][own].sum(axis=1), []
                pooled = p["bias"].copy()
                for i, w in enumerate(WIDTHS):
                    if len(own) >= w:
                        y = convolved(x, p, w)[: len(own) - w + 1]
                        at = y.argmax(axis=0)
                        pooled[i * FILTERS : (i + 1) * FILTERS] += y[at, np.arange(FILTERS)]
                        peaks.append((i, w, at))
                z = float(np.clip(np.maximum(pooled, 0) @ p["out"] + p["c"][0], -30, 30))
                g = (1 / (1 + np.exp(-z)) - label[d]) * weight[d] / batch
                grads["out"] += g * np.maximum(pooled, 0)
                grads["c"] += g
                gp = g * p["out"] * (pooled > 0)
                grads["bias"] += gp
                for i, w, at in peaks:
                    gf = gp[i * FILTERS : (i + 1) * FILTERS]
                    for j in range(w):
                        rows_j, block = own[at + j], slice(j * DIM, (j + 1) * DIM)
                        grads[f"conv{w}"][block] += x[at + j].T * gf
                        touched.append(rows_j.ravel())
                        moved.append(np.repeat((p[f"conv{w}"][block] * gf).T, rows_j.shape[1], axis=0))
            t += 1
            if touched:
                at, back = np.unique(np.concatenate(touched), return_inverse=True)
                d = np.zeros((len(at), DIM), np.float32)
                np.add.at(d, back, np.concatenate(moved))
                d[at == 0] = 0
                steps = [("emb", at, d)]
            else:
                steps = []
            for k, at, d in [*steps, *((k, slice(None), d) for k, d in grads.items())]:
                m[k][at] += 0.1 * (d - m[k][at])
                v[k][at] += 0.01 * (d * d - v[k][at])
                p[k][at] -= (0.01 * (m[k][at] / (1 - 0.9**t)) / (np.sqrt(v[k][at] / (1 - 0.99**t)) + 1e-6)).astype(np.float32)


def threshold(logit: np.ndarray, label: np.ndarray, weight: np.ndarray) -> float:
    """The cut with the least weight of errors, in the middle of its gap."""
    order = np.argsort(logit, kind="stable")
    z, y, w = logit[order].astype(float), label[order], weight[order]
    wrong = np.concatenate([[0], np.cumsum(w * y)]) + np.concatenate([np.cumsum((w * (1 - y))[::-1])[::-1], [0]])
    best = np.flatnonzero(wrong <= wrong.min() + 1e-9)
    k = best[len(best) // 2]
    return float((z[max(k - 1, 0)] + z[min(k, len(z) - 1)]) / 2)


def guessed(rows: np.ndarray, first: np.ndarray, spoken: np.ndarray) -> np.ndarray:
    """Number of the likeliest language of each document; one beyond the last for a document without known words."""
    total = np.zeros((len(first) - 1, spoken.shape[1]))
    full = np.flatnonzero(np.diff(first))
    if len(full):
        total[full] = np.add.reduceat(spoken[rows[:, 0]], first[:-1][full], axis=0)
    return np.where((total == 0).all(axis=1), spoken.shape[1], total.argmax(axis=1))


def packed(p: dict) -> np.ndarray:
    """The small parameters in rows of DIM."""
    flat = np.concatenate([p[k].ravel() for k in sorted(p) if k != "emb"])
    return np.pad(flat, (0, -len(flat) % DIM)).reshape(-1, DIM)


def advanced(p: dict, at: np.ndarray, step: np.ndarray) -> dict:
    """p after steps of the rows ``at``: those of the embeddings, then those of :func:`packed`."""
    size, out = 1 << BITS, {k: x.copy() for k, x in p.items()}
    out["emb"][at[at < size]] += step[at < size]
    flat = packed(p)
    flat[at[at >= size] - size] += step[at >= size]
    flat, begin = flat.ravel(), 0
    for k in sorted(p):
        if k != "emb":
            out[k] = flat[begin : begin + p[k].size].reshape(p[k].shape)
            begin += p[k].size
    return out


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", doc_id: str = "doc_id", text: str = "text", lang: str = "lang", seed: int = 5) -> dict:
    """Fit on all labelled documents, in parts of about PART; the driver holds the model and counts of its rows alone."""
    known = labels.where(F.col(label).isNotNull() & F.col(doc_id).isNotNull()).groupBy(F.col(doc_id).alias("doc_id")).agg(F.max(label).cast("long").alias("y"))
    count = {r["y"]: r["n"] for r in merged(docs.select(F.col(doc_id).alias("doc_id")), known, "doc_id").groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    n1, n0 = count.get(1, 0), count.get(0, 0)
    both, parts = min(n1, n0) > 0, max(1, -(-3 * (n1 + n0) // (4 * PART)))
    fold = lambda salt, n: F.pmod(F.xxhash64("doc_id", F.lit(salt)), F.lit(n))
    rows = merged(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.col(lang).alias("lang")), known, "doc_id")
    rows = rows.where("y IN (0, 1)").withColumn("part", fold("part", parts)).withColumn("apart", (fold("apart", 4) == 0) & F.lit(min(n1, n0) >= 12))
    rows = materialise(rows.repartition(parts, "part").sortWithinPartitions("part", "doc_id", "text", "lang"), "labelled")
    ctx = docs.sparkSession.sparkContext

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            words, first = features(part.column(0))
            langs = part.column(1).to_pylist()
            y, apart = part.column(2).to_numpy(), part.column(3).to_numpy(zero_copy_only=False)
            doc, names = np.repeat(np.arange(len(y)), np.diff(first)), np.array(langs, object)
            for name in sorted(set(langs), key=str):
                own = (names == name)[doc]
                at, seen, ones = tallies(words[own & ~apart[doc]], doc[own & ~apart[doc]], y)
                yield pa.RecordBatch.from_arrays([pa.array(at), pa.array([name] * len(at), pa.string()), pa.array(np.zeros_like(at)), pa.array(seen), pa.array(ones)], ["at", "lang", "words", "seen", "ones"])
                at, n = np.unique(words[own, 0], return_counts=True)
                none = pa.array(np.zeros_like(at))
                yield pa.RecordBatch.from_arrays([pa.array(at), pa.array([name] * len(at), pa.string()), pa.array(n), none, none], ["at", "lang", "words", "seen", "ones"])

    made = rows.select("text", "lang", "y", "apart").mapInArrow(counted, "at long, lang string, words long, seen long, ones long")
    # no more than 2 ** BITS rows of each language
    made = made.groupBy("at", "lang").agg(F.sum("words").alias("words"), F.sum("seen").alias("seen"), F.sum("ones").alias("ones")).toArrow()
    names = sorted(x for x in made.column("lang").unique().to_pylist() if x is not None)
    at, words, seen, ones = (made.column(c).to_numpy() for c in ("at", "words", "seen", "ones"))
    of = np.array([names.index(x) if x is not None else -1 for x in made.column("lang").to_pylist()], np.int64)
    spoken = tongues(at[of >= 0], of[of >= 0], words[of >= 0], len(names))
    each, back = np.unique(at, return_inverse=True)
    seen, ones = (np.bincount(back, weights=x, minlength=len(each)) for x in (seen, ones))
    sizes = {(r["apart"], r["y"]): r["n"] for r in rows.groupBy("apart", "y").agg(F.count(F.lit(1)).alias("n")).collect()}
    f1, f0 = sizes.get((False, 1), 0), sizes.get((False, 0), 0)
    held = seen > 0
    p = started(each[held], seen[held], ones[held], f1, f0, np.random.default_rng(seed))

    def stepped(turn: int, p: dict) -> dict:
        shipped = ctx.broadcast(p)  # 2 ** BITS rows: 8 MB

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for part in groups(batches, ["part"]):
                words, first = features(part.column("text").combine_chunks())
                y, n, before = part.column("y").to_numpy(), part.num_rows, shipped.value
                after = {k: x.copy() for k, x in before.items()}
                epochs = max(1, min(60, -(-600 * 16 // n)) // ROUNDS)
                fit_steps(after, words, first, y, np.arange(n), epochs, f1 / (f1 + f0), np.random.default_rng([seed, turn, part.column("part")[0].as_py()]))
                at = np.unique(words)
                at = at[(after["emb"][at] != before["emb"][at]).any(axis=1)]
                small = packed(after) - packed(before)
                step = np.concatenate([after["emb"][at] - before["emb"][at], small])
                # whole numbers, so that their sums are the same in any order
                step = np.rint(step.astype(float) * (1 << 24)).astype(np.int64) * n
                at = np.concatenate([at, (1 << BITS) + np.arange(len(small))])
                yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(np.full(len(at), n)), *(pa.array(np.ascontiguousarray(x)) for x in step.T)], ["at", "n", *columns])

        columns = [f"d{k}" for k in range(DIM)]
        steps = rows.where("NOT apart").select("part", "text", "y").mapInArrow(run, "at long, n long, " + ", ".join(f"{c} long" for c in columns))
        made = steps.groupBy("at").agg(F.sum("n").alias("n"), *[F.sum(c).alias(c) for c in columns]).toArrow()
        step = np.stack([made.column(c).to_numpy() for c in columns], 1) / made.column("n").to_numpy()[:, None] / (1 << 24)
        return advanced(p, made.column("at").to_numpy(), step.astype(np.float32))

    if both:
        for turn in range(ROUNDS):
            p = stepped(turn, p)
    shipped = ctx.broadcast((p, spoken))

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p, spoken = shipped.value
        for part in slices(batches, "text"):
            words, first = features(part.column(0))
            z = np.rint(np.clip(forward(words, first, p), -30, 30).astype(float) * FINE).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(guessed(words, first, spoken).astype(np.int64)), pa.array(z), part.column(1)], ["guess", "z", "y"])

    apart = rows.where("apart") if any(a for a, _ in sizes) else rows
    found = apart.select("text", "y").mapInArrow(judged, "guess long, z long, y long").groupBy("guess", "z", "y").agg(F.count(F.lit(1)).alias("n")).orderBy("guess", "z", "y").toArrow()
    guess, z, y, n = (found.column(c).to_numpy() for c in ("guess", "z", "y", "n"))  # 60 * FINE steps of each language and class at most
    cut = calibrated(z / FINE, y, n, guess, len(names)) if both and y.min() != y.max() else uncalibrated(both, n1 > 0, len(names))
    return {"p": p, "spoken": spoken, "cut": cut, "names": names}


def scores(docs: DataFrame, model: dict, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, score (0 to 1) and the language whose threshold was used (null: the common one), of every row."""
    shipped = docs.sparkSession.sparkContext.broadcast(model)  # 2 ** BITS rows: 8 MB, and 1 MB for each language

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shipped.value
        names = np.array([*model["names"], *[None] * (1 + (not model["names"]))], object)
        cut = model["cut"] if model["names"] else np.repeat(model["cut"], 2)
        for part in slices(batches, text, 2 << 20):
            rows, first = features(part.column(1))
            guess = guessed(rows, first, model["spoken"])
            z = np.clip(forward(rows, first, model["p"]) - cut[guess], -30, 30)
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(1 / (1 + np.exp(-z.astype(float)))), pa.array(names[guess], pa.string())], ["doc_id", "score", "threshold_lang"])

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias(text)).mapInArrow(run, "doc_id long, score double, threshold_lang string")
