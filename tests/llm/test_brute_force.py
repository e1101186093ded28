"""Classifiers, language profiles, targets and the index against plain loops, and special rows of each."""

import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from helixlake.llm import ann, langid, licenses, mixing, quality_cnn, toxicity_cnn

LONG = "a long text that goes on and on. " * 3000


@pytest.fixture(scope="module")
def odd(spark):
    """Null, empty and very long texts, repeated rows, and columns whose names operators use themselves."""
    rows = [(1, "Plain words of a text."), (2, None), (3, ""), (4, LONG), (5, "Plain words of a text."), (1, "Plain words of a text."), (None, "no id here")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("lang", F.lit("en")).withColumn("source", F.lit("s"))
    for name in ("gone", "__id", "__n", "__own", "__copy", "score", "size", "label", "id", "doc", "print", "copies", "line", "nth", "y"):
        df = df.withColumn(name, F.lit(7))
    return df.repartition(2)


def test_quality_against_loops():
    r = random.Random(1)
    texts = ["", None, "short", "x" * 300, "".join(chr(r.randrange(32, 400)) for _ in range(900))]
    model = quality_cnn.train([*texts, "good " * 80] * 3, np.array([0, 0, 1, 0, 0, 1] * 3), epochs=1)
    net, w = quality_cnn.loaded(model)
    found = quality_cnn.probabilities(pa.array(texts), net, w)
    for text, got in zip(texts, found, strict=True):
        data = (text or "").encode()
        logits, at = [], 0
        while True:
            part = data[at : at + 256].ljust(256, b"\0")
            blocks = [np.concatenate([net.p["emb"][b] for b in part[4 * k : 4 * k + 4]]) for k in range(64)]
            pooled = [max(float(blocks[k] @ net.p["conv"][:, f] + blocks[k + 1] @ net.p["conv"][:, 24 + f]) for k in range(63)) for f in range(24)]
            pooled = [max(p + float(b), 0) for p, b in zip(pooled, net.p["bias"], strict=True)]
            logits.append(min(12, max(-12, sum(p * float(o) for p, o in zip(pooled, net.p["out"], strict=True)) + float(net.p["c"][0]))))
            at += 240
            if at + 16 >= len(data):
                break
        mean = sum(logits) / len(logits)
        spread = max(0, sum(z * z for z in logits) / len(logits) - mean * mean) ** 0.5
        z = w[0] * mean + w[1] * max(logits) + w[2] * min(logits) + w[3] * spread + w[4]
        assert got == pytest.approx(1 / (1 + np.exp(-z)), abs=1e-3)


def test_quality_learns_from_every_chunk(monkeypatch):
    seen, whole = [], quality_cnn.chunk_matrix
    monkeypatch.setattr(quality_cnn, "chunk_matrix", lambda data, starts, ends: seen.append((len(starts), int(starts[-1]))) or whole(data, starts, ends))
    quality_cnn.train(["ab " * 4000, "#% " * 20], np.array([1, 0]), epochs=1)
    assert seen[0] == (50 + 1, 12_000)  # the last chunk of the long text and the one of the short one


def test_quality_rows(spark, odd):
    labels = spark.createDataFrame([(k, k % 2) for k in range(1, 6)], "doc_id long, quality int")
    model = quality_cnn.fit(odd, labels)
    rows = quality_cnn.scores(odd, model).collect()
    assert len(rows) == 7 and all(0 <= x["score"] <= 1 for x in rows)
    score = {x["doc_id"]: x["score"] for x in rows}
    assert score[1] == score[5] and score[2] == score[3]
    kept = quality_cnn.keep_good(odd, model, threshold=score[1])
    assert kept.columns == odd.columns and kept.count() == sum(x["score"] >= score[1] for x in rows) >= 3
    none = odd.where("doc_id < 0")
    empty = quality_cnn.fit(none, labels)
    assert quality_cnn.scores(none, empty).count() == 0 and quality_cnn.keep_good(none, empty).count() == 0


def test_quality_scores_do_not_depend_on_their_neighbours(spark):
    r = random.Random(2)
    texts = ["".join(chr(r.randrange(32, 400)) for _ in range(r.randrange(0, 2500))) for _ in range(300)]
    model = quality_cnn.train(texts, np.array([k % 2 for k in range(300)]), epochs=1)
    net, w = quality_cnn.loaded(model)
    whole = quality_cnn.probabilities(pa.array(texts), net, w).tolist()
    for n in (1, 7, 64):
        assert [p for a in range(0, 300, n) for p in quality_cnn.probabilities(pa.array(texts[a : a + n]), net, w)] == whole
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for n in (1, 7, 50):
        assert [x["score"] for x in quality_cnn.scores(df.repartition(n), model).orderBy("doc_id").collect()] == whole


def test_toxicity_against_loops():
    r = random.Random(3)
    words = ["alpha", "beta", "gamma", "delta", "nasty", "ok", "élan"]
    texts = [" ".join(r.choice(words) for _ in range(r.randrange(0, 9))) for _ in range(60)] + [""]
    label = np.array([int("nasty" in t) for t in texts])
    model = toxicity_cnn.train(texts, label, ["en"] * len(texts), epochs=1)
    rows, first = toxicity_cnn.features(pa.array(texts, pa.large_string()))
    got, p = toxicity_cnn.forward(rows, first, model["p"]), model["p"]
    for d in range(len(texts)):
        x = [p["emb"][row].sum(axis=0) for row in rows[first[d] : first[d + 1]]]
        out = []
        for w in (1, 2, 3):
            places = range(len(x) - w + 1)
            out += [max((sum(float(x[i + j] @ p[f"conv{w}"][8 * j : 8 * j + 8, f]) for j in range(w)) for i in places), default=0.0) for f in range(6)]
        want = sum(max(v + float(b), 0) * float(o) for v, b, o in zip(out, p["bias"], p["out"], strict=True)) + float(p["c"][0])
        assert got[d] == pytest.approx(want, abs=1e-4)


def test_a_language_with_few_documents_takes_the_common_threshold():
    logit, label = np.array([-3.0, -2, -1, 1, 2, 3]), np.array([0, 0, 0, 1, 1, 1])
    assert toxicity_cnn.threshold(logit, label, np.ones(6)) == 0
    few = toxicity_cnn.threshold(np.append(logit, 0.9), np.append(label, 0), np.append(np.full(6, 10.0), 1.0))
    assert 0.9 <= few <= 1
    far = toxicity_cnn.threshold(np.append(logit, [2.5] * 40), np.append(label, [0] * 40), np.append(np.full(6, 1.0), np.ones(40)))
    assert far > 2.5


def test_toxicity_rows(spark, odd):
    labels = spark.createDataFrame([(k, k % 2) for k in range(1, 6)], "doc_id long, toxic int")
    model = toxicity_cnn.fit(odd, labels)
    rows = toxicity_cnn.scores(odd, model).collect()
    assert len(rows) == 7 and all(0 <= x["score"] <= 1 for x in rows)
    by = {x["doc_id"]: x for x in rows}
    assert by[1]["score"] == by[5]["score"] and by[2]["score"] == by[3]["score"] and by[2]["threshold_lang"] is None
    none = odd.where("doc_id < 0")
    assert toxicity_cnn.scores(none, toxicity_cnn.fit(none, labels)).count() == 0


def test_toxicity_learns_from_every_labelled_document(spark, monkeypatch):
    monkeypatch.setattr(toxicity_cnn, "PART", 300)
    r = random.Random(12)
    texts = [" ".join(r.choice(["alpha", "beta", "gamma", "delta"]) for _ in range(20)) for _ in range(4800)]
    label = [k % 2 for k in range(4800)]
    # every toxic document has one of 300 words, each in eight documents: a sample would leave some unknown
    rude = [t + f" {'vxqzjk'[k // 2 % 6]}{k // 2 % 300}wfb" if y else t for k, (t, y) in enumerate(zip(texts, label, strict=True))]
    docs = spark.createDataFrame([(k, t, "en") for k, t in enumerate(rude)], "doc_id long, text string, lang string").repartition(3)
    labels = spark.createDataFrame(list(enumerate(label)), "doc_id long, toxic int")
    model = toxicity_cnn.fit(docs, labels)
    rows, _ = toxicity_cnn.features(pa.array(rude))
    assert (model["spoken"][rows[:, 0]] != 0).all()
    whole = toxicity_cnn.features(pa.array(rude))[0]
    at, n = np.unique(whole[:, 0], return_counts=True)
    want = np.log((n + 0.5) / (len(whole) + 0.5 * (1 << toxicity_cnn.BITS)))
    assert np.allclose(model["spoken"][at, 0], want, atol=1e-5)
    score = {x["doc_id"]: x["score"] for x in toxicity_cnn.scores(docs, model).collect()}
    assert np.mean([(score[k] >= 0.5) == y for k, y in enumerate(label)]) > 0.98
    again = toxicity_cnn.fit(docs.repartition(5), labels)
    assert all((model["p"][k] == again["p"][k]).all() for k in model["p"]) and (model["cut"] == again["cut"]).all()


def plain_profile(text):
    count = Counter()
    low = (text or "").lower()
    marked = "".join(c if c.isalpha() else "\0" for c in low)
    padded = "\0" + marked + "\0"
    for i, c in enumerate(padded):
        if c != "\0":
            count[c] += 1
        two, three = padded[i : i + 2], padded[i : i + 3]
        if len(two) == 2 and two != "\0\0":
            count[two] += 1
        if len(three) == 3 and three[1] != "\0":
            count[three] += 1
    return count


def test_language_against_loops(spark, odd):
    r = random.Random(5)
    make = lambda a: " ".join("".join(r.choice(a) for _ in range(r.randrange(1, 7))) for _ in range(60))
    train = [(k, make(a), name) for k, (name, a) in enumerate([("aa", "abcde"), ("bb", "cdefg"), ("cc", "éfghà")] * 6)]
    profiles = langid.fit(spark.createDataFrame(train, "doc_id long, text string, lang string"))
    names = dict(profiles)
    packed = lambda g: langid.ranked(next(langid.grams([g])).copy())
    assert set(names) == {"aa", "bb", "cc"} and len(packed("ab")) > 3
    texts = [make(a) for a in ("abcde", "cdefg", "éfghà", "abcdefg")] + ["a", "", None, "12 3!", LONG]
    got = {x["doc_id"]: x for x in langid.predict(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), profiles).collect()}
    for k, text in enumerate(texts):
        count = plain_profile(text)
        if not count:
            assert (got[k]["lang_pred"], got[k]["score"]) == ("und", 0.0)
            continue
        values = next(langid.grams([text]))
        assert len(values) == sum(count.values())
        mine = [v for v, _ in sorted(Counter(values.tolist()).items(), key=lambda x: (-x[1], x[0]))[:300]]
        far = {}
        for name, profile in profiles:
            at = {g: i for i, g in enumerate(profile)}
            far[name] = sum(abs(i - at[g]) if g in at else 300 for i, g in enumerate(mine))
        best = min(sorted(far), key=lambda n: far[n])
        assert (got[k]["lang_pred"], round(got[k]["score"], 9)) == (best, round(1 - far[best] / (300 * len(mine)), 9))
    assert langid.predict(odd, profiles).count() == 7


def test_targets_against_filling_by_bisection(spark):
    r = random.Random(6)
    for n in (1, 2, 5, 9):
        size = {f"s{k}": r.choice([1, 10, 1000, 30]) for k in range(n)} | {None: 5}
        order = [*sorted(k for k in size if k), None]
        weight = {k: (5, 2, 1)[i % 3] for i, k in enumerate(order)}
        low, high, total = 0.0, 1e9, sum(size.values())
        for _ in range(200):
            level = (low + high) / 2
            low, high = (level, high) if sum(min(weight[k] * level, 3 * size[k]) for k in size) < total else (low, level)
        want = {k: min(weight[k] * high, 3 * size[k]) for k in size}
        rows = [(k, 1) for k, v in size.items() for _ in range(v)]
        got = {x["source"]: x["target"] for x in mixing.targets(spark.createDataFrame(rows, "source string, size long")).collect()}
        assert got == pytest.approx(want, rel=1e-6)


def test_landing_takes_the_best_of_all_choices():
    r = np.random.default_rng(4)
    for _ in range(40):
        n = int(r.integers(0, 9))
        p, size = r.choice([0.0, 1.0, 0.3, 0.62], n), r.integers(1, 50, n).astype(float)
        got, open_ = mixing.landing(p, size), (p > 0) & (p < 1)
        assert set(got.tolist()) <= {0.0, 1.0} and (got[~open_] == p[~open_]).all()
        every = [sum(size[open_][k] for k in range(open_.sum()) if m >> k & 1) for m in range(1 << open_.sum())]
        want = (p[open_] * size[open_]).sum()
        assert abs((got[open_] * size[open_]).sum() - want) == pytest.approx(min(abs(x - want) for x in every))


def test_words_come_near_their_target_beside_a_huge_document():
    r = np.random.default_rng(5)
    for n in (40, 200):
        size = np.concatenate([r.integers(20, 900, n), [6000]]).astype(float)
        p = mixing.settled(np.full(n + 1, 0.37), size, r.random(n + 1))
        assert set(p.tolist()) <= {0.0, 1.0} and (p * size).sum() == pytest.approx(0.37 * size.sum(), rel=0.01)


def test_mix_rows(odd):
    out = mixing.mixed(odd)
    assert out.columns == odd.columns
    rows = mixing.mix(odd).collect()
    assert len(rows) == 7 and out.count() == sum(x["copies"] for x in rows)
    assert {tuple(x) for x in out.distinct().collect()} <= {tuple(x) for x in odd.collect()}
    assert mixing.mixed(odd.where("doc_id < 0")).count() == 0


def test_codes_alone_find_neighbours():
    r = np.random.default_rng(7)
    x = ann.unit(r.normal(size=(6000, 32)))
    books = ann.learn(x[:4000])
    codes = ann.encoded(x, books)
    norms = np.linalg.norm(sum(books[m][codes[:, m]] for m in range(len(books))), axis=1).astype(np.float32)
    near = ann.Nearest(books, 32)
    near.start((0, 0))
    near.ask(np.arange(0, 6000, 200), x[::200])
    for a in range(0, 6000, 512):
        near.meet(np.arange(a, min(a + 512, 6000)), codes[a : a + 512].ravel(), norms[a : a + 512])
    hits = 0
    for q, row in zip(range(0, 6000, 200), near.node, strict=True):
        want = np.argsort(-(x @ x[q]), kind="stable")[1:6]
        hits += len(set(want.tolist()) & set(row.tolist()))
    assert near.node.shape[1] == 32 and hits >= 0.9 * 5 * 30


def test_search_of_thousands(spark):
    r = np.random.default_rng(8)
    x = r.normal(size=(5200, 12))
    rows = [(k, v.tolist(), 1.0) for k, v in enumerate(x)] + [(100, x[7].tolist(), 1.0), (9000, [1.0, 2.0], 1.0), (9001, [2.0, 4.1], 1.0), (None, x[3].tolist(), 1.0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, score double").withColumn("node", F.lit(1)).withColumn("rank", F.lit(2)).withColumn("query_id", F.lit(3)).repartition(3)
    got: dict = {}
    for row in ann.search(df, F.col("vec_id") % 500 == 0).collect():
        got.setdefault(row["query_id"], {}).setdefault(row["rank"], (row["vec_id"], row["score"]))
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    for q in range(500, 5001, 500):
        score = unit @ unit[q]
        score[q] = -2
        want = np.lexsort((np.arange(len(x)), -np.round(score, 12)))[:5]
        assert [score[got[q][k][0]] for k in range(1, 6)] == pytest.approx([score[w] for w in want], abs=1e-9)
    assert [v for v, _ in got[9000].values()] == [9001]  # vectors of one length meet


def test_notices_split_repeated_and_at_the_threshold(spark):
    words = licenses.words_of(licenses.TEMPLATES["MIT"])
    n = len(licenses.shingles_of(licenses.TEMPLATES["MIT"]))
    whole = " ".join(words)
    need = -(-80 * n // 100)
    at, below = " ".join(words[: need + 4]), " ".join(words[: need + 3])
    cut = len(words) // 2
    split = " ".join(words[:cut]) + " some other words of the author " + " ".join(words[cut:])
    texts = [whole, whole + " x " + whole, at, below, split, LONG + whole]
    df = spark.createDataFrame([*enumerate(texts), (0, whole)], "doc_id long, text string").withColumn("license", F.lit(1)).withColumn("words", F.lit(2))
    got = sorted((x["doc_id"], x["n_found"]) for x in licenses.scan(df, templates={"MIT": licenses.TEMPLATES["MIT"]}).collect())
    assert got == [(0, n), (0, n), (1, n), (2, need), (4, n - 4), (5, n)]
