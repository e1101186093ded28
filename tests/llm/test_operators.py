"""Operators against brute force on small tables with nulls, empty and long texts, ties and repeated rows."""

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from helixlake.llm import ann, bpe, langid, licenses, line_dedup, mixing, ngram_join, quality_cnn, rules, toxicity_cnn
from helixlake.llm.common import components

WORDS = [a + b for a in ("th", "er", "on", "qu", "st") for b in ("an", "is", "ou", "el", "ra", "em")]


def corpus():
    r = random.Random(4)
    texts = [None, "", " \n", "One two", "one TWO", "a b c d e"]
    for k in range(40):
        w = [r.choice(WORDS) for _ in range(r.choice((8, 30, 120)))]
        texts.append(" ".join(w))
        if k % 3 == 0:
            w[len(w) // 2] = "changed"
            texts.append(" ".join(w))
        if k % 5 == 0:
            texts.append(texts[-1])
    texts += ["long " * 30_000, "Shared line of some length here.\nown text\nShared line of some length hexe.", "Shared line of some length here.\n\nmore"]
    return texts


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(k, t, ("en", "fr")[k % 2], None if k % 9 == 0 else f"s{k % 4}", len(t or "")) for k, t in enumerate(corpus())]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    return df.withColumn("size", F.lit("clash")).withColumn("label", F.lit("clash")).withColumn("print", F.lit(1)).repartition(3)


@pytest.fixture(scope="module")
def empty(docs):
    return docs.where("doc_id < 0")


def test_ngram_join(spark, docs, empty):
    def shingles(t):
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())

    sets = [shingles(t) for t in corpus()]
    label = list(range(len(sets)))
    for _ in sets:
        for i, a in enumerate(sets):
            for j, b in enumerate(sets):
                if a and 100 * len(a & b) >= 80 * len(a | b):
                    label[i] = label[j] = min(label[i], label[j])
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in ngram_join.classes(docs).collect()}
    assert got == {k: (len(s), label[k]) for k, s in enumerate(sets)}
    assert ngram_join.classes(empty).count() == 0
    lone = ngram_join.classes(docs.withColumn("doc_id", F.lit(None).cast("long"))).select("component_id").distinct().collect()
    assert [r[0] for r in lone] == [None]


def test_rtree_finds_what_all_pairs_find():
    r = np.random.default_rng(2)
    sets = [np.unique(r.integers(0, 1 << 62, 300).astype(np.uint64)) for _ in range(60)]
    for s in list(sets):
        t = s.copy()
        t[r.integers(0, 300, 12)] = r.integers(0, 1 << 62, 12).astype(np.uint64)
        sets.append(np.unique(t))
    tree = ngram_join.RTree(ngram_join.points_of([ngram_join.packed_point(ngram_join.mix(s)) for s in sets]), np.array([len(s) for s in sets]))
    met = {tuple(sorted((int(i), int(j)))) for a, b in tree.pairs() for i, j in zip(a, b, strict=True)}
    want = {(i, j) for i in range(len(sets)) for j in range(i + 1, len(sets)) if ngram_join.similar(sets[i], sets[j])}
    assert want <= met and len(want) == 60


def test_edit_distance():
    def plain(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            row, last = [i], row
            for j, y in enumerate(b, 1):
                row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
        return row[-1]

    r = random.Random(1)
    for _ in range(3000):
        a = "".join(r.choice("abé") for _ in range(r.randrange(9)))
        b = list(a)
        for _ in range(r.randrange(4)):
            k = r.randrange(len(b) + 1)
            b[k : k + r.randrange(2)] = r.choice(["", "a", "é"])
        assert line_dedup.within(a, "".join(b)) == (plain(a, "".join(b)) <= 2)


def test_line_dedup(docs, empty):
    kept, texts = {}, corpus()
    lines = [(k, i, x) for k, t in enumerate(texts) if t is not None for i, x in enumerate(t.split("\n"))]
    for k, i, x in lines:
        if len(x) < 20 or not any(len(y) >= 20 and line_dedup.within(*sorted((x, y), key=len)) for a, b, y in lines if (a, b) < (k, i)):
            kept.setdefault(k, []).append(x)
    got = {r["doc_id"]: r["text"] for r in line_dedup.dedup(docs).collect()}
    assert got == {k: None if t is None else "\n".join(kept.get(k, [])) for k, t in enumerate(texts)}
    out = line_dedup.dedup(docs)
    assert out.columns == docs.columns and line_dedup.dedup(empty).count() == 0


def test_bpe(docs, empty):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    t = Tokenizer.from_file(path)
    odd = ["ΑΣ ΣΑΣ. İstanbul \x1c x\x85y a\xa0b ١٢٣ ẞ", "<|endoftext|> a<|startoftext|>b <|x|>", "it's WE'VE, ok...  ,. 3.14"]
    rows = docs.sparkSession.createDataFrame(list(enumerate([*corpus(), *odd])), "doc_id long, text string")
    texts = dict(enumerate([*corpus(), *odd]))
    for r in bpe.encode_digests(rows, path).collect():
        e = t.encode(texts[r["doc_id"]] or "", add_special_tokens=False)
        decoded = t.decode(e.ids, skip_special_tokens=False)
        assert (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) == (len(e.ids), *(hashlib.sha256(x.encode()).hexdigest() for x in (" ".join(map(str, e.ids)), decoded)))
    assert bpe.encode(empty, path).count() == 0


def test_mixing(docs, empty):
    rows = mixing.mix(docs).collect()
    assert len(rows) == docs.count()
    for s in {r["source"] for r in rows}:
        own = [r for r in rows if r["source"] == s]
        taken = sum(r["copies"] * r["size"] for r in own)
        assert abs(taken - own[0]["target"]) <= 2 * max([r["size"] for r in own], default=0)
        assert all(0 <= r["copies"] <= 3 for r in own)
        assert own[0]["target"] <= 3 * own[0]["source_size"] + 1e-6
    assert sum({r["source"]: r["target"] for r in rows}.values()) == pytest.approx(sum(r["size"] for r in rows))
    again = {(r["doc_id"], r["copies"]) for r in mixing.mix(docs.repartition(7)).collect()}
    assert again == {(r["doc_id"], r["copies"]) for r in rows}
    assert mixing.mixed(docs).count() == sum(r["copies"] for r in rows)
    assert mixing.mix(empty).count() == 0


def test_nearest(spark):
    r = np.random.default_rng(0)
    x = r.normal(size=(300, 16))
    x[100:140] = x[100]
    rows = [(k, [float(v) for v in row]) for k, row in enumerate(x)] + [(900, None), (901, [0.0] * 16), (902, [float("nan")] * 16), (903, [None] * 16)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got: dict = {}
    for row in ann.search(df, F.col("vec_id") % 50 == 0).collect():
        got.setdefault(row["query_id"], {})[row["rank"]] = (row["vec_id"], row["score"])
    assert sorted(got) == list(range(0, 300, 50))
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    hits = 0
    for q, found in got.items():
        score = unit @ unit[q]
        score[q] = -2
        want = sorted(range(300), key=lambda k: (-round(score[k], 12), k))[:5]
        hits += len(set(want) & {v for v, _ in found.values()})
    assert hits >= 0.9 * 5 * len(got)
    assert [got[100][k][0] for k in range(1, 6)] == [101, 102, 103, 104, 105]
    assert ann.search(df.where("vec_id > 899"), F.col("vec_id") % 50 == 0).count() == 0


def test_language(docs, empty, spark):
    rows = [(k, t, "ab" if k % 2 else "cd") for k, t in enumerate(["abba baab abab " * 9, "cddc ccdd dcdc " * 9] * 10)]
    rows = [(k, t, "cd" if "c" in t else "ab") for k, t, _ in rows]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    p = langid.fit(df)
    test = spark.createDataFrame([(1, "baba ab"), (2, "DCDC"), (3, "12 !"), (4, None), (5, "")], "doc_id long, text string")
    assert [(r["doc_id"], r["lang_pred"]) for r in langid.predict(test, p).orderBy("doc_id").collect()] == [(1, "ab"), (2, "cd"), (3, "und"), (4, "und"), (5, "und")]
    assert langid.predict(empty, langid.fit(empty)).count() == 0


def test_rules_and_licenses(docs, empty):
    found = {r["doc_id"]: r for r in rules.verdicts(docs).collect()}
    for k, t in enumerate(corpus()):
        w = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        lines = [x for x in (t or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        three = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
        count = {x: 0 for x in three}
        for x in three:
            count[x] += 1
        rep = len({i + j for i, x in enumerate(three) if count[x] > 1 for j in range(3)})
        assert (found[k]["n_words"], found[k]["word_chars"], found[k]["n_dup_lines"], found[k]["n_repeat_words"]) == (len(w), sum(map(len, w)), len(lines) - len(set(lines)), rep)
        assert found[k]["base_failed"] == (len(w) < 50 or 100 * rep > 50 * len(w))
    assert rules.verdicts(empty).count() == 0
    own = docs.limit(1).select(F.explode(F.array(*[F.lit("Before it. " + t + " And after.") for t in licenses.TEMPLATES.values()])).alias("text"), F.lit(1).alias("doc_id"))
    names = {r["license"] for r in licenses.scan(own).collect()}
    assert names == set(licenses.TEMPLATES)
    assert licenses.scan(docs).count() == 0 and licenses.scan(empty).count() == 0


def test_classifiers_learn(spark, docs, empty):
    r = random.Random(3)
    texts = [" ".join(r.choice(WORDS) for _ in range(60)) for _ in range(160)]
    bad = np.array([k % 3 == 0 for k in range(160)])
    junk = [" ".join(w + "###" for w in t.split()) if b else t for t, b in zip(texts, bad, strict=True)]
    model = quality_cnn.train(junk, (~bad).astype(int))
    df = spark.createDataFrame([*enumerate(junk), (998, ""), (999, None)], "doc_id long, text string")
    score = {x["doc_id"]: x["score"] for x in quality_cnn.scores(df, model).collect()}
    assert np.mean([(score[k] >= 0.3) != b for k, b in enumerate(bad)]) > 0.97 and score[998] == score[999]
    rude = [t.replace(t.split()[5], "scoundrel") if b else t for t, b in zip(texts, bad, strict=True)]
    model = toxicity_cnn.train(rude, bad.astype(int), ["en", "fr"] * 80)
    df = spark.createDataFrame([*enumerate(rude), (998, ""), (999, None)], "doc_id long, text string")
    score = {x["doc_id"]: x["score"] for x in toxicity_cnn.scores(df, model).collect()}
    assert np.mean([(score[k] >= 0.5) == b for k, b in enumerate(bad)]) > 0.95 and 0 <= score[999] <= 1


def test_components(spark):
    df = spark.createDataFrame([(k, k + 1) for k in range(1, 20)] + [(40, 30), (30, 35)], "a long, b long")
    got = {r["node"]: r["label"] for r in components(df).collect()}
    assert got == {**{k: 1 for k in range(1, 21)}, 30: 30, 35: 30, 40: 30}
