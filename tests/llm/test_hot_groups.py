"""Hot keys, cells and lines: small bounds take the ways of large tables; columns of any name; the rule by spots."""

import random
import re

import pytest
from pyspark.sql import functions as F

from helixlake.llm import common, line_dedup, ngram_join

from .test_whole_lines import edited, plain


def kept_lines(texts, linked):
    """Brute force: the text of each document once later members of every class of lines are gone."""
    lines = [(k, i, x) for k, t in enumerate(texts) if t is not None for i, x in enumerate(t.split("\n"))]
    label = list(range(len(lines)))
    for i, (_, _, a) in enumerate(lines):
        for j, (_, _, b) in enumerate(lines[:i]):
            if label[i] != label[j] and a.strip(" \t\r\x0b\x0c") and b.strip(" \t\r\x0b\x0c") and (a == b or linked(a, b)):
                label = [label[j] if x == label[i] else x for x in label]
    first, out = {}, {}
    for (k, i, x), own in zip(lines, label, strict=True):
        first.setdefault(own, (k, i))
    for (k, i, x), own in zip(lines, label, strict=True):
        if first[own] == (k, i):
            out.setdefault(k, []).append(x)
    return {k: None if t is None else "\n".join(out.get(k, [])) for k, t in enumerate(texts)}


def two(a, b):
    return min(len(a), len(b)) >= 20 and abs(len(a) - len(b)) <= 2 and plain(a, b) <= 2


@pytest.fixture(scope="module")
def crowd():
    r = random.Random(9)
    base = "the quick brown fox jumps over the lazy dog"
    near = [edited(r, base, r.randrange(1, 3)) for _ in range(60)]
    texts = ["\n".join([r.choice(near), r.choice(["Yes.", "No.", ""]), f"line {k} stands here on its own, number {k * k}"]) for k in range(80)]
    return [*texts, None, "", "Yes.\nYes.\n \n \nNo.", base]


@pytest.mark.parametrize("bucket", [5, 1500])
def test_copies_and_near_copies_of_crowds(spark, crowd, monkeypatch, bucket):
    monkeypatch.setattr(line_dedup, "BUCKET", bucket)
    monkeypatch.setattr(common, "SAMPLE", 1 if bucket == 5 else 64)
    df = spark.createDataFrame(list(enumerate(crowd)), "doc_id long, text string")
    for name in ("gone", "__id", "line", "h1", "doc", "label", "first"):
        df = df.withColumn(name, F.lit(name))
    out = line_dedup.dedup(df.repartition(3))
    assert out.columns == df.columns
    assert {x["doc_id"]: x["text"] for x in out.collect()} == kept_lines(crowd, two)


def test_by_spots(spark):
    r = random.Random(10)
    word = lambda: "".join(r.choice("abcdefghijklmnop") for _ in range(r.randrange(2, 8)))
    lines, pairs = [], 0
    for size in (9, 12, 14, 18, 30, 45, 80, 150):
        for _ in range(4):
            own = [word() for _ in range(size)]
            near = list(own)
            near[r.randrange(size)] = word()[:3]
            if size > 40:
                near[r.randrange(size)] = word()[:3]
            a, b = " ".join(own), " ".join(near)
            lines += [a, b]
            pairs += plain(a, b) <= max(2, min(len(a), len(b)) // 20) if min(len(a), len(b)) >= 20 else 0
    df = spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string").repartition(3)
    got = {x["doc_id"]: x["text"] for x in line_dedup.dedup(df, allowed=line_dedup.by_spots).collect()}
    gone = sum(got[k] == "" for k in range(1, len(lines), 2))
    assert gone == pairs >= 16 and all(got[k] for k in range(0, len(lines), 2))
    assert gone <= sum(x["text"] == "" for x in line_dedup.dedup(df, allowed=line_dedup.by_length).collect())


def test_chosen_grams_are_those_of_a_plain_walk():
    import numpy as np

    r = np.random.default_rng(3)
    for n, w in ((40, 7), (200, 33), (9, 9), (50, 1)):
        v = r.integers(1, 30, n).astype(np.uint64)
        inside = r.random(n - w + 1) < 0.7
        want = sorted({p for i in range(n - w + 1) if inside[i] for p in range(i, i + w) if v[p] == v[i : i + w].min()})
        assert line_dedup.chosen(v, inside, w).tolist() == want


def shingles(t):
    w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").lower())
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


@pytest.mark.parametrize("cell", [4, 1500])
def test_large_cells(spark, monkeypatch, cell):
    monkeypatch.setattr(ngram_join, "CELL", cell)
    monkeypatch.setattr(common, "SAMPLE", 1 if cell == 4 else 64)
    r = random.Random(11)
    vocabulary = [a + b + c for a in "bdfgk" for b in "aeio" for c in "lmnr"]
    base = [r.choice(vocabulary) for _ in range(60)]
    rows = []
    for k in range(70):
        w = list(base)
        if k % 7 == 6:  # shares half of its words with the crowd
            w[20:] = [r.choice(vocabulary) for _ in range(40)]
        for _ in range(r.randrange(3)):
            w[r.randrange(60)] = r.choice(vocabulary)
        rows.append((k, " ".join(w)))
    rows += [(5, "another text under an id that was there before"), (71, "another text under an id that was there before"), (None, rows[0][1]), (72, None)]
    got = {}
    for x in ngram_join.classes(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect():
        got.setdefault(x["doc_id"], set()).add(x["component_id"])
    ids = [k for k, _ in rows]
    sets = [shingles(t) for _, t in rows]
    label = dict(zip(ids, ids, strict=True))
    for _ in range(6):
        for i, a in enumerate(sets):
            for j, b in enumerate(sets):
                if None not in (ids[i], ids[j]) and a and b and 100 * len(a & b) >= 80 * len(a | b):
                    label[ids[i]] = label[ids[j]] = min(label[ids[i]], label[ids[j]])
    assert got == {k: {v} for k, v in label.items()}


def test_counts_of_hot_keys(spark, monkeypatch):
    monkeypatch.setattr(common, "SAMPLE", 1)
    rows = spark.createDataFrame([(1, k) for k in range(50)] + [(2, 1), (2, 2), (3, 9)], "key long, owner long")
    got = {(x["key"], x["n"], x["low"] is None) for x in common.counted(rows, rows, "key", "owner", {"low": F.min("owner")}).collect()}
    assert got == {(1, 50, True), (2, 2, False), (3, 1, False)}


@pytest.mark.parametrize("most", [2, 3, 100])
def test_rows_of_different_labels_meet_once_or_more(spark, most):
    r = random.Random(12)
    rows = [(key, o, label) for key in range(6) for o in range(key * 3) for label in [r.choice([0, 0, 0, 1, 2]) if key % 2 else 0]]
    df = spark.createDataFrame(rows, "key long, owner long, label long")
    groups: dict = {}
    for x in common.across(df, "key", "owner", most).collect():
        groups.setdefault((x["key"], x["p"], x["q"]), []).append(x)
    met = {(k, *sorted((a["owner"], b["owner"]))) for (k, _, _), g in groups.items() for a in g for b in g if a["label"] != b["label"] and (a["asks"] or b["asks"])}
    assert met == {(k, *sorted((a, b))) for k, a, x in rows for l, b, y in rows if k == l and x != y}
    assert all(len({x["owner"] for x in g}) == len(g) for g in groups.values())
