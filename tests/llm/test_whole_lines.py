"""Line dedup with thresholds that follow the length, against brute force."""

import random
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from helixlake.llm import common, line_dedup


def plain(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, last = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
    return row[-1]


def edited(r, text, edits):
    out = list(text)
    for _ in range(edits):
        k = r.randrange(len(out) + 1)
        out[k : k + r.randrange(2)] = r.choice(["", "x", "é"])
    return "".join(out)


def test_distance_with_many_edits():
    r = random.Random(5)
    for _ in range(400):
        a = "".join(r.choice("abé") for _ in range(r.randrange(1, 40)))
        b = edited(r, a, r.randrange(9))
        for edits in (0, 3, 6):
            assert line_dedup.near(a, b, edits) == (plain(a, b) <= edits)


def test_pairs_verified_together():
    r = random.Random(6)
    texts, edits = [], []
    for _ in range(700):
        most = r.choice([0, 1, 2, 5, 12, 31, 40])
        a = "".join(r.choice("abé\U0001f600") for _ in range(r.randrange(0, 160)))
        texts += [a, edited(r, a, r.randrange(2 * most + 2))]
        edits.append(most)
    i = np.arange(0, len(texts), 2)
    got = line_dedup.Lines(texts).near(i, i + 1, np.array(edits))
    want = [plain(texts[k], texts[k + 1]) <= e for k, e in zip(i, edits, strict=True)]
    assert got.tolist() == want and 100 < sum(want) < 600
    assert line_dedup.Lines([]).near(i[:0], i[:0], i[:0]).tolist() == []


@pytest.fixture(scope="module")
def lines():
    r = random.Random(8)
    out = []
    for size in (21, 39, 58, 59, 60, 61, 62, 79, 80, 95, 120, 199, 201, 202, 203, 220, 260, 400, 450):
        for _ in range(2):
            text = "".join(r.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(size))
            most = max(2, size // 20)
            out += [text, edited(r, text, most), edited(r, text, most + 1), edited(r, text, 2 * most)]
            # edits at even distances leave only the shortest shared runs
            step = size // (most + 1)
            out.append("".join("#" if k % step == step - 1 and k // step < most else x for k, x in enumerate(text)))
    out.append("long " * 5000)
    r.shuffle(out)
    return out


def test_by_length(spark, lines):
    allowed = lambda a, b: max(2, min(len(a), len(b)) // 20)
    label = list(range(len(lines)))
    for i, a in enumerate(lines):
        for j, b in enumerate(lines[:i]):
            if min(len(a), len(b)) >= 20 and abs(len(a) - len(b)) <= allowed(a, b) and plain(a, b) <= allowed(a, b):
                label = [label[j] if x == label[i] else x for x in label]
    first = {}
    for k, x in enumerate(label):
        first.setdefault(x, k)
    want = {k: x if first[label[k]] == k else "" for k, x in enumerate(lines)}
    df = spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string").repartition(3)
    got = {x["doc_id"]: x["text"] for x in line_dedup.dedup(df, allowed=line_dedup.by_length).collect()}
    assert got == want
    assert sum(x == "" for x in want.values()) > 70
    fixed = line_dedup.dedup(df).where("text = ''").count()
    assert fixed < sum(x == "" for x in want.values())
    assert line_dedup.dedup(df.where(F.lit(False)), allowed=line_dedup.by_length).count() == 0


def test_pipeline_stage_follows_the_length(spark):
    from corpus_pipeline import line_dedup_stage

    text = "The quick brown fox jumps over the lazy dog while the band plays on in the old town square tonight."
    df = spark.createDataFrame([(1, text, 0), (2, text.replace("quick", "swift"), 0)], "doc_id long, text string, n_chars int")
    assert {r["doc_id"]: r["text"] for r in line_dedup_stage(spark, df, "").collect()} == {1: text, 2: ""}


def test_pipeline_stage_finds_edits_that_are_spread(spark):
    from corpus_pipeline import line_dedup_stage

    r = random.Random(14)
    rows = []
    for size in (60, 99, 140, 200, 300, 1000, 3001):
        text, most = [r.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(size)], size // 20
        spots = [(k + 1) * size // (most + 2) for k in range(most + 1)]  # as far apart as they can be
        near = "".join("#" if k in spots[:most] else x for k, x in enumerate(text))
        far = "".join("%" if k in spots else x for k, x in enumerate(text))
        rows += [(len(rows), "".join(text)), (len(rows) + 1, near), (len(rows) + 2, far)]
    df = spark.createDataFrame([(*x, 0) for x in rows], "doc_id long, text string, n_chars int")
    got = {r["doc_id"]: r["text"] for r in line_dedup_stage(spark, df, "").collect()}
    assert got == {k: "" if k % 3 == 1 else x for k, x in rows}


def test_short_lines(spark):
    texts = ["The end of it\nLes.\n\n \nab", "Les.\nThe and of it\n\n \nLes!", "Les.\nab\nac\nThe ant of it", None, "Short of it"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["text"] for r in line_dedup.dedup(df, allowed=line_dedup.by_length).collect()}
    # exact copies go at any length; "end" and "and" are one edit apart, and so are "and" and "ant"; below 10 code points no near copy goes
    assert got == {0: texts[0], 1: "\n \nLes!", 2: "ac", 3: None, 4: texts[4]}


def test_all_pairs_of_short_lines(spark):
    r = random.Random(3)
    texts = [edited(r, "".join(r.choice("ab ") for _ in range(size)) + "y", 1) for size in (3, 8, 9, 10, 11, 17, 18, 19, 20, 21) for _ in range(30)]
    label = list(range(len(texts)))
    for i, a in enumerate(texts):
        for j, b in enumerate(texts[:i]):
            n = min(len(a), len(b))
            if a.strip() and b.strip() and plain(a, b) <= (2 if n >= 20 else n // 10):
                label = [label[j] if x == label[i] else x for x in label]
    first = {}
    for k, x in enumerate(label):
        first.setdefault(x, k)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["text"] for r in line_dedup.dedup(df, allowed=line_dedup.by_length).collect()}
    assert got == {k: x if first[label[k]] == k else "" for k, x in enumerate(texts)}


def test_stage_leaves_only_what_its_result_reads(spark, lines):
    from corpus_pipeline import line_dedup_stage

    folder = Path(common.shared_folder(spark).removeprefix("file://"))
    before = set(folder.iterdir()) if folder.exists() else set()
    df = spark.createDataFrame([(k, x, 0) for k, x in enumerate(lines[:20])], "doc_id long, text string, n_chars int")
    out = line_dedup_stage(spark, df, "")
    left = sorted(x.name.partition("-")[0] for x in set(folder.iterdir()) - before)
    assert left == ["going", "places"] and out.count() == 20


def test_keys_stay_only_where_place_and_letters_leave_the_edits(spark):
    r = random.Random(21)
    word = lambda n: "".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(n))
    phrase = word(30)
    texts = [word(10 * k) + phrase + word(170 - 10 * k) for k in range(18)]  # one phrase in other places of other lines
    texts.append(edited(r, texts[0], 9))
    lines = spark.createDataFrame(list(enumerate(texts)), "line long, text string")
    bags = line_dedup.signed(lines)
    met = line_dedup.winnowed_met(lines, bags, line_dedup.by_length).collect()
    assert {(x["line"], x["other"]) for x in met} == {(0, 18)}
