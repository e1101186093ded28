"""Packing, manifest and collocations against plain loops, and special rows of each."""

import hashlib
import random
import re
import unicodedata
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import regex
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from helixlake.llm import bpe, collocations, merkle, packing
from helixlake.llm.queries import TOKENIZER

PATH = public_tokenizers.path(TOKENIZER)
LONG = "a long text, that goes on and on. " * 3000
ODD = [(1, "Plain words of a text.", "s"), (2, None, None), (3, "", "s"), (4, LONG, ""), (5, "Plain words of a text.", "s"), (1, "Plain words of a text.", "s"), (None, "no id here", None)]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def odd(spark):
    df = spark.createDataFrame(ODD, "doc_id long, text string, lang string")
    for name in ("part", "nth", "n", "pos", "block", "top", "path", "key", "digest", "g", "h1", "word", "name", "rank", "length", "number", "score"):
        df = df.withColumn(name, F.lit(7))
    return df.repartition(3)


def test_every_code_point_is_split_as_the_library_does(library):
    assigned = [c for c in range(0x110000) if unicodedata.category(chr(c)) not in ("Cn", "Co", "Cs")]
    newer = [c for c in range(0x110000) if unicodedata.category(chr(c)) == "Cn"]
    known = regex.compile(r"\P{Cn}")
    some = assigned + [c for c in newer if known.match(chr(c))] + newer[::211]
    texts = [f"a{chr(c)}b 1{chr(c)} {chr(c)}{chr(c)}" for c in some]
    want = [" ".join(map(str, e.ids)) for e in library.encode_batch(texts, add_special_tokens=False)]
    encoder = bpe.Encoder(PATH, None)
    got = [i for k in range(0, len(texts), 20_000) for _, i, _ in encoder.texts(texts[k : k + 20_000])]
    assert [hex(c) for c, a, b in zip(some, want, got, strict=True) if a != b] == []


def test_merges_of_many_words_and_of_long_ones(library):
    r = random.Random(3)
    words = ["".join(r.choice("abcdetnirsoé1.,#'") for _ in range(r.randrange(1, 130))) for _ in range(400)] + ["ab" * 40_000]
    rule = bpe.WordBpe(PATH)
    want = [[t.id for t in library.model.tokenize("".join(rule.letters[b] for b in w.encode()))] for w in words]
    assert rule.merge_many(words) == want and [rule.merge(w) for w in words] == want


def test_ids_of_texts(library):
    texts = ["", None, "a<|endoftext|>b c", "x\x1cy z.", " a ", "\x85 b,\n", "Final ΣΣ. É́", LONG]
    want = [np.array(e.ids, "<u4").tobytes() for e in library.encode_batch([x or "" for x in texts], add_special_tokens=False)]
    assert list(packing.Ids(PATH).ids(texts)) == want


def check_bins(rows, ids, capacity):
    bins, of = defaultdict(list), defaultdict(list)
    for x in rows:
        bins[x["sequence_id"]].append((x["offset"], x["length"]))
        of[x["doc_id"]].append(x)
    for places in bins.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= capacity
    for doc, own in of.items():
        want = Counter()
        for x in ids[doc]:
            for k, a in enumerate(range(0, len(x), capacity)):
                part = x[a : a + capacity]
                want[(k, a, len(part), zlib.crc32(np.array(part, "<u4").tobytes()))] += 1
        assert Counter((x["piece"], x["start"], x["length"], x["ids_crc32"]) for x in own) == want
    return len(bins)


def test_packing_rows(odd, library):
    ids = defaultdict(list)
    for doc, text, _ in ODD:
        ids[doc].append([*library.encode(text or "", add_special_tokens=False).ids, 1])
    rows = packing.pack(odd, PATH).collect()
    total = sum(len(x) for own in ids.values() for x in own)
    assert check_bins(rows, ids, 4096) == -(-total // 4096)
    assert packing.pack(odd.where("doc_id < 0"), PATH).count() == 0
    assert check_bins(packing.pack(odd, PATH, capacity=7).collect(), ids, 7) >= total // 7


def test_bins_are_the_fullest():
    r = random.Random(4)
    for _ in range(60):
        count = {r.randrange(1, 40): r.randrange(1, 5) for _ in range(r.randrange(1, 7))}
        room = r.randrange(1, 60)
        sums = {0}
        for length, n in count.items():
            sums = {s + length * k for s in sums for k in range(n + 1) if s + length * k <= room}
        taken = packing.fullest(count, room)
        assert sum(k * n for k, n in taken.items()) == max(sums) and all(n <= count[k] for k, n in taken.items())
        bins = packing.packed(dict(count), 60)
        left = Counter()
        for taken, times in bins:
            assert sum(k * n for k, n in taken.items()) <= 60
            left.update({k: n * times for k, n in taken.items()})
        assert left == Counter(count)


def plain_manifest(rows, levels_of):
    h = lambda *x: hashlib.sha256("".join(x).encode()).hexdigest()
    field = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"

    def tree(nodes):
        steps = [[nodes[i ^ 1] if i ^ 1 < len(nodes) else "" for i in range(len(nodes))]] if len(nodes) > 1 else []
        at = nodes
        while len(at) > 1:
            at = [h(*at[i : i + 2]) for i in range(0, len(at), 2)]
            if len(at) > 1:
                steps.append([at[i ^ 1] if i ^ 1 < len(at) else "" for i in range(len(at))])
        return at[0], [[s[i >> j] for j, s in enumerate(steps)] for i in range(len(nodes))]

    groups = defaultdict(list)
    for doc, text, lang in rows:
        groups[lang].append((doc is not None, doc or 0, h(field(doc), field(lang), field(text)), doc))
    names = sorted(groups, key=lambda x: (x is not None, (x or "").encode()))
    roots, out = [], []
    for name in names:
        own = sorted(groups[name])
        root, steps = tree([x[2] for x in own])
        roots.append(root)
        out += [(name, x[3], x[2], root, s) for x, s in zip(own, steps, strict=True)]
    root, above = tree(roots)
    return Counter((doc, leaf, sub, root, h(*s, *above[names.index(name)])) for name, doc, leaf, sub, s in out)


@pytest.mark.parametrize("levels", [1, 2, 10])
def test_manifest(spark, odd, levels):
    rows = ODD + [(k, f"text {k}", lang) for k in range(10, 37) for lang in ("x", None)[: 1 + k % 2]] + [(99, "alone", "é")]
    wide = odd.select("doc_id", "text", "lang", *odd.columns[3:]).unionByName(spark.createDataFrame(rows[len(ODD) :], "doc_id long, text string, lang string"), allowMissingColumns=True)
    now = F.when(F.col("doc_id") % 2 == 0, merkle.leaf(["doc_id", "lang", F.concat("text", F.lit("!"))]))
    found = merkle.manifest(wide, "lang", "doc_id", ["doc_id", "lang", "text"], {"now": now}, levels)
    found = found.select("*", F.sha2(merkle.proof("path"), 256).alias("proof"), merkle.folded("leaf", "path").alias("same"), merkle.folded(F.coalesce("now", "leaf"), "path").alias("folded")).collect()
    assert Counter((x["doc_id"], x["leaf"], x["subroot"], x["root"], x["proof"]) for x in found) == plain_manifest(rows, levels)
    assert all(x["same"] == x["root"] for x in found)
    assert all((x["folded"] == x["root"]) == (x["now"] in (None, x["leaf"])) for x in found)


def test_manifest_of_nothing_and_of_one(spark):
    rows = spark.createDataFrame([(5, "t", "a")], "doc_id long, text string, lang string")
    make = lambda d: merkle.manifest(d, "lang", "doc_id", ["doc_id", "text"]).collect()
    (one,) = make(rows)
    assert one["leaf"] == one["subroot"] == one["root"] and one["path"] == []
    assert make(rows.where("doc_id < 0")) == []


def plain_collocations(rows, least, top):
    f, n = defaultdict(Counter), Counter()
    for _, text, lang in rows:
        own = "und" if lang is None else lang
        lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower):
            w = [x for x in re.split(r"[\x20\x09]+", piece) if x]
            n[own] += len(w)
            for k in range(1, 5):
                f[own].update(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, count in f.items():
        own = {g: a for g, a in count.items() if len(g) > 1 and a >= least}
        rows_ = []
        for g, a in own.items():
            inside = lambda z, g=g: any(z[i : i + len(g)] == g for i in range(len(z) - len(g) + 1))
            if any(len(z) > len(g) and 100 * b >= 80 * a and inside(z) for z, b in own.items()):
                continue
            score, _, l, r = min((2_000_000 * a // (count[g[:k]] + count[g[k:]]), k, count[g[:k]], count[g[k:]]) for k in range(1, len(g)))
            rows_.append((-score, -a, " ".join(g).encode(), l, r))
        for rank, (s, a, g, l, r) in enumerate(sorted(rows_)[:top], 1):
            out.append((lang, rank, g.decode(), -a, l, r, n[lang], -s))
    return sorted(out)


@pytest.mark.parametrize("bits", [28, 15])
def test_collocations(spark, odd, monkeypatch, bits):
    monkeypatch.setattr(collocations, "MAX_BITS", bits)
    r = random.Random(9)
    words = ["alpha", "Beta", "gamma", "é", "the", "of", "x1", "#"]
    texts = [" ".join(r.choice(words) + r.choice(["", "", "", ".", "\n", ",\t"]) for _ in range(r.randrange(0, 60))) for _ in range(300)]
    rows = ODD + [(k, t, ("en", "fr", None, "und")[k % 4]) for k, t in enumerate(texts)]
    df = odd.unionByName(spark.createDataFrame(rows[len(ODD) :], "doc_id long, text string, lang string"), allowMissingColumns=True)
    for least, top in ((30, 2000), (5, 40)):
        got = sorted(tuple(x) for x in collocations.collocations(df, "lang", least=least, top=top).collect())
        assert got == plain_collocations(rows, least, top) and got
    assert collocations.collocations(df.where("doc_id < 0"), "lang").count() == 0


def test_words_that_share_a_hash_are_hashed_anew(spark, monkeypatch):

    rows = [(k, "one two three " * 20, "en") for k in range(3)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    found, again = collocations.counts, []

    def counts(texts, seed):
        again.append(seed)
        out = found(texts, seed)
        return out.withColumn("high", F.col("low") + 1) if seed == 0 else out

    monkeypatch.setattr(collocations, "counts", counts)
    got = sorted(tuple(x) for x in collocations.collocations(df, "lang", least=5).collect())
    assert again == [0, 1] and got == plain_collocations(rows, 5, 2000)
