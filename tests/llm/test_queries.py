"""The registered queries over the small tables: their columns, folds, thresholds and sums."""

import zlib

import numpy as np
import pyarrow.dataset as ds
import pytest

from helixlake.llm.queries import QUERIES, SQL

D = "/root/testdata/sf0.001"
COLUMNS = {
    "op1_quality_classifier": ["doc_id", "held_out", "score", "predicted"],
    "op2_ngram_jaccard_join": ["doc_id", "n_shingles", "component_id"],
    "op3_toxicity": ["doc_id", "held_out", "score", "predicted"],
    "op5_quality_rules": ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"],
    "op6_source_mixing": ["doc_id", "size", "source_size", "target", "taken"],
    "op7_nearest_neighbours": ["query_id", "rank", "vec_id", "score"],
    "op9_language_id": ["doc_id", "held_out", "lang_pred", "score"],
    "op10_bpe": ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
    "op11_best_fit_packing": ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
    "op12_merkle_manifest": ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"],
    "op13_phrase_collocations": ["lang", "rank", "phrase", "a", "l", "r", "n", "score"],
}


@pytest.fixture(scope="module")
def docs():
    return {r["doc_id"]: r for r in ds.dataset(f"{D}/documents.parquet").to_table().to_pylist()}


def crc(doc_id):
    return zlib.crc32(str(doc_id).encode())


@pytest.mark.parametrize("name", ["op1_quality_classifier", "op3_toxicity"])
def test_scores(spark, docs, name):
    rows = QUERIES[name](spark, D).collect()
    assert list(rows[0].asDict())[:4] == COLUMNS[name] and sorted(r.doc_id for r in rows) == sorted(docs)
    least = 0.3 if name.startswith("op1") else 0.5
    for r in rows:
        assert r.held_out == (crc(r.doc_id) % 5 == 0) and 0 <= r.score <= 1 and r.predicted == int(r.score >= least)


def test_languages(spark, docs):
    rows = QUERIES["op9_language_id"](spark, D).collect()
    assert list(rows[0].asDict()) == COLUMNS["op9_language_id"] and len(rows) == len(docs)
    assert all(r.held_out == (crc(r.doc_id) % 4 == 2) and 0 <= r.score <= 1 for r in rows)


def test_mix(spark, docs):
    rows = QUERIES["op6_source_mixing"](spark, D).collect()
    assert list(rows[0].asDict()) == COLUMNS["op6_source_mixing"] and len(rows) == len(docs)
    assert all(r.taken % max(1, r.size) == 0 and r.taken <= 3 * r.size for r in rows)
    by = {docs[r.doc_id]["source"]: r for r in rows}
    assert sum(r.target for r in by.values()) == pytest.approx(sum(r.size for r in rows), rel=1e-6)
    assert {(r.doc_id, r.taken) for r in rows} == {(r.doc_id, r.taken) for r in QUERIES["op6_source_mixing"](spark, D).collect()}


def test_neighbours(spark):
    table = ds.dataset(f"{D}/embeddings.parquet").to_table()
    ids, x = table.column("vec_id").to_numpy(), np.array(table.column("embedding").to_pylist(), np.float64)
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    rows = QUERIES["op7_nearest_neighbours"](spark, D).collect()
    assert list(rows[0].asDict()) == COLUMNS["op7_nearest_neighbours"]
    got: dict = {}
    for r in rows:
        got.setdefault(r.query_id, {})[r.rank] = (r.vec_id, r.score)
    assert sorted(got) == sorted(int(i) for i in ids if i % 50 == 0)
    for q, near in got.items():
        score = unit @ unit[ids == q][0]
        score[ids == q] = -2
        want = np.sort(score)[::-1][:5]
        assert [near[k][1] for k in range(1, 6)] == pytest.approx(want.tolist(), abs=1e-9)


@pytest.mark.parametrize("name", sorted(set(COLUMNS) & set(SQL)))
def test_queries_against_their_sql(spark, name):
    import duckdb

    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{D}/documents.parquet'")
    got = QUERIES[name](spark, D)
    assert got.columns == COLUMNS[name]
    found = con.execute(SQL[name])
    at = [[c[0] for c in found.description].index(c) for c in got.columns]
    assert sorted(repr(tuple(r)) for r in got.collect()) == sorted(repr(tuple(r[k] for k in at)) for r in found.fetchall())
