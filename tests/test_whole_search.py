"""Candidates of a query whose text very many references hold."""

from helixlake.operators import search


def test_frequent_kmers_stay(spark, monkeypatch):
    monkeypatch.setattr(search, "HOT", 40)
    text = "MKTAYIAKQRQISFVKSHFSRQ"
    q = spark.createDataFrame([(1, text)], "query long, sequence string")
    r = spark.createDataFrame([(k, "AC" * (k % 3) + text) for k in range(250)], "ref long, sequence string")
    got = sorted((x["ref"], x["diagonal"], x["shared"]) for x in search.candidates(q, r).collect())
    assert got == [(k, 2 * (k % 3), len(text) - 11) for k in range(250)]
