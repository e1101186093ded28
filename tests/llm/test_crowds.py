"""Nearest neighbours among crowds of scaled and jittered copies, against brute force."""

import numpy as np
from pyspark.sql import functions as F

from helixlake.llm import ann


def test_crowds(spark):
    r = np.random.default_rng(6)
    x = r.normal(size=(5000, 16))
    crowd, close = r.permutation(5000)[:3600].reshape(2, 1800)
    x[crowd] = x[crowd[0]] * r.uniform(0.5, 2, 1800)[:, None]
    x[close] = x[close[0]] + r.normal(size=(1800, 16)) * 1e-4
    df = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(x)], "vec_id long, embedding array<double>").repartition(3)
    ask = sorted({*map(int, crowd[:4]), *map(int, close[:4]), 0, 1, 2})
    got: dict = {}
    for row in ann.search(df, F.col("vec_id").isin(ask)).collect():
        got.setdefault(row["query_id"], {})[row["rank"]] = row["vec_id"]
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    for q in ask:
        score = np.round(unit @ unit[q], 12)
        score[q] = -2
        assert [got[q][k] for k in range(1, 6)] == np.lexsort((np.arange(5000), -score))[:5].tolist()
