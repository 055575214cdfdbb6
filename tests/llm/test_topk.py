import math

import numpy as np
from pyspark.sql import functions as F

from millrace.llm import topk


def brute(rows, k):
    """rows of (id, vector): for each query id its k best (score, id)."""
    good = [(i, [math.floor(64 * float(c)) for c in v]) for i, v in rows
            if i is not None and v and all(c is not None and math.isfinite(c) for c in v)]
    out = []
    for n, (q, a) in enumerate(good):
        if q % 20 == 0:
            scores = sorted((-sum(x * y for x, y in zip(a, b)), i) for m, (i, b) in enumerate(good) if m != n and len(a) == len(b))
            out += [(q, rank, i, -s) for rank, (s, i) in enumerate(scores[:k], 1)]
    return sorted(out)


def test_matches_brute_force(spark):
    rng = np.random.default_rng(4)
    rows = [(int(i), rng.normal(size=17).round(2).tolist()) for i in range(300)]
    rows += [(400, rows[0][1]), (401, rows[0][1]), (401, rows[0][1]), (440, [None] * 17), (460, None), (None, rows[1][1]),
             (480, [float("nan")] + [0.0] * 16), (500, [1.0, 2.0]), (501, [3.0, -1.0]), (520, [1e9] * 17), (521, [])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(5)
    got = topk.top_k(df, F.col("id") % 20 == 0, k=5).select("query_id", "rank", "id", "score").collect()
    assert sorted(map(tuple, got)) == brute(rows, 5)
    assert topk.top_k(df.limit(0), F.col("id") % 20 == 0).count() == 0


def test_bounds_are_bounds():
    rng = np.random.default_rng(5)
    q, x = rng.normal(size=(20, 33)), rng.normal(size=(30, 33))
    exact = q @ x.T
    last = None
    for parts in topk.LEVELS:
        bound = topk.segment_statistics(q, parts) @ topk.segment_statistics(x, parts).T
        assert (bound >= exact - 1e-9).all()
        last = bound if last is None else last
    assert (bound <= last + 1e-9).mean() > 0.9   # finer is mostly tighter
