import math

import numpy as np
import pytest

from millrace.llm import whitening
from millrace.llm.queries import QUERIES

from llm_help import SF

SCHEMA = "vec_id long, embedding array<double>, component string, id string, n string"


def brute(rows, wanted=8):
    """(x, n, deviations, eigenvalues, eigenvectors as columns, trace) of the usable rows of one length."""
    good = [v for v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    x = [[math.floor(1024 * float(c)) + 100000 for c in v] for v in good]
    n, sums = len(x), [sum(c) for c in zip(*x)]
    deviations = [sum((n * a - s) ** 2 for a, s in zip(v, sums)) for v in x]
    centred = np.array([[(n * a - s) / n for a, s in zip(v, sums)] for v in x])
    e, vectors = np.linalg.eigh(centred.T @ centred / n)
    order = np.argsort(-e)[:wanted]
    return centred, n, deviations, e[order], vectors[:, order], e.sum()


def check(got, rows, wanted=8):
    """``got`` rows against brute force; within tied eigenvalues any basis is right."""
    centred, n, deviations, e, vectors, trace = brute([v for _, v in rows], wanted)
    e = e[e > 1e-9 * e[0]]
    assert len(got) == n * len(e)
    by = {}
    for r in got:
        assert r["n"] == n and r["identity_error"] <= 1e-8
        by.setdefault(r["component"], []).append(r)
    ids = [i for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    for k, value in enumerate(e, 1):
        part = by[k]
        assert part[0]["explained"] == pytest.approx(value / trace, rel=1e-10)
        assert sorted((str(r["vec_id"]), int(r["deviation"])) for r in part) == sorted((str(i), d) for i, d in zip(ids, deviations))
        if all(abs(value - other) > 1e-6 * e[0] for j, other in enumerate(e, 1) if j != k):
            want = centred @ vectors[:, k - 1] / math.sqrt(value)
            have = {(str(r["vec_id"]), int(r["deviation"])): r["whitened"] for r in part}
            mine = np.array([have[str(i), d] for i, d in zip(ids, deviations)])
            assert min(np.abs(mine - want).max(), np.abs(mine + want).max()) < 1e-8


def test_query_matches_brute_force(spark):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    check(QUERIES["op11_whiten"](spark, SF).collect(), rows)


def run(spark, rows, **options):
    df = spark.createDataFrame([(i, v, "c", "i", "n") for i, v in rows], SCHEMA).repartition(3)
    return whitening.whiten(df, **options).withColumnRenamed("id", "vec_id").collect()


def test_odd_rows(spark):
    rng = np.random.default_rng(3)
    rows = [(i, v.tolist()) for i, v in enumerate(rng.normal(size=(60, 12)) * np.arange(1, 13))]
    rows += [(None, rows[0][1]), (5, rows[5][1]), (70, None), (71, [None] * 12), (72, [float("nan")] + [0.0] * 11), (73, [float("inf")] * 12), (74, [])]
    check(run(spark, rows), rows)
    others = run(spark, rows + [(80, [1.0, 2.0]), (81, [5.0])])   # other lengths take no part
    assert len(others) == 62 * 8 and others[0]["n"] == 62
    assert run(spark, []) == [] and run(spark, [(1, None)]) == []
    assert run(spark, [(1, [3.0, 4.0]), (2, [3.0, 4.0])]) == []   # no deviation, no component
    assert run(spark, [(1, [3.0])]) == []


def test_ties_and_constant_dimensions(spark):
    """Corners of a cross: all deviations tie, half of the dimensions are constant or copies."""
    rows = []
    for k in range(6):
        for sign in (1.0, -1.0):
            v = [0.0] * 6
            v[k] = sign
            rows.append((len(rows), v + [7.0, v[0], v[1]]))
    check(run(spark, rows), rows)


def test_stops_early_and_finds_all_that_matter():
    rng = np.random.default_rng(8)
    spread = np.concatenate(([30, 30, 30, 20, 20, 9, 8, 7.5], np.full(192, 0.05)))
    x = rng.normal(size=(4000, 200)) * spread
    x -= x.mean(0)
    # the largest three tie exactly
    q, s, t = np.linalg.svd(x, full_matrices=False)
    s[1] = s[2] = s[0]
    x = q * s @ t
    scans = []

    def product(p):
        scans.append(1)
        u = x @ p
        return x.T @ u, float(u @ u)

    values, vectors = whitening.components_of(product, 200, float((x * x).sum()), 8)
    assert np.allclose(values, s[:8], rtol=1e-12)
    assert np.abs(x.T @ (x @ vectors) - vectors * values ** 2).max() < 1e-9 * values[0] ** 2
    assert np.abs(vectors.T @ vectors - np.eye(8)).max() < 1e-12


def test_large_counts_stay_exact():
    n = 3_000_000_000
    centre = whitening.Centre(n, np.array([100_000, 100_001]), np.array([5, n - 1]))
    data = np.array([[99_000, 100_500], [100_000, 100_001]], np.int64).tobytes()
    assert whitening._deviations(centre, data) == [
        (n * -1000 - 5) ** 2 + (n * 499 - n + 1) ** 2, 25 + (n - 1) ** 2]
