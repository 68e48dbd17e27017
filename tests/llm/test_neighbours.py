import numpy as np
import pytest

from cohortkit.llm.neighbours import Codes, bounds, distances, nearest_neighbours, tile_neighbours


def brute(rows, queries, k):
    ok = {}
    for i, v in rows:
        if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            ok[i] = min(ok.get(i, v), v)
    out = {}
    for q in queries:
        if q in ok:
            d = sorted((float(distances(np.array([ok[q]], float), np.array([v], float))[0]), i)
                       for i, v in ok.items() if i != q and len(v) == len(ok[q]))
            out[q] = [(n + 1, i, s) for n, (s, i) in enumerate(d[:k])]
    return {q: v for q, v in out.items() if v}


def test_against_brute_force(spark):
    r = np.random.default_rng(1)
    rows = [(i, r.normal(size=8).astype(np.float32).tolist()) for i in range(300)]
    rows += [(300 + i, [1.0] * 8) for i in range(60)]  # ties
    rows += [(400, None), (401, [0.0] * 8), (402, [float("nan")] * 8), (403, [float("inf")] + [1.0] * 7),
             (404, [None] + [1.0] * 7), (405, []), (406, [1.0, 2.0]), (407, [2.0, 1.0]), (None, [1.0] * 8),
             (300, [2.0] * 8), (408, [1e30] * 8), (409, [1e-30] * 8)]
    df = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<float>, query_id string")
    queries = [i for i, _ in rows if i is not None and i % 20 == 0] + [406, 408, 409]
    got = {}
    for x in nearest_neighbours(df.where(df.vec_id.isin(queries)), df, k=5, query_block=10, candidate_block=64).collect():
        got.setdefault(x["query_id"], []).append((x["rank"], x["vec_id"], x["score"]))
    single = lambda v: None if v is None else [x if x is None else float(np.float32(x)) for x in v]
    want = brute([(i, single(v)) for i, v in rows], queries, 5)
    assert {q: sorted(v) for q, v in got.items()} == want


def test_few_candidates_and_empty(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.0, 1.0])], "vec_id long, embedding array<double>")
    assert [tuple(r)[:3] for r in nearest_neighbours(df.where("vec_id = 0"), df).collect()] == [(0, 1, 1)]
    assert nearest_neighbours(df.limit(0), df).count() == 0
    assert nearest_neighbours(df, df.limit(0)).count() == 0


@pytest.mark.parametrize("size", [1, 64, 1500])
def test_bounds_hold(size):
    r = np.random.default_rng(size)
    a, b = r.normal(size=(20, size)) * 100, r.normal(size=(30, size))
    b[0], b[1] = a[0], a[0] * (1 + 1e-9)
    low, high = bounds(Codes(a), Codes(b))
    exact = np.array([distances(np.repeat(x[None], 30, 0), b) for x in a])
    assert (low <= exact).all() and (exact <= high).all()


def test_tile_order():
    v = np.array([[1.0, 0], [0, 1], [1, 0], [1, 0]])
    assert tile_neighbours(np.array([5]), v[:1], np.array([5, 9, 8, 7]), v, 2) == [[(0.0, 7), (0.0, 8)]]
