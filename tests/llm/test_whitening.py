import math

import numpy as np
import pytest

from cohortkit.llm import queries, whitening
from cohortkit.llm.whitening import scatter, whiten

VECTORS = "vec_id long, embedding array<float>"


def whole(vector):
    return [math.floor(1024 * float(np.float32(c))) + 100_000 for c in vector]


def check(rows, vectors, components=8):
    """Against whole-number sums and numpy's eigenvectors of the covariance."""
    x = [whole(v) for _, v in vectors]
    n, dim = len(x), len(x[0])
    sums = [sum(r[d] for r in x) for d in range(dim)]
    t = np.array([[n * r[d] - sums[d] for d in range(dim)] for r in x], object)
    values, axes = np.linalg.eigh((t.T @ t).astype(float) / n ** 3)
    values, axes = values[::-1], axes[:, ::-1]
    place = {i: k for k, (i, _) in enumerate(vectors)}
    used = min(components, dim)
    scores = np.zeros((n, used))
    assert len(rows) == n * used
    for r in rows:
        k, c = place[r["vec_id"]], r["component"] - 1
        scores[k, c] = r["whitened"]
        assert r["n"] == n and int(r["deviation"]) == sum(int(v) ** 2 for v in t[k])
        assert r["explained"] == pytest.approx(values[c] / values.sum(), rel=1e-9)
        assert 0 <= r["identity_error"] < 1e-9
    expected = (t / n).astype(float) @ axes[:, :used] / np.sqrt(values[:used])
    for c in range(used):
        assert min(np.abs(scores[:, c] - expected[:, c]).max(), np.abs(scores[:, c] + expected[:, c]).max()) < 1e-7


@pytest.mark.parametrize("spread", [1, 2, 1000, 1 << 20, 1 << 40, 1 << 51])
def test_bit_slices_give_exact_products(spread):
    rng = np.random.default_rng(spread % 97)
    for n in (1, 63, 64, 65, 300):
        x = rng.integers(-spread, spread, (n, 5))
        x[:, 3] = 7
        sums, pairs = scatter(x)
        o = x.astype(object)
        assert sums == [int(v) for v in o.sum(axis=0)]
        assert pairs == [int(o[:, i] @ o[:, j]) for i in range(5) for j in range(i, 5)]


@pytest.mark.parametrize("block", [50, 1 << 14])
def test_equals_a_direct_computation(spark, monkeypatch, block):
    monkeypatch.setattr(whitening, "BLOCK", block)
    rng = np.random.default_rng(3)
    axes = rng.normal(size=(12, 12)) * np.arange(1, 13)
    vectors = [(i, v) for i, v in enumerate((rng.normal(size=(400, 12)) @ axes.T).astype(np.float32).tolist())]
    frame = spark.createDataFrame(vectors, VECTORS).repartition(5)
    check(whiten(frame, columns=["vec_id"]).collect(), vectors)
    few = [(i, v[:3]) for i, v in vectors]
    check(whiten(spark.createDataFrame(few, VECTORS)).collect(), few)


def test_wide_entries_stay_exact(spark):
    rng = np.random.default_rng(4)
    vectors = [(i, v) for i, v in enumerate((rng.normal(size=(60, 3)) * 2.0 ** 35).astype(np.float32).tolist())]
    check(whiten(spark.createDataFrame(vectors, VECTORS)).collect(), vectors)


def test_rows_that_take_no_part(spark):
    rng = np.random.default_rng(5)
    vectors = [(i, v) for i, v in enumerate(rng.normal(size=(40, 4)).astype(np.float32).tolist())]
    nan, inf = float("nan"), float("inf")
    bad = [(100, None), (101, [1.0, None, 2.0, 3.0]), (102, [nan, 0.0, 0.0, 0.0]), (103, [0.0, -inf, 0.0, 0.0]),
           (104, []), (105, [1.0, 2.0]), (106, [3e38, 0.0, 0.0, 0.0])]
    frame = spark.createDataFrame(bad[:4] + vectors + bad[4:], VECTORS)
    check(whiten(frame).collect(), vectors)


def test_flat_empty_repeated_and_clashing(spark):
    flat = spark.createDataFrame([(i, [1.0, 2.0]) for i in range(9)], VECTORS)
    assert whiten(flat).count() == 0 and whiten(flat.limit(0)).count() == 0
    assert whiten(spark.createDataFrame([(1, None)], VECTORS)).count() == 0
    line = spark.createDataFrame([(i, [float(i % 5), 1.0], "x") for i in range(10)] + [(None, [2.0, 1.0], None)],
                                 VECTORS + ", n string")
    rows = whiten(line).collect()  # one dimension varies: one component
    assert whiten(line).columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    assert len(rows) == 11 and {r["component"] for r in rows} == {1} and {r["n"] for r in rows} == {11}
    assert {r["explained"] for r in rows} == {1.0}


def test_query_over_the_whole_table(spark):
    sf = "/root/testdata/sf0.001"
    given = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    good = [(i, v) for i, v in given if v is not None and None not in v and all(map(math.isfinite, v))]
    check(queries.op12_whitening(spark, sf).collect(), good)
