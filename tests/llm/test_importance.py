import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortkit.llm.importance import gram_blocks, importance_sample, kth_largest, order_key

SCHEMA = "doc_id long, text string, kept string"


def test_grams_stay_within_texts():
    t = ["abcdef", "", "abc", "abcd", "é"]
    raw = "".join(t).encode()
    offsets = np.cumsum([0] + [len(x.encode()) for x in t])
    found = [(d, h) for doc, hs in gram_blocks(np.frombuffer(raw, np.uint8), offsets, 4, 1 << 10) for d, h in zip(doc, hs)]
    assert [d for d, _ in found] == [0, 0, 0, 3]
    assert found[0][1] == found[3][1] and all(0 <= h < 1 << 10 for _, h in found)


def test_order_key():
    v = np.array([-np.inf, -5.5, -1e-300, -0.0, 0.0, 1e-300, 2.0, np.inf])
    k = order_key(v)
    assert (np.diff(k) >= 0).all() and k[3] == k[4] and len(set(k.tolist())) == 7


@pytest.mark.parametrize("seed", [1, 2])
def test_kth_largest(spark, seed):
    r = random.Random(seed)
    v = [r.choice([r.randint(-(1 << 63), (1 << 63) - 1), r.randint(-5, 5)]) for _ in range(300)]
    df = spark.createDataFrame([(x,) for x in v], "x long").repartition(3)
    for k in (1, 2, 150, 299, 300):
        assert kth_largest(df, "x", k) == sorted(v, reverse=True)[k - 1]
    assert kth_largest(df, "x", 301) is None and kth_largest(df, "x", 0) is None


def corpus(seed, n):
    """(rows, labels): good prose and bad lists, half of them labelled."""
    r = random.Random(seed)
    rows, truth = [], {}
    for i in range(n):
        good = r.random() < 0.8
        w = ["".join(r.choices("etaoinshr", k=r.randint(2, 8))) for _ in range(r.randint(20, 120))]
        rows.append((i, " ".join(w) if good else " | ".join(w) + "$$$", "k"))
        truth[i] = int(good)
    return rows, truth


def test_held_out_accuracy(spark):
    rows, truth = corpus(3, 800)
    docs = spark.createDataFrame(rows, SCHEMA)
    labels = spark.createDataFrame([(i, truth[i]) for i in range(0, 800, 2)], "doc_id long, quality int")
    out = {x["doc_id"]: x for x in importance_sample(docs, labels).collect()}
    held = range(1, 800, 2)
    good, bad = [i for i in held if truth[i]], [i for i in held if not truth[i]]
    assert np.mean([out[a]["log_weight"] > out[b]["log_weight"] for a in good for b in bad]) > 0.99
    assert np.mean([out[i]["kept"] for i in good]) > 0.95
    share = sum(truth[i] for i in range(0, 800, 2)) / 400
    assert sum(x["kept"] for x in out.values()) == round(share * 800)


def test_sampling_follows_the_weights(spark):
    """Without labels weights are equal and every row is as likely as another."""
    docs = spark.createDataFrame([(i, "same text", "k") for i in range(1000)], SCHEMA)
    none = spark.createDataFrame([], "doc_id long, quality int")
    kept = [{x["doc_id"] for x in importance_sample(docs, none, share=0.3, seed=s).where("kept").collect()} for s in (1, 2)]
    assert len(kept[0]) == len(kept[1]) == 300 and 50 < len(kept[0] & kept[1]) < 140


def test_nulls_repeats_ties_and_empty(spark):
    docs = spark.createDataFrame([(1, None, "k"), (2, "", "k"), (None, "text here", "k"), (3, "x" * 100000, "k"),
                                  (3, "x" * 100000, "k")], SCHEMA)
    labels = spark.createDataFrame([(3, 1), (3, 0), (2, 1), (None, 1), (9, None)], "doc_id long, quality int")
    out = importance_sample(docs, labels, share=0.5)
    assert out.columns == ["doc_id", "text", "n_grams", "log_weight", "gumbel_key", "kept"]
    got = out.collect()
    assert len(got) == 5 and {x["n_grams"] for x in got if not x["text"]} == {0}
    assert importance_sample(docs.limit(0), labels).count() == 0
    assert importance_sample(docs, labels, share=0.0).where(F.col("kept")).count() == 0


def test_whole_result_by_brute_force(spark):
    """Models, weights, keys and kept rows by plain Python over every row."""
    r = random.Random(6)
    alphabet, n, buckets, smoothing, seed = "ab cé", 4, 1 << 8, 1e-2, 11
    rows = [(i, "".join(r.choices(alphabet, k=r.choice([0, 3, 4, 50, 400]))) or None, "k") for i in range(120)]
    rows += [(7, rows[7][1], "k"), (None, "abab abab", "k")]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(4)
    labels = [(i, int(i % 3 > 0)) for i in range(0, 120, 2)] + [(4, 0), (500, 1)]
    out = importance_sample(docs, spark.createDataFrame(labels, "doc_id long, quality int"), n=n, buckets=buckets)

    def grams(text):
        raw = (text or "").encode()
        return [hash_of(raw[i:i + n]) for i in range(len(raw) - n + 1)]

    def hash_of(gram):
        h = 0
        for byte in gram:
            h = (h * 257 + byte) % (1 << 64)
        return (h * 0x9E3779B97F4A7C15) % (1 << 64) >> 56

    good = {i: min(q for k, q in labels if k == i) for i, _ in labels}
    raw, target = [0] * buckets, [0] * buckets
    for i, text, _ in rows:
        for g in grams(text):
            raw[g] += 1
            target[g] += good.get(i, 0)

    def log_p(counts):
        p = [c / sum(counts) + smoothing / buckets for c in counts]
        return [math.log(x / sum(p)) for x in p]

    ratio = [a - b for a, b in zip(log_p(target), log_p(raw))]
    noise = {x["doc_id"]: x["u"] for x in docs.select("doc_id", F.pmod(F.xxhash64(F.lit(seed), "doc_id"), F.lit(1 << 52)).alias("u")).collect()}
    want = []
    for i, text, _ in rows:
        weight = sum(ratio[g] for g in grams(text))
        want.append((repr(i), len(grams(text)), weight, weight - math.log(-math.log((noise[i] + 0.5) / (1 << 52)))))
    k = round(sum(good.values()) / len(good) * len(rows))
    least = sorted((w[3] for w in want), reverse=True)[k - 1]
    got = sorted((repr(x["doc_id"]), x["n_grams"], x["log_weight"], x["gumbel_key"], x["kept"]) for x in out.collect())
    assert len(got) == len(want)
    for g, w in zip(got, sorted(want)):
        assert g[:2] == w[:2] and g[2:4] == pytest.approx(w[2:], abs=1e-8) and g[4] == (w[3] >= least - 1e-9)
