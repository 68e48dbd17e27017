import random
import re

import numpy as np
import pandas as pd
import pytest

from cohortkit.llm.components import _settled, _star, components
from cohortkit.llm.ngram_join import bitmap_bits, fold, may_link, near_duplicates, parity_bitmap, shingle_sets, size_band
from cohortkit.llm.queries import OP7_SQL
from cohortkit.llm.words import word_hashes

from llm_fixtures import make_docs, sql_rows  # noqa: F401

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text):
    w = WORD.findall("".join(c.lower() if c.isascii() else c for c in text or ""))
    if len(w) >= 5:
        return {tuple(w[i:i + 5]) for i in range(len(w) - 4)}
    return {tuple(w)} if w else set()


def brute(rows, percent=80):
    """{id: component} with rows of one id as one document."""
    sets = [(i, shingles(t)) for i, t in rows]
    parent = {i: i for i, _ in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for n, (i, a) in enumerate(sets):
        for j, b in sets[:n]:
            common = len(a & b)
            if a and b and 100 * common >= percent * (len(a) + len(b) - common):
                x, y = sorted((find(i), find(j)))
                parent[y] = x
    return {i: find(i) for i in parent}


def corpus(seed):
    r = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    passage = " ".join(r.choices(words, k=40))
    rows = []

    def change(text, share):
        return " ".join(w if r.random() > share else r.choice(words) for w in text.split())

    for g in range(25):
        base = " ".join(r.choices(words, k=r.choice([3, 5, 8, 30, 120])))
        rows += [base] + [change(base, r.choice([0, 0.01, 0.03, 0.05])) for _ in range(r.choice([0, 1, 2, 5]))]
    rows += [passage + " " + " ".join(r.choices(words, k=r.choice([2, 4, 8, 12, 40]))) for _ in range(30)]
    big = " ".join(r.choices(words, k=100))
    rows += [change(big, 0.015) for _ in range(70)] + [big] * 10
    rows += [None, "", " \n\t", "one", "One", "a b c d", "A B\nc D", "a b c d e", "x " * 400, "x " * 9]
    r.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize("seed, block", [(1, 1024), (2, 8)])
def test_components_by_brute_force(make_docs, seed, block):
    rows = corpus(seed)
    got = {r["doc_id"]: r for r in near_duplicates(make_docs(rows), buckets=1 << 10, block=block).collect()}
    assert {i: r["component_id"] for i, r in got.items()} == brute(rows)
    assert all(got[i]["n_shingles"] == len(shingles(t)) for i, t in rows)


def test_chain_repeats_nulls_and_empty(spark):
    w = [f"v{i}" for i in range(200)]
    # a chain: neighbours are alike, the ends are not
    rows = [(10 + i, " ".join(w[3 * i:3 * i + 60]), "c") for i in range(20)]
    rows += [(5, "other text that nobody else has here", "c"), (5, rows[3][1], "c"), (None, rows[3][1], "c")]
    df = spark.createDataFrame(rows, "doc_id long, text string, component_id string")
    got = [tuple(r) for r in near_duplicates(df).collect()]
    assert len(got) == len(rows)
    assert {c for i, _, c in got if i is not None} == {5}
    assert [c for i, _, c in got if i is None] == [None]
    assert near_duplicates(df.limit(0)).count() == 0


def test_bitmaps_never_exclude_a_link():
    r = np.random.default_rng(1)
    for _ in range(200):
        n = int(r.integers(1, 300))
        a = r.integers(0, 1 << 63, n, dtype=np.uint64)
        b = np.unique(np.concatenate([a[:int(n * r.uniform(0.7, 1)) or 1], r.integers(0, 1 << 63, int(r.integers(0, 30)), dtype=np.uint64)]))
        a = np.unique(a)
        x, y = parity_bitmap(a)[None], parity_bitmap(b)[None]
        least = min(x.shape[1], y.shape[1])
        differing = np.bitwise_count(fold(x, least) ^ fold(y, least)).sum()
        common = len(np.intersect1d(a, b))
        assert differing <= len(a) + len(b) - 2 * common
        if 100 * common >= 80 * (len(a) + len(b) - common):
            assert may_link(np.array([len(a)]), np.array([len(b)]), np.array([differing]), 80)[0]
    assert bitmap_bits(1) == bitmap_bits(64) == 64 and bitmap_bits(65) == 128


def test_word_hashes():
    texts = ["a b", "", "b\x0ba  A", "ab é", " ", "é"]
    data = "".join(texts).encode()
    offsets = np.cumsum([0] + [len(t.encode()) for t in texts])
    h, at = word_hashes(np.frombuffer(data, np.uint8), offsets)
    assert np.diff(at).tolist() == [2, 0, 3, 2, 0, 1]
    assert h[0] == h[3] and h[1] == h[2] and h[6] == h[7] and len(set(h.tolist())) == 5
    low, _ = word_hashes(np.frombuffer(data, np.uint8), offsets, lower=True)
    assert low[4] == low[0]
    assert [len(s) for s in shingle_sets(np.frombuffer(data, np.uint8), offsets, 5)] == [1, 0, 1, 1, 0, 1]


def test_connected_components(spark):
    r = random.Random(4)
    edges = [(r.randrange(200), r.randrange(200)) for _ in range(120)] + [(i, i + 1) for i in range(300, 340)] + [(7, 7)]
    got = dict(map(tuple, components(spark.createDataFrame(edges, "a long, b long")).collect()))
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        x, y = sorted((find(a), find(b)))
        parent[y] = x
    assert got == {x: find(x) for x in list(parent) if find(x) != x}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("percent", [50, 80, 95, 100])
def test_sizes_that_may_link_are_in_neighbouring_bands(percent):
    n = np.arange(1, 1_000_001)
    band = size_band(n, percent)
    largest = 100 * n // percent  # the largest set that may link with one of n
    assert (np.diff(band) >= 0).all()
    assert (size_band(largest, percent) - band <= 1).all()


def test_components_against_sql(spark, sql_rows):
    """The query's SQL on texts whose similarities lie around the limit, with chains, copies and odd texts."""
    r = random.Random(9)
    texts = [None, "", " \n", "one", "One", "a b c d", "a b c d e", "A b\x0bc d e", "é é é é é é é"]
    for _ in range(12):
        words = [r.choice("abcdefghijklmnop") + r.choice("xyz") for _ in range(r.choice([6, 30, 60]))]
        for _ in range(8):
            texts.append(" ".join(words))
            at = r.randrange(len(words))
            words = words[:at] + r.choices("uvw", k=r.randint(0, 3)) + words[at + r.randint(0, 3):]
    frame = pd.DataFrame({"doc_id": r.sample(range(1000), len(texts)), "text": texts})
    docs = spark.createDataFrame(list(frame.itertuples(index=False, name=None)), "doc_id long, text string")
    want = sql_rows(OP7_SQL, documents=frame)
    got = near_duplicates(docs).select("doc_id", "n_shingles", "component_id").collect()
    assert sorted(map(tuple, got)) == sorted(want.itertuples(index=False, name=None))
    assert (want["doc_id"] != want["component_id"]).sum() > 20


def test_a_contraction_shuffles_once_and_settles_at_once(spark):
    """Check of the number of shuffles: each has a task for every partition, however few links there are."""
    conf = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in conf}
    links = spark.createDataFrame([(5, 1), (5, 3), (7, 5)], "a long, b long")
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        for large in (True, False):
            star = _star(links, large)
            plan = star._jdf.queryExecution().executedPlan().toString()
            assert len(re.findall(r"Exchange hashpartitioning", plan)) - plan.count("ReusedExchange") == 1, plan
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert not _settled(links)
    assert _settled(spark.createDataFrame([(5, 1), (3, 1), (9, 2)], "a long, b long"))
    assert not _settled(spark.createDataFrame([(5, 1), (5, 2)], "a long, b long"))
    assert _settled(links.limit(0))
