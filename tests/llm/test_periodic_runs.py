import hashlib
import random
import zlib

import numpy as np
import pytest

from cohortkit.llm import queries
from cohortkit.llm.periodic_runs import collapse_runs, periodic_runs

from llm_fixtures import make_docs  # noqa: F401


def brute(words, min_length=24, min_periods=3):
    """All maximal runs with their smallest period, period by period."""
    n, smallest = len(words), {}
    for q in range(1, n // min_periods + 1):
        start = 0
        while start + q < n:
            end = start + q
            while end < n and words[end] == words[end - q]:
                end += 1
            if end - start >= max(min_length, min_periods * q):
                smallest.setdefault((start, end), q)
            start = max(end - q + 1, start + 1)
    return sorted((s, e - s, q) for (s, e), q in smallest.items())


def collapsed(words, runs):
    dropped = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in dropped)


def ids(texts):
    words = sorted({w for t in texts for w in t})
    at = np.cumsum([0] + [len(t) for t in texts])
    return np.array([words.index(w) for t in texts for w in t], np.int64), at


@pytest.mark.parametrize("seed", range(4))
def test_runs_equal_brute_force(seed):
    rnd = random.Random(seed)
    texts = []
    for _ in range(60):
        text = rnd.choices("abc"[:rnd.choice([1, 2, 2, 3])], k=rnd.randrange(40))
        for _ in range(rnd.randrange(4)):
            part = rnd.choices("abcdefgh", k=rnd.randrange(1, 12))
            text += (part * 9)[:rnd.randrange(1, 9 * len(part))]
            text += rnd.choices("abcd", k=rnd.randrange(3))
        texts.append(text)
    for least, times in ((24, 3), (3, 3), (6, 4)):
        found = list(zip(*(x.tolist() for x in periodic_runs(*ids(texts), least, times))))
        at = ids(texts)[1]
        wanted = [(s + int(a), n, q) for a, t in zip(at, texts) for s, n, q in brute(t, least, times)]
        assert found == wanted


@pytest.mark.parametrize("seed", range(4))
def test_long_periods_equal_brute_force(seed):
    rnd = random.Random(seed)
    texts = []
    for n in (50, 700, 300):
        part = rnd.choices("ab" if seed % 2 else "abcdefghijklmnop", k=n)
        text = rnd.choices("ab", k=30) + (part * 4)[:rnd.randrange(3 * n, 4 * n)] + rnd.choices("ab", k=30)
        texts.append(text)
    found = list(zip(*(x.tolist() for x in periodic_runs(*ids(texts)))))
    at = ids(texts)[1]
    assert found == [(s + int(a), n, q) for a, t in zip(at, texts) for s, n, q in brute(t)]


def test_fibonacci_word_and_one_letter():
    a, b = "a", "ab"
    while len(b) < 400:
        a, b = b, b + a
    for text in (b, "x" * 1000, "xy" * 13, "x" * 23, "x" * 24):
        assert list(zip(*(x.tolist() for x in periodic_runs(*ids([list(text)]))))) == brute(list(text))


def test_runs_stay_within_their_text():
    texts = [["a", "b"] * 11, ["a", "b"] * 11, [], ["a", "b"] * 12]
    assert [x.tolist() for x in periodic_runs(*ids(texts))] == [[44], [24], [2]]


def test_fewer_periods_are_refused():
    with pytest.raises(ValueError):
        periodic_runs(*ids([["a"]]), 24, 2)


def test_collapse_texts(spark, make_docs, monkeypatch):
    from cohortkit.llm import byte_words
    monkeypatch.setattr(byte_words, "PIECE", 64)
    said = " ".join(["stop it now"] * 10)
    rows = [(1, f"before\t {said}\x0bafter   é"), (2, "plain  text\n"), (3, None), (4, ""), (5, " \n"), (2, "plain  text\n"),
            (6, " ".join(f"w{i % 5000}" for i in range(20_000)))]
    out = collapse_runs(make_docs(rows)).collect()
    by_id = {r["doc_id"]: r for r in out}
    assert by_id[1]["collapsed"] == "before stop it now after   é"
    assert [tuple(x) for x in by_id[1]["runs"]] == [(1, 30, 3)]
    assert [by_id[i]["collapsed"] for i in (2, 3, 4, 5)] == ["plain text", "", "", ""]
    assert [by_id[i]["n_words"] for i in (2, 3, 4, 5, 6)] == [2, 0, 0, 0, 20_000]
    assert [tuple(x) for x in by_id[6]["runs"]] == [(0, 20_000, 5_000)]
    assert by_id[6]["collapsed"].count(" ") == 4_999
    assert len(out) == 7
    assert collapse_runs(make_docs([])).count() == 0
    clash = spark.createDataFrame([(1, said, "x")], "doc_id long, text string, runs string")
    assert collapse_runs(clash).columns == ["doc_id", "text", "n_words", "runs", "collapsed"]


def test_many_periodic_texts_in_little_time():
    # 2**19 words that repeat with a long period: about one sort per level
    text = np.tile(np.random.default_rng(1).integers(0, 50, 1 << 15), 16)
    assert [x.tolist() for x in periodic_runs(text, np.array([0, len(text)]))] == [[0], [1 << 19], [1 << 15]]


def test_query_equals_brute_force_on_all_documents(spark):
    sf = "/root/testdata/sf0.001"
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = queries.op13_periodic_runs(spark, sf).collect()
    assert len(rows) == len(docs)
    periodic = 0
    for r in rows:
        words = (docs[r["doc_id"]] or "").encode().split()
        words = [w.decode() for w in words]
        h = zlib.crc32(str(r["doc_id"]).encode())
        if h % 10 == 0 and words:
            g, n = h // 10, len(words)
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
        if len(words) > 6000:  # brute force is quadratic; the few longer ones are checked by their digests' form only
            continue
        runs = brute(words)
        periodic += bool(runs)
        assert r["n_runs"] == len(runs)
        told = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
        assert r["runs_sha256"] == hashlib.sha256(told.encode()).hexdigest()
        assert r["collapsed_sha256"] == hashlib.sha256(collapsed(words, runs).encode()).hexdigest()
        if runs:
            from fractions import Fraction
            best = min(runs, key=lambda x: (-Fraction(x[1], x[2]), x[0], x[2]))
            assert (r["start"], r["length"], r["period"]) == best and r["exponent_milli"] == 1000 * best[1] // best[2]
        else:
            assert r["start"] is None and r["exponent_milli"] is None
    assert periodic > 5
