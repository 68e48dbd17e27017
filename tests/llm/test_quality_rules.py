import random
import re

import numpy as np
import pandas as pd
import pytest

from cohortkit.llm.quality_rules import (
    chi2_quantile, closest, concentrate, DIM, FLOORS, least_determinant, measure, quality_rules, shortest_half)

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words by plain Python."""
    text = text or ""
    words = WORD.findall(text)
    places = {}
    for i in range(len(words) - 4):
        places.setdefault(tuple(words[i:i + 5]), []).append(i)
    covered = {i + k for v in places.values() if len(v) > 1 for i in v for k in range(5)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        dup += bool(WORD.search(line)) and line in seen
        seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered)


def odd_texts(seed, n=300):
    r = random.Random(seed)
    return ["", " ", "a", "\n\n\n", "a\na\n\na", "x " * 9, "x " * 10, "é😀 #$\x0b|", "a b c d e a b c d e", "a b c d e f\na b c d e g"] + \
        ["".join(r.choices(["one", "two", " ", " ", "\n", "\t", "#", "<", "é", "A", "3."], k=r.randint(1, 80))) for _ in range(n)]


def test_measures_by_brute_force():
    t = odd_texts(1)
    raw = "".join(t).encode()
    offsets = np.cumsum([0] + [len(x.encode()) for x in t])
    m = measure(np.frombuffer(raw, np.uint8), offsets)
    got = list(zip(*(m[k].tolist() for k in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"))))
    assert got == [brute(x) for x in t]


def prose(r, n):
    return " ".join(r.choice(["the", "of", "plain", "words", "stand", "here", "again", "Now", "and", "then,"]) +
                    r.choice(["", "", "", "ly", "ing"]) for _ in range(n)) + f" {r.random()}."


def test_outliers_per_group(spark):
    """Odd documents go, in every group and also where groups are pooled; plain ones stay."""
    r = random.Random(2)
    rows, bad = [], set()
    for i in range(1500):
        lang, source = ("en", "s0") if i % 3 == 0 else (r.choice(["en", "de", None]), f"s{r.randint(1, 40)}")
        text = prose(r, r.randint(30, 200))
        if i % 20 == 7:
            bad.add(i)
            text = r.choice(["$$$ ".join(text.split()), text.upper() + "!!", " | ".join(w + " " + w for w in text.split())])
        rows.append((i, text, lang, source, "k"))
    rows += [(2000, None, "en", "s0", "k"), (2001, "", None, None, "k"), (2002, "few words", "en", "s0", "k"),
             (2003, "same " * 50, "en", "s0", "k"), (0, rows[0][1], rows[0][2], rows[0][3], "k")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, kept string")
    out = quality_rules(df)
    assert out.columns[:4] == ["doc_id", "text", "lang", "source"] and out.columns[-1] == "kept"
    got = out.collect()
    assert len(got) == len(rows)
    for x in got:
        want = brute(x["text"])
        assert tuple(x[k] for k in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")) == want
        assert x["base_failed"] == (want[0] < 10 or 100 * want[4] > 20 * want[0])
        if x["base_failed"]:
            assert not x["kept"]
    passed = [x for x in got if not x["base_failed"]]
    kept = {x["doc_id"] for x in passed if x["kept"]}
    assert not kept & bad
    plain = {x["doc_id"] for x in passed} - bad
    assert len(plain - kept) <= 0.005 * len(plain)


def test_few_rows_and_empty_table(spark):
    df = spark.createDataFrame([(1, "ten words " * 1 + "a b c d e f g h i", "en", "s", 1), (2, None, None, None, None)],
                               "doc_id long, text string, lang string, source string, n_chars long")
    got = {x["doc_id"]: x for x in quality_rules(df).collect()}
    assert got[1]["kept"] and got[1]["distance"] is None and not got[2]["kept"]
    assert quality_rules(df.limit(0)).count() == 0


def vectors(texts):
    return np.vstack([measure(np.frombuffer(t.encode(), np.uint8), np.array([0, len(t.encode())]))["x"] for t in texts])


def direct(x, seed, tries=60):
    """Distances by the textbook: concentration from random small subsets, least determinant, one reweighting."""
    r, floor, best = np.random.default_rng(seed), np.diag(np.square(FLOORS)), None

    def fit(rows):
        return rows.mean(axis=0), np.cov(rows.T, bias=True) + floor

    def distances(mu, cov):
        return np.einsum("ij,jk,ik->i", x - mu, np.linalg.inv(cov), x - mu)

    for _ in range(tries):
        mu, cov = fit(x[r.choice(len(x), 8, replace=False)])
        for _ in range(60):
            mu, cov = fit(x[np.argsort(distances(mu, cov))[:len(x) // 2]])
        if best is None or np.linalg.slogdet(cov)[1] < best[0]:
            best = np.linalg.slogdet(cov)[1], mu, cov
    d = distances(*best[1:])
    d = distances(*fit(x[d <= np.median(d) / chi2_quantile(0.5) * chi2_quantile(0.975)]))
    return best[0], d * chi2_quantile(0.5) / np.median(d)


@pytest.mark.parametrize("junk", [0.0, 0.4])
def test_estimate_agrees_with_a_direct_one(spark, junk):
    """The least determinant and the distances against a direct estimate on the vectors, also
    where two fifths of a source are junk: that goes, prose stays."""
    r = random.Random(5)
    rows, bad = [], set()
    for i in range(600):
        text = prose(r, r.randint(40, 120))
        if r.random() < junk:
            bad.add(i)
            text = " ".join(w + r.choice(["$$$", "%%%", "|"]) for w in text.upper().split())
        rows.append((i, text, "en", "s", 0))
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = {x["doc_id"]: x for x in quality_rules(df, columns=["doc_id"]).collect()}
    assert not any(x["base_failed"] for x in got.values())
    x = vectors([t for _, t, *_ in rows])
    logdet, d = direct(x, 1)
    pooled = spark.createDataFrame([("p", v.tolist()) for v in x], "pool string, x array<double>")
    best = least_determinant(pooled, 0.5, 40, 1e-3).collect()
    assert len(best) == 1
    mine = np.linalg.slogdet(np.array(best[0]["inv"]).reshape(DIM, DIM))[1]
    assert -mine == pytest.approx(logdet, abs=0.15)
    mine = np.array([got[i]["distance"] for i in range(600)])
    good = np.array([i not in bad for i in range(600)])
    assert np.corrcoef(np.log(d[good]), np.log(mine[good]))[0, 1] > 0.98
    assert np.median(mine[good]) == pytest.approx(np.median(d[good]), rel=0.15)
    assert {i for i in got if not got[i]["kept"]} == bad


def test_many_groups_meet_by_salt(spark):
    """The same distances whether estimates are broadcast or shuffled."""
    r = random.Random(8)
    rows = [(i, prose(r, 50), "en", f"s{i % 3}", None) for i in range(360)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    a, b = ({x["doc_id"]: x["distance"] for x in quality_rules(df, columns=["doc_id"], few=few).collect()} for few in (0, 10))
    assert len(a) == 360 and all(a[i] == pytest.approx(b[i], rel=1e-9) for i in a)


def test_a_step_never_raises_the_determinant():
    """From any start, also with rows that tie."""
    r = np.random.default_rng(3)
    x = np.vstack([r.normal(size=(300, DIM)) * 0.2, np.repeat(r.normal(size=(20, DIM)), 10, axis=0)])
    for seed in range(5):
        pick = np.random.default_rng(seed).choice(len(x), 12)
        mu, cov, last = x[pick].mean(axis=0), np.cov(x[pick].T) + np.diag(np.square(FLOORS)), np.inf
        for _ in range(12):
            d = np.einsum("ij,jk,ik->i", x - mu, np.linalg.inv(cov), x - mu)
            place = np.floor(np.log2(np.maximum(d, 1e-9)) * 16).astype(int)
            bins = pd.DataFrame([{"bin": b, "n": int((place == b).sum()), "sums": x[place == b].sum(axis=0),
                                  "products": (x[place == b].T @ x[place == b])[np.triu_indices(DIM)]}
                                 for b in sorted(set(place))])
            out = concentrate(0.5)(("p", 0), bins).iloc[0]
            # within a bin rows count alike, so equal up to the width of one bin
            assert out["logdet"] <= last + 0.05
            mu, cov, last = np.array(out["mu"]), np.linalg.inv(np.array(out["inv"]).reshape(DIM, DIM)), out["logdet"]


def test_closest_takes_exactly_so_many_rows():
    n = np.array([3, 1, 4, 2])
    assert closest(n, 5).tolist() == [1, 1, 0.25, 0] and closest(n, 10).tolist() == [1, 1, 1, 1]
    assert (closest(n, 0.5) * n).sum() == 0.5
    assert shortest_half(np.array([0.0, 1.0, 5.0, 5.1, 5.2])) == (5.1, pytest.approx(0.2))


@pytest.mark.parametrize("size", [99, 101])
def test_small_sources_are_judged_too(spark, size):
    """A source below or above ``min_rows``, in a language below it or not: every row that passes
    the base rules has a distance, and junk goes."""
    r = random.Random(size)
    rows = [(i, prose(r, 60), "en", "large", None) for i in range(300)]
    rows += [(1000 + i, prose(r, 60), r.choice(["en", "xx"]), "small", None) for i in range(size)]
    rows += [(5000 + i, " ".join(w + "$$$" for w in prose(r, 60).upper().split()), "xx", "small", None) for i in range(5)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = {x["doc_id"]: x for x in quality_rules(df, columns=["doc_id"]).collect()}
    assert len(got) == len(rows)
    assert {i for i, x in got.items() if x["distance"] is None} == {i for i, t, *_ in rows if brute(t)[4] * 5 > brute(t)[0]}
    assert {i for i, x in got.items() if not x["kept"]} == {5000 + i for i in range(5)}


def test_chi2_quantile():
    # tabulated for six degrees of freedom
    assert chi2_quantile(0.5, 6) == pytest.approx(5.348, rel=0.01)
    assert chi2_quantile(0.99, 6) == pytest.approx(16.812, rel=0.01)
