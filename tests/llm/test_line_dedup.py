import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortkit.llm.line_dedup import BloomPair, bit_places, line_dedup, merge, salted_join

from llm_fixtures import make_docs, sql_rows  # noqa: F401


def brute(rows, min_docs, keep, min_chars=1):
    """{(id, text): (n_lines, n_dropped, kept)} by plain Python."""
    key = lambda line: "".join(c.lower() if c.isascii() else c for c in line.strip(" \t\n\x0b\x0c\r"))
    docs = {}
    for i, text in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= min_chars:
                docs.setdefault(key(line), set()).add(i)
    out = {}
    for i, text in rows:
        lines, kept, used = (text or "").split("\n"), [], set()
        for line in lines:
            k = key(line)
            shared = len(docs.get(k, ())) >= min_docs
            first = shared and keep == "first" and k not in used and i == min(docs[k], key=lambda x: (x is None, x))
            if not shared or first:
                kept.append(line)
                used.add(k)
        out[i, text] = len(lines), len(lines) - len(kept), "\n".join(kept)
    return out


def random_rows(seed, n=60):
    r = random.Random(seed)
    lines = [f"Line {i % 7}" + " x" * (i % 3) for i in range(25)] + ["", " ", "\tline 3", "LINE 4 ", "É", "é"]
    return [(i, "\n".join(r.choices(lines, k=r.randint(0, 9)))) for i in range(n)]


@pytest.mark.parametrize("keep", ["none", "first"])
def test_against_brute_force(make_docs, keep):
    rows = random_rows(1) + [(100, None), (101, ""), (102, "only here\nLine 1\nLine 1"), (103, "a\r\n A \nb")]
    rows += [(5, "a repeated id\nLine 2"), (102, "only here\nLine 1\nLine 1")]
    got = line_dedup(make_docs(rows), min_docs=3, keep=keep, bloom_bits=1 << 12).collect()
    want = brute(rows, 3, keep)
    assert len(got) == len(rows)
    texts = {}
    for i, text in rows:
        texts.setdefault(i, []).append(want[i, text])
    for r in got:
        assert (r["n_lines"], r["n_dropped"], r["text"]) in texts[r["doc_id"]]


def test_small_filter_changes_nothing(make_docs):
    rows = random_rows(2)
    many, few = (sorted(line_dedup(make_docs(rows), min_docs=2, keep="none", bloom_bits=b).select("doc_id", "text").collect())
                 for b in (1 << 16, 64))
    assert many == few


def test_hot_line_and_long_text(make_docs):
    rows = [(i, f"own {i}\nthe same in all") for i in range(300)] + [(999, "\n".join(f"l{i}" for i in range(20000)))]
    got = {r["doc_id"]: r for r in line_dedup(make_docs(rows), min_docs=10, keep="none").collect()}
    assert all(got[i]["text"] == f"own {i}" and got[i]["n_dropped"] == 1 for i in range(300))
    assert got[999]["n_lines"] == 20000 and got[999]["n_dropped"] == 0


def test_clashing_columns_null_ids_and_empty_table(spark):
    df = spark.createDataFrame([(None, "a\nb", 1, "k"), (None, "a", 2, "k"), (3, "a\nc", 3, "k")],
                               "doc_id long, text string, n_lines int, key string")
    out = line_dedup(df, min_docs=2, keep="none")
    assert out.columns == ["doc_id", "text", "key", "n_lines", "n_dropped"]
    assert sorted(r["text"] for r in out.collect()) == ["", "b", "c"]
    assert line_dedup(df.limit(0), min_docs=2).count() == 0


def test_merged_filters_miss_nothing():
    r = np.random.default_rng(0)
    a, b = r.integers(0, 1 << 63, 200, dtype=np.uint64), r.integers(0, 1 << 63, 200, dtype=np.uint64)
    b[:20] = a[:20]
    pairs = [BloomPair(1 << 12, 3), BloomPair(1 << 12, 3)]
    pairs[0].add(a), pairs[1].add(b)
    _, twice = merge(*[(p.once, p.twice) for p in pairs])
    assert twice[bit_places(a[:20], 1 << 12, 3)].all()


def test_sql_agrees(spark, make_docs, sql_rows):
    from cohortkit.llm.queries import OP2_SQL

    docs = make_docs([(i, t) for i, t in random_rows(3)])
    got = line_dedup(docs, min_docs=10, keep="none").toPandas()
    want = sql_rows(OP2_SQL, documents=docs.toPandas()).set_index("doc_id")
    for r in got.itertuples():
        w = want.loc[r.doc_id]
        assert (r.n_lines, r.n_dropped) == (w.n_lines, w.n_dropped)
        assert hashlib.sha256(r.text.encode()).hexdigest() == w.kept_sha256


def test_a_hot_line_is_dealt_under_salts(spark):
    """Nothing is lost or multiplied, the parts are even, and there are few hot keys."""
    n = 3000
    rows = [(f"k{i % 700}" if i % 3 else "hot", i, 1) for i in range(n)] + [("hot", None, 1)]
    pairs = spark.createDataFrame(rows, "key string, id long, n long").repartition(5)
    counts = pairs.groupBy("key").agg(F.count(F.lit(1)).alias("docs"), F.min("id").alias("first"))
    confirmed = counts.where("docs >= 2")
    out = salted_join(pairs, confirmed, 50)
    want = pairs.join(confirmed, "key").select("key", "id", "first")
    got = out.select("key", "id", "first")
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
    parts = [r["n"] for r in out.where("key = 'hot'").groupBy("salt").agg(F.count(F.lit(1)).alias("n")).collect()]
    assert len(parts) == 21 and max(parts) < 100
    assert out.where("key != 'hot'").select("salt").distinct().count() == 1
    assert salted_join(pairs.limit(0), confirmed.limit(0), 50).count() == 0


def test_salts_change_no_result(spark, make_docs):
    rows = [(i, f"shared by all\nline {i}\nline {i % 40}\n{'third' if i % 3 == 0 else i}") for i in range(300)]
    rows += [(5, rows[5][1]), (None, "shared by all\nline 7"), (900, None)]
    docs = make_docs(rows)
    for keep in ("first", "none"):
        a, b = (line_dedup(docs, keep=keep, salt_docs=s).select("doc_id", "text", "n_lines", "n_dropped") for s in (7, 10**6))
        assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()
