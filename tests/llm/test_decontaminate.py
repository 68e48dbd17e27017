import hashlib
import random
import re

import pytest

from cohortkit.llm import queries
from cohortkit.llm.byte_words import ALNUM, word_pieces
from cohortkit.llm.decontaminate import WORD, decontaminate
from cohortkit.llm.suffix_automaton import SuffixAutomaton

from llm_fixtures import make_docs, sql_rows  # noqa: F401

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
ITEMS = "item_id long, text string"


def words_of(text):
    return WORDS.findall((text or "").translate(LOWER))


def brute(text, items, window=10):
    """Hit words and ids of the items, by comparing every window with every place."""
    words, hit, found = words_of(text), set(), set()
    for item, said in items:
        said = words_of(said)
        m = min(len(said), window)
        for i in range(len(said) - m + 1 if m else 0):
            for at in range(len(words) - m + 1):
                if words[at:at + m] == said[i:i + m]:
                    hit.update(range(at, at + m))
                    found |= set() if item is None else {str(item)}
    return len(words), hit, sorted(found)


def check(rows, docs, items, window=10):
    texts = dict(docs)
    assert len(rows) == len(docs)
    for r in rows:
        n, hit, found = brute(texts[r["doc_id"]], items, window)
        assert (r["n_words"], r["n_hit"], r["items"]) == (n, len(hit), found)
        assert r["contaminated"] == bool(hit)
        assert {w for s in r["spans"] for w in range(s["start"], s["end"])} == hit


def test_words_are_those_of_the_pattern():
    text = "Aé 9-x_Y\tÄÖ\x00z\x7fq٣   \U0001F600k"
    assert [w.decode() for p in word_pieces(text.encode(), ALNUM) for w in p] == words_of(text)
    assert [w.decode().translate(LOWER) for w in WORD.findall(text.encode())] == words_of(text)


def test_automaton_knows_every_substring():
    rnd = random.Random(5)
    sequences = [[rnd.randrange(3) for _ in range(rnd.randrange(12))] for _ in range(30)]
    automaton = SuffixAutomaton(sequences)
    parts = {tuple(s[a:b]) for s in sequences for a in range(len(s)) for b in range(a + 1, len(s) + 1)}
    stream, state, matched = [rnd.randrange(4) for _ in range(400)], 0, 0
    for i, symbol in enumerate(stream):
        state, matched = automaton.advance(state, matched, symbol)
        longest = max((n for n in range(1, 13) if tuple(stream[max(0, i + 1 - n):i + 1]) in parts and n <= i + 1), default=0)
        assert matched == longest
        assert matched == 0 or automaton.length[automaton.link[state]] < matched <= automaton.length[state]


@pytest.mark.parametrize("shard_words", [25, 200_000])
def test_hits_equal_brute_force(spark, make_docs, shard_words):
    rnd = random.Random(11)
    vocabulary = ["a", "b", "C", "Dé", "e9"]
    items = [(i, " ".join(rnd.choices(vocabulary, k=rnd.choice([0, 1, 3, 6, 8, 30])))) for i in range(12)]
    items += [(3, items[5][1]), (None, " ".join(rnd.choices(vocabulary, k=9))), (77, None), (78, "... --")]
    docs = []
    for i in range(40):
        words = rnd.choices(vocabulary + [f"free{j}" for j in range(12)], k=rnd.randrange(80))
        for _ in range(rnd.randrange(3)):
            at = rnd.randrange(len(words) + 1)
            words[at:at] = (items[rnd.randrange(12)][1] or "").upper().split()
        docs.append((i, rnd.choice([" ", ", ", "\n- "]).join(words)))
    docs += [(100, None), (101, ""), (102, " .,;")]
    rows = decontaminate(make_docs(docs), spark.createDataFrame(items, ITEMS), window=6, shard_words=shard_words).collect()
    check(rows, docs, items, 6)


def test_spans_leave_the_text(spark, make_docs):
    said = "one two three four five six seven eight nine ten eleven"
    docs = [(0, f"Before, {said.title()}; after."), (1, said), (2, f"x {said} {said} y"), (3, "ten words are not here")]
    items = spark.createDataFrame([(5, said)], ITEMS)
    rows = {r["doc_id"]: r for r in decontaminate(make_docs(docs), items).collect()}
    assert [rows[i]["text"] for i in range(4)] == ["Before, ; after.", "", "x  y", "ten words are not here"]
    assert [rows[i]["longest"] for i in range(4)] == [11, 11, 11, 0]
    assert [rows[i]["rejected"] for i in range(4)] == [True, True, True, False]
    assert not decontaminate(make_docs(docs), items, max_coverage=1.0).where("rejected").head(1)


def test_long_items_and_texts_are_read_in_pieces(spark, make_docs, monkeypatch):
    from cohortkit.llm import byte_words
    monkeypatch.setattr(byte_words, "PIECE", 100)
    words = [f"w{i}" for i in range(25_000)]
    docs = [(0, " ".join(words[9_000:21_000])), (1, "free " * 30 + " ".join(words[9_995:10_005]) + " free" * 30)]
    rows = {r["doc_id"]: r for r in decontaminate(make_docs(docs), spark.createDataFrame([(1, " ".join(words))], ITEMS),
                                                  columns=["doc_id"]).collect()}
    assert rows[0]["n_hit"] == rows[0]["n_words"] == 12_000 and rows[0]["items"] == ["1"]
    assert [tuple(s) for s in rows[1]["spans"]] == [(30, 40)]


def test_empty_tables_clashes_and_repeats(spark, make_docs):
    items = spark.createDataFrame([(1, "a b c")], ITEMS)
    none = make_docs([])
    assert decontaminate(none, items).count() == 0
    docs = spark.createDataFrame([(1, "a b c d", "mine", 3), (1, "a b c d", "mine", 3), (None, "b c a", None, None)],
                                 "doc_id long, text string, spans string, items int")
    out = decontaminate(docs, spark.createDataFrame([], ITEMS))
    assert out.columns == ["doc_id", "text", "n_words", "n_hit", "longest", "items", "spans", "contaminated", "rejected"]
    assert [r["n_hit"] for r in out.collect()] == [0, 0, 0]
    rows = decontaminate(docs, items).collect()
    assert sorted(r["n_hit"] for r in rows) == [0, 3, 3] and sorted(r["text"] for r in rows) == [" d", " d", "b c a"]


def test_query_and_sql_over_a_small_fixture(spark, sql_rows, tmp_path):
    rnd = random.Random(2)
    items = [(i, " ".join(rnd.choices("abcdef", k=rnd.choice([2, 9, 10, 25])))) for i in range(9)] + [(9, None), (10, "")]
    docs = [(i, " ".join(rnd.choices("abcdefghi", k=40)) + "; " + (items[i % 11][1] or "")) for i in range(60)] + [(60, None)]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, ITEMS).write.parquet(f"{tmp_path}/benchmark.parquet")
    out = queries.op11_decontamination(spark, str(tmp_path)).toPandas().sort_values("doc_id").reset_index(drop=True)
    import pandas as pd
    sql = sql_rows(queries.OP11_SQL, documents=pd.DataFrame(docs, columns=["doc_id", "text"]),
                   benchmark=pd.DataFrame(items, columns=["item_id", "text"])).sort_values("doc_id").reset_index(drop=True)
    assert out.equals(sql[out.columns].astype(out.dtypes))
    for r in out.itertuples():
        n, hit, found = brute(dict(docs)[r.doc_id], items)
        assert (r.n_words, r.n_hit, r.n_items) == (n, len(hit), len(found))
        assert r.items_sha256 == hashlib.sha256(",".join(found).encode()).hexdigest()
