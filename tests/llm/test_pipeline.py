"""The pipeline's stages on a small corpus, each against what its own input asks for."""

import random

import corpus_pipeline as cp

from test_ngram_join import brute as components_of
from test_quality_rules import brute as measures_of
from test_secrets import brute as secrets_of

from llm_fixtures import make_docs  # noqa: F401

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row string"


def corpus():
    r = random.Random(8)
    words = [f"{a}{b}" for a in ("ta", "ne", "sol", "mi", "ru") for b in ("", "n", "ra", "de", "s", "lo")]
    rows = []
    for i in range(300):
        lines = [" ".join(r.choices(words, k=r.randint(8, 20))) for _ in range(r.randint(2, 6))]
        if i % 4 == 0:
            lines.insert(1, "Shared by very many documents of this corpus")
        if i % 9 == 0:
            lines.append('the token = "%040x"' % r.getrandbits(160))
        rows.append("\n".join(lines))
    rows += [rows[5]] * 20 + [rows[7], rows[7] + " once"] + [None, "", "too few words", "again " * 40, "### " * 60 + "a b c"]
    return [(i, t, "en" if i % 3 else None, f"s{i % 4}", len(t or ""), "extra") for i, t in enumerate(rows)]


def test_stages(spark, tmp_path):
    docs = spark.createDataFrame(corpus(), SCHEMA)
    rows = {}
    for name, stage in cp.STAGES:
        path = str(tmp_path / name)
        stage(spark, docs, "").write.parquet(path)
        before, docs = docs, spark.read.parquet(path)
        rows[name] = docs.collect()
        if name != cp.STAGES[-1][0]:
            assert docs.columns == before.columns
            assert all(x["n_chars"] == len(x["text"] or "") for x in rows[name])
    texts = {name: {x["doc_id"]: x["text"] for x in rows[name]} for name, _ in cp.STAGES[:-1]}

    first = {i: t for i, t, *_ in corpus()}
    for i, t in first.items():
        n, _, _, _, again = measures_of(t)
        if n < 10 or 100 * again > 20 * n:
            assert i not in texts["quality_rules"]
    assert set(range(300)) <= set(texts["quality_rules"])

    shared = [t for t in texts["line_dedup"].values() if "Shared by" in t]
    assert len(shared) == 1
    group = [i for i, t in first.items() if t == first[5]]
    assert [i for i in group if i in texts["line_dedup"]] == [5]

    want = components_of(list(texts["line_dedup"].items()))
    assert set(texts["ngram_join"]) == set(want.values())
    assert all(texts["ngram_join"][i] == texts["line_dedup"][i] for i in texts["ngram_join"])

    assert set(texts["secret_scan"]) == set(texts["ngram_join"])
    for i, t in texts["secret_scan"].items():
        assert not secrets_of(t)
        if not secrets_of(texts["ngram_join"][i]):
            assert t == texts["ngram_join"][i]

    packed = {}
    for x in rows["packing"]:
        packed[x["doc_id"]] = packed.get(x["doc_id"], 0) + x["length"]
        assert x["doc_tokens"] >= x["length"]
    assert set(packed) == set(texts["secret_scan"])
    assert all(packed[x["doc_id"]] == x["doc_tokens"] for x in rows["packing"])


def test_empty_and_repeated(spark):
    docs = spark.createDataFrame(corpus(), SCHEMA).limit(0)
    for _, stage in cp.STAGES:
        assert stage(spark, docs, "").count() == 0
    one = "alpha beta gamma delta epsilon zeta eta theta iota kappa"
    docs = spark.createDataFrame([(1, one, None, None, 1, ""), (1, one, None, None, 1, ""), (None, one, None, None, 1, "")], SCHEMA)
    left = cp.drop_near_duplicates(spark, docs, "").collect()
    assert sorted(x["doc_id"] or 0 for x in left) == [0, 1]


def test_run(spark):
    from tests.conftest import SF_SMALL

    out = cp.run(spark, SF_SMALL)
    assert out.count() > 0 and out.columns[0] == "doc_id"


def test_repeated_ids_with_other_texts_stay(spark, make_docs):
    from corpus_pipeline import drop_near_duplicates
    one, two, three = (" ".join(f"{w}{i}" for i in range(60)) for w in "abc")
    rows = [(1, one), (1, two), (1, one + " more"), (2, two), (None, three), (None, three), (None, one), (3, ""), (3, None)]
    left = drop_near_duplicates(spark, make_docs(rows), "").collect()
    assert sorted(((r["doc_id"] or 0), r["text"] or "") for r in left) == sorted(
        [(1, one), (1, two), (0, three), (0, three), (0, one), (3, ""), (3, "")])


def test_a_stage_called_twice_keeps_its_first_result(spark, make_docs):
    from corpus_pipeline import drop_near_duplicates
    docs = make_docs([(i, " ".join(f"w{i}x{j}" for j in range(30))) for i in range(5)])
    first = drop_near_duplicates(spark, docs, "")
    second = drop_near_duplicates(spark, docs, "")
    assert first.count() == second.count() == 5
