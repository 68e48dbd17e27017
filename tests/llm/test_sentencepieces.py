import random

import numpy as np
import public_tokenizers
import pytest
from sentencepiece import SentencePieceProcessor
from sentencepiece import sentencepiece_model_pb2 as messages

from cohortkit.llm import sentencepieces as sps

BPE = public_tokenizers.path("piece_bpe_32k.model")
SPECIAL = ["", " ", "  a b ", "x\ny", "\ttab\r\n", "ﬁ é ½ \xa0z", "日本語のテキスト 漢字😀", "a" * 300, "ab" * 200 + " " * 40,
           "<s> </s> <0x41>", "representation includegraphics"]


def texts(seed, n=300):
    r = random.Random(seed)
    abc = "etaoin shrdluETAOIN_-=*/.,;:'\"(){}[]0123456789éèß漢😀\n\t  "
    return SPECIAL + ["".join(r.choices(abc, k=r.randint(1, 200))) for _ in range(n)]


@pytest.fixture(scope="module")
def unigram(tmp_path_factory):
    """The vocabulary as a unigram model with scores of its own."""
    model = messages.ModelProto()
    with open(BPE, "rb") as f:
        model.ParseFromString(f.read())
    model.trainer_spec.model_type = 1
    r = random.Random(5)
    for p in model.pieces:
        p.score = -r.randint(1, 1 << 12) / 64  # exact in single precision
    path = tmp_path_factory.mktemp("model") / "unigram.model"
    path.write_bytes(model.SerializeToString())
    return str(path)


def test_bpe_ids_equal_the_library():
    lib, vocabulary = SentencePieceProcessor(model_file=BPE), sps.Vocabulary.load(BPE)
    t = texts(1)
    ids = sps.Encoder(vocabulary).encode(t)
    assert [x.tolist() for x in ids] == lib.encode(t)
    decoder = sps.Decoder(vocabulary)
    assert [decoder.decode(x) for x in ids] == [lib.decode(x.tolist()) for x in ids] == t


def test_unigram_scores_equal_the_library(unigram):
    """Ties between paths may fall differently; their totals are equal."""
    lib, vocabulary = SentencePieceProcessor(model_file=unigram), sps.Vocabulary.load(unigram)
    encoder = sps.Encoder(vocabulary)
    assert vocabulary.kind == "unigram"
    same = 0
    for t, mine in zip(texts(2), encoder.encode(texts(2))):
        theirs = lib.encode(t)
        at = vocabulary.bytes_at
        cost = lambda ids: sum(vocabulary.scores[i] for i in ids if not at <= i < at + 256)
        assert cost(mine.tolist()) == pytest.approx(cost(theirs), abs=1e-3)
        same += mine.tolist() == theirs
    assert same > 0.9 * len(texts(2))


def test_viterbi_by_brute_force():
    r = np.random.default_rng(3)
    ids = r.integers(-1, 5, (40, 6, 3))
    for k in range(3):
        ids[:, 6 - k:, k] = -1
    scores = np.array([-1.0, -2.5, -3.25, -4.75, -0.5])
    starts = sps.boundaries(sps.viterbi(ids, scores, -9.0))

    def best(w, i):
        if i == 6:
            return 0.0
        options = []
        for k in range(min(3, 6 - i)):
            if ids[w, i, k] >= 0 or k == 0:
                options.append((scores[ids[w, i, k]] if ids[w, i, k] >= 0 else -9.0) + best(w, i + k + 1))
        return max(options)

    for w in range(40):
        at = np.flatnonzero(starts[w]).tolist() + [6]
        total = sum(scores[ids[w, a, b - a - 1]] if ids[w, a, b - a - 1] >= 0 else -9.0 for a, b in zip(at, at[1:]))
        assert total == best(w, 0)


def test_long_merge_equals_batched():
    vocabulary = sps.Vocabulary.load(BPE)
    for w in ["▁" + "abracadabra" * 5, "the" * 20, "-" * 50]:
        ids = vocabulary.find(sps.span_keys(sps.codes_of([w]), vocabulary.longest))
        assert (sps.merge_long(ids, vocabulary.scores) == sps.merge_order(ids, vocabulary.scores)).all()


def test_spark_round_trip(spark):
    rows = [(i, t, "k") for i, t in enumerate(texts(4, 20))] + [(900, None, "k"), (0, "", "k")]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    coded = sps.encode(df, BPE)
    assert coded.columns == ["doc_id", "ids"]
    back = sps.decode(coded, BPE)
    assert sorted(map(tuple, back.collect())) == sorted((i, t or "") for i, t, _ in rows)
    assert sps.encode(df.limit(0), BPE).count() == 0
    odd = spark.createDataFrame([(1, None), (2, [None, 300]), (3, [259 - 1])], "doc_id long, ids array<int>")
    assert sorted(map(tuple, sps.decode(odd, BPE).collect()))[0] == (1, "")
