import random
import zlib

import numpy as np
import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from cohortkit.llm.packing import WordIds, encode_texts, pack, pack_lengths, sequence_sizes

from llm_fixtures import make_docs  # noqa: F401

PATH = public_tokenizers.path("word_bpe_49k.json")


def library():
    t = Tokenizer.from_file(PATH)
    t.encode_special_tokens = True
    return t


def odd_texts(seed, n=200):
    r = random.Random(seed)
    abc = "etaoin shrdluETAOIN'_-=*/.,;:!?\"(){}0123456789éÈßÿµª漢😀İΣ́\n\t\x0b\x1c\x1f\x85\xa0 "
    return ["", " ", "it's we'll o'the 'S x.", "a<|endoftext|>b <|startoftext|>", "a" * 500, "É.,! é"] + \
        ["".join(r.choices(abc, k=r.randint(1, 120))) for _ in range(n)]


def test_ids_equal_whole_text_encoding():
    lib, t = library(), odd_texts(1)
    ids = WordIds(PATH, limit=300)
    for i in range(0, len(t), 40):  # forgets on the way
        for text, got in zip(t[i:i + 40], encode_texts(t[i:i + 40], ids)):
            assert got.tolist() == lib.encode(text, add_special_tokens=False).ids, text


def test_sequences_are_full_and_balanced():
    r = random.Random(2)
    for size in (8, 2048):
        lengths = [r.randint(1, size) for _ in range(200)] + [size] * 5 + [0]
        done = pack_lengths(lengths, size, 1.0, 1.0 / size)
        room = sequence_sizes(sum(lengths), size)
        for i, n in enumerate(lengths):
            parts = sorted((a, k) for j, a, k, *_ in done if j == i)
            assert sum(k for _, k in parts) == n
            assert all(a + k == b for (a, k), (b, _) in zip(parts, parts[1:]))
        for s, n in enumerate(room):
            parts = sorted((o, k) for *_, k, q, o in done if q == s)
            assert sum(k for _, k in parts) == n and parts[0][0] == 0
            assert all(o + k == p for (o, k), (p, _) in zip(parts, parts[1:]))
        assert all(n == size or n & (n - 1) == 0 for n in room)
    cost = {}
    for _, _, k, s, _ in pack_lengths([100] * 400, 2048, 1.0, 1.0 / 2048):
        cost[s] = cost.get(s, 0) + k + k * k / 2048
    full = [cost[s] for s in range(100 * 400 // 2048)]
    assert max(full) < 1.05 * min(full)
    assert pack_lengths([], 8, 1, 1) == []


def test_pack(spark):
    lib = library()
    rows = [(i, t, i) for i, t in enumerate(odd_texts(3, 40))] + [(500, None, 0), (1, " ", 1), (600, "word " * 9000, 6),
                                                                 (None, "no id", 0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, start long")
    out = pack(df, PATH, size=256, shard_docs=16).withColumn("crc", F.crc32("ids")).collect()
    assert set(out[0].asDict()) == {"doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset",
                                    "sequence_tokens", "crc"}
    by_doc, by_sequence = {}, {}
    for r in out:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_sequence.setdefault(r["sequence_id"], []).append(r)
    for i, text, _ in rows:
        want = np.array(lib.encode(text or "", add_special_tokens=False).ids + [1], "<u4")
        mine = sorted(by_doc[i], key=lambda r: r["start"])
        if i == 1:  # the id of two rows
            assert sum(r["length"] for r in mine) == 2 * len(want)
            continue
        assert np.array_equal(np.concatenate([np.frombuffer(r["ids"], "<u4") for r in mine]), want)
        assert all(r["doc_tokens"] == len(want) and r["crc"] == zlib.crc32(r["ids"]) for r in mine)
    for parts in by_sequence.values():
        parts.sort(key=lambda r: r["offset"])
        total = sum(r["length"] for r in parts)
        assert total == parts[0]["sequence_tokens"] <= 256 and total & (total - 1) == 0
        assert [r["offset"] for r in parts] == np.cumsum([0] + [r["length"] for r in parts[:-1]]).tolist()
    assert pack(df.limit(0), PATH).count() == 0


def test_few_long_documents_are_spread(spark, make_docs):
    rows = [(i, " ".join(["word"] * 40_000)) for i in range(6)]
    out = pack(make_docs(rows), public_tokenizers.path("word_bpe_49k.json"), shard_bytes=1 << 18)
    shards = [r[0] for r in out.select((F.col("sequence_id") / (1 << 32)).cast("long")).distinct().collect()]
    assert len(shards) >= 4
    assert out.agg(F.sum("length")).first()[0] == out.select("doc_id", "doc_tokens").distinct().agg(F.sum("doc_tokens")).first()[0]


def test_a_word_is_encoded_once_whatever_its_case():
    ids = WordIds(PATH)
    texts = ["Word word WORD, word! straße Straße", "wORD ' it's <|ENDOFTEXT|> <|endoftext|> İ é É ª µ", "ÉTÉ été."]
    got = [a.tobytes() for a in encode_texts(texts, ids)]
    assert got == [ids.whole(t) for t in texts]
    ascii_only = WordIds(PATH)
    encode_texts(["Word word WORD wOrd, WORD,"], ascii_only)
    assert set(ascii_only) == {"word", "word,", ","}
