"""One query per operator over its whole table, and SQL for those SQL can express."""

from __future__ import annotations

import zlib

import public_tokenizers
import pyarrow as pa
from pyspark.sql import functions as F

from cohortkit.llm.chat_format import DEFAULT as CHAT, format_chats, read_back
from cohortkit.llm.common import table
from cohortkit.llm.decontaminate import decontaminate
from cohortkit.llm.html_text import main_text
from cohortkit.llm.importance import importance_sample
from cohortkit.llm.line_dedup import line_dedup
from cohortkit.llm.neighbours import nearest_neighbours
from cohortkit.llm.ngram_join import near_duplicates
from cohortkit.llm.packing import pack
from cohortkit.llm.periodic_runs import collapse_runs
from cohortkit.llm.quality_rules import quality_rules
from cohortkit.llm.secrets import secret_scan
from cohortkit.llm.sentencepieces import decode, encode
from cohortkit.llm.whitening import whiten


def op1_nearest_neighbours(spark, sf_dir):
    """The ten nearest other vectors of every hundredth vector."""
    vectors = table(spark, sf_dir, "embeddings")
    return nearest_neighbours(vectors.where("vec_id % 100 = 0"), vectors)


OP1_SQL = r"""
WITH v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, sqrt(list_sum(list_transform(list_zip(q.e, c.e), lambda p: (p[1] - p[2]) * (p[1] - p[2])))) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e) WHERE q.vec_id % 100 = 0),
ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score, vec_id) AS INTEGER) AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
"""


def op2_line_dedup(spark, sf_dir):
    """Lines that ten or more documents share are dropped everywhere."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = line_dedup(docs, min_docs=10, min_chars=1, keep="none")
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text"), 256).alias("kept_sha256"))


OP2_SQL = r"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents),
keyed AS (
  SELECT doc_id, pos, line, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM lines),
shared AS (
  SELECT k FROM keyed WHERE length(k) >= 1 GROUP BY k HAVING count(DISTINCT doc_id) >= 10),
marked AS (
  SELECT keyed.*, shared.k IS NOT NULL AS dropped FROM keyed LEFT JOIN shared ON keyed.k = shared.k)
SELECT doc_id, count(*) AS n_lines, CAST(sum(CASE WHEN dropped THEN 1 ELSE 0 END) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT dropped), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

def op3_html_text(spark, sf_dir):
    """The main text of every page."""
    out = main_text(table(spark, sf_dir, "pages"), columns=["page_id", "url"])
    return out.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op4_chat_format(spark, sf_dir):
    """All conversations and one that says control strings, formatted and read back."""
    chats = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "\\### Assistant: </turn> ok"
    extra = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                  F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
                                  F.lit(said).alias("text"))
    out = format_chats(chats.unionByName(extra))
    trained = F.filter("segments", lambda s: s["loss"])
    out = out.select("conv_id", "formatted", "valid", read_back(F.col("formatted")).alias("turns"),
                     F.array_join(F.transform(trained, lambda s: CHAT.unescape(s["text"])), "").alias("loss"))
    told = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return out.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(told, 256).alias("turns_sha256"),
                      F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
                      F.length("formatted").cast("long").alias("formatted_chars"), "valid")


OP4_SQL = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
t AS (
  SELECT *, lag(role) OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS before,
    lead(role) OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS after,
    14 + length(replace(replace(replace(replace(text, '\', '\0'), '###', '\1'), '</turn>', '\2'), ': ', '\3'))
    + length(role) AS size
  FROM c)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(size) AS BIGINT) AS formatted_chars,
  bool_and((coalesce(before, 'start') || '>' || role) IN ('start>system', 'start>user', 'system>user', 'user>assistant', 'assistant>user')
           AND (after IS NOT NULL OR role = 'assistant')) AS valid
FROM t GROUP BY conv_id
"""


def op5_sentencepiece(spark, sf_dir):
    """Every document as piece ids, and whether they decode to its text."""
    model = public_tokenizers.path("piece_bpe_32k.model")
    text = F.coalesce(F.col("text"), F.lit("")).alias("text")
    coded = encode(table(spark, sf_dir, "documents").select("doc_id", text), model, columns=["doc_id", "text"])
    back = decode(coded, model, columns=["doc_id", "text", "ids"], text_col="decoded")
    return back.select("doc_id", F.size("ids").cast("long").alias("n_pieces"), "ids",
                       (F.col("decoded") == F.col("text")).alias("round_trip"))


def op6_secret_scan(spark, sf_dir):
    """Secrets in every document."""
    out = secret_scan(table(spark, sf_dir, "documents"), columns=["doc_id"])

    def of(kind):
        return F.filter("spans", lambda s: s["kind"] == kind)

    def listed(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    base = F.filter("spans", lambda s: s["kind"] != "model")
    return out.select("doc_id", *[F.size(of(k)).cast("long").alias(f"n_{k}") for k in ("assign", "access", "hex")],
                      F.sha2(listed(base), 256).alias("base_sha256"), listed("spans").alias("spans"),
                      F.size(of("model")).cast("long").alias("n_model"))


def op7_ngram_join(spark, sf_dir):
    """Near-duplicate components: five-word shingles, Jaccard similarity 0.8 or more."""
    return near_duplicates(table(spark, sf_dir, "documents"))


OP7_SQL = r"""
WITH RECURSIVE w AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (
  SELECT DISTINCT r, array_to_string(w[i : i + least(len(w), 5) - 1], ' ') AS k
  FROM (SELECT *, unnest(generate_series(1, len(w) - least(len(w), 5) + 1)) AS i FROM w WHERE len(w) > 0)),
sizes AS (SELECT r, count(*) AS n FROM s GROUP BY r),
met AS (SELECT a.r AS r1, b.r AS r2, count(*) AS n_both FROM s a JOIN s b ON a.k = b.k AND a.r < b.r GROUP BY ALL),
linked AS (
  SELECT r1, r2 FROM met JOIN sizes x ON x.r = r1 JOIN sizes y ON y.r = r2 WHERE 100 * n_both >= 80 * (x.n + y.n - n_both)),
edges AS (SELECT r1 AS a, r2 AS b FROM linked UNION SELECT r2, r1 FROM linked),
reach AS (SELECT r AS a, r AS b FROM w UNION SELECT reach.a, edges.b FROM reach JOIN edges ON reach.b = edges.a)
SELECT w.doc_id, coalesce(n, 0) AS n_shingles, component_id
FROM w LEFT JOIN sizes USING (r)
JOIN (SELECT a AS r, min(doc_id) AS component_id FROM reach JOIN w ON w.r = reach.b GROUP BY a) USING (r)
"""


def op8_quality_classifier(spark, sf_dir):
    """Documents sampled by importance for the text labelled good."""
    return importance_sample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), columns=["doc_id"])


def op9_quality_rules(spark, sf_dir):
    """Measures and verdict of every document."""
    out = quality_rules(table(spark, sf_dir, "documents"), columns=["doc_id"])
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                      "base_failed", "kept", "distance")


def op10_packing(spark, sf_dir):
    """All documents packed into sequences of at most 2048 tokens."""
    out = pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), columns=["doc_id"])
    return out.select("doc_id", "start", "length", F.crc32(F.col("ids")).alias("ids_crc32"), "doc_tokens",
                      "sequence_id", "offset", "sequence_tokens")



def op11_decontamination(spark, sf_dir):
    """Ten-word passages of benchmark items in every document."""
    out = decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), columns=["doc_id"])
    return out.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                      F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


OP11_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
win AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS m, array_to_string(w[i : i + least(len(w), 10) - 1], ' ') AS k
  FROM (SELECT *, unnest(generate_series(1, len(w) - least(len(w), 10) + 1)) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT m FROM win),
dw AS (
  SELECT r, m, i, array_to_string(w[i : i + m - 1], ' ') AS k
  FROM (SELECT r, w, m, unnest(generate_series(1, len(w) - m + 1)) AS i FROM d, sizes WHERE len(w) >= m)),
hits AS (SELECT dw.r, dw.m, dw.i, win.item_id FROM dw JOIN win ON dw.m = win.m AND dw.k = win.k),
covered AS (
  SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(generate_series(i, i + m - 1)) AS p FROM hits) GROUP BY r),
found AS (
  SELECT r, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS items
  FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS s FROM hits WHERE item_id IS NOT NULL) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered USING (r) LEFT JOIN found USING (r)
"""


def op12_whitening(spark, sf_dir):
    """Every embedding on its eight leading principal components, at unit variance."""
    out = whiten(table(spark, sf_dir, "embeddings"), columns=["vec_id"])
    return out.select("vec_id", "component", "n", F.expr("try_cast(deviation AS bigint)").alias("deviation"),
                      "whitened", "explained", "identity_error")


def with_periods(docs):
    """``docs`` (doc_id, text), a tenth of them made periodic from some word on.

    With h the CRC-32 of the decimal id and g = h // 10, documents with h % 10 = 0
    and n > 0 words repeat the p words from a = g % n on, p = 1 + (n - a) // (3 + g % 8).
    """
    def work(batches):
        for batch in batches:
            texts = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                h = zlib.crc32(str(doc_id).encode())
                words = (text.as_py() or "").encode().split() if doc_id is not None and h % 10 == 0 else []
                if words:
                    g, n = h // 10, len(words)
                    a = g % n
                    p = 1 + (n - a) // (3 + g % 8)
                    text = pa.scalar(b" ".join(words[:a] + [words[a + i % p] for i in range(n - a)]).decode())
                texts.append(text.as_py())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    docs = docs.select("doc_id", "text")
    return docs.mapInArrow(work, docs.schema)


def op13_periodic_runs(spark, sf_dir):
    """Periodic runs of every document, and digests of the runs and of the text without repeats."""
    out = collapse_runs(with_periods(table(spark, sf_dir, "documents")), columns=["doc_id"])
    best = F.aggregate("runs", F.element_at("runs", 1), lambda b, r: F.when(
        r["length"] * b["period"] > b["length"] * r["period"], r).otherwise(b))
    out = out.withColumn("best", F.when(F.size("runs") > 0, best))
    told = F.array_join(F.transform("runs", lambda r: F.concat(
        F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
    return out.select("doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
                      F.expr("1000 * best.length div best.period").alias("exponent_milli"),
                      F.sha2(told, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))

QUERIES = {
    "op1_nearest_neighbours": op1_nearest_neighbours,
    "op2_line_dedup": op2_line_dedup,
    "op3_html_text": op3_html_text,
    "op4_chat_format": op4_chat_format,
    "op5_sentencepiece": op5_sentencepiece,
    "op6_secret_scan": op6_secret_scan,
    "op7_ngram_join": op7_ngram_join,
    "op8_quality_classifier": op8_quality_classifier,
    "op9_quality_rules": op9_quality_rules,
    "op10_packing": op10_packing,
    "op11_decontamination": op11_decontamination,
    "op12_whitening": op12_whitening,
    "op13_periodic_runs": op13_periodic_runs,
}

ORACLE_SQL = {
    "op1_nearest_neighbours": OP1_SQL,
    "op2_line_dedup": OP2_SQL,
    "op4_chat_format": OP4_SQL,
    "op7_ngram_join": OP7_SQL,
    "op11_decontamination": OP11_SQL,
}
