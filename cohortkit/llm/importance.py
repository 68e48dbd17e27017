"""Quality classification by importance resampling.

Two generative models over hashed byte n-grams are estimated: one of the
target (documents labelled good), one of the raw corpus. A document's
weight is the log ratio of its probabilities under both. Adding independent
Gumbel noise to the log weights and taking the largest ``k`` samples ``k``
documents without replacement in proportion to their weights.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from cohortkit.llm.common import CHUNK_BYTES, packed, quoted, saved, text_chunks, unpacked

RADIX_BITS = 16


def gram_blocks(data: np.ndarray, offsets: np.ndarray, n: int, buckets: int):
    """For blocks of the texts' ``n``-grams: the text each belongs to, and its bucket.
    None crosses from one text into the next."""
    total = len(data) - n + 1
    for a in range(0, max(total, 0), CHUNK_BYTES):
        b = min(a + CHUNK_BYTES, total)
        doc = np.searchsorted(offsets, np.arange(a, b + n - 1), side="right") - 1
        inside = doc[:b - a] == doc[n - 1:]
        h = data[a:b].astype(np.uint64)
        for k in range(1, n):
            h = h * np.uint64(257) + data[a + k:b + k]
        h = (h * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - buckets.bit_length() + 1)
        yield doc[:b - a][inside], h[inside].astype(np.int64)


def gram_counts(rows: DataFrame, n: int, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Counts of the buckets over all rows (text, good) and over the good ones."""
    def count(batches):
        table = np.zeros((2, buckets), np.int64)
        for part, data, offsets in text_chunks(batches, "text"):
            good = np.array(part.column(1).fill_null(False))
            for doc, h in gram_blocks(data, offsets, n, buckets):
                table[0] += np.bincount(h, minlength=buckets)
                if good.any():
                    table[1] += np.bincount(h[good[doc]], minlength=buckets)
        for i in range(2):
            yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([table[i].tobytes()])],
                                             names=["model", "counts"])

    def add(batches):
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for i, counts in zip(*(c.to_pylist() for c in batch.columns)):
                total[i] = total.get(i, 0) + np.frombuffer(counts, np.int64)
        for i, counts in total.items():
            yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([counts.tobytes()])],
                                             names=["model", "counts"])

    ddl = "model int, counts binary"
    parts = rows.mapInArrow(count, ddl)
    out = np.zeros((2, buckets), np.int64)
    # two tables of fixed size per input partition, added up by a few tasks before the last
    spread = parts.repartition(16, "model", F.rand(5)).mapInArrow(add, ddl)
    for r in spread.repartition("model").mapInArrow(add, ddl).collect():
        out[r["model"]] = np.frombuffer(r["counts"], np.int64)
    return out[0], out[1]


def log_ratio(raw: np.ndarray, target: np.ndarray, smoothing: float) -> np.ndarray:
    """Log of the target's over the raw model's probability of each bucket."""
    def log_p(counts: np.ndarray) -> np.ndarray:
        p = counts / max(counts.sum(), 1) + smoothing / len(counts)
        return np.log(p / p.sum())
    return log_p(target) - log_p(raw)


def order_key(values: np.ndarray) -> np.ndarray:
    """Signed 64-bit integers in the order of the doubles (-0 as 0)."""
    bits = (values + 0.0).view(np.int64)
    return np.where(bits < 0, bits ^ np.int64(0x7FFFFFFFFFFFFFFF), bits)


def kth_largest(keys: DataFrame, column: str, k: int) -> int | None:
    """The ``k``-th largest value of a column of longs, exactly, by counting
    digits of it: at most 2**16 counts a round come to the driver."""
    if k <= 0:
        return None
    low, high = -(1 << 63), (1 << 63) - 1
    left = k
    for shift in range(64 - RADIX_BITS, -1, -RADIX_BITS):
        digit = F.shiftrightunsigned(F.col(column) - F.lit(low), shift) if shift else F.col(column) - F.lit(low)
        if shift == 64 - RADIX_BITS:
            # the sign bit turned over, as the difference would overflow
            digit = F.shiftrightunsigned(F.col(column).bitwiseXOR(F.lit(low)), shift)
        counts = sorted(keys.where(F.col(column).between(low, high)).groupBy(digit.cast("int").alias("d"))
                        .agg(F.count(F.lit(1)).alias("n")).collect(), key=lambda r: -r["d"])
        for r in counts:
            if r["n"] >= left:
                low += r["d"] << shift
                high = low + (1 << shift) - 1
                break
            left -= r["n"]
        else:
            return None  # fewer than k rows: all are taken
    return low


def labelled_sample(labels: DataFrame, id_col: str, label_col: str, sample: int) -> DataFrame:
    """(label_id, good) of at most ``sample`` labelled ids, those of smallest hash; an id
    with both labels counts as bad."""
    rows = (labels.where(quoted(label_col).isNotNull() & quoted(id_col).isNotNull())
            .groupBy(quoted(id_col).alias("label_id")).agg((F.min(quoted(label_col).cast("int")) > 0).alias("good")))
    return saved(rows.orderBy(F.xxhash64("label_id"), "label_id").limit(sample), "label-sample")


def importance_sample(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                      label_col: str = "quality", columns: list[str] | None = None, share: float | None = None,
                      sample: int = 20000, n: int = 4, buckets: int = 1 << 16, smoothing: float = 1e-2,
                      seed: int = 11) -> DataFrame:
    """``columns`` of the input (default: all), ``n_grams``, ``log_weight``, ``gumbel_key`` and ``kept``.

    Kept are the ``k`` rows of largest key (log weight plus Gumbel noise),
    ``k`` being ``share`` of all rows, by default the share of good labels.
    Noise depends on ``seed`` and the id alone, so repeated ids share it, and
    rows that tie with the ``k``-th are kept with it. Input columns of the
    new names are replaced.

    The target model is fitted on the good ones among at most ``sample``
    labelled ids; the raw model on every row. Both have ``buckets`` counters
    (a power of two). A NULL or empty text has weight 0. Without good labels
    all weights are 0. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    names = list(docs.columns) if columns is None else list(columns)
    chosen = labelled_sample(labels, id_col, label_col, sample)
    stats = chosen.agg(F.count(F.lit(1)), F.sum(F.col("good").cast("int"))).first()
    labelled, good = stats[0], stats[1] or 0
    share = (good / labelled if labelled else 1.0) if share is None else share
    text = quoted(text_col).cast("string").alias("text")
    # at most ``sample`` rows are broadcast
    flagged = (docs.select(text, quoted(id_col).alias("id"))
               .join(F.broadcast(chosen), F.col("id") == F.col("label_id"), "left").select("text", "good"))
    raw, target = gram_counts(flagged, n, buckets)
    table = log_ratio(raw, target, smoothing) if target.any() else np.zeros(buckets)
    shared = spark.sparkContext.broadcast(table)  # a fixed number of buckets
    noise = F.pmod(F.xxhash64(F.lit(seed), quoted(id_col)), F.lit(1 << 52)).alias("noise")
    rows = docs.select(packed(docs.select([quoted(c) for c in names])).alias("row"), noise, text)

    def weigh(batches):
        ratio = shared.value
        for part, data, offsets in text_chunks(batches, "text"):
            weight, grams = np.zeros(part.num_rows), np.zeros(part.num_rows, np.int64)
            for doc, h in gram_blocks(data, offsets, n, buckets):
                weight += np.bincount(doc, ratio[h], minlength=part.num_rows)
                grams += np.bincount(doc, minlength=part.num_rows)
            uniform = (np.array(part.column(1), np.float64) + 0.5) / float(1 << 52)
            key = weight - np.log(-np.log(uniform))
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(grams), pa.array(weight), pa.array(key), pa.array(order_key(key))],
                names=["row", "n_grams", "log_weight", "gumbel_key", "rank_key"])

    scored = saved(rows.mapInArrow(weigh, StructType(
        [rows.schema["row"], StructField("n_grams", LongType()), StructField("log_weight", DoubleType()),
         StructField("gumbel_key", DoubleType()), StructField("rank_key", LongType())])), "importance")
    k = round(share * scored.count())
    least = kth_largest(scored, "rank_key", k)
    kept = F.lit(k > 0) if least is None else F.col("rank_key") >= F.lit(least)
    given = {c: F.col(c) for c in ("n_grams", "log_weight", "gumbel_key")} | {"kept": kept}
    return scored.select(unpacked(scored, [c for c in names if c not in given] + list(given), given))
