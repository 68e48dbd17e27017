"""Line deduplication with two Bloom filters and an exact confirmation.

1. Every task hashes the distinct line keys of its documents into a filter
   of keys seen once and a filter of keys seen twice. Merging two tasks'
   filters ORs both and adds the AND of the once-seen filters to the
   twice-seen one, so a key two documents share is always in the latter.
2. Only lines whose key is in the twice-seen filter are shuffled: their
   documents are counted exactly, by the key's text.
3. The confirmed keys of each document are joined back on its id, and the
   lines are dropped (or kept in the first document that has them).

The filters' size is a parameter and does not follow the input; beyond it
the filter lets more lines through to step 2, and results stay the same.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortkit.llm.common import packed, quoted, saved, tidy, to_batch, unpacked, WHITE

SEGMENT = 1 << 16  # bytes of a filter that travel together


def line_key(line: bytes) -> bytes:
    """The line without white space at both ends, A-Z lower-cased."""
    return line.strip(WHITE).lower()


def long_enough(key: bytes, min_chars: int) -> bool:
    """At least ``min_chars`` code points; decodes only where bytes don't decide."""
    n = len(key)
    if n < min_chars:
        return False
    return n >= 4 * min_chars or len(key.decode()) >= min_chars


def doc_keys(text: str | None, min_chars: int) -> set[bytes]:
    keys = set(map(line_key, (text or "").encode().split(b"\n")))
    return {k for k in keys if long_enough(k, min_chars)}


def bit_places(keys: np.ndarray, bits: int, hashes: int) -> np.ndarray:
    """``hashes`` bit positions for each 64-bit key hash (one row each)."""
    step = (keys >> np.uint64(32)) | np.uint64(1)
    k = np.arange(hashes, dtype=np.uint64)[:, None]
    return ((keys[None, :] + k * step[None, :]) & np.uint64(bits - 1)).astype(np.int64)


class BloomPair:
    """Filters of keys seen once or more and twice or more."""

    def __init__(self, bits: int, hashes: int):
        self.bits, self.hashes = bits, hashes
        self.once, self.twice = np.zeros(bits, bool), np.zeros(bits, bool)

    def add(self, keys: np.ndarray) -> None:
        """``keys``: 64-bit hashes, one for each document that has the line."""
        keys, counts = np.unique(keys, return_counts=True)
        at = bit_places(keys, self.bits, self.hashes)
        again = self.once[at].all(axis=0) | (counts > 1)
        self.twice[at[:, again].ravel()] = True
        self.once[at.ravel()] = True


def merge(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    return a[0] | b[0], a[1] | b[1] | (a[0] & b[0])


def key_hashes(keys: set[bytes]) -> list[int]:
    return [xxhash.xxh3_64_intdigest(k) for k in keys]


def twice_seen(texts: DataFrame, min_chars: int, bits: int, hashes: int) -> bytes:
    """The merged twice-seen filter over all rows of ``texts`` (one column), packed."""
    segment = min(SEGMENT, bits // 8)
    schema = pa.schema([("segment", pa.int32()), ("once", pa.binary()), ("twice", pa.binary())])

    def build(batches):
        pair = BloomPair(bits, hashes)
        for batch in batches:
            found: list[int] = []
            for text in batch.column(0):
                found += key_hashes(doc_keys(text.as_py(), min_chars))
            if found:
                pair.add(np.array(found, np.uint64))
        once, twice = np.packbits(pair.once), np.packbits(pair.twice)
        for i in range(0, len(once), segment):
            if once[i:i + segment].any():
                yield to_batch({"segment": [i // segment], "once": [once[i:i + segment].tobytes()],
                                "twice": [twice[i:i + segment].tobytes()]}, schema)

    def combine(batches):
        found: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            for i, once, twice in zip(*(c.to_pylist() for c in batch.columns)):
                new = np.frombuffer(once, np.uint8), np.frombuffer(twice, np.uint8)
                found[i] = merge(found[i], new) if i in found else new
        for i, (_, twice) in found.items():
            if twice.any():
                yield to_batch({"segment": [i], "once": [b""], "twice": [twice.tobytes()]}, schema)

    ddl = "segment int, once binary, twice binary"
    parts = texts.mapInArrow(tidy(build), ddl).repartition("segment").mapInArrow(tidy(combine), ddl)
    whole = bytearray(bits // 8)
    for r in parts.select("segment", "twice").collect():  # bits / 8 bytes at most
        whole[r["segment"] * segment:(r["segment"] + 1) * segment] = r["twice"]
    return bytes(whole)


def salted_join(pairs: DataFrame, confirmed: DataFrame, salt_docs: int) -> DataFrame:
    """``pairs`` (key, id, ..) with ``first`` of their confirmed key.

    A key with over ``salt_docs`` documents that is also more than a thousandth of all
    confirmed pairs meets them under a salt for each ``salt_docs``. There are fewer than a
    thousand such keys whatever the input, so their hashes can be broadcast.
    """
    total = confirmed.agg(F.coalesce(F.sum("docs"), F.lit(0))).first()[0]
    hot = (confirmed.where((F.col("docs") > salt_docs) & (F.col("docs") * 1000 > total))
           .groupBy(F.xxhash64("key").alias("hot")).agg(F.max(F.ceil(F.col("docs") / salt_docs)).alias("salts")))

    def with_salts(df: DataFrame) -> DataFrame:
        found = df.join(F.broadcast(hot), F.xxhash64("key") == F.col("hot"), "left").drop("hot")
        return found.withColumn("salts", F.coalesce("salts", F.lit(1)))

    left = with_salts(pairs).withColumn("salt", F.pmod(F.xxhash64("id"), F.col("salts"))).drop("salts")
    right = with_salts(confirmed).select(
        "key", "first", F.explode(F.sequence(F.lit(0).cast("long"), F.col("salts") - 1)).alias("salt"))
    return left.join(right, ["key", "salt"])


def line_dedup(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", min_docs: int = 2,
               min_chars: int = 1, keep: str = "first", bloom_bits: int = 1 << 25,
               bloom_hashes: int = 3, salt_docs: int = 100_000) -> DataFrame:
    """Drop lines whose key at least ``min_docs`` documents share.

    A text is split at ``\\n``; a line's key is the line stripped of ASCII
    white space and lower-cased in A-Z; keys under ``min_chars`` code points
    never count. ``keep='first'`` leaves such a line in the document with
    the smallest id that has it (its first such line there), ``'none'``
    nowhere. Returns the input's columns with the text replaced by the
    remaining lines joined by ``\\n``, then ``n_lines`` (before dropping) and
    ``n_dropped``; input columns of these two names are replaced.

    A NULL or empty text is one empty line and comes back empty. Rows with
    one id (or with no id) are one document when documents are counted; each
    such row keeps its own result. An empty table gives an empty result.
    Runs one pass over the texts at once, to build the filters, which have
    ``bloom_bits`` bits each (a power of two). A line of more than ``salt_docs``
    documents meets them under that many salts.
    """
    if keep not in ("first", "none"):
        raise ValueError("keep must be 'first' or 'none'")
    if bloom_bits < 64 or bloom_bits & (bloom_bits - 1):
        raise ValueError("bloom_bits must be a power of two, 64 or more")
    spark = docs.sparkSession
    rows = docs.select(packed(docs, [text_col]).alias("row"), quoted(id_col).alias("id"),
                       quoted(text_col).cast("string").alias("text"))
    seen = spark.sparkContext.broadcast(twice_seen(rows.select("text"), min_chars, bloom_bits, bloom_hashes))
    id_type = rows.schema["id"].dataType

    def suspects(batches):
        bits = np.frombuffer(seen.value, np.uint8)
        for batch in batches:
            keys: list[bytes] = []
            rows_of: list[int] = []
            for i, text in enumerate(batch.column(1)):
                own = doc_keys(text.as_py(), min_chars)
                keys += own
                rows_of += [i] * len(own)
            if not keys:
                continue
            at = bit_places(np.array(key_hashes(keys), np.uint64), bloom_bits, bloom_hashes)
            hit = (bits[at >> 3] >> (7 - (at & 7)).astype(np.uint8) & 1).all(axis=0)
            at = np.flatnonzero(hit)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(np.array(rows_of)[at])),
                 pa.array([keys[i].decode() for i in at], pa.string())], names=["id", "key"])

    ddl = f"id {id_type.simpleString()}, key string"
    found = saved(rows.select("id", "text").mapInArrow(tidy(suspects), ddl), "line-suspects")
    # by key and document first: a key of very many documents is spread, and repeated rows count once
    pairs = found.groupBy("key", "id").agg(F.count(F.lit(1)).alias("n"))
    confirmed = saved(pairs.groupBy("key").agg(F.count(F.lit(1)).alias("docs"), F.min("id").alias("first"))
                      .where(F.col("docs") >= min_docs), "line-confirmed")
    drops = (salted_join(pairs, confirmed, salt_docs)
             .groupBy("id").agg(F.collect_list(F.struct(
                 "key", F.coalesce(F.col("id") == F.col("first"), F.col("first").isNull())
                 .alias("here"))).alias("keys")))
    drops = drops.select(F.col("id").alias("drop_id"), F.col("keys.key").alias("keys"), F.col("keys.here").alias("here"))
    joined = rows.join(drops, F.col("id").eqNullSafe(F.col("drop_id")), "left").select("row", "text", "keys", "here")

    def apply(batches):
        for batch in batches:
            out: list[str] = []
            n_lines: list[int] = []
            n_dropped: list[int] = []
            for text, keys, here in zip(batch.column(1), batch.column(2), batch.column(3)):
                text = text.as_py() or ""
                lines = text.split("\n")
                n_lines.append(len(lines))
                if keys.is_valid:
                    left = {k: keep == "first" and h for k, h in zip(keys.as_py(), here.as_py())}
                    kept = []
                    for line in lines:
                        key = line_key(line.encode()).decode()
                        if key not in left:
                            kept.append(line)
                        elif left[key]:
                            left[key] = False
                            kept.append(line)
                    n_dropped.append(len(lines) - len(kept))
                    text = "\n".join(kept)
                else:
                    n_dropped.append(0)
                out.append(text)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(out, pa.string()), pa.array(n_lines, pa.int64()),
                 pa.array(n_dropped, pa.int64())], names=["row", "kept", "n_lines", "n_dropped"])

    result = joined.mapInArrow(tidy(apply), _row_schema(joined))
    given = {text_col: F.col("kept"), "n_lines": F.col("n_lines"), "n_dropped": F.col("n_dropped")}
    columns = [c for c in docs.columns if c not in ("n_lines", "n_dropped")] + ["n_lines", "n_dropped"]
    return result.select(unpacked(result, columns, given))


def _row_schema(joined: DataFrame):
    from pyspark.sql.types import LongType, StringType, StructField, StructType

    return StructType([joined.schema["row"], StructField("kept", StringType()),
                       StructField("n_lines", LongType()), StructField("n_dropped", LongType())])
