"""Helpers shared by the operators of this package."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortkit.session import scratch_path

#: ASCII white space, ``[\\x20\\x09-\\x0D]``.
WHITE = b" \t\n\x0b\x0c\r"

#: Bytes of text worked on at once inside a task.
CHUNK_BYTES = 2 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def saved(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared checkpoint folder and read back.

    Cuts the lineage with a copy that survives a lost executor.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def packed(df: DataFrame, without: Sequence[str] = ()) -> Column:
    """The columns of ``df`` but ``without`` as one struct.

    Working columns next to it cannot clash with the caller's columns,
    whatever those are called.
    """
    cols = [quoted(c) for c in df.columns if c not in without]
    return F.struct(*cols) if cols else F.struct(F.lit(None).cast("int").alias("none"))


def unpacked(df: DataFrame, columns: Sequence[str], given: dict[str, Column], row: str = "row") -> list[Column]:
    """``columns`` in order: from ``given`` where named there, else from the struct ``row``."""
    return [(given[c] if c in given else F.col(row).getField(c)).alias(c) for c in columns]


def text_chunks(batches: Iterable[pa.RecordBatch], column: str,
                limit: int = CHUNK_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices of the batches holding about ``limit`` bytes of text (one row at least).

    Yields the slice, the bytes of its texts and the row offsets in them;
    a NULL text has no bytes.
    """
    for batch in batches:
        col = batch.column(batch.schema.get_field_index(column)).cast(pa.large_string())
        if col.null_count:
            col = col.fill_null("")
        offsets = np.frombuffer(col.buffers()[1], np.int64)[col.offset:col.offset + len(col) + 1] \
            if len(col) else np.zeros(1, np.int64)
        data = col.buffers()[2]
        data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
        at = 0
        while at < len(col):
            end = int(np.searchsorted(offsets, offsets[at] + limit, side="right")) - 1
            end = min(max(end, at + 1), len(col))
            lo, hi = int(offsets[at]), int(offsets[end])
            yield batch.slice(at, end - at), data[lo:hi], offsets[at:end + 1] - lo
            at = end


def to_batch(columns: dict[str, object], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [x if isinstance(x, (pa.Array, pa.ChunkedArray)) else pa.array(x, f.type)
         for f, x in ((f, columns[f.name]) for f in schema)], schema=schema)


def row_count(mask: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """How often ``mask`` is true between consecutive ``offsets``."""
    ends = offsets.tolist()
    return np.fromiter((np.count_nonzero(mask[a:b]) for a, b in zip(ends, ends[1:])), np.int64, len(ends) - 1)


def release() -> None:
    """Free memory of this Python process back to the system.

    Unreachable frames go first, which also lets the JVM forget their plans.
    """
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # not glibc: nothing to trim
        pass


def tidy(work: Callable) -> Callable:
    """``work`` for ``mapInArrow``, giving free memory back to the system when a task ends.

    Python workers live on for later tasks; what allocators hold on to after one
    stage would add to what the next one needs.
    """
    def run(batches):
        yield from work(batches)
        release()
    return run
