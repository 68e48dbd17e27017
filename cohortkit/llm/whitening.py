"""Embedding whitening from exact integer moments, by bit-sliced products.

Vector entries become integers. Each block of rows shifts a dimension's
integers by their least value, slices them into bit planes and packs a plane
of 64 rows into one word. The sum over rows of a product of two dimensions
is the sum over pairs of their planes of 2**(a + b) times the number of bits
that both have set, counted word by word. Shifts are undone and blocks added
in whole numbers, so the scatter is exact whatever the order of rows; it is
centred as whole numbers before it becomes a matrix of doubles for ``eigh``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortkit.llm.common import packed, quoted, saved, unpacked

#: Rows sliced at once: 256 words a plane.
BLOCK = 1 << 14
#: Exact sums travel as two decimals, the lower with this many bits.
LOW_BITS = 60
MADE = ("component", "n", "deviation", "whitened", "explained", "identity_error")


def integers(vectors: pa.Array, dim: int | None, scale: int, shift: int) -> tuple[np.ndarray, np.ndarray]:
    """Which vectors take part, and ``floor(scale * c) + shift`` of their entries.

    Those of another length than ``dim`` (or without entries), with a NULL or
    non-finite entry, or one whose integer is not below 2**53, take no part.
    """
    lengths = vectors.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    flat = vectors.flatten()  # leaves out what is under NULL vectors
    values = flat.cast(pa.float64()).fill_null(float("nan")).to_numpy(zero_copy_only=False)
    with np.errstate(over="ignore", invalid="ignore"):
        values = np.floor(scale * values) + shift
    bad = np.zeros(len(values) + 1, np.int64)
    np.cumsum(~(np.abs(values) < 2.0 ** 53), out=bad[1:])
    ends = np.cumsum(lengths)
    good = (lengths > 0) & (bad[ends] == bad[ends - lengths])
    if dim is None:
        return good, lengths
    good &= lengths == dim
    at = (ends - lengths)[good]
    return good, values[at[:, None] + np.arange(dim)].astype(np.int64)


def planes(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The bit planes of each column above its least value, rows packed 64 to a word.

    Returns the least values, the planes and each plane's column and bit.
    """
    least = x.min(axis=0)
    above = (x - least).astype(np.uint64)
    bits = [int(m).bit_length() for m in above.max(axis=0)]
    column = np.repeat(np.arange(x.shape[1]), bits)
    bit = np.concatenate([np.arange(b) for b in bits]) if sum(bits) else np.zeros(0, np.int64)
    words = -(-len(x) // 64)
    out = np.zeros((len(column), words * 8), np.uint8)
    for i, (c, b) in enumerate(zip(column, bit)):
        row = np.packbits(((above[:, c] >> np.uint64(b)) & np.uint64(1)).astype(np.uint8))
        out[i, :len(row)] = row
    return least, out.view(np.uint64), column, bit


def scatter(x: np.ndarray) -> tuple[list[int], list[int]]:
    """Exact sums of the columns and of the products of all pairs of columns (upper
    triangle, row by row) of a block of rows."""
    least, sliced, column, bit = planes(x)
    n, dim = x.shape
    weight = np.zeros((len(column), dim), object)
    for i, (c, b) in enumerate(zip(column, bit)):
        weight[i, c] = 1 << int(b)
    common = np.zeros((len(column), len(column)), np.int64)
    for i in range(len(column)):
        common[i, i:] = np.bitwise_count(sliced[i] & sliced[i:]).sum(axis=1, dtype=np.int64)
    common += np.triu(common, 1).T
    small = max((int(b) for b in bit), default=0) * 2 + 2 + n.bit_length() + len(column).bit_length() < 62
    kind = np.int64 if small else object
    weight = weight.astype(kind)
    products = weight.T @ common.astype(kind) @ weight if len(column) else np.zeros((dim, dim), kind)
    sums = weight.T @ np.diag(common).astype(kind) if len(column) else np.zeros(dim, kind)
    low = [int(v) for v in least]
    sums = [int(v) for v in sums]
    pairs = [int(products[i, j]) + low[i] * sums[j] + low[j] * sums[i] + n * low[i] * low[j]
             for i in range(dim) for j in range(i, dim)]
    return [s + n * m for s, m in zip(sums, low)], pairs


def moments(vectors: DataFrame, dim: int, scale: int, shift: int) -> tuple[int, np.ndarray, np.ndarray]:
    """Number of vectors, sums and sums of products over all rows, as whole numbers."""
    def work(batches):
        count, sums, pairs = 0, [0] * dim, [0] * (dim * (dim + 1) // 2)
        for x in blocks(batches, dim, scale, shift):
            more, products = scatter(x)
            count += len(x)
            sums = [a + b for a, b in zip(sums, more)]
            pairs = [a + b for a, b in zip(pairs, products)]
        if count:
            values = [count, *sums, *pairs]
            wide = pa.decimal128(38, 0)
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(len(values)), pa.int32()), pa.array([v >> LOW_BITS for v in values], wide),
                 pa.array([v & ((1 << LOW_BITS) - 1) for v in values], wide)], names=["place", "high", "low"])

    parts = vectors.mapInArrow(work, "place int, high decimal(38,0), low decimal(38,0)")
    rows = parts.groupBy("place").agg(F.sum("high").alias("high"), F.sum("low").alias("low")).collect()  # by dim alone
    values = {r["place"]: (int(r["high"]) << LOW_BITS) + int(r["low"]) for r in rows}
    if not values:
        return 0, np.zeros(dim, object), np.zeros((dim, dim), object)
    sums = np.array([values[1 + i] for i in range(dim)], object)
    products = np.zeros((dim, dim), object)
    products[np.triu_indices(dim)] = [values[1 + dim + k] for k in range(dim * (dim + 1) // 2)]
    products += np.triu(products, 1).T
    return values[0], sums, products


def blocks(batches, dim: int, scale: int, shift: int) -> Iterator[np.ndarray]:
    """The integers of the rows that take part, ``BLOCK`` rows at a time."""
    held: list[np.ndarray] = []
    for batch in batches:
        held.append(integers(batch.column(0), dim, scale, shift)[1])
        while sum(map(len, held)) >= BLOCK:
            rows = np.concatenate(held)
            yield rows[:BLOCK]
            held = [rows[BLOCK:]]
    rows = np.concatenate(held) if held else np.zeros((0, dim), np.int64)
    if len(rows):
        yield rows


def squares(t: np.ndarray) -> list[int]:
    """Exact sum of squares of each row of whole numbers."""
    if not len(t):
        return []
    if t.dtype == object or np.abs(t).max() >= 1 << 46:
        return [sum(int(v) ** 2 for v in row) for row in t]
    high, low = t >> 23, t & ((1 << 23) - 1)
    parts = ((high * high).sum(axis=1), (high * low).sum(axis=1), (low * low).sum(axis=1))
    return [(int(a) << 46) + (int(b) << 24) + int(c) for a, b, c in zip(*parts)]


def whiten(vectors: DataFrame, *, vector_col: str = "embedding", columns: list[str] | None = None,
           components: int = 8, scale: int = 1024, shift: int = 100_000) -> DataFrame:
    """Vectors on their leading principal components, each scaled to unit variance.

    An entry ``c`` counts as the whole number ``floor(scale * c) + shift``. The
    covariance (divisor ``n``) is exact; its unit eigenvectors are numbered from
    1 by falling eigenvalue. Returns ``columns`` (default: all but the vector)
    and, one row per vector and component, ``component``, ``n`` (vectors that
    take part), ``deviation`` (decimal: exact sum over dimensions of the square
    of ``n`` times the entry less the sum), ``whitened``, ``explained`` (share of
    the variance) and ``identity_error``: the largest absolute entry of the
    measured covariance of ``whitened`` less the identity. Input columns of these
    names are replaced.

    Vectors that are NULL, hold NULL or non-finite entries, or entries whose
    number reaches 2**53, take no part and have no rows; nor have empty ones, nor
    those of another length than most have (of lengths equally common, the
    smallest). Components with under 1e-11 of the first's variance can't be told
    from rounding and are left out, so vectors that are all equal give no rows,
    as an empty table does. Rows repeat as given and count as often.

    Three passes: lengths, moments and output, which is written and read back to measure
    its covariance. What meets on the driver grows with the dimension alone.
    """
    names = [c for c in vectors.columns if c != vector_col] if columns is None else list(columns)
    spark = vectors.sparkSession
    base = vectors.select(quoted(vector_col).cast("array<double>").alias("v"),
                          packed(vectors.select([quoted(c) for c in names])).alias("row"))

    def measured(batches):
        for batch in batches:
            good, lengths = integers(batch.column(0), None, scale, shift)
            yield pa.RecordBatch.from_arrays([pa.array(lengths[good], pa.int32())], names=["dim"])

    common = (base.select("v").mapInArrow(measured, "dim int").groupBy("dim").count()
              .orderBy(F.desc("count"), "dim").first())
    dim = common["dim"] if common else 1
    n, sums, products = moments(base.select("v"), dim, scale, shift)
    centred = n * products - np.multiply.outer(sums, sums)  # n * n times the covariance
    variance = np.array([[v / max(n * n, 1) for v in row] for row in centred])
    values, axes = np.linalg.eigh(variance)
    values, axes = values[::-1], axes[:, ::-1]
    used = int((values[:components] > max(values[0], 0.0) * 1e-11).sum())
    values, axes = values[:used], axes[:, :used]
    trace = float(np.trace(variance))
    explained = values / trace if used else values
    wide = n.bit_length() + 53 > 62

    def work(batches):
        for batch in batches:
            good, x = integers(batch.column(0), dim, scale, shift)
            t = (x.astype(object) if wide else x) * n - (sums if wide else sums.astype(np.int64))
            score = (t / n).astype(np.float64) @ axes / np.sqrt(values)
            ends = pa.array(np.arange(len(t) + 1) * used, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column(1).take(pa.array(np.flatnonzero(good))), pa.array(squares(t), pa.decimal128(38, 0)),
                 pa.ListArray.from_arrays(ends, pa.array(score.ravel(), pa.float64()))],
                names=["row", "deviation", "scores"])

    schema = base.select("row").schema
    for field in spark.createDataFrame([], "deviation decimal(38,0), scores array<double>").schema:
        schema.add(field)
    if used:
        rows = saved(base.mapInArrow(work, schema), "whitened")
        error = identity_error(rows, n, used)
    else:
        rows, error = spark.createDataFrame([], schema), 0.0
    rows = rows.select("row", "deviation", F.posexplode("scores").alias("axis", "whitened"))
    shares = F.array(*[F.lit(float(v)) for v in explained]) if used else F.array(F.lit(0.0))
    given = {"component": F.col("axis") + 1, "n": F.lit(n).cast("long"), "deviation": F.col("deviation"),
             "whitened": F.col("whitened"), "explained": F.get(shares, F.col("axis")), "identity_error": F.lit(error)}
    return rows.select(unpacked(rows, [c for c in names if c not in given] + list(given), given))


def identity_error(rows: DataFrame, n: int, used: int) -> float:
    """Largest absolute entry of the covariance of the written scores less the identity."""
    def gather(centre):
        def work(batches):
            total = np.zeros(used if centre is None else (used, used))
            for batch in batches:
                x = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, used)
                total += x.sum(axis=0) if centre is None else (x - centre).T @ (x - centre)
            yield pa.RecordBatch.from_arrays([pa.array([total.ravel().tolist()], pa.list_(pa.float64()))], names=["s"])

        parts = rows.select("scores").mapInArrow(work, "s array<double>")
        cells = used if centre is None else used * used
        return np.array(parts.agg(*[F.sum(F.col("s")[i]) for i in range(cells)]).first(), float) / n

    mean = gather(None)
    return float(np.abs(gather(mean).reshape(used, used) - np.eye(used)).max())
