"""Quality rules: counted base rules and robust multivariate outliers.

Each document becomes a short vector of transformed text statistics. Per
language and source a minimum-covariance-determinant estimate of centre and
scatter is found from several deterministic starts by concentration steps:
order the rows by Mahalanobis distance, re-estimate from the closest half,
repeat until the determinant settles. The start with the least determinant
wins and is re-estimated once from all rows that are not far from it. A step
is one aggregation over all rows, for all starts together, into histograms
of distances that carry the first and second moments of each bin, so no group
is ever gathered; only its bins (a fixed number) meet in one task.
"""

from __future__ import annotations

from statistics import NormalDist

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from cohortkit.llm.common import packed, quoted, row_count, saved, text_chunks, tidy, unpacked, WHITE
from cohortkit.llm.words import is_space, mix, windows, word_hashes

SYMBOLS = b"#*$%&|<>"
PUNCTUATION = b".,;:!?"
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: Standard deviations of the statistics (log word length; square roots of the shares
#: of symbols, capitals, digits, punctuation, words equal to the one before) count as
#: this at least, so that what is constant in most documents of a group does not reject
#: the others. Digits may vary most: numbers and keys in a text are no sign of bad prose.
FLOORS = (0.08, 0.05, 0.05, 0.2, 0.04, 0.05)
DIM = len(FLOORS)
BINS_PER_OCTAVE, LOW_BIN, HIGH_BIN = 16, -160, 320


def repeat_words(hashes: np.ndarray, offsets: np.ndarray, n: int = 5) -> np.ndarray:
    """Words of each text inside ``n``-word windows found twice or more in it."""
    found, at = windows(hashes, offsets, n)
    if not len(found):
        return np.zeros(len(offsets) - 1, np.int64)
    doc = np.searchsorted(offsets, at, side="right").astype(np.uint64)
    key = mix(found + doc * np.uint64(0x9E3779B97F4A7C15))
    order = np.argsort(key)
    same = key[order[1:]] == key[order[:-1]]
    again = np.zeros(len(key), bool)
    again[order[1:][same]] = True
    again[order[:-1][same]] = True
    edge = np.zeros(len(hashes) + 1, np.int32)
    np.add.at(edge, at[again], 1)
    np.add.at(edge, at[again] + n, -1)
    return row_count(np.cumsum(edge[:-1]) > 0, offsets)


def dup_lines(text: bytes) -> int:
    """Lines with a word that equal an earlier line."""
    lines = text.split(b"\n")
    if len(set(lines)) == len(lines):
        return 0
    seen: set[bytes] = set()
    found = 0
    for line in lines:
        if line in seen:
            found += bool(line.strip(WHITE))
        seen.add(line)
    return found


def measure(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """The five measures and the statistic vector of each text."""
    hashes, words_at = word_hashes(data, offsets)
    n_words = np.diff(words_at)
    space = is_space(data)
    chars = row_count(~space & ((data & np.uint8(0xC0)) != 0x80), offsets)

    def count(of: bytes) -> np.ndarray:
        wanted = np.zeros(256, bool)
        wanted[list(of)] = True
        return row_count(wanted[data], offsets)

    symbols = count(SYMBOLS)
    ends = offsets.tolist()
    dups = np.fromiter((dup_lines(data[a:b].tobytes()) for a, b in zip(ends, ends[1:])), np.int64, len(ends) - 1)
    share = [np.sqrt(c / (chars + 100.0)) for c in
             (symbols, count(bytes(range(65, 91))), count(bytes(range(48, 58))), count(PUNCTUATION))]
    echo = np.zeros(len(hashes), bool)
    echo[1:] = hashes[1:] == hashes[:-1]
    first = words_at[:-1]
    echo[first[first < len(hashes)]] = False
    share.append(np.sqrt(row_count(echo, words_at) / (n_words + 20.0)))
    return {"n_words": n_words, "word_chars": chars, "n_symbols": symbols, "n_dup_lines": dups,
            "n_repeat_words": repeat_words(hashes, words_at),
            "x": np.column_stack([np.log((chars + 110.0) / (n_words + 20.0)), *share])}


def chi2_quantile(p: float, d: int = DIM) -> float:
    """Wilson-Hilferty approximation."""
    c = 2.0 / (9.0 * d)
    return d * (1 - c + NormalDist().inv_cdf(p) * c ** 0.5) ** 3


def distance() -> Column:
    """Squared Mahalanobis distance of ``x`` from ``mu`` under ``inv`` (row-major)."""
    d = [F.col("x")[i] - F.col("mu")[i] for i in range(DIM)]
    out = F.lit(0.0)
    for i in range(DIM):
        for j in range(i, DIM):
            out = out + d[i] * d[j] * F.col("inv")[i * DIM + j] * F.lit(1.0 if i == j else 2.0)
    return out


def histogram(rows: DataFrame) -> DataFrame:
    """Per pool, start and distance bin: count, sums and sums of products of ``x``."""
    place = F.floor(F.log2(F.greatest(distance(), F.lit(1e-9))) * BINS_PER_OCTAVE).cast("int")
    bins = rows.withColumn("bin", F.greatest(F.lit(LOW_BIN), F.least(F.lit(HIGH_BIN), place)))
    sums = [F.sum(F.col("x")[i]) for i in range(DIM)]
    return bins.groupBy("pool", "start", "bin").agg(
        F.count(F.lit(1)).alias("n"), F.array(*sums).alias("sums"), products([F.col("x")[i] for i in range(DIM)]))


def meet(pooled: DataFrame, fit: DataFrame, few: int) -> DataFrame:
    """The rows of each pool with its fits.

    Up to ``few`` pools (four fits of some 400 bytes each) are broadcast. More meet their
    rows by a shuffle under salts, so that a pool with a third of all rows is spread.
    """
    if fit.select("pool").distinct().limit(few + 1).count() <= few:
        return pooled.join(F.broadcast(fit), "pool")
    salts = 64
    return (pooled.withColumn("salt", F.monotonically_increasing_id() % salts)
            .join(fit.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long")))),
                  ["pool", "salt"]).drop("salt"))


def products(x: list[Column]) -> Column:
    """Sums of the products of every two of ``x``, the upper triangle row by row."""
    return F.array(*[F.sum(x[i] * x[j]) for i in range(DIM) for j in range(i, DIM)]).alias("products")


def square(upper: np.ndarray) -> np.ndarray:
    """The symmetric matrix of an upper triangle."""
    out = np.empty((DIM, DIM))
    out[np.triu_indices(DIM)] = upper
    return np.triu(out) + np.triu(out, 1).T


def moments(bins: pd.DataFrame, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Centre and floored scatter of the rows of all bins, each bin by its weight."""
    count = (weight * bins["n"].to_numpy()).sum()
    mu = weight @ np.vstack(bins["sums"]) / count
    cov = square(weight @ np.vstack(bins["products"]) / count) - np.outer(mu, mu)
    return mu, cov + np.diag(np.square(FLOORS))


def closest(n: np.ndarray, rows: float) -> np.ndarray:
    """Weights of bins, in order, that take exactly ``rows`` rows; the last bin counts in part."""
    return np.clip((rows - (np.cumsum(n) - n)) / n, 0.0, 1.0)


def median_distance(bins: pd.DataFrame) -> float:
    n = bins["n"].to_numpy()
    weight = closest(n, 0.5 * n.sum())
    half = max(int(np.count_nonzero(weight)) - 1, 0)
    return float(2.0 ** ((bins["bin"].iloc[half] + weight[half]) / BINS_PER_OCTAVE))


def concentrate(share: float):
    """A function for the bins of one pool and start: centre, inverse scatter and log
    determinant of the closest ``share`` of its rows."""
    def work(key: tuple, bins: pd.DataFrame) -> pd.DataFrame:
        bins = bins.sort_values("bin")
        n = bins["n"].to_numpy()
        mu, cov = moments(bins, closest(n, share * n.sum()))
        return pd.DataFrame({"pool": [key[0]], "start": [key[1]], "mu": [mu.tolist()],
                             "inv": [np.linalg.inv(cov).ravel().tolist()], "logdet": [np.linalg.slogdet(cov)[1]]})
    return work


def reweigh(quantile: float):
    """As ``concentrate``, from all rows under this chi-squared quantile once the median
    distance is scaled to the chi-squared median; and that scale."""
    def work(key: tuple, bins: pd.DataFrame) -> pd.DataFrame:
        bins = bins.sort_values("bin")
        scale = median_distance(bins) / chi2_quantile(0.5)
        cut = np.log2(scale * chi2_quantile(quantile)) * BINS_PER_OCTAVE
        mu, cov = moments(bins, np.clip(cut - bins["bin"].to_numpy(), 0.0, 1.0))
        return pd.DataFrame({"pool": [key[0]], "start": [key[1]], "mu": [mu.tolist()],
                             "inv": [np.linalg.inv(cov).ravel().tolist()], "scale": [scale]})
    return work


def shortest_half(q: np.ndarray) -> tuple[float, float]:
    """Middle and width of the shortest interval with half of the rows, from equally spaced quantiles."""
    half = len(q) // 2
    width = q[half:] - q[:len(q) - half]
    k = int(width.argmin())
    return (q[k] + q[k + half]) / 2, float(width[k])


def starts(pooled: DataFrame, few: int) -> DataFrame:
    """Four deterministic starts for each pool (pool, start, mu, inv, logdet, settled).

    0: medians, spreads from quartiles. 1: middles and widths of each statistic's shortest
    half, which other rows cannot move while they are fewer than half. 2, 3: around
    these, the correlations of hyperbolic tangents and of spatial signs.
    """
    steps = 40
    quantiles = F.array(*[F.lit(k / steps) for k in range(steps + 1)])
    marks = saved(pooled.groupBy("pool").agg(F.array(*[
        F.percentile_approx(F.col("x")[i], quantiles, 1000) for i in range(DIM)]).alias("q")), "quality-quantiles")

    def both(frames):
        for frame in frames:
            out = []
            for pool, q in zip(frame["pool"], frame["q"]):
                q = np.vstack(q)
                halves = np.array([shortest_half(row) for row in q])
                for start, mid, width in ((0, q[:, steps // 2], q[:, 3 * steps // 4] - q[:, steps // 4]),
                                          (1, halves[:, 0], halves[:, 1])):
                    out.append((pool, start, mid.tolist(), np.maximum(width / 1.349, FLOORS).tolist()))
            yield pd.DataFrame(out, columns=["pool", "start", "mu", "spread"])

    plain = saved(marks.mapInPandas(both, "pool string, start int, mu array<double>, spread array<double>"),
                  "quality-starts")
    halves = plain.where("start = 1")
    z = [(F.col("x")[i] - F.col("mu")[i]) / F.col("spread")[i] for i in range(DIM)]
    scaled = meet(pooled, halves, few).select("pool", F.array(*z).alias("z"))
    norm = F.sqrt(F.aggregate("z", F.lit(1e-12), lambda a, v: a + v * v))
    bent = {2: [F.tanh(F.col("z")[i]) for i in range(DIM)], 3: [F.col("z")[i] / F.col("norm") for i in range(DIM)]}
    sums = scaled.withColumn("norm", norm).groupBy("pool").agg(
        *[products(x).alias(f"products_{start}") for start, x in bent.items()])
    names = tuple(bent)
    told = sums.join(halves, "pool").select("pool", "mu", "spread", *[f"products_{k}" for k in names])

    def shaped(frames):
        for frame in frames:
            out = []
            for pool, mu, spread, *found in frame.itertuples(index=False):
                for start, upper in zip(names, found):
                    cross = square(np.asarray(upper)) + 1e-9 * np.eye(DIM)
                    side = np.asarray(spread) / np.sqrt(np.diag(cross))
                    cov = cross * np.outer(side, side) + np.diag(np.square(FLOORS))
                    out.append((pool, start, list(mu), np.linalg.inv(cov).ravel().tolist()))
            yield pd.DataFrame(out, columns=["pool", "start", "mu", "inv"])

    diagonal = [1 / (F.col("spread")[i] * F.col("spread")[i]) if i == j else F.lit(0.0)
                for i in range(DIM) for j in range(DIM)]
    made = plain.select("pool", "start", "mu", F.array(*diagonal).alias("inv")).unionByName(
        told.mapInPandas(shaped, "pool string, start int, mu array<double>, inv array<double>"))
    return saved(made.select("*", F.lit(float("inf")).alias("logdet"), F.lit(False).alias("settled")), "quality-fit")


def least_determinant(pooled: DataFrame, share: float, max_steps: int, tolerance: float,
                      few: int = 2000) -> DataFrame:
    """Per pool the fit (pool, start, mu, inv) of least determinant, over all starts.

    With the floors added to the scatter a step still never raises the determinant (its
    logarithm is concave); a start is left alone once a step lowers it by less than
    ``tolerance``.
    """
    fit = starts(pooled, few)
    for _ in range(max_steps):
        moving = fit.where(~F.col("settled"))
        bins = histogram(meet(pooled, moving, few))
        new = bins.groupBy("pool", "start").applyInPandas(
            concentrate(share), "pool string, start int, mu array<double>, inv array<double>, logdet double")
        new = new.select("pool", "start", F.struct("mu", "inv", "logdet").alias("new"))
        lower = F.col("new.logdet") < F.col("logdet")
        moved = moving.join(new, ["pool", "start"]).select(
            "pool", "start", *[F.when(lower, F.col(f"new.{c}")).otherwise(F.col(c)).alias(c) for c in ("mu", "inv", "logdet")],
            (F.col("logdet") - F.col("new.logdet") < tolerance).alias("settled"))
        fit = saved(fit.where("settled").unionByName(moved), "quality-fit")
        if fit.where(~F.col("settled")).isEmpty():
            break
    best = fit.groupBy("pool").agg(F.min_by(F.struct("start", "mu", "inv"), F.struct("logdet", "start")).alias("best"))
    return best.select("pool", "best.*")


def pools(scored: DataFrame, min_rows: int) -> tuple[DataFrame, DataFrame]:
    """For each language and source the pools its rows help to estimate, and the one they are
    judged in: their own group; if that is small all rows of the language; if that is
    small all rows; none if there are too few in all."""
    groups = scored.groupBy("lang", "source").agg(F.count(F.lit(1)).alias("n"))
    langs = (groups.groupBy("lang").agg(F.sum("n").alias("lang_n"), F.min("n").alias("least_n"))
             .withColumnRenamed("lang", "of_lang"))
    total, least_lang = langs.agg(F.coalesce(F.sum("lang_n"), F.lit(0)), F.min("lang_n")).first()
    none = F.lit(None).cast("string")

    def pool(level: int, lang: Column, source: Column) -> Column:
        return F.to_json(F.struct(F.lit(level).alias("level"), lang.alias("lang"), source.alias("source")))

    own, lang, every = pool(0, F.col("lang"), F.col("source")), pool(1, F.col("lang"), none), pool(2, none, none)
    enough = F.lit(total >= min_rows)
    told = groups.join(langs, F.col("lang").eqNullSafe(F.col("of_lang"))).select(
        F.col("lang").alias("pool_lang"), F.col("source").alias("pool_source"),
        F.when(F.col("n") >= min_rows, own).when(F.col("lang_n") >= min_rows, lang).when(enough, every).alias("pool"),
        F.array_compact(F.array(
            F.when(F.col("n") >= min_rows, own),
            F.when((F.col("lang_n") >= min_rows) & (F.col("least_n") < min_rows), lang),
            F.when(enough & F.lit(least_lang is not None and least_lang < min_rows), every))).alias("helps"))
    told = saved(told, "quality-pools")
    return (told.select("pool_lang", "pool_source", F.explode("helps").alias("pool")),
            told.where("pool IS NOT NULL").select("pool_lang", "pool_source", "pool"))


def quality_rules(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                  source_col: str = "source", columns: list[str] | None = None, min_words: int = 10,
                  max_repeat_percent: int = 20, subset: float = 0.5, max_steps: int = 40,
                  tolerance: float = 1e-3, min_rows: int = 100, max_distance: float = 120.0,
                  few: int = 2000) -> DataFrame:
    """Measures of every document and whether it is kept.

    Returns ``columns`` (default: all of the input's) and ``n_words``,
    ``word_chars``, ``n_symbols``, ``n_dup_lines``, ``n_repeat_words``,
    ``distance`` (squared, scaled; NULL in a table with too few rows),
    ``base_failed`` and ``kept``; input columns of these names are replaced.
    A document fails the base rules with fewer than ``min_words`` words or
    more than ``max_repeat_percent`` of them in repeated five-word windows;
    of the others, those whose squared distance from their group's centre is
    over ``max_distance`` are rejected. Distances are scaled so that their
    median in a group is the chi-squared median; the limit is far in the tail
    because the statistics of good text are not normal. A group with fewer
    than ``min_rows`` such documents is judged by the estimate for all rows of
    its language, and a language with fewer by the estimate for all rows; if
    these are fewer, the base rules alone decide. An estimate withstands junk
    in just under half of its rows (``1 - subset``). Estimates of up to ``few``
    groups are broadcast, those of more are shuffled; results are the same.

    A NULL text has no words. NULL languages or sources are groups of their
    own. Rows repeat as given. An empty table gives an empty result.
    """
    names = list(docs.columns) if columns is None else list(columns)
    # a text travels once, beside its row
    beside = [text_col] if docs.schema[text_col].dataType == StringType() else []
    back = text_col in names and bool(beside)
    base = docs.select(packed(docs.select([quoted(c) for c in names]), beside).alias("row"),
                       quoted(lang_col).cast("string").alias("lang"),
                       quoted(source_col).cast("string").alias("source"),
                       quoted(text_col).cast("string").alias("text"))

    def work(batches):
        for part, data, offsets in text_chunks(batches, "text"):
            m = measure(data, offsets)
            x = pa.ListArray.from_arrays(pa.array(np.arange(0, DIM * part.num_rows + 1, DIM), pa.int32()),
                                         pa.array(m.pop("x").ravel()))
            yield pa.RecordBatch.from_arrays(
                [part.column(i) for i in range(3 + back)] + [pa.array(m[k], pa.int64()) for k in MEASURES] + [x],
                names=["row", "lang", "source", *["text"] * back, *MEASURES, "x"])

    ddl = ", ".join(f"{k} long" for k in MEASURES)
    schema = base.select("row", "lang", "source", *["text"] * back).schema
    for field in base.sparkSession.createDataFrame([], ddl + ", x array<double>").schema:
        schema.add(field)
    rows = base.mapInArrow(tidy(work), schema)
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat_percent * F.col("n_words"))
    rows = saved(rows.withColumn("base_failed", failed), "quality-measures")
    scored = rows.where(~F.col("base_failed")).select("lang", "source", "x")
    helps, judge = pools(scored, min_rows)
    match = F.col("lang").eqNullSafe(F.col("pool_lang")) & F.col("source").eqNullSafe(F.col("pool_source"))
    pooled = saved(scored.join(helps, match).select("pool", "x"), "quality-pooled")
    fit = saved(least_determinant(pooled, subset, max_steps, tolerance, few), "quality-fit")
    kind = "pool string, start int, mu array<double>, inv array<double>, scale double"
    for _ in range(2):  # all rows that are not far; then the scale of what came out
        bins = histogram(meet(pooled, fit.select("pool", "start", "mu", "inv"), few))
        last, fit = fit, saved(bins.groupBy("pool", "start").applyInPandas(reweigh(0.975), kind), "quality-fit")
    judged = saved(judge.join(last.drop("scale"), "pool").join(fit.select("pool", "scale"), "pool")
                   .select("pool_lang", "pool_source", "mu", "inv", "scale"), "quality-fit")
    out = rows.join(judged, match & ~F.col("base_failed"), "left").withColumn("distance", distance() / F.col("scale"))
    kept = ~F.col("base_failed") & F.coalesce(F.col("distance") <= max_distance, F.lit(True))
    made = [*MEASURES, "distance", "base_failed"]
    given = {k: F.col(k) for k in made} | {"kept": kept}
    order = [c for c in names if c not in given] + list(given)
    return out.select(unpacked(out, order, ({text_col: F.col("text")} if back else {}) | given))
