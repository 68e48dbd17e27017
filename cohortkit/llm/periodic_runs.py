"""Periodic runs of words, by a dictionary of basic factors.

The basic factors of a text are its stretches of 2**k words. Each level
names them: equal stretches of a text get equal numbers, and a stretch of
twice the length is named by the numbers of its halves. Where a factor of
length L occurs again d <= L words later and nowhere between, L + d words
have period d, and no smaller one. Such positions that follow one another
with the same d are an arithmetic progression that covers one run, from its
first position to L + d words after its last: had the run a neighbouring
word more, that position would belong to the progression too.

Level L proposes the periods in (L/2, L]; those up to twice its length are
proposed by the next level, whose factors are a period long at least. A run of
smallest period q and three periods or more always shows on the first level
with L >= q: its first factor occurs again q words on, L + q < 3q words in all.
So every such run is found once. Factors that occur once in a text are
forgotten, so later levels see little of ordinary text.
"""

from __future__ import annotations

from collections import defaultdict
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortkit.llm.byte_words import SPACED, numbered, word_pieces
from cohortkit.llm.common import packed, quoted, text_chunks, unpacked

RUN = "struct<start:long,length:long,period:long>"


def progressions(pos: np.ndarray, gap: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First and last position and gap of the stretches of consecutive positions with one gap."""
    order = np.lexsort((pos, gap))
    pos, gap = pos[order], gap[order]
    new = np.ones(len(pos), bool)
    new[1:] = (gap[1:] != gap[:-1]) | (pos[1:] != pos[:-1] + 1)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(pos)) - 1
    return pos[first], pos[last], gap[first]


def periodic_runs(ids: np.ndarray, offsets: np.ndarray, min_length: int = 24,
                  min_periods: int = 3) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, length and smallest period of all maximal runs, by start, then period.

    ``ids`` are the words of all texts, ``offsets`` where each text starts.
    A run has ``max(min_length, min_periods * period)`` words at least
    (``min_periods`` of three or more). Starts are positions in ``ids``.
    """
    if min_periods < 3:
        raise ValueError("min_periods must be 3 or more")
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    doc = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    pos = np.arange(len(ids))
    key = doc * (int(ids.max()) + 1 if len(ids) else 1) + ids
    full = np.full(len(ids), -1, np.int64)  # name of the factor at a position, -1: occurs once
    named = pos[:0]
    length = 1
    while len(pos):
        order = np.argsort(key, kind="stable")
        at, sorted_key = pos[order], key[order]
        same = sorted_key[1:] == sorted_key[:-1]
        gap = at[1:] - at[:-1]
        near = same & (gap <= length) & (2 * gap > length)
        if near.any():
            first, last, period = progressions(at[:-1][near], gap[near])
            size = last + length + period - first
            long = size >= np.maximum(min_length, min_periods * period)
            if long.any():
                found.append((first[long], size[long], period[long]))
        again = np.zeros(len(at), bool)
        again[1:] = same
        again[:-1] |= same
        name = np.zeros(len(at), np.int64)
        name[1:] = np.cumsum(~same)
        full[named] = -1
        named = at[again]
        full[named] = name[again]
        pos = np.sort(named)
        pos = pos[pos + length < len(ids)]
        pos = pos[(full[pos + length] >= 0) & (doc[pos] == doc[pos + length])]
        key = full[pos] * np.int64(len(at) + 1) + full[pos + length]
        length *= 2
    if not found:
        none = np.zeros(0, np.int64)
        return none, none, none
    start, size, period = (np.concatenate(x) for x in zip(*found))
    order = np.lexsort((period, start))
    return start[order], size[order], period[order]


def collapse_runs(docs: DataFrame, *, text_col: str = "text", columns: list[str] | None = None,
                  min_length: int = 24, min_periods: int = 3) -> DataFrame:
    """The periodic runs of every text, and the text with each run's first period only.

    Words are the runs of ``[^\\x20\\x09-\\x0D]``, numbered from 0. A run is a
    stretch of words in which words one period apart are equal, its period is
    the smallest such, and no neighbouring word extends it. Returns
    ``columns`` (default: all of the input's) and ``n_words``, ``runs`` (start,
    length and period, by start, then period) and ``collapsed``: the words in no
    run beyond its first period, joined by one space; input columns of these
    names are replaced.

    A NULL text, an empty one and one of white space have no words, no runs and
    an empty ``collapsed``. Rows repeat as given, in any order; an empty table
    gives an empty result. One pass without a shuffle; a text of any length is
    worked on whole, at about a hundred bytes of memory a word at most.
    """
    names = list(docs.columns) if columns is None else list(columns)
    base = docs.select(packed(docs.select([quoted(c) for c in names])).alias("row"),
                       quoted(text_col).cast("string").alias("text"))

    def work(batches):
        for part, data, offsets in text_chunks(batches, "text"):
            ids, at = numbered(data, offsets, SPACED, defaultdict(count().__next__).__getitem__)
            start, size, period = periodic_runs(ids, at, min_length, min_periods)
            runs_at = np.searchsorted(start, at)
            edge = np.zeros(len(ids) + 1, np.int64)
            np.add.at(edge, start + period, 1)
            np.add.at(edge, start + size, -1)
            keep = np.cumsum(edge[:-1]) == 0
            texts = []
            ends = offsets.tolist()
            for i, (a, b) in enumerate(zip(ends, ends[1:])):
                kept, seen = [], int(at[i])
                whole = runs_at[i] == runs_at[i + 1]
                for words in word_pieces(data[a:b].tobytes(), SPACED):
                    if not whole:
                        stays = keep[seen:seen + len(words)]
                        words = [words[j] for j in np.flatnonzero(stays)] if not stays.all() else words
                        seen += len(stays)
                    if words:
                        kept.append(b" ".join(words))
                texts.append(b" ".join(kept))
            own = np.repeat(at[:-1], np.diff(runs_at))
            runs = pa.ListArray.from_arrays(
                pa.array(runs_at, pa.int32()),
                pa.StructArray.from_arrays([pa.array(x, pa.int64()) for x in (start - own, size, period)],
                                           names=["start", "length", "period"]))
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(np.diff(at), pa.int64()), runs,
                 pa.array(texts, pa.binary()).cast(pa.string())], names=["row", "n_words", "runs", "collapsed"])

    schema = base.select("row").schema
    for field in base.sparkSession.createDataFrame([], f"n_words long, runs array<{RUN}>, collapsed string").schema:
        schema.add(field)
    out = base.mapInArrow(work, schema)
    given = {k: F.col(k) for k in ("n_words", "runs", "collapsed")}
    return out.select(unpacked(out, [c for c in names if c not in given] + list(given), given))
