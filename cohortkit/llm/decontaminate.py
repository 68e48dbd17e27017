"""Benchmark decontamination by a generalised suffix automaton of the test items.

The items' words are numbered and read into an automaton. A text's words are
streamed through it: after each word it knows the longest stretch of any
item that the text has just spelt. A stretch of a window's length or more is
a hit, and the automaton's states tell which items have that window. Only
stretches of words whose neighbours also are neighbours in some item are
streamed, since a match of two words or more can lie nowhere else; numpy
finds them.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortkit.llm.byte_words import ALNUM, numbered, word_pieces
from cohortkit.llm.common import packed, quoted, saved, text_chunks, unpacked
from cohortkit.llm.suffix_automaton import SuffixAutomaton

WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+")
#: Words of an item that are read into the automaton in one piece; pieces overlap by a window.
ITEM_PIECE = 10_000
MADE = ("n_words", "n_hit", "longest", "items", "spans", "contaminated", "rejected")


class Items:
    """The automaton of some items, and which windows end in its states."""

    def __init__(self, items: Sequence[tuple[str | None, Sequence[bytes]]], window: int):
        self.window = window
        self.vocabulary: dict[bytes, int] = {}
        sequences = [[self.vocabulary.setdefault(w, len(self.vocabulary)) for w in words] for _, words in items]
        self.automaton = SuffixAutomaton(sequences)
        self.owners: dict[int, set[str]] = {}  # state of a whole window -> ids of items
        self.short: dict[int, dict[int, set[str]]] = {}  # state -> length of a shorter window -> ids
        self.least = min([window] + [len(s) for s in sequences if s])
        pairs: set[int] = set()
        for (item, _), sequence in zip(items, sequences):
            pairs.update(a * len(self.vocabulary) + b for a, b in zip(sequence, sequence[1:]))
            state = matched = 0
            for i, symbol in enumerate(sequence):
                state, matched = self.automaton.advance(state, matched, symbol)
                if i + 1 >= window:
                    owners = self.owners.setdefault(self.automaton.holder(state, window), set())
                    owners.update([item] if item is not None else [])
            if 0 < len(sequence) < window:
                here = self.short.setdefault(self.automaton.holder(state, len(sequence)), {})
                here.setdefault(len(sequence), set()).update([item] if item is not None else [])
        self.pairs = np.array(sorted(pairs), np.int64)

    def number(self, word: bytes) -> int:
        return self.vocabulary.get(word, -1)

    def stretches(self, ids: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts and ends of what is worth streaming: ``least`` words or more, all known,
        neighbours known as such, within one text."""
        joined = np.zeros(len(ids) + 1, bool)  # joined[i]: word i - 1 goes on at word i
        if len(ids) > 1 and len(self.pairs):
            key = ids[:-1] * len(self.vocabulary) + ids[1:]
            place = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
            joined[1:-1] = (self.pairs[place] == key) & (ids[:-1] >= 0) & (ids[1:] >= 0)
        joined[offsets] = False
        known = ids >= 0
        starts, ends = np.flatnonzero(known & ~joined[:-1]), np.flatnonzero(known & ~joined[1:]) + 1
        long = ends - starts >= self.least
        return starts[long], ends[long]

    def stream(self, ids: list[int], at: int, spans: list[list[int]], found: set[str]) -> int:
        """Add the hits of one stretch that starts at word ``at``; the longest match with a window in it."""
        automaton, state, matched, longest = self.automaton, 0, 0, 0
        for i, symbol in enumerate(ids, at + 1):
            state, matched = automaton.advance(state, matched, symbol)
            covered = 0
            behind = state
            if matched >= self.window:
                covered = matched
                behind = automaton.holder(state, self.window)
                found |= self.owners[behind]
            while self.short and behind > 0:
                for n, items in self.short.get(behind, {}).items():
                    if n <= matched:
                        covered = max(covered, n)
                        found |= items
                behind = automaton.link[behind]
            if covered:
                longest = max(longest, covered)
                first = i - covered
                while spans and spans[-1][1] >= first:
                    first = min(first, spans.pop()[0])
                spans.append([first, i])
        return longest


def merged(spans: list[list[int]]) -> list[list[int]]:
    out: list[list[int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return out


def without(text: bytes, spans: list[list[int]]) -> bytes:
    """The text without the words of the spans and what is between them."""
    kept, at, word = [], 0, 0
    places = WORD.finditer(text)
    for start, end in spans:
        for place in places:
            if word == start:
                kept.append(text[at:place.start()])
            word += 1
            if word == end:
                at = place.end()
                break
    return b"".join(kept) + text[at:]


def item_pieces(items: DataFrame, id_col: str, text_col: str, window: int) -> DataFrame:
    """Item ids as strings with their words, in overlapping pieces of bounded length."""
    def work(batches):
        for batch in batches:
            ids, pieces, sizes = [], [], []
            for item, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                words = [w for part in word_pieces((text.as_py() or "").encode(), ALNUM) for w in part]
                for at in range(0, max(len(words) - window + 1, min(len(words), 1)), ITEM_PIECE):
                    piece = words[at:at + ITEM_PIECE + window - 1]
                    ids.append(item)
                    pieces.append(b" ".join(piece))
                    sizes.append(len(piece))
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.string()), pa.array(pieces, pa.binary()),
                                              pa.array(sizes, pa.int64())], names=["item", "words", "n"])

    picked = items.select(quoted(id_col).cast("string").alias("item"), quoted(text_col).cast("string").alias("text"))
    return picked.mapInArrow(work, "item string, words binary, n long")


def decontaminate(docs: DataFrame, items: DataFrame, *, text_col: str = "text", item_id: str = "item_id",
                  item_text: str = "text", columns: list[str] | None = None, window: int = 10,
                  max_coverage: float = 0.5, shard_words: int = 200_000) -> DataFrame:
    """Find and remove what texts share with test items.

    Words are the runs of letters a-z, digits and all characters beyond
    ASCII, after lower-casing A-Z. ``window`` consecutive words of an item
    found in a text are a hit, as are all words of an item of fewer. Returns
    ``columns`` (default: all of the input's), the text without the hit spans
    if it is among them, then ``n_words``, ``n_hit`` (words in hits),
    ``longest`` (words of the longest match, 0 without a hit; an item of over
    10,000 words is read in overlapping pieces, so a longer match counts as
    that), ``items`` (ids of the items hit, as strings, sorted), ``spans``
    (first word and end of each stretch of hit words), ``contaminated`` and
    ``rejected`` (over ``max_coverage`` of the words are hit); input columns of
    these names are replaced.

    A NULL or empty text has no words and no hits; a NULL text stays NULL. An
    item without words hits nothing; one without an id counts as a hit but is
    not listed; rows that repeat an item id are one item when listed. Rows
    repeat as given. Empty tables give no rows, or no hits.

    The items come to the driver in shards of about ``shard_words`` words, whose
    automaton is broadcast; each shard is one pass over the texts, without a
    shuffle, and results don't depend on the shards.
    """
    names = list(docs.columns) if columns is None else list(columns)
    base = docs.select(packed(docs.select([quoted(c) for c in names if c != text_col])).alias("row"),
                       quoted(text_col).cast("string").alias("text"),
                       F.lit(None).cast("array<struct<start:long,end:long>>").alias("spans"),
                       F.lit(None).cast("array<string>").alias("items"),
                       F.lit(0).cast("long").alias("longest"), F.lit(0).cast("long").alias("n_words"))
    spark = docs.sparkSession
    pieces = saved(item_pieces(items, item_id, item_text, window), "benchmark-items")
    total = pieces.agg(F.sum("n")).first()[0] or 0
    shards = max(1, -(-total // shard_words))
    dealt = pieces.withColumn("shard", F.pmod(F.xxhash64("words"), F.lit(shards)))
    out = base
    for shard in range(shards):
        rows = dealt.where(F.col("shard") == shard).groupBy("item", "words").count().collect()  # one shard: bounded
        known = spark.sparkContext.broadcast(Items([(r["item"], bytes(r["words"]).split()) for r in rows], window))
        out = out.mapInArrow(_scan(known), base.schema)
        if shard + 1 < shards:
            out = saved(out, "decontaminate-shard")
    done = out.mapInArrow(_cut, base.schema) if text_col in names else out
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    given = {c: F.col(c) for c in ("n_words", "longest", "spans")} | {
        "n_hit": F.coalesce(hit, F.lit(0).cast("long")),
        "items": F.coalesce(F.sort_array("items"), F.array().cast("array<string>")),
        "spans": F.coalesce("spans", F.array().cast("array<struct<start:long,end:long>>"))}
    given["contaminated"] = given["n_hit"] > 0
    given["rejected"] = given["n_hit"] > F.lit(max_coverage) * F.col("n_words")
    given = {text_col: F.col("text")} | {k: given[k] for k in MADE}
    return done.select(unpacked(done, [c for c in names if c not in MADE] + list(MADE), given))


def _scan(known):
    """One pass: the hits of one shard of items are added to those found before."""
    def work(batches):
        items: Items = known.value
        for part, data, offsets in text_chunks(batches, "text"):
            ids, at = numbered(data, offsets, ALNUM, items.number)
            spans: dict[int, list[list[int]]] = {}
            found: dict[int, set[str]] = {}
            longest = part.column(4).to_numpy(zero_copy_only=False).copy()
            starts, ends = items.stretches(ids, at)
            owner = np.searchsorted(at, starts, side="right") - 1
            for i, a, b in zip(owner.tolist(), starts.tolist(), ends.tolist()):
                own, names = spans.get(i, []), found.get(i, set())
                best = items.stream(ids[a:b].tolist(), a - int(at[i]), own, names)
                if best:
                    spans[i], found[i] = own, names
                    longest[i] = max(longest[i], best)
            old_spans, old_items = part.column(2), part.column(3)
            if spans or old_spans.null_count < len(old_spans):
                all_spans, all_items = [], []
                for i in range(part.num_rows):
                    before = [[s["start"], s["end"]] for s in old_spans[i].as_py() or []]
                    both = merged(before + spans.get(i, []))
                    all_spans.append([{"start": a, "end": b} for a, b in both] or None)
                    all_items.append(sorted(set(old_items[i].as_py() or []) | found.get(i, set())) or None)
                old_spans = pa.array(all_spans, old_spans.type)
                old_items = pa.array(all_items, old_items.type)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), old_spans, old_items, pa.array(longest, pa.int64()),
                 pa.array(np.diff(at), pa.int64())], schema=part.schema)
    return work


def _cut(batches):
    """Hit spans leave the texts."""
    for batch in batches:
        spans = batch.column(2)
        if spans.null_count < len(spans):
            texts = [t.as_py() if not s.is_valid else
                     without(t.as_py().encode(), [[x["start"], x["end"]] for x in s.as_py()]).decode()
                     for t, s in zip(batch.column(1), spans)]
            batch = batch.set_column(1, batch.schema.field(1), pa.array(texts, batch.schema.field(1).type))
        yield batch
