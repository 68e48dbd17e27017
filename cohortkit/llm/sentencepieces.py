"""SentencePiece encoding and decoding with batched numpy.

A text is cut into words that no piece reaches across; each distinct word
of a batch is segmented once, all words of equal length together. Hashes of
all substrings are looked up in the sorted hashes of the vocabulary's
pieces. The Viterbi search then goes position by position through all words
of the length at once: the best score of each prefix is a maximum over the
pieces that end there, and the piece taken is stored as the way back.

A ``unigram`` model is defined by that search. A ``bpe`` model is defined
by the order of its merges, which the best total score follows for most
words but not for all; there the batch is merged too (in each step the best
pair of every word at once) and the merges decide.
"""

from __future__ import annotations

import functools
import heapq
import os
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from cohortkit.llm.common import packed, quoted, unpacked
from cohortkit.llm.words import mix

SPACE = "▁"
_ODD = 0x9E3779B97F4A7C15
NEVER = -1e30
#: An unknown character costs this much more than the worst piece.
UNKNOWN_COST = 10.0
LONG_WORD = 64
#: High bits of a hash by which most substrings are told from all pieces without a search.
NEAR_BITS = 20
#: Characters of a long word whose substrings are hashed at once.
WINDOW = 1 << 14
CELLS = 1 << 21


@dataclass
class Vocabulary:
    """What encoding needs of a model file, as plain arrays."""

    kind: str  # "unigram" or "bpe"
    pieces: list[str]
    scores: np.ndarray
    keys: np.ndarray  # sorted hashes of the normal pieces
    key_ids: np.ndarray
    bytes_at: int | None  # id of the piece for byte 0
    unknown: int
    dummy_prefix: bool
    split: str  # pattern of the words
    near: np.ndarray  # by the high bits of a hash: whether any piece has these

    @classmethod
    def load(cls, path: str) -> "Vocabulary":
        """Reads the file with the library; segmentation itself is done here."""
        from sentencepiece import SentencePieceProcessor
        from sentencepiece import sentencepiece_model_pb2 as messages

        with open(path, "rb") as f:
            raw = f.read()
        model = messages.ModelProto()
        model.ParseFromString(raw)
        rules = model.normalizer_spec
        if rules.precompiled_charsmap or rules.remove_extra_whitespaces or not rules.escape_whitespaces \
                or model.trainer_spec.treat_whitespace_as_suffix:
            raise ValueError("only models that keep the text as it is are supported")
        kind = {1: "unigram", 2: "bpe"}.get(model.trainer_spec.model_type)
        if kind is None:
            raise ValueError("only unigram and BPE models are supported")
        sp = SentencePieceProcessor(model_proto=raw)
        n = sp.get_piece_size()
        pieces = [sp.id_to_piece(i) for i in range(n)]
        normal = [i for i in range(n) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))]
        if any(SPACE in pieces[i].lstrip(SPACE) for i in normal):
            raise ValueError("pieces that reach across words are not supported")
        keys = piece_keys([pieces[i] for i in normal])
        near = np.zeros(1 << NEAR_BITS, bool)
        near[keys >> np.uint64(64 - NEAR_BITS)] = True
        order = np.argsort(keys)
        at = next((i for i in range(n) if sp.is_byte(i)), None)
        # a line feed that is in no piece ends a word as well
        feed = "" if any("\n" in pieces[i] for i in normal) else "\n"
        return cls(kind, pieces, np.array([sp.get_score(i) for i in range(n)]), keys[order],
                   np.array(normal, np.int64)[order], at, sp.unk_id(), bool(rules.add_dummy_prefix),
                   f"{SPACE}*[^{SPACE}{feed}]+|{SPACE}+" + (f"|{feed}" if feed else ""), near)

    @property
    def longest(self) -> int:
        return max((len(self.pieces[i]) for i in self.key_ids), default=1)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Ids of the pieces with these hashes, -1 where there is none."""
        out = np.full(keys.shape, -1, np.int32)
        maybe = np.flatnonzero(self.near[(keys >> np.uint64(64 - NEAR_BITS)).ravel()])
        asked = keys.ravel()[maybe]
        at = np.minimum(np.searchsorted(self.keys, asked), len(self.keys) - 1)
        hit = self.keys[at] == asked
        out.ravel()[maybe[hit]] = self.key_ids[at[hit]]
        return out


def piece_keys(pieces: list[str]) -> np.ndarray:
    """The hash of each piece, all of one length together."""
    out = np.zeros(len(pieces), np.uint64)
    sizes = np.array([len(p) for p in pieces])
    for n in np.unique(sizes[sizes > 0]).tolist():
        at = np.flatnonzero(sizes == n)
        out[at] = span_keys(codes_of([pieces[i] for i in at]), n)[:, 0, n - 1]
    return out


def span_keys(codes: np.ndarray, longest: int) -> np.ndarray:
    """Hashes of all substrings of rows of equal length: [row, start, length - 1]
    (what would reach over the end is 0)."""
    rows, n = codes.shape
    value = mix(codes + np.uint64(0x51ED270B))
    out = np.zeros((rows, n, min(longest, n)), np.uint64)
    acc = np.zeros((rows, n), np.uint64)
    for k in range(out.shape[2]):
        acc = acc[:, :n - k] * np.uint64(_ODD) + value[:, k:]
        key = acc + np.uint64((k + 1) * 0xD6E8FEB86659FD93 & (1 << 64) - 1)
        out[:, :n - k, k] = (key ^ (key >> np.uint64(32))) * np.uint64(0xBF58476D1CE4E5B9)
    return out


def codes_of(words: list[str]) -> np.ndarray:
    """Code points of words of one length, a row each."""
    return np.frombuffer("".join(words).encode("utf-32-le"), "<u4").reshape(len(words), -1).astype(np.uint64)


def viterbi(ids: np.ndarray, scores: np.ndarray, unknown_score: float) -> np.ndarray:
    """Length of the last piece of the best segmentation of every prefix: [word, end].

    ``ids``: the piece of each substring as in ``span_keys``, -1 if none. A
    single character without a piece costs ``unknown_score``. Of equal
    totals the longest last piece is taken.
    """
    rows, n, longest = ids.shape
    best = np.full((rows, n + 1), NEVER)
    best[:, 0] = 0.0
    back = np.ones((rows, n + 1), np.int64)
    for end in range(1, n + 1):
        lengths = np.arange(1, min(longest, end) + 1)
        found = ids[:, end - lengths, lengths - 1]
        value = np.where(found >= 0, scores[found], NEVER)
        value[:, 0] = np.where(found[:, 0] >= 0, value[:, 0], unknown_score)
        total = best[:, end - lengths] + value
        pick = total.shape[1] - 1 - total[:, ::-1].argmax(axis=1)
        back[:, end] = lengths[pick]
        best[:, end] = np.take_along_axis(total, pick[:, None], 1)[:, 0]
    return back


def boundaries(back: np.ndarray) -> np.ndarray:
    """Where pieces begin, followed from the end through the ways back: bool [word, position]."""
    rows, width = back.shape
    starts = np.zeros((rows, width - 1), bool)
    at = np.full(rows, width - 1)
    live = np.arange(rows)
    while len(live):
        at[live] -= back[live, at[live]]
        starts[live, at[live]] = True
        live = live[at[live] > 0]
    return starts


def merge_order(ids: np.ndarray, scores: np.ndarray) -> np.ndarray:
    """Where pieces begin when the best adjacent pair is merged until none is left, in all words at once."""
    rows, n, longest = ids.shape
    value = np.where(ids >= 0, scores[ids], -np.inf)
    out = np.ones((rows, n), bool)
    live = np.arange(rows)
    position = np.arange(n)
    while len(live):
        starts = out[live]
        # the start after each position, and the one after that
        ahead = np.where(starts, position, n)
        after = np.concatenate([np.minimum.accumulate(ahead[:, ::-1], axis=1)[:, ::-1][:, 1:],
                                np.full((len(live), 2), n)], axis=1)  # [i] = first start > i; [n] = n
        second = np.take_along_axis(after, after[:, :n], 1)
        size = second - position
        fits = starts & (after[:, :n] < n) & (size <= longest)
        gain = np.where(fits, value[live[:, None], position, np.minimum(size, longest) - 1], -np.inf)
        pick = gain.argmax(axis=1)
        row = np.arange(len(live))
        go = gain[row, pick] > -np.inf
        out[live[go], after[row[go], pick[go]]] = False
        live = live[go]
    return out


def merge_long(ids: np.ndarray, scores: np.ndarray) -> np.ndarray:
    """``merge_order`` for one long word, with a heap of pairs."""
    _, n, longest = ids.shape
    ids = ids[0]
    end, before, alive = list(range(1, n + 1)), list(range(-1, n - 1)), [True] * n
    heap: list[tuple[float, int, int]] = []

    def offer(start: int) -> None:
        if 0 <= start and end[start] < n:
            stop = end[end[start]]
            if stop - start <= longest and (found := ids[start, stop - start - 1]) >= 0:
                heapq.heappush(heap, (-scores[found], start, stop))

    for i in range(n):
        offer(i)
    while heap:
        _, start, stop = heapq.heappop(heap)
        if not alive[start] or end[start] >= n or end[end[start]] != stop:
            continue  # one of the two has merged with another since
        gone = end[start]
        alive[gone] = False
        end[start] = stop
        if stop < n:
            before[stop] = start
        offer(before[start])
        offer(start)
    return np.array(alive)[None, :]


class Encoder:
    """Encodes words of a vocabulary; remembers those it has met, up to a limit."""

    def __init__(self, vocabulary: Vocabulary, limit: int = 2_000_000):
        self.v, self.limit = vocabulary, limit
        self.known: dict[str, bytes] = {}
        self.longest = vocabulary.longest
        normal = vocabulary.scores[vocabulary.key_ids]
        self.unknown_score = float(normal.min()) - UNKNOWN_COST
        self.pattern = re.compile(vocabulary.split)

    def words(self, text: str) -> list[str]:
        if not text:
            return []
        text = text.replace(" ", SPACE)
        return self.pattern.findall(SPACE + text if self.v.dummy_prefix else text)

    def learn(self, words: set[str]) -> None:
        new = [w for w in words if w not in self.known]
        if len(new) + len(self.known) > self.limit:
            self.known.clear()
            new = list(words)
        by_length: dict[int, list[str]] = {}
        for w in new:
            by_length.setdefault(len(w), []).append(w)
        for n, group in by_length.items():
            step = max(1, CELLS // (n * min(n, self.longest))) if n <= LONG_WORD else 1
            for i in range(0, len(group), step):
                self._segment(group[i:i + step], n)

    def spans(self, codes: np.ndarray) -> np.ndarray:
        """The piece of each substring, -1 if none; rows that are long in overlapping windows."""
        n, longest = codes.shape[1], min(self.longest, codes.shape[1])
        if n <= WINDOW:
            return self.v.find(span_keys(codes, longest))
        out = np.full((len(codes), n, longest), -1, np.int32)
        for a in range(0, n, WINDOW):
            ids = self.v.find(span_keys(codes[:, a:a + WINDOW + longest - 1], longest))
            out[:, a:a + WINDOW, :ids.shape[2]] = ids[:, :WINDOW]
        return out

    def starts(self, ids: np.ndarray) -> np.ndarray:
        """Where the pieces of words begin; ``ids`` as in ``viterbi``."""
        if self.v.kind == "bpe" and ids.shape[1] > LONG_WORD:
            return merge_long(ids, self.v.scores)
        starts = boundaries(viterbi(ids, self.v.scores, self.unknown_score))
        if self.v.kind == "bpe":
            merged = merge_order(ids, self.v.scores)
            differ = (merged != starts).any(axis=1)
            starts[differ] = merged[differ]
        return starts

    def _segment(self, words: list[str], n: int) -> None:
        ids = self.spans(codes_of(words))
        starts = self.starts(ids)
        row, at = np.nonzero(starts)
        following = np.append(at[1:], n)
        size = np.where(following > at, following, n) - at
        found = ids[row, at, np.minimum(size, ids.shape[2]) - 1]
        ends = np.cumsum(np.bincount(row, minlength=len(words))).tolist()
        if (found >= 0).all():
            packed_ids = found.astype("<i4").tobytes()
            begin = 0
            for w, end in zip(words, ends):
                self.known[w] = packed_ids[4 * begin:4 * end]
                begin = end
            return
        begin = 0
        for w, end in zip(words, ends):
            out: list[int] = []
            for k in range(begin, end):
                if found[k] >= 0:
                    out.append(int(found[k]))
                elif self.v.bytes_at is None:
                    # the library makes one of adjacent unknown characters
                    if not (k > begin and found[k - 1] < 0):
                        out.append(self.v.unknown)
                else:
                    out += [self.v.bytes_at + b for b in w[at[k]:at[k] + size[k]].encode()]
            self.known[w] = np.array(out, "<i4").tobytes()
            begin = end

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        cut = [self.words(t) for t in texts]
        self.learn(set().union(*cut) if cut else set())
        return [np.frombuffer(b"".join(map(self.known.__getitem__, words)), "<i4") for words in cut]


@functools.lru_cache(maxsize=4)
def _loaded(path: str, size: int, changed: float) -> Vocabulary:
    return Vocabulary.load(path)


def load_once(path: str) -> Vocabulary:
    """The vocabulary of a file, read again only if the file has changed."""
    seen = os.stat(path)
    return _loaded(path, seen.st_size, seen.st_mtime)


class Decoder:
    """Texts of id arrays."""

    def __init__(self, vocabulary: Vocabulary):
        v = self.v = vocabulary
        self.bytes = [p.replace(SPACE, " ").encode() for p in v.pieces]
        normal = set(v.key_ids.tolist())
        for i in range(len(v.pieces)):
            if v.bytes_at is not None and v.bytes_at <= i < v.bytes_at + 256:
                self.bytes[i] = bytes([i - v.bytes_at])
            elif i == v.unknown:
                self.bytes[i] = " ⁇ ".encode()
            elif i not in normal:
                self.bytes[i] = b""  # control pieces say nothing

    def decode(self, ids: np.ndarray) -> str:
        text = b"".join(map(self.bytes.__getitem__, ids.tolist())).decode("utf-8", "replace")
        return text[1:] if self.v.dummy_prefix and text[:1] == " " else text


def encode(docs: DataFrame, model_path: str, *, text_col: str = "text", columns: list[str] | None = None,
           ids_col: str = "ids") -> DataFrame:
    """``columns`` of the input (default: all but the text) and ``ids_col``, the text's piece ids.

    Ids are those the model's own library gives, without begin or end marks.
    A NULL or empty text has no ids. Rows repeat as given; an input column
    named like ``ids_col`` is replaced. An empty table gives an empty result.
    """
    vocabulary = docs.sparkSession.sparkContext.broadcast(vars(load_once(model_path)))  # one model file
    names = [c for c in docs.columns if c != text_col] if columns is None else list(columns)
    rows = docs.select(packed(docs.select([quoted(c) for c in names])).alias("row"),
                       quoted(text_col).cast("string").alias("text"))

    def work(batches):
        encoder = Encoder(Vocabulary(**vocabulary.value))
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                ids = encoder.encode([t or "" for t in part.column(1).to_pylist()])
                ends = np.cumsum([0] + [len(x) for x in ids]).astype(np.int32)
                flat = np.concatenate(ids) if ids else np.zeros(0, np.int32)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.ListArray.from_arrays(pa.array(ends), pa.array(flat.astype(np.int32)))],
                    names=["row", "ids"])

    out = rows.mapInArrow(work, StructType([rows.schema["row"], StructField("ids", ArrayType(IntegerType()))]))
    return out.select(unpacked(out, [c for c in names if c != ids_col] + [ids_col], {ids_col: F.col("ids")}))


def decode(rows: DataFrame, model_path: str, *, ids_col: str = "ids", columns: list[str] | None = None,
           text_col: str = "text") -> DataFrame:
    """``columns`` of the input (default: all but the ids) and ``text_col``, the ids' text.

    NULL ids give an empty text, NULL elements are skipped; bytes that are no
    UTF-8 become U+FFFD. Rows repeat as given; an input column named like
    ``text_col`` is replaced. An empty table gives an empty result.
    """
    vocabulary = rows.sparkSession.sparkContext.broadcast(vars(load_once(model_path)))  # one model file
    names = [c for c in rows.columns if c != ids_col] if columns is None else list(columns)
    given = rows.select(packed(rows.select([quoted(c) for c in names])).alias("row"),
                        quoted(ids_col).cast("array<int>").alias("ids"))

    def work(batches):
        decoder = Decoder(Vocabulary(**vocabulary.value))
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                texts = [decoder.decode(np.array(x.values.drop_null())) if x.is_valid else "" for x in part.column(1)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(texts, pa.string())], names=["row", "text"])

    out = given.mapInArrow(work, StructType([given.schema["row"], StructField("text", StringType())]))
    return out.select(unpacked(out, [c for c in names if c != text_col] + [text_col], {text_col: F.col("text")}))
