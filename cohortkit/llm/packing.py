"""Cost-balanced packing of tokenised documents into sequences.

Every task tokenises its documents; blocks of a full sequence length are
cut off and the rest of each document goes, with its token ids, to one of
many shards of bounded size. A shard opens exactly the sequences its tokens
fill (the last ones of power-of-two lengths), and assigns pieces in
descending cost to the sequence of lowest cost that has room. A piece that
does not fit whole is cut there, so every sequence ends up full.
"""

from __future__ import annotations

import heapq
import os
import re
from array import array
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (BinaryType, IntegerType, LongType, StructField, StructType)

from cohortkit.llm.common import packed, quoted, tidy, unpacked

#: Separators that ``str.split`` knows and the tokenizers' ``\s`` does not.
_CONTROL = re.compile("[\x1c-\x1f]")
#: Words of letters and marks after them; a pre-tokenizer cuts between the two and nowhere else.
_LETTERS = "".join(c for c in map(chr, range(256)) if c.isalpha() and c not in "ªµº")
_MARKS = "".join(c for c in map(chr, range(33, 127)) if not c.isalnum() and c != "'")
_PROBES = ("a", "word", "Étranger", "größe", "naïve", "...", "!?#$", "señal", "ÿ", "internationally")


def byte_characters() -> list[str]:
    """The character that byte-level models write for each byte: itself where it prints, else one above 255."""
    prints = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in prints]
    return [chr(b if b in prints else 256 + rest.index(b)) for b in range(256)]


class WordIds(dict):
    """Token ids of words, as bytes of unsigned integers of ``dtype``.

    New plain words go straight to the model, if it is seen to give what the
    whole tokenizer gives. The others are encoded many at a time as one text,
    with a special token between them to tell where each ends.
    """

    def __init__(self, path: str, limit: int = 1_000_000):
        super().__init__()
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one task, one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.limit, self.tokenize = limit, self.tokenizer.model.tokenize
        special = {i: t.content for i, t in self.tokenizer.get_added_tokens_decoder().items() if t.special}
        self.mark_id, self.mark = next(iter(special.items()))
        self.special = re.compile("|".join(map(re.escape, special.values())))
        self.byte_characters = byte_characters()
        self.dtype, self.code = ("<u2", "H") if self.tokenizer.get_vocab_size() <= 1 << 16 else ("<u4", "I")
        self.direct = all(self.plain(w.lower()) == self.whole(w) for w in _PROBES)

    def plain(self, part: str) -> bytes:
        """Ids of one lower-case part without the steps before the model."""
        if not part.isascii():
            part = "".join(map(self.byte_characters.__getitem__, part.encode()))
        return array(self.code, [t.id for t in self.tokenize(part)]).tobytes()

    def whole(self, text: str) -> bytes:
        """Ids of any text; special tokens' strings in it are ordinary text."""
        self.tokenizer.encode_special_tokens = True
        ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        self.tokenizer.encode_special_tokens = False
        return np.array(ids, self.dtype).tobytes()

    def _encode(self, words: list[str], batch: int = 4096) -> None:
        for i in range(0, len(words), batch):
            part = words[i:i + batch]
            (code,) = self.tokenizer.encode_batch_fast([self.mark.join(part)], add_special_tokens=False)
            ids = np.array(code.ids, np.int64)
            ends = np.append(np.flatnonzero(ids == self.mark_id), len(ids)).tolist()
            raw, size = ids.astype(self.dtype).tobytes(), np.dtype(self.dtype).itemsize
            begin = 0
            for word, end in zip(part, ends, strict=True):
                self[word] = raw[size * begin:size * end]
                begin = end + 1

    def learn(self, words: set[str]) -> None:
        new = [w for w in words if w not in self]
        if len(self) + len(new) > self.limit:  # forget, to bound memory
            self.clear()
            new = list(words)
        # a plain word without marks is its own part, so parts are kept among the words
        rest, known = [], self.get
        for w in new:
            head = w.rstrip(_MARKS) if self.direct else ""
            if not head or head.strip(_LETTERS):
                if self.special.search(w):
                    self[w] = self.whole(w)
                else:
                    rest.append(w)
                continue
            low, marks = head.lower(), w[len(head):]
            ids = known(low)
            if ids is None:
                ids = self[low] = self.plain(low)
            if marks:
                more = known(marks)
                if more is None:
                    more = self[marks] = self.plain(marks)
                ids += more
            self[w] = ids
        self._encode(rest)


def encode_texts(texts: list[str], ids: WordIds) -> list[np.ndarray]:
    """Ids of each text. White space only separates in this tokenizer, so a text's
    ids are those of its words, and each distinct word is encoded once, whatever its
    case where the tokenizer is seen to lower ASCII letters."""
    split = [None if _CONTROL.search(t) else (t.lower() if ids.direct and t.isascii() else t).split() for t in texts]
    ids.learn(set().union(*[w for w in split if w]))
    return [np.frombuffer(ids.whole(t) if words is None else
                          b"".join(itemgetter(*words)(ids)) if len(words) > 1 else b"".join(map(ids.__getitem__, words)),
                          ids.dtype)
            for t, words in zip(texts, split)]


def sequence_sizes(tokens: int, size: int) -> list[int]:
    """Lengths that sum to ``tokens``: full sequences, then falling powers of two."""
    rest = tokens % size
    return [size] * (tokens // size) + [1 << k for k in range(rest.bit_length() - 1, -1, -1) if rest >> k & 1]


def pack_lengths(lengths: list[int], size: int, linear: float, quadratic: float) -> list[tuple[int, int, int, int, int]]:
    """(piece, start in it, length, sequence, offset) for pieces of at most ``size``.

    Descending cost, to the sequence of lowest cost with room; what does not
    fit is put back as a smaller piece. Ties go to the earlier piece and the
    earlier sequence.
    """
    def cost(n: int) -> float:
        return linear * n + quadratic * n * n

    room = sequence_sizes(sum(lengths), size)
    filled = [0] * len(room)
    # a short sequence starts as if its missing part were taken
    open_sequences = [(cost(size) - cost(n), s) for s, n in enumerate(room)]
    heapq.heapify(open_sequences)
    pieces = [(-cost(n), i, 0, n) for i, n in enumerate(lengths) if n]
    heapq.heapify(pieces)
    out = []
    while pieces:
        _, i, start, n = heapq.heappop(pieces)
        spent, s = heapq.heappop(open_sequences)
        take = min(n, room[s])
        out.append((i, start, take, s, filled[s]))
        filled[s] += take
        room[s] -= take
        if room[s]:
            heapq.heappush(open_sequences, (spent + cost(take), s))
        if take < n:
            heapq.heappush(pieces, (-cost(n - take), i, start + take, n - take))
    return out


def pack(docs: DataFrame, tokenizer_path: str, *, id_col: str = "doc_id", text_col: str = "text",
         columns: list[str] | None = None, size: int = 2048, end_id: int = 1, linear: float = 1.0,
         quadratic: float = 1.0 / 2048, shard_docs: int = 4096,
         shard_bytes: int = 1 << 23) -> DataFrame:
    """Sequences of at most ``size`` tokens from all documents, without padding.

    A document is its text's ids by the tokenizer file, then ``end_id``. One
    row per piece: ``columns`` of the input (default: all but the text), and
    ``start``, ``length``, ``ids`` (binary, little-endian unsigned 32-bit),
    ``doc_tokens``, ``sequence_id``, ``offset`` and ``sequence_tokens``;
    input columns of these names are replaced. ``size`` must be a power of
    two; every sequence is full, of ``size`` tokens or a smaller power of two.

    The tokenizer must drop white space and encode words apart from each
    other. A NULL or empty text is the end id alone. Rows with the same id
    are packed each for itself. A shard holds about ``shard_docs`` documents'
    last blocks and ``shard_bytes`` of text, whichever needs more shards: a
    token has a byte at least, so a shard's tokens are bounded however long
    the documents are. An empty table gives an empty result.
    """
    if size & (size - 1):
        raise ValueError("size must be a power of two")
    names = [c for c in docs.columns if c != text_col] if columns is None else list(columns)
    rows = docs.select(packed(docs.select([quoted(c) for c in names])).alias("row"),
                       F.xxhash64(quoted(id_col)).alias("key"), quoted(text_col).cast("string").alias("text"))
    n_docs, n_bytes = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    shards = max(1, -(-n_docs // shard_docs), -(-n_bytes // shard_bytes))
    kept = rows.schema["row"]

    def tokens(batches):
        known = WordIds(tokenizer_path)
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                texts = [t or "" for t in part.column(2).to_pylist()]
                rows_of, start, length, doc_tokens, codes = [], [], [], [], []
                for i, ids in enumerate(encode_texts(texts, known)):
                    ids = np.append(ids, end_id).astype(known.dtype)
                    for a in range(0, len(ids), size):
                        piece = ids[a:a + size]
                        rows_of.append(i)
                        start.append(a)
                        length.append(len(piece))
                        doc_tokens.append(len(ids))
                        codes.append(piece.tobytes())
                key = np.array(part.column(1), np.int64)[rows_of]
                # the blocks of one document go to different shards
                shard = (key.astype(np.uint64) + np.array(start, np.uint64) // np.uint64(size)
                         * np.uint64(0x9E3779B97F4A7C15)) % np.uint64(shards)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(rows_of)), pa.array(shard.astype(np.int32)), pa.array(key),
                     pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(doc_tokens, pa.int64()),
                     pa.array(codes, pa.binary())],
                    names=["row", "shard", "key", "start", "length", "doc_tokens", "ids"])

    def long(name: str) -> StructField:
        return StructField(name, LongType())

    cut = rows.mapInArrow(tidy(tokens), StructType([kept, StructField("shard", IntegerType()), long("key"),
                                              long("start"), long("length"), long("doc_tokens"), StructField("ids", BinaryType())]))

    def place(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        key, start, length, shard = (group[c].to_numpy() for c in ("key", "start", "length", "shard"))
        # the order of arrival may differ between attempts
        order = np.lexsort((start, key, -length))
        start, sizes, codes = start[order].tolist(), length[order].tolist(), group["ids"].chunk(0)
        done = pack_lengths(sizes, size, linear, quadratic)
        ids = []
        for i, a, n, *_ in done:
            raw = codes[int(order[i])].as_buffer()
            width = raw.size // sizes[i]
            ids.append(np.frombuffer(raw, f"<u{width}")[a:a + n].astype("<u4").tobytes())
        base, lengths = int(shard[0]) << 32, sequence_sizes(sum(sizes), size)
        of = pa.array(order[[i for i, *_ in done]])
        return pa.table({
            "row": group["row"].take(of),
            "start": pa.array([start[i] + a for i, a, *_ in done], pa.int64()),
            "length": pa.array([n for _, _, n, *_ in done], pa.int64()),
            "doc_tokens": group["doc_tokens"].take(of),
            "ids": pa.array(ids, pa.binary()),
            "sequence_id": pa.array([base + s for *_, s, _ in done], pa.int64()),
            "offset": pa.array([o for *_, o in done], pa.int64()),
            "sequence_tokens": pa.array([lengths[s] for *_, s, _ in done], pa.int64())})

    made = ["start", "length", "ids", "doc_tokens", "sequence_id", "offset", "sequence_tokens"]
    out = cut.groupBy("shard").applyInArrow(place, StructType(
        [kept, long("start"), long("length"), long("doc_tokens"), StructField("ids", BinaryType()),
         long("sequence_id"), long("offset"), long("sequence_tokens")]))
    return out.select(unpacked(out, [c for c in names if c not in made] + made, {c: F.col(c) for c in made}))
