"""Secret scans: fixed patterns, and a character network over further candidates.

The base patterns always count. Besides them every longer stretch of key
characters with a digit or mixed case in it is a candidate; a convolutional
network (``char_cnn``) reads it with its surroundings, a long one by
overlapping windows of which the highest score counts, and adds those it
takes for secrets. It is trained here, on findings labelled by the base
patterns in a bounded sample of the corpus and on the same findings in other
spellings. A candidate that no base pattern matches has no label: it may be a
key of another kind. It teaches the network only once a first network, which
has seen generated harmless runs alone, ranks it below nearly all secrets.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from cohortkit.llm.char_cnn import CharCNN, encode, recall_threshold
from cohortkit.llm.common import packed, quoted, saved, text_chunks, tidy, unpacked

KINDS = ("assign", "access", "hex", "model")
# Fixed patterns and least lengths of the base rules.
ASSIGN = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A)
ASSIGN_VALUE = 6
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
ACCESS_LENGTH = 20
HEX = re.compile(r"[0-9a-f]+")
HEX_LENGTH = 24

CANDIDATE_LENGTH = 16
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=.-]{%d,}" % CANDIDATE_LENGTH)
KEYLIKE = re.compile(r"[0-9]|[a-z][A-Z]")
WORD = re.compile(rb"(?<![A-Za-z0-9+/_=.-])[A-Za-z]?[a-z]{2,8}(?![A-Za-z0-9+/_=-])")
LEFT, BODY, RIGHT = 24, 48, 8
LENGTH = LEFT + BODY + RIGHT
STEP = 16  # between the windows over a longer candidate
SCORED = 4096  # contexts the network reads at once
SPANS = "array<struct<kind:string,start:long,end:long,score:double>>"


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, number of the kind, end) of the base rules' matches, in order."""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= ASSIGN_VALUE]
    found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_LENGTH]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text) if m.end() - m.start() >= HEX_LENGTH]
    return sorted(found)


def candidates(text: str, taken: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """Stretches of key characters between base spans that have a digit, or an upper-case
    letter after a lower-case one."""
    out: list[tuple[int, int]] = []

    def add(start: int, end: int) -> None:
        if end - start >= CANDIDATE_LENGTH and KEYLIKE.search(text, start, end):
            out.append((start, end))

    spans = iter(sorted((s, e) for s, _, e in taken))
    ahead = next(spans, None)
    reach = 0  # the end of the base spans met so far
    for m in CANDIDATE.finditer(text):
        while ahead and ahead[0] < m.end():
            add(max(reach, m.start()), ahead[0])
            reach = max(reach, ahead[1])
            ahead = next(spans, None)
        add(max(reach, m.start()), m.end())
    return out


def context(text: str, start: int, end: int) -> bytes:
    """The characters around and in a span, its first ``BODY`` if it is longer, at fixed
    places; other than ASCII are ``?``."""
    end = min(end, start + BODY)
    left = text[max(0, start - LEFT):start].rjust(LEFT, "\0")
    return (left + text[start:end].ljust(BODY, "\0") + text[end:end + RIGHT].ljust(RIGHT, "\0")).encode("ascii", "replace")


def contexts(text: str, start: int, end: int) -> Iterator[bytes]:
    """The contexts of overlapping windows over the whole span, one for a span that fits."""
    for at in range(start, max(end - BODY, start), STEP):
        yield context(text, at, at + BODY)
    yield context(text, max(end - BODY, start), end)


def marks() -> np.ndarray:
    return np.array([0] * LEFT + [1] * BODY + [0] * RIGHT)


def suspicious(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Rows that can hold a base match or a candidate: a cheap necessary condition."""
    key = np.zeros(256, bool)
    key[[c for c in range(128) if re.match(r"[A-Za-z0-9+/_=.-]", chr(c))]] = True
    inside = key[data]
    # runs begin and end at a text's ends too
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    begin, end = offsets[:-1], offsets[1:] - 1
    begin, end = begin[begin <= end], end[begin <= end]
    first[begin], last[end] = inside[begin], inside[end]
    lo, hi = np.flatnonzero(first), np.flatnonzero(last) + 1
    long = np.flatnonzero(hi - lo >= CANDIDATE_LENGTH)
    out = np.zeros(len(offsets) - 1, bool)
    if len(long):
        lo, hi = lo[long], hi[long]
        # a digit, or a pair of a lower-case and an upper-case letter, lies within the run
        digits = np.flatnonzero((data >= 48) & (data < 58))
        humps = np.flatnonzero((data[:-1] >= 97) & (data[:-1] < 123) & (data[1:] >= 65) & (data[1:] < 91))
        keep = np.searchsorted(digits, hi) > np.searchsorted(digits, lo)
        keep |= np.searchsorted(humps, hi - 1) > np.searchsorted(humps, lo)
        # hex runs and access keys may have no digit: runs of their length count anyway
        keep |= hi - lo >= ACCESS_LENGTH
        out[np.searchsorted(offsets, lo[keep], side="right") - 1] = True
    ends = offsets.tolist()
    for i, (a, b) in enumerate(zip(ends, ends[1:])):
        if not out[i] and b > a:
            low = data[a:b].tobytes().lower()
            out[i] = any(w in low for w in (b"passw", b"secret", b"token", b"apikey", b"api_key"))
    return out


def spellings(value: str, rng: np.random.Generator) -> list[str]:
    """The same random material as other kinds of keys."""
    raw = xxhash.xxh3_128_digest(value.encode()) + xxhash.xxh3_128_digest(value.encode()[::-1])
    plain = base64.b64encode(raw).decode().rstrip("=")
    size = int(rng.integers(20, 41))
    safe = re.sub("[+/]", "x", plain)
    name = "".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), int(rng.integers(2, 6)))) + str(rng.choice(list("_-.")))
    letters = "".join(c for c in safe if not c.isdigit())
    return [plain[:size], safe[:size] + "0", f"sk_{safe[:size]}7", f"{name}{safe[:size]}3", raw.hex().upper()[:size],
            f"{raw.hex()[:8]}-{raw.hex()[8:12]}-{raw.hex()[12:16]}-{raw.hex()[16:20]}-{raw.hex()[20:32]}",
            base64.b32encode(raw).decode()[:size], f"{safe[:size].lower()}9", letters[:max(size, 16)],
            f"{name}{int.from_bytes(raw[:5], 'big')}-{safe[:size]}", f"{safe[:size]}.{safe[::-1][:size]}1"]


def innocent(rng: np.random.Generator, words: Sequence[str] = ()) -> str:
    """A long run of key characters with digits or mixed case that is no secret; ``words``:
    what it may be made of besides made-up words."""
    def word() -> str:
        if len(words) and rng.random() < 0.6:
            return words[int(rng.integers(len(words)))]
        return "".join(rng.choice(list("etaoinshrdlu"), int(rng.integers(3, 9))))

    n = lambda a, b: str(int(rng.integers(a, b)))
    if rng.random() < 0.5:
        return [f"{word()}{n(1, 99)}.{word()}.example.com", f"{word()}_{word()}_{word()}_{n(1, 999)}",
                f"20{n(10, 30)}-0{n(1, 9)}-{n(10, 28)}-{word()}-{word()}", f"{word()}/{word()}/{word()}{n(1, 99)}.html",
                n(10**15, 10**18), f"{word()}-{word()}-{word()}-{n(1, 99)}"][int(rng.integers(0, 6))]
    if rng.random() < 0.15:
        return [f"20{n(10, 30)}-{n(10, 13)}-{n(10, 29)}T{n(10, 24)}.{n(10, 60)}.{n(10, 60)}", f"0.{n(10**14, 10**17)}",
                f"{n(1, 255)}.{n(1, 255)}.{n(1, 255)}.{n(1, 255)}/{n(1, 9999)}"][int(rng.integers(0, 3))]
    parts: list[str] = []
    while sum(map(len, parts)) < CANDIDATE_LENGTH or len(parts) < 2:
        parts.append(word() + (n(0, 2000) if rng.random() < 0.2 else ""))
    joint = str(rng.choice(["/", ".", "-", "_", "=", ""]))
    if not joint or rng.random() < 0.2:
        parts = [x[:1].upper() + x[1:] if i or rng.random() < 0.5 else x for i, x in enumerate(parts)]
    return joint.join(parts) + str(rng.choice(["", "", n(0, 2000), f".{n(1, 99)}", ".html", ".com"]))


def long_path(rng: np.random.Generator, middle: str) -> tuple[str, int]:
    """A harmless run longer than a window with ``middle`` in it, and where that starts."""
    parts = ["in", "sta", "lla", "tion", "gu", "ide", "set", "ting", "com", "pu", "ter", "mod", "ule", "ver", "sion", "re", "lea", "se",
             "al", "pha", "bra", "vo", "ky", "fox", "jump", "quick", "ward", "zen"]
    word = lambda: "".join(rng.choice(parts, int(rng.integers(1, 5))))
    joint = str(rng.choice(list("//._-")))
    before, after = (joint.join(word() for _ in range(int(rng.integers(2, 9)))) for _ in range(2))
    return f"{before}{joint}{middle}{joint}{after}.html", len(before) + 1


def labelled(positive: list[tuple[bytes, str]], unlabelled: list[bytes], seed: int) -> tuple[list[bytes], np.ndarray]:
    """Training rows: findings as they are and in other spellings with and without the words
    before them and within long runs, against generated harmless runs. Of the ``unlabelled``
    candidates only the surroundings are used."""
    rng = np.random.default_rng(seed)
    yes, no = [c for c, _ in positive], []
    values = [v for _, v in positive] or [str(i) for i in range(300)]
    around = [c[:LEFT].decode() for c in unlabelled] + [c[:LEFT].decode() for c in yes] + ["\0" * LEFT]
    words = sorted({w.decode() for x in around for w in WORD.findall(x.encode())})
    for i in range(max(len(values), 600)):
        for s in spellings(f"{values[i % len(values)]}{i}", rng)[i % 3::3]:
            left = around[int(rng.integers(len(around)))] if rng.random() < 0.7 else "\0" * LEFT
            yes.append(context(left + s + " ", LEFT, LEFT + len(s)))
            if i % 2:
                # a window as over a long run, with the key's beginning anywhere in its first step
                run, at = long_path(rng, s)
                yes.append(context(run, max(0, at - int(rng.integers(0, STEP))), len(run)))
    for _ in range(max(len(yes), 600)):
        left, s = around[int(rng.integers(len(around)))], innocent(rng, words)
        no.append(context(left + s + " ", LEFT, LEFT + len(s)))
        if rng.random() < 0.5:
            run, _ = long_path(rng, s)
            windows = list(contexts(left + run + " ", len(left), len(left) + len(run)))
            no.append(windows[int(rng.integers(len(windows)))])
    return yes + no, np.array([1.0] * len(yes) + [0.0] * len(no), np.float32)


def findings(rows: DataFrame) -> DataFrame:
    """Context of every base match (label 1) and every other candidate (0: none known); input: one text column."""
    schema = pa.schema([("label", pa.int32()), ("context", pa.binary()), ("value", pa.string()), ("rank", pa.int64())])

    def work(batches):
        for part, data, offsets in text_chunks(batches, "text"):
            out: list[tuple[int, bytes, str]] = []
            for i in np.flatnonzero(suspicious(data, offsets)).tolist():
                text = part.column(0)[i].as_py()
                taken = base_spans(text)
                for s, kind, e in taken:
                    value = ASSIGN.match(text, s).start(2) if kind == 0 else s
                    out.append((1, context(text, value, e), text[value:e][:64]))
                out += [(0, c, "") for s, e in candidates(text, taken) for c in contexts(text, s, e)]
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([x[0] for x in out], pa.int32()), pa.array([x[1] for x in out], pa.binary()),
                     pa.array([x[2] for x in out], pa.string()),
                     pa.array([xxhash.xxh3_64_intdigest(x[1]) >> 1 for x in out], pa.int64())], schema=schema)

    return rows.mapInArrow(tidy(work), "label int, context binary, value string, rank long")


def train(rows: DataFrame, *, sample: int = 2000, recall: float = 0.98, seed: int = 7) -> tuple[CharCNN, float]:
    """The network and its threshold, from at most ``sample`` base matches and as many
    unlabelled candidates.

    The sample takes the distinct findings of smallest hash, so it is the same
    however the input is partitioned. A quarter of the rows is held out: it
    calibrates the probabilities and sets the threshold, the highest that
    still finds ``recall`` of the held-out secrets.

    Learning is in two steps. The first network knows secrets and generated
    harmless runs. Held-out secrets are its spies: an unlabelled candidate
    that scores below ``recall`` of them is taken for harmless and joins the
    second network's negatives; one that scores above is left out.
    """
    found = saved(findings(rows), "secret-findings")
    picked = {label: found.where(F.col("label") == label).select("rank", "context", "value").distinct()
              .orderBy("rank", "context", "value").limit(sample).collect() for label in (0, 1)}
    return fit([(bytes(r["context"]), r["value"]) for r in picked[1]], [bytes(r["context"]) for r in picked[0]], recall, seed)


def fit(positive: list[tuple[bytes, str]], unlabelled: list[bytes], recall: float, seed: int) -> tuple[CharCNN, float]:
    """Both steps of ``train`` on sampled findings."""
    strings, labels = labelled(positive, unlabelled, seed)
    first, least = _fit(encode(strings, LENGTH), labels, recall, seed)
    harmless = encode(unlabelled, LENGTH)
    harmless = harmless[first.probabilities(harmless) < least]
    if not len(harmless):
        return first, least
    return _fit(np.concatenate([encode(strings, LENGTH), harmless]),
                np.concatenate([labels, np.zeros(len(harmless), np.float32)]), recall, seed)


def _fit(codes: np.ndarray, labels: np.ndarray, recall: float, seed: int) -> tuple[CharCNN, float]:
    order = np.random.default_rng(seed).permutation(len(codes))
    held, rest = order[:len(order) // 4], order[len(order) // 4:]
    model = CharCNN(marks(), seed).fit(codes[rest], labels[rest], seed=seed).calibrate(codes[held], labels[held])
    return model, recall_threshold(model.probabilities(codes[held][labels[held] > 0]), recall)


def secret_scan(docs: DataFrame, *, text_col: str = "text", columns: list[str] | None = None, sample: int = 2000,
                recall: float = 0.98, seed: int = 7) -> DataFrame:
    """``columns`` of the input (default: all) and ``spans``: every secret found in the text.

    A span has its kind (``assign``, ``access``, ``hex`` by the base patterns,
    ``model`` by the network), start and end in code points (end exclusive) and
    score (1 for base matches, else the calibrated probability), ordered by
    start, then kind. Spans of different base kinds may overlap; the network's
    touch no base span. An input column ``spans`` is replaced.

    A NULL or empty text has no spans. Rows repeat as given. An empty table
    gives an empty result. Training reads all texts once at the call and
    takes at most ``sample`` base matches and as many other candidates to the driver.
    """
    names = list(docs.columns) if columns is None else list(columns)
    text = quoted(text_col).cast("string").alias("text")
    model, threshold = train(docs.select(text), sample=sample, recall=recall, seed=seed)
    # a fixed number of weights, as plain arrays
    shared = docs.sparkSession.sparkContext.broadcast((model.state(), threshold))
    # a text travels once, beside its row
    beside = [text_col] if docs.schema[text_col].dataType == StringType() else []
    back = text_col in names and bool(beside)
    rows = docs.select(packed(docs.select([quoted(c) for c in names]), beside).alias("row"), text)
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()),
                               ("score", pa.float64())]))

    def work(batches):
        state, least = shared.value
        net = CharCNN.from_state(state)
        for part, data, offsets in text_chunks(batches, "text"):
            spans: list[list[tuple[int, int, int, float]]] = [[] for _ in range(part.num_rows)]
            best: dict[tuple[int, int, int], float] = {}
            asked: list[tuple[int, int, int]] = []
            strings: list[bytes] = []

            def score() -> None:
                if asked:
                    for x, p in zip(asked, net.probabilities(encode(strings, LENGTH)).tolist()):
                        best[x] = max(best.get(x, 0.0), p)
                    asked.clear()
                    strings.clear()

            for i in np.flatnonzero(suspicious(data, offsets)).tolist():
                body = part.column(1)[i].as_py()
                taken = base_spans(body)
                spans[i] = [(s, k, e, 1.0) for s, k, e in taken]
                for s, e in candidates(body, taken):
                    for c in contexts(body, s, e):
                        asked.append((i, s, e))
                        strings.append(c)
                        if len(asked) == SCORED:
                            score()
            score()
            for (i, s, e), p in best.items():
                if p >= least:
                    spans[i].append((s, 3, e, p))
            yield pa.RecordBatch.from_arrays(
                [part.column(i) for i in range(1 + back)] + [pa.array([[{"kind": KINDS[k], "start": s, "end": e, "score": p}
                                            for s, k, e, p in sorted(x)] for x in spans], kind)],
                names=["row", *["text"] * back, "spans"])

    schema = StructType([rows.schema["row"], *[rows.schema["text"]] * back]).add(StructField("spans", StringType()))
    schema["spans"].dataType = docs.sparkSession.createDataFrame([], f"spans {SPANS}").schema["spans"].dataType
    out = rows.mapInArrow(tidy(work), schema)
    return out.select(unpacked(out, [c for c in names if c != "spans"] + ["spans"],
                               ({text_col: F.col("text")} if back else {}) | {"spans": F.col("spans")}))


def redact(docs: DataFrame, *, text_col: str = "text", mark: str = "[secret]", **options) -> DataFrame:
    """The input with every secret's span (overlapping ones as one) replaced by ``mark``.

    A NULL text stays NULL; other options are those of ``secret_scan``.
    """
    found = secret_scan(docs.select(packed(docs, [text_col]).alias("row"), quoted(text_col).cast("string").alias("text")),
                        text_col="text", **options)

    def step(acc, span):
        # acc: text so far and the end of what it covers
        begin, end = span["start"], span["end"]
        gap = F.substring(F.col("text"), acc["at"] + 1, F.greatest(begin - acc["at"], F.lit(0)))
        return F.when(begin < acc["at"], F.struct(acc["out"].alias("out"), F.greatest(acc["at"], end).alias("at"))) \
            .otherwise(F.struct(F.concat(acc["out"], gap, F.lit(mark)).alias("out"), end.alias("at")))

    start = F.struct(F.lit("").alias("out"), F.lit(0).cast("long").alias("at"))
    done = F.aggregate("spans", start, step)
    text = F.when(F.size("spans") == 0, F.col("text")).otherwise(
        F.concat(done["out"], F.substring(F.col("text"), done["at"] + 1, F.length("text"))))
    return found.withColumn("redacted", text).select(
        [(F.col("redacted") if c == text_col else F.col("row").getField(c)).alias(c) for c in docs.columns])
