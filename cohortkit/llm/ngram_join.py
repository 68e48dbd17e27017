"""Near duplicates: an exact Jaccard self-join of word-shingle sets.

1. Shingles are counted in a table of fixed size; the counts give every
   document the same order of shingles, rare ones first. Two sets that are
   similar enough share one of their first shingles in this order (prefix
   filter), so only documents meeting on such a key are ever compared.
2. Each document's set is also hashed to a bitmap of parities. The number of
   bits in which two bitmaps differ bounds the sets' difference from below,
   their overlap from above.
3. On every shared key each document is paired only with the first of its
   band of set sizes and the first of the band below; pairs whose bitmaps
   allow it are decided by intersecting the sorted shingle arrays. Their
   links give first components.
4. Keys whose documents of similar size are not yet in one component are
   compared further: in tiles of bounded size, between rows of different
   components, by bitmaps, then exactly. In the first rounds a row offers
   only the nearest row of another component, which joins large groups at a
   cost of one pair per row; the last round offers all that are left. Pairs
   inside a component need no look, and no link between two is lost.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortkit.llm.common import quoted, saved, text_chunks, tidy
from cohortkit.llm.components import components
from cohortkit.llm.words import mix, windows, word_hashes

SEGMENT = 1 << 16  # counters that travel together
SEGMENT_TASKS = 32  # tasks that add up segments: their number is fixed, and most shuffle partitions have none
MIN_BITS = 64


def shingle_sets(data: np.ndarray, offsets: np.ndarray, n: int) -> list[np.ndarray]:
    """Each text's distinct ``n``-word shingles as sorted 64-bit hashes. A text with
    fewer words has its whole sequence as the only one; without words, none."""
    hashes, words_at = word_hashes(data, offsets, lower=True)
    found, at = windows(hashes, words_at, n)
    ends = np.searchsorted(at, words_at).tolist()
    out = []
    for i, (a, b) in enumerate(zip(ends, ends[1:])):
        if b > a:
            own = np.sort(found[a:b])
            fresh = np.ones(len(own), bool)
            np.not_equal(own[1:], own[:-1], out=fresh[1:])
            out.append(own[fresh])
        else:
            words = hashes[words_at[i]:words_at[i + 1]]
            if len(words):
                # set apart from shingles by the length mixed in
                acc = np.uint64(len(words))
                for w in words:
                    acc = mix((acc ^ w).reshape(1))[0]
                out.append(np.array([acc], np.uint64))
            else:
                out.append(words)
    return out


def least_overlap(n: np.ndarray | int, percent: int):
    """Shingles of a set of ``n`` that any set similar enough must share."""
    return (n * percent + 99) // 100


def size_band(n: np.ndarray, percent: int) -> np.ndarray:
    """Bands a little wider than the ratio of sizes that may link: sets that may are in
    one band or in neighbouring ones. Some of a band may not: sizes are compared too."""
    return np.floor(np.log(n) / (np.log(100 / percent) * 1.0001) if percent < 100 else n).astype(np.int64)


def bitmap_bits(n: int) -> int:
    """Bits of a set's bitmap: the power of two at or above its size."""
    return max(MIN_BITS, 1 << (n - 1).bit_length())


def parity_bitmap(shingles: np.ndarray) -> np.ndarray:
    """Bit i tells whether an odd number of shingles hash to i."""
    bits = bitmap_bits(len(shingles))
    odd = np.bincount((shingles >> np.uint64(20)).astype(np.int64) & (bits - 1), minlength=bits) & 1
    return np.packbits(odd.astype(bool), bitorder="little").view(np.uint64)


def fold(bitmaps: np.ndarray, words: int) -> np.ndarray:
    """Rows of bitmaps cut to ``words`` 64-bit words; parities add up."""
    while bitmaps.shape[1] > words:
        half = bitmaps.shape[1] // 2
        bitmaps = bitmaps[:, :half] ^ bitmaps[:, half:]
    return bitmaps


def may_link(size_a: np.ndarray, size_b: np.ndarray, differing: np.ndarray, percent: int) -> np.ndarray:
    """Whether sets of these sizes whose bitmaps differ in so many bits can be similar enough."""
    # overlap <= (|A| + |B| - differing) / 2, union = |A| + |B| - overlap
    total = size_a + size_b
    overlap = np.minimum((total - differing) // 2, np.minimum(size_a, size_b))
    return 100 * overlap >= percent * (total - overlap)


def count_rows(table: np.ndarray) -> Iterator[tuple[int, bytes]]:
    """The counters of one task by segment, as 16-bit numbers (more counts as that)."""
    segment = min(SEGMENT, len(table))
    for i in range(0, len(table), segment):
        part = table[i:i + segment]
        if part.any():
            yield i // segment, np.minimum(part, 0xFFFF).astype("<u2").tobytes()


def count_table(parts: DataFrame, buckets: int) -> np.ndarray:
    """How many documents' shingles fall into each bucket (a fixed number of counters),
    from (segment, counts) rows."""
    schema = pa.schema([("segment", pa.int32()), ("counts", pa.binary())])
    segment = min(SEGMENT, buckets)

    def add(batches):
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for i, counts in zip(*(c.to_pylist() for c in batch.columns)):
                total[i] = total.get(i, 0) + np.frombuffer(counts, "<u2").astype(np.int64)
        for i, counts in total.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([i], pa.int32()), pa.array([np.minimum(counts, 0xFFFFFFFF).astype("<u4").tobytes()])],
                schema=schema)

    whole = np.zeros(buckets, np.uint32)
    joined = parts.repartition("segment").coalesce(SEGMENT_TASKS).mapInArrow(tidy(add), "segment int, counts binary")
    for r in joined.collect():  # 4 bytes a bucket
        whole[r["segment"] * segment:(r["segment"] + 1) * segment] = np.frombuffer(r["counts"], "<u4")
    return whole


def rarest(shingles: np.ndarray, counts: np.ndarray, percent: int) -> np.ndarray:
    """The shingles of a set of which any set similar enough shares one: its rarest, by one
    order for all documents (counters, then hashes)."""
    if not len(shingles):
        return shingles
    take = len(shingles) - int(least_overlap(len(shingles), percent)) + 1
    common = np.minimum(counts[(shingles & np.uint64(len(counts) - 1)).astype(np.int64)], 0xFFFFF).astype(np.uint64)
    order = (common << np.uint64(44)) | (shingles >> np.uint64(20))
    return shingles[np.argsort(order, kind="stable")[:take]]


def shared_keys(keys: DataFrame, percent: int) -> DataFrame:
    """Rows (key, n, id) that another row of their key may link with by size, with
    their ``band``, the first id of the band on that key (``leader``), and that of
    the band below (``lower``); each the row's own id if there is none."""
    def work(batches: Iterator[pa.RecordBatch]):
        held = None  # the last row, with its band, leader, lower and whether it has met a neighbour
        for batch in batches:
            if not batch.num_rows:
                continue
            k, n, v = (np.array(batch.column(i)) for i in range(3))
            if held:
                k, n, v = (np.concatenate([[x], y]) for x, y in zip(held[:3], (k, n, v)))
            band = size_band(n, percent)
            same = k[1:] == k[:-1]
            begins = np.flatnonzero(np.concatenate([[True], ~same | (band[1:] != band[:-1])]))
            runs = np.diff(np.append(begins, len(k)))
            first, low = v[begins].copy(), np.full(len(begins), -1, np.int64)
            if held:
                first[0] = held[3]
            follows = (k[begins[1:]] == k[begins[:-1]]) & (band[begins[1:]] == band[begins[:-1]] + 1)
            low_known = np.concatenate([[False], follows])
            low[1:] = first[:-1]
            if held and held[4] is not None:
                low[0], low_known[0] = held[4], True
            leader = np.repeat(first, runs)
            lower = np.where(np.repeat(low_known, runs), np.repeat(low, runs), v)
            meets = same & (percent * n[1:] <= 100 * n[:-1])
            shared = np.zeros(len(k), bool)
            shared[1:] |= meets
            shared[:-1] |= meets
            if held:
                shared[0] |= held[5]
            out = np.flatnonzero(shared[:-1])
            if len(out):
                yield pa.RecordBatch.from_arrays([pa.array(x[out]) for x in (k, band, n, v, leader, lower)], names=names)
            held = (k[-1], n[-1], v[-1], leader[-1], lower[-1] if low_known[-1] else None, bool(shared[-1]))
        if held and held[5]:
            low = held[2] if held[4] is None else held[4]
            row = (held[0], size_band(np.array([held[1]]), percent)[0], held[1], held[2], held[3], low)
            yield pa.RecordBatch.from_arrays([pa.array([x], pa.int64()) for x in row], names=names)

    names = ["key", "band", "n", "id", "leader", "lower"]
    return (keys.repartition("key").sortWithinPartitions("key", "n", "id")
            .mapInArrow(tidy(work), ", ".join(f"{c} long" for c in names)))


def cross_pairs(tile: np.ndarray, sizes: np.ndarray, comps: np.ndarray, side: np.ndarray, home: np.ndarray,
                bitmaps: list[bytes], percent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs of rows of one tile that may link and lie in different components, and the
    least share of their shingles in which they differ.

    Where a tile's rows have two sides only pairs across them meet, and one of
    a pair must be at home in the tile's band. Wider bitmaps are folded.
    """
    widths = np.array([len(b) for b in bitmaps])
    found_a, found_b, apart = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0)]
    bands = {w: np.flatnonzero(widths == w) for w in np.unique(widths).tolist()}
    maps = {w: np.frombuffer(b"".join(bitmaps[i] for i in at), np.uint64).reshape(len(at), w // 8)
            for w, at in bands.items()}
    sides = np.zeros((int(tile.max(initial=0)) + 1, 2), bool)
    sides[tile, side] = True
    two_sides = sides.all(axis=1)[tile]
    for w, rows in bands.items():
        for w2, others in bands.items():
            if w2 < w:
                continue
            small = fold(maps[w2], w // 8)
            for a in range(0, len(rows), 128):
                ra = rows[a:a + 128]
                for b in range(0, len(others), 1024):
                    rb = others[b:b + 1024]
                    ok = (comps[ra][:, None] != comps[rb][None, :]) & (tile[ra][:, None] == tile[rb][None, :])
                    ok &= home[ra][:, None] | home[rb][None, :]
                    ok &= (side[ra][:, None] != side[rb][None, :]) | ~two_sides[ra][:, None]
                    low = np.minimum(sizes[ra][:, None], sizes[rb][None, :])
                    high = np.maximum(sizes[ra][:, None], sizes[rb][None, :])
                    ok &= 100 * low >= percent * high
                    if w == w2:
                        ok &= ra[:, None] < rb[None, :]
                    i, j = np.nonzero(ok)
                    if not len(i):
                        continue
                    differing = np.zeros(len(i), np.int64)
                    for x in range(w // 8):
                        differing += np.bitwise_count(maps[w][a:a + 128][i, x] ^ small[b:b + 1024][j, x])
                    good = may_link(sizes[ra[i]], sizes[rb[j]], differing, percent)
                    found_a.append(ra[i[good]])
                    found_b.append(rb[j[good]])
                    apart.append(differing[good] / (sizes[found_a[-1]] + sizes[found_b[-1]]))
    return np.concatenate(found_a), np.concatenate(found_b), np.concatenate(apart)


def nearest_of_each(a: np.ndarray, b: np.ndarray, apart: np.ndarray) -> np.ndarray:
    """Which pairs are the nearest one of either of their rows (the first of equals)."""
    row = np.concatenate([a, b])
    order = np.lexsort((np.concatenate([apart, apart]), row))
    first = np.ones(len(order), bool)
    first[1:] = row[order[1:]] != row[order[:-1]]
    return np.unique(order[first] % max(len(a), 1))


def tiled_pairs(rows: DataFrame, percent: int, nearest: bool, together: int = 256) -> DataFrame:
    """(a, b), a < b: what ``cross_pairs`` finds in every tile, or each row's nearest of
    it; input sorted by tile. Small tiles are searched ``together`` rows at a time."""
    columns = ["id", "n", "comp", "side", "home", "bitmap"]

    def search(parts: list[tuple[int, pa.Table]]):
        t = pa.concat_tables([p for _, p in parts])
        tile = np.repeat(np.arange(len(parts)), [p.num_rows for _, p in parts])
        number = np.unique([k for k, _ in parts], return_inverse=True)[1]
        ids, n, comp, side, home = (t[c].to_numpy() for c in columns[:5])
        a, b, apart = cross_pairs(number[tile], n, comp, side, home.astype(bool), t["bitmap"].to_pylist(), percent)
        if nearest:
            best = nearest_of_each(a, b, apart)
            a, b = a[best], b[best]
        pairs = np.unique(np.sort(np.column_stack([ids[a], ids[b]]), axis=1), axis=0)
        return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])

    def work(batches: Iterator[pa.RecordBatch]):
        last, number, parts, held = None, 0, [], 0
        for batch in batches:
            if not batch.num_rows:
                continue
            tile = np.column_stack([np.array(batch.column(i), np.int64) for i in range(4)])
            starts = np.concatenate([[0], np.flatnonzero((tile[1:] != tile[:-1]).any(axis=1)) + 1, [len(tile)]]).tolist()
            body = pa.Table.from_batches([batch]).select(columns)
            for a, b in zip(starts, starts[1:]):
                now = tuple(tile[a])
                if now != last:
                    if held >= together:
                        yield search(parts)
                        parts, held = [], 0
                    last, number = now, number + 1
                parts.append((number, body.slice(a, b - a)))
                held += b - a
        if parts:
            yield search(parts)

    return rows.mapInArrow(tidy(work), "a long, b long").distinct()


def banded(rows: DataFrame) -> DataFrame:
    """Rows (key, band, n, id) once for every (key, band) group in which they are compared.

    A row is at home in its own band and visits the one above, so that all
    sets of similar size meet. ``salt`` is the part of its group it is dealt to.
    """
    return rows.select("key", "n", "id", F.explode(F.array(
        F.struct(F.col("band").alias("band"), F.lit(1).alias("home")),
        F.struct((F.col("band") + 1).alias("band"), F.lit(0).alias("home")))).alias("t")).select(
        "key", F.col("t.band").alias("band"), "id", "n", F.col("t.home").alias("home"),
        F.pmod(F.xxhash64("id"), F.lit(SALTS)).cast("int").alias("salt"))


def mixed(spread: DataFrame, comp: DataFrame, repeated: bool) -> DataFrame:
    """The rows of ``banded``, with their component, in the groups that need a comparison.

    Groups of one component or without a row at home are left out and, if
    there may be ``repeated`` ones, of the groups of the same rows (by size
    and two 64-bit hashes) all but one.
    """
    placed = (spread.join(comp, F.col("id") == F.col("node"), "left")
              .select("key", "band", "id", "n", F.coalesce("component", "id").alias("comp"), "home", "salt"))
    facts = [F.min("comp").alias("low"), F.max("comp").alias("high"), F.max("home").alias("any_home"),
             F.collect_set("salt").alias("salts")]
    mark = F.struct("id", "home")
    if repeated:
        facts += [F.count(F.lit(1)).alias("size"), F.bit_xor(F.xxhash64(mark)).alias("one"),
                  F.bit_xor(F.xxhash64(F.lit(1), mark)).alias("two")]
    once = placed.groupBy("key", "band").agg(*facts).where((F.col("low") < F.col("high")) & (F.col("any_home") == 1))
    if repeated:
        # documents that share many keys without linking are the same group on each of them
        once = (once.groupBy("band", "size", "one", "two").agg(F.min_by(F.struct("key", "salts"), "key").alias("g"))
                .select(F.col("g.key").alias("key"), "band", F.col("g.salts").alias("salts")))
    # a group's rows are found again by (key, band, salt): a large one is spread over its salts
    return placed.join(once.select("key", "band", F.explode("salts").alias("salt")), ["key", "band", "salt"])


def tiles(rows: DataFrame, block: int) -> DataFrame:
    """Rows (key, band, id, n, comp, home, bitmap) dealt into tiles of bounded size.

    The rows of a group's largest component meet only the others, which also
    meet each other. Both kinds are split into blocks of about ``block``
    rows, and every pair of blocks that must meet is a tile.
    """
    per = rows.groupBy("key", "band", "comp").agg(F.count(F.lit(1)).alias("m"), F.collect_set("salt").alias("salts"))
    group = (per.groupBy("key", "band").agg(F.max_by("comp", F.struct("m", "comp")).alias("major"),
                                            F.max("m").alias("major_rows"), (F.sum("m") - F.max("m")).alias("minor_rows"),
                                            F.array_distinct(F.flatten(F.collect_list("salts"))).alias("salts"))
             .select("key", "band", "major", F.ceil(F.col("major_rows") / block).cast("int").alias("majors"),
                     F.ceil(F.col("minor_rows") / block).cast("int").alias("minors"), F.explode("salts").alias("salt")))
    j = rows.join(group, ["key", "band", "salt"])
    of_major = F.pmod(F.xxhash64("id"), F.col("majors")).cast("int")
    of_minor = F.pmod(F.xxhash64("id"), F.col("minors")).cast("int")

    def upto(n):
        return F.sequence(F.lit(0), n - 1)

    # a tile is a pair of blocks; those of two blocks of minor rows have x below zero
    against = F.when(F.col("comp") == F.col("major"), F.transform(upto(F.col("minors")), lambda y: F.struct(
        of_major.alias("x"), y.alias("y"), F.lit(0).alias("side")))).otherwise(F.concat(
            F.transform(upto(F.col("majors")), lambda x: F.struct(x.alias("x"), of_minor.alias("y"), F.lit(1).alias("side"))),
            F.transform(upto(F.col("minors")), lambda o: F.struct(
                (-1 - F.least(o, of_minor)).alias("x"), F.greatest(o, of_minor).alias("y"),
                F.when(of_minor > o, 1).otherwise(0).alias("side")))))
    return (j.select("key", "band", "id", "n", "comp", "home", "bitmap", F.explode(against).alias("t"))
            .select("key", "band", F.col("t.x").alias("x"), F.col("t.y").alias("y"), "id", "n", "comp",
                    F.col("t.side").alias("side"), "home", "bitmap")
            .repartition("key", "band", "x", "y").sortWithinPartitions("key", "band", "x", "y"))


def copies_of(sized: DataFrame, salts: int = 256) -> DataFrame:
    """(id, first): documents whose set an earlier id has too, and the first id that has it.

    A set's first id is matched back by (set, salt), so one that a third of all
    documents have is spread over the salts. An id with several rows may come more than once.
    """
    salt = F.pmod(F.xxhash64("id"), F.lit(salts)).alias("salt")
    rows = sized.select("digest", "id").withColumn("salt", salt)
    part = rows.groupBy("digest", "salt").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("m"))
    whole = (part.groupBy("digest").agg(F.min("first").alias("first"), F.sum("m").alias("m"),
                                        F.collect_list("salt").alias("salts"))
             .where("m > 1").select("digest", "first", F.explode("salts").alias("salt")))
    return rows.join(whole, ["digest", "salt"]).where("id <> first").select("id", "first")


def near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", words: int = 5,
                    percent: int = 80, buckets: int = 1 << 21, block: int = 1024, rounds: int = 2) -> DataFrame:
    """``id_col``, ``n_shingles`` and ``component_id`` of every row.

    A text's set are its distinct shingles of ``words`` words (runs without
    ASCII white space, A-Z lower-cased); a shorter text is one shingle, a
    text without words is empty and linked with nothing. Two documents link
    when 100 times their intersection is at least ``percent`` times their
    union; ``component_id`` is the smallest id reachable by links, itself
    included. Shingles are compared by 64-bit hashes.

    A NULL text is empty. Rows with one id are one document that links by
    any of its texts; each row is returned. Rows without an id take no part
    and have no component. Ids must be integers. Other columns are not read.
    An empty table gives an empty result. ``buckets`` (a power of two) and
    ``block`` bound memory, ``rounds`` are the rounds of nearest rows; results
    do not depend on them. Runs its jobs at the call.
    """
    spark = docs.sparkSession
    texts = docs.select(quoted(id_col).cast("long").alias("id"), quoted(text_col).cast("string").alias("text"))

    def sketch(batches):
        counts = np.zeros(buckets, np.int64)
        names = ["id", "n", "digest", "bitmap", "segment"]
        for part, data, offsets in text_chunks(batches, "text"):
            sets = shingle_sets(data, offsets, words)
            if sets:
                counts += np.bincount((np.concatenate(sets) & np.uint64(buckets - 1)).astype(np.int64), minlength=buckets)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array([len(s) for s in sets], pa.int64()),
                 pa.array([xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets], pa.binary()),
                 pa.array([parity_bitmap(s).tobytes() if len(s) else None for s in sets], pa.binary()),
                 pa.nulls(len(sets), pa.int32())], names=names)
        # the task's counters follow its documents, in the column of the bitmaps
        for segment, part in count_rows(counts):
            yield pa.RecordBatch.from_arrays([pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()), pa.nulls(1, pa.binary()),
                                              pa.array([part], pa.binary()), pa.array([segment], pa.int32())], names=names)

    written = saved(texts.mapInArrow(tidy(sketch), "id long, n long, digest binary, bitmap binary, segment int"),
                    "shingle-sketches")
    sketches = written.where("segment IS NULL").drop("segment")
    sized = sketches.where(F.col("id").isNotNull() & (F.col("n") > 0))
    counted = written.where("segment IS NOT NULL").select("segment", F.col("bitmap").alias("counts"))
    table = spark.sparkContext.broadcast(count_table(counted, buckets))  # 4 bytes a bucket
    # documents of one set are one from here on: the first of them stands for those left out
    copies = saved(copies_of(sized), "shingle-copies")
    left_out = (copies.join(sized.groupBy("id").count().where("count = 1").drop("count"), "id")
                .select(F.col("id").alias("copy")).distinct())
    known = saved(sized.join(left_out, F.col("id") == F.col("copy"), "left_anti"), "shingle-sets")
    read = spark.sparkContext.broadcast(id_filter(known.select("id")))  # a fixed number of bits

    def prefix(batches):
        counts, bits = table.value, np.frombuffer(read.value, np.uint8)
        for part, data, offsets in text_chunks(batches, "text"):
            ids = np.array(part.column(0).fill_null(0), np.int64)
            sets = shingle_sets(data, offsets, words)
            # a copy that the filter lets through follows its first document on every key and links nothing
            wanted = id_bits(ids, bits) & ~np.array(part.column(0).is_null())
            keys = [rarest(s, counts, percent) if w else s[:0] for s, w in zip(sets, wanted)]
            doc = np.repeat(np.arange(len(sets)), [len(k) for k in keys])
            flat = np.concatenate(keys) if keys else np.zeros(0, np.uint64)
            sizes = np.array([len(s) for s in sets], np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(flat.view(np.int64)), pa.array(sizes[doc]), pa.array(ids[doc])], names=["key", "n", "id"])

    shared = saved(shared_keys(texts.mapInArrow(tidy(prefix), "key long, n long, id long"), percent), "shared-keys")
    stars = (shared.select(F.col("id").alias("b"), F.explode(F.array("leader", "lower")).alias("a"))
             .where(F.col("a") != F.col("b")).select("a", "b").distinct())
    bounded = bounded_pairs(stars, known, percent)
    links = (bounded.where("same").select("a", "b")
             .unionByName(exact_links(bounded.where(~F.col("same")).select("a", "b"), texts, words, percent)))
    comp = components(links.unionByName(copies.select(F.col("id").alias("a"), F.col("first").alias("b"))))

    # components only grow, so a group that needs no comparison now will not need one in a later round
    rows = saved(mixed(banded(shared.select("key", "band", "n", "id").distinct()), comp, True), "mixed-keys")
    left = rounds
    while True:
        tiled = tiles(rows.join(known.select("id", "n", "bitmap"), ["id", "n"]), block)
        more = exact_links(tiled_pairs(tiled, percent, left > 0), texts, words, percent)
        grown = not more.isEmpty()
        if grown:
            # the components so far stand for the links that made them
            comp = components(comp.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(more))
        if left <= 0:
            break
        # a round that links nothing would repeat itself: the last one is next
        left = left - 1 if grown else 0
        if grown:
            rows = saved(mixed(rows.drop("comp"), comp, False), "mixed-keys")
    out = sketches.join(comp, F.col("id") == F.col("node"), "left")
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"),
                      F.coalesce("component", "id").alias("component_id"))


FILTER_BITS = 1 << 24
#: Parts that a group's rows are dealt into where group facts meet them.
SALTS = 64


def id_places(ids: np.ndarray) -> np.ndarray:
    return (mix(ids.view(np.uint64)) & np.uint64(FILTER_BITS - 1)).astype(np.int64)


def id_bits(ids: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """Which ids the filter may hold."""
    at = id_places(ids)
    return (bits[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)


def id_filter(ids: DataFrame) -> bytes:
    """A filter of fixed size over a column of ids: it holds all of them, and others by chance."""
    schema = pa.schema([("segment", pa.int32()), ("bits", pa.binary())])

    def gather(batches):
        bits = np.zeros(FILTER_BITS, bool)
        for batch in batches:
            bits[id_places(np.array(batch.column(0), np.int64))] = True
        whole = np.packbits(bits, bitorder="little")
        for i in range(0, len(whole), SEGMENT):
            if whole[i:i + SEGMENT].any():
                yield pa.RecordBatch.from_arrays([pa.array([i // SEGMENT], pa.int32()),
                                                  pa.array([whole[i:i + SEGMENT].tobytes()])], schema=schema)

    def join(batches):
        found: dict[int, np.ndarray] = {}
        for batch in batches:
            for i, bits in zip(*(c.to_pylist() for c in batch.columns)):
                found[i] = found.get(i, np.uint8(0)) | np.frombuffer(bits, np.uint8)
        for i, bits in found.items():
            yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([bits.tobytes()])], schema=schema)

    ddl = "segment int, bits binary"
    out = bytearray(FILTER_BITS // 8)
    joined = (ids.mapInArrow(tidy(gather), ddl).repartition("segment").coalesce(SEGMENT_TASKS)
              .mapInArrow(tidy(join), ddl))
    for r in joined.collect():  # the filter's size at most
        out[r["segment"] * SEGMENT:(r["segment"] + 1) * SEGMENT] = r["bits"]
    return bytes(out)


def bounded_pairs(pairs: DataFrame, known: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sizes and bitmaps allow a link, and whether their sets are the ``same``."""
    left = known.select(F.col("id").alias("a"), *[F.col(c).alias(f"a_{c}") for c in ("n", "digest", "bitmap")])
    right = known.select(F.col("id").alias("b"), *[F.col(c).alias(f"b_{c}") for c in ("n", "digest", "bitmap")])
    near = pairs.join(left, "a").join(right, "b").where(
        100 * F.least("a_n", "b_n") >= percent * F.greatest("a_n", "b_n"))

    def bound(batches):
        for batch in batches:
            size_a, size_b = np.array(batch.column(2)), np.array(batch.column(3))
            differing = np.zeros(batch.num_rows, np.int64)
            for i, (x, y) in enumerate(zip(batch.column(5), batch.column(6))):
                x = np.frombuffer(x.as_py(), np.uint64)[None, :]
                y = np.frombuffer(y.as_py(), np.uint64)[None, :]
                least = min(x.shape[1], y.shape[1])
                differing[i] = np.bitwise_count(fold(x, least) ^ fold(y, least)).sum()
            same = np.array(batch.column(4))
            good = np.flatnonzero(may_link(size_a, size_b, differing, percent) | same)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(good)), batch.column(1).take(pa.array(good)),
                                              pa.array(same[good])], names=["a", "b", "same"])

    same = (F.col("a_digest") == F.col("b_digest")).alias("same")
    return saved(near.select("a", "b", "a_n", "b_n", same, "a_bitmap", "b_bitmap")
                 .mapInArrow(tidy(bound), "a long, b long, same boolean"), "bounded-pairs")


def exact_links(pairs: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """The pairs (a, b) that link: those with enough common shingles."""
    spark = pairs.sparkSession
    pairs = saved(pairs, "pairs")
    needed = pairs.select(F.explode(F.array("a", "b")).alias("id"))
    wanted = spark.sparkContext.broadcast(id_filter(needed))  # a fixed number of bits

    def arrays(batches):
        bits = np.frombuffer(wanted.value, np.uint8)
        for part, data, offsets in text_chunks(
                (b.filter(pa.array(id_bits(np.array(b.column(0).fill_null(0), np.int64), bits))) for b in batches), "text"):
            sets = shingle_sets(data, offsets, words)
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array([s.tobytes() for s in sets], pa.binary())],
                                             names=["id", "shingles"])

    sets = saved(texts.mapInArrow(tidy(arrays), "id long, shingles binary"), "shingle-arrays")

    def decide(batches):
        for batch in batches:
            good = []
            for i, (x, y) in enumerate(zip(batch.column(2), batch.column(3))):
                x, y = np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64)
                common = len(np.intersect1d(x, y, assume_unique=True))
                if common and 100 * common >= percent * (len(x) + len(y) - common):
                    good.append(i)
            at = pa.array(good, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(1).take(at)], names=["a", "b"])

    checked = (pairs.join(sets.select(F.col("id").alias("a"), F.col("shingles").alias("a_shingles")), "a")
               .join(sets.select(F.col("id").alias("b"), F.col("shingles").alias("b_shingles")), "b")
               .select("a", "b", "a_shingles", "b_shingles").mapInArrow(tidy(decide), "a long, b long"))
    return saved(checked, "links")
