"""Main text of web pages: block structure, then a suffix array per host.

Every page is cut into text blocks, leaving out what markup says is no
article text (menus, forms, adverts, comments and so on). The token streams
of a host's pages are joined and their suffixes sorted to the depth of
``depth`` tokens; runs that repeat on many distinct pages are boilerplate.
Blocks covered by such runs are removed, the unique runs stay.

A large host is split into shards of bounded size, but its runs are counted
over the whole host. Distinct pages are dealt by a hash of their text, so the
shards' counts add up; a run on a share of the host's pages is on that share
of some shard's at least, so each shard first names the runs it has that
often. These are then counted in every shard and summed, and the shards drop
those that reach the host's thresholds.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from cohortkit.llm.common import packed, quoted, saved, unpacked
from cohortkit.llm.words import windows

TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|<[/?!a-zA-Z][^>]*+>""", re.S)
ATTRIBUTE = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
WORD = re.compile(r"[a-z]+|[0-9]+")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe svg math object canvas select audio video".split())
DROPPED = frozenset("head nav footer aside form dialog menu button fieldset".split())
BLOCKS = frozenset("""address article aside blockquote body caption dd details div dl dt fieldset figcaption figure footer
form h1 h2 h3 h4 h5 h6 header hr li main nav ol p pre section summary table tbody tfoot thead tr ul""".split())
CELLS = frozenset(("br", "td", "th", "option"))
MAIN = frozenset(("article", "main"))
#: Words in class, id or role that mark a part as no article text.
HINTS = frozenset("""ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies
consent gdpr notice notices notification alert popup modal overlay newsletter subscribe subscription signup nav navbar
navigation menu menubar breadcrumb breadcrumbs sidebar complementary widget related recommended share sharing social
comment comments reply replies respond discussion disqus footer contentinfo toolbar pagination pager login search
skip copyright form dialog""".split())
HEADERS = frozenset(("header", "masthead"))
#: Words that may stand beside one of those in a class or id without changing what it says.
GENERIC = frozenset("""area bar block box btn button buttons container content global group inner item items left links
list main outer page post primary right row secondary section site top bottom form wrap wrapper""".split())
#: Of ``RAW`` those that a tag can't close itself and that hold no elements.
SCRIPTS = frozenset("script style textarea title".split())

# What makes a run boilerplate, see ``unique_blocks``.
DEPTH = 8
MIN_PAGES, SHARE = 4, 0.02
ARTICLE_PAGES, ARTICLE_SHARE = 10, 0.6
COVERED = 0.9
SEEN = 1 << 16  # page texts a task remembers


@dataclass
class Block:
    text: str
    inside: bool  # within an article or main element


def attributes(source: str) -> dict[str, str]:
    return {m[1].lower(): m[2] or m[3] or m[4] or "" for m in ATTRIBUTE.finditer(source)}


def hidden(tag: str, source: str, inside: bool) -> bool:
    """Whether markup alone says that an element holds no article text."""
    if tag in DROPPED or (tag == "header" and not inside):
        return True
    if not source.strip() or tag in ("html", "body") or tag in MAIN:
        return False
    a = attributes(source)
    if "hidden" in a or a.get("aria-hidden", "").lower() == "true" \
            or "display:none" in a.get("style", "").replace(" ", "").lower():
        return True
    return any(telling(name, inside) for name in " ".join((a.get("class", ""), a.get("id", ""), a.get("role", ""))).split())


def telling(name: str, inside: bool) -> bool:
    """Whether a class, id or role names a part that is no article text: all its words do, or are
    generic. ``with-sidebar`` and ``search-results-article`` say something else."""
    words = WORD.findall(name.lower())
    marks = [w in HINTS or (w in HEADERS and not inside) for w in words]
    return any(marks) and all(m or w in GENERIC for m, w in zip(marks, words))


def raw_end(page: str, tag: str, at: int) -> int:
    """Where the content of a raw element ends, those of its kind within it included; -1 without an end tag."""
    open_tags, end = 1, -1
    for m in re.compile(rf"<(/?){re.escape(tag)}\b[^>]*>?", re.I).finditer(page, at):
        if m[1]:
            open_tags, end = open_tags - 1, m.end()
            if not open_tags or tag in SCRIPTS:
                break
        elif tag not in SCRIPTS and not m[0].endswith("/>"):
            open_tags += 1
    return end


def blocks(page: str) -> list[Block]:
    """The page's text blocks in order, references decoded, white space made single."""
    out: list[Block] = []
    gathered: list[str] = []
    stack: list[tuple[str, bool, bool]] = []  # tag, hidden, inside main
    opened: Counter[str] = Counter()  # open elements by tag
    # open blocks, the innermost last: place in the stack, other elements open between it and the next by tag
    frames: list[tuple[int, Counter[str]]] = [(-1, Counter())]
    endless: set[str] = set()  # tags without an end tag in the rest of the page
    off = inside = False
    at = 0

    def flush() -> None:
        text = " ".join("".join(gathered).split())
        gathered.clear()
        if text:
            out.append(Block(text, inside))

    def say(text: str) -> None:
        if text and not off:
            gathered.append(html.unescape(text) if "&" in text else text)

    def close(depth: int) -> None:
        nonlocal off, inside
        end = len(stack)
        while frames[-1][0] >= depth:
            end = frames.pop()[0]
        frames[-1][1].subtract(name for name, *_ in stack[depth:end])
        opened.subtract(name for name, *_ in stack[depth:])
        del stack[depth:]
        off, inside = (stack[-1][1], stack[-1][2]) if stack else (False, False)

    def last(tag: str) -> int:
        return next(i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == tag)

    while at < len(page):
        m = TOKEN.search(page, at)
        if not m:
            say(page[at:])
            break
        say(page[at:m.start()])
        at = m.end()
        if not m[2]:
            continue  # a comment or declaration
        tag = m[2].lower()
        if tag in BLOCKS or tag in MAIN:
            flush()
        elif tag in CELLS:
            gathered.append(" ")
        if m[1]:
            # what is searched is closed, and no search begins without something to find; an
            # inline end tag does not close blocks opened after it
            if opened[tag] if tag in BLOCKS else frames[-1][1][tag]:
                close(last(tag))
            continue
        empty = m[3].rstrip().endswith("/")
        if tag in RAW and not (empty and tag not in SCRIPTS):
            end = raw_end(page, tag, at) if tag not in endless else -1
            if end >= 0:
                at = end
            elif tag in SCRIPTS:
                at = len(page)
            else:
                endless.add(tag)
            continue
        if tag in VOID or tag in RAW or empty and tag not in BLOCKS:
            continue
        if tag in BLOCKS or tag in ("td", "th"):
            # these end an open paragraph, an item the one before it
            until = {"li": ("li",), "tr": ("tr",), "dt": ("dt", "dd"), "dd": ("dt", "dd")}.get(tag, ())
            block = frames[-1][0]
            if block >= 0 and (stack[block][0] == "p" or stack[block][0] in until):
                close(block)
        within = inside or tag in MAIN
        if tag in BLOCKS:
            frames.append((len(stack), Counter()))
        else:
            frames[-1][1][tag] += 1
        opened[tag] += 1
        stack.append((tag, off or hidden(tag, m[3], inside), within and not off))
        off, inside = stack[-1][1], stack[-1][2]
    flush()
    return out


def article_blocks(page: str) -> list[Block]:
    """The blocks of the article and main elements if there are any, else all."""
    found = blocks(page)
    return [b for b in found if b.inside] or found


def ranks(tokens: np.ndarray, depth: int) -> np.ndarray:
    """Ranks of all suffixes by their first ``depth`` tokens: a suffix array built by
    doubling, stopped at that depth. Equal ranks mean equal runs."""
    rank, done = np.unique(tokens, return_inverse=True)[1].astype(np.int64), 1
    while done < depth:
        step = min(done, depth - done)
        ahead = np.full(len(rank), -1, np.int64)
        ahead[:-step] = rank[step:]
        rank = np.unique(rank * (len(rank) + 1) + ahead + 1, return_inverse=True)[1].astype(np.int64)
        done += step
    return rank


def pages_with(rank: np.ndarray, page: np.ndarray) -> np.ndarray:
    """On how many distinct pages each suffix's run occurs."""
    order = np.lexsort((page, rank))
    r, p = rank[order], page[order]
    new_rank = np.ones(len(r), bool)
    new_rank[1:] = r[1:] != r[:-1]
    new_page = new_rank.copy()
    new_page[1:] |= p[1:] != p[:-1]
    group = np.cumsum(new_rank) - 1
    out = np.empty(len(rank), np.int64)
    out[order] = np.bincount(group, new_page).astype(np.int64)[group]
    return out


@dataclass
class Stream:
    """Pages as one token stream: 0 ends a block, a negative value of its own a page."""
    tokens: np.ndarray
    page_of: np.ndarray  # equal pages have the number of their first
    spans: list[list[tuple[int, int]]]  # of each page's blocks
    ends: np.ndarray  # where each page begins, and the end
    n_pages: int  # distinct ones


def stream(pages: list[list[Block]]) -> tuple[Stream, list[str]]:
    """The stream and its vocabulary; tokens are places in it, from 1."""
    vocabulary: dict[str, int] = {}
    tokens: list[int] = []
    page_of: list[int] = []
    spans: list[list[tuple[int, int]]] = []
    ends = [0]
    distinct: dict[tuple[str, ...], int] = {}
    for p, page in enumerate(pages):
        same = distinct.setdefault(tuple(b.text for b in page), p)
        own = []
        for b in page:
            ids = [vocabulary.setdefault(w, len(vocabulary) + 1) for w in b.text.split()]
            own.append((len(tokens), len(tokens) + len(ids)))
            tokens += ids
            tokens.append(0)  # the end of a block
            page_of += [same] * (len(ids) + 1)
        tokens.append(-1 - p)  # the end of a page, equal to no other
        page_of.append(same)
        spans.append(own)
        ends.append(len(tokens))
    return Stream(np.array(tokens, np.int64), np.array(page_of, np.int64), spans, np.array(ends), len(distinct)), list(vocabulary)


def run_hashes(s: Stream, vocabulary: list[str], depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the runs that end before their page does, the same in every shard, and their places."""
    words = np.array([1] + [xxhash.xxh3_64_intdigest(w) for w in vocabulary], np.uint64)
    # the page's end takes no part: a run with it repeats nowhere
    inner = s.tokens >= 0
    at = np.flatnonzero(inner)
    found, first = windows(words[s.tokens[at]], np.concatenate([[0], np.cumsum(inner)])[s.ends], depth)
    return found.view(np.int64), at[first]


def uncovered(pages: list[list[Block]], s: Stream, loose: np.ndarray, strict: np.ndarray, *, depth: int,
              covered: float) -> list[list[str]]:
    """Each page's blocks but those covered by the runs at places ``loose``, or ``strict`` in articles."""
    def cover(at: np.ndarray) -> np.ndarray:
        edge = np.zeros(len(s.tokens) + depth + 1, np.int32)
        np.add.at(edge, at, 1)
        np.add.at(edge, at + depth, -1)
        # a run up to the end of a page is shorter than depth, and unique by that end
        return np.concatenate([[0], np.cumsum(np.cumsum(edge)[:len(s.tokens)] > 0)])

    outside, inside = cover(loose), cover(strict)
    return [[b.text for b, (i, j) in zip(page, own)
             if (c := inside if b.inside else outside)[j] - c[i] < covered * (j - i)]
            for page, own in zip(pages, s.spans)]


def unique_blocks(pages: list[list[Block]], *, depth: int = DEPTH, min_pages: int = MIN_PAGES, share: float = SHARE,
                  article_share: float = ARTICLE_SHARE, article_pages: int = ARTICLE_PAGES,
                  covered: float = COVERED) -> list[list[str]]:
    """Each page's blocks but those covered by runs that repeat across the pages.

    Outside an article element a run is boilerplate on ``min_pages`` distinct
    pages and ``share`` of them; inside, where markup speaks for the text, on
    ``article_pages`` and ``article_share``. Pages of equal text count once.
    """
    s, _ = stream(pages)
    if s.n_pages < min_pages:
        return [[b.text for b in page] for page in pages]
    found = pages_with(ranks(s.tokens, depth), s.page_of)
    return uncovered(pages, s, np.flatnonzero(found >= max(min_pages, share * s.n_pages)),
                     np.flatnonzero(found >= max(article_pages, article_share * s.n_pages)), depth=depth, covered=covered)


def frequent_runs(pages: list[list[Block]]) -> tuple[int, np.ndarray]:
    """Number of a shard's distinct pages, and the runs on such a share of them that they can be
    boilerplate of the host: one on less than that in every shard is on less in all."""
    s, vocabulary = stream(pages)
    if not s.n_pages:
        return 0, np.zeros(0, np.int64)
    runs, at = run_hashes(s, vocabulary, DEPTH)
    found = pages_with(ranks(s.tokens, DEPTH), s.page_of)[at]
    return s.n_pages, np.unique(runs[found >= min(SHARE, ARTICLE_SHARE) * s.n_pages - 1e-9])


def counted_runs(pages: list[list[Block]], asked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """On how many of a shard's distinct pages the runs ``asked`` for occur, for those that do."""
    s, vocabulary = stream(pages)
    runs, at = run_hashes(s, vocabulary, DEPTH)
    hit = np.isin(runs, asked)
    runs, at = runs[hit], at[hit]
    found = pages_with(runs, s.page_of[at])
    runs, first = np.unique(runs, return_index=True)
    return runs, found[first]


def blocks_without(pages: list[list[Block]], loose: np.ndarray, strict: np.ndarray) -> list[list[str]]:
    """Each page's blocks but those covered by the given runs."""
    s, vocabulary = stream(pages)
    runs, at = run_hashes(s, vocabulary, DEPTH)
    return uncovered(pages, s, at[np.isin(runs, loose)], at[np.isin(runs, strict)], depth=DEPTH, covered=COVERED)


def main_text(pages: DataFrame, *, html_col: str = "html", url_col: str = "url", id_col: str = "page_id",
              columns: list[str] | None = None, shard_pages: int = 256) -> DataFrame:
    """``columns`` of the input (default: all but the page source) and ``text``: the article's
    blocks in page order joined by two line feeds, empty if there are none.

    An input column ``text`` is replaced. A NULL page is empty; a page
    without a URL belongs to a host of its own kind. Rows repeat as given;
    equal pages count once when repeats are counted. An empty table gives an
    empty result. Pages are compared within their host, in shards of about
    ``shard_pages``; a run's count is taken over all of the host's pages, so
    results do not depend on the shards.
    """
    names = [c for c in pages.columns if c != html_col] if columns is None else list(columns)
    host = F.lower(F.regexp_extract(F.coalesce(quoted(url_col).cast("string"), F.lit("")),
                                    r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))
    # by the page first: a page of very many copies is spread
    copies = pages.select(host.alias("host"), F.xxhash64(quoted(html_col)).alias("page")).groupBy("host", "page") \
        .agg(F.count(F.lit(1)).alias("n"))
    large = saved(copies.groupBy("host").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("pages"))
                  .where(F.col("n") > shard_pages)
                  .select(F.col("host").alias("large_host"), F.ceil(F.col("n") / shard_pages).cast("int").alias("shards"),
                          F.ceil(F.col("pages") / shard_pages).cast("int").alias("counting")),
                  "large-hosts")
    rows = pages.select(packed(pages.select([quoted(c) for c in names])).alias("row"), host.alias("host"),
                        F.xxhash64(quoted(id_col), quoted(url_col)).alias("key"), quoted(html_col).cast("string").alias("html"))
    kept = rows.schema["row"]
    one = F.lit(1)
    dealt = rows.join(large, F.col("host") == F.col("large_host"), "left").select(
        "row", "host", F.coalesce("shards", one).alias("shards"), F.coalesce("counting", one).alias("counting"),
        F.pmod("key", F.coalesce("shards", one)).cast("int").alias("shard"), "html")
    kind = pa.list_(pa.struct([("text", pa.string()), ("inside", pa.bool_())]))

    def parse(batches):
        # A task's first page of a text goes to the shard of that text and counts there, once with
        # those of other tasks; its copies go anywhere.
        seen: set[tuple[str, bytes]] = set()
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                found, shard, counts = [], [], []
                for h, shards, counting, own, x in zip(*(c.to_pylist() for c in part.columns[1:])):
                    page = article_blocks(x or "")
                    found.append([{"text": b.text, "inside": b.inside} for b in page])
                    digest = xxhash.xxh3_128_digest("\n".join(b.text for b in page)) if shards > 1 else b""
                    first = shards == 1 or (h, digest) not in seen
                    if shards > 1 and first:
                        if len(seen) >= SEEN:
                            seen.clear()
                        seen.add((h, digest))
                        own = int.from_bytes(digest[:8], "little") % counting
                    shard.append(own)
                    counts.append(first)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:3], pa.array(shard, pa.int32()), pa.array(counts, pa.bool_()), pa.array(found, kind)],
                    names=["row", "host", "shards", "shard", "counts", "blocks"])

    empty = pages.sparkSession.createDataFrame(
        [], "host string, shards int, shard int, counts boolean, blocks array<struct<text:string,inside:boolean>>")
    cut = dealt.mapInArrow(parse, StructType([kept, *empty.schema]))
    # all three passes over the shards group the same rows in the same way, which are shuffled once
    shards_of = cut.groupBy("host", "shard")

    def parsed(group: pa.Table, counting: bool) -> list[list[Block]]:
        found = group["blocks"].filter(group["counts"]) if counting else group["blocks"]
        return [[Block(b["text"], b["inside"]) for b in x] for x in found.to_pylist()]

    def one_host(group: pa.Table, runs, n, pages_on) -> pa.Table:
        return pa.table([pa.array([group["host"][0].as_py()] * len(runs), pa.string()),
                         pa.array([group["shards"][0].as_py()] * len(runs), pa.int32()), pa.array(runs, pa.int64()),
                         pa.array(pages_on, pa.int64()), pa.array(n, pa.int64())], names=["host", "shards", "run", "pages", "n"])

    def name_runs(group: pa.Table) -> pa.Table:
        if group["shards"][0].as_py() == 1:
            return one_host(group, [], [], [])
        n, runs = frequent_runs(parsed(group, True))
        return one_host(group, [None, *runs.tolist()], [n] + [0] * len(runs), [0] * (len(runs) + 1))

    def count_runs(group: pa.Table, asked: pa.Table) -> pa.Table:
        if not group.num_rows or not asked.num_rows:
            return one_host(group if group.num_rows else asked, [], [], [])
        runs, found = counted_runs(parsed(group, True), asked["runs"].combine_chunks().flatten().to_numpy())
        return one_host(group, runs, np.full(len(runs), asked["n"][0].as_py()), found)

    def clean(group: pa.Table, known: pa.Table) -> pa.Table:
        found = parsed(group, False)
        if not found:
            texts = []
        elif group["shards"][0].as_py() == 1:
            texts = unique_blocks(found)
        elif not known.num_rows:
            texts = [[b.text for b in page] for page in found]
        else:
            listed = known["runs"].combine_chunks().flatten()
            runs, on = (listed.field(i).to_numpy() for i in (0, 1))
            n = known["n"][0].as_py()
            texts = blocks_without(found, runs[on >= max(MIN_PAGES, SHARE * n)], runs[on >= max(ARTICLE_PAGES, ARTICLE_SHARE * n)])
        return pa.table({"row": group["row"], "text": pa.array(["\n\n".join(x) for x in texts], pa.string())})

    def to_shards(hosts: DataFrame):
        return hosts.withColumn("shard", F.explode(F.sequence(F.lit(0), F.col("shards") - 1))).groupBy("host", "shard")

    ddl = "host string, shards int, run long, pages long, n long"
    named = shards_of.applyInArrow(name_runs, ddl).groupBy("host").agg(
        F.max("shards").alias("shards"), F.sum("n").alias("n"), F.collect_set("run").alias("runs"))
    counted = shards_of.cogroup(to_shards(named)).applyInArrow(count_runs, ddl).groupBy("host", "run").agg(
        F.max("shards").alias("shards"), F.sum("pages").alias("pages"), F.max("n").alias("n"))
    # of a page's length at most 1 / share runs a token are on that share of the pages
    known = counted.where((F.col("pages") >= F.greatest(F.lit(MIN_PAGES), SHARE * F.col("n")))
                          | (F.col("pages") >= F.greatest(F.lit(ARTICLE_PAGES), ARTICLE_SHARE * F.col("n")))) \
        .groupBy("host").agg(F.max("shards").alias("shards"), F.max("n").alias("n"),
                             F.collect_list(F.struct("run", "pages")).alias("runs"))
    out = shards_of.cogroup(to_shards(known)).applyInArrow(clean, StructType([kept, StructField("text", StringType())]))
    return out.select(unpacked(out, [c for c in names if c != "text"] + ["text"], {"text": F.col("text")}))
