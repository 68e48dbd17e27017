import numpy as np
import pytest

from cohortkit.llm.html_text import Block, article_blocks, blocks, main_text, pages_with, ranks, unique_blocks


def texts(page):
    return [b.text for b in article_blocks(page)]


def test_structure():
    page = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head>
    <body class="ad-free"><header>site</header><nav><ul><li>menu</nav><!-- <p>c</p> --><div class="ad">buy</div>
    <article><header><h1>Title &amp; more</h1></header><p>One<b> two<br>three <p>Four&nbsp;five &lt;p&gt;
    <form><p>name <input></form><aside>side</aside><div class="cookie-notice">cookies</div><p hidden>no
    <ul><li>x<li>y</ul><p>Last <i>one</i><div id="comments"><p>reader</div></article><footer>&copy;</footer>"""
    assert texts(page) == ["Title & more", "One two three", "Four five <p>", "x", "y", "Last one"]


def test_odd_pages():
    assert texts("") == [] and texts("plain  text") == ["plain text"]
    assert texts("<p>a<p>b</p></div>c") == ["a", "b", "c"]
    assert texts("<p>a <b>b <") == ["a b <"]
    assert texts("<script>never closed <p>x") == []
    assert texts("a<br>b<!-- open") == ["a b"]
    assert texts("<div>1 < 2 & 3 &amp; 4 &#233; &eacute; &bogus;</div>") == ["1 < 2 & 3 & 4 é é &bogus;"]
    assert texts("<main><p>in</main><p>out") == ["in"]
    assert texts('<p title="a>b">c</p><p title="d>e</p>') == ["c", "e"] or texts('<p title="a>b">c</p>') == ["c"]
    assert len(texts("<p>x" * 3000)) == 3000
    deep = texts("<div>" * 5000 + "x" + "</div>" * 5000)
    assert deep == ["x"]


def test_suffix_ranks_by_brute_force():
    r = np.random.default_rng(0)
    t = r.integers(0, 3, 200)
    for depth in (1, 3, 4, 8):
        rank = ranks(t, depth)
        run = [tuple(t[i:i + depth]) for i in range(len(t))]
        assert all((rank[i] == rank[j]) == (run[i] == run[j]) for i in range(len(t)) for j in range(len(t)))
        page = np.arange(len(t)) // 20
        want = [len({page[j] for j in range(len(t)) if run[j] == run[i]}) for i in range(len(t))]
        assert pages_with(rank, page).tolist() == want


def test_boilerplate_goes_unique_runs_stay():
    notice = "this site uses cookies to make your visit better accept"
    pages = [[Block(notice, False), Block(f"own text number {i} says things nobody else says {i * 7}", False),
              Block(f"{notice} with {i} a tail of words that only page {i} has in it at all", False)] for i in range(12)]
    out = unique_blocks(pages)
    assert all(len(x) == 2 and notice not in x for x in out)
    # few pages, or markup that speaks for the text: it stays
    assert unique_blocks(pages[:3])[0][0] == notice
    inside = [[Block(notice if i < 5 else f"t{i} a b c d e f g h i", True)] for i in range(12)]
    assert all(len(x) == 1 for x in unique_blocks(inside))
    # equal pages count once
    assert all(len(x) == 3 for x in unique_blocks([pages[0]] * 12))


def test_main_text(spark):
    page = "<nav>m</nav><article><p>Own {0}</article>"
    rows = [(i, f"http://h{i % 2}.example/{i}", page.format(i), "k") for i in range(30)]
    rows += [(30, None, None, "k"), (31, "no url", "", "k"), (None, "http://h0.example/x", "<p>x", "k"), (0, rows[0][1], rows[0][2], "k")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    out = main_text(df, shard_pages=4)
    assert out.columns == ["page_id", "url", "text"]
    got = sorted((r["page_id"] is None, r["page_id"] or 0, r["text"]) for r in out.collect())
    want = sorted([(False, i, f"Own {i}") for i in range(30)] + [(False, 30, ""), (False, 31, ""), (True, 0, "x"), (False, 0, "Own 0")])
    assert got == want
    assert main_text(df.limit(0)).count() == 0


def test_blocks_keep_order():
    assert [b.text for b in blocks("<table><tr><td>a<td>b<tr><td>c</table><pre>x\n y</pre>")] == ["a b", "c", "x y"]


def test_results_do_not_depend_on_shards(spark):
    """Runs count over the host: at, above and below its limits, with copies of pages that count once."""
    r = np.random.default_rng(3)

    def notice(k):
        return " ".join(f"notice{k}word{j}" for j in range(12))

    rows = []
    for i in range(400):
        said = [notice(k) for k, on in enumerate((7, 8, 9, 12, 40, 400)) if (i * 7 + k * 31) % 400 < on]
        own = " ".join(f"w{x}" for x in r.integers(0, 10**6, 12))
        rows.append((i, f"http://big.example/{i}", "".join(f"<p>{x}</p>" for x in [*said, own])))
    # 400 distinct pages: eight are 2 %; copies of a page with the rarest notice don't make it frequent
    rare = next(x for x in rows if notice(0) in x[2])
    rows += [(1000 + i, f"http://big.example/copy{i}", rare[2]) for i in range(60)]
    rows += [(2000 + i, f"http://small.example/{i}", f"<p>{notice(9)}</p><p>{i} own") for i in range(5)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(5)
    whole = {x["page_id"]: x["text"] for x in main_text(df, shard_pages=1000).collect()}
    for i in (7, 32, 256):
        assert {x["page_id"]: x["text"] for x in main_text(df, shard_pages=i).collect()} == whole
    left = "\n".join(whole.values())
    assert [notice(k) in left for k in range(6)] == [True, False, False, False, False, False]
    assert sum(notice(0) in x for x in whole.values()) == 67


@pytest.mark.parametrize("page, text", [
    ('<article><p>First.</p><svg width="1"/><p>Second.</p></article>', ["First.", "Second."]),
    ('<article><p>First.</p><iframe src="x"/><p>Second.</p></article>', ["First.", "Second."]),
    ("<article><p>First.</p><svg><p>Second.</p></article>", ["First.", "Second."]),
    ("<article><p>First.</p><svg><svg>in</svg>out</svg><p>Second.</p></article>", ["First.", "Second."]),
    ("<article><p>How a <label>field</label> works</p></article>", ["How a field works"]),
    ('<div class="content with-sidebar"><p>Text.</p></div>', ["Text."]),
    ('<div class="post no-comments"><p>Text.</p></div>', ["Text."]),
    ('<div id="search-results-article"><p>Text.</p></div>', ["Text."]),
    ('<div class="site-sidebar"><p>Links.</p></div><p>Text.</p>', ["Text."]),
    ('<div class="x comment-list"><p>Me too.</p></div><p>Text.</p>', ["Text."]),
    ("<div><b>a<div>b</b>c</div></div>", ["a", "bc"]),
])
def test_markup_that_misled(page, text):
    assert [b.text for b in article_blocks(page)] == text


@pytest.mark.parametrize("part", ["<b>", "<b></i>", "<svg>", "<div><b></i>", "<p><b>", "<b><p></p>", "</div>", "<li><i>"])
def test_odd_markup_takes_linear_time(part):
    import time
    start = time.perf_counter()
    article_blocks("<i>" + part * 60_000 + "end")
    assert time.perf_counter() - start < 10
