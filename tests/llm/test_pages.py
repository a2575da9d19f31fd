"""Main text of pages against what was put into them."""

import html
import re

import pyarrow as pa
import pytest

from retail_layers.llm import pages, queries

SF01 = "/root/testdata/sf0.01"


def plain(page):
    """Articles of the given pages, whose form is known."""
    inside = re.search(r"<article>(.*)</article>", page, re.S)[1]
    found = (" ".join(html.unescape(re.sub(r"<[^>]*>", " " if False else "", x.replace("<br>", " "))).split())
             for x in re.split(r"</?(?:p|h1)>", inside))
    return "\n".join(x for x in found if x)


def test_given_pages(spark, given):
    want = {r["page_id"]: plain(r["html"]) for r in given("pages", SF01).collect()}
    rows = queries.op4_pages(spark, SF01).collect()
    assert {r["page_id"]: r["text"] for r in rows} == want and len(rows) == len(want)
    assert all(r["n_chars"] == len(r["text"]) for r in rows)


PAGE = """<!doctype html><HTML><head><title>Not this &amp; that</title><style>p{}</style></head><body class='x'>
<!-- <p>nor this</p> --><header><h2>Site name</h2></header><nav><ul><li><a href="/a>b">Menu</a></ul></nav>
<div id="cookie-notice">We use cookies</div><div class="wrap"><div class="sidebar">Aside</div>
<article class=post><header><h1>The  &#84;itle</h1></header><p>One<b>two</b> three&nbsp;four<br>five
<p hidden>secret<p>six &lt;7&gt; &eacute;<script>var a = "<p>no</p>"</script></p><div class="advert"><div>Buy</div> now</div>
<ul><li>eight<li>nine</ul></div><blockquote>ten</blockquote><form>Mail <input> <button>Send</button></form>
<footer>By me</footer></article><section class="comments"><article><p>First!</p></article></section>
</div><aside>More</aside><footer>End</footer>"""


def test_structure_of_one_page():
    marked, inside, outside = pages.structured(PAGE)
    assert marked
    assert inside == ["The Title", "Onetwo three four five", "six <7> é", "eight", "nine", "ten"]
    assert {"Site name", "Menu", "We use cookies", "Aside", "First!", "More", "End", "By me"} <= set(outside)


@pytest.mark.parametrize("page,want", [
    (None, []), ("", []), ("plain text", ["plain text"]), ("<p>a<p>b", ["a", "b"]), ("a < b > c", ["a < b > c"]),
    ("<p>unclosed 'quote <b class='x>y", ["unclosed 'quote <b class='x>y"]), ("<div>x</div></div></p>y", ["x", "y"]),
    ("<nav>menu <main>text</main>", ["text"]), ("<script>x", []), ("<!-- never closed <p>x", []),
])
def test_pieces(page, want):
    assert pages.structured(page)[1] == want


@pytest.mark.parametrize("inner", [
    '<div style="overflow:hidden">kept</div>', "<p>a <a href='/the-hidden-cost'>kept</a></p>", '<p title="A hidden gem">kept</p>',
    '<p title="class=advert id=menu">kept</p>', "<p data-hidden=1>kept</p>", "<p data-x = 'role=\"menu\"'>kept</p>",
    "<a href=/x/hidden/y>kept</a>",
])
def test_names_of_attributes_inside_values_mean_nothing(inner):
    _, inside, outside = pages.structured(f"<article><p>begin</p>{inner}<p>end</p></article>")
    assert not outside and inside[0] == "begin" and inside[1].endswith("kept") and inside[2] == "end"


@pytest.mark.parametrize("attributes", ["hidden", "HIDDEN=''", "title='x' hidden", "class=advert", "id = 'menu'", 'role="menu"', "aria-hidden=true"])
def test_attributes_that_hide(attributes):
    assert pages.structured(f"<article><p>begin</p><div {attributes}>gone</div></article>")[1] == ["begin"]


@pytest.mark.parametrize("page", [
    '<body class="no-sidebar"><article><p>kept</p></article></body>', '<article class="post has-share"><p>kept</p></article>',
    '<div id="content" class="widget-area"><p>kept</p></div>', '<article><section class="related-work"><p>kept</p></section></article>',
    '<article><div class="menu-item">kept</div></article>', '<article><p class="notice-board">kept</p></article>',
    '<body class="menu"><p>kept</p></body>', '<form action="/"><div>kept <input><button>Go</button><select><option>a</select></div></form>',
    '<div role="form"><p>kept</p></div>', '<main class="page menu"><p>kept</p></main>',
])
def test_names_are_taken_whole(page):
    assert pages.structured(page)[1] == ["kept"]


@pytest.mark.parametrize("attributes", ["class='site-footer'", "class='x cookie_notice'", "id='primary-menu'", "class='ads-container'"])
def test_names_of_several_words(attributes):
    assert pages.structured(f"<div {attributes}>gone</div><p>kept</p>")[1] == ["kept"]
    assert pages.structured("<article>kept</article><article class='comment'>gone</article>")[1] == ["kept"]


def test_one_page_under_two_urls_is_no_repetition(spark):
    page = "<body><p>" + " ".join(f"word{k}" for k in range(40)) + "</p></body>"
    rows = [(1, "https://h.example/a?utm=1", page), (2, "https://h.example/a?utm=2", page)]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    assert {r["text"] for r in pages.extract(df).collect()} == {" ".join(f"word{k}" for k in range(40))}


def unmarked(spark):
    rows = []
    top = "<div>home news about us contact press jobs help search login</div>"
    end = "<p>all rights reserved by the people who own this site since long ago</p>"
    for i in range(12):
        own = " ".join(f"w{i}x{k}" for k in range(30))
        rows.append((i, f"https://u@H.example:80/{i}" if i % 2 else f"https://h.example/{i}", f"<body>{top}<p>{own}</p>{end}</body>"))
    rows += [(50, "https://other.example/", f"<body>{top}<p>alone on its host</p></body>")] * 2
    rows += [(51, None, None), (None, "https://h.example/z", ""), (52, "https://h.example/y", f"<body>{top}</body>")]
    return spark.createDataFrame(rows, "page_id bigint, url string, html string")


def test_repeated_parts_of_a_host_go_where_no_article_is_marked(spark):
    got = sorted(((r["page_id"], r["text"]) for r in pages.extract(unmarked(spark)).collect()), key=str)
    menu = "home news about us contact press jobs help search login"
    want = [(i, " ".join(f"w{i}x{k}" for k in range(30))) for i in range(12)]
    want += [(50, f"{menu}\nalone on its host")] * 2 + [(51, ""), (None, ""), (52, "")]
    assert got == sorted(want, key=str)


def test_odd_tables(spark):
    df = unmarked(spark).selectExpr("*", "'x' as text", "'y' as _page", "1 as marked", "2 as page")
    assert pages.extract(df).count() == df.count()
    assert pages.extract(df.limit(0)).count() == 0
    long_page = spark.createDataFrame([(1, "http://a/", "<article>" + "<p>word</p>" * 50_000)], "page_id bigint, url string, html string")
    assert pages.extract(long_page).first()["text"] == "\n".join(["word"] * 50_000)


def test_stream_is_the_same_in_any_batches():
    import numpy as np
    rng = np.random.default_rng(9)
    n = 400
    table = pa.table({"host": rng.integers(0, 2, n), "tokens": rng.integers(0, 60, n), "page": rng.integers(0, 12, n),
                      "place": rng.integers(-1, 9, n)}).sort_by([(c, "ascending") for c in ("host", "tokens", "page", "place")])
    rows = table.to_pylist()
    held = {}
    for r in rows:
        held.setdefault((r["host"], r["tokens"]), set()).add(r["page"])
    want = sorted((r["page"], r["place"]) for r in rows if r["place"] >= 0 and len(held[r["host"], r["tokens"]]) > 1)
    for size in (1, 2, 7, 400):
        out = pa.Table.from_batches(list(pages._repeated(iter(table.to_batches(max_chunksize=size))))).to_pylist()
        assert sorted((r["page"], r["place"]) for r in out) == want


def test_neighbours_in_order_have_their_true_common_lengths():
    import numpy as np
    rng = np.random.default_rng(4)
    texts = [(host, page, rng.integers(1, 3, rng.integers(20, 60)).astype(np.uint64)) for host in (1, 2) for page in range(6)]
    rows = sorted((host, page, tuple(t[k:].tolist()), k) for host, page, t in texts for k in range(len(t) - 7))
    rows.sort(key=lambda r: (r[0], r[2][:pages.WIDTH], r[1], r[3]))
    codes = [pages._codes(np.array(r[2], np.uint64))[0].tobytes() for r in rows]
    assert [(r[0], c) for r, c in zip(rows, codes)] == sorted((r[0], c) for r, c in zip(rows, codes))
    table = pa.table({"host": [r[0] for r in rows], "codes": codes, "page": [r[1] for r in rows], "place": [r[3] for r in rows],
                      "need": [0] * len(rows)})

    def length(a, b):
        k = 0
        while a[0] == b[0] and k < min(len(a[2]), len(b[2]), pages.WIDTH) and a[2][k] == b[2][k]:
            k += 1
        return k

    want = [0, *(length(a, b) for a, b in zip(rows, rows[1:])), 0]
    for size in (1, 3, 1000):
        got = list(pages._common(iter(table.to_batches(max_chunksize=size))))
        assert np.concatenate([g[5] for g in got]).tolist() == want[:-1]
        assert np.concatenate([g[6] for g in got]).tolist() == want[1:]


NOTE = " ".join(f"note{k}" for k in range(37))


def test_whole_blocks_that_most_articles_of_a_host_share_go(spark):
    def own(i, n=60):
        return " ".join(f"w{i}x{k}" for k in range(n))

    shared = " ".join(f"both{k}" for k in range(30))  # of two pages
    rows, want = [], {}
    for i in range(6):
        rows.append((i, f"https://a.example/{i}", f"<article><p>{own(i)}</p><p>{NOTE}</p><p>{shared if i < 2 else own(i, 9)}</p><p>{NOTE} {own(i, 3)}</p></article>"))
        want[i] = "\n".join([own(i), shared if i < 2 else own(i, 9), f"{NOTE} {own(i, 3)}"])
    for i in range(10, 20):  # four of ten pages
        rows.append((i, f"https://b.example/{i}", f"<article><p>{own(i)}</p>" + (f"<p>{NOTE}</p>" if i < 14 else "") + "</article>"))
        want[i] = own(i) + ("\n" + NOTE if i < 14 else "")
    for i in range(20, 26):  # copies of each other
        rows.append((i, f"https://c.example/{i}", f"<article><p>{own(0)}</p><p>{NOTE}</p><p>edition {i}</p></article>"))
        want[i] = f"{own(0)}\n{NOTE}\nedition {i}"
    for i in range(30, 36):  # what a menu shows of an article is no evidence against it
        rows.append((i, f"https://d.example/{i}", f"<nav>{own(35)}</nav><article><p>{own(i)}</p></article>"))
        want[i] = own(i)
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    assert {r["page_id"]: r["text"] for r in pages.extract(df).collect()} == want


def test_repeated_strings_of_unmarked_pages_against_all_windows(spark):
    import numpy as np
    rng = np.random.default_rng(8)
    pool = [" ".join(f"p{j}t{rng.integers(0, 4)}" for _ in range(rng.integers(5, 40))) for j in range(8)]
    rows = []
    for i in range(24):
        parts = [pool[k] if k < len(pool) else " ".join(f"u{rng.integers(0, 3)}" for _ in range(rng.integers(1, 30))) for k in rng.integers(0, 14, 5)]
        rows.append((i, f"https://h{i % 3}.example/{i}", "".join(f"<p>{x}</p>" for x in parts)))
    held = {}
    for i, _, page in rows:
        words = " ".join(pages.structured(page)[1]).split()
        for k in range(len(words) - 7):
            held.setdefault((i % 3, *words[k:k + 8]), set()).add(i)
    want = {}
    for i, _, page in rows:
        parts = pages.structured(page)[1]
        words = " ".join(parts).split()
        gone = {k + j for k in range(len(words) - 7) if len(held[(i % 3, *words[k:k + 8])]) > 1 for j in range(8)}
        at, out = 0, []
        for p in parts:
            n = len(p.split())
            out.append(" ".join(w for j, w in enumerate(p.split()) if at + j not in gone))
            at += n
        want[i] = "\n".join(x for x in out if x)
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    assert {r["page_id"]: r["text"] for r in pages.extract(df).collect()} == want
