import html
import random
import re

from dimhistory.llm import pages
from dimhistory.llm.queries import QUERIES

PAGE = """<html><head><title>t</title></head><body><header><h1>Site</h1></header><nav>menu</nav>
<div class="cookie-notice">We use</div><main><article><header><h1>Real &amp; title</h1></header>
<p>One <b>bo</b>ld<br>two &nbsp; three<p>para &lt;x&gt; <script>if(a<b){}</script>after
<aside>side</aside><form><input>f</form><div class="ad-slot">buy</div><footer>by</footer></article>
<section id="comments"><article class="comment"><p>nice!</p></article></section></main>
<div id="sidebar">s</div><footer>f</footer>"""


def test_what_an_article_holds():
    lines = [t for kind, t in pages.page_lines(PAGE) if kind == pages.ARTICLE]
    assert lines == ["Real & title", "One bold", "two three", "para <x> after"]


def test_lcs_is_longest_and_common():
    rng = random.Random(2)
    for _ in range(1500):
        a, b = ([rng.randint(0, 4) for _ in range(rng.randint(0, 12))] for _ in range(2))
        table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
        kept = pages.shared_lines(a, b)
        rest = iter(b)
        assert sum(kept) == table[-1][-1]
        assert all(x in rest for x, k in zip(a, kept, strict=True) if k)


def test_pages_without_article_lose_what_neighbours_share(spark):
    bar = "<div>Welcome to the site</div><div>All rights</div>"
    rows = [(i, f"http://h.com/p/{i}", f"<body>{bar}<p>own text {i}</p></body>") for i in range(4)]
    rows += [(9, "http://h.com/q/1", "<body><div>Welcome to the site</div></body>")]
    rows += [(10, "http://solo.com/", "<body><p>only page</p></body>")]
    got = {
        r["page_id"]: r["text"]
        for r in pages.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    }
    assert [got[i] for i in range(4)] == [f"own text {i}" for i in range(4)]
    assert got[9] == "Welcome to the site"  # all shared: a copy, nothing can be told apart
    assert got[10] == "only page"


def test_pages_with_an_article_are_differenced_too(spark):
    bar, quote = "<div>Welcome to the site</div>", "<p>as the poet says</p>"
    page = "<body>{}<nav>menu {}</nav><article><p>text {}</p>{}</article><div>after {}</div></body>".format
    rows = [(i, f"http://h.com/p/{i}", page(bar, i, i, quote, i)) for i in range(3)]
    rows += [(3, "http://solo.com/", page(bar, 3, 3, quote, 3))]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r["page_id"]: r["text"] for r in pages.extract(frame).collect()}
    # the shared bar goes, the shared quotation of the articles stays, and so does a line of one page only
    assert [got[i] for i in range(3)] == [f"text {i} as the poet says after {i}" for i in range(3)]
    assert got[3] == "text 3 as the poet says"  # no neighbour tells what stands beside the article


def test_every_page_is_aligned(spark, sf_dir):
    staging = pages.Staging(spark)
    parsed = staging.write(pages._parsed(spark.read.parquet(f"{sf_dir}/pages.parquet")), "lines")
    want = {r["row"]: r for r in parsed.collect()}
    order = sorted(want.values(), key=lambda r: (r["host"], r["path"], r["row"]))
    cut = {r["row"]: r["kept"] for r in pages._differenced(parsed, staging).collect()}
    for at, r in enumerate(order):
        near = [order[i] for i in (at - 1, at + 1) if 0 <= i < len(order) and order[i]["host"] == r["host"]]
        best = max(near, key=lambda o: pages._common_prefix(r["path"], o["path"]), default=None)
        shared = pages.shared_lines(r["hashes"], best["hashes"]) if best else None
        kept = pages.kept_lines(bytes(r["kinds"]), shared)
        assert cut.get(r["row"], [True] * len(kept)) == kept
        assert len(r["lines"]) == len(kept)
    staging.drop()


def test_odd_pages(spark):
    rows = [
        (1, None, None), (2, "http://a/", ""), (3, "http://a/", "<p>x</p>"), (3, "http://a/", "<p>x</p>"),
        (None, "http://b", "<article>" + "<div>" * 5000 + "deep" + "</p>" * 5000),
        (5, "not a url", "<a <b> & &am &lt"), (6, "http://c", "<script>" * 50), (7, "http://d", "word " * 50_000),
    ]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    frame = frame.selectExpr("*", "1 AS row", "2 AS host", "3 AS at", "4 AS lines", "5 AS text")
    got = pages.extract(frame).collect()
    assert len(got) == len(rows)
    by_id = {r["page_id"]: r["text"] for r in got}
    assert by_id[1] == by_id[2] == by_id[6] == "" and by_id[3] == "x" and by_id[None] == "deep"
    assert by_id[7] == " ".join(["word"] * 50_000)
    assert pages.extract(frame.limit(0)).count() == 0


def test_query_against_a_plain_reading(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/pages.parquet").collect()
    got = {r["page_id"]: r for r in QUERIES["op5_html_text"](spark, sf_dir).collect()}
    assert len(got) == len(rows)
    for r in rows:
        inner = re.search(r"<article>(.*?)(?:</article>|\Z)", r["html"], re.S)[1]
        text = html.unescape(re.sub(r"</?(?:p|h1)>|<br>", "\n", inner).replace("<b>", "").replace("</b>", ""))
        assert got[r["page_id"]]["text"] == " ".join(text.split())
        assert got[r["page_id"]]["n_chars"] == len(got[r["page_id"]]["text"])
