"""Main text of pages: the scan by brute force, the text by cutting the marked content out plainly."""

import html
import random
import re
from collections import Counter

import pytest

from headgate.llm.mainpage import Page, best_run, counted, extract, main_text, weights
from headgate.llm.tables import read


def test_best_run_by_brute_force():
    rng = random.Random(5)
    for _ in range(300):
        scores = [rng.randrange(-3, 4) for _ in range(rng.randrange(12))]
        runs = [(sum(scores[i:j]), -j, i) for i in range(len(scores)) for j in range(i + 1, len(scores) + 1) if sum(scores[i:j]) > 0]
        _, end, start = max(runs, default=(0, 0, 0))
        assert best_run(scores) == (start, -end)


def plainly(page):
    """The text of the one article, by patterns: enough for pages whose article holds only headings, paragraphs and inline marks."""
    article = re.search(r"<article>(.*?)</article>", page, re.S).group(1).replace("<br>", "\n")
    blocks = (re.sub(r"<[^>]*>", "", b) for b in re.split(r"</?(?:p|h1)>", article))
    return "\n\n".join(t for t in (" ".join(html.unescape(b).split()) for b in blocks) if t)


def test_every_page(spark, sd):
    want = {r.page_id: (r.url, plainly(r.html)) for r in read(spark, sd, "pages").collect()}
    got = {r.page_id: (r.url, r.text) for r in extract(read(spark, sd, "pages")).collect()}
    assert got == want
    rows = [(r.page_id, r.url, r.html) for r in read(spark, sd, "pages").collect()]
    # Pages that mark nothing, told by what the others have taught.
    bare = [(10_000 + i, u, re.sub(r"</?article>", "", h)) for i, u, h in rows] + [(20_000 + i, u, h.replace("article>", "div>")) for i, u, h in rows]
    got = extract(spark.createDataFrame(rows + bare, "page_id long, url string, html string")).collect()
    assert all(r.text == want[r.page_id % 10_000][1] and r.n_chars == len(r.text) for r in got) and len(got) == 3 * len(rows)


PROSE = "The quick brown fox jumps over the lazy dog near the river bank today."
SURROUNDED = f"""<!doctype html><html><head><title>Site &amp; more</title><style>p{{}}</style><body class="has-sidebar">
<header><a href="/">Site</a><p>A slogan of this site</p></header><div id="main-menu"><ul><li><a>Home</a><li><a>About</a></ul></div>
<div role="alert">We use cookies on this site to make it better for you.</div>
<div class="page"><div class="content"><h1>Fish&nbsp;&amp;&#32;chips</h1><p>{PROSE}
   {PROSE}<p>Is 3 &lt; 4? <em>Yes</em>, it<b>s</b> so.<br>Line two<div class="ad-slot"><p>Buy now this thing</div><ul><li>first point of it<li>second point of it</ul>
<form><label>Mail</label><input><button>Send</button></form><table><tr><td>a cell<td>next cell</table><blockquote>{PROSE}</blockquote><script>var a = "<p>no</p>";</script>
<aside>Aside we go</aside><pre>x  =
 1</pre><p>{PROSE}</p></div></div><section id="comments"><h2>Comments</h2><p>{PROSE}<p>{PROSE}</section><nav>More</nav><footer>&copy; the site of them all</footer>"""


def test_surroundings_are_left_out(spark):
    want = "\n\n".join(["Fish & chips", f"{PROSE} {PROSE}", "Is 3 < 4? Yes, its so. Line two", "first point of it", "second point of it", "a cell", "next cell", PROSE, "x = 1", PROSE])
    learned = weights({"p": {True: 900}, "h1": {True: 90}, "<p": {True: 50, False: 2}, "<body": {False: 9}})
    assert main_text(SURROUNDED, learned) == want
    assert main_text(SURROUNDED, {}) == want


@pytest.mark.parametrize(("page", "text"), [
    ("", ""), ("<p></p><div> \n</div>", ""), ("plain words only", "plain words only"), ("<p>a &am b &amp c", "a &am b & c"), ("<p>unclosed <b>bold<p>next", "unclosed bold\n\nnext"),
    ("<script>x", ""), ("<nav>menu<p>x</nav>", ""), ("a < b and c > d", "a < b and c > d"), ("<p>one<!-- <p>two --> three</p>", "one three"), ("<article><header><h1>Title here</h1></header><p>words of it</p></article>", "Title here\n\nwords of it"),
    ("<div class='post'>a<span>b</span>c<br>d</div>", "abc d"),
])
def test_small_pages(page, text):
    assert main_text(page, {}) == text


def test_weights_come_from_labelled_pages():
    labelled = "<div><p>out</div><article><h1>t</h1><p>one two</p><article>three</article></article><p>after</p>"
    assert counted(labelled) == Counter({("<div", False): 1, ("<p", False): 2, ("p", False): 2, ("</p", False): 2, ("</div", False): 1, ("<h1", True): 1, ("h1", True): 1, ("</h1", True): 1,
                                         ("<p", True): 1, ("p", True): 2, ("</p", True): 1, ("article", True): 1})
    assert counted("<p>none") == counted("<article>1</article><article>2</article>") == Counter()
    w = weights({"p": {True: 99, False: 0}, "li": {True: 1, False: 50}, "<li": {True: 1, False: 50}, "<p": {True: 99}})
    assert w["p"] > w["li"] > 0 > w["<p"] > w["<li"]
    assert Page.of("<main>x</main>").labels == 1


def test_odd_pages(spark):
    long = " ".join(f"<p>word{i} and more" for i in range(30_000))
    rows = [(1, "u", None), (1, "u", ""), (None, None, "<p>x y z"), (None, None, "<p>x y z"), (2, "v", "<" * 2000), (3, "w", long), (4, "x", "<div>" * 5000 + "deep words here")]
    pages = spark.createDataFrame([(i, u, h, "t", 7) for i, u, h in rows], "page_id long, url string, html string, text string, n_chars int")
    got = Counter((r.page_id, r.url, r.text[:9], r.n_chars) for r in extract(pages).collect())
    size = sum(len(f"word{i} and more") + 2 for i in range(30_000)) - 2
    assert got == Counter({(1, "u", "", 0): 2, (None, None, "x y z", 5): 2, (2, "v", "<" * 9, 2000): 1, (3, "w", "word0 and", size): 1, (4, "x", "deep word", 15): 1})
    assert extract(pages.limit(0)).count() == 0
