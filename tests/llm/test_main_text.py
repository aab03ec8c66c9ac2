"""Main text of pages: by tags and names, and by what a site repeats."""

import html
import re
from collections import Counter

from salesmill.llm.main_text import PROSE, _below, extract_main_text, main_text, parse, site_templates, subtree_hashes
from salesmill.llm.queries import op1_main_text

from .conftest import SMALL

PAGE = """<!doctype html><html><head><title>T</title><style>a{}</style></head><body class="has-sidebar">
<header class="site-header"><h1>Site</h1><nav>menu</nav></header><div id="cookie-notice">We use cookies</div>
<div class="wrap with-sidebar"><main><article class="post"><header class="entry-header"><h1>Head &amp; line</h1></header>
<p>First <b>bold</b>&nbsp;text<br>next<p>Second<!-- no --></p><ul><li>one<li>two</ul><div class="share">share me</div>
<blockquote><p>quote</p></blockquote><form>Mail <input value=x></form><table><tr><td>a<td>b</table><pre>x
 y</pre><section class="comments"><h3>Comments</h3><article class="comment"><p>bad</p></article></section>
<div hidden>unseen</div><footer>tags</footer></article></main><aside>side</aside></div><footer>foot</footer>
<script>var a="</p><p>no</p>";</script></body></html>"""


def test_a_page_of_many_parts():
    assert main_text(parse(PAGE)).split("\n") == [
        "Head & line", "First bold text next", "Second", "one", "two", "quote", "a", "b", "x y",
    ]


def test_pages_of_no_order():
    assert main_text(parse("<div class=a><p>x</p><p>y</p></div>tail &lt;b&gt; <!-- c --> end")) == "x\ny\ntail <b> end"
    assert main_text(parse("<p>a<div>b</div>c")) == "a\nb\nc"
    assert main_text(parse("< a < b </x> <p")) == "< a < b"
    assert main_text(parse("<div>" * 5000 + "deep" + "</p>")) == "deep"
    assert main_text(parse("")) == ""
    assert main_text(parse("<title>only &amp; title")) == ""


def test_main_with_prose_beside_articles():
    cards = "<article><p>card 1</p></article><article><p>card 2</p></article>"
    assert main_text(parse(f"<main><h1>Head</h1><p>Own <b>text</b></p><div>{cards}</div></main>")) == (
        "Head\nOwn text\ncard 1\ncard 2"
    )
    assert main_text(parse(f"<main>{cards}<aside><p>side</p></aside></main><p>foot</p>")) == "card 1\ncard 2"


def test_chrome_tags_around_the_page():
    assert main_text(parse("<body><form><nav>menu</nav><div><p>all</p></div></form><script>x</script></body>")) == "all"
    assert main_text(parse("<div>top</div><form><main><p>text</p></main></form><form>Mail</form>")) == "text"
    assert main_text(parse("<aside><article><p>card</p></article></aside><article><p>text</p></article>")) == "text"
    assert main_text(parse("<p>text</p><form><p>Mail</p></form>")) == "text"


def test_templates_go_and_prose_stays():
    page = "<body><div>{}</div><div>Buy now</div><article><p>own {}</p><p>Buy now</p><div>Buy now</div></article></body>"
    tree = parse(page.format("x", 1))
    templates = {h for h, _ in subtree_hashes(parse("<div>Buy now</div><p>Buy now</p>")).values()}
    assert main_text(tree, templates) == "own 1\nBuy now"
    assert main_text(parse("<p>own</p><div>Buy now</div>"), templates) == "own"


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id bigint, url string, html string, host string, templates string, text string")


def row(page_id, url, page):
    return (page_id, url, page, "own", "own", "own")


def texts_by_id(df):
    return {(r.page_id, r.url): (r.text, r.n_chars) for r in df.collect()}


def test_site_templates(spark):
    plain = "<div class=x{0}>Weather today</div><div><p>Text {0}</p></div><div>Call us</div>"
    rows = [row(k, f"HTTP://me@Site.example:80/{k}?a", plain.format(k)) for k in range(6)]
    # Copies of one page surround their parts alike, so nothing of them is template.
    rows += [row(k, "https://copies.example/a", plain.format(0)) for k in range(10, 18)]
    # The same parts on a host that does not repeat them.
    rows += [row(20, "https://other.example/", plain.format(20))]
    got = texts_by_id(extract_main_text(pages(spark, rows)))
    assert all(got[k, f"HTTP://me@Site.example:80/{k}?a"][0] == f"Text {k}" for k in range(6))
    assert got[10, "https://copies.example/a"][0] == "Weather today\nText 0\nCall us"
    assert got[20, "https://other.example/"] == ("Weather today\nText 20\nCall us", 29)


def test_rotating_templates_on_a_small_and_a_large_host(spark):
    """Twelve rails, each on a twelfth of the pages; each promo in six of them."""
    def page(k):
        rail = k % 12
        return (
            f"<div>Rail {rail}<div>Promo {rail % 2}</div></div><div><p>Text {k}</p></div>"
            + "<div>Promo {}</div>".format(k % 2)
        )

    def check(n, copies):
        rows = [row(k, f"http://h{n}/{k}", page(k)) for k in range(n)]
        rows += [row(n + k, f"http://h{n}/{n + k}", page(0)) for k in range(copies)]
        got = texts_by_id(extract_main_text(pages(spark, rows)))
        assert all(text == f"Text {k if k < n else 0}" for (k, _), (text, _) in got.items())

    check(48, 0)
    check(1200, 0)
    check(48, 2000)   # copies are one page


def test_blocks_repeated_on_one_page_are_no_template(spark):
    """Three surroundings, but one page."""
    page = "<div>Same<p>a</p></div>"
    rows = [row(1, "http://one/", f"<div>x{page}</div><div>y{page}</div><div>z{page}</div>")]
    rows += [row(2, "http://one/2", "<p>other</p>")]
    got = texts_by_id(extract_main_text(pages(spark, rows)))
    assert got[1, "http://one/"][0] == "x\nSame\na\ny\nSame\na\nz\nSame\na"


def test_odd_rows(spark):
    rows = [row(1, None, None), row(2, "x", ""), row(None, None, "<p>a</p>"), row(3, "not a url", "<p>b é🙂</p>")]
    rows += [row(4, "http://h/", "<p>c</p>"), row(4, "http://h/", "<p>c</p>"), row(5, "", "<p>" + "w " * 100_000)]
    found = extract_main_text(pages(spark, rows))
    assert found.columns == ["page_id", "url", "text", "n_chars"] and found.count() == len(rows)
    got = texts_by_id(found)
    assert got[1, None] == ("", 0) and got[2, "x"] == ("", 0) and got[None, None] == ("a", 1)
    assert got[3, "not a url"] == ("b é🙂", 4) and got[5, ""][1] == 199_999
    assert extract_main_text(pages(spark, [])).count() == 0


def test_query_against_the_articles(spark, small):
    got = {r.page_id: (r.url, r.text, r.n_chars) for r in op1_main_text(spark, SMALL).collect()}
    for page in small("pages"):
        article = re.search(r"<article>(.*)</article>", page["html"], re.S)[1]
        blocks = [html.unescape(re.sub(r"<[^>]*>", "", x)).split() for x in re.split(r"</?(?:p|h1)>", article)]
        text = "\n".join(" ".join(b) for b in blocks if b)
        assert got.pop(page["page_id"]) == (page["url"], text, len(text))
    assert not got


def test_names_that_only_mention_chrome_stay():
    assert main_text(parse('<div class="content no-sidebar"><p>text</p></div>')) == "text"
    assert main_text(parse('<div class="post ad-hoc"><p>text</p></div>')) == "text"
    article = '<article><p>first</p><section class="social-history"><p>then</p></section><div class="widget-guide">last</div></article>'
    assert main_text(parse(article)) == "first\nthen\nlast"
    chrome = '<div id="cookie-notice">x</div><div class="siteHeader">x</div><div class="sidebar-2 left">x</div><div class="post-comments"><p>x x x x</p></div>'
    assert main_text(parse(f"<div>{chrome}<p>text</p></div>")) == "text"


def test_what_holds_most_of_the_prose_stays_whatever_its_name():
    page = '<div class="sidebar"><p>{}</p></div><p>rest</p>'
    assert main_text(parse(page.format("long " * 9))) == " ".join(["long"] * 9) + "\nrest"
    assert main_text(parse(page.format("x"))) == "rest"
    templates = {h for pair in subtree_hashes(parse("<section><p>all of it</p></section>")).values() for h in pair}
    assert main_text(parse("<section><p>all of it</p></section><p>more</p>"), templates) == "all of it\nmore"


def test_what_is_unseen_ends_no_paragraph():
    for unseen in ("<button>y</button>", "<svg><text>y</text></svg>", "<noscript>y</noscript>", "<video>y</video>"):
        assert main_text(parse(f"<p>x {unseen} z</p>")) == "x z"
    assert main_text(parse("<article><p>so <math><mi>a</mi><mo>=</mo><mn>1</mn></math> holds</p></article>")) == "so a=1 holds"
    assert main_text(parse("<p>a</p>b<div class=ad>ad</div>c")) == "a\nb\nc"


def test_one_block_between_others_like_it_stays(spark):
    """A sentence in a block of its own, on many pages, in the text of one."""
    def page(k):
        lines = "".join(f"<div>Line {k}.{n}</div>" for n in range(3))
        return f"<section><div>Start {k}</div><div>As always.</div>{lines}</section><ul class=menu><li>Home</ul>"

    rows = [row(k, f"http://h/{k}", page(k)) for k in range(9)]
    got = texts_by_id(extract_main_text(pages(spark, rows)))
    assert got[4, "http://h/4"][0] == "Start 4\nAs always.\nLine 4.0\nLine 4.1\nLine 4.2"


def counted(rows):
    """``site_templates`` by dictionaries."""
    hosts = {}
    for _, url, page in rows:
        host = re.match(r"\s*[a-z]+://([^/?#:]*)", url)[1].lower()
        tree = parse(page)
        prose = {n for n, e in numbered(tree).items() if e.tag in PROSE}
        found = {(place, own) for n, (own, place) in subtree_hashes(tree).items() if n not in prose}
        hosts.setdefault(host, {}).setdefault(main_text(tree), set()).add(frozenset(found))
    out = {}
    for host, contents in hosts.items():
        # Of copies one counts; copies here have the same elements.
        kept = [min(found, key=sorted) for found in contents.values()]
        n, at = Counter(x for found in kept for x in found), Counter(p for found in kept for p in {p for p, _ in found})
        templates = {own for (place, own), k in n.items() if k >= 3 and k >= 0.05 * len(kept)}
        for place, on_pages in at.items():
            here = [k for (p, _), k in n.items() if p == place]
            again = sum(k for k in here if k > 1)
            if again >= 3 and again >= 0.15 * sum(here) and sum(here) <= 2 * on_pages and on_pages >= 0.3 * len(kept):
                templates.add(place)
        if templates:
            out[host] = {h - (1 << 64) if h >> 63 else h for h in templates}
    return out


def numbered(tree):
    return {e.number: e for e in _below(tree)}


def renamed(page):
    """Without the tag and the name that tell the article and the advert of the given pages."""
    return re.sub(r"<(/?)article>", r"<\1div>", page).replace('<div class="ad">', '<div class="x">')


def test_templates_against_plain_counts(spark, small):
    rows = [(p["page_id"], p["url"], renamed(p["html"])) for p in small("pages")]
    rows += [(1000 + k, f"http://more.example/{k}", f"<nav>{k % 4}</nav><div><p>{k}</p></div><div>{k // 2}</div>") for k in range(24)]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    got = {r.host: set(r.templates) for r in site_templates(df).collect()}
    assert got == counted(rows) and "more.example" in got


def test_templates_alone_find_the_articles(spark):
    """The given pages, of which neither tag nor name tells what is advert and what article."""
    given = spark.read.parquet("/root/testdata/sf0.1/pages.parquet").select("page_id", "url", "html").collect()
    df = spark.createDataFrame([(p.page_id, p.url, renamed(p.html)) for p in given], "page_id bigint, url string, html string")
    got = {r.page_id: r.text for r in extract_main_text(df).collect()}
    right = worse = 0
    for p in given:
        article = re.search(r"<article>(.*)</article>", p.html, re.S)[1]
        blocks = [html.unescape(re.sub(r"<[^>]*>", "", x)).split() for x in re.split(r"</?(?:p|h1)>", article)]
        want = "\n".join(" ".join(b) for b in blocks if b)
        right += got[p.page_id] == want
        worse += main_text(parse(renamed(p.html))) == want != got[p.page_id]
        assert set(want.split("\n")) <= set(got[p.page_id].split("\n"))
    assert right >= 0.95 * len(given) and worse == 0
