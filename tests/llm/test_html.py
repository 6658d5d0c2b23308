from vela.llm.html_extract import extract, hash_subtrees, main_text, parse
from vela.llm.queries import QUERIES

PAGE = """<!DOCTYPE html><html><head><title>T &amp; x</title><style>p{}</style></head><body class="no-sidebar">
<header><h2>Site</h2><nav><a href="/">Home</a></nav></header><div class="cookie-notice">We use cookies</div>
<main><article><header><h1>A  title</h1><span>by me</span></header><p>First &amp; <b>bold<br>line&nbsp;x &#233;</p><script>var a = "</p><p>no";</script>
<p>Second<div class="ad-box">Buy</div><ul><li>one<li>two</ul><table><tr><td>a<td>b</table><aside>side</aside><form><input>Mail</form>
<blockquote>quote <i>it</i></blockquote><!-- gone --><footer>tags</footer></article>
<section id="comments"><article>A reader says a lot of things that are not the article at all, really a lot of them, over and over</article></section></main>
<div role="complementary">more</div><footer>&copy; x</footer></body></html>"""


def test_structure_rules():
    assert main_text(PAGE, set()).split("\n\n") == ["A title", "First & bold line x é", "Second", "one", "two", "a", "b", "quote it"]


def test_broken_pages():
    assert main_text("", set()) == "" and main_text("plain  text", set()) == "plain text"
    assert main_text("<p>a < b <3 &am &amp", set()) == "a < b <3 &am &"
    assert main_text("<article><p>x<!-- open", set()) == "x"
    assert main_text("<div><p>a</p></div></div></b><p>b", set()) == "a\n\nb"
    assert main_text("<script>x" + "<p>" * 3, set()) == ""
    assert main_text("<p>" + "<b>" * 5000 + "deep", set()) == "deep"


def test_pages_that_end_inside_a_tag():
    prose = "then " + "some more words " * 400
    assert main_text(f"<p>if a <b {prose}", set()) == f"if a <b {prose}".strip()
    assert main_text("<p>text <b " + "x" * 100_000, set()) == "text <b " + "x" * 100_000
    assert main_text("<p>a<!-- x -->b <i title='" + "y" * 200 + "<!-- gone", set()) == "ab <i title='" + "y" * 200
    assert main_text("<p>" + "<b <!x " * 50_000, set()).count("<b") == 50_000
    assert main_text('<a ">two " ' * 50_000, set()).count("two") == 50_000


def test_every_article_and_much_text_beside_them():
    parts = "<main><article><h2>One</h2><p>first post</p></article><div class='ad'>Buy</div><article><p>second post, a longer one</p></article></main>"
    assert main_text(parts, set()) == "One\n\nfirst post\n\nsecond post, a longer one"
    story = "".join(f"<p>Paragraph {i} of the story.</p>" for i in range(20))
    told = [f"Paragraph {i} of the story." for i in range(20)]
    teaser = "<article><header>by me<h3>Read next</h3></header><p>A teaser</p></article>"
    assert main_text(f"<nav>x</nav><main><div>{story}</div>{teaser}</main><div>y</div>", set()).split("\n\n") == [*told, "Read next", "A teaser"]
    assert main_text(f"<body><div>{story}</div>{teaser}</body>", set()).split("\n\n") == [*told, "Read next", "A teaser"]
    box = hash_subtrees(parse(f"<div>{story}</div>"))[-1].hash
    assert main_text(f"<body><div>{story}</div>{teaser}</body>", {box}) == "Read next\n\nA teaser"


def test_names_made_from_words_of_the_article_stay():
    kept = ["<h2 id='related-work'>Related work</h2>", "<section id='social-impact'><h3 id='comments'>Impact</h3></section>", "<p id='notice-period'>Notice</p>", "<div class='share-price'>Price</div>",
            "<p>a <span id='skip'>b</span></p>", "<pre><code class='x'><span class='hljs-comment'># c</span> <span class='comment'># d</span></code></pre>", "<div class='post-header'>Head</div>"]
    gone = ["<div class='share-buttons'>S</div>", "<div class='x post__related'>R</div>", "<section id='comments'><p>C</p></section>", "<p class='ad'>A</p>", "<div id='cookie-notice'>N</div>"]
    page = "".join(k + g for k, g in zip(kept, [*gone, "", ""]))
    told = "Related work\n\nImpact\n\nNotice\n\nPrice\n\na b\n\n# c # d\n\nHead"
    assert main_text(f"<article>{page}</article>", set()) == told and main_text(f"<main>{page}</main>", set()) == told
    assert main_text("<h2 id='related-work'>Related work</h2><div class='my-share'>S</div>", set()) == "Related work"


def test_site_template_goes_and_copies_of_an_article_stay(spark):
    rows = []
    for i in range(12):
        body = "the same article on every page" if i < 8 else f"article number {i}"
        rows.append((i, f"http://one.example/{i}", f"<body><div>Top bar of the site</div><article><p>{body}</p><p>Always this line</p><div>Box on each page</div></article><div>Number {i}</div></body>"))
    rows += [(100 + i, f"http://two.example/{i}", f"<body><div>Links</div><div><p>Story {i} told at length</p></div></body>") for i in range(6)]
    rows += [(200, None, "<div>Links</div><p>x</p>"), (201, "http://one.example/z", None), (202, "//three.example", "<p>Links</p>"), (202, "//three.example", "<p>Links</p>")]
    got = {r.page_id: r.text for r in extract(spark.createDataFrame([(*r, "c", "d", 1) for r in rows], "page_id long, url string, html string, host string, template string, salt int")).collect()}
    assert got[3] == "the same article on every page\n\nAlways this line" and got[10] == "article number 10\n\nAlways this line"
    assert got[102] == "Story 2 told at length"
    assert got[200] == "Links\n\nx" and got[201] == "" and got[202] == "Links"


def test_recurring_blocks_inside_articles_go(spark):
    rows = [(i, f"http://a.example/{i}", f"<article><h1>Title {i}</h1><p>Story {i} at length</p><p>Read us daily</p></article>") for i in range(12)]
    copy = "<article><h1>Copy</h1><div><p>The same story</p></div></article>"
    rows += [(100 + i, f"http://b.example/{i}", copy if i < 9 else f"<article><p>Other {i}</p></article>") for i in range(12)]
    rows += [(200 + i, f"http://c.example/{i}", f"<div><p>Story {i} here</p>" + ("<p>Again</p><div><p>Box</p></div>" if i < 24 else "") + "</div>") for i in range(60)]
    rows += [(300 + i, f"http://d.example/{i}", f"<article><p>Story {i} here</p>" + ("<p>Again</p><div><p>Box</p></div>" if i < 24 else "") + "</article>") for i in range(60)]
    got = {r.page_id: r.text for r in extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got[3] == "Title 3\n\nStory 3 at length"
    assert got[100] == "Copy\n\nThe same story" and got[110] == "Other 10"
    assert got[203] == got[303] == "Story 3 here\n\nAgain" and got[230] == got[330] == "Story 30 here"


def test_query_rows(spark, sf):
    pages = spark.read.parquet(f"{sf}/pages.parquet")
    got = QUERIES["op6_html_extraction"](spark, sf).collect()
    assert len(got) == pages.count()
    assert all(r.n_chars == len(r.text) for r in got) and all("<" not in r.text[:50] for r in got)
    expected = {r.page_id: main_text(r.html, set()) for r in pages.collect()}
    assert {r.page_id: r.text for r in got} == expected
    assert extract(pages.where("false")).count() == 0


def test_hashes_depend_on_text_and_tags():
    a, b, c = (hash_subtrees(parse(x))[-1].hash for x in ("<div><p>a  b</p></div>", "<div><p>a b</p></div>", "<div><p>a c</p></div>"))
    assert a == b != c
