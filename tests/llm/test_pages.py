import re

from cellstar.llm import pages

SCHEMA = "page_id long, url string, html string, host string, text string"


def expected(page):
    """Heading and paragraphs of the test pages, read off their known form."""
    body = re.search(r"<article>(.*)</article>", page, re.S)[1]
    parts = re.split(r"</?(?:h1|p)>", body)
    import html

    plain = [" ".join(html.unescape(re.sub(r"<br>", " ", p).replace("<b>", "").replace("</b>", "")).split()) for p in parts]
    return "\n\n".join(p for p in plain if p)


def test_test_pages(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    want = {r.page_id: expected(r.html) for r in table.collect()}
    got = pages.main_text(table).collect()
    assert {r.id: r.text for r in got} == want and len(got) == len(want)
    assert all(r.n_chars == len(r.text) for r in got)


def soup(i, body):
    return (
        f'<html><head><title>Site {i}</title></head><body><div class="top"><a href="/">Home</a> <a href="/x">News</a></div>'
        f'<div class="cookie-notice"><p>We use cookies {i}.</p></div><div class="c1">{body}<p>Read our weekly letter.</p></div>'
        f'<div id="comments"><p>Nice {i}!</p></div><form><p>Search {i}</p></form><div>Copyright {i}</div></body></html>'
    )


def test_template_without_an_article_element():
    bodies = [f"<h2>Title {i}</h2>" + "".join(f"<p>Words &amp; <b>more</b>&nbsp;words\n of {i}, {k}<br>x.</p>" for k in range(i % 4 + 1)) for i in range(9)]
    texts = pages.extract([soup(i, b) for i, b in enumerate(bodies)])
    for i, text in enumerate(texts):
        want = [f"Title {i}"] + [f"Words & more words of {i}, {k} x." for k in range(i % 4 + 1)]
        assert text == "\n\n".join(want)


def test_article_without_what_surrounds_it():
    page = (
        "<header><h1>Site</h1></header><nav>Menu</nav><main><article><header><h1>Title</h1></header><p>One<script>x('</p>')</script> 1 &lt; 2"
        "<p>Two <a href='#'>link</a><aside>Side</aside><ul><li>Three</ul><div class='share-buttons'>Share</div><section id=comments><p>C</p></section>"
        "<!-- <p>no</p> --><form>F</form><style>p{}</style></article></main><footer>F</footer>"
    )
    assert pages.extract([page]) == ["Title\n\nOne 1 < 2\n\nTwo link\n\nThree"]


def test_odd_pages_and_hot_host(spark):
    big = "<article>" + "<p>word &eacute; " * 50_000 + "</article>"
    odd = [None, "", "plain text", "<", "<article>", "<p><b>x", "</div></p>y", "<article><p>a > b <3</article>", "<!-- open", big, "<a" * 3000, "<p class='" * 2000]
    rows = [(i, "http://h.com/a", h, "clash", "clash") for i, h in enumerate(odd)]
    rows += [(100 + i, "HTTP://Hot.example.com/x", soup(i, f"<p>Own words {i} of this page</p>"), "", "") for i in range(300)]
    rows += [(None, None, "<article>n</article>", "", "")] * 2
    got = pages.main_text(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(got) == len(rows)
    texts = {r.id: r.text for r in got}
    assert texts[0] == texts[1] == texts[4] == texts[8] == "" and texts[9].count("word é") == 50_000 and texts[None] == "n"
    assert texts[7] == "a > b <3"
    assert all(texts[100 + i] == f"Own words {i} of this page" for i in range(300))


def test_classes_must_keep_their_order():
    one, two = [("p", "a"), ("p", "b"), ("p", "c")], [("p", "a"), ("p", "c"), ("p", "b")]
    frame, _ = pages.deduce([one, two, one])
    assert frame == [("p", "a"), ("p", "b")] or frame == [("p", "a"), ("p", "c")]


def test_empty_table(spark):
    assert pages.main_text(spark.createDataFrame([], SCHEMA)).collect() == []


def test_the_template_decides_on_pages_with_an_article(monkeypatch):
    bodies = [f"<article><h2>Title {i}</h2><p>Words of the article numbered {i}.</p><p>Read our letter.</p></article>" for i in range(9)]
    want = [f"Title {i}\n\nWords of the article numbered {i}." for i in range(9)]
    assert pages.extract([soup(i, b) for i, b in enumerate(bodies)]) == want
    monkeypatch.setattr(pages, "deduce", lambda tokens: ([], set()))
    assert pages.extract([soup(i, b) for i, b in enumerate(bodies)]) == [f"{w}\n\nRead our letter." for w in want]


def test_copied_articles_stay():
    page = "<html><body><p>Site {}</p><article><p>One article that is on all of them.</p><p>It has two parts.</p></article></body></html>"
    assert pages.extract([page.format(i) for i in range(5)]) == ["One article that is on all of them.\n\nIt has two parts."] * 5


def test_a_section_of_prose_stays_whatever_its_name():
    prose = "Courts have long held that " + "such words belong to the article " * 4
    page = f"<article><p>One</p><section class='legal'><p>{prose}</p></section><div class='widget tags'>a b</div><div class='related'><a href='/'>{prose}</a></div></article>"
    assert pages.extract([page]) == [f"One\n\n{prose.strip()}"]


def test_two_templates_on_one_host():
    def page(i):
        kind = "story" if i % 4 == 0 else "post"
        return soup(i, f"<h2>Title {i}</h2><p>{'long words ' * (1 + i % 5)}of {i}.</p>").replace('class="c1"', f'class="{kind}"')

    def other(i):
        return f"<html><body><table class='frame'><ul><a href='/'>x</a></ul><section class='text'><p>Told in {'other ' * (i + 1)}words.</p></section></table></body></html>"

    texts = pages.extract([page(i) for i in range(48)])
    assert texts == [f"Title {i}\n\n{'long words ' * (1 + i % 5)}of {i}." for i in range(48)]
    mixed = pages.extract([page(i) if i % 2 else other(i) for i in range(48)])
    assert mixed == [texts[i] if i % 2 else f"Told in {'other ' * (i + 1)}words." for i in range(48)]


def test_an_article_in_two_sections():
    def body(i):
        return f"<div class='lead'><p>{f'w{i} ' * 80}</p></div><div class='rest'><p>{f'v{i} ' * 20}</p></div>"

    texts = pages.extract([soup(i, body(i)) for i in range(9)])
    assert texts == [f"{(f'w{i} ' * 80).strip()}\n\n{(f'v{i} ' * 20).strip()}" for i in range(9)]


def test_paragraphs_that_are_links_stay_in_the_main_slot():
    page = (
        "<body><div class='m'><a href='/'>Home</a> &middot; <a href='/x'>News</a></div><div class='post'><h2>T</h2><p><a href='/y'>whole paragraph</a></p>"
        "<p>More words than links</p><p><a href='/'>one</a> | <a href='/'>two</a></p></div><ul><li><a href='/z'>Elsewhere</a></li></ul></body>"
    )
    assert pages.extract([page]) == ["T\n\nwhole paragraph\n\nMore words than links"]
    many = [page.replace("More", f"More of {i} {i}") for i in range(5)]
    assert pages.extract(many) == [f"More of {i} {i} words than links" for i in range(5)]

    listed = page.replace("</p></div><ul>", "</p><ul><li><a href='/r'>Read</a></li><li><a href='/s'>also</a></li></ul><ul><li>A point</li><li><a href='/t'>Another</a></li></ul></div><ul>")
    assert pages.extract([listed]) == ["T\n\nwhole paragraph\n\nMore words than links\n\nA point\n\nAnother"]


def test_deep_nesting_in_time_and_memory():
    import time
    import tracemalloc

    depth = 50_000
    deep = "<div>" * depth + "<p>inner words</p>" + "</div>" * depth
    tracemalloc.start()
    started = time.time()
    assert pages.extract([deep, deep, deep.replace("inner", "other")]) == ["inner words", "inner words", "other words"]
    assert time.time() - started < 60 and tracemalloc.get_traced_memory()[1] < 500_000_000
    tracemalloc.stop()
