"""Which parts of a page are content."""

import time

import pytest

from rollcall.llm import html_extract


def extract(pattern, n=4):
    return html_extract.extract([pattern.replace("#", f"v{i} w{i * i}") for i in range(n)])


LONG = "<p>long # text " + "of a story " * 20 + "</p>"
TEXT = "long v0 w0 text " + " ".join(["of a story"] * 20)


def test_names_of_wrappers():
    for body in ('<body class="no-sidebar">', '<body class="has-cookie-notice cookie-notice">', '<body><div id="page" class="layout-sidebar-right">'):
        for article in ("<article>", '<article class="post has-comments">', "<div>"):
            page = f"{body}<nav>menu</nav>{article}{LONG}<div class='ad'>buy #</div></{article[1:].split()[0].strip('>')}>"
            assert extract(page)[0] == extract(page, 1)[0] == TEXT, page


def test_long_advert_beside_article():
    assert extract(f"<body><div class='ad'>{LONG}</div><article><p>short #</p></article>")[0] == "short v0 w0"
    assert extract(f"<body><article><p>short #</p></article><div class='comments'><article>{LONG}</article></div>")[0] == "short v0 w0"


def test_all_slots_in_page_order():
    title = "<h1>Title #</h1>"
    for page in (
        f"<body><div id=a>{title}</div><div id=b>{LONG}</div><div id=c>end #</div><footer>f</footer>",
        f"<body><main>{title}<article>{LONG}</article><section>end #</section></main>",
        f"<body><article>{title}</article><article>{LONG}</article><div class=ad>x #</div><article>end #</article>",
    ):
        assert extract(page)[0] == f"Title v0 w0\n\n{TEXT}\n\nend v0 w0", page
    assert extract(f"<body><article>{title}</article><article>{LONG}</article>", 1) == [f"Title v0 w0\n\n{TEXT}"]


def test_template_among_equal_siblings():
    assert extract(f"<body><div>Home News About</div><div>{LONG}</div><div>All rights reserved</div>")[0] == TEXT


def test_same_paragraph_on_every_page():
    """What every page has is template, whatever its element and wherever it stands; a paragraph of one page stays."""
    assert extract(f"<body><p>All rights reserved</p><div>{LONG}</div><pre>Legal</pre>")[0] == TEXT
    assert extract(f"<body><article>{LONG}<p>The end.</p></article><p>All rights reserved</p>")[0] == TEXT
    pages = [f"<body><article>{LONG.replace('#', f'v{i} w{i * i}')}{'<p>The end.</p>' if i == 2 else ''}</article>" for i in range(5)]
    assert [x.endswith("The end.") for x in html_extract.extract(pages)] == [False, False, True, False, False]


def test_repeated_items_are_aligned():
    """What the items of a list share on most pages is template; what differs is content."""
    item = lambda k: f"<div class=item><div class=by>Posted by staff</div><div class=body>item {k} # of the page</div></div>"
    pages = [f"<body><div>{''.join(item(k) for k in range(1 + i % 3))}</div>{LONG}".replace("#", f"v{i} w{i * i}") for i in range(6)]
    got = html_extract.extract(pages)
    assert got[2] == "\n\n".join([*(f"item {k} v2 w4 of the page" for k in range(3)), TEXT.replace("v0 w0", "v2 w4")])


def test_alignment_by_what_matches_below():
    """Of two possible slots the one with more matching nodes below is taken."""
    deep, flat = "<div><ul><li><p>x #</p></li></ul><table><tr><td>#</td></tr></table></div>", "<div>#</div>"
    one, two = (html_extract.parse(f"<body>{x}".replace("#", "1")) for x in (flat + "<p>a</p>" + deep, "<h2>b</h2>" + deep + "<h3>c</h3>"))
    wrapper = html_extract.Slot("html")
    html_extract.align(wrapper, one, 0)
    html_extract.align(wrapper, two, 1)
    both = [s for body in wrapper.children for s in body.children if len(s.seen) == 2]
    assert [s.label for s in both] == ["div"] and len(both[0].children) == 2


def test_deep_and_wide_pages():
    for tag in ("div", "font", "span", "blockquote", "b"):
        page = f"<body><article>{f'<{tag}>' * 5000}deep # text</article>"
        assert extract(page)[0] == extract(page, 1)[0] == "deep v0 w0 text"
    wide = ["<body>" + "".join(f"<{'h2' if (k * (i + 3)) % 7 else 'h3'}>{k} v{i}</{'h2' if (k * (i + 3)) % 7 else 'h3'}>" for k in range(1500)) for i in range(3)]
    assert all(t.count("\n\n") == 1499 for t in html_extract.extract(wide))


def test_pages_of_a_table(spark):
    """Null html, repeated rows, null ids and urls, no rows, and columns with clashing names."""
    page = "<body><nav>n</nav><article><p>text {}</p></article>"
    rows = [(i, f"http://h.example/{i}", page.format(i), "x") for i in range(5)] + [(4, "http://h.example/4", page.format(4), "x"), (None, None, None, "x"), (9, None, "", "x"), (10, "http://h.example/q", None, None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = sorted(((r.page_id, r.url, r.text, r.n_chars) for r in html_extract.extract_pages(pages).collect()), key=str)
    want = sorted(((i, u, t if (t := f"text {i}") and h else "", len(f"text {i}") if h else 0) for i, u, h, _ in rows), key=str)
    assert got == want
    assert html_extract.extract_pages(pages.where("false")).count() == 0


def test_apostrophes_in_unquoted_values():
    page = "<article><p data-x=it's title='a \"b\" > c' hidden-x = d>Text # of it</p><p class=a'b>It's # here</p><br/><a href=x/>link #</a></article>"
    assert extract(page)[1] == "Text v1 w1 of it\n\nIt's v1 w1 here\n\nlink v1 w1"


@pytest.mark.parametrize("page", ["<a " * 133_000, "<div>" * 20_000 + "</p>" * 20_000, "<div>" + "<b>" * 20_000 + "<hr>" * 20_000, "<i>" + "<b>" * 20_000 + "</i>" * 20_000, "<a x=\"<b y='" * 30_000, "<div class='ad'>" * 5_000 + "<article>x</article>" * 5_000])
def test_time_is_linear(page):
    began = time.process_time()
    html_extract.extract([page])
    assert time.process_time() - began < 5


def test_names_within_words_are_content():
    parts = ["<div class='share-price'>price #</div>", "<p class='notice-of-meeting'>meeting #</p>", "<section class='related work'>work #</section>", "<div class='adaptation'>adapted #</div>"]
    assert extract(f"<article>{LONG}{''.join(parts)}</article>")[0] == "\n\n".join([TEXT, "price v0 w0", "meeting v0 w0", "work v0 w0", "adapted v0 w0"])
    for name in ("ad", "ads top", "post-comments", "related-posts", "social share", "x1 cookie-bar", "sidebar primary"):
        assert extract(f"<article>{LONG}<div class='{name}'>other #</div></article>")[0] == TEXT, name


def test_two_kinds_of_page():
    """Two pages suffice to tell a constant; copies and near copies of one page don't."""
    page = "<body><div><p>{}</p><p>Copyright 2020</p></div>"
    assert html_extract.extract([page.format("alpha beta gamma"), page.format("one two three four")]) == ["alpha beta gamma", "one two three four"]
    near = page.format("alpha beta gamma " * 9 + "</p><p>{}")
    assert html_extract.extract([near.format("x"), near.format("y"), near.format("x")])[0].startswith("alpha beta gamma")


#: Pages of five sites without an article element, and what is content on each.
SITES = {
    "blog": ("<body><div class=top><a href=/>Home</a> <a href=/a>Archive</a></div><div id=c><h2>Post #</h2><p>Body # one</p><p>Body # two</p></div><div><p>Written with care.</p></div>", ["Post #", "Body # one", "Body # two"]),
    "table": ("<body><table><tr><td>Start | News</td><td><h1>Report #</h1><p>Line # a<p>Line # b</td></tr><tr><td>Imprint</td></tr></table>", ["Report #", "Line # a", "Line # b"]),
    "forum": ("<body><header>Forum</header><ul class=breadcrumbs><li>All #</ul><ol><li><div>Says # first</div><div>Reply to this</div><li><div>Says # second</div><div>Reply to this</div></ol>", ["Says # first", "Says # second"]),
    "shop": ("<body><form>Search #</form><main><h1>Item #</h1><div class=price>Costs #</div><div>Free delivery from 50</div></main><div class=ads>Buy #</div>", ["Item #", "Costs #"]),
    "docs": ("<body><div role=navigation>Chapter #</div><section><h1>Call #</h1><pre>run(#)</pre><dl><dt>arg #<dd>what # is</dl></section><div id=footer>v#</div>", ["Call #", "run(#)", "arg #", "what # is"]),
}


def test_labelled_pages_without_article():
    """Precision and recall of blocks over all sites; figures in the README."""
    got = want = both = 0
    for page, blocks in SITES.values():
        for i, text in enumerate(extract(page, 6)):
            found, true = text.split("\n\n"), [b.replace("#", f"v{i} w{i * i}") for b in blocks]
            got, want, both = got + len(found), want + len(true), both + sum(b in true for b in found)
    assert both / want == 1.0 and both / got == 1.0
