"""Main-text extraction on pages of several make-ups."""

import time

import pytest

from almanac.llm.htmltext import extract, extract_main_text

ARTICLE = "<h1>Head &amp; line</h1><p>First  para,\n with <b>bold</b> text &lt;here&gt;.</p><p>Second<br>para</p><ul><li>one<li>two</ul>"
TEXT = "Head & line\nFirst para, with bold text <here>.\nSecond para\none\ntwo"


@pytest.mark.parametrize("page", [
    "<html><head><title>t</title><style>p{}</style></head><body><nav><a href=x>menu</a></nav><article>%s</article>"
    "<footer>foot note text that is long enough to matter, really long</footer></body></html>",
    "<body><header><h1>Site</h1></header><aside>side words</aside><main>%s</main><script>var t='</p>';</script></body>",
    "<div class='navbar'>a b c</div><div id=content>%s</div><div class='sidebar widget'>More words here, many of them, "
    "and more of them still, so that they outweigh the article by far, which should not matter at all.</div>",
    "<article>%s<div class='ad'>buy</div><section id='comments'><p>I liked this very much, it was a good read</p></section>"
    "<form><p>Subscribe now</p><input></form></article>",
    "<body><div class='cookie-notice'>We use cookies</div><div><div class='post'>%s</div></div>"
    "<noscript>no script</noscript><!-- <p>hidden</p> --></body>"])
def test_article_only(page):
    assert extract(page % ARTICLE) == TEXT


def test_unclosed_markup_and_tables():
    assert extract("<article><h1>T</h1><p><b>one.<br><p>two</p><p><i>three</article><footer>x</footer>") == "T\none.\ntwo\nthree"
    assert extract("<article><table><tr><td>a<td>b<tr><td>c</table></article>") == "a\nb\nc"
    assert extract("plain text, no tags") == "plain text, no tags"
    assert extract("<p>a < b &amp; c &nbsp; d</p>") == "a < b & c d"


def test_empty_null_and_long():
    assert extract(None) == extract("") == extract("<html><body></body></html>") == extract("<nav>x</nav>") == ""
    start = time.time()
    assert extract("<article><p>" + "word " * 400_000 + "</p></article>").count(" ") == 399_999
    for bad in ("<" * 60_000, "<a '" * 30_000, "<b>" * 30_000 + "</i>" * 30_000, "<div>" * 20_000 + "</p>" * 20_000, "&" * 50_000):
        extract(bad)
    assert time.time() - start < 30


def test_operator(spark):
    df = spark.createDataFrame([(1, "u", "<p>a b</p>", "x"), (None, None, None, "y"), (1, "u", "<p>a b</p>", "x")],
                               "page_id long, url string, html string, text string")
    got = sorted((tuple(r) for r in extract_main_text(df).collect()), key=str)
    assert got == [(1, "u", "a b", 3), (1, "u", "a b", 3), (None, None, "", 0)]
    assert extract_main_text(df.limit(0)).collect() == []


def test_density_decides_beside_article_elements():
    one = "".join(f"<p>{w} paragraph of the first part, with a good many words in it.</p>" for w in ("First", "Second", "Third"))
    two = "".join(f"<p>{w} paragraph of part two, somewhat shorter.</p>" for w in ("Fourth", "Fifth", "Sixth"))
    lead = "<h1>Head</h1><div class='lead'>The lead stands beside the article and tells what it is all about.</div>"
    links = "<nav>" + "".join(f"<a href=x{i}>entry {i}</a>" for i in range(9)) + "</nav>"
    for tag in ("article", "section", "div"):
        for page in (f"<body>{links}{lead}<{tag}>{one}</{tag}><{tag}>{two}</{tag}></body>",
                     f"<body>{lead}<div><{tag}>{one}</{tag}><{tag}>{two}</{tag}></div>{links}</body>"):
            lines = extract(page).split("\n")
            assert lines[0] == "Head" and lines[1].startswith("The lead") and len(lines) == 8, (tag, lines)
    # a short article element does not stand for a page whose text lies elsewhere
    got = extract(f"<body>{links}<div>{one}{two}</div><article><p>Teaser.</p></article></body>")
    assert got.count("paragraph") == 6


def test_only_hidden_elements_are_left_out():
    text = "<p>A paragraph of text, long enough to stand.</p><p>Another one beside it, as long as that.</p>"
    want = "A paragraph of text, long enough to stand.\nAnother one beside it, as long as that."
    for seen in ('class="overflow-hidden"', 'style="overflow:hidden"', 'title="hidden gems"', 'data-x1="a hidden b"',
                 'data-href="/hidden-lake"', 'title="display: none"', "title='a hidden class=nav'", 'aria-hidden="false"'):
        assert extract(f"<body><div {seen}>{text}</div></body>") == want, seen
    for unseen in ("hidden", "id=x hidden", 'hidden="" id=x', 'hidden="hidden"', "HIDDEN", 'style="color:red; Display : none"',
                   'style="visibility:hidden"', 'aria-hidden="true"'):
        assert extract(f"<body><div>{text}</div><div {unseen}>{text}</div></body>") == want, unseen


@pytest.mark.parametrize("opening", [
    '<div class="no-sidebar">', '<div class="post type-post comments-open">', '<div class="layout has-sidebar">',
    '<div id="notice-board-history">', '<div class="search-algorithms">', '<section id="related-work-1">'])
def test_names_that_only_contain_a_noise_word_are_kept(opening):
    end = f"</{opening[1:].split()[0]}>"
    foot = "<div class='site-footer'>The foot of the page, with a few words more</div>"
    assert extract(f"<body>{opening}{ARTICLE}{end}{foot}</body>") == TEXT
    # inside an article too
    assert extract(f"<body><article><h1>Top</h1><p>The opening of it all.</p>{opening}{ARTICLE}{end}</article>{foot}</body>") == \
        "Top\nThe opening of it all.\n" + TEXT


@pytest.mark.parametrize("name", ["sidebar", "sidebar-left", "main-nav", "site_footer", "related-posts", "ad-slot", "adSlot2 ad-slot-2",
                                  "cookie-notice", "x comments-area", "share-buttons", "widget widget_text", "newsletter-form"])
def test_compound_names_of_boilerplate_go(name):
    aside = f"<div class='{name}'><p>Words that are not part of the article, quite a few of them, in one paragraph.</p></div>"
    assert extract(f"<body><div id=content>{ARTICLE}</div>{aside}</body>") == TEXT
