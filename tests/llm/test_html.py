"""Main text of hand-made pages."""

import pytest

from clickweave.llm.html import extract_text, main_text
from tests.llm.corpus import frame

LONG = "These are many words of an article that goes on for a good while, longer than any menu could be."


@pytest.mark.parametrize(
    "page, text",
    [
        (None, ""),
        ("", ""),
        ("<html><body></body></html>", ""),
        ("<article><h1>A</h1><p>b  c\n d</p><p><b>e.<br><p>f</article><p>after", "A b c d e. f"),
        ("<article><p>x &amp; y &lt;z&gt; &eacute;&#233;&#xe9; &copy</p></article>", "x & y <z> ééé ©"),
        ("<article><p>&amp;lt; stays</p></article>", "&lt; stays"),
        ("<nav><p>menu</p></nav><article><p>in</p></article><footer>foot</footer>", "in"),
        ("<article><p>a</p><aside>side</aside><div class='ad box'>buy</div><p>b</p></article>", "a b"),
        ("<article><p>a</p><form><p>name</p></form><p>b</p></article>", "a b"),
        ("<article><p>a</p><script>if (a<b) '</p><p>no'</script><style>p{}</style><p>b</p></article>", "a b"),
        ("<article><p>a</p><!-- <p>no</p> --><p>b</p></article>", "a b"),
        ("<article><p>a</p></article><section id='comments'><article><p>talk</p></article></section>", "a"),
        ("<article><p>a</p><div class='comments'><p>one</p><div><p>two</p></div></div><p>b</p></article>", "a b"),
        ("<article><p>see <a href='x'>this link</a> now</p></article>", "see this link now"),
        ("<article><p>in<b>si</b>de</p></article>", "inside"),
        ("<article><p>a<p class=notice>note<p>b</article>", "a b"),
        ("<div class='page-with-sidebar'><main><p>kept</p></main><div id=sidebar>no</div></div>", "kept"),
        ("<article><p>cut off in the mid<b", "cut off in the mid"),
        ("<article><p>a < b and 1<2</p></article>", "a < b and 1<2"),
        ("<article><p title='a > b'>t</p><img alt='x>y'><hr/>u</article>", "t u"),
        ("<ARTICLE><P>Big</P></ARTICLE>", "Big"),
        ("<header>site</header><article><header><h1>Head</h1></header><p>t</p></article>", "Head t"),
        ("<head><title>T</title><meta name=x><article><p>no end of head</p></article>", "no end of head"),
        ("<article><p>a<svg class='icon'/>b</p><svg><text>no</text></svg><p>c</p></article>", "ab c"),
        ("<form id=f><nav>menu</nav><article><p>wrapped</p></article></form>", "wrapped"),
        ("<form id=f><div>wrapped</div></form>", "wrapped"),
        ("<article><p>a</p></article><aside><article><p>teaser</p></article></aside>", "a"),
        ("<article><ul><li>one<li>two</ul><table><tr><td>c<td>d</table></article>", "one two c d"),
    ],
)
def test_marked_pages(page, text):
    assert main_text(page) == text


@pytest.mark.parametrize(
    "page, text",
    [
        ("<article><h2 id='related-work'>Related work</h2><p>a</p></article>", "Related work a"),
        ("<article><h2 class='notice'>Head</h2><p>a</p></article>", "Head a"),
        ("<article><section id='discussion'><p>a</p></section><p>b</p></article>", "a b"),
        ("<article><section id=social-history><p>a</p></section><p>b</p></article>", "a b"),
        ("<article class='post comments-open'><p>a</p></article>", "a"),
        ("<article class='discussion'><p>a</p></article>", "a"),
        ("<article><p>a</p></article><article class='comment'><p>talk</p></article>", "a"),
        (f"<body><div class='content has-sidebar'><p>{LONG}</p></div></body>", LONG),
        (f"<body><div class='site-footer'>{LONG}</div><p>{LONG}</p></body>", LONG),
    ],
)
def test_names_of_elements(page, text):
    assert main_text(page) == text


@pytest.mark.parametrize(
    "naming",
    [
        "id='comments'", "id='comments' class='comments-area'", "class='user-comments'", "class='comment-list'",
        "class='ad-slot'", "class='ad_box'", "id='ad-1'", "class='adSlot'", "class='share-buttons'",
        "class='newsletter-signup'", "class='sidebar-left'", "class='related-posts'", "class='cookie-notice'",
        "class='page-header'", "id='related-articles'", "class='reader-comments'", "role='complementary'",
    ],
)
def test_parts_beside_the_text_of_an_article(naming):
    for tag in ("div", "section", "ul"):
        beside = f"<{tag} {naming}><p>not this</p><{tag}><li>nor that</li></{tag}></{tag}>"
        assert main_text(f"<article><p>{LONG}</p>{beside}<p>End.</p></article>") == f"{LONG} End."
        assert main_text(f"<main><p>{LONG}</p><p>End.</p>{beside}</main>") == f"{LONG} End."
        if naming != "role='complementary'":
            assert main_text(f"<body><div><p>{LONG}</p><p>End.</p></div>{beside}</body>") == f"{LONG} End."


def test_comments_longer_than_their_article_go():
    talk = "".join(f"<li>{LONG}</li>" for _ in range(20))
    assert main_text(f"<article><p>{LONG}</p><ol class='comment-list'>{talk}</ol></article>") == LONG


@pytest.mark.parametrize("naming", ["id='discussion'", "id='notice'", "id='related-work'", "class='discussion'"])
def test_sections_named_for_what_they_are_about(naming):
    page = f"<article><p>Short start.</p><section {naming}><p>{LONG}</p><p>{LONG}</p></section></article>"
    assert main_text(page) == f"Short start. {LONG} {LONG}"


@pytest.mark.parametrize("foot", ["Imprint text here", "© 2024 Some Site", "Copyright Some Site. All rights reserved."])
def test_plain_foot_of_an_unmarked_page(foot):
    assert main_text(f"<body><div><p>{LONG}</p><p>End.</p></div><div>{foot}</div></body>") == f"{LONG} End."
    assert main_text(f"<body><div><p>{LONG}</p></div><div>{foot}</div><div>Contact us</div></body>") == LONG
    assert main_text(f"<body><p>{LONG}</p><p>End.</p><p>{foot}</p></body>") == f"{LONG} End."
    # inside of an article it is text
    assert main_text(f"<article><p>{LONG}</p><p>{foot}</p></article>") == f"{LONG} {foot}"


def test_second_container_of_an_unmarked_page():
    assert main_text(f"<body><div>{LONG}</div><aside>x</aside><div>Short part</div></body>") == f"{LONG} Short part"


def test_unmarked_page_keeps_the_surge():
    menu = "".join(f"<li><a href='/{i}'>entry {i}</a></li>" for i in range(20))
    page = (
        f"<body><ul>{menu}</ul><div>Top</div><div></div><br><h2>Title</h2><p>{LONG}</p><p>Short.</p><p>{LONG}</p>"
        "<div class='footer'>imprint</div></body>"
    )
    text = main_text(page)
    assert text.endswith(f"Title {LONG} Short. {LONG}")
    assert "entry" not in text and "imprint" not in text


def test_body_outside_of_a_teaser_card():
    body = "".join(f"<p>{LONG}</p>" for _ in range(5))
    for card in ("<article><p>Read this too</p></article>", "<article><h3>Next</h3></article>"):
        text = main_text(f"<body><div>Top</div><aside>x</aside><div>{body}</div>{card}</body>")
        assert text == " ".join([LONG] * 5)
    # boilerplate that is less than the article does not displace it
    assert main_text(f"<article>{body}</article><div>{LONG}</div>") == " ".join([LONG] * 5)


def test_unmarked_article_goes_on_behind_an_advert():
    advert = "<div class='ad'>buy</div>"
    page = f"<body><div><p>{LONG}</p>{advert}<p>Short end.</p></div>{advert}<div>imprint</div></body>"
    assert main_text(page) == f"{LONG} Short end."
    page = f"<body><div><p>{LONG}</p><p>{LONG}</p><aside>x</aside><p>a</p>{advert}<p>b</p></div></body>"
    assert main_text(page) == f"{LONG} {LONG} a b"


def test_short_unmarked_page_keeps_its_fullest_block():
    assert main_text("<body><div>just a line</div></body>") == "just a line"


def test_long_page():
    page = "<article>" + "<p>word &amp; word</p>" * 20_000 + "</article>"
    assert main_text(page) == " ".join(["word & word"] * 20_000)


def test_table(spark):
    data = [(1, "u", "<article><p>é𝄞</p></article>"), (1, "u", "<article><p>é𝄞</p></article>"), (2, None, None)]
    data.append((None, "v", ""))
    pages = frame(spark, data, "page_id bigint, url string, html string").withColumnRenamed("doc", "text")
    got = sorted((r.page_id or 0, r.url or "", r.text, r.n_chars) for r in extract_text(pages).collect())
    assert got == [(0, "v", "", 0), (1, "u", "é𝄞", 2), (1, "u", "é𝄞", 2), (2, "", "", 0)]
    assert extract_text(pages.limit(0)).count() == 0
