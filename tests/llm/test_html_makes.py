"""Main text of pages of several makes, each with its hand-cut answer, and of hostile ones."""

import time

import pytest

from paperloom.llm.html_text import extract

LONG = ["The first paragraph tells, with commas, what the matter is, and for whom.", "The second goes on about it at some length, and ends as it began.", "A third closes the text; it has nothing more to say."]
TEXT = "".join(f"<p>{p}</p>" for p in LONG)


def article(inside):
    return f"<html><body><nav><a href=x>Home</a> <a href=y>News</a></nav><article><h1>Title</h1>{TEXT}{inside}<p>The last one.</p></article><footer>Imprint. All rights.</footer></body></html>"


@pytest.mark.parametrize(
    ("inside", "kept"),
    [
        ("<p class='ad-hoc'>An ad hoc committee met on it.</p>", ["An ad hoc committee met on it."]), ("<p class='login-required'>Body text for all.</p>", ["Body text for all."]),
        ("<div class='reply'><p>Dear reader, thanks.</p><p>One thing is this. The other is that.</p></div>", ["Dear reader, thanks.", "One thing is this. The other is that."]),
        ("<h2>See also</h2><ul><li><a href=a>One page</a></li><li><a href=b>Another</a></li></ul>", ["See also", "One page", "Another"]),
        (f"<header><h2>{'Long ' * 250}title</h2></header>", ["Long " * 250 + "title"]), ("<p class='has-no-ads'>Plain words.</p>", ["Plain words."]), ("<table><tr><td>a</td><td>b</td></tr></table>", ["a", "b"]),
        ("<blockquote>No stop &amp; no&nbsp;end</blockquote>", ["No stop & no end"]),
        ("<div class='ad'>Buy this now. It is cheap.</div>", []), ("<div id='ad-banner'><p>Buy now. It is cheap.</p></div>", []), ("<section class='comments'><p>I liked it, thanks.</p></section>", []),
        ("<div class='reply'><a href=a>Reply</a> <a href=b>Share</a></div>", []), ("<div class='cookie-notice'>We use cookies. Accept them.</div>", []), ("<aside>Other stories. Read on.</aside>", []),
        ("<nav><a href=a>Next</a></nav>", []), ("<form>Your name. <input name=a></form>", []), ("<script>var x = '<p>no</p>';</script>", []), ("<div hidden>Not seen. Never.</div>", []),
    ],
)
def test_parts_of_an_article(inside, kept):
    assert extract(article(inside)).split("\n") == ["Title", *LONG, *kept, "The last one."]


MENU = "<ul class=menu><li><a href=a>Start</a></li><li><a href=b>Contact</a></li></ul>"
MAKES = {
    "divs": f"<body><div id=header><a href=/>Site</a></div>{MENU}<div id=content><h1>Title</h1>{TEXT}</div><div id=sidebar><h3>More</h3><a href=c>c</a></div><div id=footer>Imprint</div></body>",
    "main": f"<body><header><a href=/>Site</a>{MENU}</header><main><h1>Title</h1>{TEXT}</main><footer>Imprint, rights.</footer></body>",
    "table": f"<body><table><tr><td>{MENU}</td><td><h1>Title</h1>{TEXT}</td></tr><tr><td colspan=2 class=footer>Imprint</td></tr></table></body>",
    "comments": f"<body><div class=post><h1>Title</h1>{TEXT}</div><div class=comments><p>A reader says, at length, that all of this is wrong, or right.</p><p>Another one, of a like mind, agrees with it, and adds a thing.</p></div></body>",
    "broken": f"<body><div class=content><h1>Title</h1>{TEXT.replace('</p>', '')}</div><div class=ads><b>Buy</body>",
    "upper": f"<BODY><DIV CLASS='CONTENT'><H1>Title</H1>{TEXT.replace('p>', 'P>')}</DIV><DIV CLASS='NewsLetter'>Subscribe to it. Now.</DIV></BODY>",
    "sections": f"<body><article><h1>Title</h1><section>{TEXT[: TEXT.index('</p>') + 4]}</section><section>{TEXT[TEXT.index('</p>') + 4 :]}</section></article><section class=related><a href=x>Other</a></section></body>",
}


@pytest.mark.parametrize("make", sorted(MAKES))
def test_pages_of_several_makes(make):
    assert extract(MAKES[make]).split("\n") == ["Title", *LONG]


@pytest.mark.parametrize(
    "page",
    [
        "<script>" + '</script "' * 100_000, "<article>" + "<blockquote class=nav>" * 40_000 + "Hi." + "</blockquote>" * 40_000, "<p>" + (" " * 500) * 2000 + "x", "<div class='" + "a-" * 400_000 + "'>x",
        "<p>" + "<b>." * 60_000, "<style" * 150_000, "<ul>" + "<li><a href=x>y</a>" * 50_000,
    ],
    ids=range(7),
)
def test_hostile_pages_take_time_in_proportion(page):
    start = time.monotonic()
    extract(page)
    assert time.monotonic() - start < 5
