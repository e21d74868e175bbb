"""Pages without article or main elements, omitted end tags, marks on wrappers."""

import pytest

from reviewlens.llm import htmltext

PARA = "A paragraph of the article that is long enough to be taken for content by its ratio of text to tags"
LIST = "".join(f"<li>Item number {i} of a long list that says a good deal about its subject.</li>" for i in range(8))
ITEMS = "\n".join(f"Item number {i} of a long list that says a good deal about its subject." for i in range(8))
WANT = f"The title\nA short intro.\n{ITEMS}\nThe end."
BODY = f"<h1>The title</h1><p>A short intro.</p><ul>{LIST}</ul><p>The end.</p>"
NAV = '<nav><a href="/">Home</a> <a href="/x">More</a></nav>'
FOOT = '<footer><p>Copyright by somebody, all rights reserved.</p></footer>'


@pytest.mark.parametrize("page", [
    f"<html><head><title>T</title></head><body>{NAV}<div>{BODY}</div>{FOOT}</body></html>",
    f"<html><head><title>T</title><body>{NAV}<div>{BODY}</div>{FOOT}",
    f"<title>T</title><meta charset=utf-8><div>{BODY}</div>{FOOT}",
    f"<head><title>T</title><style>p {{}}</style><h1>The title</h1><p>A short intro.<ul>{LIST}</ul><p>The end.",
    f'<body class="has-sidebar"><div class="page has-sidebar comments-open">{NAV}<div id="text">{BODY}</div>'
    f'<div class="sidebar"><h3>About</h3><p>{PARA}</p></div></div>{FOOT}',
    f'<body><div class="widget"><section>{BODY}</section></div><div class="comments"><h3>2 replies</h3><p>{PARA}</p></div>{FOOT}',
    f"<body>{NAV}<section>{BODY}</section>{FOOT}",
])
def test_whole_article_without_named_elements(page):
    assert htmltext.main_text(page) == WANT


def test_marked_elements_beside_an_article_stay_out():
    page = f'<body><div class="post"><h1>T</h1><p>{PARA}</p></div><div class="comments"><h2>Replies</h2><p>{PARA}!</p><p>{PARA}?</p></div>'
    assert htmltext.main_text(page) == f"T\n{PARA}"
    named = f'<body><article class="has-comments"><h1>T</h1><p>{PARA}</p><div class="share"><p>Share this</p></div></article></body>'
    assert htmltext.main_text(named) == f"T\n{PARA}"


def test_nothing_to_extract():
    for page in ("", None, "<body></body>", f"<body>{NAV}{FOOT}</body>", "<head><title>T</title></head>"):
        assert htmltext.main_text(page) == ""
