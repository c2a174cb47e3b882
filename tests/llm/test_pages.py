"""Main text: comment threads, nested articles and menus at any depth."""

import pytest

from daymart.llm import html_extract

PROSE = "The river rose in the night, and by the morning the lower road, the mill and the yard stood under water. "
FILLER = f"<p>{PROSE}first</p><p>{PROSE}second</p>"
WANT = [f"{PROSE}first", f"{PROSE}second"]
THREAD = "".join(f"<p>I think, and my neighbour {k} agrees, that the mill was old, dark and damp. {PROSE}</p>" for k in range(12))


@pytest.mark.parametrize("open_", ["<article>", "<main>", "<div>", '<div class="post">', "<main><article>"])
@pytest.mark.parametrize("thread", ['<div class="comments">{}</div>', '<section id="comments">{}</section>',
                                    '<article class="comment">{}</article>', '<article class="post comment">{}</article>',
                                    '<ol class="comment-list">{}</ol>', '<div id="disqus_thread">{}</div>',
                                    '<div class="comment-body content">{}</div>'])
def test_comments_longer_than_the_article_stay_out(open_, thread):
    closing = "".join(f"</{t.split()[0].strip('>')}>" for t in reversed(open_[1:].split("<")))
    for page in (f"<body>{open_}{FILLER}{thread.format(THREAD)}{closing}</body>",
                 f"<body>{open_}{FILLER}{closing}{thread.format(THREAD)}</body>"):
        assert html_extract.main_text(page).split("\n") == WANT


def test_comment_articles_beside_and_below():
    each = "".join(f'<article class="comment" id="c{k}"><header>Anna</header><p>{PROSE}{k}</p></article>' for k in range(9))
    nested = f'<article class="comment"><p>{PROSE}x</p><article class="comment"><p>{PROSE}y</p></article></article>'
    for page in (f"<article>{FILLER}{each}</article>", f"<article>{FILLER}</article>{each}", f"<main><article>{FILLER}</article>{nested}{each}</main>"):
        assert html_extract.main_text(page).split("\n") == WANT


def test_a_page_of_nothing_but_comments_is_empty():
    assert html_extract.main_text(f'<body><div class="comments">{THREAD}</div></body>') == ""
    assert html_extract.main_text(f'<body><div class="sidebar">{FILLER}</div><div class="comments">{THREAD}</div></body>').split("\n") == WANT


@pytest.mark.parametrize("depth", [1, 150, 199, 200, 210, 1000, 20_000])
def test_menus_at_any_depth_stay_out(depth):
    menu = "<nav><ul>" + "".join(f"<li>Entry, with a comma, {k}. {PROSE}</li>" for k in range(9)) + "</ul></nav>"
    deep = "<div>" * depth + menu + "</div>" * depth
    page = f"<body>{deep}<article>{FILLER}</article></body>"
    assert html_extract.main_text(page).split("\n") == WANT
    inner = f"<body>{'<div>' * depth}{menu}<article>{FILLER}</article>{'</div>' * depth}</body>"
    assert html_extract.main_text(inner).split("\n") == WANT
    assert html_extract.main_text("<b>" * depth + "One sentence." + "</b>" * depth) == "One sentence."


def test_names_of_the_article_itself():
    for attributes in ('class="post"', 'class="sidebar article"', 'class="has-comments"', 'id="main-story"', 'class="social-policy"'):
        assert html_extract.main_text(f"<body><article {attributes}>{FILLER}</article></body>").split("\n") == WANT
    page = f'<body><article>{FILLER}</article><article class="related"><p>Other <a href="x">things</a></p></article></body>'
    assert html_extract.main_text(page).split("\n") == WANT
