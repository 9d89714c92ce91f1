"""Labelled pages the extractor is trained on.

Layouts are written by hand, with ``data-label`` 1 on what is the article and 0
on what is not; elements inside inherit it. Words are drawn, so that nothing
is learnt from them but their length and marks.
"""

from __future__ import annotations

import random

#: How many pages the model is fitted on.
PAGES = 1000

_LETTERS = "etaoinshrdlucmfwyp"


def _words(draw: random.Random, low: int, high: int) -> str:
    words = ["".join(draw.choice(_LETTERS) for _ in range(draw.randint(1, 9))) for _ in range(draw.randint(low, high))]
    for i in range(len(words)):
        if draw.random() < 0.12:
            words[i] += draw.choice(",.;")
    return " ".join(words).capitalize()


def _links(draw: random.Random, low: int = 3, high: int = 9) -> str:
    return "".join(f'<li><a href="/{i}">{_words(draw, 1, 3)}</a></li>' for i in range(draw.randint(low, high)))


def _frame(draw: random.Random, place: str) -> str:
    """Something that is not the article, for the top, the side or the end of a page."""
    short, long = _words(draw, 2, 9), _words(draw, 8, 40) + "."
    choices = {
        "top": [
            f'<nav data-label="0"><ul>{_links(draw)}</ul></nav>',
            f'<header data-label="0"><h1>{_words(draw, 1, 4)}</h1><nav><ul>{_links(draw)}</ul></nav></header>',
            f'<div class="navbar" data-label="0"><ul>{_links(draw)}</ul></div>',
            f'<div id="header" data-label="0"><p>{short}</p></div>',
            f'<div class="cookie-notice" data-label="0"><p>{long}</p><button>{_words(draw, 1, 2)}</button></div>',
            f'<div class="ad" data-label="0">{long}</div>',
            f'<div class="top-banner" data-label="0"><p>{long}</p></div>',
            f'<table class="menu" data-label="0"><tr><td><a href="/">{short}</a></td><td><a href="/b">{short}</a></td></tr></table>',
            f'<table data-label="0"><tr>{"".join(f'<td><a href="/{i}">{_words(draw, 1, 3)}</a></td>' for i in range(draw.randint(2, 7)))}</tr></table>',
            f'<div data-label="0">{" ".join(f'<a href="/{i}">{_words(draw, 1, 3)}</a>' for i in range(draw.randint(2, 7)))}</div>',
            f'<div class="breadcrumbs" data-label="0"><a href="/">{_words(draw, 1, 2)}</a> / <a href="/x">{_words(draw, 1, 2)}</a></div>',
        ],
        "side": [
            f'<aside data-label="0"><h3>{short}</h3><ul>{_links(draw)}</ul></aside>',
            f'<div class="sidebar" data-label="0"><h3>{short}</h3><p>{long}</p><ul>{_links(draw)}</ul></div>',
            f'<div class="sponsored" data-label="0"><p>{long}</p></div>',
            f'<form data-label="0"><label>{short}</label><input name="q"><p>{long}</p><button>{_words(draw, 1, 2)}</button></form>',
            f'<div class="newsletter" data-label="0"><h4>{short}</h4><p>{long}</p></div>',
            f'<aside class="related" data-label="0"><p>{long}</p></aside>',
            f'<div class="social-share" data-label="0"><a href="/s">{short}</a></div>',
        ],
        "end": [
            f'<footer data-label="0">&copy; {short}</footer>',
            f'<footer data-label="0"><p>{long}</p><ul>{_links(draw)}</ul></footer>',
            f'<div id="footer" data-label="0"><p>{long}</p></div>',
            f'<section class="comments" data-label="0"><h2>{short}</h2><div class="comment"><p>{long} {long}</p></div><div class="comment"><p>{long}</p></div></section>',
            f'<div id="comments" data-label="0"><ol><li><article class="comment"><p>{long} {long}</p></article></li></ol></div>',
            f'<div class="pagination" data-label="0"><a href="/1">1</a> <a href="/2">2</a></div>',
            f'<div class="disclaimer" data-label="0"><p>{long}</p></div>',
        ],
    }
    return draw.choice(choices[place])


#: Classes that speak for two things, as wrappers of articles have them.
_MIXED = [
    "post has-sidebar", "post tags-news", "post search-result tags", "entry related-content", "content with-menu",
    "page-header-off main", "article-body share-enabled", "story social", "content no-comments", "post promoted",
    "layout sidebar-right", "page nav-fixed", "hentry category-meta",
]


def _body(draw: random.Random) -> str:
    """What an article holds, without an element around it."""
    title = f"<h1>{_words(draw, 2, 10)}</h1>"
    parts = [f"<header>{title}</header>" if draw.random() < 0.15 else title] if draw.random() < 0.8 else []
    for _ in range(draw.randint(1, 9)):
        kind = draw.random()
        if kind < 0.58:
            parts.append(f"<p>{_words(draw, 3, 90)}.</p>")
        elif kind < 0.66:
            parts.append(f"<h2>{_words(draw, 1, 7)}</h2>")
        elif kind < 0.74:
            parts.append("<ul>" + "".join(f"<li>{_words(draw, 2, 14)}</li>" for _ in range(draw.randint(2, 6))) + "</ul>")
        elif kind < 0.80:
            parts.append(f"<blockquote><p>{_words(draw, 8, 40)}.</p></blockquote>")
        elif kind < 0.86:
            parts.append("<table>" + "".join(f"<tr><td>{_words(draw, 1, 4)}</td><td>{_words(draw, 1, 6)}</td></tr>" for _ in range(3)) + "</table>")
        elif kind < 0.96:
            parts.append(f'<p>{_words(draw, 5, 30)} <a href="/y">{_words(draw, 1, 4)}</a> {_words(draw, 5, 30)}.</p>')
        else:
            parts.append(f"<pre>{_words(draw, 4, 30)}</pre>")
    return "".join(parts)


def _plain(draw: random.Random) -> str:
    """Text without paragraphs: bare, with line breaks, or in inline elements."""
    lines = [f"{_words(draw, 12, 80)}." for _ in range(draw.randint(1, 6))]
    return draw.choice([
        "<br><br>".join(lines), "\n\n".join(lines), "".join(f"<b>{_words(draw, 1, 4)}</b> {x}<br>" for x in lines),
        "".join(f"<span>{x}</span> " for x in lines), "".join(f"<font size=2>{x}</font><hr>" for x in lines),
        "<h1>" + _words(draw, 2, 8) + "</h1>" + "<br>".join(lines), "".join(f"<div>{x}</div>" for x in lines),
    ])


def _article(draw: random.Random) -> str:
    inner = _body(draw) if draw.random() < 0.75 else _plain(draw)
    if draw.random() < 0.15:
        inner += f'<div class="ad" data-label="0"><p>{_words(draw, 5, 25)}.</p></div><p>{_words(draw, 20, 60)}.</p>'
    if draw.random() < 0.1:
        inner += f'<footer data-label="0">{_words(draw, 3, 12)}</footer>'
    opening, closing = draw.choice([
        ("<article data-label=\"1\">", "</article>"),
        ("<main data-label=\"1\">", "</main>"),
        ("<main data-label=\"1\"><article>", "</article></main>"),
        ("<div class=\"content\" data-label=\"1\">", "</div>"),
        ("<div id=\"main-content\" data-label=\"1\"><div class=\"post\">", "</div></div>"),
        ("<div data-label=\"1\">", "</div>"),
        ("<section class=\"entry\" data-label=\"1\">", "</section>"),
        ("<div class=\"wrap\"><div class=\"story\" data-label=\"1\">", "</div></div>"),
        ("<div role=\"main\" data-label=\"1\">", "</div>"),
        (f"<{(tag := draw.choice(['article', 'div', 'section', 'main']))} class=\"{draw.choice(_MIXED)}\" data-label=\"1\">", f"</{tag}>"),
    ])
    return opening + inner + closing


def _in_cells(draw: random.Random) -> str:
    """A page laid out by a table, the article in one of its cells."""
    inner = _body(draw) if draw.random() < 0.45 else _plain(draw)
    links = "<br>".join(f'<a href="/{i}">{_words(draw, 1, 3)}</a>' for i in range(draw.randint(3, 9)))
    side = f'<td width="150" data-label="0">{links}</td>'
    if draw.random() < 0.5:
        side = f'<td data-label="0">{links}</td>'
    cells = [side, f'<td data-label="1">{inner}</td>']
    if draw.random() < 0.3:
        cells.append(f'<td data-label="0"><p>{_words(draw, 3, 15)}</p></td>')
    head = f'<tr data-label="0"><td colspan="3"><b>{_words(draw, 1, 5)}</b></td></tr>' if draw.random() < 0.6 else ""
    foot = f'<tr data-label="0"><td colspan="3">&copy; {_words(draw, 2, 9)}</td></tr>' if draw.random() < 0.6 else ""
    return f'<table width="100%">{head}<tr>{"".join(cells)}</tr>{foot}</table>'


def labelled_pages(count: int = PAGES, seed: int = 7) -> list[str]:
    draw = random.Random(seed)
    pages = []
    for _ in range(count):
        top = "".join(_frame(draw, "top") for _ in range(draw.randint(0, 3)))
        before = _frame(draw, "side") if draw.random() < 0.3 else ""
        after = "".join(_frame(draw, "side") for _ in range(draw.randint(0, 2)))
        end = "".join(_frame(draw, "end") for _ in range(draw.randint(0, 3)))
        kind = draw.random()
        if kind < 0.5:
            page = f"<body>{top}{before}{_article(draw)}{after}{end}</body>"
        elif kind < 0.83:
            # The body is the article, with frames in it or none.
            inner = _body(draw) if draw.random() < 0.6 else _plain(draw)
            page = f'<body data-label="1">{top}{before}{inner}{after}{end}</body>'
        else:
            page = f"<body>{top if draw.random() < 0.4 else ''}{_in_cells(draw)}{end if draw.random() < 0.4 else ''}</body>"
        pages.append(f"<html><head><title>x</title></head>{page}</html>")
    return pages
