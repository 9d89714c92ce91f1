"""Pages of many builds, written by hand; blocks of the article begin with @."""

import pytest

from feederlens.llm import extraction
from feederlens.llm.html_tree import Tree

T = "@The bridge over the river opens late"
A = "@The council met on Tuesday evening to discuss the new bridge, which has been delayed for two years, and heard from the engineers who drew it."
B = "@Work will go on through the winter. Engineers said that the piers are sound, but the deck has to be cast again, for the concrete was too wet."
C = "@“We have waited long enough,” said one shopkeeper, who has seen half of his customers go to the other side of town since the old bridge closed."
D = "@Nobody could say what the delay would cost."
E = "@A report is due in May; until then, the ferry runs every twenty minutes, free of charge, from six in the morning to midnight."
S = "@Short, but part of it."
NAV = "<ul><li><a href=/>Home</a></li><li><a href=/n>News</a></li><li><a href=/s>Sport</a></li><li><a href=/w>Weather</a></li></ul>"
LINKS = "<a href=/1>Other bridges of the county</a> <a href=/2>Ferries and timetables</a> <a href=/3>All about roads</a>"
COOKIE = "We use cookies to make this site work and to show you adverts. By going on you accept all of them."
BUY = "Buy two pairs of boots and get the third for free, only this week and only in our shop."
COMMENT = "I crossed it every day as a child, and I cannot believe that they still have not finished it, what a shame."

PAGES = {
    "body, h1 and paragraphs": f"<html><body><h1>{T}</h1><p>{A}</p><p>{B}</p><p>{C}</p><p>{D}</p><p>{E}</p></body></html>",
    "with nav and footer": f"<body><nav>{NAV}</nav><h1>{T}</h1><p>{A}</p><p>{B}</p><p>{C}</p><footer>&copy; 2024 The Paper</footer></body>",
    "one paragraph": f"<p>{A}</p>",
    "bare text": f"{A} and so on, as it was said.",
    "inline text in body": f"<body>{A} <b>Said so</b> and <i>did so</i>, as it was planned.</body>",
    "text and line breaks": f"<body>{A}<br><br>{B}<br>{C}</body>",
    "layout table": f"<table><tr><td width=120><a href=/>Home</a><br><a href=/n>News</a><br><a href=/s>Sport</a></td><td><h1>{T}</h1><p>{A}</p><p>{B}</p></td></tr></table>",
    "layout table with banner": f"<body><table border=0><tr><td colspan=2><b>The Paper</b></td></tr><tr><td><a href=/>Home</a> <a href=/n>News</a></td><td><p>{A}</p><p>{C}</p><p>{E}</p></td></tr></table></body>",
    "bare text in a cell": f"<table><tr><td><a href=/>Home</a><br><a href=/a>About</a><br><a href=/c>Contact</a></td><td>{A}<br><br>{B}</td></tr></table>",
    "article with has-sidebar": f"<body><header><a href=/>The Paper</a></header><article class='post has-sidebar'><h1>{T}</h1><p>{A}</p><p>{B}</p></article><aside><h3>More</h3>{LINKS}</aside></body>",
    "post with tag class": f"<body><nav>{NAV}</nav><div class='post tags-news'><h1>{T}</h1><p>{A}</p><p>{C}</p></div></body>",
    "search-result post": f"<body><article class='post search-result tags'><h2>{T}</h2><p>{A}</p><p>{B}</p></article></body>",
    "unclosed head": f"<html><head><title>The Paper</title><meta charset=utf-8><h1>{T}</h1><p>{A}</p><p>{B}</p>",
    "unclosed svg": f"<body><div><svg><path d='M0'><p>{A}</p><p>{B}</p></div></body>",
    "unclosed iframe": f"<body><iframe src=/ad><h1>{T}</h1><p>{A}</p><p>{C}</p></body>",
    "unclosed noscript": f"<body><noscript><img src=/x><h1>{T}</h1><p>{A}</p><p>{B}</p></body>",
    "unclosed object in a block": f"<body><div class=content><p>{A}</p><object data=x><p>{B}</p></div><footer>&copy; The Paper</footer></body>",
    "main": f"<body><header><h1>The Paper</h1><nav>{NAV}</nav></header><main><h2>{T}</h2><p>{A}</p><p>{B}</p><p>{D}</p></main><footer><p>Imprint</p></footer></body>",
    "article in main": f"<body><main><article><h1>{T}</h1><p>{A}</p><figure><img src=b><figcaption>{S}</figcaption></figure><p>{E}</p></article></main></body>",
    "divs without names": f"<body><div><div><a href=/>Home</a> <a href=/n>News</a></div><div><div>{A}</div><div>{B}</div><div>{C}</div></div></div></body>",
    "section per heading": f"<body><section><h2>{T}</h2><p>{A}</p></section><section><h2>@What comes next</h2><p>{B}</p><p>{E}</p></section></body>",
    "id content": f"<body><div id=header><a href=/>The Paper</a></div><div id=content><h1>{T}</h1><p>{A}</p><p>{B}</p></div><div id=footer>Imprint, contact, terms of use</div></body>",
    "cookie notice first": f"<body><div class=cookie-consent><p>{COOKIE}</p><button>Accept</button></div><article><h1>{T}</h1><p>{A}</p><p>{B}</p></article></body>",
    "advert between": f"<body><article><p>{A}</p><div class=ad><p>{BUY}</p></div><p>{B}</p><p>{C}</p></article></body>",
    "sponsored aside": f"<body><div class=story><h1>{T}</h1><p>{A}</p><p>{B}</p></div><aside class=sponsored><p>{BUY}</p></aside></body>",
    "comments after": f"<body><article><h1>{T}</h1><p>{A}</p><p>{C}</p></article><section id=comments><h3>2 comments</h3><p>{COMMENT}</p><p>{COMMENT}</p></section></body>",
    "comments as list": f"<body><div class=entry><p>{A}</p><p>{B}</p></div><ol class=comment-list><li class=comment><p>{COMMENT}</p></li><li class=comment><p>{COMMENT}</p></li></ol></body>",
    "newsletter form": f"<body><main><p>{A}</p><p>{B}</p><p>{E}</p></main><form><label>Your address</label><input><button>Subscribe</button></form></body>",
    "list in the article": f"<body><article><h1>{T}</h1><p>{A}</p><ul><li>@The ferry stays free.</li><li>@The old bridge goes.</li><li>@The road is closed.</li></ul><p>{B}</p></article></body>",
    "quote and code": f"<body><article><p>{A}</p><blockquote><p>{C}</p></blockquote><pre>@load = 12 * beams</pre><p>{B}</p></article></body>",
    "data table in the article": f"<body><article><h1>{T}</h1><p>{A}</p><table><tr><td>@Spring</td><td>@12 weeks</td></tr><tr><td>@Autumn</td><td>@9 weeks</td></tr></table><p>{B}</p></article></body>",
    "links in the text": f"<body><article><p>{A[:60]} <a href=/x>the old plan</a> {A[60:]}</p><p>{B} <a href=/y>Read the report</a>.</p></article></body>",
    "breadcrumbs": f"<body><div class=breadcrumbs><a href=/>Home</a> / <a href=/n>News</a></div><div class=content><h1>{T}</h1><p>{A}</p><p>{B}</p></div></body>",
    "pagination": f"<body><div class=content><p>{A}</p><p>{B}</p></div><div class=pagination><a href=/1>1</a> <a href=/2>2</a> <a href=/3>next</a></div></body>",
    "share buttons": f"<body><article><h1>{T}</h1><div class=social-share><a href=/f>Share</a> <a href=/t>Post</a></div><p>{A}</p><p>{B}</p></article></body>",
    "nav as table": f"<body><table class=menu><tr><td><a href=/>Home</a></td><td><a href=/n>News</a></td></tr></table><h1>{T}</h1><p>{A}</p><p>{B}</p></body>",
    "upper case tags": f"<HTML><BODY><H1>{T}</H1><P>{A}<P>{B}<P>{C}</BODY></HTML>",
    "unclosed paragraphs": f"<body><div id=nav><a href=/>Home</a> <a href=/n>News</a></div><div id=main><p>{A}<p>{B}<p>{C}</div></body>",
    "role main": f"<body><div role=banner><a href=/>The Paper</a></div><div role=main><h1>{T}</h1><p>{A}</p><p>{B}</p></div><div role=contentinfo>Imprint and terms</div></body>",
    "deep wrappers": f"<body><div><div><div><div class=wrap><div><h1>{T}</h1><p>{A}</p><p>{B}</p><p>{C}</p></div></div></div></div></div><footer>&copy; us</footer></body>",
    "two columns by class": f"<body><div class=row><div class=col-8><h1>{T}</h1><p>{A}</p><p>{B}</p><p>{C}</p></div><div class='col-4 sidebar'><h4>Most read</h4>{NAV}</div></div></body>",
    "hidden modal": f"<body><article><p>{A}</p><p>{B}</p></article><div class=modal style='display: none'><p>{COOKIE}</p></div></body>",
    "related stories": f"<body><article><h1>{T}</h1><p>{A}</p><p>{B}</p></article><div class=related><h3>Related</h3>{NAV}</div></body>",
    "paragraphs then long footer": f"<body><h1>{T}</h1><p>{A}</p><p>{B}</p><p>{E}</p><footer><p>The Paper is published by the town and its friends, since 1890.</p>{NAV}</footer></body>",
    "centred old page": f"<body bgcolor=white><center><h2>{T}</h2></center><font face=Arial>{A}</font><p><font face=Arial>{B}</font><hr><center><a href=/>Back</a> <a href=/n>Next</a></center></body>",
    "definition list": f"<body><main><h1>{T}</h1><dl><dt>@Deck</dt><dd>{B}</dd><dt>@Piers</dt><dd>{E}</dd></dl></main></body>",
    "noscript closed": f"<body><noscript><p>Please turn on scripts to see the adverts.</p></noscript><article><p>{A}</p><p>{C}</p></article></body>",
    "header inside the article": f"<body><article><header><h1>{T}</h1></header><p>{A}</p><p>{B}</p><footer>Filed under roads</footer></article></body>",
}


def judged(page):
    """(wanted, found) of each block."""
    tree = Tree(page)
    chance = dict(zip(map(id, tree.nodes), extraction.model().marginals(tree.nodes), strict=True))
    return [(text.startswith("@"), chance[id(node)] > 0.5, text) for node, text in tree.texts()]


@pytest.mark.parametrize("name", PAGES)
def test_every_page_gives_its_article(name):
    """Most of the article's characters at least, and no page empty."""
    blocks = judged(PAGES[name])
    wanted = sum(len(t) for want, _, t in blocks if want)
    assert wanted and sum(len(t) for want, found, t in blocks if want and found) >= 0.7 * wanted


def test_blocks_of_all_pages():
    found = [b for page in PAGES.values() for b in judged(page)]
    right = sum(want and got for want, got, _ in found)
    recall = right / sum(want for want, _, _ in found)
    precision = right / sum(got for _, got, _ in found)
    print(f"{len(PAGES)} pages, {len(found)} blocks, precision {precision:.3f}, recall {recall:.3f}")
    assert len(PAGES) >= 40 and precision >= 0.93 and recall >= 0.95


def test_no_silent_element_swallows_a_page():
    for tag in ("svg", "iframe", "noscript", "template", "object", "canvas", "audio", "video", "select", "math", "head", "title"):
        assert A in extraction.main_text(f"<body><{tag}><h1>{T}</h1><p>{A}</p><p>{B}</p></body>"), tag
        assert "shown" not in extraction.main_text(f"<body><p>{A}</p><{tag}>not shown</{tag}><p>{B}</p></body>") or tag == "head"


def test_deep_and_long_pages():
    deep = "<div>" * 40 + f"<h1>{T}</h1><p>{A}</p><p>{B}</p>" + "</div>" * 40
    assert A in extraction.main_text(f"<body>{deep}</body>")
    assert isinstance(extraction.main_text("<div>" * 5000 + A), str)
    long = f"<body><article>{''.join(f'<p>{A}</p>' for _ in range(3000))}</article></body>"
    assert extraction.main_text(long).count("\n") == 2999
    assert extraction.main_text("<svg>" * 2000 + f"<p>{A}</p><p>{B}</p>")


def test_clashing_columns_and_repeated_pages(spark):
    page = PAGES["main"]
    df = spark.createDataFrame([(1, "u", page, "old", 5), (1, "u", page, None, None), (2, None, None, "x", 1)], "page_id long, url string, html string, text string, n_chars long")
    rows = extraction.extract(df).collect()
    texts = {r.page_id: r.text for r in rows}
    assert len(rows) == 3 and texts[1].startswith(T) and texts[2] == ""
    assert all(r.n_chars == len(r.text) for r in rows)
