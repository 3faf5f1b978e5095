"""Main texts of pages against the paragraphs the pages are made of."""

from __future__ import annotations

import html
import re

import pytest

from findlark.llm import regions

PAGES = "page_id long, url string, html string, text string, n_chars int"

HEAD = "<!DOCTYPE html><html><head><title>No title</title><style>p{}</style><script>var t='<p>no script</p>';</script></head>"
MENU = '<nav><ul><li><a href="/a">Home page</a></li><li><a href="/b">About all of us</a></li></ul></nav>'
TOP = '<header><a href="/">The site</a><p>The best site of all the sites there are</p></header>'
COOKIE = '<div class="cookie-notice">We use cookies; accept them all or go away from here now please</div>'
FORM = '<form><label>Search for</label><input name=q><button>Go on and search</button></form>'
SIDE = '<aside><h3>Popular</h3><ul><li>one two three four five six seven</li></ul></aside>'
RELATED = '<ul><li><a href="/1">Another article to read</a></li><li><a href="/2">One more of them</a></li></ul>'
AD = '<div class="advertisement"><p>Buy now the best thing ever made by anyone</p></div>'
COMMENTS = '<section id="comments"><h2>Comments</h2>' + '<div class="comment"><p>Reader says that this is a fine thing to read</p></div>' * 5 + "</section>"
FOOT = "<footer>&copy; all rights are reserved by the owner of the site</footer></body></html>"

BLOCKS = [
    "A title of it",
    "The first paragraph has some words, then a <b>bold</b> one and <a href='/x'>a link</a> in it.",
    "Some &lt;tags&gt; &amp; signs:\n\t much   white&nbsp;space, caf&eacute; &#128512; and more words to come.",
    "Short.",
    "The last paragraph of the text has enough words to be taken for text by anyone who counts.",
]
PLAIN = [" ".join(html.unescape(re.sub("<[^>]*>", "", b)).split()) for b in BLOCKS]


def page(start, stop, between="", paragraph="<p>%s</p>"):
    inner = f"<h1>{BLOCKS[0]}</h1>" + between.join(paragraph % b for b in BLOCKS[1:])
    return f"{HEAD}<body class='has-sidebar'>{TOP}{MENU}{COOKIE}{FORM}{start}{inner}{stop}{SIDE}{FOOT}"


@pytest.fixture(scope="module")
def pages(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/pages.parquet")


@pytest.fixture(scope="module")
def weights(pages):
    return regions.learn(pages)


def paragraphs(source):
    """What the made pages hold between their article tags, by plain string work."""
    inner = source[source.index("<article>") + 9 : source.index("</article>")]
    parts = re.split(r"</?(?:p|h1)>", inner)
    lines = [" ".join(html.unescape(re.sub("<[^>]*>", "", part)).split()) for part in parts]
    return "\n".join(line for line in lines if line)


def test_query_small_table(pages):
    rows = {r["page_id"]: r for r in pages.collect()}
    found = regions.main_texts(pages).collect()
    assert len(found) == len(rows)
    for row in found:
        source = rows[row["page_id"]]
        assert row["text"] == paragraphs(source["html"])
        assert (row["url"], row["n_chars"]) == (source["url"], len(row["text"]))


def test_undeclared_article(pages, weights):
    """The same pages without their article tags: tags and words alone lead to the region."""
    for row in pages.collect():
        bare = row["html"].replace("<article>", "<div>").replace("</article>", "</div>")
        assert regions.main_text(regions.Page(bare), weights) == paragraphs(row["html"])


@pytest.mark.parametrize(
    ("start", "stop"),
    [
        ("<article>", COMMENTS + "</article>"),
        ("<main><article>", "</article>" + COMMENTS + "</main>"),
        ("<main>", COMMENTS + RELATED + "</main>"),
        ('<div role="main">', "</div>" + COMMENTS),
        ('<div id="content"><div class="post-body">', "</div>" + COMMENTS + "</div>"),
        ("<table><tr><td>", "</td></tr></table>" + COMMENTS),
        ("<div><div>", "</div></div>" + COMMENTS),
        ('<article><div class="share-buttons">Share this with all the world</div>', "</article>"),
    ],
)
def test_layouts(weights, start, stop):
    for between in ("", AD):
        assert regions.main_text(regions.Page(page(start, stop, between)), weights) == "\n".join(PLAIN)


def test_bad_nesting_and_cuts(weights):
    whole = page("<article>", "</article>")
    loose = page("<article>", "</article>", paragraph="<p><b>%s<br>")
    assert regions.main_text(regions.Page(loose), weights) == "\n".join(PLAIN)
    stray = page("<article>", "</article>", between="</div></span></section>")
    assert regions.main_text(regions.Page(stray), weights) == "\n".join(PLAIN)
    cut = whole[: whole.index("Short.") + 6]
    assert regions.main_text(regions.Page(cut), weights) == "\n".join(PLAIN[:4])
    upper = re.sub(r"</?(\w+)", lambda m: m[0].upper(), whole)
    assert regions.main_text(regions.Page(upper), weights) == "\n".join(PLAIN)
    for broken in ("<p>a<!-- never closed", "<p>a<script>x", '<p>a<a href="x', "<p>a<"):
        assert regions.main_text(regions.Page(broken), weights).startswith("a")


def test_scores_and_scan(weights):
    """Words score above zero, tags below; no other region of whole texts scores more."""
    source = page("<div><div>", "</div></div>" + COMMENTS)
    for name in sorted(regions.KNOWN):
        assert weights.tag("any", name) < 0 < weights.word("any", name, False) <= 1
    parsed = regions.Page(source)
    scores = []
    for piece in parsed.order:
        if isinstance(piece, int):
            block, _, count, leaf, linked, beside, _ = parsed.texts[piece]
            scores.append((block, 0 if beside else count * weights.word("any", leaf, linked)))
        else:
            scores.append((None, 0 if piece[1] else weights.tag("any", piece[0])))
    best = max(
        ((sum(s for _, s in scores[i:j]), i, j) for i in range(len(scores)) for j in range(i + 1, len(scores) + 1)),
    )
    blocks = [b for b, s in scores[best[1] : best[2]] if b is not None and s]
    lines = {" ".join(t.split()) for b, t, n, *_ in parsed.texts if n and min(blocks) <= b <= max(blocks)}
    assert PLAIN[0] in lines and PLAIN[3] in lines


def test_odd_pages(spark, pages):
    long = "<article>" + "<p>many words in here</p>" * 50_000 + "</article>"
    rows = [
        (1, "u", None, "x", 3), (2, None, "", "x", 3), (None, "v", "plain words", None, None), (3, "w", " \n\t ", "x", 3),
        (4, "u", long, "x", 3), (5, "u", "<p>same</p>", "x", 3), (5, "u", "<p>same</p>", "x", 3), (6, "u", "<<<>>>&&amp;", "x", 3),
    ]
    found = regions.main_texts(spark.createDataFrame(rows, PAGES), regions.learn(pages)).collect()
    texts = ["", "", "plain words", "", "\n".join(["many words in here"] * 50_000), "same", "same", "<<<>>>&&"]
    assert [(r["page_id"], r["url"], r["text"], r["n_chars"]) for r in found] == [
        (i, u, t, len(t)) for (i, u, *_), t in zip(rows, texts)
    ]


def test_empty_table_and_no_labels(spark):
    nothing = spark.createDataFrame([], PAGES)
    assert regions.main_texts(nothing).count() == 0
    unlabelled = spark.createDataFrame([(1, "u", page("<div>", "</div>"), "x", 3)], PAGES)
    assert regions.main_texts(unlabelled).first()["text"] == "\n".join(PLAIN)
