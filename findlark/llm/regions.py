"""Main text of web pages: the maximum-scoring subsequence of words and tags."""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from findlark.llm.common import batches_of, ship

ship(__name__)

SCAN_BYTES = 4 << 20
# score of a tag that is never seen in main text, against 1 for a word that always is
TAG_COST = 3.25
# what a tag costs that is never seen outside of main text
TAG_LEAST = 0.01
# counts added to every feature before it has been seen, with the share of main text they suppose
PRIOR, WORD_SHARE, LINK_SHARE, TEXT_TAG_SHARE, TAG_SHARE = 20.0, 0.7, 0.1, 0.9, 0.3

# Element names of HTML by what they are to this module.
RAW = frozenset("script style xmp iframe noembed noframes textarea title".split())
HIDDEN = frozenset("head noscript template svg math select button datalist object canvas audio video dialog".split())
AROUND = frozenset("nav aside footer form menu".split())
SECTIONS = frozenset("html body main article section nav aside header footer form".split())
NESTED = SECTIONS | HIDDEN | frozenset("div ul ol dl table thead tbody tfoot tr figure fieldset details menu center".split())
LEAVES = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd td th pre blockquote figcaption caption address summary legend hgroup".split())
BREAKS = NESTED | LEAVES | {"hr", "option", "optgroup"}
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar toolbar".split())

# Words by which class and id names tell what an element is for, whole or as a start.
NOTICES = frozenset(
    "nav navbar navigation menu masthead topbar toolbar ad ads adslot advert banner notice alert toast popup modal "
    "overlay consent gdpr paywall login signup search share sharing social pager pagination related recommended "
    "replies reply respond widget skip rail".split()
)
STARTS = (
    "sidebar", "comment", "advert", "sponsor", "cookie", "newsletter", "subscri", "breadcrumb", "promo", "footer",
    "disqus", "discuss", "notification", "recommend", "submenu", "hidden",
)
HEADS = frozenset("header head".split())
CONTENT = frozenset("article post entry story content main body text".split())
MAIN_TEXT = frozenset("article post entry story articlebody".split())

NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<end>/?)(?P<name>[A-Za-z][^\s/>]*)(?P<more>(?:[^>\"']|\"[^\"]*\"|'[^']*')*+)(?:>|\Z)"
    r"|<(?P<end2>/?)(?P<name2>[A-Za-z][^\s/>]*)[^>]*(?:>|\Z)",
    re.S,
)
TEXT_TAGS = frozenset("p h1 h2 h3 h4 h5 h6 br b i em strong u s sub sup code pre blockquote".split())
KNOWN = BREAKS | RAW | frozenset("a b br i em strong span img u s small sub sup code label input meta link font".split())


def purpose(name: str, more: str, inside: bool) -> tuple[bool, int]:
    """Whether an element is beside the main text, and how surely it is the main text (0 to 3)."""
    if name in ("html", "body"):
        return False, 0
    level = {"article": 3, "main": 2}.get(name, 0)
    beside = name in AROUND or name in HIDDEN or (name == "header" and not inside)
    if not more or "=" not in more and "hidden" not in more:
        return beside, 0 if beside else level
    for key, *values in ATTRIBUTE.findall(more):
        key, value = key.lower(), "".join(values)
        if key == "hidden" or (key == "aria-hidden" and value == "true"):
            beside = True
        elif key == "role":
            beside = beside or value.lower() in ROLES
            level = max(level, 2 if value.lower() == "main" else 0)
        elif key == "itemprop" and value == "articleBody":
            level = 3
        elif key == "style":
            plain = value.lower().replace(" ", "")
            beside = beside or "display:none" in plain or "visibility:hidden" in plain
        elif key in ("class", "id"):
            for part in value.split():
                names = [n.lower() for n in NAME.findall(part)]
                about = [n for k, n in enumerate(names) if not (k and names[k - 1] in ("has", "with", "no", "without"))]
                if any(n in NOTICES or n.startswith(STARTS) for n in about):
                    beside = beside or name not in ("article", "main")  # names on these are of the layout
                    if name == "article" and any(n.startswith("comment") for n in about):
                        beside = True
                elif HEADS & set(about) and not inside and not CONTENT & set(about):
                    beside = True
                elif name in ("div", "section", "td") and MAIN_TEXT & set(about):
                    level = max(level, 1)
    return beside, 0 if beside else level


class Page:
    """The pieces of one page: texts between tags with what is known of them, and tags.

    ``texts`` holds ``(block, text, words, leaf, linked, beside, level)``; ``marks`` the sequence of
    text numbers and, for tags, ``(name, beside, level)`` of the element around it, in page order;
    ``lists`` the list element each block is in.
    """

    def __init__(self, source: str):
        self.texts: list[tuple] = []
        self.order: list[int | tuple] = []
        self.lists: dict[int, int] = {}
        self.levels: set[int] = set()
        # open elements: name, beside, level, list
        stack: list[tuple[str, bool, int, int]] = [("", False, 0, 0)]
        block, leaf, linked, at, lists = 0, "", False, 0, 0
        length = len(source)
        while at < length:
            tag = TAG.search(source, at)
            text = source[at : tag.start() if tag else length]
            if text:
                _, beside, level, _list = stack[-1]
                text = html.unescape(text)
                count = len(text.split())
                self.order.append(len(self.texts))
                self.texts.append((block, text, count, leaf, linked, beside, level))
                if _list:
                    self.lists[block] = _list
            if not tag:
                break
            at = tag.end()
            name = (tag["name"] or tag["name2"] or "").lower()
            if not name:
                continue
            closing = bool(tag["end"] or tag["end2"])
            if not closing and name in RAW:
                over = re.compile(rf"</{name}(?=[\s/>]|\Z)[^>]*(?:>|\Z)", re.I).search(source, at)
                at = over.end() if over else length
                continue
            if name == "br":
                self.order.append(("br", *stack[-1][1:3]))
                self.texts.append((block, " ", 0, leaf, linked, *stack[-1][1:3]))
                continue
            kept = name if name in KNOWN else "other"
            if name not in NESTED:
                self.order.append((kept, *stack[-1][1:3]))
            if name == "a":
                linked = not closing
                continue
            if name not in BREAKS:
                continue
            block += 1
            if name in NESTED:
                linked, leaf = False, ""
                if not closing:
                    self.order.append((kept, *stack[-1][1:3]))
                    _, beside, level, _list = stack[-1]
                    own, kind = purpose(name, tag["more"] or "", level > 0)
                    beside = beside or own
                    if not beside:
                        level = max(level, kind)
                        self.levels.add(level)
                    if name in ("ul", "ol", "menu"):
                        lists += 1
                        _list = lists
                    stack.append((name, beside, level, _list))
                else:
                    for k in range(len(stack) - 1, 0, -1):
                        if stack[k][0] == name:
                            del stack[k:]
                            break
                        if stack[k][0] in SECTIONS and name not in SECTIONS:
                            break
                    self.order.append((kept, *stack[-1][1:3]))
            elif not closing:
                if name != "li":
                    linked = False
                leaf = name
            else:
                leaf, linked = "", False

    def scope(self) -> int:
        """The surest level of main text the page declares."""
        return max(self.levels, default=0)


def word_feature(scope: str, leaf: str, linked: bool) -> str:
    return f"w {scope} {leaf or '-'} {'a' if linked else '-'}"


def features(page: Page) -> Counter:
    """Counts of the features of a labelled page: ``(feature, whether inside)`` to occurrences."""
    found: Counter = Counter()
    scope = page.scope()
    for piece in page.order:
        if isinstance(piece, int):
            _, _, count, leaf, linked, beside, level = page.texts[piece]
            kind = lambda where: word_feature(where, leaf, linked)  # noqa: E731, B023
        else:
            name, beside, level = piece
            count = 1
            kind = lambda where: f"t {where} {name}"  # noqa: E731, B023
        inside = level == scope
        if count and not beside:
            found[kind("in" if inside else "out"), inside] += count
            found[kind("any"), inside] += count
    return found


class Weights:
    """Scores of words and tags from counts inside and outside of the main text of labelled pages."""

    def __init__(self, counts: dict[str, tuple[int, int]]):
        self.counts = counts
        self.known: dict[str, float] = {}

    def share(self, feature: str, supposed: float) -> float:
        if feature not in self.known:
            inside, outside = self.counts.get(feature, (0, 0))
            self.known[feature] = (inside + PRIOR * supposed) / (inside + outside + PRIOR)
        return self.known[feature]

    def word(self, scope: str, leaf: str, linked: bool) -> float:
        """More than 0, at most 1."""
        supposed = {"in": 0.99, "out": 0.01}.get(scope, LINK_SHARE if linked else WORD_SHARE)
        return self.share(word_feature(scope, leaf, linked), supposed)

    def tag(self, scope: str, name: str) -> float:
        """Less than 0."""
        supposed = {"in": 0.99, "out": 0.01}.get(scope, TEXT_TAG_SHARE if name in TEXT_TAGS else TAG_SHARE)
        return -TAG_LEAST - TAG_COST * (1 - self.share(f"t {scope} {name}", supposed))


def main_text(page: Page, weights: Weights) -> str:
    """Text of the best-scoring region: whole blocks, without those beside the main text."""
    best = total = 0.0
    start, found = None, None
    scope = page.scope()
    for piece in page.order:
        if isinstance(piece, int):
            block, _, count, leaf, linked, beside, level = page.texts[piece]
        else:
            name, beside, level = piece
        # elements beside the main text are cut out; what is left of them are their own two tags
        if beside:
            continue
        where = "any" if not scope else "in" if level == scope else "out"
        if not isinstance(piece, int):
            total += weights.tag(where, name) if start is not None else 0
            if total <= 0:
                total, start = 0.0, None
        elif count:
            start = block if start is None else start
            total += count * weights.word(where, leaf, linked)
            if total > best:
                best, found = total, (start, block)
    if found is None:
        return ""
    blocks: dict[int, list[str]] = {}
    menus: dict[int, bool] = {}
    for block, text, count, _, linked, beside, _ in page.texts:
        if found[0] <= block <= found[1] and not beside:
            blocks.setdefault(block, []).append(text)
            if count and block in page.lists:
                of = page.lists[block]
                menus[of] = menus.get(of, True) and linked
    lines = (
        " ".join("".join(parts).split()) for block, parts in blocks.items() if not menus.get(page.lists.get(block, 0))
    )
    return "\n".join(line for line in lines if line)


COUNTS = T.StructType(
    [
        T.StructField("feature", T.StringType()),
        T.StructField("inside", T.LongType()),
        T.StructField("outside", T.LongType()),
    ]
)


def learn(pages: DataFrame) -> Weights:
    """Weights from all pages (``html``) that declare their main text by an ``article`` or ``main``.

    Counts are summed per batch in the tasks and then in Spark; features are element names of a
    fixed list, so at most a few hundred rows reach the driver, whatever the data.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        for batch in batches:
            for source in batch.column(0):
                page = Page(source.as_py() or "")
                if page.scope() >= 2:
                    total.update(features(page))
        names = sorted({name for name, _ in total})
        columns = [names, [total[n, True] for n in names], [total[n, False] for n in names]]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int64(), pa.int64()))], COUNTS.names)

    rows = pages.select("html").mapInArrow(count, COUNTS)
    sums = rows.groupBy("feature").agg(F.sum("inside").alias("inside"), F.sum("outside").alias("outside"))
    return Weights({r["feature"]: (r["inside"], r["outside"]) for r in sums.collect()})


RESULT = T.StructType(
    [
        T.StructField("page_id", T.LongType()),
        T.StructField("url", T.StringType()),
        T.StructField("text", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)


def main_texts(pages: DataFrame, weights: Weights | None = None) -> DataFrame:
    """``page_id, url, text, n_chars`` of every row of ``pages`` (``page_id``, ``url``, ``html``).

    A page is a sequence of words, which score more than 0, and tags, which score less; the
    contiguous region of the highest sum is its main text. The scores are learned from the pages
    that declare their main text (:func:`learn`): a word counts by the share of words of its kind
    that is main text (kind: innermost block, linked or not, in or out of a declared main text), a
    tag by the share of its kind that is not. The region is widened to whole blocks; elements beside
    the main text (by element name, role, class and id words) and lists of links are left out of it.

    A null or empty page, and one without words, has the text ''. Truncated and badly nested pages
    are read as far as they go. Rows are judged one by one: repeated rows and ids give a row each, null ids
    and urls stay null, an empty table gives none, other columns are ignored. Pages are never cut.
    Ties go to the region that ends first. Nothing is shuffled but the counts.
    """
    if weights is None:
        weights = learn(pages)
    counts = weights.counts
    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), "html")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Weights(counts)
        for part in batches_of(batches, "html", SCAN_BYTES):
            texts = [main_text(Page(source.as_py() or ""), own) for source in part.column(2)]
            sizes = pa.array([len(t) for t in texts], pa.int64())
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(texts, pa.string()), sizes], RESULT.names)

    return rows.mapInArrow(run, RESULT)
