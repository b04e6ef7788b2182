"""Main text of web pages: flat text blocks classified by a decision tree.

A page is cut into blocks at block-level tags, without building a document tree.
A block is described by its words and link density, those of the blocks before and
after it and of the element it is a part of, by its place, and by what it stands in:
an article, a heading, or an element that by its tag, role or class is menu, header,
footer, sidebar, notice, advert, form or comments. A decision tree fitted on the small
labelled pages below, half of them without an article element, decides which blocks
are main text.

Pages are handled one by one where they are read; nothing is shuffled.
"""

from __future__ import annotations

import html
import random
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import ship_package

# A comment, a declaration, or a tag. A quote opens a value only right after "="; one
# that is never closed is a letter of an unquoted value, and so is any quote inside one.
_VALUE = r"\"[^\"]*\"|'[^']*'|[^\s>]++"
_MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|</[^A-Za-z][^>]*(?:>|\Z)"
    rf"|<(/?)([A-Za-z][^\s/>]*+)((?:[\s/]++|[^\s/>][^\s/>=]*+(?:\s*+=\s*+(?:{_VALUE})?)?)*+)(?:>|\Z)",
    re.S,
)
_ATTRIBUTE = re.compile(rf"([^\s/>][^\s/>=]*+)(?:\s*+=\s*+({_VALUE})?)?")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
_NAME_PART = re.compile(r"[^\W_]+")
_RAW = {"script", "style", "textarea", "title", "iframe", "noembed", "noframes", "xmp"}
_RAW_END = {tag: re.compile(rf"</{tag}(?=[\s/>])", re.I) for tag in _RAW}
_UNSEEN = {"head", "template", "noscript", "svg", "math", "select", "option", "button", "datalist", "object", "canvas", "audio", "video"}
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
_BLOCK = set(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre search section summary table tbody td tfoot th thead tr ul".split()
)
_ASIDE_TAGS = {"nav", "footer", "aside", "menu", "dialog"}
_ASIDE_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alertdialog", "alert", "menu", "menubar"}
_IMPLIED = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "td": {"td", "th"}, "th": {"td", "th"}, "tr": {"tr", "td", "th"}}
_LEAVES = {"p", "h1", "h2", "h3", "h4", "h5", "h6", "li", "dt", "dd", "td", "th", "pre", "figcaption", "caption", "summary"}
# A class or id names something beside the article when all its parts are known and
# one of them is strong ("cookie-notice", not "hidden-gems") ...
_STRONG = set(
    "ad ads adv advert adverts advertisement sponsor sponsored promo promotion comment comments commentlist disqus reply replies respond "
    "cookie cookies consent gdpr notice newsletter subscribe subscription share sharing social related recommended breadcrumb breadcrumbs "
    "pagination pager login signin signup popup modal overlay copyright disclaimer footer footnav skip hidden".split()
)
# ... or, on an element around the article, weak ...
_WEAK = {"sidebar", "header", "menu", "nav", "navbar", "navigation", "widget", "widgets", "toolbar", "banner", "search", "masthead"}
# ... and these say nothing.
_PLAIN = set(
    "area bar block body bottom box buttons col column container content footer form inner item items left link links list main media "
    "page panel post posts right row section site slot text thread title top unit view wrap wrapper".split()
)

FEATURES = (
    "words", "links", "words_before", "links_before", "words_after", "links_after",
    "parent_words", "parent_links", "position", "aside", "article", "heading",
)


@dataclass
class Block:
    text: str
    words: int
    links: float  # share of words inside links
    aside: int  # 0 no, 1 by a weak name around it, 2 by tag, role or strong name
    article: bool
    heading: bool
    marked: bool  # in the labelled pages: main text
    parent: int  # number of the element whose parts this block is one of
    form: int  # number of the form it stands in, 0 for none


@dataclass
class _Open:
    tag: str
    number: int
    parent: int
    form: int
    unseen: bool
    strong: bool
    weak: bool
    article: bool
    heading: bool
    marked: bool


def blocks(page: str) -> list[Block]:
    """Text blocks of a page in order, character references decoded, runs of white
    space made one space. Unclosed and stray tags are tolerated; a tag that is cut
    off at the end of the page is markup. The time is linear in the page: an end tag
    looks for its element only where one is open."""
    out: list[Block] = []
    stack = [_Open("", 0, 0, 0, False, False, False, False, False, False)]
    standing: Counter[str] = Counter()
    parts: list[str] = []
    words = linked = in_link = opened = 0

    def close() -> None:
        nonlocal words, linked
        if parts:
            here = stack[-1]
            text = " ".join("".join(parts).split())
            if text:
                aside = 2 if here.strong else int(here.weak)
                links = min(1.0, linked / max(1, words))
                out.append(Block(text, text.count(" ") + 1, links, aside, here.article, here.heading, here.marked, here.parent, here.form))
            parts.clear()
        words = linked = 0

    def add(start: int, end: int) -> None:
        nonlocal words, linked
        if start < end and not stack[-1].unseen:
            piece = page[start:end]
            piece = html.unescape(piece) if "&" in piece else piece
            parts.append(piece)
            n = len(piece.split())
            words += n
            linked += n if in_link else 0

    def pop() -> str:
        tag = stack.pop().tag
        standing[tag] -= 1
        return tag

    position = 0
    while match := _MARKUP.search(page, position):
        add(position, match.start())
        position = match.end()
        if match[2] is None:
            continue
        tag, closing = match[2].lower(), match[1] == "/"
        if tag == "br" and not stack[-1].unseen:
            parts.append(" ")
        if tag == "a":
            in_link = 0 if closing else 1
        if tag in _BLOCK:
            close()
            in_link = 0
        if closing:
            while standing[tag] > 0 and pop() != tag:
                pass
            continue
        if tag in _RAW:
            end = _RAW_END[tag].search(page, position)
            position = end.start() if end else len(page)
            continue
        if tag in _VOID or match[3].endswith("/") and tag not in _BLOCK:
            continue
        if tag in _BLOCK or tag in _UNSEEN:
            if tag in _BLOCK and stack[-1].tag in ("p", "h1", "h2", "h3", "h4", "h5", "h6"):
                pop()  # a block ends an open paragraph or heading
            while stack[-1].tag in _IMPLIED.get(tag, ()):
                pop()
            if tag == "body":
                del stack[1:]  # a head left open does not hide the page
                standing.clear()
            opened += 1
            stack.append(_opened(tag, match[3], stack[-1], opened))
            standing[tag] += 1
    add(position, len(page))
    close()
    return out


def _named(found: dict[str, str], known: set[str]) -> bool:
    """Whether a class or the id is made of known words, one of them of ``known``."""
    for name in f"{found.get('class', '')} {found.get('id', '')}".split():
        parts = set(_NAME_PART.findall(_CAMEL.sub("-", name).lower()))
        if parts & known and parts <= _STRONG | _WEAK | _PLAIN:
            return True
    return False


def _opened(tag: str, attributes: str, above: _Open, number: int) -> _Open:
    strong = weak = unseen = marked = False
    if attributes.strip(" /"):
        found: dict[str, str] = {}
        for name, value in _ATTRIBUTE.findall(attributes):
            quoted = len(value) > 1 and value[0] in "\"'" and value[0] == value[-1]
            found.setdefault(name.lower(), value[1:-1] if quoted else value)
        if tag not in ("html", "body", "main"):
            strong = _named(found, _STRONG) or found.get("role", "").lower() in _ASIDE_ROLES
            weak = _named(found, _WEAK)
        style = "".join(found.get("style", "").lower().split())
        unseen = "hidden" in found or "display:none" in style or found.get("aria-hidden", "").lower() == "true"
        marked = "data-main" in found
    starts = tag in ("article", "main")
    around = above.weak and not (starts and not weak)  # what is named around the article does not name the article
    return _Open(
        tag,
        number,
        above.number if tag in _LEAVES else number,
        number if tag == "form" else above.form,
        above.unseen or unseen or tag in _UNSEEN,
        above.strong or strong or tag in _ASIDE_TAGS,
        around or ((weak or tag == "header") and not above.article),
        above.article or starts,
        tag in ("h1", "h2", "h3", "h4", "h5", "h6"),
        above.marked or marked,
    )


def describe(found: list[Block]) -> np.ndarray:
    """(blocks, features); outside the page stand empty blocks. A form that holds less
    than half of the page's words is something beside the text, another is the page."""
    n = len(found)
    own = np.array([(b.words, b.links) for b in found], dtype=float).reshape(-1, 2)
    edge = np.zeros((1, 2))
    inside: Counter[int] = Counter()
    linked: Counter[int] = Counter()
    forms: Counter[int] = Counter()
    for b in found:
        inside[b.parent] += b.words
        linked[b.parent] += b.words * b.links
        forms[b.form] += b.words
    half = own[:, 0].sum() / 2
    rest = [
        (inside[b.parent], linked[b.parent] / inside[b.parent], i / n, 2 if b.form and forms[b.form] < half else b.aside, b.article, b.heading)
        for i, b in enumerate(found)
    ]
    flags = np.array(rest, dtype=float).reshape(-1, 6)
    return np.hstack([own, np.vstack([edge, own[:-1]])[:n], np.vstack([own[1:], edge])[:n], flags])


def fit(spark: SparkSession, pages: list[str] | None = None, depth: int = 8) -> Tree:
    """The decision tree of labelled pages: blocks in elements with ``data-main`` are
    main text."""
    rows = []
    for page in LABELLED + labelled_pages() if pages is None else pages:
        found = blocks(page)
        rows += [(features.tolist(), float(b.marked)) for features, b in zip(describe(found), found)]
    table = spark.createDataFrame(rows, "f array<double>, label double").select(array_to_vector("f").alias("features"), "label")
    model = DecisionTreeClassifier(maxDepth=depth, minInstancesPerNode=2, seed=1).fit(table.coalesce(1))
    return _tree(model._call_java("rootNode"))


def _tree(node) -> Tree:
    if node.subtreeDepth() == 0:
        return (node.prediction() == 1.0,)
    split = node.split()
    return split.featureIndex(), split.threshold(), _tree(node.leftChild()), _tree(node.rightChild())


def decide(tree: Tree, features: np.ndarray) -> bool:
    while len(tree) > 1:
        tree = tree[2] if features[tree[0]] <= tree[1] else tree[3]
    return tree[0]


def main_text(page: str | None, tree: Tree) -> str:
    found = blocks(page or "")
    return "\n".join(b.text for b, f in zip(found, describe(found)) if decide(tree, f))


def extract(pages: DataFrame, keep: tuple[str, ...] = ("page_id", "url"), source: str = "html") -> DataFrame:
    """The ``keep`` columns, ``text`` and ``n_chars`` (code points) of every page.

    A null or empty page, or one without main text, has an empty text. Whole pages
    are read, however long; repeated rows stay repeated; null keys are kept. Other
    columns are not read; ``text`` and ``n_chars`` are refused in ``keep``.
    """
    if {"text", "n_chars"} & set(keep):
        raise ValueError("Columns text and n_chars are made here.")
    ship_package(pages.sparkSession)
    tree = fit(pages.sparkSession)
    picked = pages.select(*keep, F.col(source).alias("__html"))
    schema = T.StructType([*picked.schema.fields[:-1], *T.StructType.fromDDL("text string, n_chars long").fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                texts = [main_text(page.as_py(), tree) for page in part.column(len(keep))]
                columns = [part.column(i) for i in range(len(keep))]
                columns += [pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return picked.mapInArrow(run, schema)


def _paragraph(words: int, seed: str) -> str:
    return " ".join(f"{seed}{i % 7}" for i in range(words)) + "."


def _menu(n: int, seed: str) -> str:
    return "<ul>" + "".join(f'<li><a href="/{i}">{seed} {i}</a></li>' for i in range(n)) + "</ul>"


# The labelled table: pages written for the purpose, main text marked.
LABELLED = [
    # an article element with titles, long and very short paragraphs, lists and links
    f"<body><nav>{_menu(6, 'Go')}</nav><article data-main><h1>Title of the day</h1><p>{_paragraph(60, 'lo')}</p><p>So.</p>"
    f"<h2>Then</h2><p>{_paragraph(25, 'mi')}</p><p><b>Why now?</b></p><ul><li>One</li><li>Two things</li></ul><p>{_paragraph(9, 'na')}</p></article>"
    f"<footer>&copy; 2020 Some House, all rights are with the authors of the pages</footer></body>",
    f"<body><div class='ad'>Buy one of these now and get the second for nothing at all</div><main data-main><h1>A</h1><p>Short.</p>"
    f"<p>{_paragraph(14, 'ra')}</p><p>See <a href='/x'>this</a>.</p></main><aside><h3>More</h3><p>{_paragraph(30, 'si')}</p></aside></body>",
    f"<body><header><h1>Name of the site</h1><p>{_paragraph(12, 'sub')}</p></header><article data-main><h2>Report</h2><p><a href='/a'>Source</a></p>"
    f"<p>{_paragraph(45, 'to')}</p><blockquote>{_paragraph(18, 'qu')}</blockquote><p>End.</p></article>"
    f"<section class='comments'><h3>Comments</h3><p>{_paragraph(40, 'co')}</p><p>Me too</p><p>{_paragraph(22, 'ce')}</p></section></body>",
    # an article with something else inside it
    f"<body><article><div data-main><h1>Inside</h1><p>{_paragraph(30, 'pa')}</p></div><div class='ad'>{_paragraph(14, 'buy')}</div>"
    f"<div data-main><p>{_paragraph(8, 'pe')}</p><p>Yes.</p></div><div class='share'><a href='/s'>Share</a> <a href='/t'>Tell</a></div>"
    f"<aside><p>{_paragraph(35, 'box')}</p></aside><div data-main><p>{_paragraph(50, 'po')}</p></div><form><p>Your name please</p></form></article></body>",
    f"<body><div class='cookie-notice'><p>{_paragraph(28, 'we')}</p></div><article data-main><h1>Plain</h1><p>{_paragraph(5, 'di')}</p><p>{_paragraph(70, 'da')}</p>"
    f"<table><tr><td>Cell</td><td>12</td></tr></table></article><div id='footer'><p>{_paragraph(16, 'foot')}</p></div></body>",
    # no article element: words and links decide
    f"<body><div>{_menu(8, 'Topic')}</div><div data-main><h1>Headline of a page of divisions</h1><p>{_paragraph(55, 'va')}</p><p>{_paragraph(38, 've')}</p>"
    f"<p>{_paragraph(20, 'vi')}</p></div><div>{_menu(5, 'Other story')}</div><div><a href='/i'>Imprint</a> <a href='/p'>Privacy</a></div></body>",
    f"<body><div><a href='/'>Home</a> <a href='/n'>News</a></div><div data-main><p>{_paragraph(33, 'ka')}</p><p>{_paragraph(12, 'ke')}</p><p>{_paragraph(48, 'ki')}</p></div>"
    f"<div><p><a href='/m'>{_paragraph(7, 'more')}</a></p><p><a href='/l'>{_paragraph(9, 'last')}</a></p></div><div>Page 3</div></body>",
    f"<body><div class='sidebar'><h4>About</h4><p>{_paragraph(26, 'ab')}</p></div><div data-main><h2>Second thoughts on the matter</h2><p>{_paragraph(64, 'za')}</p>"
    f"<p>{_paragraph(31, 'ze')}</p></div><form><p>{_paragraph(11, 'ask')}</p></form><div>Printed 12:30</div></body>",
]


def labelled_pages(count: int = 240, seed: int = 1) -> list[str]:
    """More labelled pages, of random parts: with and without an article element, in a
    form around the page, paragraphs straight in the body, link lists in between."""
    rng = random.Random(seed)

    def text(low: int, high: int) -> str:
        return _paragraph(rng.randint(low, high), rng.choice(("la", "be", "ri", "so")))

    def links(low: int, high: int) -> str:
        return "".join(f"<li><a href=/{i}>{text(1, 6)}</a></li>" for i in range(rng.randint(low, high)))

    def prose(mark: str) -> str:
        out = [f"<h1{mark}>{text(2, 9)}</h1>"] if rng.random() < 0.7 else []
        for i in range(rng.randint(1, 7)):
            body = text(20, 90) if i == 0 or rng.random() < 0.6 else text(1, 19)
            if rng.random() < 0.2:
                body = f"{body} <a href=/x>{text(1, 4)}</a> {text(4, 20)}"
            out.append(f"<p{mark}>{body}</p>")
            if rng.random() < 0.12:
                out.append(f"<h2{mark}>{text(1, 6)}</h2><p{mark}>{text(15, 60)}</p>")
            if rng.random() < 0.12:
                out.append(f"<ul{mark}>" + "".join(f"<li>{text(2, 9)}</li>" for _ in range(rng.randint(3, 6))) + f"</ul><p{mark}>{text(20, 50)}</p>")
            if mark and rng.random() < 0.1:
                out.append(f"<p{mark}><a href=/s>{text(1, 3)}</a></p><p{mark}>{text(20, 50)}</p>")
        return "".join(out)

    def beside(named: bool) -> str:
        kind = rng.randrange(6)
        if kind == 0 or not named and kind > 3:
            return f"<div><h3>{text(1, 4)}</h3><ul>{links(3, 8)}</ul></div>"
        if kind == 1:
            return f"<h3>{text(1, 4)}</h3><ul>{links(3, 9)}</ul>"
        if kind == 2:
            return "".join(f"<p><a href=/t>{text(4, 14)}</a></p>" for _ in range(rng.randint(2, 5)))
        if kind == 3:
            return f"<form><p>{text(2, 12)}</p><label>{text(1, 3)}</label></form>"
        name = rng.choice(("ad", "cookie-notice", "comments", "related-posts", "newsletter", "share-links"))
        return f"<div class='{name}'><p>{text(3, 45)}</p><p>{text(1, 12)}</p></div>"

    pages = []
    for i in range(count):
        top = rng.choice((f"<ul>{links(3, 9)}</ul>", f"<nav><ul>{links(3, 9)}</ul></nav>", f"<div><a href=/>{text(1, 2)}</a> <a href=/n>{text(1, 2)}</a></div>", ""))
        if i % 2:
            inner = prose(" data-main")
            if rng.random() < 0.4:  # something beside the text in the article
                inner += rng.choice((f"<ul>{links(3, 8)}</ul>", f"<div class='ad'><p>{text(3, 30)}</p></div>", f"<aside><p>{text(5, 50)}</p></aside>")) + prose(" data-main")
            main = f"<article class='{rng.choice(('', 'social-science', 'entry'))}'>{inner}</article>"
        else:
            mark = " data-main"
            main = rng.choice((f"<div>{prose(mark)}</div>", prose(mark), f"<div data-main>{prose('')}</div>"))
        under = rng.choice((f"<div>{text(2, 9)}</div>", f"<footer>{text(3, 20)}</footer>", f"<div id=footer><p>{text(4, 30)}</p></div>", "", ""))
        page = top + (beside(True) if rng.random() < 0.4 else "") + main + (beside(True) if rng.random() < 0.5 else "") + under
        pages.append(f"<body><form>{page}</form></body>" if rng.random() < 0.15 else f"<body>{page}</body>")
    return pages
