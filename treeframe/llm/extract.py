"""Main text of web pages: flat text blocks, judged by a decision tree.

A page is cut into blocks of text at block-level tags. Each block is described
by its words and link density, those of its neighbours, and where it stands: in
an element that is named as boilerplate (navigation, advert, comments and so
on), in an article or main element, outside such an element although the page
has one, and as a heading. A decision tree, grown on the blocks of a few labelled pages below, keeps
or drops each block.

A page is one row and one function call, so no page's size or frequency touches
another's task. Tags are found by expressions that never go back (their repetitions
are possessive) and end with the page at the latest, and open elements are counted by name, so
a page takes time in proportion to its length, however broken it is.

Defined results: a null or empty page, and one without any kept block, gives an
empty text. Comments, scripts, styles, textareas and tags that are not closed end with
the page. Other embedded elements (drawings, frames, lists of options and so on)
have no text here: a self-closed one is empty, a closed one ends with its own
closing tag, and one that is not closed ends before the next block-level tag;
a closing tag without an opening one is passed over. Character references are
decoded once; ASCII white space inside a block is one space; blocks are
joined in page order by one newline. Rows that repeat an id are rows of their
own; further columns stay unread.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from treeframe.llm.rows import map_batches, text_of

_RAW = "script|style|textarea"
TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<({_RAW})\b.*?(?:</\1\s*+>|\Z)|<[!?][^>]*+(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"<]*+\"|'[^'<]*+'|[\"'])*+)(?:>|\Z)",
    re.S | re.I,
)
SPACE = re.compile(r"[\x20\x09-\x0D]+")
NAMED = re.compile(r"(?:class|id|role|aria-label)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")

# Elements that begin and end a block, and what their names say.
BLOCKS = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt "
    "fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html "
    "label legend li main menu nav ol option p pre section summary table tbody td tfoot th thead "
    "title tr ul".split()
)
EMBEDDED = frozenset("noscript template svg math iframe object canvas select".split())
HEADINGS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))
MAIN = frozenset(("article", "main"))
BOILERPLATE = frozenset(
    "nav aside footer form menu dialog button label fieldset head title header".split()
)
BAD_NAMES = frozenset(
    "ad ads adv advert advertisement advertising advertorial alert author banner bio breadcrumb "
    "breadcrumbs comment comments complementary consent contentinfo cookie cookies copyright "
    "disclaimer discussion disqus feedback footer form gdpr header legal login masthead menu "
    "menubar modal nav navbar navigation newsletter notice notification overlay pager pagination "
    "popup promo promotion recommended related replies reply respond responses search share "
    "sharing sidebar signup skip social sponsor sponsored subscribe subscription tags toolbar "
    "topbar trending widget".split()
)
# Name parts that say whether a page has something, not what the element is.
HAVING = frozenset("has with no without".split())
GOOD_NAMES = frozenset("article content entry main post story".split())
# What a paragraph or list item closes when it begins.
CLOSES = {
    "p": frozenset(("p",)), "li": frozenset(("p", "li")), "dt": frozenset(("p", "dt", "dd")),
    "dd": frozenset(("p", "dt", "dd")), "tr": frozenset(("p", "td", "th", "tr")),
    "td": frozenset(("p", "td", "th")), "th": frozenset(("p", "td", "th")),
    "option": frozenset(("option",)),
}
VOID = frozenset(("hr",))


# Tag, boilerplate, main part, boilerplate by a tag, in an article.
Standing = tuple[str, bool, bool, bool, bool]


def _embedded(page: str, tokens: list[re.Match]) -> dict[int, tuple[int, int]]:
    """For each embedded element, by its opening token: its last token, and where it ends."""
    names = [(t.group(3) or "").lower() for t in tokens]
    ends: dict[int, tuple[int, int]] = {}
    opened: dict[str, list[int]] = {}
    for i, (tag, token) in enumerate(zip(names, tokens)):
        if tag not in EMBEDDED:
            continue
        if token.group(2):
            if opened.get(tag):
                ends[opened[tag].pop()] = (i, token.end())
            continue
        # A slash may also belong to an address without quotes.
        follows = i + 1 < len(tokens) and names[i + 1] == tag and tokens[i + 1].group(2)
        if token.group(4).endswith("/") and not follows:
            ends[i] = (i, token.end())
        else:
            opened.setdefault(tag, []).append(i)
    unclosed = {i for own in opened.values() for i in own}
    block = (len(tokens), len(page))
    for i in range(len(tokens) - 1, -1, -1):
        if i in unclosed:
            ends[i] = (block[0] - 1, block[1])
        elif names[i] in BLOCKS and names[i] != "option":
            block = (i, tokens[i].start())
    return ends


def blocks_of(page: str) -> list[tuple]:
    """(text, words, words in links, boilerplate, main, heading) of each block in order."""
    out: list[tuple] = []
    stack: list[Standing] = [("", False, False, False, False)]
    pieces: list[str] = []
    linked, link_at, heading = 0, 0, False
    # How many elements of a name are open: most closing tags without an opening one
    # need no look at the stack.
    n_open: dict[str, int] = {}

    def close(depth: int) -> None:
        for standing in stack[depth:]:
            n_open[standing[0]] -= 1
        del stack[depth:]

    def flush() -> None:
        nonlocal linked, heading
        text = SPACE.sub(" ", "".join(pieces)).strip(" ")
        pieces.clear()
        if text:
            n = text.count(" ") + 1
            out.append((text, n, min(linked, n), stack[-1][1], stack[-1][2], heading))
        linked, heading = 0, False

    def take(text: str) -> None:
        nonlocal linked
        if text:
            text = html.unescape(text)
            pieces.append(text)
            if link_at:
                linked += len(text.split())

    at, last = 0, -1
    tokens = list(TOKEN.finditer(page))
    embedded = _embedded(page, tokens)
    for i, token in enumerate(tokens):
        if i <= last:
            continue
        take(page[at : token.start()])
        at = token.end()
        if i in embedded:
            last, at = embedded[i]
            continue
        tag = (token.group(3) or "").lower()
        closing = bool(token.group(2))
        if tag == "a":
            link_at = 0 if closing else len(stack)
        elif tag == "br":
            pieces.append(" ")
        elif tag in BLOCKS:
            flush()
            if closing:
                depth = len(stack) - 1
                while n_open.get(tag) and stack[depth][0] != tag:
                    depth -= 1
                if n_open.get(tag):
                    close(depth)
            else:
                while stack[-1][0] in CLOSES.get(tag, ()):
                    close(len(stack) - 1)
                if tag not in VOID:
                    stack.append((tag, *_standing(tag, token.group(4), stack[-1])))
                    n_open[tag] = n_open.get(tag, 0) + 1
                heading = tag in HEADINGS
            if len(stack) < link_at:
                link_at = 0
    take(page[at:])
    flush()
    return out


def _names(attributes: str) -> set[str]:
    """Parts of the names in attributes, without those that follow one of ``HAVING``."""
    names: set[str] = set()
    for found in NAMED.finditer(attributes or ""):
        for name in (found[1] or found[2] or found[3] or "").split():
            for part in PARTS.findall(name):
                if part.lower() in HAVING:
                    break
                names.add(part.lower())
    return names


def _standing(tag: str, attributes: str, parent: Standing) -> tuple[bool, bool, bool, bool]:
    """Whether what is in an element is boilerplate, whether it is in the main part, whether
    it is boilerplate by an element's tag, and whether it is in an article.

    A main element, and an article that is in no other one, ends a mark that names
    around it have set, unless it is named so itself.
    """
    _, bad, main, by_tag, in_article = parent
    names = _names(attributes)
    named_bad = bool(names & BAD_NAMES)
    if tag in MAIN and not named_bad and not in_article:
        bad = by_tag
    if tag in ("html", "body", *MAIN) or tag == "header" and main:
        named_bad = False
    if tag in BOILERPLATE and not (tag == "header" and main):
        by_tag = True
    return (
        bad or by_tag or named_bad,
        main or tag in MAIN or "main" in names or bool(names & GOOD_NAMES and not named_bad),
        by_tag, in_article or tag == "article",
    )


FEATURES = (
    "words", "links", "words_before", "links_before", "words_after", "links_after",
    "boilerplate", "main", "outside", "heading",
)


def features_of(blocks: list[tuple]) -> list[tuple]:
    """``FEATURES`` of each block; link densities are shares of words."""
    has_main = any(b[4] and not b[3] for b in blocks)
    own = [(n, links / n) for _, n, links, *_ in blocks]
    around = [(0, 0.0), *own, (0, 0.0)]
    return [
        (*own[i], *around[i], *around[i + 2], b[3], b[4], has_main and not b[4], b[5])
        for i, b in enumerate(blocks)
    ]


# Labelled pages: text that is kept begins with a star.
_LONG = "word " * 40
_MID = "some words of a sentence that goes on for a while and then ends here "
LABELLED = tuple(
    page.replace("LONG", _LONG).replace("MID", _MID)
    for page in (
        """<head><title>A title</title></head><body><nav><ul><li><a href=x>Home</a></li><li><a
        href=y>News</a></li></ul></nav><div class="ad">Buy this now.</div><article><h1>*Headline of
        it</h1><p>*LONG</p><p>*Short one.</p><p>*MID</p></article><footer>All about us.</footer>""",
        """<body><header><h1>Site name</h1><a href=a>Log in</a></header><main><h2>*Part one</h2>
        <p>*MID</p><ul><li>*First item</li><li>*Second <a href=b>item</a></li></ul><p>*LONG</p>
        <aside><p>MID</p></aside><div class="share"><a href=c>Share</a></div></main>
        <div class="sidebar"><p>LONG</p></div><footer><p>MID</p></footer>""",
        """<body><div id="menu"><a href=a>One</a> <a href=b>Two</a></div><div id="content"><h1>*A
        page</h1><p>*LONG</p><p>*MID</p><p>*End.</p></div><div id="comments"><p>LONG</p><p>Nice.</p>
        </div><div class="cookie-notice">MID</div>""",
        """<body><p><a href=a>Home</a> | <a href=b>Site map</a></p><h1>*Plain page</h1><p>*LONG</p>
        <p>*MID</p><p>*LONG</p><p><a href=c>Back</a></p><p>Page 3</p>""",
        """<body><table><tr><td><a href=a>All</a><td><a href=b>New</a></table><p>*MID</p><p>*LONG
        <a href=d>with a link</a> MID</p><p>*MID</p><form><label>Name</label><p>LONG</p></form>
        <p><a href=c>Terms</a> <a href=c>Privacy</a></p>""",
        """<body><div>Welcome</div><div><a href=a>Start</a></div><div>*LONG</div><div>*MID</div>
        <div>*LONG</div><div><a href=a>More of this</a></div><div>Copyright 2001</div>""",
        """<body><article><header><h1>*Title here</h1></header><p>*MID</p><blockquote>*Quoted
        words</blockquote><section class="related"><p>MID</p><a href=x>Next story to read</a>
        </section><p>*MID</p><div class="comments"><p>LONG</p></div></article><p>MID</p>""",
        """<body><nav><a href=a>Home</a></nav><article><h1>*Word</h1><p>*Yes.</p><p>*LONG</p><p>*No.
        </p><p>*So it ends.</p></article>""",
        """<body><p>MID</p><article><p>*MID</p><p>*One</p><p>*<a href=a>Linked heading of it</a></p>
        <p>*Last</p></article><p>LONG</p><p>Right.</p><p>MID</p>""",
        """<body><div>LONG</div><main><h1>*Top</h1><p>*MID</p><p>*<a href=s>Source</a></p></main>
        <p>MID</p>""",
        """<body><p>*MID</p><p>*LONG</p><p>*MID</p><p><a href=a>All of the news that we have for you
        today</a> <a href=b>and more of it in the archive</a></p>""",
        """<body><div><a href=a>Some longer link text of this site for all</a> and <a href=b>another
        one of about the same length</a></div><p>*LONG</p><p>*MID with <a href=a>a link</a></p>""",
        """<body><h1>*Single</h1><p>*LONG</p>""",
        """<body><div class="content has-sidebar"><article><header class="entry-header"><h1>*Name of
        it</h1></header><p>*MID</p><p>*LONG</p></article></div><div class="sidebar"><p>MID</p></div>
        """,
        """<body><div class="social-layout search"><p>MID</p><article><h1>*Its name</h1><p>*MID</p>
        <div class="share"><p>MID</p></div><p>*LONG</p></article><p>LONG</p></div>""",
    )
)

Node = tuple  # (feature, limit, node if at most, node if more) or (keep,)


def grow_tree(x: np.ndarray, y: np.ndarray, depth: int = 6) -> Node:
    """A decision tree that splits where the Gini impurity falls most; the first of ties."""
    if depth == 0 or y.all() or not y.any():
        return (bool(y.mean() >= 0.5),)
    best = (2 * len(y) * y.mean() * (1 - y.mean()) - 1e-9, None, None)
    for feature in range(x.shape[1]):
        values = np.unique(x[:, feature])
        for limit in (values[1:] + values[:-1]) / 2:
            low = x[:, feature] <= limit
            cost = sum(2 * len(s) * s.mean() * (1 - s.mean()) for s in (y[low], y[~low]))
            if cost < best[0]:
                best = (cost, feature, float(limit))
    _, feature, limit = best
    if feature is None:
        return (bool(y.mean() >= 0.5),)
    low = x[:, feature] <= limit
    return (feature, limit, grow_tree(x[low], y[low], depth - 1),
            grow_tree(x[~low], y[~low], depth - 1))


def train(pages: tuple[str, ...] = LABELLED) -> Node:
    """The tree of labelled pages."""
    rows, keep = [], []
    for page in pages:
        blocks = blocks_of(page)
        rows += features_of(blocks)
        keep += [b[0].startswith("*") for b in blocks]
    # Where a block stands comes first, so that it is preferred among equal splits.
    return grow_tree(np.array(rows, float)[:, _ORDER], np.array(keep))


_ORDER = [6, 8, 7, 9, 1, 3, 5, 0, 2, 4]


def main_text(page: str, tree: Node) -> str:
    blocks = blocks_of(page)
    kept = []
    for block, row in zip(blocks, features_of(blocks)):
        node = tree
        while len(node) > 1:
            node = node[2] if row[_ORDER[node[0]]] <= node[1] else node[3]
        if node[0]:
            kept.append(block[0])
    return "\n".join(kept)


def extract_text(
    pages: DataFrame, id: str = "page_id", url: str = "url", page: str = "html",
    labelled: tuple[str, ...] = LABELLED,
) -> DataFrame:
    """Per row: page_id, url, text."""
    tree = train(labelled)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(value.as_py(), tree) for value in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string())],
                ["page_id", "url", "text"],
            )

    rows = pages.select(
        F.col(id).cast("bigint").alias("page_id"), F.col(url).cast("string").alias("url"),
        text_of(page).alias("html"),
    )
    return map_batches(rows, run, "page_id bigint, url string, text string")
