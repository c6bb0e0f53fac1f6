"""Main text of web pages by two passes of block rules.

A page is read into blocks of text with what stands around them.  Pass one decides a block that its surroundings or its
stop-word and link densities decide, and leaves short ones open.  Pass two gives each open block the label of its
nearest decided neighbours within the same part of the page; a part that is marked up as the article keeps what its
neighbours do not settle, any other part drops it.

A class or id such as "sidebar" drops an element only where its own text agrees: names that stand on most of a page's prose
("layout has-sidebar") belong to a wrapper.
"""

from __future__ import annotations

import html
import re
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import batches_of, pick

LONG_CHARS = 80  # a block below this is short
LINK_SHARE = 0.4  # of a block's characters in links: above it the block is a menu
STOP_SHARE = 0.2  # of a block's words that are stop words: at or above it the block is prose

# Elements by what they are, and frequent words of four languages.
RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes template".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong "
    "sub sup time tt u var wbr img br nobr ruby rt rp".split()
)
DROPPED = frozenset("nav footer aside form menu dialog select button fieldset svg canvas object audio video map head".split())
FOREIGN = frozenset("svg math".split())
PARTS = frozenset("article main".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
FLOW = frozenset("p ul ol li dl dt dd blockquote pre h1 h2 h3 h4 h5 h6".split())
MARKS = frozenset(
    "ad ads advert advertisement advertising adbox banner sponsor sponsored promo promotion nav navbar navigation menu "
    "breadcrumb breadcrumbs sidebar footer comment comments disqus replies reply cookie cookies consent gdpr notice "
    "popup modal overlay newsletter subscribe subscription signup login share sharing social related recommended "
    "widget toolbar pagination pager masthead skip copyright legal outbrain taboola".split()
)
REPLIES = frozenset("comment comments disqus replies reply".split())  # may hold more prose than the article
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar toolbar form".split())
STOP_WORDS = frozenset(
    "the of and to a in is it that for on with as are was be this by at from or an not have which "
    "der die das und in den von zu mit ist im für auf dem des ein eine nicht als auch sich es bei aus "
    "de la le et les des en un une du que est pour dans qui sur par au avec pas plus ne ce il "
    "el los las y del que se por con una para su al lo como más o pero sus".split()
)

_TOKEN = re.compile(
    r"<!--(?:>|->|.*?(?:--!?>|\Z))"  # comment
    r"|<[!?][^>]*(?:>|\Z)"  # declaration
    r"|<(/?)([A-Za-z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)(>|\Z)"  # tag; the page's end may cut it
    r"|<(/?)([A-Za-z][^\s/>]*)([^>]*)(>|\Z)",  # tag with a stray quote
    re.S,
)
_ATTRIBUTE = re.compile(r"([^\s\"'>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_MARK = re.compile(r"[a-z]+")
_WORD = re.compile(r"[^\W\d_]+")
_SPACE = re.compile(r"\s+")
_SENTENCE_END = re.compile(r"[.!?\u2026\u061f\u06d4\u0964](?=[\s\"'\u00bb\u201d\u2019)\]]|\Z)|[\u3002\uff01\uff1f]")
_UNSPACED = re.compile(r"[\u0e01-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u9fff\uf900-\ufaff\U00020000-\U000323af]")


def attributes_of(text: str) -> list[tuple[str, str]]:
    """(name, value) of a tag's attributes, read one after the other, in lower case."""
    return [(key.lower(), "".join(values).lower()) for key, *values in _ATTRIBUTE.findall(text)] if text else []


def _dropped(name: str, attributes: list[tuple[str, str]], in_part: bool) -> bool:
    """Whether an element's name or attributes say that it holds no article text."""
    if name in DROPPED or (name == "header" and not in_part):
        return True
    for key, value in attributes:
        if key in ("class", "id") and name in PARTS and not MARKS.isdisjoint(_MARK.findall(value)) and "comment" in value:
            return True
        if (key == "role" and value.strip() in ROLES) or key == "hidden" or (key == "aria-hidden" and value == "true"):
            return True
        if key == "style" and "display:none" in value.replace(" ", ""):
            return True
    return False


def _marks(name: str, attributes: list[tuple[str, str]]) -> frozenset[str]:
    """The names in an element's class and id that tell of something else than the article."""
    if not attributes or name in ("body", "html", *PARTS):
        return frozenset()
    return MARKS.intersection(w for key, value in attributes if key in ("class", "id") for w in _MARK.findall(value))


@dataclass(eq=False)
class Mark:
    """A marked element: its names, and the marked element around it.  Its number follows that one's."""

    names: frozenset[str]
    around: Mark | None
    number: int


def outwards(mark: Mark | None, seen: set[Mark]):
    """The marked elements from ``mark`` outwards that are not in ``seen``, which takes them up."""
    while mark and mark not in seen:
        seen.add(mark)
        yield mark
        mark = mark.around


@dataclass
class Around:
    """An open block element, with what holds for the blocks in it."""

    name: str = ""
    dropped: bool = False
    part: int = 0
    box: int = 0
    mark: Mark | None = None
    main: bool = False


@dataclass
class Block:
    text: str
    linked: int  # characters inside links
    part: int  # 0 outside article and main elements, else the number of the innermost
    box: int  # number of the innermost element that is no paragraph, heading or list
    dropped: bool
    mark: Mark | None = None  # the innermost marked element around
    main: bool = False  # inside a main element
    element: str = ""  # the innermost element


OUTSIDE = Around()


def blocks_of(page: str) -> list[Block]:
    """Blocks of text in page order.  White space is squeezed; ``br`` counts as white space."""
    blocks: list[Block] = []
    pieces: list[str] = []
    link_pieces: list[str] = []
    open_: list[Around] = []  # block elements around
    counts: dict[str, int] = {}  # open elements by name
    links, n_parts, n_boxes, n_marks, at, size = 0, 0, 0, 0, 0, len(page)

    def add(text: str) -> None:
        if text:
            text = html.unescape(text)  # a reference ends where a tag begins
            pieces.append(text)
            if links:
                link_pieces.append(text)

    def close_block() -> None:
        text = _SPACE.sub(" ", "".join(pieces)).strip()
        if text:
            linked = len(_SPACE.sub(" ", "".join(link_pieces)).strip())
            e = open_[-1] if open_ else OUTSIDE
            blocks.append(Block(text, linked, e.part, e.box, e.dropped, e.mark, e.main, e.name))
        pieces.clear()
        link_pieces.clear()

    def leave() -> str:
        name = open_.pop().name
        counts[name] -= 1
        return name

    while at < size:
        m = _TOKEN.search(page, at)
        if m is None:
            add(page[at:])
            break
        add(page[at : m.start()])
        at = m.end()
        name = (m[2] or m[6] or "").lower()
        if not name:
            continue
        closing, attributes = m[1] or m[5], m[3] or m[7] or ""
        if not (m[4] or m[8]):
            continue  # cut by the page's end
        if name == "a":
            links = 0 if closing else 1
            continue
        if name in INLINE:
            if name == "br":
                pieces.append(" ")
            continue
        close_block()
        if closing:
            if counts.get(name):
                while leave() != name:
                    pass
            continue
        if name in RAW:
            end = re.compile(rf"</{re.escape(name)}[\s/>]", re.I).search(page, at)
            if end is None:
                break
            at = end.start()
            continue
        if name in VOID or (name in FOREIGN and attributes.endswith("/")):  # a slash at a tag's end closes nothing else
            continue
        links = 0
        if name == "p" or name in HEADINGS or name == "li":  # these end an open one of their kind
            while open_ and (open_[-1].name == "p" or open_[-1].name in HEADINGS or open_[-1].name == name == "li"):
                leave()
        around = open_[-1] if open_ else OUTSIDE
        if name in PARTS and not around.dropped:
            n_parts += 1
        part, box = n_parts if name in PARTS else around.part, around.box
        if name not in FLOW:
            n_boxes += 1
            box = n_boxes
        found = attributes_of(attributes)
        mark = around.mark
        if names := _marks(name, found):
            n_marks += 1
            mark = Mark(names, around.mark, n_marks)
        dropped = around.dropped or _dropped(name, found, around.part > 0)
        open_.append(Around(name, dropped, part, box, mark, around.main or (name == "main" and not dropped)))
        counts[name] = counts.get(name, 0) + 1
    close_block()
    return drop_marked(blocks)


def drop_marked(blocks: list[Block]) -> list[Block]:
    """Drops the blocks of marked elements, but for wrappers and what they hold.

    An element is a wrapper where it is the innermost marked one around more than half of the page's prose, or, on a page
    without prose, of the short text in article and main elements; where none is, elements of the same names count
    together.  One of reader comments is a wrapper only where no prose stands outside of it, or where it holds the h1.
    What is around a wrapper is one, too.
    """
    if not any(b.mark for b in blocks):
        return blocks
    free = [b for b in blocks if not b.dropped and b.linked <= LINK_SHARE * len(b.text)]
    counted = [b for b in free if first_pass(b)] or [b for b in free if b.part]
    total = sum(len(b.text) for b in counted)

    def most(key) -> set:
        sizes: dict = {}
        for b in counted:
            if b.mark and not b.mark.names & REPLIES:
                sizes[key(b.mark)] = sizes.get(key(b.mark), 0) + len(b.text)
        return {k for k, n in sizes.items() if 2 * n > total}

    wrappers = most(lambda mark: mark)
    if not wrappers and (names := most(lambda mark: mark.names)):
        seen: set[Mark] = set()
        wrappers = {mark for b in counted for mark in outwards(b.mark, seen) if mark.names in names}
    seen = set()
    wrappers |= {mark for b in free if b.element == "h1" for mark in outwards(b.mark, seen) if mark.names & REPLIES}
    # Those around all of the prose: each element's count is handed outwards, the innermost first.
    inside: dict[Mark, int] = {}
    seen = set()
    for b in counted:
        if b.mark:
            inside[b.mark] = inside.get(b.mark, 0) + 1
    for mark in sorted((m for b in counted for m in outwards(b.mark, seen)), key=lambda m: -m.number):
        if mark.around:
            inside[mark.around] = inside.get(mark.around, 0) + inside[mark]
    wrappers |= {mark for mark, n in inside.items() if n == len(counted) and mark.names & REPLIES}
    seen = set()
    wrappers |= {outer for mark in wrappers for outer in outwards(mark, seen)}
    kept: dict[Mark, bool] = {}  # whether an element and all marked ones around it are wrappers
    seen = set()
    for mark in sorted((m for b in blocks for m in outwards(b.mark, seen)), key=lambda m: m.number):
        kept[mark] = mark in wrappers and (mark.around is None or kept[mark.around])
    for b in blocks:
        b.dropped |= b.mark is not None and not kept[b.mark]
    return blocks


def prose_length(text: str) -> int:
    """Characters; one of a script without blanks counts as three."""
    return len(text) + (0 if text.isascii() else 2 * len(_UNSPACED.findall(text)))


def sentences(text: str) -> bool:
    """Whether a long text of any language is made of sentences, by their marks; Thai and its like have none."""
    n = len(_SENTENCE_END.findall(text))
    letters = 0 if text.isascii() else len(_UNSPACED.findall(text))
    return 2 * letters > len(text) or (n > 0 and 25 * n <= prose_length(text) <= 400 * n)


def first_pass(block: Block) -> bool | None:
    """True: article; False: not; None: open."""
    if block.dropped:
        return False
    if block.linked > LINK_SHARE * len(block.text):
        # A short paragraph of an article may be a link; a list of links is a menu.
        return None if block.part and block.element == "p" and prose_length(block.text) < LONG_CHARS else False
    if prose_length(block.text) < LONG_CHARS:
        return None
    words = [w.lower() for w in _WORD.findall(block.text)]
    stops = sum(w in STOP_WORDS for w in words)
    if stops >= STOP_SHARE * max(1, len(words)):
        return True
    # Other languages show by their sentences; tables and lists are decided only by where they stand.
    return True if block.part or sentences(block.text) else None


def second_pass(blocks: list[Block], labels: list[bool | None]) -> list[bool]:
    """Open blocks inherit from the nearest decided neighbour on either side; ties are article.

    Neighbours in the same box come first, then those in the same part.  Where a part decides nothing, marked-up
    article stays and the rest goes.  A dropped element's label is about that element alone, but outside of articles
    it also tells of what stands around it.
    """
    n = len(blocks)
    near: list[list[tuple[int, bool]]] = [[] for _ in range(n)]
    for key in (lambda b: (b.part, b.box), lambda b: b.part):
        sides: list[list[tuple[int, bool]]] = [[] for _ in range(n)]
        for order in (range(n), range(n - 1, -1, -1)):
            last: dict = {}
            for k in order:
                if labels[k] is not None and not (blocks[k].dropped and blocks[k].part):
                    last[key(blocks[k])] = (k, labels[k])
                elif labels[k] is None and key(blocks[k]) in last:
                    sides[k].append(last[key(blocks[k])])
        near = [x or y for x, y in zip(near, sides)]
    out = []
    for k, label in enumerate(labels):
        if label is None:
            nearest = min((abs(k - j) for j, _ in near[k]), default=0)
            label = any(x for j, x in near[k] if abs(k - j) == nearest) if near[k] else blocks[k].part > 0
        out.append(label)
    return out


def main_text(page: str) -> str:
    """The article's blocks, joined by line feeds."""
    blocks = blocks_of(page)
    labels = second_pass(blocks, [first_pass(b) for b in blocks])
    if any(label and b.part for b, label in zip(blocks, labels)):
        # A page that marks its article up has no article text outside of it.
        labels = [label and b.part > 0 for b, label in zip(blocks, labels)]
    if any(label and b.main for b, label in zip(blocks, labels)):
        labels = [label and b.main for b, label in zip(blocks, labels)]  # article cards beside main tell of other pages
    return "\n".join(b.text for b, label in zip(blocks, labels) if label)


_OUT = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64())])


def extract(df: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per input row: page_id, url, text, n_chars (code points).

    A null or empty page, and one without article text, gives an empty text.  Null ids and urls are handed on;
    repeated rows come back once each; an empty table gives no rows; other columns are not read.
    """
    def run(batches):
        def rows():
            for batch in batches:
                for page_id, url, page in zip(batch.column("page_id"), batch.column("url"), batch.column("html")):
                    text = main_text(page.as_py() or "")
                    yield page_id.as_py(), url.as_py(), text, len(text)

        return batches_of(rows(), _OUT, weight=lambda r: len(r[2]))

    return pick(df, page_id=id_col, url=url_col, html=html_col).mapInArrow(run, "page_id bigint, url string, text string, n_chars bigint")
