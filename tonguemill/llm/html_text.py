"""HTML extraction by tree scoring.

A page becomes a tree of elements whose text stands in blocks.  Paragraphs earn points for length and commas and pass them
to their ancestors; a container's points are discounted by its link density; the article round the best container is kept
with what reads like text, headings, lists, tables and captions beside it; what is no article (menus, headers, notices,
adverts, forms, comments) is left out.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

SCHEMA = "page_id long, url string, text string, n_chars long"

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe xmp noembed noframes".split())
#: Never part of a text, whatever they hold.
NO_TEXT = frozenset(
    "script style textarea title noscript template iframe xmp noembed noframes head form nav aside footer menu dialog "
    "button select option svg math object audio video canvas map datalist".split()
)
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol option p pre section select summary table tbody td tfoot "
    "th thead title tr ul".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 hgroup".split())
#: Parts of an article that earn few points or none.
FURNITURE = frozenset("ul ol dl table figure figcaption caption".split())
PARAGRAPHS = frozenset("p pre td blockquote li dd div section article main body h2 h3 h4".split())
#: An element that starts ends an open one of these (as browsers do), up to the nearest container.
ENDS = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
    "tbody": {"tr", "td", "th", "thead", "tbody"}, "tfoot": {"tr", "td", "th", "thead", "tbody"}, "option": {"option"},
}
HOLDERS = frozenset("table ul ol dl div section article main body html select td th blockquote".split())
NOT_ARTICLE = frozenset(
    "nav navbar navigation menu header masthead footer sidebar aside ad ads advert adverts advertisement advertising sponsor sponsored "
    "promo promotion notice notices cookie cookies consent gdpr banner popup modal overlay alert share sharing social related recommended "
    "newsletter subscribe subscription signup login breadcrumb breadcrumbs pagination pager toolbar widget form search skip".split()
)
#: Those of them that say how a page is laid out, and so may stand on a container that holds the article.
LAYOUT = frozenset(
    "nav navbar navigation menu header masthead footer sidebar aside breadcrumb breadcrumbs pagination pager toolbar widget form search "
    "skip".split()
)
#: Those that are ordinary words too: a name with them counts only if all its words are of this kind (`share-buttons`, not
#: `share-price`).
WEAK = frozenset(
    "menu header aside notice notices alert share sharing social related recommended promo promotion subscribe subscription signup login "
    "form search skip widget reply replies respond discussion reviews responses feedback".split()
)
NAMING = frozenset(
    "bar box block button buttons list links link icon icons item items area panel section container wrapper wrap inner outer slot unit "
    "top bottom left right main site page post posts article articles entry story content body text title more reader readers user users "
    "media group row col column grid field fields input toggle tools tool message messages your you may also like news stories reads".split()
)
#: Names for what belongs to an article: `entry-header` holds its title.
OF_ARTICLE = frozenset("article post entry story".split())
#: Words round which a class says what a container has or is for (`with-sidebar`, `comments-open`), not what it is.
STATES = frozenset("with has no without open closed enabled disabled on off".split())
PLACES = frozenset("content main page layout wrap wrapper container site article post body".split())
COMMENTS = frozenset("comment comments commentlist disqus respond replies reply discussion responses feedback reviews".split())
#: Names of inline elements whose text is no part of the paragraph round them.
INLINE_OUT = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo share sharing social newsletter subscribe signup login cookie "
    "consent popup modal".split()
)
ROLES = frozenset("navigation banner contentinfo complementary search form alert dialog alertdialog menu menubar".split())

_TAG = re.compile(r"""(?:[^'">]|"[^"]*"|'[^']*')*+>""")
_NAME = re.compile(r"[a-zA-Z][^\s/>]*")
_MARKS = re.compile(r"""\b(class|id|role|hidden|aria-hidden|style)\b(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""", re.I)
_WORD = re.compile(r"[a-z]+")
_HUMP = re.compile(r"(?<=[a-z])(?=[A-Z])")  # UserComments is user-comments
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden")


class Element:
    __slots__ = ("name", "parent", "children", "marks", "points", "length", "linked", "out", "mute")

    def __init__(self, name: str, parent: Element | None, marks: str = "", mute: bool = False) -> None:
        self.name, self.parent, self.marks, self.mute = name, parent, marks, mute
        self.children: list[Element | Block] = []
        self.points, self.length, self.linked, self.out = 0.0, 0, 0, False


class Block:
    __slots__ = ("text", "linked", "parent")

    def __init__(self, text: str, linked: int, parent: Element) -> None:
        self.text, self.linked, self.parent = text, linked, parent


def parse(page: str) -> Element:
    """The tree of a page.  Broken markup is read as browsers read it: what is open at the end is closed there."""
    root = here = Element("html", None)
    pieces: list[str] = []
    links = linked = muted = 0

    def end_block() -> None:
        nonlocal linked
        if pieces:
            text = " ".join("".join(pieces).split())
            if text:
                owner = here
                while owner.name not in BLOCKS and owner.parent:
                    owner = owner.parent
                owner.children.append(Block(text, min(linked, len(text)), owner))
            pieces.clear()
        linked = 0

    at, size = 0, len(page)
    while at < size:
        cut = page.find("<", at)
        if cut < 0:
            cut = size
        if cut > at and not muted:
            pieces.append(html.unescape(page[at:cut]))  # a reference ends where a tag begins
            if links:
                linked += cut - at
        if cut == size:
            break
        following = page[cut + 1 : cut + 2]
        if following == "!" or following == "?":
            if page.startswith("<!--", cut):
                end = page.find("-->", cut + 4)
                at = size if end < 0 else end + 3
            elif page.startswith("<![CDATA[", cut):
                end = page.find("]]>", cut)
                at = size if end < 0 else end + 3
            else:
                end = page.find(">", cut)
                at = size if end < 0 else end + 1
            continue
        closing = following == "/"
        name = _NAME.match(page, cut + 1 + closing)
        if not name:
            if not muted:
                pieces.append("<")
            at = cut + 1
            continue
        tag = _TAG.match(page, name.end())
        end = tag.end() if tag else page.find(">", name.end()) + 1
        if not end:
            break
        at, kind = end, name.group().lower()
        if closing:
            if kind in BLOCKS:
                end_block()
            found = here
            while found and found.name != kind:
                if found.name in HOLDERS and kind not in HOLDERS and kind not in BLOCKS:
                    found = None
                    break
                found = found.parent
            if found and found.parent:
                step = here
                while step is not found.parent:
                    links -= step.name == "a"
                    muted -= step.mute
                    step = step.parent
                here = found.parent
            continue
        if kind in BLOCKS:
            end_block()
            ended = ENDS.get(kind, ()) if kind in ENDS else {"p"}
            step, last = here, None
            while step and step.name not in HOLDERS - set(ended):
                if step.name in ended:
                    last = step
                step = step.parent
            if last and last.parent:
                step = here
                while step is not last.parent:
                    links -= step.name == "a"
                    muted -= step.mute
                    step = step.parent
                here = last.parent
        elif kind == "br":
            pieces.append(" ")
        if kind in ("html", "body") and any_open(here, kind):
            continue
        if kind in VOID or page[end - 2 : end - 1] == "/":
            continue
        if kind in RAW:
            stop = re.compile(rf"</{re.escape(kind)}(?=[\s/>])", re.I).search(page, end)
            after = page.find(">", stop.end()) if stop else -1
            at = size if after < 0 else after + 1
            continue
        if kind == "a":
            links += 1
        marks = page[name.end() : end - 1]
        mute = kind not in BLOCKS and (kind in NO_TEXT or bool(marks) and _mute(marks))
        muted += mute
        element = Element(kind, here, marks, mute)
        here.children.append(element)
        here = element
    end_block()
    return root


def any_open(here: Element | None, kind: str) -> bool:
    while here:
        if here.name == kind:
            return True
        here = here.parent
    return False


def _read_marks(marks: str) -> Iterator[tuple[str, str]]:
    for m in _MARKS.finditer(marks):
        yield m.group(1).lower(), _HUMP.sub("-", m.group(2) or m.group(3) or m.group(4) or "").lower()


def _unseen(key: str, value: str) -> bool:
    return key == "hidden" or key == "aria-hidden" and value == "true" or key == "style" and bool(_HIDDEN.search(value))


def _mute(marks: str) -> bool:
    """Whether an inline element's text is not shown, or is an advert or the like by a whole name of its class."""
    return any(_unseen(key, value) or key == "class" and not INLINE_OUT.isdisjoint(value.split()) for key, value in _read_marks(marks))


def _name_says(token: str, bad: frozenset[str]) -> str:
    """What one name in a class or id says: `yes`, `layout`, `state`, or nothing."""
    words = set(_WORD.findall(token))
    found = words & bad
    if not found or words & STATES:
        return ""
    if found <= WEAK and any(w not in bad and w not in NAMING and w not in PLACES and len(w) > 2 for w in words):
        return ""
    if words & OF_ARTICLE and found <= {"header"}:
        return ""
    if found <= LAYOUT:
        return "state" if words & PLACES else "layout"
    return "yes"


def _leave_out(element: Element) -> str:
    """Whether an element's name, class, id or role says that it is no part of an article: `yes`, or `layout` where only words of
    layout say so, and `state` where these stand with the name of a place; else empty.

    Headings and paragraphs are not judged by their id, which names what they are about, nor sections unless it is a whole word;
    a header of an article is part of it.
    """
    if element.name in NO_TEXT:
        return "yes"
    heads_article = element.name == "header" and (any_open(element, "article") or any_open(element, "main"))
    if element.name == "header" and not heads_article:
        return "yes"
    if not element.marks or element.name in ("html", "body"):
        return ""
    bad = COMMENTS - WEAK if element.name in ("article", "main") else COMMENTS | NOT_ARTICLE
    text = element.name in HEADINGS or element.name in ("p", "pre", "blockquote")
    found = ""
    for key, value in _read_marks(element.marks):
        if _unseen(key, value):
            return "yes"
        if key == "role" and value in ROLES:
            return "yes"
        if heads_article or key not in ("class", "id") or key == "id" and text:
            continue
        for token in value.split():
            if key == "id" and element.name == "section" and token not in bad:
                continue
            says = _name_says(token, bad)
            if says == "yes":
                return says
            found = "layout" if "layout" in (says, found) else says or found
    return found


def _walk(root: Element) -> Iterator[Element]:
    """Elements in page order, without recursion: pages may nest deeply."""
    stack = [root]
    while stack:
        element = stack.pop()
        yield element
        stack.extend(c for c in reversed(element.children) if isinstance(c, Element))


def _mark(root: Element, order: list[Element]) -> None:
    """Marks as out what is no article.  Words of layout do not count on a container that holds most of the page's text and the
    article: an article, main or h1, or all paragraphs that stand in nothing else that is out."""
    whole = max(1, root.length - root.linked)
    marks = {id(e): mark for e in order if e.parent is not None and (mark := _leave_out(e))}
    wrappers = {id(e) for e in order if marks.get(id(e)) in ("layout", "state") and e.name in ("div", "section", "main")
                and e.length - e.linked > 0.6 * whole and any(isinstance(c, Element) for c in e.children)}
    if not wrappers:
        for element in order:
            element.out = id(element) in marks or bool(element.parent and element.parent.out)
        return
    # Bottom up: what stands in an element outside of all that is left out; top down: paragraphs beside it, articles round it.
    read: dict[int, int] = {}
    held: dict[int, set[str]] = {}
    for element in reversed(order):
        text = element.name in PARAGRAPHS - HEADINGS
        key, n, names = id(element), 0, {element.name} & {"article", "main", "h1"}
        for c in element.children:
            if isinstance(c, Block):
                n += text and len(c.text) >= 25 and not _dense(c, 0.25)
            else:
                n += read[id(c)] if id(c) not in marks else 0
                names |= held[id(c)] if id(c) not in marks or id(c) in wrappers else set()
        read[key], held[key] = n, names
    anchors = {"article", "main"} if held[id(root)] & {"article", "main"} else {"h1"}
    beside, inside = {id(root): 0}, {id(root): "h1" in anchors}
    for element in order:
        key, up = id(element), element.parent
        if up:
            beside[key] = beside[id(up)] + read[id(up)] - (read[key] if key not in marks else 0)
            inside[key] = inside[id(up)] or up.name in anchors
        element.out = bool(up and up.out)
        if key in marks and not element.out:
            article = held[key] & anchors or inside[key] and (marks[key] == "state" or not beside[key])
            element.out = not (key in wrappers and article)


def main_text(page: str | None) -> str:
    """The blocks of the article joined by newlines; empty for a null or empty page or one without text."""
    if not page:
        return ""
    root = parse(page)
    order = list(_walk(root))
    for element in reversed(order):  # children first
        for child in element.children:
            element.length += len(child.text) if isinstance(child, Block) else child.length
            element.linked += child.linked
    _mark(root, order)
    _score([e for e in order if not e.out])
    kept = _best(root, [e for e in order if not e.out])
    lines: list[str] = []
    stack: list[Element | Block] = list(reversed(kept))
    while stack:
        part = stack.pop()
        if isinstance(part, Block):
            lines.append(part.text)
        elif not part.out:
            stack.extend(reversed(part.children))
    return "\n".join(lines)


def _score(elements: list[Element]) -> None:
    for element in elements:
        if element.name not in PARAGRAPHS:
            continue
        for block in element.children:
            if isinstance(block, Block) and len(block.text) >= 25:
                free = 1 - block.linked / len(block.text)
                points = (1 + block.text.count(",") + min(len(block.text) / 100, 3)) * free
                up, share = (element.parent or element) if element.name in ("p", "pre", "td", "li", "dd", "h2", "h3", "h4") else element, 1.0
                for _ in range(4):
                    up.points += points * share
                    if up.parent is None:
                        break
                    up, share = up.parent, share / 2
    for element in elements:
        element.points *= 1 - element.linked / max(1, element.length)
        if element.name in ("article", "main"):
            element.points = element.points * 1.5 + 10 * (element.length > 0)


def _article(best: Element) -> Element:
    """The outermost article or main round the best container, or itself.  A main with several articles is no article."""
    top, step = best, best
    while step.parent is not None:
        if step.name == "article":
            top = step
        elif step.name == "main":
            articles, stack = 0, [step]
            while stack and articles < 2:
                element = stack.pop()
                articles += element.name == "article"
                if element.name != "article" or element is step:
                    stack.extend(c for c in element.children if isinstance(c, Element) and not c.out)
            if articles < 2:
                top = step
        step = step.parent
    return top


def _dense(part: Element | Block, least: float = 0.5) -> bool:
    return part.linked >= least * (len(part.text) if isinstance(part, Block) else part.length)


def _beside(node: Element, least: float) -> tuple[list[Element | Block], list[Element | Block]]:
    """What is kept of a node's siblings, before and after it: what reads like text, lists, tables and captions; headings
    before it; what stands between; and all that is no list of links where the parent has a heading of its own."""
    parts = [c for c in node.parent.children if isinstance(c, Block) or c is node or not c.out and c.length]
    at = next(i for i, c in enumerate(parts) if c is node)
    named = node.name in ("article", "main")
    kept = {at}
    for i, part in enumerate(parts):
        if isinstance(part, Block):
            if len(part.text) > 80 and not _dense(part, 0.25):
                kept.add(i)
        elif part.points >= least or part.name in ("p", "blockquote", "pre") and part.length > 80 and not _dense(part, 0.25):
            kept.add(i)
        elif not named and part.name in FURNITURE and not _dense(part):
            kept.add(i)
    first, last = min(kept), max(kept)
    kept.update(i for i in range(first, last) if parts[i].__class__ is Element and parts[i].name in HEADINGS | FURNITURE or not _dense(parts[i]))
    top = first
    follows = True  # what comes next is kept
    for i in range(first - 1, -1, -1):
        part = parts[i]
        if isinstance(part, Element) and part.name in HEADINGS:
            if follows or part.name in ("h1", "h2"):
                kept.add(i)
                top = i
            follows = True
        elif _dense(part):
            follows = False
    kept.update(i for i in range(top, first) if not _dense(parts[i]) and not (isinstance(parts[i], Element) and parts[i].name in HEADINGS))
    own = any(isinstance(parts[i], Element) and parts[i].name in HEADINGS for i in kept if i < at)
    if own and not named and node.parent.name not in ("body", "html"):
        kept.update(i for i, part in enumerate(parts) if not _dense(part))
    return [parts[i] for i in sorted(kept) if i < at], [parts[i] for i in sorted(kept) if i > at]


def _best(root: Element, elements: list[Element]) -> list[Element | Block]:
    """The article round the best container, or that container, with what is kept beside it and, where no article is marked as
    such, beside the elements round it, in page order; the whole page if nothing earns points."""
    best = max(elements, key=lambda e: e.points)
    if best.points <= 0 or best.parent is None:
        return list(root.children)
    node = top = _article(best)
    before, after = [], []
    while node.parent is not None:
        above, below = _beside(node, best.points * 0.2)
        before.append(above)
        after.extend(below)
        if top.name in ("article", "main"):
            break
        node = node.parent
    return [part for level in reversed(before) for part in level] + [top] + after


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars for every row of `pages`.

    A null or empty page has an empty text; ids and urls may be null or repeat, each row is read by itself, and other columns take no
    part.  A very long page is read whole, in time and memory in proportion to it.  Containers that earn the same points go by
    page order.  No rows give none.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(page) for page in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                names=["page_id", "url", "text", "n_chars"],
            )

    return pages.selectExpr("cast(page_id as long) page_id", "url", "html").mapInArrow(run, SCHEMA)
