"""Text blocks of an HTML page, each with its open elements. A forgiving reader, never an error."""

from __future__ import annotations

import html
import re
from dataclasses import dataclass, field

_TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>""", re.S)
_LABEL = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)

# Element classes of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea noscript template iframe xmp noembed noframes".split())
FOREIGN = frozenset(["svg", "math"])
# Inside FOREIGN: elements that hold HTML, and those that otherwise end it, as in browsers.
HOLDS_HTML = frozenset("foreignobject desc title annotation-xml mi mo mn ms mtext".split())
ENDS_FOREIGN = frozenset(
    "b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 head hr i img li listing menu meta nobr ol p pre ruby s small span strong strike sub sup "
    "table tt u ul var article section main aside nav header footer html".split()
)
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rp rt ruby s samp small span strike strong sub sup time tt u var wbr img".split()
)
ENDS_P = frozenset(
    "address article aside blockquote details dialog div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split()
)
ENDS_LIKE = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
SCOPE = frozenset("html body article section main div table td th ul ol dl nav aside footer header form blockquote".split())


@dataclass(eq=False, slots=True)
class Element:
    """An open element. ``number`` counts them in page order, parents first; ``path`` stands for the
    names and first labels from the root to it: equal numbers for equal paths."""

    name: str
    labels: str
    parent: Element | None
    number: int
    path: int


@dataclass
class Block:
    """Text between two block boundaries. ``linked``: characters of it inside links."""

    element: Element
    parts: list[str] = field(default_factory=list)
    linked: int = 0

    def text(self) -> str:
        return " ".join(html.unescape("".join(self.parts)).split())


def _labels(attributes: str) -> str:
    if "=" not in attributes:
        return ""
    return " ".join((a or b or c).lower() for _, a, b, c in _LABEL.findall(attributes))


def _foreign_end(page: str, name: str, at: int) -> int:
    """Where the FOREIGN element that begins before ``at`` ends: its own end tag, or HTML that can't be in it."""
    deep, inside = 1, 0
    while (m := _TOKEN.search(page, at)) is not None:
        closing, tag, attributes = (m[1], m[2], m[3]) if m[2] else (m[4], m[5], m[6])
        tag = (tag or "").lower()
        if tag in ("script", "style") and not closing and not attributes.endswith("/"):
            end = re.compile(f"</{tag}\\s*>", re.I).search(page, m.end())
            if end is None:
                break
            at = end.end()
            continue
        if tag == name and (closing or not attributes.endswith("/")):
            deep += -1 if closing else 1
            if not deep:
                return m.end()
        elif tag in HOLDS_HTML and (closing or not attributes.endswith("/")):
            inside = max(0, inside - 1) if closing else inside + 1
        elif tag in ENDS_FOREIGN and not inside:
            return m.start()
        at = m.end()
    return len(page)


def blocks(page: str) -> tuple[list[Block], list[Element]]:
    """Blocks with text, and all elements, both in page order. What scripts, styles and titles hold is not text."""
    root = Element("", "", None, 0, 0)
    stack, elements = [root], [root]
    paths: dict[tuple[int, str, str], int] = {}
    out: list[Block] = []
    block: Block | None = None
    links, at, size = 0, 0, len(page)

    def home() -> Element:
        i = len(stack) - 1
        while stack[i].name in INLINE:
            i -= 1
        return stack[i]

    def text(chunk: str) -> None:
        nonlocal block
        if chunk:
            if block is None:
                block = Block(home())
                out.append(block)
            block.parts.append(chunk)
            if links:
                block.linked += len(chunk)

    def pop(index: int) -> None:
        nonlocal links
        links -= sum(e.name == "a" for e in stack[index:])
        del stack[index:]

    def open_index(names: set[str] | frozenset[str], scope: frozenset[str]) -> int:
        for i in range(len(stack) - 1, 0, -1):
            if stack[i].name in names:
                return i
            if stack[i].name in scope:
                return 0
        return 0

    while at < size:
        m = _TOKEN.search(page, at)
        if m is None:
            text(page[at:])
            break
        text(page[at : m.start()])
        at = m.end()
        closing, name, attributes = (m[1], m[2], m[3]) if m[2] else (m[4], m[5], m[6])
        if not name:
            continue
        name = name.lower()
        if closing:
            if name in INLINE:
                i = open_index({name}, SCOPE)
            else:
                block = None
                i = next((i for i in range(len(stack) - 1, 0, -1) if stack[i].name == name), 0)
            if i:
                pop(i)
            continue
        if name in FOREIGN:
            at = at if attributes.endswith("/") else _foreign_end(page, name, at)
            continue
        if name in RAW:
            end = re.compile(f"</{re.escape(name)}\\s*>", re.I).search(page, at)
            at = end.end() if end else size
            continue
        if name in VOID:
            if name == "br":
                text(" ")
            elif name == "hr":
                block = None
            continue
        if name not in INLINE:
            block = None
            if name in ENDS_P and (i := open_index({"p"}, SCOPE)):
                pop(i)
            if name in ENDS_LIKE and (i := open_index(frozenset(ENDS_LIKE[name]), frozenset({"table", "ul", "ol", "dl", "select", "menu"}))):
                pop(i)
        if attributes.endswith("/") and name not in INLINE:
            continue
        parent = stack[-1]
        labels = _labels(attributes)
        first = labels.split(" ", 1)[0]
        path = parent.path if name in INLINE else paths.setdefault((parent.path, name, first), len(paths) + 1)
        stack.append(Element(name, labels, parent, len(elements), path))
        elements.append(stack[-1])
        links += name == "a"
    return [b for b in out if b.text()], elements
