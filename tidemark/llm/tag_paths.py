"""HTML extraction: the main text of pages by tag-path ratios.

Method. A page's text blocks are put together by root-to-leaf tag path (block elements with their
first label). Each path has two ratios: text characters per block and punctuation marks per block,
link text left out. Along the page, the ratios of the blocks are smoothed with their neighbours' and
fused into one score; paths whose mean score reaches ``SHARE`` of the page's best are content. The
main text is the smallest section that holds all blocks on content paths, or the section around it if
that is labelled as content or has more sentences. It is kept whole: what stands in it is
kept, long or short, except for parts that say of themselves that they are something else (menus,
adverts, forms, comments and the like, by element or label). A headline (h1) before a section without one is kept
unless it stands in the page's head.

Elements are numbered parents first, so what depends on ancestors is passed down, and sums over
descendants are passed up, in one walk each: time and memory follow the page's length, however deep it nests.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.page_blocks import Block, Element, blocks
from tidemark.llm.words import column

SHARE = 0.2  # of the best path's score that makes a path content
_KERNEL = (0.25, 0.5, 0.25)
_PUNCTUATION = re.compile(r"[.,;:!?…。、，；：！？]")
_OTHER_ELEMENTS = frozenset("nav footer aside button select menu dialog".split())
# Words of labels. What they name is never a part of an article ...
_NEVER_WORDS = (
    r"(?:nav|navigation|navbar|menu|sidebar|footer|foot|masthead|topbar|ad|ads|adv|advert[^\W_]*|adbox|promo[^\W_]*|sponsor[^\W_]*|cookie[^\W_]*|consent|gdpr|notice[^\W_]*|"
    r"newsletter|subscri[^\W_]*|comment[^\W_]*|disqus|replies|reactions|share[^\W_]*|social|related|recommend[^\W_]*|more|teaser[^\W_]*|trending|popular|breadcrumb[^\W_]*|popup|modal|"
    r"overlay|login|signup|complementary|contentinfo|pagination|pager)"
)
# ... and what an article may have a section about: inside one they count only where no sentence stands.
_SELDOM_WORDS = r"(?:side|banner|alert|widget|search|tags|legal|copyright|disclaimer)"
# Words that say where or what kind of box, so that a label with them is still one of the above.
_PLACE_WORDS = r"(?:site|page|main|global|top|bottom|left|right|upper|lower|inner|outer|area|bar|box|block|container|wrap|wrapper|list|item|slot|unit|section|news|\d+)"


def _whole_label(words: str) -> re.Pattern:
    """A whole label: words of this sort or places, with at least one of the first."""
    return re.compile(rf"(?:^|\s)(?:{_PLACE_WORDS}[_-]+)*{words}(?:[_-]+(?:{words}|{_PLACE_WORDS}))*(?=\s|$)")


_NEVER, _SELDOM = _whole_label(_NEVER_WORDS), _whole_label(_SELDOM_WORDS)
_COMMENTS = re.compile(r"comment|disqus|replies|reactions")
_CONTENT = re.compile(r"(?:^|[\s_-])(?:entry|content|post|article|story|text|articlebody|prose)(?=[\s_-]|$)")
_HEAD = re.compile(r"(?:^|[\s_-])(?:top|head|header|masthead|brand|branding|logo|site|banner)(?=[\s_-]|$)")
_RIGHTS = re.compile(r"©|\(c\)|copyright|all rights reserved", re.I)
_WHOLE = frozenset("html body main article".split())  # never something else by label
MOST = 0.5  # of the page's text outside links that a labelled element must hold to be content nevertheless
_RIGHTS_LINE = 150  # characters, at most
_SENTENCE = 40  # characters outside links, with a punctuation mark
_SECTIONS = frozenset("body article main section div td html".split())


def _own(block: Block, text: str) -> int:
    return max(0, len(text) - block.linked)


def _is_rights(text: str) -> bool:
    """A line that claims rights, as pages end with; not a paragraph that speaks of them."""
    return len(text) < _RIGHTS_LINE and bool(_RIGHTS.search(text))


def _is_sentence(block: Block, text: str) -> bool:
    return _own(block, text) >= _SENTENCE and bool(_PUNCTUATION.search(text)) and not _is_rights(text)


def _down(elements: list[Element], own: list[bool]) -> list[bool]:
    """For each element whether it or one it stands in is marked."""
    out = list(own)
    for e in elements[1:]:
        out[e.number] = out[e.number] or out[e.parent.number]
    return out


def _up(elements: list[Element], own: dict[int, int]) -> list[int]:
    """For each element the sum over it and all that stands in it."""
    out = [0] * len(elements)
    for number, value in own.items():
        out[number] = value
    for e in reversed(elements[1:]):
        out[e.parent.number] += out[e.number]
    return out


def _sums(found: list[tuple[Block, str]], value) -> dict[int, int]:
    out: dict[int, int] = defaultdict(int)
    for block, text in found:
        out[block.element.number] += value(block, text)
    return out


def _content_blocks(found: list[tuple[Block, str]], elements: list[Element]) -> list[tuple[Block, str]]:
    """Blocks outside parts that are something else. A label is not believed on an element that holds
    most of the page's text, unless an article or main elsewhere has text or the label speaks of comments."""
    in_whole = _down(elements, [e.name in ("article", "main") for e in elements])
    gone = _down(elements, [e.name in _OTHER_ELEMENTS or (e.name == "header" and not in_whole[e.number]) for e in elements])
    found = [f for f in found if not gone[f[0].element.number]]
    never = [e.name == "form" or (e.name not in _WHOLE and bool(e.labels and _NEVER.search(e.labels))) for e in elements]
    seldom = [e.name not in _WHOLE and bool(e.labels and _SELDOM.search(e.labels)) for e in elements]
    if not any(never) and not any(seldom):
        return found
    sentences = _up(elements, _sums(found, lambda b, t: int(_is_sentence(b, t))))
    labelled = [n or (s and not (in_whole[i] and sentences[i])) for i, (n, s) in enumerate(zip(never, seldom, strict=True))]
    mass = _up(elements, _sums(found, lambda b, t: 0 if _is_rights(t) else _own(b, t)))
    below = _down(elements, labelled)
    clean = _up(elements, _sums([f for f in found if not below[f[0].element.number]], lambda b, t: 1))
    wholes = [e.name in ("article", "main") and clean[e.number] > 0 for e in elements]
    around = [0] * len(elements)  # such elements that it is or stands in
    for e in elements:
        around[e.number] = wholes[e.number] + (around[e.parent.number] if e.parent else 0)
    for e in elements:
        elsewhere = sum(wholes) > around[e.number]
        if labelled[e.number] and mass[e.number] > MOST * mass[0] and not elsewhere and not _COMMENTS.search(e.labels):
            labelled[e.number] = False
    below = _down(elements, labelled)
    return [f for f in found if not below[f[0].element.number]] or found


def _scores(found: list[tuple[Block, str]]) -> dict[int, float]:
    """Score of each tag path."""
    sums: dict[int, list[float]] = defaultdict(lambda: [0, 0, 0])
    for block, text in found:
        own = sums[block.element.path]
        own[0] += _own(block, text)
        own[1] += len(_PUNCTUATION.findall(text)) * (block.linked * 2 < len(text))
        own[2] += 1
    ratios = [(sums[b.element.path][0] / sums[b.element.path][2], sums[b.element.path][1] / sums[b.element.path][2]) for b, _ in found]
    padded = [ratios[0], *ratios, ratios[-1]]
    scores: dict[int, list[float]] = defaultdict(list)
    for i, (block, _) in enumerate(found):
        length, marks = (sum(w * padded[i + d][k] for d, w in enumerate(_KERNEL)) for k in (0, 1))
        own_length, own_marks = ratios[i]
        # A neighbour lifts a block by half at most: smoothing bridges gaps, it doesn't move borders.
        scores[block.element.path].append(min(length, 1.5 * own_length) * (1 + min(marks, 1.5 * own_marks)))
    return {path: sum(s) / len(s) for path, s in scores.items()}


def _section(found: list[tuple[Block, str]], elements: list[Element]) -> Element:
    """The section of the main text."""
    score = _scores(found)
    least = SHARE * max(score.values())
    chosen = [f for f in found if score[f[0].element.path] >= least]
    chosen = [f for f in chosen if not _is_rights(f[1])] or chosen
    content = _up(elements, _sums(chosen, lambda b, t: 1))
    # The last element that holds all of them: a holder's descendants come behind it.
    section = elements[max(i for i, n in enumerate(content) if n == content[0])]
    while section.parent is not None and section.name not in _SECTIONS:
        section = section.parent
    outer = None
    at = section
    while at is not None:
        outer = at if at.name in ("article", "main") else outer
        at = at.parent
    if outer is not None:
        return outer
    sentences = _up(elements, _sums(found, lambda b, t: int(_is_sentence(b, t))))
    own, linked = (_up(elements, _sums(found, f)) for f in (_own, lambda b, t: min(b.linked, len(t))))
    at = section
    while (at := at.parent) is not None and at.name not in ("", "html", "body"):
        if at.name not in _SECTIONS:
            continue
        more = own[at.number] - own[section.number], linked[at.number] - linked[section.number]
        said = bool(_CONTENT.search(at.labels)) or sentences[at.number] > sentences[section.number]
        if sum(more) and (more[0] < more[1] or not said):
            break
        section = at
    return section


def main_text(page: str | None) -> str:
    """Main text of one page: blocks joined by newlines; empty if there is none."""
    found, elements = blocks(page or "")
    found = _content_blocks([(b, b.text()) for b in found], elements)
    if not found:
        return ""
    section = _section(found, elements)
    inside = _down(elements, [e is section for e in elements])
    head = _down(elements, [bool(e.labels and e.name not in _WHOLE and _HEAD.search(e.labels)) for e in elements])
    kept = [i for i, (b, _) in enumerate(found) if inside[b.element.number]]
    before = [i for i, (b, _) in enumerate(found[: kept[0]]) if b.element.name == "h1" and not head[b.element.number]] if kept else []
    if not any(found[i][0].element.name == "h1" for i in kept):
        kept = before[-1:] + kept
    return "\n".join(found[i][1] for i in kept)


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for begin in range(0, batch.num_rows, 256):
            some = batch.slice(begin, 256)
            texts = [main_text(p) for p in column(some, "html").to_pylist()]
            yield pa.record_batch(
                [column(some, "id"), column(some, "url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=["id", "url", "text", "n_chars"],
            )


def extract(pages: DataFrame, id_column: str = "page_id", url_column: str = "url", html_column: str = "html") -> DataFrame:
    """(id, url, text, n_chars) per page; n_chars counts code points.

    Character references are decoded, white space inside a block is one space, blocks are in page
    order. A NULL, empty or broken page gives what can be read of it, or an empty text. A page is
    judged by itself, so repeated rows give equal results; other columns are ignored.
    """
    pages = pages.select(F.col(id_column).alias("id"), F.col(url_column).cast("string").alias("url"), F.col(html_column).cast("string").alias("html"))
    kind = dict(pages.dtypes)["id"]
    return pages.mapInArrow(_extract, f"id {kind}, url string, text string, n_chars long").withColumnRenamed("id", id_column)
