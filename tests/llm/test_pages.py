"""Main text: pages of many layouts, deep nesting, and the choice of a section by its plain definition."""

import random
import time
import tracemalloc

import pytest

from tidemark.llm import tag_paths
from tidemark.llm.page_blocks import blocks
from tidemark.llm.tag_paths import main_text

P = "A paragraph of the article, with some words in it, and a second part; it ends here."
PAGES = {
    "parts beside the body": (
        "<body><div class=entry><h1>Title</h1><div class=intro><p>Short intro.</p></div><div class=body>" + f"<p>{P}</p>" * 8 + "</div>"
        "<div class=refs><ul><li>First source</li><li>Second source</li></ul></div></div><div class=foot>© 2024 Example Press. All rights reserved, everywhere and always.</div></body>",
        ["Title", "Short intro.", *[P] * 8, "First source", "Second source"],
    ),
    "code and a table": (
        f"<body><div id=nav><a href=x>Home</a></div><div id=content><div><h2>How to</h2></div><div><p>{P}</p><p>{P}</p></div><div><pre>x = 1</pre></div>"
        "<div><table><tr><td>a</td><td>b</td></tr></table></div></div></body>",
        ["How to", P, P, "x = 1", "a", "b"],
    ),
    "sections named like boxes": (
        f"<article><h1>Engines</h1><p>{P}</p><section id=search><h2>Search</h2><p>Search works by an index, and it is quick; that is all there is to it.</p></section>"
        f"<section class=side><p>The far side of the moon is never seen from here, as it happens to turn.</p></section><div class=search><input>Find</div></article>",
        ["Engines", P, "Search", "Search works by an index, and it is quick; that is all there is to it.", "The far side of the moon is never seen from here, as it happens to turn."],
    ),
    "site name in the page's head": (f"<body><div class=top><h1>The Daily Site</h1></div><div class=text><h2>News</h2><p>{P}</p><p>{P}</p></div></body>", ["News", P, P]),
    "teasers in main": (f"<main><h1>Title</h1><p>{P}</p><section class=more><h2>More news</h2><p>Another story, which you may like to read as well, some day.</p></section></main>", ["Title", P]),
    "a short text beside a copyright line": ("<body><div class=text>Hi.</div><div class=foot>© 2024 Example Press, all rights reserved.</div></body>", ["Hi."]),
    "headline before the text": (f"<body><div class=page><h1>Headline</h1></div><div class=body><p>{P}</p><p>{P}</p></div></body>", ["Headline", P, P]),
    "a wrapper of the whole page": (
        f"<body><div id=page><div class=logo>Site</div><div class=links><a href=a>One</a> <a href=b>Two</a></div><div class=inner><p>{P}</p><p>{P}</p></div><div class=end>© Example. All rights reserved, in every part of it.</div></div></body>",
        [P, P],
    ),
    "two articles": (f"<main><article><h2>One</h2><p>{P}</p><p>{P}</p><p>{P}</p></article><article><h2>Two</h2><p>{P}</p></article></main>", ["One", P, P, P, "Two", P]),
}


@pytest.mark.parametrize("name", PAGES)
def test_layouts(name):
    page, want = PAGES[name]
    assert main_text(page).split("\n") == want


def test_deep_nesting_takes_linear_time_and_memory():
    def run(n):
        page = "<article>" + f"<div class=c>{P}" * n + "</div>" * n + "</article>"
        tracemalloc.start()
        begin = time.process_time()
        assert main_text(page).count("\n") == n - 1
        used = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        return time.process_time() - begin, used

    run(100)
    (short, _), (long, memory) = run(5000), run(50_000)
    assert long < 25 * short and memory < 500 << 20


def test_a_page_of_open_elements_without_text():
    assert main_text("<div>" * 100_000) == ""


# The same choice by its definition: every question is asked of the plain tree.


def chain(e):
    while e is not None:
        yield e
        e = e.parent


def by_definition(page):
    t = tag_paths
    found, _ = blocks(page)
    found = [(b, b.text()) for b in found]
    holds = lambda e, b: any(a is e for a in chain(b.element))
    whole = lambda e: any(a.name in ("article", "main") for a in chain(e))
    found = [f for f in found if not any(a.name in t._OTHER_ELEMENTS or (a.name == "header" and not whole(a)) for a in chain(f[0].element))]

    def labelled(e):
        if e.name in t._WHOLE or not (e.labels or e.name == "form"):
            return False
        if e.name == "form" or t._NEVER.search(e.labels):
            return True
        return bool(t._SELDOM.search(e.labels)) and not (whole(e) and any(t._is_sentence(b, x) for b, x in found if holds(e, b)))

    weight = lambda b, x: 0 if t._is_rights(x) else t._own(b, x)
    total = sum(weight(b, x) for b, x in found)
    clean = {a for b, _ in found if not any(labelled(c) for c in chain(b.element)) for a in chain(b.element) if a.name in ("article", "main")}

    def believed(e):
        if not labelled(e):
            return False
        mass = sum(weight(b, x) for b, x in found if holds(e, b))
        elsewhere = clean - set(chain(e))
        return not (mass > t.MOST * total and not elsewhere and not t._COMMENTS.search(e.labels))

    found = [f for f in found if not any(believed(a) for a in chain(f[0].element))] or found
    if not found:
        return ""
    score = t._scores(found)
    best = max(score.values())
    content = [(b, x) for b, x in found if score[b.element.path] >= t.SHARE * best]
    content = [b for b, x in content if not t._is_rights(x)] or [b for b, _ in content]
    section = next(a for a in chain(content[0].element) if all(holds(a, b) for b in content))
    while section.parent is not None and section.name not in t._SECTIONS:
        section = section.parent
    outer = [a for a in chain(section) if a.name in ("article", "main")]
    if outer:
        section = outer[-1]
    else:
        for a in list(chain(section))[1:]:
            if a.name in ("", "html", "body"):
                break
            if a.name not in t._SECTIONS:
                continue
            extra = [f for f in found if holds(a, f[0]) and not holds(section, f[0])]
            own, linked = sum(t._own(b, x) for b, x in extra), sum(min(b.linked, len(x)) for b, x in extra)
            said = t._CONTENT.search(a.labels) or any(t._is_sentence(b, x) for b, x in extra)
            if own + linked and (own < linked or not said):
                break
            section = a
    kept = [i for i, (b, _) in enumerate(found) if holds(section, b)]
    heads = lambda e: any(a.labels and a.name not in t._WHOLE and t._HEAD.search(a.labels) for a in chain(e))
    before = [i for i in range(kept[0]) if found[i][0].element.name == "h1" and not heads(found[i][0].element)]
    if not any(found[i][0].element.name == "h1" for i in kept):
        kept = before[-1:] + kept
    return "\n".join(found[i][1] for i in kept)


def test_random_pages_equal_the_definition():
    rng = random.Random(9)
    names = ["div", "section", "article", "main", "p", "ul", "li", "h1", "header", "footer", "nav", "form", "span", "a", "td", "aside"]
    labels = ["", "", "", " class=entry", " class=side", " class=search", " id=content", " class='ad box'", " class=comments", " class=more-news", " class=top", " class=post", " role=navigation"]
    texts = [P, "Short.", "Title", "© All rights reserved, by someone or other, in this year.", "word " * 30, ""]

    def make(depth):
        if depth == 0 or rng.random() < 0.2:
            return rng.choice(texts)
        name = rng.choice(names)
        return f"<{name}{rng.choice(labels)}>" + "".join(make(depth - 1) for _ in range(rng.randrange(1, 4))) + f"</{name}>"

    some = 0
    for _ in range(1500):
        page = f"<body>{''.join(make(5) for _ in range(rng.randrange(1, 4)))}</body>"
        got = main_text(page)
        assert got == by_definition(page), page
        some += bool(got)
    assert some > 1000
