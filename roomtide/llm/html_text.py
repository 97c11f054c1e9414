"""Main text of web pages by tag-path ratios.

A page becomes blocks of text in page order; each block has a tag path, the
block elements from the root to it with their class, id and role. Paths are
then weighed as a whole:

- text ratio: the path's characters outside links over its number of blocks;
- punctuation ratio: the same of sentence marks;
- units: an element with a class, id or role of its own, ``article`` and ``main`` start a unit, except paragraphs,
  headings, lists and tables, which belong to the unit around them;
- smoothing: a path also counts the ratios of its unit's paths, weighted by their share of the text; lines of lists
  and tables and headings also those of all that lies in their unit and the one around it, below ``body``, so they
  stand with their article whatever wraps them;
- fusion: the product of both smoothed ratios and the share of the path's text outside links (a heading may be a link);
- weights: a tenth outside ``article`` and ``main`` if the page has one with text, ``MARKED`` below a class, id or role
  that names boilerplate and below ``form``;
- threshold: ``share`` of the best path's weighted ratio. It decides all paths, in and outside of ``article``.

Paths through elements that never hold main text (menus, footers, scripts ...) and hidden ones have ratio zero, as
does inline text whose own class or id names boilerplate, unless its element marks words of a sentence (``STRESS``:
emphasis, code, citations ...), which stay with their block.

A block ends at any block element's tag and at ``br``. Character references
are decoded, white space inside a block becomes one space, and blocks are
joined by a newline. Null html counts as empty; an empty page, and a page
without content, has empty text. Rows are kept one by one, whatever their
ids and urls. Nothing is cut: a page may be of any length and depth; it is
held whole. Paths with equal ratios are decided alike, so there are no ties to
break. An empty table gives an empty table. Only the columns named are read,
so other columns can't clash.
"""

from __future__ import annotations

import re
from collections import Counter
from html import unescape
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame

from roomtide.llm.text import map_batches, one_column

# Elements of HTML by their kind.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe noembed noframes xmp svg math".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rp rt ruby s samp small "
    "span strike strong sub sup time tt u var wbr img input".split()
)
#: Inline elements that say something about the words in them, whatever their class.
STRESS = frozenset("abbr b bdi bdo big cite code data del dfn em i ins kbd mark q s samp strike strong sub sup time tt u var".split())
NEVER = frozenset(
    "head nav footer aside menu dialog button select option fieldset datalist object applet audio video canvas map".split()
) | RAW
#: Words of a class, id or role that mark boilerplate.
MARKS = frozenset(
    "ad ads adv advert adverts advertisement banner breadcrumb breadcrumbs comment comments consent cookie cookies "
    "copyright disqus footer foot gdpr header hidden login masthead menu menubar modal nav navbar navigation navigations "
    "newsletter notice notices overlay pager pagination popup promo promos related reply replies search share sharing "
    "sidebar signup skip social sponsor sponsored subscribe tags teaser toolbar widget widgets complementary contentinfo "
    "alert alertdialog sidenav topbar toc".split()
)
MARKED = 0.05
LINES = frozenset("li td th dt dd caption figcaption h1 h2 h3 h4 h5 h6".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
PARTS = LINES | frozenset("p ul ol dl table thead tbody tfoot tr blockquote pre figure".split())
#: A start tag of the first closes open elements of the second, up to an element of the third.
IMPLIED = {
    "li": ("li", "ul ol menu".split()), "dt": ("dt dd".split(), ["dl"]), "dd": ("dt dd".split(), ["dl"]),
    "tr": ("tr td th".split(), ["table"]), "td": ("td th".split(), ["tr", "table"]), "th": ("td th".split(), ["tr", "table"]),
    "option": ("option", ["select"]),
}
_QUOTED = r"""[^>"']*+(?:"[^"]*+"[^>"']*+|'[^']*+'[^>"']*+)*+"""
TAG = re.compile(rf"<!--.*?(?:-->|\Z)|<[!?][^>]*+>|<(/?)([a-zA-Z][^\s/>]*+)({_QUOTED})>|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>", re.S)
ATTRIBUTE = re.compile(r"""([a-zA-Z_:][-\w:.]*)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'=<>`]+)))?""")
MARK = re.compile(r"[.!?;:,。！？；：，、…]")
WORDS = re.compile(r"[a-z]+|[0-9]+")


class Unit(NamedTuple):
    above: int
    marked: bool
    content: bool
    root: bool


class Open(NamedTuple):
    """An open element, and what holds for the text in it."""
    name: str
    path: int = -1
    unit: int = 0
    dead: bool = False
    content: bool = False
    line: bool = False
    heading: bool = False


class Block(NamedTuple):
    path: int
    unit: int
    text: str
    linked: int
    dead: bool
    content: bool
    line: bool


def _label(name: str, attributes: str) -> tuple[str, bool, bool]:
    """The element's part of a path, whether it is marked as boilerplate, and whether it is hidden."""
    if not attributes or not attributes.strip(" /"):
        return name, False, False
    label, marked, dead = [name], False, False
    for m in ATTRIBUTE.finditer(attributes):
        key, value = m[1].lower(), unescape(m[2] or m[3] or m[4] or "").lower()
        if key in ("class", "id", "role"):
            label.append(f"{key}={value}")
            marked |= not MARKS.isdisjoint(WORDS.findall(value))
        elif key == "hidden" or key == "aria-hidden" and value == "true" or key == "style" and "display:none" in value.replace(" ", ""):
            dead = True
    return " ".join(label), marked, dead


def blocks(html: str) -> tuple[list[Block], list[Unit]]:
    """Text blocks in page order, and the units they are in; a unit comes after the one above it."""
    found: list[Block] = []
    stack: list[Open] = []
    units, starts = [Unit(-1, False, False, True)], {}  # starts: the unit of a path that starts one
    page = Open("")
    numbers: dict[tuple[int, str], int] = {}  # of paths, by parent and label
    unclosed: set[str] = set()
    pieces: list[str] = []
    linked, links = 0, 0

    def end_of(name: str, at: int) -> int | None:
        """Behind the next end tag of the element."""
        if name in unclosed:
            return None
        if over := re.compile(rf"</{name}\s*>", re.I).search(html, at):
            return over.end()
        unclosed.add(name)
        return None

    def flush():
        nonlocal linked
        text = " ".join("".join(pieces).split())
        if text:
            x = stack[-1] if stack else page
            found.append(Block(x.path, x.unit, text, 0 if x.heading else linked, x.dead, x.content, x.line))
        pieces.clear()
        linked = 0

    opened: Counter[str] = Counter()  # names on the stack

    def close(k: int):
        flush()
        opened.subtract(x.name for x in stack[k:])
        del stack[k:]

    at, n, last = 0, len(html), html.rfind(">") + 1
    while at < n:
        m = TAG.search(html, at, last) if at < last else None
        end = m.start() if m else n
        if end > at:
            piece = unescape(html[at:end])
            pieces.append(piece)
            if links:
                linked += len("".join(piece.split()))
        if not m:
            break
        at = m.end()
        name = (m[2] or m[5] or "").lower()
        if not name:
            continue
        if m[1] or m[4]:
            if name == "a":
                links = max(0, links - 1)
            elif name in INLINE:
                pass
            elif opened[name]:
                close(next(k for k in range(len(stack) - 1, -1, -1) if stack[k].name == name))
            elif name in ("br", "p"):
                flush()
            continue
        attributes = m[3] or m[6] or ""
        if name in RAW:
            if name in ("svg", "math") and attributes.rstrip().endswith("/"):
                continue
            over = end_of(name, at)
            if over is None and name in ("noscript", "template", "svg", "math"):
                continue
            at = n if over is None else over
            continue
        if name == "a":
            links += 1
        if name in INLINE:
            _, marked, hidden = _label(name, attributes)
            if (hidden or marked and name not in STRESS) and name not in VOID and (over := end_of(name, at)):
                at = over
                links -= name == "a" and links > 0
            continue
        flush()
        if name in VOID:
            continue
        links = 0 if name in ("p", "div", "article", "section", "main") else links
        if name in IMPLIED:
            shut, upto = IMPLIED[name]
            for k in range(len(stack) - 1, -1, -1):
                if stack[k].name in upto:
                    break
                if stack[k].name in shut:
                    close(k)
                    break
        if stack and stack[-1].name == "p":
            close(len(stack) - 1)
        label, marked, hidden = _label(name, attributes)
        above = stack[-1] if stack else page
        root = name in ("html", "body")
        marked = (marked or name == "form") and not root
        content = above.content or name in ("article", "main")
        dead = above.dead or hidden and not root or name in NEVER or name == "header" and not content
        path = numbers.setdefault((above.path, label), len(numbers))
        unit, own = above.unit, marked or name in ("article", "main") or label != name and name not in PARTS
        if own:
            if path not in starts:
                starts[path] = len(units)
                units.append(Unit(above.unit, marked or units[above.unit].marked, content, root))
            unit = starts[path]
        line = name in LINES or above.line and not own
        opened[name] += 1
        stack.append(Open(name, path, unit, dead, content, line, name in HEADINGS or above.heading and not own))
    flush()
    return found, units


def chosen(found: list[Block], units: list[Unit], share: float = 0.1) -> list[str]:
    """The texts of the blocks on content paths."""
    paths: dict[int, list[float]] = {}  # blocks, characters outside links, marks, all characters
    where: dict[int, Block] = {}
    for b in found:
        if not b.dead:
            where[b.path] = b
            x = paths.setdefault(b.path, [0, 0, 0, 0])
            x[0] += 1
            x[1] += len(b.text) * (1 - b.linked / (len(b.text) - b.text.count(" ")))
            x[2] += len(MARK.findall(b.text)) if b.linked * 2 < len(b.text) else 0
            x[3] += len(b.text)
    if not paths:
        return []
    some = any(x[1] and where[p].content for p, x in paths.items())
    ratio = {p: (x[1] / x[0], x[2] / x[0]) for p, x in paths.items()}
    inside = [[0.0, 0.0, 0] for _ in units]
    for p, (text, marks) in ratio.items():
        x = inside[where[p].unit]
        for k, v in enumerate((text * paths[p][1], marks * paths[p][1], paths[p][1])):
            x[k] += v
    below = [list(x) for x in inside]
    for u in range(len(units) - 1, 0, -1):
        above = units[u].above
        if units[above].marked == units[u].marked and units[above].content == units[u].content:
            below[above] = [a + b for a, b in zip(below[above], below[u])]
    fused = {}
    for p, own in ratio.items():
        b, x = where[p], paths[p]
        unit, above = units[b.unit], units[units[b.unit].above]
        bases = [inside[b.unit]]
        if b.line and not unit.root:
            bases.append(below[b.unit])
            if unit.above > 0 and not above.root and above.marked == unit.marked and above.content == unit.content:
                bases.append(below[unit.above])
        text, marks = (max(own[k], *(s[k] / (s[2] or 1) for s in bases)) for k in (0, 1))
        weight = (0.1 if some and not b.content else 1) * (MARKED if unit.marked else 1)
        fused[p] = text * (1 + marks) * (x[1] / x[3]) * weight
    best = max(fused.values())
    content = {p for p, x in fused.items() if x >= share * best and x > 0}
    return [b.text for b in found if b.path in content and not b.dead]


def main_text(html: str | None) -> str:
    return "\n".join(chosen(*blocks(html or "")))


def extract(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """``page_id``, ``url``, ``text`` and ``n_chars`` of every page."""
    def run(batch: pa.RecordBatch):
        texts = [main_text(x) for x in batch.column(2).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], names=["page_id", "url", "text", "n_chars"])

    ids = pages.schema[page_id].dataType.simpleString()
    return map_batches(one_column(pages, page_id=page_id, url=url, html=html), run, f"page_id {ids}, url string, text string, n_chars bigint")
