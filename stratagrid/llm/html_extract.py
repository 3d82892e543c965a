"""Main text of web pages by tag-path ratios.

Every block of text belongs to the path of block elements from the root to it. Per
path, a page's text length and punctuation are summed and divided by the number of
blocks; the two ratios are smoothed along the order in which the paths first occur,
fused by their product, and paths above the threshold (the spread of the fused ratios)
whose own ratios aren't small beside the best are content. The content nodes are the
article elements, or the main element, if they hold 0.3 of what the content paths weigh,
else the element that the content paths have in common, with the headings, paragraphs
and lists beside it. Under them all text is kept, short blocks and links too, but for
boilerplate.

Boilerplate is certain by tag, role or being hidden. By class or id it is a suspicion
only, which yields to the text: a suspect element is kept if it holds the only article
elements of the page, or most of the text together with the page's first heading or a
name that speaks for an article. Names that say what an element has, lacks or does
(`has-sidebar`, `no-comments`, `overflow-hidden`) raise none, and none is raised by the
name of an article's paragraph. Outside the content nodes, blocks of links weigh nothing.
"""

from __future__ import annotations

import html
import math
import re
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:"[^"]*"|'[^']*'|[^>"'])*)(?:>|\Z)""", re.S)
_ATTRIBUTE = re.compile(r"""([^\s=/"'<>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_WORDS = re.compile(r"[a-z]+")
_CAMEL = re.compile(r"([a-z])([A-Z])")
_PUNCTUATION = re.compile(r"[.,;:!?…。，、；：！？¿¡]")
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template iframe textarea title xmp noembed noframes svg math object".split())
BLOCKS = frozenset("html head body address article aside blockquote center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr legend li main menu nav ol p pre search section summary table tbody td tfoot th thead tr ul br option select caption".split())
CLOSES_P = BLOCKS - {"br", "option", "caption"}
#: start tag -> open tags it ends, up to the fence
IMPLIED = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"}), "body": ({"head"}, set())}
DROPPED_TAGS = frozenset("head nav footer aside form button select option menu dialog input label search".split()) | RAW
DROPPED_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
DROPPED_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertisements advertising adbox adslot sponsor sponsored promo promotion promotions banner sidebar sidebars nav navbar navigation menu menus breadcrumb breadcrumbs footer masthead topbar "
    "cookie cookies consent gdpr notice notices notification notifications alert popup modal overlay newsletter subscribe subscription signup login comment comments commentlist disqus reply replies respond discussion "
    "aside sidenav subnav topnav leftnav rightnav megamenu dropdown offcanvas lightbox foot announcement announcements disclaimer paywall teaser teasers share sharing social related recommended recommendations widget widgets pager pagination toolbar tagcloud skip copyright hidden".split()
)
#: A header by name is the page's, unless it is named after the article too.
ARTICLE_WORDS = frozenset("article entry post content story main".split())
#: Elements that give the article away.
ROOTS = ("article", "main")
#: Elements that the content root is never inside of.
WHOLE = frozenset("ul ol menu dl table blockquote pre".split())
#: A block with a larger share of link text is navigation, if it is no heading or paragraph.
LINKS = 0.9
PROSE = frozenset("p h1 h2 h3 h4 h5 h6".split())
SMOOTHING = (0.25, 0.5, 0.25)
#: A path whose own ratios come to less than this part of the largest is no content, whatever its neighbours are.
OWN = 0.2
#: Names that say what an element has, lacks or does.
MODIFIERS = frozenset("has no with without not overflow".split())
CERTAIN, STRONG, WEAK = 1, 2, 3


class _Node:
    __slots__ = ("tag", "path", "dropped", "suspect", "link", "semantic", "block")

    def __init__(self, tag: str, path: int, dropped: bool, suspect: int, link: bool, semantic: bool, block: _Node | None = None):
        self.tag, self.path, self.dropped, self.suspect, self.link, self.semantic = tag, path, dropped, suspect, link, semantic
        self.block = block or self


class Block(NamedTuple):
    path: int
    dropped: bool  # for certain
    suspect: int  # the innermost suspect element that it stands in; 0 if none
    link: float  # share of link text
    text: str


class Suspect(NamedTuple):
    parent: int
    weak: bool  # its names speak for an article too
    semantic: bool  # inside an article or main element


class Page(NamedTuple):
    """A path is a number; parent and tag give the path above it and its last element. Number 0 is the root, and no suspect."""

    blocks: list[Block]
    parent: list[int]
    tag: list[str]
    suspects: list[Suspect]


def _attributes(raw: str) -> dict[str, str]:
    return {m[1].lower(): next((x for x in (m[2], m[3], m[4]) if x is not None), "") for m in _ATTRIBUTE.finditer(raw)}


def _boilerplate(tag: str, attributes: dict[str, str], semantic: bool) -> int:
    """CERTAIN, STRONG or WEAK boilerplate, or 0."""
    if tag in DROPPED_TAGS or tag == "header" and not semantic:
        return CERTAIN
    if not attributes:
        return 0
    if attributes.get("role", "").lower() in DROPPED_ROLES or "hidden" in attributes or attributes.get("aria-hidden") == "true" or "display:none" in attributes.get("style", "").replace(" ", "").lower():
        return CERTAIN
    if tag in ("html", "body", *ROOTS):
        return STRONG if tag == "article" and "comment" in attributes.get("class", "").lower() else 0
    if tag == "p" and semantic:
        return 0
    names = set()
    for token in f"{attributes.get('class', '')} {attributes.get('id', '')}".split():
        words = _WORDS.findall(_CAMEL.sub(r"\1 \2", token).lower())
        if words and words[0] not in MODIFIERS:
            names.update(words)
    article = not ARTICLE_WORDS.isdisjoint(names)
    if not DROPPED_WORDS.isdisjoint(names):
        return WEAK if article else STRONG
    return STRONG if "header" in names and not semantic and not article else 0


def parse(source: str) -> Page:
    """The blocks of a page in their order."""
    found: list[Block] = []
    parent, tags, suspects, number = [0], [""], [Suspect(0, False, False)], {}
    stack = [_Node("", 0, False, 0, False, False)]
    pieces: list[str] = []
    linked = 0
    owner = stack[0]
    depth: dict[str, int] = {}

    def cut(i: int):
        for x in stack[i:]:
            depth[x.tag] -= 1
        del stack[i:]

    def flush():
        nonlocal linked
        if pieces:
            text = " ".join("".join(pieces).split())
            if text:
                found.append(Block(owner.path, owner.dropped, owner.suspect, min(1.0, linked / (len(text) - text.count(" "))), text))
            pieces.clear()
        linked = 0

    def take(raw: str):
        nonlocal linked, owner
        top = stack[-1]
        if not raw or top.dropped and not pieces and not raw.strip():
            return
        block = top.block
        if top.dropped and not block.dropped or top.suspect != block.suspect:  # an inline element that is boilerplate
            return
        if not pieces:
            owner = block
        text = html.unescape(raw)
        pieces.append(text)
        if top.link:
            linked += sum(map(len, text.split()))

    def close(tags: set, fence: set):
        if not any(map(depth.get, tags)):
            return
        for i in range(len(stack) - 1, 0, -1):
            if stack[i].tag in tags:
                flush()
                cut(i)
                return
            if stack[i].tag in fence:
                return

    at, n = 0, len(source)
    while at < n:
        m = _TOKEN.search(source, at)
        if m is None:
            take(source[at:])
            break
        take(source[at : m.start()])
        at = m.end()
        if m[2] is None:
            continue
        tag = m[2].lower()
        if m[1]:
            if tag in BLOCKS or tag == "p":
                flush()
            i = len(stack) - 1
            while depth.get(tag) and stack[i].tag != tag:
                i -= 1
            if depth.get(tag):
                cut(i)
            continue
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}[\s/>]", re.I).search(source, at)
            if not m[3].endswith("/") or tag not in ("svg", "math"):
                at = n if end is None else end.start()
                if end is not None:
                    shut = source.find(">", at)
                    at = n if shut < 0 else shut + 1
            continue
        if tag in BLOCKS:
            flush()
        if tag in CLOSES_P:
            close({"p"}, {"table", "button", "td", "th", "caption"})
        if tag in IMPLIED:
            close(*IMPLIED[tag])
        if tag in VOID:
            continue
        top = stack[-1]
        attributes = _attributes(m[3]) if m[3].strip() else {}
        semantic = top.semantic or tag in ROOTS
        block = tag in BLOCKS
        kind = _boilerplate(tag, attributes, top.semantic)
        suspect = top.suspect
        if kind in (STRONG, WEAK):
            suspect = len(suspects)
            suspects.append(Suspect(top.suspect, kind == WEAK, top.semantic))
        path = top.path
        if block:
            name = (top.path, tag, attributes.get("class", ""))
            path = number.setdefault(name, len(parent))
            if path == len(parent):
                parent.append(top.path)
                tags.append(tag)
        depth[tag] = depth.get(tag, 0) + 1
        stack.append(_Node(tag, path, top.dropped or kind == CERTAIN, suspect, top.link or tag == "a", semantic, None if block else top.block))
    flush()
    return Page(found, parent, tags, suspects)


def _outermost(page: Page, tags: tuple[str, ...]) -> list[int]:
    """Of each path, the outermost one at or above it that ends in one of `tags`; 0 if none."""
    found = [0] * len(page.parent)
    for i in range(1, len(found)):
        found[i] = found[page.parent[i]] or (i if page.tag[i] in tags else 0)
    return found


def kept_blocks(page: Page) -> list[Block]:
    """The blocks that no boilerplate holds."""
    blocks = [b for b in page.blocks if not b.dropped]
    if not any(b.suspect for b in blocks):
        return blocks
    root = _outermost(page, ROOTS)
    spared = [False] * len(page.suspects)
    spared[0] = True
    inside: dict[int, int] = {}
    for b in blocks:
        if root[b.path]:
            inside[root[b.path]] = inside.get(root[b.path], 0) + len(b.text)
    if inside and not any(root[b.path] and all(page.suspects[s].semantic for s in _chain(page, b.suspect)) for b in blocks):
        # no article but in suspects: what holds the heaviest one is none
        best = max(inside, key=inside.get)
        for b in blocks:
            if root[b.path] == best:
                for s in _chain(page, b.suspect):
                    spared[s] = spared[s] or not page.suspects[s].semantic
    title = next((b for b in blocks if page.tag[b.path] == "h1"), None)
    fit = [s.weak for s in page.suspects]  # may be kept, if they hold most of what may be
    fit[0] = True
    for s in _chain(page, title.suspect) if title else ():
        fit[s] = True
    for s in range(1, len(fit)):
        fit[s] = (fit[s] or spared[s]) and fit[page.suspects[s].parent]
    size, scope = [0] * len(page.suspects), 0
    for b in blocks:
        if fit[b.suspect] and (root[b.path] or not inside):
            size[b.suspect] += len(b.text)
            scope += len(b.text)
    for s in range(len(size) - 1, 0, -1):
        size[page.suspects[s].parent] += size[s]
    for s in range(1, len(size)):
        spared[s] = (spared[s] or fit[s] and 2 * size[s] > scope) and spared[page.suspects[s].parent]
    return [b for b in blocks if spared[b.suspect]]


def _chain(page: Page, suspect: int) -> list[int]:
    found = []
    while suspect:
        found.append(suspect)
        suspect = page.suspects[suspect].parent
    return found


def fused_ratios(page: Page, kept: list[Block]) -> dict[int, float]:
    """The smoothed, fused text and punctuation ratio of each path, in order of first occurrence; boilerplate weighs nothing."""
    good = set(map(id, kept))
    sums: dict[int, list[float]] = {}
    for b in page.blocks:
        s = sums.setdefault(b.path, [0.0, 0.0, 0.0])
        if id(b) in good:
            s[0] += len(b.text) * (1 - b.link)
            s[1] += len(_PUNCTUATION.findall(b.text)) * (1 - b.link)
        s[2] += 1
    ratios = [(s[0] / s[2], 1 + s[1] / s[2], s[0]) for s in sums.values()]

    def smooth(v: list[float]) -> list[float]:
        side = len(SMOOTHING) // 2
        return [sum(w * v[min(len(v) - 1, max(0, i + k - side))] for k, w in enumerate(SMOOTHING)) for i in range(len(v))]

    fused = [t * p for t, p in zip(smooth([r[0] for r in ratios]), smooth([r[1] for r in ratios]))]
    least = OWN * max(r[0] * r[1] for r in ratios)
    return {path: f if r[2] and r[0] * r[1] >= least else 0.0 for path, f, r in zip(sums, fused, ratios)}


def main_text(source: str | None) -> str:
    """The article of a page; empty if there is none."""
    page = parse(source or "")
    kept = kept_blocks(page)
    if not kept:
        return ""
    ratios = fused_ratios(page, kept)
    values = list(ratios.values())
    mean = sum(values) / len(values)
    threshold = min(max(values), math.sqrt(sum((v - mean) ** 2 for v in values) / len(values)))
    weight: dict[int, float] = {}
    shown: dict[int, float] = {}  # text by path, 0 for navigation
    for b in kept:
        if ratios[b.path] >= threshold and ratios[b.path] > 0:
            weight[b.path] = weight.get(b.path, 0.0) + len(b.text) * (1 - b.link)
        shown[b.path] = shown.get(b.path, 0.0) + (len(b.text) if b.link <= LINKS or page.tag[b.path] in PROSE else 0.0)
    weight = weight or dict.fromkeys(shown, 1.0)
    roots = _roots(page, weight, shown)
    under = [0 in roots] * len(page.parent)
    for i in range(1, len(under)):
        under[i] = under[page.parent[i]] or i in roots
    return " ".join(b.text for b in kept if under[b.path])


def _roots(page: Page, weight: dict[int, float], shown: dict[int, float]) -> set[int]:
    """The article or main elements if they hold much of what the content paths weigh, else the element that those paths have in common.

    That element is the innermost one above all content paths that isn't a block of text
    or a part of a list or table. It goes up as long as the element above it holds
    paragraphs, headings or lists of its own (of the body: if they have 0.3 of the
    text). A first heading beside it or above is kept too.
    """
    total = sum(weight.values())
    for tag in ROOTS:
        outer = _outermost(page, (tag,))
        held = {outer[p] for p in shown if outer[p]}
        if held and sum(weight.get(p, 0.0) for p in shown if outer[p]) >= 0.3 * total:
            return held

    def above(path: int) -> list[int]:
        found = [path]
        while path:
            path = page.parent[path]
            found.append(path)
        return found

    common: list[int] | None = None
    for path in weight:
        line = above(path)
        common = line if common is None else [x for x in common if x in set(line)]
    inside = {x for path in shown for x in above(path)[1:]}
    root = next((x for x in common or [0] if x in inside and page.tag[x] not in PROSE and not WHOLE.intersection(page.tag[y] for y in above(x))), 0)
    own: dict[int, float] = {}
    for path, n in shown.items():
        if page.tag[path] in PROSE or WHOLE.intersection(page.tag[y] for y in above(path)):
            holder = next(x for x in above(path)[1:] if page.tag[x] not in PROSE and not WHOLE.intersection(page.tag[y] for y in above(x)))
            own[holder] = own.get(holder, 0.0) + n
    under = sum(n for path, n in shown.items() if root in above(path))
    while root:
        up = page.parent[root]
        if own.get(up, 0.0) <= (0.3 * under if page.tag[up] in ("body", "html", "") else 0.0):
            break
        root = up
    title = next((path for path in shown if page.tag[path] == "h1"), None)
    return {root, title} if title is not None and page.parent[title] in above(root) else {root}


def _extract(place: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(x.as_py()) for x in batch.column(place)]
            rest = [c for i, c in enumerate(batch.columns) if i != place]
            yield pa.RecordBatch.from_arrays([*rest, pa.array(texts, pa.string())], [*(n for i, n in enumerate(batch.schema.names) if i != place), "text"])

    return run


def extract(pages: DataFrame, html_col: str = "html", keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """`keep` columns of `pages` and text, the main text of the whole page, a row for each row.

    Null and empty html give an empty text; pages and their nesting may be of any size.
    Repeated rows give repeated results. Other columns, whatever their names, are ignored.
    """
    rows = pages.select(*keep, F.col(html_col).cast("string").alias("__html"))
    schema = T.StructType([*rows.schema.fields[:-1], T.StructField("text", T.StringType())])
    return rows.mapInArrow(_extract(len(keep)), schema)
