"""Main text of pages by tag-path ratios.

A page is read into blocks: runs of text between block-level tags, each under
its path from root to leaf (tag names).  For each path of the page the
text length and the punctuation, both without link text, are summed and
divided by the number of blocks.  Both ratios are smoothed over the order in
which paths first occur, fused by multiplication, and paths whose fused score
reaches a share of the page's deviation are content, unless nearly all their text is links.  What they choose decides: around
the best of them the smallest element that holds most of the chosen text is the content region, widened to the article or main
element around it if there is one.  The chosen blocks are the result, wherever they lie, and so are the region's other blocks
but for link lists, so that a short paragraph or a heading in the midst isn't lost.  Beside a long article, short ones are teasers and left out.

Elements that are never main text (menus, page headers and footers, sidebars,
forms, scripts, styles, and elements whose class, id or role names a notice,
an advert, comments and the like) are left out before anything is counted.  Inside an article or main element
only a whole class or role of the stronger of these names counts, not a part of a name.

Each element knows the number of its path, of its parent's number and its own name, and sums over subtrees go from the last
element to the first, so that a page's cost grows with its length, however deep it is nested.

Defined cases: null or empty html, and html without text, give an empty string;
markup may be cut off or nested wrongly; text without any tag is one block;
control and repeated white space in a block is one space; repeated rows and
null ids or urls pass through; an empty table gives an empty result.  Only the
named columns are read.
"""

from __future__ import annotations

import html
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from martflow.llm.flat import map_texts

#: Share of the deviation of the fused scores that a content path has to reach.
SHARE = 0.5
#: Share of link text over which a path is a menu; of the longest article's text under which another is a teaser;
#: of the content paths' text that the content region has to hold.
LINKED = 0.8
TEASER = 0.1
REGION_SHARE = 0.8
#: Weights of a path's neighbours, itself in the middle, in the smoothing.
KERNEL = np.array([0.1, 0.8, 0.1])

#: Element names of HTML by their role.
DROPPED = frozenset("nav header footer aside form script style noscript template iframe svg object canvas button select textarea head menu dialog video audio".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr b bdi bdo br cite code data del dfn em font i img ins kbd label mark q s samp small span strong strike sub sup time tt u var wbr big acronym center nobr math mi mn mo mrow mtext msup msub msubsup mfrac msqrt mroot mover munder mspace".split())
RAW = frozenset(("script", "style", "noscript", "template", "iframe", "textarea", "title", "xmp"))
REGION = frozenset(("article", "main"))
#: An opening tag closes an open element of the second group, if no element of the third group lies between.
CLOSES = {"li": ({"li"}, {"ul", "ol"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
          "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
          "option": ({"option"}, {"select"})}
CLOSES_P = frozenset("address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split())

_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([A-Za-z][A-Za-z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)|</?[A-Za-z][^>]*(?:>|\Z)", re.S)
_NAMED = re.compile(r"""\b(?:class|id|role|aria-label)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_OWN = re.compile(r"""\b(?:class|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_HIDDEN = re.compile(r"""\bhidden\b(?!\s*=\s*["']?false)|display\s*:\s*none|aria-hidden\s*=\s*["']?true""", re.I)
_UNWANTED = re.compile(r"(?:^|[\s_-])(?:ads?|adverts?|advertisements?|adsense|banners?|sponsor(?:ed|s)?|promos?|promotions?|nav|navbar|navigation|menus?|breadcrumbs?|"
                       r"header|masthead|footer|foot|sidebars?|aside|widgets?|cookies?|consent|gdpr|notices?|alerts?|popups?|modals?|overlay|newsletters?|subscribe|signup|login|"
                       r"comments?|disqus|replies|reply|respond|discussion|share|sharing|social|related|recommended|recommendations|pagination|pager|toolbar|complementary|contentinfo|search)(?:$|[\s_-])", re.I)
#: Names that count inside an article too, as a whole class or role.
_STRONG = frozenset("ad ads advert adverts advertisement advertisements adsense sponsor sponsored promo promotion nav navbar navigation menu breadcrumb breadcrumbs sidebar "
                    "cookie cookies consent gdpr notice newsletter subscribe comments disqus share sharing related recommended pagination pager".split())
_PUNCTUATION = re.compile(r"[.,;:!?…。、，！？；：؟]")
_SPACE = re.compile(r"\s+")


class _Node:
    """An open or closed element; ``at`` is its number in the page, ``path`` that of its path from the root."""

    __slots__ = ("name", "up", "dropped", "at", "path", "article", "main")

    def __init__(self, name: str, up: "_Node | None", dropped: bool, at: int = 0, path: int = 0):
        self.name, self.up, self.dropped, self.at, self.path = name, up, dropped, at, path
        # the outermost article, and the outermost main element, that hold it
        self.article = up and up.article or (self if name == "article" else None)
        self.main = up and up.main or (self if name == "main" else None)

    @property
    def region(self) -> "_Node | None":
        return self.article or self.main


def _unwanted(name: str, attributes: str, inside: bool) -> bool:
    if name in DROPPED:
        return True
    if not attributes or name in ("body", "html") or name in REGION:
        return False
    if _HIDDEN.search(re.sub(r"\"[^\"]*\"|'[^']*'", lambda m: m[0] if "none" in m[0] or "true" in m[0] else '""', attributes)):
        return True
    if inside:
        return any(w in _STRONG for m in _OWN.findall(attributes) for w in "".join(m).lower().split())
    # classes joined in camel case count as parted
    return any(_UNWANTED.search(re.sub(r"(?<=[a-z])(?=[A-Z])", "-", "".join(m))) for m in _NAMED.findall(attributes))


def read_blocks(page: str) -> list[tuple[_Node, str, int]]:
    """(element, text, characters of link text) of each block outside unwanted elements."""
    node = root = _Node("", None, False)
    out, parts, linked, at = [], [], 0, 0
    holder, links, made = node, 0, 0
    paths: dict[tuple[int, str], int] = {}
    opened: Counter[str] = Counter()

    def flush():
        nonlocal parts, linked
        if parts:
            text = _SPACE.sub(" ", "".join(parts)).strip()
            if text:
                out.append((holder, text, min(linked, len(text))))
            parts, linked = [], 0

    def add(raw: str):
        nonlocal holder, linked
        if raw and not node.dropped:
            if not parts:
                holder = block_of(node)
            text = html.unescape(raw) if "&" in raw else raw
            parts.append(text)
            linked += len(text.strip()) if links else 0

    def block_of(n: _Node) -> _Node:
        while n.up and n.name in INLINE:
            n = n.up
        return n

    end = len(page)
    while at < end:
        m = _TAG.search(page, at)
        if not m:
            rest = page[at:]
            add(rest)
            break
        add(page[at:m.start()])
        at, name = m.end(), (m[2] or "").lower()
        if not name:
            if m[0].startswith("<![CDATA["):
                add(m[0][9:].removesuffix("]]>").replace("&", "&amp;"))
            continue
        if m[1]:
            found = node if opened[name] else root
            while found.up and found.name != name:
                # a stray end tag of an inline element doesn't close blocks
                if name in INLINE and found.name not in INLINE:
                    break
                found = found.up
            if found.up and found.name == name:
                if name not in INLINE:
                    flush()
                while True:
                    links -= node.name == "a"
                    opened[node.name] -= 1
                    if node is found:
                        node = node.up
                        break
                    node = node.up
            elif name not in INLINE:
                flush()
            continue
        attributes = m[3] or ""
        if name == "br":
            add(" ")
            continue
        if name not in INLINE:
            flush()
        if name in CLOSES_P or name in CLOSES:
            shut, bar = CLOSES.get(name, ({"p"}, ()))
            walk = node if any(opened[x] for x in shut) else root
            while walk.up and walk.name not in bar and (walk.name in INLINE or walk.name in shut):
                if walk.name in shut:
                    while True:
                        links -= node.name == "a"
                        opened[node.name] -= 1
                        node, last = node.up, node
                        if last is walk:
                            break
                    break
                walk = walk.up
        if name in VOID or attributes.endswith("/") and name not in INLINE | {"p", "div", "li"}:
            continue
        if name in RAW:
            close = re.compile(rf"</{name}\s*>", re.I).search(page, at)
            if name == "title" or name in DROPPED or name == "xmp":
                at = close.end() if close else end
                continue
        made += 1
        path = paths.setdefault((node.path, name), len(paths) + 1)
        node = _Node(name, node, node.dropped or _unwanted(name, attributes, node.region is not None), made, path)
        links += name == "a"
        opened[name] += 1
    flush()
    return out


def path_scores(blocks: list[tuple[_Node, str, int]]) -> dict[int, float]:
    """Fused, smoothed ratio of text and punctuation of each path."""
    length, marks, count = {}, {}, {}
    for node, text, linked in blocks:
        p = node.path
        own = len(text) - linked
        length[p] = length.get(p, 0) + own
        marks[p] = marks.get(p, 0) + (len(_PUNCTUATION.findall(text)) if own else 0)
        count[p] = count.get(p, 0) + 1
    ratio = lambda x: np.convolve(np.pad([x[p] / count[p] for p in count], 1, mode="edge"), KERNEL, mode="valid")
    return dict(zip(count, ratio(length) * (1 + ratio(marks))))


def _subtrees(nodes: dict[int, _Node], weight: dict[int, int]) -> tuple[dict[int, int], dict[int, int]]:
    """Of every element the weights of its subtree, and the last element in it."""
    total, last = dict.fromkeys(nodes, 0), {k: k for k in nodes}
    for k in sorted(nodes, reverse=True):  # an element comes after those that hold it
        total[k] += weight.get(k, 0)
        if nodes[k].up:
            up = nodes[k].up.at
            total[up] += total[k]
            last[up] = max(last[up], last[k])
    return total, last


def _with_holders(blocks: list[tuple[_Node, str, int]]) -> dict[int, _Node]:
    nodes: dict[int, _Node] = {}
    for node, _, _ in blocks:
        while node and node.at not in nodes:
            nodes[node.at] = node
            node = node.up
    return nodes


def content(page: str | None) -> str:
    """The main text: kept blocks, white space evened, joined by two line feeds."""
    blocks = read_blocks(page or "")
    if not blocks:
        return ""
    scores = path_scores(blocks)
    least = SHARE * np.fromiter(scores.values(), float, len(scores)).std()
    linked = {}
    for node, text, k in blocks:
        all_text, link_text = linked.get(node.path, (0, 0))
        linked[node.path] = all_text + len(text), link_text + k
    menu = {p for p, (n, k) in linked.items() if k > LINKED * n}
    articles = {}
    for node, text, k in blocks:
        if node.article:
            articles[node.article] = articles.get(node.article, 0) + len(text) - k
    teasers = {a for a, n in articles.items() if n < TEASER * max(articles.values())}
    chosen = [scores[n.path] >= least and n.path not in menu and n.article not in teasers for n, _, _ in blocks]
    if not any(chosen):
        return ""
    weight = {}
    for (node, text, k), c in zip(blocks, chosen):
        if c:
            weight[node.at] = weight.get(node.at, 0) + len(text) - k
    own, last = _subtrees(_with_holders(blocks), weight)
    best = max((i for i, c in enumerate(chosen) if c), key=lambda i: (scores[blocks[i][0].path], len(blocks[i][1])))
    top = first = blocks[best][0]
    while top.up and own[top.at] < REGION_SHARE * own[0]:
        top = top.up
    if top is first and top.up:
        top = top.up
    top = top.region or top
    inside = [top.at <= n.at <= last[top.at] and n.path not in menu and n.article not in teasers for n, _, _ in blocks]
    return "\n\n".join(t for (_, t, _), c, x in zip(blocks, chosen, inside) if c or x)


def main_text(pages: DataFrame, page: str = "page_id", url: str = "url", source: str = "html") -> DataFrame:
    """page_id, url, text and n_chars of every row of ``pages``."""
    fields = [T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())]

    def make():
        def work(pages):
            texts = [content(p) for p in pages]
            return [pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]

        return work

    return map_texts(pages, make, fields, source, [page, url])
