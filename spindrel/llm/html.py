"""Main text of web pages by tree scoring.

A page is read into a tree that forgives unclosed and stray tags. Blocks pass points for
length and commas to their parents, half of them to the grandparent, and so on; a
container's sum is discounted by its link density, and weighs more for an article or main.
The best container is kept, and those siblings, its own and its ancestors', that score
close to it or read like text. Elements that say what they are (menus, headers, footers,
sidebars, notices, adverts, forms, scripts, hidden parts and reader comments) never count;
a name alone says so only of a block, as a whole name (`sidebar`, `site-header`, not
`social-history`), and where the element does not hold the article or most points.
Every step is one pass over the nodes, whatever their depth.
"""

from __future__ import annotations

import html as entities
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import prepare

_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style textarea title noscript template iframe xmp noembed noframes".split())
_BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "head header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
_SKIP = frozenset("nav footer aside form fieldset menu select option button dialog head title textarea script style noscript template iframe svg canvas audio video object embed applet xmp noembed noframes".split())
_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar toolbar form".split())
_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promoted banner cookie cookies consent gdpr notice notices notification alert popup modal overlay "
    "comment comments disqus reply replies respond nav navbar navigation menu menus breadcrumb breadcrumbs pagination pager sidebar sidebars aside rail footer header masthead topbar "
    "toolbar share sharing social related recommended recommendations newsletter subscribe subscription signup login search widget widgets skip hidden".split()
)
#: Words that may stand beside those names without making them something else.
_BESIDE = frozenset(
    "area articles bar bars block blocks bottom box boxes button buttons container content feed form global group icon icons inner item items left link links list lists main outer page panel "
    "post posts primary right row secondary section site slot small stories sticky tags text title top unit user users wrap wrapper".split()
)
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: An open element of the key's name ends where one of these opens.
_ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "tbody", "tfoot"}, "td": {"td", "th", "tr"}, "th": {"td", "th", "tr"}, "option": {"option"}}
_NAME = re.compile(r"[a-zA-Z][^\s/>]*")
_REST = re.compile(r"""(?:[^>"']++|"[^"]*+"|'[^']*+')*+>""")
_ATTR = re.compile(r"""([a-zA-Z_:][-\w:.]*)\s*(?:=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
_PARTS = re.compile(r"[^a-z0-9]+")
_CLOSE = {name: re.compile(rf"</{name}(?=[\s/>]|$)", re.IGNORECASE) for name in _RAW}


class _Node:
    __slots__ = ("block", "chars", "holds", "kept", "kids", "links", "named", "parent", "points", "score", "skip", "tag", "within")

    def __init__(self, tag, parent, skip, within, named=False):
        self.tag, self.parent, self.skip, self.within, self.named = tag, parent, skip, within, named
        self.block = self if parent is None or tag in _BLOCK else parent.block
        self.kids: list = []
        self.score, self.points, self.chars, self.links, self.holds, self.kept = 0.0, 0.0, 0, 0, False, False

    @property
    def density(self) -> float:
        return self.links / self.chars if self.chars else 1.0

    @property
    def worth(self) -> float:
        strong = self.chars and self.tag in ("article", "main")
        return (self.score * (3 if strong else 1) + (10 if strong else 0)) * (1 - self.density)


def _says_so(name: str) -> bool:
    """Whether a class or id names a part of a page that is no article."""
    parts = [w for w in _PARTS.split(name) if w and not w.isdigit()]
    return any(w in _NAMES for w in parts) and all(w in _NAMES or w in _BESIDE for w in parts)


def _skipped(tag: str, attrs: str, within: bool) -> bool | None:
    """Whether an element never counts; None if only its name says so."""
    if tag in _SKIP or (tag == "header" and not within):
        return True
    if not attrs.strip(" /\t\r\n"):
        return False
    found = {k.lower(): (v or "").strip("\"'") for k, v in _ATTR.findall(attrs)}
    if "hidden" in found or found.get("aria-hidden", "").lower() == "true" or re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", found.get("style", ""), re.IGNORECASE):
        return True
    if found.get("role", "").lower() in _ROLES:
        return True
    if tag in ("html", "body", "article", "main"):
        return False
    if tag not in _BLOCK or tag in _HEADINGS or (tag == "header" and within):
        return False
    return None if any(_says_so(name) for k in ("class", "id") for name in found.get(k, "").lower().split()) else False


def _tree(page: str):
    """(nodes, blocks), both in page order: a block is (node, its pieces), a piece (node,
    text, whether in a link)."""
    root = _Node("", None, False, False)
    nodes, stack, open_tags = [root], [root], {}
    since: list[dict[str, int]] = [{}]  # inline elements open since each open block
    anchors: list[tuple[_Node, dict[str, int]]] = []  # open links, and where they are counted
    blocks: list[tuple[_Node, list]] = []
    run: list[tuple[_Node, str, bool]] = []

    def flush():
        if run:
            blocks.append((stack[-1].block, run.copy()))
            run.clear()

    def pop():
        node = stack.pop()
        open_tags[node.tag] -= 1
        if node.tag in _BLOCK:
            since.pop()
        else:
            since[-1][node.tag] -= 1
        if anchors and anchors[-1][0] is node:
            anchors.pop()
        return node.tag

    def add(text):
        if not stack[-1].skip:
            run.append((stack[-1], entities.unescape(text), bool(open_tags.get("a"))))

    at, n = 0, len(page)
    while at < n:
        lt = page.find("<", at)
        if lt < 0:
            add(page[at:])
            break
        if lt > at:
            add(page[at:lt])
        at = lt
        if page.startswith("<!--", at):
            end = page.find("-->", at + 4)
            at = n if end < 0 else end + 3
        elif page[at + 1 : at + 2] in ("!", "?"):
            end = page.find(">", at)
            at = n if end < 0 else end + 1
        elif page.startswith("</", at) and (m := _NAME.match(page, at + 2)):
            end = page.find(">", m.end())
            at = n if end < 0 else end + 1
            tag = m[0].lower()
            if tag in _BLOCK:
                flush()
            if tag == "br":
                add(" ")
            if open_tags.get(tag):
                if tag == "a" or tag not in _BLOCK:
                    # an inline end doesn't close blocks that opened inside
                    if since[-1].get(tag):
                        while pop() != tag:
                            pass
                    elif tag == "a":  # the links around open blocks end, their elements stay open
                        for x, count in anchors:
                            x.tag = "span"
                            count["a"] -= 1
                            count["span"] = count.get("span", 0) + 1
                            open_tags["span"] = open_tags.get("span", 0) + 1
                        anchors.clear()
                        open_tags["a"] = 0
                else:
                    while pop() != tag:
                        pass
        elif m := _NAME.match(page, at + 1):
            tag = m[0].lower()
            r = _REST.match(page, m.end())
            end = r.end() if r else page.find(">", m.end()) + 1
            if not end:
                break  # the page ends inside a tag
            attrs = page[m.end() : end - 1]
            at = end
            if tag == "br":
                add(" ")
                continue
            if tag in _BLOCK:
                flush()
            if tag in _VOID:
                continue
            if tag in _BLOCK and tag != "body" and open_tags.get("p"):
                while pop() != "p":
                    pass
            for name, ends in _ENDS.items():
                if tag in ends and stack[-1].tag == name:
                    pop()
            if tag == "a" and open_tags.get("a"):
                while stack[-1].tag != "a" and stack[-1].tag not in _BLOCK:
                    pop()
                if stack[-1].tag == "a":
                    pop()
            parent = stack[-1]
            within = parent.within or tag in ("article", "main")
            if tag in _RAW:
                c = _CLOSE[tag].search(page, at)
                at = c.start() if c else n
                if c:
                    end = page.find(">", at)
                    at = n if end < 0 else end + 1
                continue
            if attrs.endswith("/") and tag not in _BLOCK:
                continue
            skip = _skipped(tag, attrs, parent.within)
            node = _Node(tag, parent, parent.skip or bool(skip), within, skip is None)
            parent.kids.append(node)
            nodes.append(node)
            stack.append(node)
            open_tags[tag] = open_tags.get(tag, 0) + 1
            if tag in _BLOCK:
                since.append({})
            else:
                since[-1][tag] = since[-1].get(tag, 0) + 1
                if tag == "a":
                    anchors.append((node, since[-1]))
        else:
            add("<")
            at += 1
    flush()
    return nodes, blocks


def _read(pieces) -> tuple[str, int]:
    """The text of a block's pieces that are not skipped, and its characters in links."""
    text = " ".join("".join(t for x, t, _ in pieces if not x.skip).split())
    return text, min(len(text), sum(len(" ".join(t.split())) for x, t, a in pieces if a and not x.skip))


def points(tag: str, text: str) -> float:
    """What a block is worth to its parent."""
    n = len(text)
    return min(1.0, n / 25) * (1 + text.count(",") + min(n / 100, 3)) * (0.2 if tag in _HEADINGS else 1)


def _measure(nodes, blocks) -> list[tuple[_Node, str]]:
    """Points, characters and link characters of every node, and the blocks with text."""
    for x in nodes:
        x.score, x.points, x.chars, x.links = 0.0, 0.0, 0, 0
    out = []
    for node, pieces in blocks:
        text, links = _read(pieces)
        if text:
            out.append((node, text))
            node.points += points(node.tag, text) * (1 - links / len(text))
            node.chars += len(text)
            node.links += links
    for x in reversed(nodes):
        up = x.parent
        if up is not None:
            up.score += x.points + x.score / 2
            up.chars += x.chars
            up.links += x.links
    return out


def _skip_named(nodes, blocks) -> None:
    """Skips elements for their name, unless they hold an article or main with text, or
    more than half of the page's points."""
    total = 0.0
    around: dict[int, float] = {}  # points of the blocks below a node
    _measure(nodes, blocks)
    for x in reversed(nodes):
        up = x.parent
        total += x.points
        if up is not None:
            around[id(up)] = around.get(id(up), 0.0) + x.points + around.get(id(x), 0.0)
            up.holds = up.holds or x.holds or bool(x.chars and x.tag in ("article", "main"))
    for x in nodes:  # parents first
        x.skip = x.skip or (x.parent is not None and x.parent.skip) or (x.named and not x.holds and around.get(id(x), 0.0) <= total / 2)


def main_text(page: str | None) -> str:
    """The page's article: its blocks in page order, joined by an empty line."""
    if not page:
        return ""
    nodes, blocks = _tree(page)
    if any(x.named for x in nodes):
        _skip_named(nodes, blocks)
    read = _measure(nodes, blocks)
    best = max((x for x in nodes if x.chars), key=lambda x: x.worth, default=nodes[0])
    while best.tag in ("", "html") and (inner := next((x for x in best.kids if x.tag in ("html", "body") and x.chars == best.chars), None)):
        best = inner
    if best.tag in ("", "html", "body"):  # nothing is around it: what is mostly links goes
        for x in best.kids:
            x.kept = x.density <= 0.5 or x.tag in _HEADINGS
        own = best
    else:
        best.kept, own = True, None
    least, x = max(10.0, 0.2 * best.worth), best
    while x.parent is not None:
        near = x is best or x.parent.within or x.parent.tag in ("article", "main")
        for s in x.parent.kids:
            if s is not x and s.chars and (s.worth >= least or (near and (s.density < 0.25 or s.tag in _HEADINGS))):
                s.kept = True
        x = x.parent
    for x in nodes:
        x.kept = x.kept or (x.parent is not None and x.parent.kept)
    above = set()  # text straight inside an ancestor that is part of the article
    x = best.parent
    while x is not None and (x is best.parent or x.within or x.tag in ("article", "main")) and x.tag not in ("", "html", "body"):
        above.add(id(x))
        x = x.parent
    return "\n\n".join(t for node, t in read if node.kept or node is own or id(node) in above)


def _extracted(batches):
    for batch in batches:
        texts = [main_text(h) for h in batch["html"].to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch["page_id"], batch["url"], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"]
        )


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of every row of `pages` (page_id, url, html).

    A null or empty page, or one without text, has the empty text. Repeated rows give
    equal rows; null ids and urls stay null. Other columns are ignored; an empty table
    gives an empty result."""
    prepare(pages.sparkSession)
    pages = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    return pages.mapInArrow(_extracted, "page_id long, url string, text string, n_chars long")
