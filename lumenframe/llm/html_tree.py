"""A tolerant HTML reader: tags to a tree of elements with their pieces of text in page order."""

from __future__ import annotations

import re
from bisect import bisect_right
from html import unescape

#: Fixed values of HTML: elements without content, with raw text, and those that stand as blocks.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
BLOCK = frozenset(
    "address article aside blockquote body br button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "head header hgroup hr html legend li main menu nav ol optgroup option p pre section select summary table tbody td textarea tfoot th thead title tr ul".split()
)
#: An opening tag ends these open elements, up to one of the holders.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "option": ({"option"}, {"select"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"tbody", "thead", "tr", "td", "th"}, {"table"}), "thead": ({"tbody", "tr", "td", "th"}, {"table"}), "tfoot": ({"tbody", "thead", "tr", "td", "th"}, {"table"}),
}
ENDS_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section summary table ul".split()
)
#: All that can stand in a head; another opening tag ends it.
IN_HEAD = frozenset("base basefont bgsound link meta noframes noscript script style template title".split())
SCOPE = frozenset("html body div article section aside main nav header footer td th li blockquote button form figure table dd".split())

_TAG = re.compile(r"<(/?)([A-Za-z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>")
_ATTR = re.compile(r"([^\s=\"'/>]+)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")


class Tree:
    """Elements by number; parents come before their children. text: (element, text, starts a block) in page order."""

    __slots__ = ("tag", "parent", "attrs", "text")

    def __init__(self):
        self.tag, self.parent, self.attrs, self.text = ["#page"], [-1], [""], []


def attributes(source: str) -> dict[str, str]:
    return {m[1].lower(): unescape(m[2] or m[3] or m[4] or "") for m in _ATTR.finditer(source)}


class _Open:
    """The open elements, with the depths of each name and of those that end a search, so that no tag looks through them."""

    def __init__(self):
        self.tags, self.elements = ["#page"], [0]
        self.depths: dict[str, list[int]] = {}
        self.scopes, self.bodies = [0], []

    def push(self, tag: str, element: int) -> None:
        depth = len(self.tags)
        self.tags.append(tag)
        self.elements.append(element)
        self.depths.setdefault(tag, []).append(depth)
        if tag in SCOPE:
            self.scopes.append(depth)
        if tag != "head" and (tag not in IN_HEAD or tag == "template"):
            self.bodies.append(depth)

    def cut(self, depth: int) -> None:
        """End the elements from this depth on."""
        for tag in self.tags[depth:]:
            self.depths[tag].pop()
        del self.tags[depth:], self.elements[depth:]
        for stack in (self.scopes, self.bodies):
            while stack and stack[-1] >= depth:
                stack.pop()

    def last(self, tag: str) -> int:
        """Depth of the innermost open element of a name, 0 if there is none."""
        found = self.depths.get(tag)
        return found[-1] if found else 0

    def opening(self, tag: str) -> None:
        """End what an opening tag ends."""
        if tag not in IN_HEAD and tag != "head":
            head = self.last("head")
            if head and (not self.bodies or self.bodies[-1] < head):
                self.cut(head)
        if tag in CLOSES:
            ends, hold = CLOSES[tag]
            holder = max(self.last(t) for t in hold)
            first = [d[i] for t in ends if (d := self.depths.get(t)) and (i := bisect_right(d, holder)) < len(d)]
            if first:
                self.cut(min(first))
        if tag in ENDS_P:
            p = self.last("p")
            if p and p > self.scopes[-1]:
                self.cut(p)

    def closing(self, tag: str) -> None:
        """End the innermost element of a name; an inline one does not reach across an element of SCOPE."""
        depth = self.last(tag)
        if depth and (tag in BLOCK or depth >= self.scopes[-1]):
            self.cut(depth)


def parse(html: str) -> Tree:
    """Never fails, in time linear in the page: stray end tags are passed over, and what is left open ends with the page."""
    tree = Tree()
    tag, parent, attrs, text = tree.tag, tree.parent, tree.attrs, tree.text
    open_, at, n, fresh = _Open(), 0, len(html), True
    find = html.find

    def say(piece: str, element: int | None = None):
        nonlocal fresh
        if piece:
            text.append((open_.elements[-1] if element is None else element, unescape(piece) if "&" in piece else piece, fresh))
            fresh = False

    while at < n:
        lt = find("<", at)
        if lt < 0:
            say(html[at:])
            break
        if lt > at:
            say(html[at:lt])
        nxt = html[lt + 1 : lt + 2]
        if nxt == "!" or nxt == "?":
            if html.startswith("<!--", lt):
                end = find("-->", lt + 4)
                at = n if end < 0 else end + 3
            elif html.startswith("<![CDATA[", lt):
                end = find("]]>", lt)
                say(html[lt + 9 : n if end < 0 else end])
                at = n if end < 0 else end + 3
            else:
                end = find(">", lt)
                at = n if end < 0 else end + 1
            continue
        m = _TAG.match(html, lt)
        if not m:
            if nxt.isalpha() or nxt == "/":  # a broken tag: up to the next ">"
                end = find(">", lt)
                at = n if end < 0 else end + 1
            else:
                say("<")
                at = lt + 1
            continue
        at = m.end()
        name = m[2].lower()
        if m[1]:
            if name == "p" or name in BLOCK:
                fresh = True
            open_.closing(name)
            continue
        open_.opening(name)
        if name in BLOCK:
            fresh = True
        if name in VOID:
            continue
        tag.append(name)
        parent.append(open_.elements[-1])
        attrs.append(m[3])
        if name in RAW:
            end = re.compile(f"</{re.escape(name)}(?=[\\s/>])", re.I).search(html, at)
            if name == "title" or name == "textarea":
                say(html[at : end.start() if end else n], len(tag) - 1)
                fresh = True
            close = find(">", end.start()) if end else -1
            at = n if close < 0 else close + 1
        elif not m[3].endswith("/") or name in ("p", "div", "span", "a", "li"):
            open_.push(name, len(tag) - 1)
    return tree
