"""A small tolerant HTML reader: block nodes and runs of text, as arrays."""

from __future__ import annotations

import html
import re
from dataclasses import dataclass, field

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<close>/?)(?P<tag>[a-zA-Z][a-zA-Z0-9:-]*)(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)",
    re.S,
)
ATTR = re.compile(r"([a-zA-Z_:@][\w:.@-]*)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
PART = re.compile(r"[a-z]+|\d+")
CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Their content is no text of the page.
SKIPPED = frozenset("script style template iframe canvas head title textarea select datalist audio video annotation annotation-xml desc metadata".split())
#: Of these nothing is shown, not even a space.
UNSEEN = frozenset("script style template head title annotation annotation-xml desc metadata".split())
#: Of these the content is not read as markup.
RAW = frozenset("script style textarea title iframe".split())
#: Where another element starts, an open head ends.
IN_HEAD = frozenset("base basefont bgsound link meta noscript script style template title".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup "
    "time tt u var wbr br img input button output meter progress picture source nobr "
    "math semantics mi mn mo mrow ms mspace mtext mfrac mroot msqrt msub msup msubsup mover munder munderover mfenced menclose mpadded mphantom mstyle "
    "svg g text tspan textpath defs use symbol path rect circle ellipse line polyline polygon object noscript".split()
)
#: An open element of the left kind ends where an element of the right kind starts.
ENDS = {
    "p": frozenset(
        "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header "
        "hgroup hr main menu nav ol p pre section table ul".split()
    ),
    "li": frozenset(["li"]),
    "dt": frozenset(["dt", "dd"]),
    "dd": frozenset(["dt", "dd"]),
    "tr": frozenset(["tr", "tbody", "thead", "tfoot"]),
    "td": frozenset(["td", "th", "tr", "tbody", "tfoot"]),
    "th": frozenset(["td", "th", "tr", "tbody", "tfoot"]),
    "option": frozenset(["option", "optgroup"]),
}
#: The elements that a start tag can end.
ENDED: dict[str, tuple[str, ...]] = {}
for _open, _starts in ENDS.items():
    for _start in _starts:
        ENDED[_start] = (*ENDED.get(_start, ()), _open)
#: An element isn't ended through one of these.
SCOPE = frozenset("table td th ul ol dl body html".split())


@dataclass
class Node:
    tag: str
    parent: int
    depth: int
    tokens: frozenset[str] = frozenset()
    hidden: bool = False
    children: list[int] = field(default_factory=list)
    #: Of a run of text: its raw pieces, the block it belongs to, its characters and those of them within links.
    text: str = ""
    block: int = -1
    linked: int = 0
    inputs: int = 0


def attributes(text: str) -> dict[str, str]:
    return {m[1].lower(): html.unescape(m[2] or m[3] or m[4] or "") for m in ATTR.finditer(text)} if text and not text.isspace() else {}


def attribute_tokens(attrs: dict[str, str]) -> frozenset[str]:
    found = " ".join(CAMEL.sub(" ", attrs[k]) for k in ("class", "id", "role", "itemprop", "aria-label", "data-role") if k in attrs)
    return frozenset(PART.findall(found.lower()))


class _Open:
    """The open elements, with what is asked of them kept at hand: their places by tag, scopes and nodes."""

    def __init__(self):
        self.tags: list[str] = ["#root"]
        self.numbers: list[int] = [0]
        self.places: dict[str, list[int]] = {}
        self.scopes: list[int] = []  # places of scopes, bodies left out
        self.owners: list[int] = [0]  # numbers of the nodes among them
        self.links = 0

    def push(self, tag: str, number: int) -> None:
        self.places.setdefault(tag, []).append(len(self.tags))
        if tag in SCOPE and tag != "body":
            self.scopes.append(len(self.tags))
        self.tags.append(tag)
        self.numbers.append(number)
        if number >= 0:
            self.owners.append(number)
        self.links += tag == "a"

    def pop(self) -> tuple[str, int]:
        tag, number = self.tags.pop(), self.numbers.pop()
        self.places[tag].pop()
        if self.scopes and self.scopes[-1] == len(self.tags):
            self.scopes.pop()
        if number >= 0:
            self.owners.pop()
        self.links -= tag == "a"
        return tag, number

    def last(self, tag: str) -> int:
        """The place of the innermost open element of that tag, or 0."""
        places = self.places.get(tag)
        return places[-1] if places else 0

    def scope(self) -> int:
        return self.scopes[-1] if self.scopes else 0


def parse(source: str) -> list[Node]:
    """Nodes in page order; the first is the root. Runs of text have the tag ``#text`` and no children.

    An inline element without telling attributes has no node and cuts no run. The time is linear in the page, however
    deep it is nested.
    """
    nodes = [Node("#root", -1, 0)]
    opened = _Open()
    block = 0
    skip, inside = "", {}  # the skipped element, and what is open within it
    pieces: list[tuple[str, bool]] = []

    def flush() -> None:
        if pieces:
            text = "".join(t for t, _ in pieces)
            if text and not text.isspace():
                at = opened.owners[-1]
                linked = sum(len("".join(t.split())) for t, within in pieces if within)
                nodes[at].children.append(len(nodes))
                nodes.append(Node("#text", at, nodes[at].depth + 1, text=text, block=block, linked=linked))
            elif text and nodes[-1].tag == "#text" and nodes[-1].block == block:
                nodes[-1].text += " "
            pieces.clear()

    def close(at: int) -> None:
        nonlocal block
        while len(opened.tags) > at:
            if opened.numbers[-1] >= 0:
                flush()
            tag, number = opened.pop()
            if number >= 0 and nodes[number].tag not in INLINE:
                block += 1

    last = 0
    for m in TOKEN.finditer(source):
        if m.start() < last:
            continue
        if not skip and m.start() > last:
            pieces.append((html.unescape(source[last : m.start()]), opened.links > 0))
        last = m.end()
        tag = (m["tag"] or "").lower()
        if not tag:
            continue
        ending = bool(m["close"])
        if skip:
            over = False
            if skip == "head":
                over = ending and tag == "head"
                if over or not ending and tag not in IN_HEAD and tag != "head":
                    skip = ""
            elif ending:
                if inside.get(tag):
                    inside[tag] -= 1
                elif tag == skip:
                    skip, over = "", True
                elif opened.last(tag):  # an outer element ends, and with it the skipped one
                    skip = ""
                else:
                    continue
            elif tag not in VOID:
                inside[tag] = inside.get(tag, 0) + 1
            if skip:
                if not ending and tag in RAW:
                    end = re.compile(rf"</{tag}\s*>?", re.I).search(source, last)
                    last = end.end() if end else len(source)
                    inside.pop(tag, None)
                continue
            if over:
                continue
        if ending:
            if tag == "br":
                pieces.append((" ", False))
                continue
            at = opened.last(tag)
            # An inline element isn't ended through a list or table.
            if at and not (tag in INLINE and opened.scope() > at):
                close(at)
            continue
        if tag in SKIPPED:
            if tag not in UNSEEN:
                pieces.append((" ", False))
            nodes[opened.owners[-1]].inputs += tag in ("textarea", "select")
            if not m["attrs"].rstrip().endswith("/"):
                if tag in RAW:
                    end = re.compile(rf"</{tag}\s*>?", re.I).search(source, last)
                    last = end.end() if end else len(source)
                else:
                    skip, inside = tag, {}
            continue
        if tag in VOID:
            if tag in ("br", "hr"):
                pieces.append((" ", False))
            if tag == "hr":
                flush()
                block += 1
            nodes[opened.owners[-1]].inputs += tag == "input"
            continue
        attrs = attributes(m["attrs"])
        tokens = attribute_tokens(attrs)
        if tag not in INLINE:
            at = max((opened.last(t) for t in ENDED.get(tag, ())), default=0)
            if at and at >= opened.scope():
                close(at)
            flush()
            block += 1
        elif tokens:
            flush()
        if tag == "button":
            nodes[opened.owners[-1]].inputs += 1
        if m["attrs"].endswith("/") and tag in INLINE:
            continue  # as of <path/> in a drawing
        if tag in INLINE and not tokens and not _hides(attrs):
            opened.push(tag, -1)
        else:
            if tag in INLINE:
                flush()
            at = opened.owners[-1]
            nodes[at].children.append(len(nodes))
            opened.push(tag, len(nodes))
            nodes.append(Node(tag, at, nodes[at].depth + 1, tokens, _hides(attrs)))
    if not skip and last < len(source):
        pieces.append((html.unescape(source[last:]), opened.links > 0))
    flush()
    return nodes


def _hides(attrs: dict[str, str]) -> bool:
    if not attrs:
        return False
    style = attrs.get("style", "").replace(" ", "").lower()
    return "hidden" in attrs or "display:none" in style or "visibility:hidden" in style or attrs.get("aria-hidden") == "true"
