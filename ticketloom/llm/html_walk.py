"""A tolerant walk over a page's markup: blocks of text, each with the path of the elements around it."""

from __future__ import annotations

import html
import re
from collections import defaultdict
from collections.abc import Callable, Iterator

PIECE = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*)>""", re.S)
#: Behind a page's last ">" no tag can end, so only these are looked for.
OPEN_ENDED = re.compile(r"<!--.*|<[!?][^>]*", re.S)
ATTRIBUTE = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp noframes noembed iframe".split())
BLOCK = frozenset("""address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure footer
form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre section select summary table tbody td textarea tfoot th thead title tr ul""".split())
#: An element of the first kind ends open ones of the second, up to the nearest of the third.
ENDS = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"})}
CONTAINERS = frozenset("div section td table".split())
CLOSED_BY_BLOCKS = frozenset("button td article section div body table li blockquote".split())
#: Of each element that ends others: which, and what ends the search for them.
CLOSES = {t: ((ENDS[t][0] | {"p"} if t in BLOCK else ENDS[t][0], ENDS[t][1] - ENDS[t][0]) if t in ENDS else (frozenset({"p"}), CLOSED_BY_BLOCKS)) for t in BLOCK | set(ENDS)}
#: All elements deeper in an element count as one, or as two: those in menus and the like, and the others.
DEPTH = 100


class Node:
    """An open element: its path and the children seen so far."""

    __slots__ = ("children", "depth", "path", "tag")

    def __init__(self, tag: str, path: str, depth: int):
        self.tag, self.path, self.depth, self.children = tag, path, depth, {}


class Stack:
    """The open elements, with the places of each tag and of all blocks, so that no tag searches through them."""

    def __init__(self):
        self.nodes, self.at, self.blocks = [Node("", "", 0)], defaultdict(list), []

    @property
    def top(self) -> Node:
        return self.nodes[-1]

    def nearest(self, tags) -> int:
        """The innermost open element of these tags; 0: none is open."""
        return max((self.at[t][-1] for t in tags if self.at[t]), default=0)

    def push(self, node: Node) -> None:
        self.at[node.tag].append(len(self.nodes))
        if node.tag in BLOCK:
            self.blocks.append(len(self.nodes))
        self.nodes.append(node)

    def close(self, place: int) -> None:
        while len(self.nodes) > place:
            tag = self.nodes.pop().tag
            self.at[tag].pop()
            if tag in BLOCK:
                self.blocks.pop()


def label_of(tag: str, attributes: str) -> str:
    """Name, id, classes and role; digits are one letter, so numbered ids are one token."""
    if not attributes.strip():
        return tag
    found = {k.lower(): a or b or c for k, a, b, c in ATTRIBUTE.findall(attributes)}
    marks = "".join("#" + w for w in found.get("id", "").split()) + "".join("." + w for w in sorted(found.get("class", "").split())) + "".join("@" + w for w in found.get("role", "").split())
    return tag + re.sub(r"[0-9]+", "N", marks.lower()).replace("/", "_")


def _child_path(parent: Node, label: str, is_side: Callable[[str], bool]) -> str:
    if parent.depth < DEPTH:
        return f"{parent.path}/{label}"
    base, _, step = (parent.path, "", "") if parent.depth == DEPTH else parent.path.rpartition("/")
    side = step == "aside" or is_side(("/article/" if "/article" in base else "/") + label)
    return f"{base}/{'aside' if side else '~'}"


def walk(page: str, is_side: Callable[[str], bool] = lambda path: False) -> Iterator[tuple[str, str, str, bool]]:
    """("open", path, "", False) for each element and ("text", path, text, inside a link) for each run of text.

    ("break", path, "", False) stands between blocks. Character references are decoded; unclosed and stray tags are
    taken as browsers do, roughly: a block ends an open paragraph, an end tag ends what is open inside it. The work is
    linear in the page, however deep it nests; ``is_side`` tells what lies in menus and the like below ``DEPTH``.
    """
    stack, last = Stack(), page.rfind(">")
    at, raw_end = 0, None

    def text(part: str):
        if part:
            yield "text", stack.top.path, html.unescape(part), bool(stack.at["a"])

    while at < len(page):
        if raw_end:
            found = re.compile(rf"</{re.escape(raw_end)}\b[^>]*>?", re.I).search(page, at)
            if raw_end in ("textarea", "title"):
                yield from text(page[at:found.start() if found else len(page)])
            at, raw_end = (found.end() if found else len(page)), None
            stack.close(len(stack.nodes) - 1)
            yield "break", stack.top.path, "", False
            continue
        found = (PIECE if at <= last else OPEN_ENDED).search(page, at)
        yield from text(page[at:found.start() if found else len(page)])
        if not found:
            break
        at = found.end()
        if found.re is OPEN_ENDED or not found.group(2):
            continue
        closing, tag, attributes = found.group(1), found.group(2).lower(), found.group(3)
        if closing:
            place = stack.nearest((tag,))
            if place and (tag in BLOCK or not stack.blocks or place > stack.blocks[-1]):
                stack.close(place)
            if tag in BLOCK:
                yield "break", stack.top.path, "", False
            continue
        if tag == "br":
            yield "text", stack.top.path, " ", False
            continue
        ends, limits = CLOSES.get(tag, ((), ()))
        while (place := stack.nearest(ends)) and place > stack.nearest(limits):
            stack.close(place)
            if tag not in ("tr", "td", "th"):
                break
        parent, label = stack.top, label_of(tag, attributes)
        seen = parent.children[label] = parent.children.get(label, 0) + 1
        if tag in CONTAINERS and label == tag:
            label = f"{label}[{seen}]"
        node = Node(tag, _child_path(parent, label, is_side), min(parent.depth + 1, DEPTH + 1))
        if tag in BLOCK:
            yield "break", parent.path, "", False
        yield "open", node.path, "", False
        if tag in VOID or attributes.endswith("/") and tag not in BLOCK:
            continue
        stack.push(node)
        if tag in RAW:
            raw_end = tag
