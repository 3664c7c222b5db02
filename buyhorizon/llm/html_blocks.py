"""Leaf blocks of an HTML page: runs of text between block boundaries, with their ancestors.

The reader is tolerant as browsers are: unclosed and misnested elements, quoted
``>`` in attributes, unknown tags and pages cut off anywhere are all fine. Time and
memory are linear in the page's size, however deep it nests: a block points to its
innermost element, an element to its parent, and open elements are found by name.
"""

from __future__ import annotations

import html
import re
from typing import NamedTuple

# a tag, else a comment, declaration or processing instruction, else a tag that the page's end cuts off
TOKEN = re.compile(r"""<(?:(/?)([a-zA-Z][^\s/>]*+)(?:((?:"[^"]*"|'[^']*'|[^>"'])*+)>|([^>]*+)>)|!--(?:.*?-->|.*\Z)|[!?][^>]*+(?:>|\Z)|/?[a-zA-Z].*\Z)""", re.S)
ATTRIBUTE = re.compile(r"""\b(class|id|role|style|hidden|aria-hidden)\b(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)
SPLIT = re.compile(r"[^a-z]+")

# fixed values: element names by role in HTML
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is never text of the page.
SILENT = frozenset("script style title template noscript iframe object svg canvas audio video head".split())
RAW = frozenset("script style title textarea iframe noscript".split())
BLOCKS = frozenset(("address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
                    "header hgroup hr html label legend li main menu nav ol optgroup option p pre section select summary table tbody td textarea tfoot th thead tr ul br").split())
CLOSES_P = frozenset(("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main "
                      "menu nav ol p pre section table ul").split())
#: An opening tag ends the open elements named, up to the nearest container named.
ENDS = {"li": ("li", ("ul", "ol", "menu", "dir")), "dt": ("dt dd", ("dl",)), "dd": ("dt dd", ("dl",)), "tr": ("tr td th", ("table",)), "td": ("td th", ("tr", "table")),
        "th": ("td th", ("tr", "table")), "option": ("option", ("select",)), "tbody": ("tbody thead tfoot tr td th", ("table",))}


#: A closing tag that finds more inline elements than this inside its element ends them, too.
INLINE = 512


class Element:
    """An open element: its tag, the words of class, id and role, its parent, and which of its features no ancestor has."""

    __slots__ = ("tag", "words", "parent", "new", "score")

    def __init__(self, tag: str, words: tuple[str, ...], parent: Element | None, new: tuple[str, ...]):
        self.tag, self.words, self.parent, self.new, self.score = tag, words, parent, new, None


class Block(NamedTuple):
    text: str
    path: Element | None  # the innermost ancestor
    linked: int  # characters inside links


def ancestors(path: Element | None) -> list[str]:
    """The ancestors, outermost first: "tag word word"."""
    out = []
    while path is not None:
        out.append(" ".join([path.tag, *path.words]))
        path = path.parent
    return out[::-1]


class _Open:
    """The open elements, found by position or by name."""

    def __init__(self):
        self.stack: list[Element] = []
        self.by_tag: dict[str, list[int]] = {}
        self.blocks: list[int] = []
        self.held: dict[str, int] = {}  # features, and how many open elements have them
        self.links = 0

    def push(self, tag: str, words: tuple[str, ...]) -> None:
        own, new = [f"in {tag}", *[f"named {w}" for w in words]], []
        for f in own:
            n = self.held.get(f, 0)
            self.held[f] = n + 1
            if not n:
                new.append(f)
        self.by_tag.setdefault(tag, []).append(len(self.stack))
        if tag in BLOCKS:
            self.blocks.append(len(self.stack))
        self.stack.append(Element(tag, words, self.stack[-1] if self.stack else None, tuple(new)))
        self.links += tag == "a"

    def pop(self) -> Element:
        e = self.stack.pop()
        self.by_tag[e.tag].pop()
        if e.tag in BLOCKS:
            self.blocks.pop()
        for f in (f"in {e.tag}", *[f"named {w}" for w in e.words]):
            self.held[f] -= 1
        self.links -= e.tag == "a"
        return e

    def pop_to(self, at: int) -> list[Element]:
        return [self.pop() for _ in range(len(self.stack) - at)][::-1]

    def drop(self, at: int) -> None:
        """Ends one element; those inside it stay open, unless they are too many."""
        inside = self.pop_to(at)[1:]
        if len(inside) <= INLINE:
            for e in inside:
                self.push(e.tag, e.words)

    def last(self, tags) -> int:
        """The position of the innermost open element of these tags, or -1."""
        return max((self.by_tag[t][-1] for t in tags if self.by_tag.get(t)), default=-1)


def _words(attributes: str) -> tuple[str, ...]:
    words = []
    for name, a, b, c in ATTRIBUTE.findall(attributes) if "=" in attributes or "hidden" in attributes else ():
        value = (a or b or c).lower()
        if name.lower() in ("hidden", "aria-hidden"):
            words += ["hidden"] if value != "false" else []
        elif name.lower() == "style":
            words += ["hidden"] if re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value) else []
        else:
            words += [w[:-1] if len(w) > 2 and w.endswith("s") and not w.endswith("ss") else w for w in SPLIT.split(re.sub(r"([a-z])([A-Z])", r"\1 \2", a or b or c).lower()) if w]
    return tuple(dict.fromkeys(words))


def blocks(page: str) -> list[Block]:
    """The page's leaf blocks in order; white space inside one is a single space."""
    out: list[Block] = []
    open_ = _Open()
    run: list[str] = []
    linked, path = 0, None
    never: set[str] = set()  # silent elements that nothing closes from here on

    def end_run():
        nonlocal linked, path
        if run:
            text = " ".join("".join(run).split())
            if text:
                out.append(Block(text, path, linked))
            run.clear()
        linked, path = 0, None

    def add(text: str):
        nonlocal linked, path
        if text and (run or not text.isspace()):
            if not run:
                path = open_.stack[-1] if open_.stack else None
            text = html.unescape(text) if "&" in text else text
            run.append(text)
            linked += len(text) if open_.links else 0

    at = 0
    while at < len(page):
        m = TOKEN.search(page, at)
        if m is None:
            add(page[at:])
            break
        add(page[at:m.start()])
        at = m.end()
        if not m[2]:
            continue
        tag = m[2].lower()
        if tag in BLOCKS:
            end_run()
        if m[1]:
            i = open_.last((tag,))
            if i >= 0 and tag in BLOCKS and tag != "p":
                open_.pop_to(i)
            elif i >= 0 and (open_.blocks[-1] if open_.blocks else -1) <= i:  # stays inside its block
                if tag == "p":
                    open_.pop_to(i)
                else:
                    open_.drop(i)
            continue
        attributes = m[3] or m[4] or ""
        if tag in SILENT and tag != "head" or tag == "textarea":
            if not attributes.endswith("/") or tag in RAW:
                close = None if tag in never else re.compile(rf"</{re.escape(tag)}\b[^>]*>" if tag in RAW else rf"</{re.escape(tag)}\s*>", re.I).search(page, at)
                if close is None:
                    never.add(tag)
                at = close.end() if close else len(page) if tag in RAW else at
            continue
        if tag in CLOSES_P or tag in ENDS:
            names, until = ENDS.get(tag, ("p", ("button", "td", "th", "table", "li", "dd")))
            while (i := open_.last(names.split())) > open_.last(until):
                open_.pop_to(i)
                if tag not in ("tr", "tbody"):
                    break
        if tag not in VOID and tag != "head":
            open_.push(tag, _words(attributes))
    end_run()
    return out
