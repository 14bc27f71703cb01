"""HTML to block nodes: a forgiving tree builder for broken pages.

Nodes are block-level elements and the runs of inline text between them (leaves). Character
references are decoded, white space in a run becomes one space, scripts, styles, comments,
form controls and other elements that show no text of their own are left out, up to their end
or that of an element around them.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from html import unescape

# Element names by their role in HTML; fixed values.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Their content is text up to their own end, or the page's.
RAW = frozenset("script style title textarea iframe noembed noframes".split())
#: Open elements like others, whose text is unseen until they or an element around them end.
UNSEEN = frozenset("noscript template svg math select button datalist canvas object audio video".split())
#: ``/>`` ends these and what is inside them; a block of HTML inside ends them as well.
FOREIGN = frozenset(["svg", "math"])
BREAKOUT = frozenset("blockquote body center dd div dl dt h1 h2 h3 h4 h5 h6 li menu ol p pre table ul".split())
CELLS = frozenset("tr td th tbody tfoot".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup "
    "time tt u var".split()
)
CLOSED_BY = {
    "p": None,  # by any block
    "li": frozenset({"li"}),
    "dt": frozenset({"dt", "dd"}),
    "dd": frozenset({"dt", "dd"}),
    "tr": frozenset({"tr", "tbody", "tfoot"}),
    "td": frozenset({"td", "th", "tr", "tbody", "tfoot"}),
    "th": frozenset({"td", "th", "tr", "tbody", "tfoot"}),
}
HEADINGS = ("h1", "h2", "h3", "h4", "h5", "h6")
_NESTS = frozenset("ul ol dl table".split())
_TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)
    |<(?P<open>[a-zA-Z][^\s/>]*)(?P<attributes>(?:\s+|/|[^\s/>=][^\s/>=]*+(?:\s*=\s*(?:"[^"]*"|'[^']*'|[^\s>"'][^\s>]*+)?)?|=)*+)>
    |</(?P<close>[a-zA-Z][^\s/>]*)[^>]*>
    |<[!?/][^>]*>""",
    re.S | re.X,
)
_TAIL = re.compile(r"<[a-zA-Z/!?][^>]*\Z", re.S)
_ATTRIBUTE = re.compile(r"""(class|id|role|itemprop)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"'][^\s>]*))""", re.I)
#: Of drawn layouts only; no page can have another value read.
LABEL = "data-granary-label"
_LABEL = re.compile(rf'{LABEL}="([01])"')
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")


@dataclass(slots=True)
class Node:
    parent: int
    depth: int
    tag: str
    words: tuple[str, ...] = ()
    text: str = ""
    linked: float = 0.0
    label: int = 0


def blocks(html: str) -> list[Node]:
    """Nodes in page order; a leaf has tag ``#text``. Node 0 is the page itself."""
    nodes = [Node(-1, 0, "#page")]
    stack: list[tuple[str, int]] = []  # open elements; -1 for inline ones, -2 for unseen ones, -3 for blocks in them
    opened: dict[str, int] = {}
    run: list[str] = []
    tops = [0]
    state = {"links": 0, "linked": 0, "unseen": 0}

    def flush() -> None:
        text = " ".join(unescape("".join(run)).split())
        if text:
            top = tops[-1]
            size = sum(len(x) for x in run)
            nodes.append(Node(top, nodes[top].depth + 1, "#text", (), text, state["linked"] / size, nodes[top].label))
        run.clear()
        state["linked"] = 0

    def pop() -> str:
        tag, node = stack.pop()
        opened[tag] -= 1
        if node >= 0:
            tops.pop()
        elif node == -2:
            state["unseen"] -= 1
        elif tag == "a":
            state["links"] -= 1
        return tag

    def say(text: str) -> None:
        if text and not state["unseen"]:
            run.append(text)
            if state["links"]:
                state["linked"] += len(text)

    def close_to(tag: str) -> None:
        while pop() != tag:
            pass

    def foreign() -> str | None:
        """The innermost unseen element, if it is foreign and no HTML is embedded in it."""
        if state["unseen"] and not opened.get("foreignobject"):
            inner = next(name for name, node in reversed(stack) if node == -2)
            return inner if inner in FOREIGN else None
        return None

    def implied(tag: str) -> None:
        """End elements that ``tag`` ends without saying so."""
        if opened.get("p"):
            close_to("p")
        for k in range(len(stack) - 1, -1, -1):
            name = stack[k][0]
            if name in _NESTS:
                break
            if name in CLOSED_BY and CLOSED_BY[name] and tag in CLOSED_BY[name]:
                while len(stack) > k:
                    pop()
                break
            if tag not in CLOSED_BY:
                break

    at, end = 0, len(html)
    while at < end:
        token = _TOKEN.search(html, at)
        if token is None:
            tail = html[at:]
            broken = _TAIL.search(tail)
            say(tail[: broken.start()] if broken else tail)
            break
        say(html[at : token.start()])
        at = token.end()
        if name := token["open"]:
            tag = name.lower()
            ended = token["attributes"].endswith("/")
            if ended and (tag in FOREIGN or foreign()):
                continue
            if tag in BREAKOUT and (inner := foreign()):
                close_to(inner)
            elif tag in CELLS and state["unseen"]:
                implied(tag)
            if tag in VOID:
                if tag == "hr" and not state["unseen"]:
                    flush()
                elif tag in ("br", "wbr"):
                    run.append(" " if tag == "br" else "")
            elif tag in RAW:
                shut = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>", re.I).search(html, at)
                at = shut.end() if shut else end
                run.append(" ")
            elif tag in UNSEEN or (state["unseen"] and tag not in INLINE):
                run.append(" ")
                stack.append((tag, -2 if tag in UNSEEN else -3))
                opened[tag] = opened.get(tag, 0) + 1
                state["unseen"] += tag in UNSEEN
            elif tag in INLINE:
                stack.append((tag, -1))
                opened[tag] = opened.get(tag, 0) + 1
                state["links"] += tag == "a"
            else:
                flush()
                implied(tag)
                top = tops[-1]
                words, label = (), nodes[top].label
                if token["attributes"]:
                    found = {m[0].lower(): m[1] or m[2] or m[3] for m in _ATTRIBUTE.findall(token["attributes"])}
                    label = int(said[1]) if (said := _LABEL.search(token["attributes"])) else label
                    words = tuple(dict.fromkeys(w.lower() for v in found.values() for w in _WORD.findall(v)))
                nodes.append(Node(top, nodes[top].depth + 1, tag, words, label=label))
                stack.append((tag, len(nodes) - 1))
                tops.append(len(nodes) - 1)
                opened[tag] = opened.get(tag, 0) + 1
        elif name := token["close"]:
            tag = name.lower()
            if tag in HEADINGS:  # any heading's end ends the open one
                tag = next((h for h in HEADINGS if opened.get(h)), tag)
            if not opened.get(tag):
                if tag == "p" and not state["unseen"]:  # stands for an empty paragraph
                    flush()
                continue
            if tag in INLINE:
                for k in range(len(stack) - 1, -1, -1):
                    if stack[k][0] == tag:
                        del stack[k]
                        opened[tag] -= 1
                        state["links"] -= tag == "a"
                        break
                    if stack[k][1] != -1:
                        break
            else:
                if next(node for name, node in reversed(stack) if name == tag) >= 0:
                    flush()
                close_to(tag)
    flush()
    return nodes
