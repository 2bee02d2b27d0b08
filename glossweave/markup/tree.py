"""A small error-tolerant HTML tree over the standard library's tokenizer.

What browsers do to broken markup, as far as the data needs it: void elements have no end,
a paragraph or list item ends where the next begins, an end tag without a start is dropped,
an element that never ends swallows the rest.
"""

from __future__ import annotations

import html
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from html.parser import HTMLParser

VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
#: An opening tag ends open elements of these names, up to the nearest of the second set.
IMPLIED_ENDS = {
    "p": ({"p"}, {"td", "div", "li", "body"}),
    "li": ({"li", "p"}, {"ul", "ol"}),
    "td": ({"td", "th", "p"}, {"tr", "table"}),
    "th": ({"td", "th", "p"}, {"tr", "table"}),
    "tr": ({"tr", "td", "th", "p"}, {"table"}),
    "ul": ({"p"}, {"td", "div", "li", "body"}),
    "ol": ({"p"}, {"td", "div", "li", "body"}),
    "div": ({"p"}, {"td", "div", "li", "body"}),
    "table": ({"p"}, {"td", "div", "li", "body"}),
}


@dataclass
class Element:
    name: str
    attributes: dict[str, str] = field(default_factory=dict)
    children: list = field(default_factory=list)  # Element, str or Comment

    def walk(self) -> Iterator["Element"]:
        """Elements below this one, in document order."""
        for c in self.children:
            if isinstance(c, Element):
                yield c
                yield from c.walk()

    def all(self, *names: str) -> list["Element"]:
        return [e for e in self.walk() if e.name in names]

    def first(self, name: str, **attributes: str) -> "Element | None":
        return next((e for e in self.walk() if e.name == name and all(e.attributes.get(k) == v for k, v in attributes.items())), None)

    @property
    def text(self) -> str:
        return "".join(c if isinstance(c, str) else c.text for c in self.children if not isinstance(c, Comment))

    def inner(self) -> str:
        return "".join(serialise(c) for c in self.children)


class Comment(str):
    pass


def serialise(node) -> str:
    if isinstance(node, Comment):
        return f"<!--{node}-->"
    if isinstance(node, str):
        return html.escape(node, quote=False)
    start = node.name + "".join(f' {k}="{html.escape(v)}"' for k, v in node.attributes.items())
    return f"<{start}>" if node.name in VOID else f"<{start}>{node.inner()}</{node.name}>"


#: Elements nested deeper have what stands in them beside them, as browsers do from some depth on.
DEEPEST = 100


class _Builder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = Element("#root")
        self.open = [self.root]
        self.beside: Counter = Counter()

    def handle_starttag(self, tag, attrs):
        ends, limits = IMPLIED_ENDS.get(tag, (frozenset(), frozenset()))
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i].name in limits:
                break
            if self.open[i].name in ends:
                del self.open[i:]
        one = Element(tag, {k: v or "" for k, v in attrs})
        self.open[-1].children.append(one)
        if tag in VOID:
            return
        if len(self.open) < DEEPEST:
            self.open.append(one)
        else:
            self.beside[tag] += 1

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag):
        if self.beside[tag]:
            self.beside[tag] -= 1
            return
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i].name == tag:
                del self.open[i:]
                return

    def handle_data(self, data):
        self.open[-1].children.append(data)

    def handle_comment(self, data):
        self.open[-1].children.append(Comment(data))


def parse(text: str) -> Element:
    builder = _Builder()
    builder.feed(text)
    builder.close()
    return builder.root
