"""A small tolerant HTML tree with the selectors that resolvers need, on the standard library's parser."""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from html.parser import HTMLParser

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: A start tag of the key closes an open tag of these first, within the nearest of ``_FENCE``.
CLOSES = {
    "li": {"li"}, "option": {"option"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"},
    **dict.fromkeys("p div ul ol table section article h1 h2 h3 h4 h5 h6 form header footer nav main aside".split(), {"p"}),
}
_FENCE = frozenset("ul ol table select dl div section article body html".split())


class Node:
    __slots__ = ("attrs", "children", "parent", "tag")

    def __init__(self, tag: str, attrs: dict[str, str], parent: Node | None):
        self.tag, self.attrs, self.parent = tag, attrs, parent
        self.children: list[Node | str] = []

    def walk(self) -> Iterator[Node]:
        """All elements below this one, in document order."""
        stack = [c for c in reversed(self.children) if isinstance(c, Node)]
        while stack:
            node = stack.pop()
            yield node
            stack += [c for c in reversed(node.children) if isinstance(c, Node)]

    def pieces(self, deep: bool = True) -> Iterator[str]:
        stack: list[Node | str] = list(reversed(self.children))
        while stack:
            x = stack.pop()
            if isinstance(x, str):
                yield x
            elif deep:
                stack += reversed(x.children)

    def text(self, deep: bool = True) -> str:
        """Stripped text pieces with spaces between them; text of scripts and styles counts too."""
        return " ".join(s for p in self.pieces(deep) if (s := p.strip()))

    def select(self, selector: str) -> list[Node]:
        paths = compile_selector(selector)
        return [n for n in self.walk() if any(_matches(n, path) for path in paths)]

    def first(self, selector: str) -> Node | None:
        paths = compile_selector(selector)
        return next((n for n in self.walk() if any(_matches(n, path) for path in paths)), None)


class Tree(Node):
    """The root of a parsed page. Its elements are gone through once, then looked up by tag or attribute."""

    __slots__ = ("held", "order")

    def __init__(self):
        super().__init__("#root", {}, None)
        self.order: list[Node] | None = None
        self.held: dict[tuple[str, str], list[int]] = {}

    def _found(self, path: tuple[tuple[Test, ...], ...]) -> Iterator[int]:
        """Places in the document of the elements that a chain of compounds selects, in order."""
        if self.order is None:
            self.order = list(self.walk())
            for k, node in enumerate(self.order):
                self.held.setdefault(("tag", node.tag), []).append(k)
                for name in node.attrs:
                    self.held.setdefault(("attr", name), []).append(k)
        likely = min((self.held.get((kind, name), ()) for kind, name, *_ in path[-1]), key=len)
        return (k for k in likely if _matches(self.order[k], path))

    def select(self, selector: str) -> list[Node]:
        paths = compile_selector(selector)
        places = sorted({k for path in paths for k in self._found(path)})
        return [self.order[k] for k in places]

    def first(self, selector: str) -> Node | None:
        places = [k for path in compile_selector(selector) if (k := next(self._found(path), None)) is not None]
        return self.order[min(places)] if places else None


class _Builder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = self.at = Tree()

    def handle_starttag(self, tag, attrs):
        node = self.at
        while node.parent is not None and node.tag not in _FENCE:
            if node.tag in CLOSES.get(tag, ()):
                self.at = node.parent
                break
            node = node.parent
        kept: dict[str, str] = {}
        for k, x in attrs:
            kept.setdefault(k, x or "")
        node = Node(tag, kept, self.at)
        self.at.children.append(node)
        if tag not in VOID:
            self.at = node

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        node = self.at
        while node.parent is not None:
            if node.tag == tag:
                self.at = node.parent
                return
            node = node.parent

    def handle_data(self, data):
        self.at.children.append(data)


def parse(html: str) -> Node:
    builder = _Builder()
    builder.feed(html)
    builder.close()
    return builder.root


_SIMPLE = re.compile(r"""([a-zA-Z][\w-]*)|\.([\w-]+)|\#([\w-]+)|\[\s*([\w:-]+)\s*(?:([*^$~]?=)\s*(?:"([^"]*)"|'([^']*)'|([^\]\s]+))\s*(i)?\s*)?\]""")
Test = tuple[str, str, str, str, bool]


@lru_cache(512)
def compile_selector(selector: str) -> tuple[tuple[tuple[Test, ...], ...], ...]:
    """Comma lists of descendant chains of compound selectors; raises ValueError for others."""
    out = []
    for part in re.split(r",(?![^\[]*\])", selector):
        chain = []
        for compound in re.findall(r"(?:\[[^\]]*\]|[^\s\[])+", part.strip()):
            tests, at = [], 0
            while at < len(compound):
                m = _SIMPLE.match(compound, at)
                if not m:
                    raise ValueError(f"selector {selector!r}")
                tag, klass, ident, name, op, a, b, c, fold = m.groups()
                value = a or b or c or ""
                tests.append(("tag", tag.lower(), "", "", False) if tag else ("attr", "class", "~=", klass, False) if klass else ("attr", "id", "=", ident, False) if ident else ("attr", name.lower(), op or "", value, bool(fold)))
                at = m.end()
            chain.append(tuple(tests))
        out.append(tuple(chain))
    return tuple(out)


def _fits(node: Node, tests: tuple[Test, ...]) -> bool:
    for kind, name, op, value, fold in tests:
        if kind == "tag":
            if node.tag != name:
                return False
            continue
        held = node.attrs.get(name)
        if held is None:
            return False
        if fold:
            held, value = held.lower(), value.lower()
        if not {"": True, "=": held == value, "*=": value != "" and value in held, "^=": value != "" and held.startswith(value), "$=": value != "" and held.endswith(value), "~=": value in held.split()}[op]:
            return False
    return True


def _matches(node: Node, path: tuple[tuple[Test, ...], ...]) -> bool:
    if not _fits(node, path[-1]):
        return False
    above, k = node.parent, len(path) - 2
    while k >= 0 and above is not None:
        if _fits(above, path[k]):
            k -= 1
        above = above.parent
    return k < 0
