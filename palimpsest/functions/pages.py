"""HTML pages in Arrow batches: decoding, main text, section trees and their walks."""

from __future__ import annotations

import json
import re
from html import escape
from html.parser import HTMLParser

import pandas as pd
from palimpsest.functions.udfs import arrow_udf

# Tags that hold others without an end, containers that are read into, and levels of sections.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
CONTAINERS = frozenset("html body main article section div c-wiz ul ol table tbody tr td".split())
LEVEL = {"root": 0, "div": 0, "table": 0, "section": 0, **{f"h{k}": k for k in range(1, 7)}}
CHILD = -1
_SPACE = re.compile(r"\s+")


class Element:
    __slots__ = ("attrs", "children", "tag")

    def __init__(self, tag: str, attrs: dict[str, str] | None = None):
        self.tag, self.attrs, self.children = tag, attrs or {}, []

    def text(self) -> str:
        """Text below, without that of scripts and styles inside (a script or style asked itself gives its own)."""
        out, todo = [], list(reversed(self.children))
        while todo:
            c = todo.pop()
            if isinstance(c, str):
                out.append(c)
            elif c.tag not in ("script", "style"):
                todo += reversed(c.children)
        return "".join(out)

    def find(self, tag: str) -> Element | None:
        stack = [self]
        while stack:
            at = stack.pop()
            if at.tag == tag:
                return at
            stack += [c for c in reversed(at.children) if isinstance(c, Element)]
        return None

    def prune(self, unwanted) -> None:
        todo = [self]
        while todo:
            at = todo.pop()
            at.children = [c for c in at.children if isinstance(c, str) or not unwanted(c)]
            todo += [c for c in at.children if isinstance(c, Element)]

    def pretty(self) -> str:
        """One line for each tag and each text, indented by depth, so that inline tags part words."""
        lines: list[str] = []
        todo: list[tuple[Element | str, int]] = [(self, 0)]
        while todo:
            at, depth = todo.pop()
            pad = " " * depth
            if isinstance(at, _End):
                lines.append(f"{pad}</{at}>")
                continue
            if isinstance(at, str):
                if at.strip():
                    lines.append(pad + escape(at.strip(), quote=False))
                continue
            inner = depth + (at.tag != "")
            if at.tag:
                attrs = "".join(f' {k}="{escape(v)}"' for k, v in at.attrs.items())
                lines.append(f"{pad}<{at.tag}{attrs}>")
                if at.tag not in VOID:
                    todo.append((_End(at.tag), depth))
            todo += [(c, inner) for c in reversed(at.children)]
        return "\n".join(lines)


class _End(str):
    """An end tag among the texts of a page that is written out."""

    __slots__ = ()


class _Builder(HTMLParser):
    """Elements by a stack: void elements close at once, an end tag closes up to the nearest of its name or is ignored."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = Element("")
        self.open = [self.root]

    def handle_starttag(self, tag, attrs):
        e = Element(tag, {k: v or "" for k, v in attrs})
        self.open[-1].children.append(e)
        if tag not in VOID:
            self.open.append(e)

    def handle_startendtag(self, tag, attrs):
        self.open[-1].children.append(Element(tag, {k: v or "" for k, v in attrs}))

    def handle_endtag(self, tag):
        for k in range(len(self.open) - 1, 0, -1):
            if self.open[k].tag == tag:
                del self.open[k:]
                return

    def handle_data(self, data):
        self.open[-1].children.append(data)


def parse(html: str) -> Element:
    b = _Builder()
    b.feed(html)
    b.close()
    return b.root


def main_text(html: str | None) -> str | None:
    """Prettified first <main>; without one, the body without scripts, styles, footers, asides, navs and advertisements."""
    if html is None:
        return None
    root = parse(html)
    if (m := root.find("main")) is not None:
        return m.pretty()
    root.prune(lambda e: e.tag in ("script", "style", "footer", "aside", "nav") or bool({"ad", "ads", "advertisement"} & set(e.attrs.get("class", "").split())))
    return (root.find("body") or root).pretty()


def decode(content: bytes | None, content_type: str | None) -> tuple[str | None, str | None]:
    """Text of a response and the encoding it names; without a name UTF-8 then Windows-1252; on failure UTF-8 with marks."""
    if content is None:
        return None, None
    m = re.search(r"charset=[\"']?([^\s;\"']+)", (content_type or "").lower())
    if m:
        try:
            return content.decode(m.group(1)), m.group(1)
        except (UnicodeDecodeError, LookupError):
            return content.decode("utf-8", "replace"), m.group(1)
    for guess in ("utf-8", "cp1252"):
        try:
            return content.decode(guess), guess
        except UnicodeDecodeError:
            pass
    return content.decode("utf-8", "replace"), None


class Node:
    """A section-tree node. Where a node goes depends on its level, see place()."""

    __slots__ = ("ahead", "children", "level", "parent", "readable", "tag", "text")

    def __init__(self, text: str, tag: str):
        self.text, self.tag, self.level = text, tag, LEVEL.get(tag, CHILD)
        self.children: list[Node] = []
        self.parent: Node | None = None
        self.ahead = self.readable = 0  # readable siblings before it, readable children

    def adopt(self, node: Node) -> None:
        node.parent, node.ahead = self, self.readable
        self.readable += not node.blank
        self.children.append(node)

    def place(self, node: Node) -> None:
        """Plain blocks go under the last child that is no plain block; headings under the last heading of a higher rank,
        again and again; all else, and where there is no such child, directly below."""
        home = self
        if node.level == CHILD:
            home = next((c for c in reversed(self.children) if c.level != CHILD), self)
        elif node.level > 0:
            while (up := next((c for c in reversed(home.children) if 0 < c.level < node.level), None)) is not None:
                home = up
        home.adopt(node)

    @property
    def blank(self) -> bool:
        return not self.text or self.text.isspace()

    def read_idx(self) -> int:
        """Reading number: along the ancestors, readable earlier siblings and the nodes themselves, less one."""
        total, at = -1, self
        while at is not None:
            total += at.ahead + (not at.blank)
            at = at.parent
        return total

    def below(self) -> list[tuple[Node, int]]:
        """(node, depth) of the node and all below it, parents first."""
        out = [(self, 1)]
        for node, depth in out:
            out += [(c, depth + 1) for c in node.children]
        return out

    def size(self) -> int:
        return len(self.below())

    def depth(self) -> int:
        return max(depth for _, depth in self.below())

    def find(self, read_idx: int) -> Node | None:
        """The first node of a reading number, depth first."""
        stack = [self]
        while stack:
            at = stack.pop()
            if at.read_idx() == read_idx:
                return at
            stack += reversed(at.children)
        return None


def joint(context: str) -> str:
    """What stands between a context and the text after it."""
    return "" if not context or context[-1].isspace() else "\n" if context.endswith(".") else ".\n"


def tree(html: str) -> Node:
    """Section tree of a page: containers are read into, scripts and footers are left out, all else with text is one leaf."""
    root = Node("", "root")

    todo: list[tuple[Element | str, Node]] = [(c, root) for c in reversed(parse(html).children)]
    while todo:
        c, at = todo.pop()
        tag = "text" if isinstance(c, str) else c.tag
        if tag in CONTAINERS:
            n = Node("", tag)
            at.place(n)
            todo += [(x, n) for x in reversed(c.children)]
        elif tag not in ("script", "footer"):
            raw = c if isinstance(c, str) else c.text()
            if raw and not raw.isspace():
                at.place(Node(_SPACE.sub(" ", escape(raw, quote=False)).strip(), tag))
    return root


def walk(root: Node) -> list[tuple[Node, str]]:
    """(node, context) of each readable node, depth first. The context of a node is that of its parent and the parent's text,
    with the raw text of the parent's earlier children before it; a joint stands only after a node with text."""
    out: list[tuple[Node, str]] = []
    todo = [(root, "")]
    while todo:
        node, context = todo.pop()
        if not node.blank:
            out.append((node, context))
        inside, last = [], node
        for c in node.children:
            inside.append((c, context + (joint(context) if last.text else "") + node.text))
            last = c
            if c.tag == "text":
                context += c.text
        todo += reversed(inside)
    return out


def as_dict(node: Node, full: bool = True) -> dict:
    made: dict[int, dict] = {}
    for n, _ in reversed(node.below()):  # children before parents
        made[id(n)] = {"text": n.text, **({"read_idx": n.read_idx(), "tag": n.tag} if full else {}), "children": [made[id(c)] for c in n.children]}
    return made[id(node)] | ({"size": node.size(), "depth": node.depth()} if node.parent is None else {})


def from_dict(d: dict) -> Node:
    root = Node(d["text"], d["tag"])
    todo = [(root, d)]
    while todo:
        at, x = todo.pop()
        for c in x["children"]:
            at.adopt(Node(c["text"], c["tag"]))
            todo.append((at.children[-1], c))
    return root


@arrow_udf("string")
def main_text_udf(html: pd.Series) -> pd.Series:
    return html.map(main_text, na_action="ignore")


@arrow_udf("struct<html:string,encoding:string>")
def decode_udf(content: pd.Series, content_type: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([decode(c, t) for c, t in zip(content, content_type)], columns=["html", "encoding"])


NODES = "array<struct<node_ord:int,read_idx:int,tag:string,level:int,depth:int,text:string,context:string,passage:string>>"


def _nodes(html: str | None) -> list[tuple]:
    rows = []
    for k, (n, context) in enumerate(walk(tree(html)) if html else []):
        depth, at = 0, n
        while at.parent is not None:
            depth, at = depth + 1, at.parent
        rows.append((k, n.read_idx(), n.tag, n.level, depth, n.text, context, context + joint(context) + n.text))
    return rows


@arrow_udf(NODES)
def tree_nodes_udf(html: pd.Series) -> pd.Series:
    """Readable nodes of a page in reading order; node_ord is unique, read_idx need not be."""
    names = ("node_ord", "read_idx", "tag", "level", "depth", "text", "context", "passage")
    return html.map(lambda h: [dict(zip(names, r)) for r in _nodes(h)])


@arrow_udf("string")
def tree_json_udf(html: pd.Series) -> pd.Series:
    return html.map(lambda h: json.dumps(as_dict(tree(h))) if h is not None else None)
