"""Per-page helper of the cleaning job: HTML text in, Markdown text out.

Two small steps over the tag stream of the standard library parser: a light element tree (needed to
focus on the main content and to drop subtrees), and a writer that walks what is left.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from html.parser import HTMLParser


@dataclass(frozen=True)
class CleaningRules:
    """What to keep and what to drop. Every rule is an option of its own."""

    # Main content, dropped tags, classes, ids, navigation tables and sections.
    content_id: str | None = "mw-content-text"
    content_class: str | None = "mw-parser-output"
    tags: tuple = ("script", "style")
    classes: tuple = (
        "mw-editsection", "toc", "noprint", "navbox", "p-lang", "p-tb", "footer", "catlinks",
    )
    ids: tuple = ("mw-navigation", "siteSub", "contentSub", "jump-to-nav")
    table_classes: tuple = ("navbox", "vertical-navbox")
    sections: tuple = ("trivia", "external links", "references")
    section_tags: tuple = ("h2", "h3")


VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
BLOCK = frozenset(
    "address article aside body caption dd details div dl dt fieldset figcaption figure footer "
    "form header html main nav ol p pre section table tbody tfoot thead title tr ul "
    "h1 h2 h3 h4 h5 h6 blockquote li hr".split()
)


@dataclass(eq=False)
class Element:
    name: str
    attrs: dict
    parent: "Element | None" = None
    children: list = field(default_factory=list)  # Elements and strings
    dropped: bool = False

    def classes(self) -> list[str]:
        return (self.attrs.get("class") or "").split()


class _Tree(HTMLParser):
    """Element tree of a page. An end tag closes the nearest open element of its name."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = Element("", {})
        self.open = [self.root]
        self.counts: dict[str, int] = {}

    def handle_starttag(self, tag, attrs):
        first: dict = {}
        for name, value in attrs:
            first[name] = value
        element = Element(tag, first, self.open[-1])
        self.open[-1].children.append(element)
        if tag not in VOID:
            self.open.append(element)
            self.counts[tag] = self.counts.get(tag, 0) + 1

    def handle_endtag(self, tag):
        if not self.counts.get(tag):
            return
        while True:
            closed = self.open.pop()
            self.counts[closed.name] -= 1
            if closed.name == tag:
                return

    def handle_data(self, data):
        self.open[-1].children.append(data)


def elements(root: Element):
    """Elements below ``root`` in document order, skipping dropped subtrees."""
    stack = [iter(root.children)]
    while stack:
        for child in stack[-1]:
            if isinstance(child, Element) and not child.dropped:
                yield child
                stack.append(iter(child.children))
                break
        else:
            stack.pop()


def _text(root: Element) -> str:
    parts, stack = [], [root]
    while stack:
        node = stack.pop()
        if isinstance(node, str):
            parts.append(node)
        elif not node.dropped:
            stack.extend(reversed(node.children))
    return "".join(parts)


def _drop(root: Element, test) -> None:
    for element in elements(root):
        if test(element):
            element.dropped = True


def focus(root: Element, rules: CleaningRules) -> Element:
    """The main content if the page marks it, else the page."""
    if rules.content_id is None:
        return root
    main = next((e for e in elements(root) if e.attrs.get("id") == rules.content_id), None)
    if main is None:
        return root
    if rules.content_class is None:
        return main
    return next((e for e in elements(main) if rules.content_class in e.classes()), main)


def prune(root: Element, rules: CleaningRules) -> None:
    """Drop noise below ``root``: tags, classes, ids, navigation tables, whole sections."""
    _drop(root, lambda e: e.name in rules.tags)
    unwanted = set(rules.classes)
    _drop(root, lambda e: not unwanted.isdisjoint(e.classes()))
    for wanted in rules.ids:
        first = next((e for e in elements(root) if e.attrs.get("id") == wanted), None)
        if first is not None:
            first.dropped = True
    navigation = set(rules.table_classes)
    _drop(root, lambda e: e.name == "table" and not navigation.isdisjoint(e.classes()))
    headings = [e for e in elements(root) if e.name in rules.section_tags]
    for heading in headings:
        title = _text(heading).lower()
        if heading.dropped or not any(s in title for s in rules.sections):
            continue
        siblings = heading.parent.children
        for sibling in siblings[siblings.index(heading) + 1 :]:
            if isinstance(sibling, Element):
                if sibling.name in rules.section_tags and not sibling.dropped:
                    break
                sibling.dropped = True
        heading.dropped = True


_SPACE = re.compile(r"[ \t\r\n\f]+")
_EMPHASIS = {"b": "**", "strong": "**", "i": "*", "em": "*", "del": "~~", "s": "~~"}
_HEADING = re.compile("h[1-6]$")


class _Writer:
    """Markdown of an element tree: headings, paragraphs, lists, tables, code, emphasis."""

    def __init__(self) -> None:
        # One buffer per open construct whose text is rewritten when it closes.
        self.buffers: list[list[str]] = [[]]
        self.lists: list[list] = []
        self.verbatim = 0

    def put(self, text: str) -> None:
        self.buffers[-1].append(text)

    def text(self, data: str) -> None:
        if self.verbatim:
            self.put(data)
            return
        data = _SPACE.sub(" ", data)
        last = self.buffers[-1][-1] if self.buffers[-1] else "\n"
        if data.startswith(" ") and last.endswith(("\n", " ")):
            data = data[1:]
        if data:
            self.put(re.sub(r"([*_])", r"\\\1", data))

    def enter(self, e: Element) -> None:
        name = e.name
        if name == "br":
            self.put("  \n")
        elif name == "hr":
            self.put("\n\n---\n\n")
        elif name == "img":
            self.put(f"![{e.attrs.get('alt') or ''}]({e.attrs.get('src') or ''})")
        elif name in ("ul", "ol"):
            self.lists.append([name, 0])
            self.buffers.append([])
        elif name == "pre":
            self.verbatim += 1
            self.buffers.append([])
        elif name == "code" and not self.verbatim:
            self.verbatim += 1
            self.buffers.append([])
        elif name in BLOCK or name in _EMPHASIS or name in ("td", "th"):
            self.buffers.append([])

    def leave(self, e: Element) -> None:
        name = e.name
        if name in VOID or not (
            name in BLOCK or name in _EMPHASIS or name in ("td", "th", "pre", "code")
        ):
            return
        if name == "code" and any_parent(e, "pre"):
            return
        body = "".join(self.buffers.pop())
        if name in ("pre", "code"):
            self.verbatim -= 1
        inner = body.strip()
        if name in _EMPHASIS:
            mark = _EMPHASIS[name]
            lead = body[: len(body) - len(body.lstrip())]
            tail = body[len(body.rstrip()) :]
            self.put(f"{lead}{mark}{inner}{mark}{tail}" if inner else body)
        elif name == "code":
            self.put(f"`{body}`" if body else "")
        elif name == "pre":
            self.put(f"\n\n```\n{body}\n```\n\n" if body else "")
        elif _HEADING.match(name):
            title = _SPACE.sub(" ", inner)
            self.put(f"\n\n{'#' * int(name[1])} {title}\n\n" if title else "")
        elif name == "li":
            kind, count = self.lists[-1] if self.lists else ("ul", 0)
            if self.lists:
                self.lists[-1][1] += 1
            depth = max(len(self.lists) - 1, 0)
            bullet = f"{count + 1}." if kind == "ol" else "*+-"[depth % 3]
            self.put(f"{bullet} " + inner.replace("\n", "\n" + " " * (len(bullet) + 1)) + "\n")
        elif name in ("ul", "ol"):
            self.lists.pop()
            edge = "\n" if self.lists else "\n\n"
            self.put(edge + body.strip("\n") + edge)
        elif name in ("td", "th"):
            self.put(" " + inner.replace("\n", " ").replace("|", "\\|") + " |")
        elif name == "tr":
            line = "|" + body.rstrip() if inner else ""
            cells = sum(1 for c in e.children if isinstance(c, Element) and c.name in ("td", "th"))
            rule = "\n|" + " --- |" * cells if line and _first_row(e) else ""
            self.put(line + rule + "\n" if line else "")
        elif name == "blockquote":
            self.put("\n\n" + "\n".join("> " + t for t in inner.split("\n")) + "\n\n" if inner else "")
        elif name in ("thead", "tbody", "tfoot"):
            self.put(body)
        elif name == "table":
            self.put("\n\n" + body.strip("\n") + "\n\n")
        else:
            self.put("\n\n" + body.strip("\n") + "\n\n" if inner else "")


def any_parent(e: Element, name: str) -> bool:
    while e.parent is not None:
        e = e.parent
        if e.name == name:
            return True
    return False


def _first_row(row: Element) -> bool:
    """Is this the first row of its table?"""
    table = row.parent
    while table is not None and table.name != "table":
        table = table.parent
    return table is None or next((e for e in elements(table) if e.name == "tr"), row) is row


def write_markdown(root: Element) -> str:
    writer = _Writer()
    stack = [iter([root])]
    trail: list[Element] = []
    while stack:
        for node in stack[-1]:
            if isinstance(node, str):
                writer.text(node)
            elif not node.dropped:
                writer.enter(node)
                trail.append(node)
                stack.append(iter(node.children))
                break
        else:
            stack.pop()
            if trail:
                writer.leave(trail.pop())
    text = "".join(writer.buffers[0])
    return re.sub(r"\n{3,}", "\n\n", text).strip()


def html_to_markdown(html: str, rules: CleaningRules = CleaningRules()) -> str:
    tree = _Tree()
    tree.feed(html)
    tree.close()
    root = focus(tree.root, rules)
    prune(root, rules)
    return write_markdown(root)
