"""A small HTML tree for the detail-page pass.

Built on the standard library tokenizer (``html.parser``), with the tree
rules of a non-repairing parser: a start tag opens an element under the
current one (void elements take no children), an end tag closes the nearest
open element of that name and is ignored when none is open, unclosed tags
stay open, and script/style text is raw. Used per row inside an Arrow batch
(``mapInPandas``); it is a helper, not an engine.
"""

from __future__ import annotations

import re
from html import escape
from html.parser import HTMLParser

VOID = frozenset("area base br col embed hr img input keygen link menuitem meta param source track wbr "
                 "basefont bgsound command frame image isindex nextid spacer".split())
RAW_TEXT = frozenset(("script", "style"))


class Text:
    __slots__ = ("data", "parent", "kind")

    def __init__(self, data: str, parent, kind: str = "text"):
        self.data, self.parent, self.kind = data, parent, kind


class Element:
    __slots__ = ("tag", "attrs", "children", "parent")

    def __init__(self, tag: str, attrs: dict, parent):
        self.tag, self.attrs, self.children, self.parent = tag, attrs, [], parent

    # -- navigation -----------------------------------------------------------
    def events(self):
        """(entered, node) of all descendants in document order, elements also when left.

        Walks keep their own stack, so a page may nest as deep as it likes.
        """
        stack = [iter(self.children)]
        open_ = []
        while stack:
            node = next(stack[-1], None)
            if node is None:
                stack.pop()
                if open_:
                    yield False, open_.pop()
            else:
                yield True, node
                if isinstance(node, Element):
                    open_.append(node)
                    stack.append(iter(node.children))

    def iter(self):
        """Descendant elements in document order."""
        return (node for entered, node in self.events() if entered and isinstance(node, Element))

    def find(self, tag: str, pred=None):
        for el in self.iter():
            if el.tag == tag and (pred is None or pred(el)):
                return el
        return None

    def find_all(self, tag: str, pred=None) -> list:
        return [el for el in self.iter() if el.tag == tag and (pred is None or pred(el))]

    def _siblings(self, step: int):
        if self.parent is None:
            return
        sib = self.parent.children
        i = sib.index(self) + step
        while 0 <= i < len(sib):
            if isinstance(sib[i], Element):
                yield sib[i]
            i += step

    def next_sibling(self, tag: str):
        return next((s for s in self._siblings(1) if s.tag == tag), None)

    def previous_sibling(self, tag: str):
        return next((s for s in self._siblings(-1) if s.tag == tag), None)

    def has_ancestor(self, pred) -> bool:
        p = self.parent
        while p is not None:
            if isinstance(p, Element) and pred(p):
                return True
            p = p.parent
        return False

    # -- content --------------------------------------------------------------
    def text(self) -> str:
        out, raw = [], 0
        for entered, node in self.events():
            if isinstance(node, Element):
                if node.tag in RAW_TEXT:
                    raw += 1 if entered else -1
            elif not raw and node.kind == "text":
                out.append(node.data)
        return "".join(out)

    def string(self):
        """The single string a tag holds (through single-child nesting)."""
        node = self
        while isinstance(node, Element):
            if len(node.children) != 1:
                return None
            node = node.children[0]
        return node.data if node.kind == "text" else None

    def inner_html(self) -> str:
        out = []
        for entered, node in self.events():
            if isinstance(node, Text):
                out.append(f"<!--{node.data}-->" if node.kind == "comment"
                           else node.data if node.kind == "raw" else escape(node.data, quote=False))
            elif not entered:
                out.append("" if node.tag in VOID else f"</{node.tag}>")
            else:
                attrs = "".join(f' {k}="{escape(v, quote=True)}"' for k, v in node.attrs.items())
                out.append(f"<{node.tag}{attrs}{'/' if node.tag in VOID else ''}>")
        return "".join(out)


class _Builder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = Element("[document]", {}, None)
        self.stack = [self.root]

    def handle_starttag(self, tag, attrs):
        parent = self.stack[-1]
        el = Element(tag, {k: (v if v is not None else "") for k, v in attrs}, parent)
        parent.children.append(el)
        if tag not in VOID:
            self.stack.append(el)

    def handle_startendtag(self, tag, attrs):
        parent = self.stack[-1]
        parent.children.append(Element(tag, {k: (v if v is not None else "") for k, v in attrs}, parent))

    def handle_endtag(self, tag):
        for i in range(len(self.stack) - 1, 0, -1):
            if self.stack[i].tag == tag:
                del self.stack[i:]
                return

    def handle_data(self, data):
        parent = self.stack[-1]
        kind = "raw" if parent.tag in RAW_TEXT else "text"
        last = parent.children[-1] if parent.children else None
        if isinstance(last, Text) and last.kind == kind:
            last.data += data
        else:
            parent.children.append(Text(data, parent, kind))

    def handle_comment(self, data):
        parent = self.stack[-1]
        parent.children.append(Text(data, parent, "comment"))


def parse(html: str) -> Element:
    b = _Builder()
    b.feed(html)
    b.close()
    return b.root


def release(doc: Element) -> None:
    """Unlink a tree that is no longer read: parents and children hold each other, and would stay until the next full collection."""
    for el in [doc, *doc.iter()]:
        el.children = []


# ---------------------------------------------------------------------------
# H6: the detail-page field walks. Fixed values that must equal the
# reference's: the three icon path prefixes and the "At a glance" heading.
# ---------------------------------------------------------------------------

MONEY_ICON = "M2.5 8C2.22386"
LOCATION_ICON = "M12 2C15.866"
JOB_ICON = "M11.5527 2.72314"
ABOUT_HEADING = "At a glance"

DETAIL_FIELDS = ("wage", "location", "employment_type", "job_type", "about", "apply_type",
                 "position", "times", "company", "industry")


def _safe(fn):
    try:
        return fn()
    except (AttributeError, IndexError, TypeError, ValueError):
        return None


def _icon_div(doc: Element, prefix: str):
    path = doc.find("path", lambda e: e.attrs.get("d", "").startswith(prefix))
    return path.parent.next_sibling("div")


def _position_tag(doc: Element):
    def anchor(e):
        href = e.attrs.get("href")
        return e.tag == "a" and href is not None and href.startswith("/jobs/") and "?searchId=" in href
    return doc.find("h1", lambda e: e.has_ancestor(anchor))


def detail_fields(html: str | None) -> dict:
    """All H6 raw fields of one page (missing node -> None, documents -> [])."""
    out = {k: None for k in DETAIL_FIELDS}
    out["documents"] = []
    if html is None:
        return out
    doc = parse(html)
    out["wage"] = _safe(lambda: _icon_div(doc, MONEY_ICON).find("div").text())
    out["location"] = _safe(lambda: _icon_div(doc, LOCATION_ICON).find("div").text())
    out["employment_type"] = _safe(lambda: _icon_div(doc, JOB_ICON).find_all("div")[1].text())
    out["job_type"] = _safe(lambda: _icon_div(doc, JOB_ICON).find_all("div")[0].text())
    out["about"] = _safe(lambda: doc.find("h3", lambda e: e.string() == ABOUT_HEADING)
                         .parent.parent.next_sibling("div").find("div").find("div").inner_html())
    out["apply_type"] = _safe(lambda: doc.find("button", lambda e: "Apply" in e.attrs.get("aria-label", "")).text())
    pos = _safe(lambda: _position_tag(doc))
    out["position"] = _safe(lambda: pos.text())
    out["times"] = _safe(lambda: pos.parent.next_sibling("div").text())
    out["company"] = _safe(lambda: pos.parent.previous_sibling("div").find("div").find_all("a")[0].find("div").text())
    out["industry"] = _safe(lambda: pos.parent.previous_sibling("div").find("div").find_all("a")[1].find("div").text())
    out["documents"] = [e.attrs["placeholder"] for e in doc.find_all(
        "input", lambda e: "search your" in e.attrs.get("placeholder", "").lower())]
    release(doc)
    return out


# ---------------------------------------------------------------------------
# HTML fragment -> Markdown (headings ATX style, '*' bullets, '**' bold,
# '*' italics, [text](href) links, two-space line breaks).
# ---------------------------------------------------------------------------

_WS = re.compile(r"[ \t\r\n\f]+")


def _escaped(text: str) -> str:
    return _WS.sub(" ", text).replace("*", r"\*").replace("_", r"\_")


def _item(bullet: str, body: str) -> str:
    """A list item; lines after its first (nested lists) are indented under it."""
    first, *rest = [x for x in body.strip().split("\n") if x.strip()] or [""]
    return "\n".join([f"{bullet} {first}", *(" " * (len(bullet) + 1) + x for x in rest)]) + "\n"


def _rendered(node: Element, body: str, lists: list) -> str:
    """Markdown of an element whose children rendered to ``body``; ``lists`` are the lists still open around it."""
    tag, t = node.tag, body.strip()
    if tag in RAW_TEXT:
        return ""
    if tag in ("h1", "h2", "h3", "h4", "h5", "h6"):
        return f"\n\n{'#' * int(tag[1])} {t}\n\n"
    if tag == "p":
        return f"\n\n{t}\n\n"
    if tag == "br":
        return "  \n"
    if tag in ("b", "strong"):
        return f"**{t}**" if t else ""
    if tag in ("i", "em"):
        return f"*{t}*" if t else ""
    if tag == "a":
        href = node.attrs.get("href")
        return f"[{t}]({href})" if href else t
    if tag in ("ul", "ol"):
        nested = body.strip("\n")
        return f"\n{nested}\n" if lists else f"\n\n{nested}\n\n"
    if tag == "li":
        kind = lists[-1] if lists else ["ul", 0]
        kind[1] += 1
        return _item(f"{kind[1]}." if kind[0] == "ol" else "*", body)
    return body


def to_markdown(fragment: str | None) -> str | None:
    """Convert an HTML fragment to Markdown; blank runs of lines are
    collapsed and the result is stripped."""
    if fragment is None:
        return None
    parts: list[list[str]] = [[]]             # rendered children of each open element
    lists: list[list] = []                    # open lists and their item counts
    doc = parse(fragment)
    for entered, node in doc.events():
        if isinstance(node, Text):
            if node.kind == "text":
                parts[-1].append(_escaped(node.data))
        elif entered:
            parts.append([])
            if node.tag in ("ul", "ol"):
                lists.append([node.tag, 0])
        else:
            if node.tag in ("ul", "ol"):
                lists.pop()
            parts[-2].append(_rendered(node, "".join(parts.pop()), lists))
    release(doc)
    text = "".join(parts[0])
    text = re.sub(r"[ ]+\n", lambda m: "  \n" if len(m.group(0)) >= 3 else "\n", text)
    text = re.sub(r"\n{3,}", "\n\n", text)
    return text.strip()
