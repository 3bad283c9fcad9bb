"""Web pages as pieces of text, units of pieces, and a tree of elements; what the extraction of articles works on."""

from __future__ import annotations

import html
import re
from dataclasses import dataclass, field

_MARK = re.compile(
    r"<!--.*?(?:-->|\Z)|<(script|style)\b[^<>]*>.*?(?:</\1\s*>|\Z)|<(/?)([a-zA-Z][\w:-]*)([^<>\"']*(?:(?:\"[^\"<>]*\"|'[^'<>]*')[^<>\"']*)*)>|<(/?)([a-zA-Z][\w:-]*)([^<>]*)(?:>|\Z)|<[!?][^<>]*(?:>|\Z)", re.S | re.I
)
_ATTR = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_WORD = re.compile(r"[^\W_]+")
_LETTER = re.compile(r"[^\W\d_]")
_CHARSET = re.compile(rb"charset\s*=\s*[\"']?([\w-]+)", re.I)
_NAMES: dict[str, tuple[str, ...]] = {}

#: Fixed values of HTML: elements without content, elements in a line of text, elements that are a unit by themselves, what an opening tag closes.
VOID = {"br", "img", "hr", "meta", "link", "input", "area", "base", "col", "embed", "source", "wbr"}
INLINE = {"a", "b", "i", "em", "strong", "span", "font", "u", "small", "big", "sub", "sup", "mark", "abbr", "cite", "code", "q", "label", "time"}
PARAGRAPH = {"p", "li", "td", "th", "h1", "h2", "h3", "h4", "h5", "h6", "blockquote", "button", "title", "figcaption", "dt", "dd", "caption", "pre"}
_CLOSES = {"li": {"li"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option"}}
_STOPS = {"table", "ul", "ol", "div", "section", "article", "body", "html"}


@dataclass(slots=True)
class Node:
    tag: str
    parent: int
    depth: int
    names: tuple[str, ...] = ()


@dataclass(slots=True)
class Unit:
    """Pieces that belong together: a paragraph, an item, a cell, a run of text between breaks."""

    node: int
    pieces: list[int] = field(default_factory=list)
    text: str = ""
    linked: int = 0
    in_head: bool = False
    atoms: int = 0
    parts: list[str] = field(default_factory=list)


@dataclass
class Page:
    nodes: list[Node]
    units: list[Unit]
    n_pieces: int
    title: str
    closed: bool


def decoded(body: bytes | None, content_type: str | None = None) -> str:
    """The page's characters: UTF-16 and UTF-8 where the bytes are that (but for a cut last character), else the charset stated, else Windows-1252."""
    if not body:
        return ""
    if body[:2] in (b"\xff\xfe", b"\xfe\xff"):
        return body.decode("utf-16", "replace")
    for end in range(4):
        try:
            return body[: len(body) - end].decode("utf-8").removeprefix("﻿")
        except UnicodeDecodeError as e:
            if e.start < len(body) - 4:
                break
    m = re.search(r"charset\s*=\s*[\"']?([\w-]+)", content_type or "", re.I)
    inside = _CHARSET.search(body)
    named = [m[1] if m else "", inside[1].decode("ascii", "ignore") if inside else ""]
    stated = [x for x in named if x and x.lower().replace("-", "") not in ("utf8", "iso88591", "latin1", "usascii", "ascii")]
    for name in [*stated, "windows-1252"]:
        try:
            return body.decode(name, "replace")
        except LookupError:
            continue
    return body.decode("latin-1")


def is_html(text: str) -> bool:
    return bool(re.search(r"<\s*(?:!doctype\s+html|html|head|body|div|p|table|title)\b", text, re.I))


def plain(text: str) -> str:
    return " ".join((html.unescape(text) if "&" in text else text).split())


def _names(attrs: str) -> tuple[str, ...]:
    """Words of an element's classes, id and role; remembered, as most elements repeat others."""
    found = _NAMES.get(attrs)
    if found is None:
        if len(_NAMES) > 100_000:
            _NAMES.clear()
        found = _NAMES[attrs] = tuple(w.lower() for a in _ATTR.finditer(attrs) for w in re.findall(r"[^\W\d_]+", a[2] or a[3] or a[4] or ""))
    return found


def parse(text: str) -> Page:
    """Pieces are numbered in page order: the text between two neighbouring tags or comments that has a letter after references are resolved."""
    nodes = [Node("#", -1, 0)]
    # per node: the block it is in, the outermost inline element below that block or -1, whether it is in a link of that block
    block_of, top_of, in_link = [0], [-1], [False]
    here, n = 0, 0
    title = ""
    # per parent that is no paragraph: atoms (node of the unit, piece numbers, text, linked, gap before) in order
    units: list[Unit] = []
    open_unit: Unit | None = None
    atom_of = -1
    breaks = 0
    last_kind = ""

    def put(raw: str) -> None:
        nonlocal n, open_unit, atom_of, breaks, last_kind, title
        t = plain(raw)
        if not t:
            return
        letters = bool(_LETTER.search(t))
        block, top = block_of[here], top_of[here]
        whole = nodes[block].tag in PARAGRAPH and nodes[block].tag not in ("td", "th", "li")
        fresh = open_unit is None or open_unit.node != block or (breaks >= 2 and not whole)
        if not fresh and not whole:
            kind = "text" if top < 0 else "inline"
            new_atom = top != atom_of
            # an inline element stands for itself unless text runs on at both sides of it
            if new_atom and ((kind == "inline" and last_kind == "inline") or breaks):
                fresh = True
            elif new_atom and kind == "inline" and len(t.split()) >= 3 and t[:1].isupper() and open_unit.text[-1:] in ".!?%)":
                fresh = True
            elif new_atom and kind == "text" and last_kind == "inline" and open_unit.atoms == 1 and len(open_unit.text.split()) >= 3 and t[:1].isupper():
                fresh = True
        if fresh:
            open_unit = Unit(block, [], "", 0, False, 0, [])
            units.append(open_unit)
        if fresh or top != atom_of:
            open_unit.atoms += 1
        atom_of, last_kind, breaks = top, "text" if top < 0 else "inline", 0
        u = open_unit
        if letters:
            u.pieces.append(n)
            u.parts.append(t)
            n += 1
        u.text = f"{u.text} {t}" if u.text else t
        if in_link[here]:
            u.linked += len(t)
        if nodes[block].tag == "title":
            u.in_head = True
            title = title or t

    closed = False
    # texts and the seven groups of the marks between them, in turn
    split = _MARK.split(text)
    for before, _, end, tag, attrs, bad_end, bad_tag, bad_attrs in zip(*(split[i::8] for i in range(8))):
        if before:
            put(before)
        tag = tag or bad_tag
        if not tag:
            continue
        tag, end, attrs = tag.lower(), end or bad_end, attrs or bad_attrs
        if end:
            k = here
            while k > 0 and nodes[k].tag != tag:
                k = nodes[k].parent
            if k > 0:
                here = nodes[k].parent
                if tag not in INLINE:
                    open_unit = None
            closed = closed or tag == "html"
            continue
        if tag == "br":
            breaks += 1
            continue
        if tag in VOID:
            continue
        if tag not in INLINE:
            open_unit = None
            k = here
            while k > 0 and nodes[k].tag in INLINE:
                k = nodes[k].parent
            if nodes[k].tag == "p":
                here = nodes[k].parent
        if tag in _CLOSES:
            k = here
            while k > 0 and nodes[k].tag not in _STOPS:
                if nodes[k].tag in _CLOSES[tag]:
                    here = nodes[k].parent
                    if tag != "tr":
                        break
                k = nodes[k].parent
        nodes.append(Node(tag, here, nodes[here].depth + 1, _names(attrs) if attrs else ()))
        k = len(nodes) - 1
        inline = tag in INLINE
        block_of.append(block_of[here] if inline else k)
        top_of.append((k if top_of[here] < 0 else top_of[here]) if inline else -1)
        in_link.append(inline and (tag == "a" or in_link[here]))
        here = k
    if split[-1]:
        put(split[-1])
    return Page(nodes, units, n, title, closed)
