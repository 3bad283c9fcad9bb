"""HTML, wikitext and office files as text: what needs a parser and therefore runs as an Arrow UDF."""

from __future__ import annotations

import html
import io
import re
import zipfile
from urllib.parse import urljoin, urlsplit
from urllib.robotparser import RobotFileParser
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, DoubleType, StringType, StructType

from . import text as T
from .urls import resolved

_START = re.compile(r"<(a|link)\b((?:[^<>\"']|\"[^\"]*\"|'[^']*')*)>", re.I)
#: What isn't markup though it may look like it.
_HIDDEN = re.compile(r"<!--.*?(?:-->|\Z)|<(script|style)\b[^<>]*>.*?(?:</\1\s*>|\Z)", re.I | re.S)
_ATTRIBUTE = re.compile(r"([a-zA-Z-]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))")


def _bytes(b) -> str:
    return "" if b is None else bytes(b).decode("utf-8", "replace")


def _elements(page: str):
    """``(tag, attributes, text up to the next end of a link)`` of links and head links, in order."""
    page = _HIDDEN.sub(" ", page)
    for m in _START.finditer(page):
        attrs = {a[1].lower(): html.unescape(a[2] or a[3] or a[4] or "") for a in _ATTRIBUTE.finditer(m[2])}
        end = page.find("</", m.end())
        yield m[1].lower(), attrs, page[m.end() : end if end >= 0 else None]


def links_of(page: str, base: str) -> list[str]:
    """Targets of the page's links in order, resolved; repeated ones stay."""
    found = (resolved(a.get("href"), base) for tag, a, _ in _elements(page) if tag == "a")
    return [u for u in found if u]


@F.pandas_udf(ArrayType(StringType()))
def extract_links(content: pd.Series, url: pd.Series) -> pd.Series:
    """:func:`links_of` for page bytes; an empty list for null."""
    return pd.Series([links_of(_bytes(c), u or "") for c, u in zip(content, url)], dtype=object)


#: How a site names its two languages in paths, queries and links.
RW_PATHS = ("/rw/", "/rw-rw/", "/kin/")
EN_PATHS = ("/en/", "/en-us/", "/en-gb/", "/eng/")
QUERY_PAIRS = (("lang=rw", "lang=en"), ("language=rw", "language=en"))
#: Part of a URL, what holds it, the other language's part, whether that is the English side, how sure it is.
_SWAPS = [
    (part, where, other, to_english, sure)
    for where, sure, pairs in (("path", 0.50, tuple(zip(RW_PATHS, EN_PATHS))), ("query", 0.40, QUERY_PAIRS))
    for rw, en in pairs
    for part, other, to_english in ((rw, en, True), (en, rw, False))
]
_RW_NAME = re.compile(r"\b(kinyarwanda|ikinyarwanda)\b", re.I)
_EN_NAME = re.compile(r"\b(english|icyongereza)\b", re.I)
_PAIR = StructType().add("url_rw", StringType()).add("url_en", StringType()).add("confidence", DoubleType()).add("method", StringType())


def page_pair(page: str, url: str) -> tuple | None:
    """The two language versions that a page tells of by its head (0.95), its language links (0.70) or its own URL (0.50 path, 0.40 query)."""
    alternates, rw, en = {}, None, None
    for tag, a, text in _elements(page):
        href = a.get("href")
        if tag == "link" and "alternate" in a.get("rel", "") and a.get("hreflang") and href:
            alternates[a["hreflang"].lower()] = href
        elif tag == "a" and href:
            rw = rw or (href if _RW_NAME.search(text) else None)
            en = en or (href if _EN_NAME.search(text) else None)
    first = next((alternates[k] for k in ("rw", "rw-rw") if k in alternates), None)
    second = next((alternates[k] for k in ("en", "en-us", "en-gb") if k in alternates), None)
    if first and second:
        return urljoin(url, first), urljoin(url, second), 0.95, "hreflang"
    if rw and en:
        return urljoin(url, rw), urljoin(url, en), 0.70, "toggle"
    low = urlsplit(url.lower())
    for part, where, other, to_english, sure in _SWAPS:
        if part in getattr(low, where):
            twin = url.replace(part, other, 1)
            return *((url, twin) if to_english else (twin, url)), sure, "url_pattern"
    return None


@F.pandas_udf(_PAIR)
def language_pair(content: pd.Series, url: pd.Series) -> pd.DataFrame:
    """:func:`page_pair` for page bytes; nulls where there is none."""
    return pd.DataFrame([page_pair(_bytes(c), u or "") or (None,) * 4 for c, u in zip(content, url)], columns=["url_rw", "url_en", "confidence", "method"])


#: Elements of wikitext whose content is no text of the article.
WIKI_DROPPED = (
    "ref", "references", "gallery", "nowiki", "source", "syntaxhighlight", "code", "pre", "math", "score", "timeline", "imagemap", "includeonly", "noinclude", "onlyinclude", "categorytree",
)
#: Headings from which on an article is apparatus.
WIKI_TAIL = (
    "amashakiro", "indanganturo", "imiyoboro", "reba kandi", "ihuza ryo hanze", "inyandiko zifashishijwe", "ibindi gusoma", "ibindi wareba", "ibindi wamenya", "reba aha", "reba ibindi", "ingingo zijyanye",
    "aho byakuwe", "references", "referances", "notes", "external links", "see also", "bibliography", "further reading", "sources",
)
_WIKI_NAMES = r"(?:File|Image|Dosiye|Fichier|Category|Ikiciro|Catégorie)"
#: What stripping leaves behind of sizes, attributes, categories in a line, formulas and magic words.
WIKI_RESIDUE = (
    rf"{_WIKI_NAMES}:[^\n]*",
    r"^\d+(?:x\d+)?px(?:\|.*)?$",
    r"\|?\d+(?:x\d+)?px(?:\]\]|\||$)",
    r"(?:class|style|align|width|colspan|rowspan)=\"[^\"]*\"",
    r"(?:align|colspan|rowspan)=\w+",
    r"^(?:thumb|right|left|center|upright|frameless|border|baseline|middle|sub|super|text-top|text-bottom)(?:\|.*)?$",
    r"^.*\{\\\s\w.*$",
    r"https?://\S+",
    r"__[A-Z]+__",
    r"^[a-z]{2,3}:.*$",
    r"^[|!].*$",
    r"'{2,}",
)
_RESIDUE = re.compile("|".join(WIKI_RESIDUE), re.M | re.I)
_ANGLES = re.compile(r"<<([^>]+)>>|<([a-zA-Z][^>]{0,40})>")
_WIKI_MARK = re.compile(r"\{\{|\}\}|\[\[|\]\]|^\{\||^\|\}", re.M)
_HEADING = re.compile(r"^=+\s*(.*?)\s*=+\s*$", re.M)


#: Fixed value of HTML: elements whose tags vanish and whose content stays; any other word in angle brackets is text.
_MARKERS = re.compile(
    r"</?(?:div|span|br|hr|p|center|blockquote|poem|small|big|b|i|u|s|em|strong|font|sub|sup|del|ins|tt|var|cite|abbr|q|dfn|kbd|samp|li|ul|ol|dl|dd|dt|table|tbody|thead|caption|td|tr|th|h[1-6]|section|ruby|rb|rp|rt|bdi|time|mark)\b[^<>]*>",
    re.I,
)


def _without_elements(t: str) -> str:
    names = "|".join(WIKI_DROPPED)
    t = re.sub(r"<!--.*?-->", "", t, flags=re.S)
    t = re.sub(rf"<(?:{names})\b[^<>]*/>", "", t, flags=re.I)
    t = re.sub(rf"<({names})\b[^<>]*>.*?</\1\s*>", "", t, flags=re.I | re.S)
    t = re.sub(r"<ref\b[^<>]*>[^\n]*|</?(?:ref|references)\s*>", "", t, flags=re.I)
    return _MARKERS.sub("", t)


def _without_brackets(t: str) -> str:
    """One scan with a stack: templates and tables vanish, links leave their label, media and categories vanish with all they hold."""
    out: list[str] = []
    stack: list[tuple[str, int]] = []
    at = 0
    for m in _WIKI_MARK.finditer(t):
        out.append(t[at : m.start()])
        at, mark = m.end(), m[0]
        if mark in ("{{", "[[", "{|"):
            stack.append((mark, len(out)))
            continue
        want = {"}}": "{{", "]]": "[[", "|}": "{|"}[mark]
        k = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == want), -1)
        if k < 0:
            if mark == "|}":
                out.append(mark)
            continue
        begin = stack[k][1]
        inner = "".join(out[begin:])
        del stack[k:], out[begin:]
        if want == "[[" and not re.match(rf"\s*{_WIKI_NAMES}\s*:", inner, re.I) and not re.match(r"[a-z]{2,3}:", inner):
            out.append(inner.rpartition("|")[2])
    out.append(t[at:])
    if stack:  # what was never closed is dropped up to the end of its line, tables to the end
        mark, begin = stack[0]
        rest = "".join(out[begin:])
        del out[begin:]
        out.append(rest if mark == "[[" else "" if mark == "{|" else rest.partition("\n")[2])
    return "".join(out)


def wiki_plain(raw: str) -> str:
    """The article's text: no templates, tables, media, references or apparatus; headings and labels of links stay."""
    t = _without_elements(raw)
    for m in _HEADING.finditer(t):
        if re.sub(r"'{2,}", "", m[1]).strip().rstrip(":").lower() in WIKI_TAIL:
            t = t[: m.start()]
            break
    t = _without_brackets(t)
    t = re.sub(r"\[https?://\S+\s*([^\]]*)\]", r"\1", t)
    t = html.unescape(_HEADING.sub(r"\1", _RESIDUE.sub("", t)))
    t = _ANGLES.sub(lambda m: f'"{m[1]}"' if m[1] else m[2], t)
    t = re.sub("[­​-‏﻿]", "", t)
    t = re.sub(r"\(\s*\)|\[\s*\]", "", t)
    lines = [re.sub(r"^[*#:;]+\s*", "", line.strip()) for line in t.split("\n")]
    end = next((i for i, line in enumerate(lines) if line.rstrip(":").lower() in WIKI_TAIL), len(lines))
    return re.sub(r"\n{3,}", "\n\n", "\n".join(lines[:end])).strip()


@F.pandas_udf(StringType())
def wikitext(s: pd.Series) -> pd.Series:
    """:func:`wiki_plain`; null stays null."""
    return s.map(wiki_plain, na_action="ignore")


def office_plain(data: bytes | None, least: int = 50) -> str | None:
    """Text of a docx or pptx file, a paragraph a line; null if it is neither or has fewer than ``least`` characters."""
    if not data:
        return None
    try:
        with zipfile.ZipFile(io.BytesIO(bytes(data))) as z:
            names = [n for n in z.namelist() if n == "word/document.xml"] or sorted((n for n in z.namelist() if re.fullmatch(r"ppt/slides/slide\d+\.xml", n)), key=lambda n: int(re.search(r"\d+", n)[0]))
            lines = []
            for n in names:
                for p in ElementTree.fromstring(z.read(n)).iter():
                    if p.tag.endswith("}p"):
                        lines.append("".join(x.text or "" for x in p.iter() if x.tag.endswith("}t")))
    except (zipfile.BadZipFile, ElementTree.ParseError, KeyError):
        return None
    text = "\n".join(x for x in lines if x.strip()).strip()
    return text if len(text) >= least else None


@F.pandas_udf(StringType())
def office_text(s: pd.Series) -> pd.Series:
    """:func:`office_plain` over file bytes."""
    return pd.Series([office_plain(x) for x in s], dtype=object)


def robots_allow(url: Column, robots: Column, status: Column, agent: str = "*") -> Column:
    """Whether a site's robots file, fetched with ``status``, lets ``agent`` read the URL: 401 and 403 deny all, other errors and no answer allow all."""

    @F.pandas_udf(BooleanType())
    def allowed(u: pd.Series, text: pd.Series) -> pd.Series:
        parsed: dict = {}
        out = []
        for x, t in zip(u, text):
            if t is not None and t not in parsed:
                parsed[t] = RobotFileParser()
                parsed[t].parse(t.splitlines())
            out.append(t is None or (bool(x) and parsed[t].can_fetch(agent, x)))
        return pd.Series(out)

    told = F.when(status.isNull() | (status >= 400), F.lit(None)).otherwise(robots)
    return ~F.coalesce(status.isin(401, 403), F.lit(False)) & allowed(url, told)


#: Fixed values of HTML: elements that are no main text, and those that end a line.
_ASIDE = re.compile("|".join(rf"<{x}\b.*?(?:</{x}\s*>|\Z)" for x in ("nav", "header", "footer", "aside", "form", "button", "noscript", "head")), re.S | re.I)
_BLOCK = re.compile(r"</?(?:p|div|li|ul|ol|tr|table|h[1-6]|section|article|main|body|blockquote|pre|dd|dt|figure|figcaption)\b[^<>]*>|<br\b[^<>]*>", re.I)
_MAIN = re.compile(r"<(article|main)\b[^<>]*>(.*?)(?:</\1\s*>|\Z)", re.S | re.I)
_PAGE_TITLE = re.compile(r"<title\b[^<>]*>([^<]*)", re.I)


def page_text(page: str, precise: bool = False) -> tuple[str, str] | None:
    """``(title, text)`` of a page by its markup alone: the article or main element (else the body) without navigation, head, foot, asides and forms, a block a line.

    ``precise`` keeps only lines of five words or more.  None where no text is left.  This is the plain way that needs no model.
    """
    title = _PAGE_TITLE.search(page)
    t = _ASIDE.sub(" ", _HIDDEN.sub(" ", page))
    parts = [m[2] for m in _MAIN.finditer(t)]
    t = re.sub(r"<[^<>]*>", "", _BLOCK.sub("\n", re.sub(r"\s+", " ", "\n".join(parts) if parts else t)))
    lines = [" ".join(html.unescape(x).split()) for x in t.split("\n")]
    lines = [x for x in lines if x and (not precise or len(x.split()) >= 5)]
    return (" ".join(html.unescape(title[1]).split()) if title else "", "\n".join(lines)) if lines else None


@F.pandas_udf(StructType().add("title", StringType()).add("text", StringType()))
def main_text(content: pd.Series, precise: pd.Series) -> pd.DataFrame:
    """:func:`page_text` for page bytes; nulls where there is no text."""
    return pd.DataFrame([page_text(_bytes(c), bool(p)) or (None, None) for c, p in zip(content, precise)], columns=["title", "text"])


#: Media types of office files.
OFFICE_TYPES = (
    "application/vnd.openxmlformats-officedocument.wordprocessingml.document", "application/vnd.openxmlformats-officedocument.presentationml.presentation", "application/msword", "application/vnd.ms-powerpoint",
)


def route(content_type: Column) -> Column:
    """Which extractor a fetched file goes to: ``pdf``, ``office`` or, for all else, ``html``."""
    c = F.lower(F.coalesce(content_type, F.lit("")))
    return F.when(F.contains(c, F.lit("application/pdf")), "pdf").when(c.rlike("|".join(re.escape(x) for x in OFFICE_TYPES)), "office").otherwise("html")


def extracted(content: Column, content_type: Column, precise: Column | None = None) -> Column:
    """``struct(text, reason)`` of a fetched file by its route; a route that gives no text says why it failed.  PDF text needs a library that isn't here."""
    way = route(content_type)
    text = F.when(way == "office", office_text(content)).when(way == "html", T.without_frame_lines(main_text(content, F.lit(False) if precise is None else precise)["text"]))
    text = F.when(T.strip(text) != "", text)
    failed = F.when(way == "pdf", "reject.pdf_extraction_failed").when(way == "office", "reject.office_extraction_failed").otherwise("reject.extraction_failed")
    return F.struct(text.alias("text"), F.when(text.isNull(), failed).alias("reason"))


def paragraph_blocks(text: Column, size: int = 2000, least: int = 50) -> Column:
    """Paragraphs joined in order until a block has ``size`` characters; blocks of fewer than ``least`` are left out; null stays null."""
    paragraphs = F.filter(F.transform(F.split(text, r"\n\s*\n"), T.strip), lambda p: p != "")
    start = F.struct(F.array().cast("array<string>").alias("done"), F.lit("").alias("now"), F.lit(0).alias("held"))

    def step(a, p):
        now, held = F.when(a["now"] == "", p).otherwise(F.concat(a["now"], F.lit("\n\n"), p)), a["held"] + F.length(p)
        full = held >= size
        return F.struct(
            F.when(full, F.concat(a["done"], F.array(now))).otherwise(a["done"]).alias("done"), F.when(full, F.lit("")).otherwise(now).alias("now"), F.when(full, F.lit(0)).otherwise(held).alias("held")
        )

    blocks = F.aggregate(paragraphs, start, step, lambda a: F.concat(a["done"], F.array(a["now"])))
    return F.filter(blocks, lambda b: F.length(b) >= least)
