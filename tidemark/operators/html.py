"""Articles from raw pages: a tree from the standard library's parser, one pass per page, in Arrow batches."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from html.parser import HTMLParser
from urllib.parse import urljoin, urlsplit

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.text import text_of

VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
HIDDEN = frozenset("script style noscript iframe svg".split())
# What is no part of an article, types that JSON-LD gives an article, and parts of class names of the node that holds it; fixed values.
UNWANTED = frozenset(("script", "style", "noscript", "iframe", "svg", "form", "button", "aside", "nav", "footer", "header"))
ARTICLE_TYPES = frozenset(("newsarticle", "article", "reportagearticle"))
CONTAINER_CLASSES = ("article", "post", "nota")
MIN_PARAGRAPH, MAX_HEADING = 25, 180
DOCUMENT = re.compile(r"\.(?:pdf|docx?|xlsx?|pptx?)(?:$|\?)", re.I)
SHARE = ("facebook.com/sharer", "twitter.com/intent", "x.com/intent", "api.whatsapp.com", "wa.me", "linkedin.com/share", "t.me/share", "mailto:")


class Node:
    __slots__ = ("tag", "attrs", "children", "parent")

    def __init__(self, tag: str, attrs: dict[str, str], parent: Node | None):
        self.tag, self.attrs, self.children, self.parent = tag, attrs, [], parent

    def walk(self, skip: frozenset[str] = frozenset()) -> Iterator[Node]:
        stack = [self]
        while stack:
            n = stack.pop()
            if n.tag in skip and n is not self:
                continue
            yield n
            stack.extend(c for c in reversed(n.children) if isinstance(c, Node))

    def text(self, sep: str = " ", skip: frozenset[str] = HIDDEN) -> str:
        parts, stack = [], list(reversed(self.children))
        while stack:
            n = stack.pop()
            if isinstance(n, str):
                if n.strip():
                    parts.append(n.strip())
            elif n.tag not in skip:
                stack.extend(reversed(n.children))
        return sep.join(parts)

    def has_class(self, name: str) -> bool:
        return name in self.attrs.get("class", "")


class _Builder(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = self.at = Node("", {}, None)

    def handle_starttag(self, tag, attrs):
        if tag in ("p", "li") and self.at.tag == tag and self.at.parent:
            self.at = self.at.parent
        node = Node(tag, {k: v or "" for k, v in attrs}, self.at)
        self.at.children.append(node)
        if tag not in VOID:
            self.at = node

    def handle_startendtag(self, tag, attrs):
        self.at.children.append(Node(tag, {k: v or "" for k, v in attrs}, self.at))

    def handle_endtag(self, tag):
        n = self.at
        while n and n.tag != tag:
            n = n.parent
        if n and n.parent:
            self.at = n.parent

    def handle_data(self, data):
        self.at.children.append(data)


def tree(html: str | None) -> Node:
    b = _Builder()
    b.feed(html or "")
    b.close()
    return b.root


def squeezed(s: str) -> str:
    return " ".join(re.sub(r"\{\{.*?\}\}", "", s).split())


def json_ld(root: Node) -> list[dict]:
    """Objects of all JSON-LD scripts, lists and graphs opened; broken scripts are passed over."""
    out: list[dict] = []
    for n in root.walk():
        if n.tag != "script" or n.attrs.get("type", "").strip().lower() != "application/ld+json":
            continue
        try:
            data = json.loads("".join(c for c in n.children if isinstance(c, str)))
        except ValueError:
            continue
        for item in data if isinstance(data, list) else [data]:
            if isinstance(item, dict):
                out += [g for g in item["@graph"] if isinstance(g, dict)] if isinstance(item.get("@graph"), list) else [item]
    return out


def article_ld(items: list[dict], types: frozenset[str] = ARTICLE_TYPES) -> dict:
    """The first object of one of the types, whatever their case."""
    for i in items:
        kinds = i.get("@type")
        if types & {str(k).lower() for k in (kinds if isinstance(kinds, list) else [kinds])}:
            return i
    return {}


def meta(root: Node, key: str) -> str:
    for attr in ("property", "name"):
        for n in root.walk():
            if n.tag == "meta" and n.attrs.get(attr) == key and n.attrs.get("content"):
                return squeezed(n.attrs["content"])
    return ""


def first(root: Node, *tags: str) -> Node | None:
    return next((n for n in root.walk() if n.tag in tags), None)


def title(root: Node, ld: dict) -> str:
    """From JSON-LD, else h1, else og:title, else the title tag."""
    h1, t = first(root, "h1"), first(root, "title")
    return next((s for s in (squeezed(str(ld.get("headline") or "")), squeezed(h1.text()) if h1 else "", meta(root, "og:title"), squeezed(t.text()) if t else "") if s), "")


def canonical(root: Node, url: str) -> str:
    for n in root.walk():
        if n.tag == "link" and "canonical" in n.attrs.get("rel", "").lower() and n.attrs.get("href"):
            return urljoin(url, n.attrs["href"].strip())
    return url


def container(root: Node) -> Node:
    """The node that holds the article: article, main, a class named after one, the body, or all."""
    named = [lambda n, c=c: c in n.attrs.get("class", "") for c in CONTAINER_CLASSES]
    for test in (lambda n: n.tag == "article", lambda n: n.tag == "main", *named, lambda n: n.tag == "body"):
        if found := next((n for n in root.walk() if test(n)), None):
            return found
    return root


def body(node: Node, ld: dict, boilerplate: re.Pattern | None = None) -> list[str]:
    """Paragraphs of at least 25 characters, each once; else the article body of JSON-LD; else lines of text."""
    good = lambda s: len(s) >= MIN_PARAGRAPH and not (boilerplate and boilerplate.search(s))
    found = [s for n in node.walk(UNWANTED) if n.tag == "p" and good(s := squeezed(n.text()))]
    if not found and isinstance(ld.get("articleBody") or ld.get("text"), str):
        found = [s for line in re.split(r"\n+", ld.get("articleBody") or ld["text"]) if good(s := squeezed(line))]
    if not found:
        found = [s for line in node.text("\n", UNWANTED).splitlines() if good(s := squeezed(line))]
    return list(dict.fromkeys(found))


def headings(node: Node) -> list[str]:
    return list(dict.fromkeys(s for n in node.walk(UNWANTED) if n.tag in ("h2", "h3") and (s := squeezed(n.text())) and len(s) < MAX_HEADING))


def author(root: Node, ld: dict) -> tuple[str, str]:
    """Name and kind: agency, organisation, person or unknown."""
    a = ld.get("author")
    a = a[0] if isinstance(a, list) and a else a
    name = squeezed(str(a.get("name") or "")) if isinstance(a, dict) else squeezed(a) if isinstance(a, str) else ""
    name = name or meta(root, "author") or next((squeezed(n.text()) for n in root.walk() if n.attrs.get("rel") == "author" or n.has_class("author") or n.has_class("byline")), "")
    low = name.lower()
    kind = "unknown" if not name else "agency" if re.search(r"\b(?:agencia|efe|afp|reuters|ap)\b", low) else "organization" if isinstance(a, dict) and a.get("@type") == "Organization" else "person"
    return name, kind


def published(root: Node, ld: dict) -> str:
    """What JSON-LD, else meta tags, else a time tag, else a visible Spanish date say."""
    t = next((n.attrs.get("datetime", "") for n in root.walk() if n.tag == "time" and n.attrs.get("datetime")), "")
    for s in (str(ld.get("datePublished") or ""), meta(root, "article:published_time"), meta(root, "date"), t):
        if s.strip():
            return s.strip()
    from tidemark.functions.dates import MONTHS

    m = re.search(r"\b\d{1,2}\s+(?:de\s+)?(?:" + "|".join(MONTHS) + r"),?\s+(?:de\s+)?\d{4}\b(?:[^\d]{1,10}\d{1,2}:\d{2})?", root.text(), re.I)
    return m[0] if m else ""


def heading_before(a: Node) -> str:
    """The nearest heading that precedes a node on its way up."""
    n: Node | None = a
    while n and n.parent:
        before = n.parent.children[: n.parent.children.index(n)]
        for sibling in reversed(before):
            if isinstance(sibling, Node):
                found = [x for x in sibling.walk() if x.tag in ("h1", "h2", "h3", "h4")]
                if found:
                    return squeezed(found[-1].text())
        n = n.parent
    return ""


def links(root: Node, node: Node, url: str) -> list[dict]:
    """Links of a page with text, place (body or page), kind (internal, external, document, share) and heading."""
    inside = {id(n) for n in node.walk(UNWANTED)}
    host = urlsplit(url).hostname or ""
    out, seen = [], set()
    for n in root.walk():
        href = n.attrs.get("href", "").strip() if n.tag == "a" else ""
        if not href or href.startswith(("#", "javascript:")):
            continue
        full = urljoin(url, href)
        if full in seen:
            continue
        seen.add(full)
        other = urlsplit(full).hostname or ""
        kind = "share" if any(s in full for s in SHARE) else "document" if DOCUMENT.search(full) else "internal" if other.removeprefix("www.") == host.removeprefix("www.") else "external"
        head = heading_before(n)
        low = f"{head} {n.parent.text() if n.parent else ''}".lower()
        role = "read_also" if "lee también" in low or "lee tambien" in low else "related" if "relacionad" in low or "te puede interesar" in low else ""
        out.append({"url": full, "text": squeezed(n.text()), "place": "body" if id(n) in inside else "page", "kind": kind, "role": role, "heading": head})
    return out


def media(node: Node, ld: dict, url: str) -> dict:
    """Images with alternative text and credit, and whether there is video or audio."""
    images, credit = [], ""
    for n in node.walk():
        if n.tag == "img":
            src = next((n.attrs[a] for a in ("src", "data-src", "data-lazy-src") if n.attrs.get(a)), "")
            if src and not src.startswith("data:"):
                images.append((urljoin(url, src), squeezed(n.attrs.get("alt", ""))))
        elif n.tag == "figcaption" and not credit:
            m = re.search(r"(?:foto|cr[eé]ditos?|imagen|agencia)\s*:?\s*(.{2,80})$", squeezed(n.text()), re.I)
            credit = m[1] if m else ""
    frames = [n.attrs.get("src", "") for n in node.walk() if n.tag in ("iframe", "embed")]
    video = any(n.tag == "video" for n in node.walk()) or any(re.search("youtube|vimeo|dailymotion", s) for s in frames)
    audio = any(n.tag == "audio" for n in node.walk()) or any(re.search("spotify|soundcloud|ivoox", s) for s in frames)
    if not images and ld.get("image"):
        i = ld["image"]
        i = i[0] if isinstance(i, list) and i else i
        src = i.get("url", "") if isinstance(i, dict) else i if isinstance(i, str) else ""
        images = [(urljoin(url, src), "")] if src else []
    return {"main_image": images[0][0] if images else "", "main_image_alt": images[0][1] if images else "", "image_count": len(images), "image_credit": credit, "has_video": video, "has_audio": audio}


def breadcrumb(root: Node) -> str:
    return next((s for n in root.walk() if (n.has_class("breadcrumb") or n.attrs.get("aria-label") == "breadcrumb") and (s := squeezed(n.text()))), "")


def ai_summary(root: Node) -> str:
    """A summary that the page marks as made by a model."""
    for n in root.walk():
        if any(n.has_class(c) for c in ("ai-summary", "resumen-ia", "article-summary")):
            return squeezed(n.text())
    return ""


RECORD = (
    "url string, canonical_url string, title string, subtitle string, lead string, ai_summary string, author_name string, author_type string, published_at_raw string, "
    "breadcrumb_raw string, paragraphs array<string>, internal_subheadings array<string>, body_text_raw string, body_text_clean string, paragraph_count int, body_length_chars int, "
    "body_length_words int, quote_count int, main_image string, main_image_alt string, image_count int, image_credit string, has_video boolean, has_audio boolean, template_noise boolean, "
    "links array<struct<url:string,text:string,place:string,kind:string,role:string,heading:string>>, parse_errors array<string>, parse_success boolean"
)


def record(html: str | None, url: str | None, boilerplate: re.Pattern | None = None) -> dict:
    """Everything about one page. What is missing is named in ``parse_errors``; a page that can't be read is an empty record."""
    url = url or ""
    errors: list[str] = []
    try:
        root = tree(html)
        ld = article_ld(json_ld(root))
        node = container(root)
        text = body(node, ld, boilerplate)
        out = {"url": url, "canonical_url": canonical(root, url), "title": title(root, ld), "ai_summary": ai_summary(root), "published_at_raw": published(root, ld), "breadcrumb_raw": breadcrumb(root), "paragraphs": text, "internal_subheadings": headings(node), "links": links(root, node, url), **media(node, ld, url)}
        out["subtitle"] = squeezed(str(ld.get("description") or "")) or meta(root, "description") or meta(root, "og:description")
        out["author_name"], out["author_type"] = author(root, ld)
    except Exception as e:  # noqa: BLE001  a page is foreign input
        errors.append(f"parse: {type(e).__name__}")
        text, out = [], {"url": url, "canonical_url": url, "title": "", "subtitle": "", "ai_summary": "", "published_at_raw": "", "breadcrumb_raw": "", "paragraphs": [], "internal_subheadings": [], "links": [], "author_name": "", "author_type": "unknown", "main_image": "", "main_image_alt": "", "image_count": 0, "image_credit": "", "has_video": False, "has_audio": False}
    clean = " ".join(text)
    errors += [f"missing_{k}" for k, v in (("title", out["title"]), ("body", text)) if not v]
    return out | {"lead": text[0] if text else "", "body_text_raw": "\n".join(text), "body_text_clean": clean, "paragraph_count": len(text), "body_length_chars": len(clean), "body_length_words": len(clean.split()), "quote_count": clean.count("“") + clean.count('"') // 2, "template_noise": "{{" in (html or "") or "}}" in (html or ""), "parse_errors": errors, "parse_success": not errors}


def extract(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html", boilerplate: str | None = None) -> DataFrame:
    """``key`` and the record of each page."""
    names = [f.split(" ")[0] for f in re.split(r", (?![^<]*>)", RECORD)]

    def go(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pattern = re.compile(boilerplate, re.I) if boilerplate else None
        for b in batches:
            rows = [record(h, u, pattern) for h, u in zip(b[html], b[url])]
            out = pd.DataFrame(rows, columns=names)
            out.insert(0, key, b[key].to_numpy())
            yield out

    kind = pages.schema[key].dataType.simpleString()
    return pages.select(key, url, html).mapInPandas(go, f"{key} {kind}, {RECORD}")


def paragraphs(html: Column | str, least: int = MIN_PARAGRAPH) -> Column:
    """Paragraphs by pattern, in the JVM: text of ``<p>`` without tags, long enough, each once."""
    raw = F.regexp_extract_all(text_of(html), F.lit(r"(?is)<p(?:\s[^>]*)?>(.*?)</p>"), 1)
    clean = F.transform(raw, lambda x: F.trim(F.regexp_replace(F.regexp_replace(x, r"<[^>]+>", " "), r"\s+", " ")))
    return F.array_distinct(F.filter(clean, lambda x: F.length(x) >= least))


def hrefs(html: Column | str) -> Column:
    """Targets of links by pattern, in the JVM, each once, in order."""
    return F.array_distinct(F.regexp_extract_all(text_of(html), F.lit(r"""(?i)<a\s[^>]*href="([^"#]+)["#]"""), 1))
