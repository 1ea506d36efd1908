"""Addresses: normal forms, identity, dates, sections."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.text import text_of

# Query parameters that don't change what an address names, fixed values.
TRACKING = ("fbclid", "gclid", "mc_cid", "mc_eid")
_PARTS = r"^([A-Za-z][A-Za-z0-9+.-]*)://([^/?#]*)([^?#]*)(?:\?([^#]*))?"


def part(url: Column, group: int) -> Column:
    """1 scheme, 2 host with user and port, 3 path, 4 query; empty where missing."""
    return F.regexp_extract(F.trim(url), _PARTS, group)


def host(url: Column) -> Column:
    """Lower case, without user, port and a leading ``www.``."""
    h = F.regexp_replace(F.lower(part(url, 2)), r"^.*@|:\d*$", "")
    return F.regexp_replace(h, r"^www\.", "")


def without_fragment(url: Column | str) -> Column:
    """No fragment and nothing from ``?utm_source`` on."""
    return F.regexp_replace(F.regexp_replace(F.trim(text_of(url)), "#.*$", ""), r"\?utm_source.*$", "")


def without_utm(url: Column | str) -> Column:
    """No fragment and no ``utm_*`` parameters; other parameters keep their order, empty ones too."""
    bare = F.regexp_replace(F.trim(text_of(url)), "#.*$", "")
    kept = F.filter(F.split(F.regexp_extract(bare, r"\?(.*)$", 1), "&"), lambda p: (p != "") & ~p.startswith("utm_"))
    head = F.regexp_replace(bare, r"\?.*$", "")
    return F.when(F.size(kept) > 0, F.concat(head, F.lit("?"), F.array_join(kept, "&"))).otherwise(head)


def _decoded(c: Column) -> Column:
    """A component of a query as text: ``+`` is a space; what can't be decoded stays."""
    return F.coalesce(F.try_url_decode(F.replace(c, F.lit("+"), F.lit(" "))), c)


def _encoded(c: Column) -> Column:
    """Letters, digits and ``_.-~`` stay, spaces become ``+``."""
    return F.replace(F.replace(F.url_encode(c), F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~"))


def article_key(canonical: Column | str, url: Column | str | None = None) -> Column:
    """What an article's address identifies; empty if there is no http address.

    https, host without ``www.``, no port, no trailing slash, no fragment, no tracking
    parameters; the others decoded, sorted by name and value, and encoded anew, so that
    different spellings of one parameter are one key. A parameter without ``=`` has an
    empty value.
    """
    u = F.nullif(F.trim(text_of(canonical)), F.lit(""))
    if url is not None:
        u = F.coalesce(u, F.nullif(F.trim(text_of(url)), F.lit("")))
    u = F.coalesce(u, F.lit(""))
    pairs = F.transform(F.filter(F.split(part(u, 4), "&"), lambda p: p != ""), lambda p: F.struct(_decoded(F.substring_index(p, "=", 1)).alias("name"), _decoded(F.when(p.contains("="), F.regexp_replace(p, "^[^=]*=", "")).otherwise("")).alias("value")))
    kept = F.array_sort(F.filter(pairs, lambda p: ~F.lower(p["name"]).startswith("utm_") & ~F.lower(p["name"]).isin(*TRACKING)))
    written = F.transform(kept, lambda p: F.concat(_encoded(p["name"]), F.lit("="), _encoded(p["value"])))
    query = F.when(F.size(written) > 0, F.concat(F.lit("?"), F.array_join(written, "&"))).otherwise("")
    good = F.lower(part(u, 1)).isin("http", "https") & (host(u) != "")
    return F.when(good, F.concat(F.lit("https://"), host(u), F.regexp_replace(part(u, 3), "/+$", ""), query)).otherwise("")


def url_date(url: Column | str) -> Column:
    """The date in ``/YYYY/MM/DD/`` of an address, else null."""
    d = F.regexp_extract(text_of(url), r"/(20\d{2}/\d{2}/\d{2})(?:/|$)", 1)
    return F.try_to_timestamp(F.nullif(d, F.lit("")), F.lit("yyyy/MM/dd")).cast("date")


def is_article(url: Column | str, hosts: list[str], excluded: list[str] = [], min_segments: int = 2) -> Column:  # noqa: B006
    """An address of one of ``hosts`` whose path has enough segments and none of the excluded beginnings."""
    u = text_of(url)
    path = part(u, 3)
    good = host(u).isin(*hosts) & (F.size(F.filter(F.split(path, "/"), lambda s: s != "")) >= min_segments)
    for x in excluded:
        good &= ~path.startswith(x)
    return good


# What the addresses of articles look like at the two styles of site, fixed values.
ARTICLE_RULES = {
    "shtml": {
        "hosts": ("www.biobiochile.cl", "biobiochile.cl"),
        "needs": r"(?i)/noticias/.*\.shtml$",
        "excluded": ("/biobiotv/", "/podcasts/", "/programas/", "/especial/", "/especiales/", "/legales/"),
    },
    "dated": {
        "hosts": ("www.elmostrador.cl", "elmostrador.cl"),
        "needs": r"/20\d{2}/\d{2}/\d{2}/",
        "excluded": ("/autor/", "/tag/", "/tags/", "/wp-content/", "/wp-json/", "/newsletter", "/categoria/", "/dia/", "/page/", "/quienes-somos", "/carta-etica", "/principios-editoriales", "/politicas-de-privacidad", "/contactenos"),
    },
}


def article_address(url: Column | str, style: str) -> Column:
    """Whether an address is that of an article of a style of site: its host as written, a path of the right form, none of the excluded fragments."""
    rule = ARTICLE_RULES[style]
    u = text_of(url)
    path = F.lower(part(u, 3)) if style == "shtml" else part(u, 3)
    good = part(u, 2).isin(*rule["hosts"]) & path.rlike(rule["needs"])
    for x in rule["excluded"]:
        good &= ~path.contains(x)
    return good


def segments(url: Column | str) -> Column:
    return F.filter(F.split(part(text_of(url), 3), "/"), lambda s: s != "")


def sections(url: Column | str, skip: tuple[str, ...] = ("noticias", "especial", "lists")) -> Column:
    """``main_section`` and ``subsection`` from the path, after segments that name no section."""
    s = F.filter(segments(url), lambda x: ~x.isin(*skip) & ~x.rlike(r"^\d+$") & ~x.rlike(r"\.\w+$"))
    pick = lambda k: F.coalesce(F.try_element_at(s, F.lit(k)), F.lit(""))
    return F.struct(pick(1).alias("main_section"), F.when(F.size(s) > 2, pick(2)).otherwise("").alias("subsection"))


def slug_of(url: Column | str, suffix: str = ".shtml") -> Column:
    """The last segment of the path without the suffix."""
    last = F.coalesce(F.try_element_at(segments(url), F.lit(-1)), F.lit(""))
    return F.when(last.endswith(suffix), F.left(last, F.length(last) - len(suffix))).otherwise(last)


def file_name(url: Column | str) -> Column:
    """A name for the stored page: signs to underscores, at most 120 long."""
    return F.left(F.regexp_replace(slug_of(url), "[^a-zA-Z0-9_-]+", "_"), F.lit(120))
