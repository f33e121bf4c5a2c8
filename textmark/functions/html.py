"""Page extraction inside Catalyst: links, containers, visible text, fields.

``element`` and its kin scan brackets, so elements may nest others of their own name;
``container`` takes one regular expression and ends at the first end tag of that name.
"""

from __future__ import annotations

import json
import re
import zlib
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

from textmark.functions import elements

# Names that also stand without a semicolon, longest first.
_OLD_NAMES = sorted((name for name in html5 if not name.endswith(";")), key=lambda n: (-len(n), n))
_REFERENCE = r"&(?:#[0-9]{1,9}+;?|#[xX][0-9a-fA-F]{1,8}+;?|[A-Za-z][A-Za-z0-9]{1,31}+;|(?:%s)%s)"
_IN_TEXT = _REFERENCE % ("|".join(_OLD_NAMES), "")
# In an attribute such a name is left alone before a letter, a digit or "=".
_IN_ATTRIBUTE = _REFERENCE % ("|".join(_OLD_NAMES), "(?![=A-Za-z0-9])")
_NOT_SHOWN = r"(?is)<!--.*?-->|<(script|style)\b.*?</\1\s*>"


def _opening(tag: str | None, css_class: str | None) -> str:
    """Pattern of an opening tag; without a name, any one, captured as group 1."""
    name = r"(\w+)" if tag is None else f"(?i:{re.escape(tag)})"
    if css_class is None:
        return rf"<{name}\b[^>]*>"
    quoted = rf"""class=["'](?:[^"']*\s)?{re.escape(css_class)}(?:\s[^"']*)?["']"""
    return rf"<{name}\b(?=[^>]*\b{quoted})[^>]*>"


def _closing(tag: str | None) -> str:
    return r"</\1>" if tag is None else f"</(?i:{re.escape(tag)})>"


def hrefs(page: Column, css_class: str | None = None, tag: str | None = "a") -> Column:
    """All link targets in page order, of elements of one class when given.

    ``tag=None`` takes elements of any name.  Values may stand in either kind of quotes
    or bare; links inside comments and scripts are none.
    """
    opening = _opening(tag, css_class).removesuffix("[^>]*>").replace(r"(\w+)", r"\w+", 1)
    value = r"""("[^"]*"|'[^']*'|[^\s"'>]+)"""
    pattern = rf"""{opening}[^>]*?\s(?i:href)\s*=\s*{value}"""
    found = F.regexp_extract_all(F.regexp_replace(page, _NOT_SHOWN, ""), F.lit(pattern), F.lit(1))
    quoted = lambda link: F.substring(link, 1, 1).isin('"', "'")
    return F.transform(
        found,
        lambda link: decoded(
            F.when(quoted(link), F.substring(link, F.lit(2), F.length(link) - 2)).otherwise(link), attribute=True
        ),
    )


def from_element(page: Column, css_class: str) -> Column:
    """The page from the first element of a class on; NULL without one."""
    return F.regexp_substr(page, F.lit(rf"(?s){_opening(None, css_class)}.*"))


def from_element(page: Column, css_class: str) -> Column:
    """The page from the first element of a class on; NULL without one."""
    return F.regexp_substr(page, F.lit(rf"(?s){_opening(None, css_class)}.*"))


def _inside(whole: Column) -> Column:
    return F.regexp_extract(whole, r"(?s)\A<[^>]*>(.*)</", 1)


def container(page: Column, tag: str | None, css_class: str | None = None) -> Column:
    """Inside of the first such element; NULL when the page has none."""
    pattern = rf"(?s){_opening(tag, css_class)}.*?{_closing(tag)}"
    return _inside(F.regexp_substr(page, F.lit(pattern)))


def containers(page: Column, tag: str | None, css_class: str | None = None) -> Column:
    """Insides of all such elements, joined in page order."""
    pattern = rf"(?s){_opening(tag, css_class)}.*?{_closing(tag)}"
    found = F.regexp_extract_all(page, F.lit(pattern), F.lit(0))
    return F.array_join(F.transform(found, _inside), "\n")


def element(page: Column, tag: str | None, css_class: str | None = None) -> Column:
    """Inside of the first such element, whatever it nests; NULL when the page has none."""
    return F.get(elements.insides(page, tag, css_class), F.lit(0))


def all_elements(page: Column, tag: str | None, css_class: str | None = None) -> Column:
    """Insides of all such elements, whatever they nest, joined in page order."""
    return F.array_join(elements.insides(page, tag, css_class), "\n")


def within(page: Column, outer: str, tag: str | None, css_class: str | None = None) -> Column:
    """Inside of the first such element inside any element of class ``outer``."""
    inner = F.transform(elements.insides(page, None, outer), lambda x: element(x, tag, css_class))
    return F.get(F.filter(inner, lambda x: x.isNotNull()), F.lit(0))


def _named(reference: Column) -> Column:
    """Characters of a named reference; NULL for a name that is none.

    The names travel as one folded literal: small maps by checksum.
    """
    buckets: list[dict[str, str]] = [{} for _ in html5]
    for name, characters in html5.items():
        buckets[zlib.crc32(f"&{name}".encode()) % len(buckets)][f"&{name}"] = characters
    table = F.from_json(F.lit(json.dumps(buckets)), "array<map<string,string>>")
    slot = F.pmod(F.crc32(reference.cast("binary")), F.lit(len(buckets))).cast("int")
    return F.try_element_at(F.get(table, slot), reference)


def _numbered(reference: Column) -> Column:
    """The character of a numeric reference; what is no character becomes U+FFFD."""
    digits = F.regexp_extract(reference, "[0-9a-fA-F]+", 0)
    code = F.when(reference.rlike("^&#[xX]"), F.conv(digits, 16, 10)).otherwise(digits).cast("long")
    real = code.between(1, 0xD7FF) | code.between(0xE000, 0x10FFFF)
    data = F.unhex(F.lpad(F.hex(F.when(real, code).otherwise(F.lit(0xFFFD))), 8, "0"))
    return F.decode(data, "UTF-32")


def decoded(text: Column, attribute: bool = False) -> Column:
    """Replace every numeric and named character reference; unknown names stay.

    The text is cut at its references and put together again, all inside Catalyst.
    """
    pattern = _IN_ATTRIBUTE if attribute else _IN_TEXT
    parts = F.split(text, pattern, -1)
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    characters = F.transform(
        found, lambda r: F.when(r.startswith("&#"), _numbered(r)).otherwise(F.coalesce(_named(r), r))
    )
    whole = F.zip_with(parts, F.concat(characters, F.array(F.lit(""))), lambda part, c: F.concat(part, c))
    return F.when(text.contains("&"), F.array_join(whole, "")).otherwise(text)


def visible_text(fragment: Column, scripts: str = "first") -> Column:
    """Text of a fragment: no script, no comment, no tag, references decoded.

    A ``<`` opens a tag only before a letter, ``/``, ``!`` or ``?``.

    ``scripts="first"`` drops only the first script of the fragment, the text of
    later ones stays; ``"all"`` drops every script.
    """
    if scripts == "first":
        fragment = F.regexp_replace(fragment, r"(?is)\A(.*?)<script\b.*?</script>", "$1")
    elif scripts == "all":
        fragment = F.regexp_replace(fragment, r"(?is)<script\b.*?</script>", "")
    else:
        raise ValueError(f"scripts is 'first' or 'all', not {scripts!r}")
    fragment = F.regexp_replace(fragment, r"(?s)<!--.*?-->", "")
    return decoded(F.regexp_replace(fragment, r"<[A-Za-z/!?][^>]*>", ""))


def field(page: Column, pattern: str) -> Column:
    """First group of ``pattern``; NULL when the page has no such element."""
    return F.nullif(F.regexp_extract(page, pattern, 1), F.lit(""))


def tagged_field(page: Column, tag: str, attribute: str, value: str) -> Column:
    """Text of the first ``<tag attribute="value">``, for example a rating."""
    quoted = rf"""{re.escape(attribute)}=["']?{re.escape(value)}["'\s>]"""
    return field(page, rf"<(?i:{re.escape(tag)})\b(?=[^>]*\b{quoted})[^>]*>([^<]*)<")


def site(url: Column) -> Column:
    """Scheme and host."""
    return F.regexp_extract(url, r"^((?i:https?)://[^/?#]+)", 1)


def absolute_url(page_url: Column, href: Column) -> Column:
    """Where a link of a page leads.

    A link with a scheme stays; ``//host`` takes the page's scheme; a path, a query or a
    fragment replaces that part of the page's address; anything else stands beside the
    page.  Dot segments stay as they are.
    """
    before = lambda marks: F.regexp_extract(page_url, rf"^[^{marks}]*", 0)
    folder = F.regexp_extract(before("?#"), r"^(\w+://[^/]*/(?:.*/)?)", 1)
    beside = F.when(folder != "", folder).otherwise(F.concat(site(page_url), F.lit("/")))
    return (
        F.when(href.rlike(r"^[A-Za-z][A-Za-z0-9+.\-]*:"), href)
        .when(href.startswith("//"), F.concat(F.regexp_extract(page_url, r"^(\w+:)", 1), href))
        .when(href.startswith("/"), F.concat(site(page_url), href))
        .when(href.startswith("?"), F.concat(before("?#"), href))
        .when(href.startswith("#"), F.concat(before("#"), href))
        .when(href == "", page_url)
        .otherwise(F.concat(beside, href))
    )
