"""Elements of a page by a scan of its brackets, inside Catalyst.

The page is cut at its tags; a running depth over the array of tags tells where an element
ends that holds others of its own name.  Comments, scripts and styles are passed over as a
whole, elements without an end tag hold nothing, and an element that is never closed ends
with the page.  Cost is one pass over the tags, whatever their nesting.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Elements without an end tag.
VOID_ELEMENTS = tuple("area base br col embed hr img input link meta param source track wbr".split())
_HIDDEN = ("script", "style")
_SPANS = "array<struct<s:int,e:int>>"


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)``, with ``value`` computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _has_class(opening: Column, css_class: str | None) -> Column:
    if css_class is None:
        return F.lit(True)
    name = re.escape(css_class)
    listed = rf"(?:[^%s]*\s)?{name}(?:\s[^%s]*)?"
    quoted = "|".join(f"{q}{listed % (q, q)}{q}" for q in "\"'")
    return opening.rlike(rf"(?s)^<[^>]*\s(?i:class)\s*=\s*(?:{quoted}|{name}(?=[\s>]))")


def _spans(tags: Column, tag: str | None, css_class: str | None) -> Column:
    """First and last tag, by number, of the outermost elements that are wanted."""

    def step(t: Column) -> Column:
        name = F.lower(F.regexp_extract(t, r"^</?([A-Za-z][^\s/>]*)", 1))
        shown = ~name.isin(*VOID_ELEMENTS, *[x for x in _HIDDEN if x != tag])
        return F.struct(
            F.when(shown, name).otherwise(F.lit("")).alias("name"),
            t.startswith("</").alias("closes"),
            _has_class(t, css_class).alias("fits"),
        )

    start = F.struct(
        F.lit(0).alias("i"), F.lit(0).alias("depth"), F.lit("").alias("name"), F.lit(0).alias("start"),
        F.array().cast(_SPANS).alias("found"),
    )

    def move(at: Column, t: Column) -> Column:
        inside = at["depth"] > 0
        begins = ~inside & ~t["closes"] & (t["name"] != "") & t["fits"]
        same = inside & (t["name"] == at["name"])
        depth = (
            F.when(begins, F.lit(1))
            .when(same & t["closes"], at["depth"] - 1)
            .when(same, at["depth"] + 1)
            .otherwise(at["depth"])
        )
        ends = same & t["closes"] & (at["depth"] == 1)
        span = F.array(F.struct(at["start"].alias("s"), at["i"].alias("e")))
        return F.struct(
            (at["i"] + 1).alias("i"), depth.alias("depth"), F.when(begins, t["name"]).otherwise(at["name"]).alias("name"),
            F.when(begins, at["i"]).otherwise(at["start"]).alias("start"),
            F.when(ends, F.concat(at["found"], span)).otherwise(at["found"]).alias("found"),
        )

    def finish(at: Column) -> Column:
        rest = F.array(F.struct(at["start"].alias("s"), at["i"].alias("e")))
        return F.when(at["depth"] > 0, F.concat(at["found"], rest)).otherwise(at["found"])

    return F.aggregate(F.transform(tags, step), start, move, finish)


def insides(page: Column, tag: str | None = None, css_class: str | None = None) -> Column:
    """Insides of the outermost elements of a name (any when ``None``) and class, in page order.

    A wanted element inside another one is part of it.  NULL for no page.
    """
    name = r"[A-Za-z][^\s/>]*" if tag is None else re.escape(tag)
    hidden = "|".join(rf"<{x}\b[^>]*>.*?</{x}\s*>" for x in _HIDDEN if x != tag)
    pattern = rf"(?is)<!--.*?-->|{hidden}|</?{name}(?=[\s/>])[^>]*>"
    wanted = None if tag is None else tag.lower()

    def cut(x: Column) -> Column:
        pieces = F.zip_with(x["parts"], F.concat(x["tags"], F.array(F.lit(""))), lambda part, t: F.concat(part, t))
        return let(
            F.struct(pieces.alias("pieces"), x["parts"].alias("parts"), _spans(x["tags"], wanted, css_class).alias("spans")),
            lambda y: F.transform(
                y["spans"],
                lambda at: F.concat(
                    F.array_join(F.slice(y["pieces"], at["s"] + 2, at["e"] - at["s"] - 1), ""), F.get(y["parts"], at["e"])
                ),
            ),
        )

    tags = F.regexp_extract_all(page, F.lit(pattern), F.lit(0))
    cuts = F.struct(tags.alias("tags"), F.split(page, pattern, -1).alias("parts"))
    return F.when(page.isNotNull(), let(cuts, cut))
