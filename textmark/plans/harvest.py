"""Stored pages to review records."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textmark.functions import html
from textmark.functions.text import parsed_rating
from textmark.operators.sampling import union_labelled


@dataclass(frozen=True)
class PageLayout:
    """Where a review page keeps its text and its rating.

    The text is the first element of a tag (any when ``None``) and class inside an
    element of class ``within``, however they nest.  Fixed values: the defaults are
    those of the review pages the stored ones were taken from.  ``parse`` is kept for
    layouts that were written with it and needs a tag; it changes nothing.
    """

    tag: str | None = None
    css_class: str | None = "text"
    within: str | None = "reviewPage"
    rating: tuple[str, str, str] = ("span", "itemprop", "ratingValue")
    scripts: str = "first"
    parse: bool = False

    def __post_init__(self) -> None:
        if self.parse and self.tag is None:
            raise ValueError("a parsed layout needs a tag")

    def text(self, page: Column) -> Column:
        if self.within is not None:
            inside = html.within(page, self.within, self.tag, self.css_class)
        else:
            inside = html.element(page, self.tag, self.css_class)
        return html.visible_text(inside, self.scripts)


def review_records(pages: DataFrame, layout: PageLayout = PageLayout()) -> DataFrame:
    """``(page_id, rating, text)`` per page; a missing rating or text is NULL.

    One projection: the page source goes no further than this.
    """
    page = F.col("html")
    rating = parsed_rating(html.tagged_field(page, *layout.rating))
    return pages.select("page_id", rating.alias("rating"), layout.text(page).alias("text"))


def gather(records: Sequence[DataFrame]) -> DataFrame:
    """Records of several sources as one table."""
    return union_labelled(*records)
