"""Links between stored pages."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textmark.functions import html
from textmark.operators.lookup import lookup_join
from textmark.runtime import written


def link_rows(pages: DataFrame, links: Column) -> DataFrame:
    """``(page_id, url, pos, href)``: one row per link, in page order."""
    rows = pages.select("page_id", "url", F.posexplode_outer(links).alias("pos", "href"))
    return rows.where(F.col("href").isNotNull())


def absolute_links(links: DataFrame) -> DataFrame:
    return links.withColumn("target", html.absolute_url(F.col("url"), F.col("href")))


def _one_page_per_url(pages: DataFrame) -> DataFrame:
    return pages.groupBy(F.col("url").alias("target")).agg(F.min("page_id").alias("target_page"))


def follow(links: DataFrame, pages: DataFrame) -> DataFrame:
    """Links beside the stored page they lead to; others drop."""
    return lookup_join(links, _one_page_per_url(pages), ["target"], "inner", ["page_id", "pos"])


def traverse(links: DataFrame, seeds: DataFrame, most: int | None = None) -> DataFrame:
    """``(page_id, level)`` of every page that is reached from ``seeds(page_id)``, level 0.

    ``links(page_id, pos, target_page)`` are followed one level at a time.  The pages of a
    level are the targets of the level before that no earlier level holds, so cycles end;
    a level without pages, or level ``most``, is the last.  Each level is written: a lost
    executor repeats one level, not the way to it.  The pages to follow are broadcast while
    they fit; beyond that, links of a page that holds very many are spread by position.
    """
    edges = written(links.select("page_id", "pos", "target_page"), "links")
    here = written(seeds.select("page_id").distinct(), "level-0")
    levels = [here.withColumn("level", F.lit(0))]
    while most is None or len(levels) <= most:
        seen = _all(levels).select("page_id")
        found = lookup_join(edges, here, ["page_id"], "inner", ["pos"])
        found = found.select(F.col("target_page").alias("page_id")).distinct()
        here = written(found.join(seen, "page_id", "left_anti"), f"level-{len(levels)}")
        if here.isEmpty():
            break
        levels.append(here.withColumn("level", F.lit(len(levels))))
    return _all(levels)


def _all(levels: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.union, levels)


def missing(links: DataFrame, pages: DataFrame) -> DataFrame:
    """Links whose page is not stored."""
    known = _one_page_per_url(pages).select("target")
    return lookup_join(links, known, ["target"], "left_anti", ["page_id", "pos"])


def site_sizes(pages: DataFrame) -> DataFrame:
    """One row per site: stored pages and the first of them."""
    return pages.groupBy(html.site(F.col("url")).alias("site")).agg(
        F.count("*").alias("site_pages"), F.min("page_id").alias("first_page")
    )


def with_site(links: DataFrame, pages: DataFrame) -> DataFrame:
    """Links beside the size of the site they lead to."""
    sited = links.withColumn("site", html.site(F.col("target")))
    return lookup_join(sited, site_sizes(pages), ["site"], "inner", ["page_id", "pos"])


def until_empty(
    listing: DataFrame, group: str, number: str, n_links: str, key: str = "page_id"
) -> DataFrame:
    """Listing pages before the first one of their group that has no links.

    The stop number folds map-side to one row per group; a group that holds most
    pages is not gathered anywhere.  Pages without a group are a group too.
    """
    empty_at = F.min(F.when(F.col(n_links) == 0, F.col(number)))
    # A row of one column equals another even where the column is NULL.
    stops = listing.groupBy(F.struct(group).alias("_group")).agg(empty_at.alias("_stop"))
    grouped = listing.withColumn("_group", F.struct(group))
    joined = lookup_join(grouped, stops, ["_group"], "inner", [key])
    open_end = F.col("_stop").isNull()
    return joined.where(open_end | (F.col(number) < F.col("_stop"))).select(*listing.columns)
