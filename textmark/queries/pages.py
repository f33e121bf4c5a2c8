"""Links, texts and fields of stored pages."""

from pyspark.sql import functions as F

from textmark.functions import html, html_parser
from textmark.operators import links as L
from textmark.operators.lookup import lookup_join
from textmark.operators.ranking import row_index
from textmark.plans.harvest import PageLayout, gather, review_records
from textmark.queries import sql as S
from textmark.queries.registry import query
from textmark.sources import tables

_ARTICLE = PageLayout(tag="article", css_class=None, within=None)

# The references that the given pages hold; the ampersand comes last.
_SQL_REFERENCES = (("quot", '"'), ("copy", "©"), ("middot", "·"), ("nbsp", "\u00a0"), ("lt", "<"), ("gt", ">"), ("amp", "&"))
_SHOWN = "regexp_replace({html}, '(?is)<!--.*?-->|<script\\b.*?</script\\s*>|<style\\b.*?</style\\s*>', '', 'g')"
_HREFS = """regexp_extract_all({html}, '<a\\b[^>]*?\\shref\\s*=\\s*("[^"]*"|''[^'']*''|[^\\s"''>]+)', 1)"""
_NAV = "array_to_string(regexp_extract_all(html, '(?s)<nav\\b[^>]*>(.*?)</nav>', 1), chr(10))"


def _decoded_sql(text, semicolon=";"):
    for name, character in _SQL_REFERENCES:
        text = f"regexp_replace({text}, '&{name}{semicolon}', '{character}', 'g')"
    return text


def _link_rows_sql(source):
    return f"""SELECT page_id, url, pos, {_decoded_sql("href")} AS href FROM (
        SELECT page_id, url, (generate_subscripts(h, 1) - 1)::INTEGER AS pos,
               regexp_replace(unnest(h), '^["''](.*)["'']$', '\\1', 's') AS href
        FROM (SELECT page_id, url, {_HREFS.format(html=_SHOWN.format(html=source))} AS h FROM pages))"""


_LINKS = _link_rows_sql("html")
_SITE = "regexp_extract({url}, '^((?i:https?)://[^/?#]+)', 1)"
_TARGETS = f"""SELECT page_id, url, pos, href, CASE
    WHEN regexp_matches(href, '^[A-Za-z][A-Za-z0-9+.-]*:') THEN href
    WHEN starts_with(href, '//') THEN split_part(url, '//', 1) || href
    WHEN starts_with(href, '/') THEN {_SITE.format(url="url")} || href
    WHEN starts_with(href, '?') THEN regexp_replace(url, '[?#].*', '') || href
    WHEN starts_with(href, '#') THEN regexp_replace(url, '#.*', '') || href
    WHEN href = '' THEN url
    ELSE regexp_replace(regexp_replace(url, '[?#].*', ''), '^(\\w+://[^/]*)(/.*/|/)?[^/]*$', '\\1') ||
         coalesce(nullif(regexp_extract(regexp_replace(url, '[?#].*', ''), '^\\w+://[^/]*(/(?:.*/)?)', 1), ''), '/') || href
    END AS target FROM ({_LINKS})"""

_STRIPPED = "regexp_replace(regexp_replace(regexp_replace({inner}, '(?s)<script\\b.*?</script>', ''), \
'(?s)<!--.*?-->', '', 'g'), '<[A-Za-z/!?][^>]*>', '', 'g')"
_ARTICLE_SQL = "nullif(regexp_extract(html, '(?s)<article\\b[^>]*>(.*?)</article>', 1), '')"


def _text_sql():
    return _decoded_sql(_STRIPPED.format(inner=_ARTICLE_SQL), ";?")


def _links(spark, folder):
    return L.link_rows(tables.pages(spark, folder), html.hrefs(F.col("html")))


@query("page_links", f"SELECT page_id, pos, href FROM ({_LINKS})")
def page_links(spark, folder):
    return _links(spark, folder).select("page_id", "pos", "href")


@query("container_links", f"SELECT page_id, pos, href FROM ({_link_rows_sql(_NAV)})")
def container_links(spark, folder):
    nav = html.all_elements(F.col("html"), "nav")
    return L.link_rows(tables.pages(spark, folder), html.hrefs(nav)).select(
        "page_id", "pos", "href"
    )


@query("parsed_container_links", f"SELECT page_id, pos, href FROM ({_link_rows_sql(_NAV)})")
def parsed_container_links(spark, folder):
    found = html_parser.element_links(F.col("html"), "nav")
    return L.link_rows(tables.pages(spark, folder), found).select("page_id", "pos", "href")


@query("page_text", f"SELECT page_id, {_text_sql()} AS text FROM pages")
def page_text(spark, folder):
    article = html.element(F.col("html"), "article")
    return tables.pages(spark, folder).select("page_id", html.visible_text(article).alias("text"))


@query("parsed_page_text", f"SELECT page_id, {_text_sql()} AS text FROM pages")
def parsed_page_text(spark, folder):
    """The same text by name of the element."""
    return tables.pages(spark, folder).select(
        "page_id", html_parser.element_text(F.col("html"), "article").alias("text")
    )


@query(
    "page_field",
    """SELECT page_id, nullif(regexp_extract(html, '<html\\b[^>]*\\blang="([^"]*)"', 1), '') AS lang,
              nullif(regexp_extract(html,
                '<span\\b[^>]*\\bitemprop="ratingValue"[^>]*>([^<]*)<', 1), '') AS rating,
              nullif(regexp_extract(html, '<meta\\b[^>]*\\bcharset="([^"]*)"', 1), '') AS charset
       FROM pages""",
)
def page_field(spark, folder):
    page = F.col("html")
    return tables.pages(spark, folder).select(
        "page_id",
        html.field(page, r'<html\b[^>]*\blang="([^"]*)"').alias("lang"),
        html.tagged_field(page, "span", "itemprop", "ratingValue").alias("rating"),
        html.field(page, r'<meta\b[^>]*\bcharset="([^"]*)"').alias("charset"),
    )


_RECORDS = f"""SELECT page_id, try_cast(nullif(regexp_extract(html,
    '<span\\b[^>]*\\bitemprop="ratingValue"[^>]*>([^<]*)<', 1), '') AS DOUBLE) AS rating,
    {_text_sql()} AS text FROM pages"""


@query("page_records", _RECORDS)
def page_records(spark, folder):
    return review_records(tables.pages(spark, folder), _ARTICLE)


@query(
    "gathered_records",
    f"""SELECT 'page' AS source, page_id AS record_id, rating, length(text) AS n_chars FROM ({_RECORDS})
        UNION ALL SELECT 'document', doc_id, rating, length(text) FROM ({S.LANGUAGE_RATED})""",
)
def gathered_records(spark, folder):
    """Records of two sources in one table."""

    def record(df, source, key):
        length = F.length("text").cast("long").alias("n_chars")
        return df.select(F.lit(source).alias("source"), F.col(key).alias("record_id"), "rating", length)

    found = review_records(tables.pages(spark, folder), _ARTICLE)
    rated = tables.language_rated(spark, folder)
    return gather([record(found, "page", "page_id"), record(rated, "document", "doc_id")])


@query("absolute_links", f"SELECT page_id, pos, target FROM ({_TARGETS})")
def absolute_links(spark, folder):
    return L.absolute_links(_links(spark, folder)).select("page_id", "pos", "target")


@query(
    "link_join",
    f"""SELECT l.page_id, l.pos, l.target, p.target_page FROM ({_TARGETS}) l
        JOIN (SELECT url AS target, min(page_id) AS target_page FROM pages GROUP BY url) p
        USING (target)""",
)
def link_join(spark, folder):
    stored = tables.table(spark, folder, "pages").select("page_id", "url")
    links = L.absolute_links(_links(spark, folder)).select("page_id", "pos", "target")
    return L.follow(links, stored).select("page_id", "pos", "target", "target_page")


@query(
    "link_join_sites",
    f"""SELECT l.page_id, l.pos, l.site, p.target_page
        FROM (SELECT *, {_SITE.format(url="target")} AS site FROM ({_TARGETS})) l
        JOIN (SELECT {_SITE.format(url="url")} AS site, min(page_id) AS target_page FROM pages GROUP BY 1) p
        USING (site)""",
)
def link_join_sites(spark, folder):
    """Links beside the first stored page of the site they lead to."""
    stored = tables.table(spark, folder, "pages").select("page_id", html.site(F.col("url")).alias("url"))
    links = L.absolute_links(_links(spark, folder)).withColumn("target", html.site(F.col("target")))
    found = L.follow(links.select("page_id", "pos", "target"), stored)
    return found.select("page_id", "pos", F.col("target").alias("site"), "target_page")


@query(
    "link_missing",
    f"SELECT page_id, pos, target FROM ({_TARGETS}) WHERE target NOT IN (SELECT url FROM pages)",
)
def link_missing(spark, folder):
    stored = tables.table(spark, folder, "pages").select("page_id", "url")
    links = L.absolute_links(_links(spark, folder)).select("page_id", "pos", "target")
    return L.missing(links, stored)


@query(
    "link_site",
    f"""SELECT l.page_id, l.pos, s.site, s.site_pages, s.first_page
        FROM (SELECT *, {_SITE.format(url="target")} AS site FROM ({_TARGETS})) l
        JOIN (SELECT {_SITE.format(url="url")} AS site, count(*) AS site_pages,
                     min(page_id) AS first_page FROM pages GROUP BY 1) s USING (site)""",
)
def link_site(spark, folder):
    """Links beside the size of the site they lead to."""
    stored = tables.table(spark, folder, "pages").select("page_id", "url")
    links = L.absolute_links(_links(spark, folder)).select("page_id", "pos", "target")
    return L.with_site(links, stored).select("page_id", "pos", "site", "site_pages", "first_page")


# The given pages lead to no stored page.  A link that leads nowhere is sent to the stored page
# that a digest of its target names, so that there are ways to follow.
_STORED = f"""SELECT l.page_id, l.pos, p.target_page FROM (
        SELECT page_id, pos, ('0x' || substr(md5(target), 1, 8))::BIGINT % (SELECT count(*) FROM pages) AS place
        FROM ({_TARGETS})) l
    JOIN (SELECT page_id AS target_page, row_number() OVER (ORDER BY page_id) - 1 AS place FROM pages) p USING (place)"""
_FIRST_OF_LANGUAGE = """SELECT min(page_id) AS page_id FROM (
    SELECT page_id, regexp_extract(html, '<html\\b[^>]*\\blang="([^"]*)"', 1) AS lang FROM pages) GROUP BY lang"""


def _stored_links(spark, folder):
    pages = tables.table(spark, folder, "pages").select("page_id")
    places = row_index(pages, [F.asc("page_id")], "place").withColumnRenamed("page_id", "target_page")
    digest = F.conv(F.substring(F.md5(F.col("target").cast("binary")), 1, 8), 16, 10).cast("long")
    links = L.absolute_links(_links(spark, folder)).withColumn("place", digest % F.lit(pages.count()))
    return lookup_join(links, places, ["place"], "inner", ["page_id", "pos"])


@query(
    "link_levels",
    f"""WITH RECURSIVE edges AS MATERIALIZED (SELECT DISTINCT page_id, target_page FROM ({_STORED})),
    ways AS (
        SELECT page_id, 0 AS level FROM ({_FIRST_OF_LANGUAGE})
        UNION SELECT e.target_page, w.level + 1 FROM ways w JOIN edges e USING (page_id)
        WHERE w.level < (SELECT count(*) FROM pages) AND w.level < 12)
    SELECT page_id, min(level)::INTEGER AS level FROM ways GROUP BY page_id""",
)
def link_levels(spark, folder):
    """How many links each page is away from the first page of any language."""
    lang = html.field(F.col("html"), r'<html\b[^>]*\blang="([^"]*)"')
    pages = tables.pages(spark, folder).select("page_id", F.coalesce(lang, F.lit("")).alias("lang"))
    seeds = pages.groupBy("lang").agg(F.min("page_id").alias("page_id"))
    return L.traverse(_stored_links(spark, folder), seeds)


_LISTING = f"""SELECT page_id, nullif(regexp_extract(html, '<html\\b[^>]*\\blang="([^"]*)"', 1), '') AS lang,
    len({_HREFS.format(html=_SHOWN.format(html="html"))}) AS n_links FROM pages"""


@query(
    "listing_until_empty",
    f"""SELECT l.page_id, l.lang, l.n_links FROM ({_LISTING}) l
        JOIN (SELECT lang, min(CASE WHEN n_links = 0 THEN page_id END) AS stop
              FROM ({_LISTING}) GROUP BY lang) s ON s.lang IS NOT DISTINCT FROM l.lang
        WHERE s.stop IS NULL OR l.page_id < s.stop""",
)
def listing_until_empty(spark, folder):
    """Pages of a language as a listing that ends at its first page without links."""
    listing = tables.pages(spark, folder).select(
        "page_id",
        html.field(F.col("html"), r'<html\b[^>]*\blang="([^"]*)"').alias("lang"),
        F.size(html.hrefs(F.col("html"))).cast("long").alias("n_links"),
    )
    return L.until_empty(listing, "lang", "page_id", "n_links")
