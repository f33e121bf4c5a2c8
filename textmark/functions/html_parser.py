"""Text and links of elements, however they nest."""

from __future__ import annotations

from pyspark.sql import Column

from textmark.functions import html


def element_text(page: Column, tag: str, css_class: str | None = None) -> Column:
    """Visible text of the first matching element, first script left out."""
    return html.visible_text(html.element(page, tag, css_class))


def element_links(page: Column, tag: str, css_class: str | None = None) -> Column:
    """Link targets inside all matching elements, in page order."""
    return html.hrefs(html.all_elements(page, tag, css_class))
