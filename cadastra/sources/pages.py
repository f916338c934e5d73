"""Publication links out of HTML pages."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _opening(tag: str, css_class: str | None) -> str:
    if css_class is None:
        return rf"<{tag}\b[^>]*>"
    name = re.escape(css_class)
    return rf"<{tag}\b[^>]*\bclass\s*=\s*[\"'](?:[^\"'>]*\s)?{name}(?:\s[^\"'>]*)?[\"'][^>]*>"


def last_element(html: Column, tag: str, css_class: str | None) -> Column:
    """Text of the last element with a tag and class, nested elements of the same tag included."""
    cut = F.split(html, rf"(?i)(?={_opening(tag, css_class)})")
    tail = F.element_at(cut, -1)
    pieces = F.split(tail, rf"(?i)(?=</?{tag}\b)")

    def walk(state: Column, piece: Column) -> Column:
        closing = piece.rlike(rf"(?i)^</{tag}\b")
        opening = piece.rlike(rf"(?i)^<{tag}\b")
        depth = state["depth"] + F.when(opening, 1).when(closing, -1).otherwise(0)
        live = state["depth"] > 0
        text = F.when(live | (state["text"] == ""), F.concat(state["text"], piece)).otherwise(state["text"])
        return F.struct(
            F.when(live | (state["text"] == ""), depth).otherwise(0).cast("int").alias("depth"), text.alias("text")
        )

    start = F.struct(F.lit(0).cast("int").alias("depth"), F.lit("").alias("text"))
    found = F.aggregate(pieces, start, walk)["text"]
    return F.when(html.rlike(rf"(?i){_opening(tag, css_class)}"), found)


def absolute_url(base: Column, link: Column) -> Column:
    """Resolve a link against the page it stands on."""
    scheme = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.-]*):", 1)
    site = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)", 1)
    page = F.regexp_extract(base, r"^([^?#]*)", 1)
    folder = F.when(page == site, F.concat(site, F.lit("/"))).otherwise(F.regexp_replace(page, r"[^/]*$", ""))
    joined = F.concat(folder, link)
    # Only the path is tidied: a query or fragment may hold any text.
    stem = F.regexp_extract(joined, r"^([^?#]*)", 1)
    tail = F.substring(joined, F.length(stem) + 1, F.length(joined))
    steps = F.split(F.substring(stem, F.length(site) + 2, F.length(stem)), "/")
    last = F.element_at(steps, -1).isin(".", "..")

    def walk(done: Column, step: Column) -> Column:
        up = F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(0)))
        return F.when(step == ".", done).when(step == "..", up).otherwise(F.concat(done, F.array(step)))

    walked = F.aggregate(steps, F.array().cast("array<string>"), walk)
    slash = F.when(last & (F.size(walked) > 0), "/").otherwise("")
    tidy = F.concat(site, F.lit("/"), F.array_join(walked, "/"), slash, tail)
    return (
        F.when(link == "", base)
        .when(link.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), link)
        .when(link.startswith("//"), F.concat(scheme, F.lit(":"), link))
        .when(link.startswith("/"), F.concat(site, link))
        .when(link.startswith("#"), F.concat(F.regexp_extract(base, r"^([^#]*)", 1), link))
        .when(link.startswith("?"), F.concat(page, link))
        .otherwise(tidy)
    )


def page_links(
    pages: DataFrame,
    url: str,
    html: str,
    path: Sequence[tuple[str, str | None]] = (("a", None),),
    date_format: str | None = None,
    keep: Sequence[str] = (),
) -> DataFrame:
    """One row per link: position, absolute url, text, date and file name.

    All steps of ``path`` but the last descend into the last element with that
    tag and class; the last step takes every matching link.
    """
    scope = F.col(html)
    for tag, css_class in path[:-1]:
        scope = last_element(scope, tag, css_class)
    tag, css_class = path[-1]
    pattern = rf"(?is)({_opening(tag, css_class)})(.*?)</{tag}\s*>"
    found = F.regexp_extract_all(F.col("_scope"), F.lit(pattern), F.lit(0))
    rows = pages.withColumn("_scope", scope).select(*keep, F.col(url).alias("_base"), F.posexplode(found).alias("position", "_a"))
    href = F.regexp_extract("_a", r"(?is)^<[^>]*?\shref\s*=\s*[\"']([^\"']*)", 1)
    text = F.trim(F.regexp_replace(F.regexp_replace("_a", r"(?s)<[^>]*>", ""), r"\s+", " "))
    linked = rows.filter(F.col("_a").rlike(r"(?is)^<[^>]*?\shref\s*=")).select(
        *keep, "position", absolute_url(F.col("_base"), href).alias("url"), href.alias("href"), text.alias("text")
    )
    day = F.try_to_date("text", date_format) if date_format else F.lit(None).cast("date")
    name = F.regexp_extract("url", r"([^/?#]*)(?:[?#].*)?$", 1)
    return linked.withColumn("published", day).withColumn("file_name", name)


def archive_link(links: DataFrame, contains: str) -> DataFrame:
    """Links to zip archives whose address holds a marker."""
    return links.filter(F.col("href").endswith(".zip") & F.col("href").contains(contains))
