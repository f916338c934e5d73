"""Boilerplate lines by site-relative frequency, in DataFrame functions only.

A line's ratio is the number of a host's pages that hold it over the host's
pages.  Lines above a ratio are dropped from all pages of that host.  What is
counted are 128-bit hashes of lines, summed up before they move, so a host with
a third of all pages sends one row per task and line.

A host has at most ``average lines per page / ratio`` boilerplate lines, however
many pages it has; its set is therefore small, is written once, and the planner
broadcasts all sets or joins them by host as their written size demands.

Copies of one page share all its lines without any of them being boilerplate.
With ``once`` a host's groups of exact and near copies are therefore counted as
one page each: pages are cut into passages of a few words at places their own
words decide on, the smallest passage hashes are a page's sketch, pages much like
another one that they meet through a part of their sketch are linked, and a line
counts once for each connected group.  Pages are known by the hash of host and
text, so neither ids nor the order of rows matter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .components import components
from .names import distinct_names, free_name, own

RATIO = 0.05
LEAST_PAGES = 3
#: Three to eight words, up to one that ends in a given letter, so that pages meet again after an edit.
PASSAGE = r"(?:\S++\s++){2,7}?\S*[edns](?!\S)|(?:\S++\s++){0,7}\S++"
#: Passage hashes of a sketch, and the parts of the hash space in each of which pages may meet.
SKETCH, PARTS = 64, 6
#: Percent of passages two pages share to count once.  Copies of one page that each share 80 % with it share 60 %.
ALIKE = 50


def _key(line: Column) -> Column:
    return F.struct(F.xxhash64(line).alias("a"), F.xxhash64(F.lit(1), line).alias("b"))


def _counted(line: Column) -> Column:
    """Lines of white space only separate paragraphs; they are neither counted nor dropped."""
    return F.length(F.trim(line)) > 0


def _sketch() -> Column:
    passages = F.regexp_extract_all(F.lower("text"), F.lit(PASSAGE), F.lit(0))
    return _smallest(F.transform(passages, lambda p: F.xxhash64(p)))


def _smallest(hashes: Column) -> Column:
    return F.slice(F.sort_array(F.array_distinct(hashes)), 1, SKETCH)


def _alike(a: Column, b: Column) -> Column:
    """Whether the smallest passages of both pages together are mostly in both."""
    both = _smallest(F.concat(a, b))
    return 100 * F.size(F.array_intersect(both, F.array_intersect(a, b))) >= ALIKE * F.size(both)


def copy_groups(pages: DataFrame) -> DataFrame:
    """``row, label`` of the pages ``row, host, sketch`` that have copies on their host; the label is a group's smallest row."""
    pages = pages.dropDuplicates(["row"])
    part = lambda i: F.get(F.filter("sketch", lambda h: F.pmod(h, F.lit(PARTS)) == i), F.lit(0))
    keys = F.array_compact(F.transform(F.sequence(F.lit(0), F.lit(PARTS - 1)), part))
    met = pages.select("row", F.xxhash64("host", F.col("host").isNull()).alias("h"), F.explode(keys).alias("key"))
    first = met.groupBy("h", "key").agg(F.min("row").alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    pairs = cut_lineage(met.join(first, ["h", "key"]).where("row > first").select("row", "first").distinct(), "met-pages")
    sketches = pages.select("row", "sketch")
    ours = pairs.join(sketches, "row")
    theirs = sketches.select(F.col("row").alias("first"), F.col("sketch").alias("other"))
    links = ours.join(theirs, "first").where(_alike(F.col("sketch"), F.col("other")))
    return components(links.select(F.col("row").alias("u"), F.col("first").alias("v"))).select(F.col("node").alias("row"), "label")


def _grouped(docs: DataFrame, host: Column, lines: Column) -> DataFrame:
    """``host, lines, label`` of every page; copies on one host share a label."""
    row = F.xxhash64(host, host.isNull(), own("text")).alias("row")
    pages = cut_lineage(docs.select(host.alias("host"), lines.alias("lines"), _sketch().alias("sketch"), row), "pages")
    labels = copy_groups(pages.select("row", "host", "sketch"))
    return pages.join(labels, "row", "left").select("host", "lines", F.coalesce("label", "row").alias("label"))


def boilerplate(
    docs: DataFrame, host: str = "source", ratio: float = RATIO, least_pages: int = LEAST_PAGES, once: bool = False
) -> DataFrame:
    """``host, lines``: each host's boilerplate lines as hashes."""
    lines = F.array_distinct(F.transform(F.filter(F.split("text", "\n"), _counted), _key))
    if once:
        page = _grouped(docs, own(host), lines)
        pages = page.select("host", "label").distinct().groupBy("host").agg(F.count("*").alias("pages"))
        line = page.select("host", "label", F.explode("lines").alias("line")).select("host", "label", "line.a", "line.b").distinct()
    else:
        page = docs.select(own(host).alias("host"), lines.alias("lines"))
        pages = page.groupBy("host").agg(F.count("*").alias("pages"))
        line = page.select("host", F.explode("lines").alias("line")).select("host", "line.a", "line.b")
    seen = line.groupBy("host", "a", "b").agg(F.count("*").alias("n"))
    often = seen.where(F.col("n") >= least_pages).alias("s").join(pages.alias("p"), F.col("s.host").eqNullSafe(F.col("p.host")))
    return (
        often.where(F.col("n") > ratio * F.col("pages"))
        .groupBy("s.host").agg(F.collect_list(F.struct("a", "b")).alias("boilerplate"))
    )


def without_boilerplate(
    docs: DataFrame, host: str = "source", ratio: float = RATIO, least_pages: int = LEAST_PAGES, once: bool = False
) -> DataFrame:
    """The rows of ``docs`` with boilerplate lines dropped from ``text``, and ``dropped_lines``.

    A line is dropped when at least ``least_pages`` pages of the row's host
    hold it, and more than ``ratio`` of them.  Lines end at line feeds; lines
    of white space alone always stay.  A line counts once a page; with ``once``
    exact and near copies on one host are one page, also among the host's pages.

    Pages of a null host form a host of their own.  A null text stays null and
    counts as a page, an empty one stays empty; a text may become empty.
    Rows of equal ``doc_id`` are pages of their own; other columns stay as
    they are; an empty table gives no rows.
    """
    names = distinct_names(docs)
    if "dropped_lines" in names:
        raise ValueError("columns of one name can't be told apart")
    kept_lines = free_name(docs, "kept_lines")
    sets = cut_lineage(boilerplate(docs, host, ratio, least_pages, once), "boilerplate")
    joined = docs.alias("d").join(sets.alias("b"), own(host, "d").eqNullSafe(F.col("b.host")), "left")
    known = F.coalesce("b.boilerplate", F.array().cast("array<struct<a:bigint,b:bigint>>"))
    lines = F.split("d.text", "\n")
    kept = F.filter(lines, lambda line: ~(_counted(line) & F.array_contains(known, _key(line))))
    return joined.select(*(own(c, "d").alias(c) for c in names), kept.alias(kept_lines)).select(
        *(F.array_join(kept_lines, "\n").alias("text") if c == "text" else own(c) for c in names),
        F.coalesce(F.size(F.split("text", "\n")) - F.size(kept_lines), F.lit(0)).alias("dropped_lines"),
    )
