"""URL verdicts from rules and a path-template tree, in DataFrame functions only.

A path is cut into ``LEVELS`` segments, the last of which holds all that follows.
Level by level and host by host, a segment that enough of a node's pages share
stays as it is and all others become a wildcard.  Sibling branches whose labelled
shares of good pages do not differ more than chance allows are merged.  What
remains are templates; one whose smoothed share of good pages is too low is
blocked.  A node keeps at most ``1 / SHARE`` segments, so the tables of kept
segments and templates grow with hosts and not with pages; each is written once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage

LEVELS = 4
#: A segment is kept when so many pages of its node, and this share of them, have it.
LEAST_PAGES, SHARE = 5, 0.02
#: Standard errors by which a branch may differ from its siblings and still be merged.
ERRORS = 1.96
#: Labelled pages that the overall share counts for, and the least smoothed share that is allowed.
PRIOR, PURITY = 10.0, 0.5
WILDCARD, MERGED = "*", "~"
ALLOW, BLOCK = "allow", "block"

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Host and path of each rule and what it says.
RULES = [
    ("org", "/", ALLOW), ("example.org", "/es/", BLOCK), ("example.org", "/en/1", BLOCK),
    ("com", "/fr/", ALLOW), ("com", "/de/", BLOCK),
]


def _parts(url: Column) -> tuple[Column, Column]:
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url)))
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), _UPPER, _LOWER)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def parsed(pages: DataFrame) -> DataFrame:
    """``pages`` with ``host``, ``path`` and the segments ``s1`` to ``s4``, empty where the path ends."""
    host, path = _parts(F.col("url"))
    pages = pages.withColumn("host", host).withColumn("path", path)
    segments = F.filter(F.split("path", "/"), lambda s: s != "")
    rest = F.array_join(F.slice(segments, LEVELS, F.greatest(F.size(segments), F.lit(1))), "/")
    return pages.withColumns(
        {f"s{i}": F.coalesce(F.get(segments, F.lit(i - 1)), F.lit("")) for i in range(1, LEVELS)} | {f"s{LEVELS}": rest}
    )


def rule_of(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> tuple[Column, Column]:
    """The longest fitting rule and its verdict, or nulls.

    A rule fits its host and all subdomains when the path starts with the
    rule's.  Rules are a short list and become one expression.
    """
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule_host, rule_path, says in sorted(rules, key=lambda r: (len(r[0] + r[1]), r[0] + r[1])):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        name = F.when(fits, F.lit(rule_host + rule_path)).otherwise(name)
        verdict = F.when(fits, F.lit(says)).otherwise(verdict)
    return name, verdict


def _kept(rows: DataFrame, level: int) -> DataFrame:
    """Segments of a level that stay as they are, by the template of the levels above."""
    above = ["host", *(f"t{i}" for i in range(1, level))]
    child = rows.groupBy(*above, f"s{level}").agg(F.count("*").alias("n"))
    node = child.groupBy(*above).agg(F.sum("n").alias("all"))
    often = child.where((F.col("n") >= LEAST_PAGES) & (F.col(f"s{level}") != ""))
    return (
        often.join(node, above).where(F.col("n") >= SHARE * F.col("all"))
        .select(*above, F.col(f"s{level}"), F.lit(True).alias("kept"))
    )


def _templated(rows: DataFrame, kept: list[DataFrame]) -> DataFrame:
    for level, table in enumerate(kept, 1):
        on = ["host", *(f"t{i}" for i in range(1, level)), f"s{level}"]
        segment = F.when((F.col(f"s{level}") == "") | F.col("kept"), F.col(f"s{level}")).otherwise(WILDCARD)
        rows = rows.join(table, on, "left").withColumn(f"t{level}", segment).drop("kept")
    return rows


def template_verdicts(rows: DataFrame, labelled: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """The kept segments of each level, and ``host, t1..t4, allowed`` of every template."""
    kept: list[DataFrame] = []
    for level in range(1, LEVELS + 1):
        kept.append(cut_lineage(_kept(_templated(rows, kept), level), f"segments-{level}"))
    names = [f"t{i}" for i in range(1, LEVELS + 1)]
    seen = _templated(rows, kept).groupBy("host", *names).agg(F.count("*").alias("pages"))
    known = _templated(labelled, kept).groupBy("host", *names).agg(
        F.count("*").alias("labelled"), F.sum(F.col("good").cast("long")).alias("good")
    )
    templates = cut_lineage(
        seen.join(known, ["host", *names], "left").na.fill(0, ["labelled", "good"]), "templates"
    )
    share = templates.agg(F.try_divide(F.sum("good"), F.sum("labelled")).alias("overall"))
    overall = share.first()[0]
    overall = 1.0 if overall is None else overall

    # Merge siblings from the top down: a merged branch's children are siblings of one another.
    merged = templates.withColumns({f"g{i}": F.lit("") for i in range(1, LEVELS + 1)})
    for level in range(1, LEVELS + 1):
        above = ["host", *(f"g{i}" for i in range(1, level))]
        branch = merged.groupBy(*above, f"t{level}").agg(F.sum("labelled").alias("m"), F.sum("good").alias("g"))
        pool = branch.groupBy(*above).agg(F.try_divide(F.sum("g"), F.sum("m")).alias("r"))
        spread = ERRORS * F.sqrt(F.col("m") * F.col("r") * (1 - F.col("r"))) + 0.5
        alike = F.col("r").isNull() | (F.abs(F.col("g") - F.col("m") * F.col("r")) <= spread)
        named = branch.join(pool, above).select(
            *above, f"t{level}", F.when(alike, F.lit(MERGED)).otherwise(F.col(f"t{level}")).alias("name")
        )
        merged = cut_lineage(
            merged.drop(f"g{level}").join(named, [*above, f"t{level}"]).withColumnRenamed("name", f"g{level}"),
            f"merged-{level}",
        )
    groups = ["host", *(f"g{i}" for i in range(1, LEVELS + 1))]
    purity = (F.sum("good") + PRIOR * overall) / (F.sum("labelled") + PRIOR)
    pure = merged.groupBy(*groups).agg(
        ((F.sum("labelled") == 0) | (purity >= PURITY)).alias("allowed")
    )
    return kept, cut_lineage(merged.join(pure, groups).select("host", *names, "allowed"), "verdicts")


def judge_urls(
    pages: DataFrame, labelled: DataFrame, rules: list[tuple[str, str, str]] | None = None
) -> DataFrame:
    """``page_id, host, path, rule, verdict`` of every row of ``page_id, url``.

    ``labelled`` holds ``url, good`` of known pages; a null ``good`` is no
    label.  The host lies after the first ``://`` up to ``/``, ``?`` or ``#``,
    A-Z lowered, the path from there up to ``?`` or ``#``.  A fitting rule
    decides, otherwise the page's template does.

    A null url, or one without ``://``, has an empty host and path and is
    judged as a template of the empty host.  A template without labels is
    allowed.  Rows of equal ``page_id`` are each judged;
    other columns are ignored; an empty table gives no rows.
    """
    rows = parsed(pages.select("page_id", "url")).drop("url")
    known = parsed(labelled.where("good IS NOT NULL").select("url", "good")).drop("url", "path")
    kept, verdicts = template_verdicts(rows, known)
    rule, says = rule_of(F.col("host"), F.col("path"), RULES if rules is None else rules)
    names = [f"t{i}" for i in range(1, LEVELS + 1)]
    judged = _templated(rows, kept).join(verdicts, ["host", *names], "left")
    method = F.when(F.coalesce("allowed", F.lit(True)), F.lit(ALLOW)).otherwise(F.lit(BLOCK))
    return judged.select(
        "page_id", "host", "path", rule.alias("rule"), F.coalesce(says, method).alias("verdict"),
        F.concat_ws("/", "host", *(F.when(F.col(c) != "", F.col(c)) for c in names)).alias("template"),
    )
