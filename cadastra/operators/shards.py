"""Count-bounded range shards for reading a large remote table in parallel.

The plan (one row per shard, a written table) is made on the cluster.  Whoever
passes its predicates to ``spark.read.jdbc`` collects them: choose ``depth`` so
that rows / depth then stays in the tens of thousands.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from datetime import date, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .aggregates import numbered_rows

LOG_PARTS = 11
LARGEST = 1e307


def _plus_months(day: date, months: int) -> date:
    total = day.year * 12 + day.month - 1 + months
    return date(total // 12, total % 12 + 1, 1 if day.day != 1 else day.day)


def date_parts(start: date, end: date) -> list[tuple[date, date]]:
    """Sub-ranges of [start, end): centuries, five years, years, months or days."""
    for months in (1200, 60, 12, 1):
        if end > _plus_months(start, months):
            break
    else:
        months = 0
    cuts, at = [], start
    while at < end:
        cuts.append(at)
        at = _plus_months(at, months) if months else at + timedelta(days=1)
    return list(zip(cuts, [*cuts[1:], end]))


def log_cuts(start: float, end: float, parts: int = LOG_PARTS) -> list[float]:
    """Log-spaced cut points of [start, end], each with as few decimals as keep them rising."""
    low = math.log10(start) if start > 0 else min(0.0, math.log10(end) - parts)
    step = (math.log10(end) - low) / parts
    cuts = [start]
    for i in range(1, parts):
        cuts.append(_shortest_above(10 ** (low + i * step), cuts[-1]))
    return [*cuts, end]


def _shortest_above(value: float, floor: float) -> float:
    if value - floor > 1:
        return float(math.floor(value))
    for digits in range(18):
        scale = 10**digits
        rounded = math.floor(value * scale) / scale
        if rounded > floor:
            return rounded
    return value


def _date_tree(start: date, end: date) -> list[tuple[date, date, date | None, date | None]]:
    """Every sub-range of [start, end) down to days, with the range it is part of: sized by the calendar alone."""
    tree = [(a, b, None, None) for a, b in date_parts(start, end)]
    for a, b, *_ in tree:
        if b - a > timedelta(days=1):
            tree += [(c, d, a, b) for c, d in date_parts(a, b)]
    return tree


def _day_counts(days: DataFrame, start: date, end: date) -> DataFrame:
    """Rows of every range of the calendar (``_from, _to``) and of the range it is part of (``_over``)."""
    spark = days.sparkSession
    tree = spark.createDataFrame(_date_tree(start, end), "_from date, _to date, _up_from date, _up_to date")
    # A day lies in one range of each size, five at most.
    spans = tree.withColumn("_day", F.explode(F.sequence("_from", F.date_sub("_to", 1))))
    counts = days.groupBy("_day").agg(F.count(F.lit(1)).alias("n"))
    sums = spans.join(counts, "_day").groupBy("_from", "_to", "_up_from", "_up_to").agg(F.sum("n").alias("n"))
    sums = cut_lineage(sums, "day-counts")
    above = sums.select(F.col("_from").alias("_up_from"), F.col("_to").alias("_up_to"), F.col("n").alias("_over")).distinct()
    return sums.join(above, ["_up_from", "_up_to"], "left").drop("_up_from", "_up_to")


def _cuts(low: float, high: float, least: float, most: float) -> list[float]:
    """Where a crowded range is cut: open ones where their rows lie, closed ones log-spaced."""
    if math.isinf(low) or math.isinf(high):
        top = most if math.isfinite(most) else max(2 * abs(least), 1.0)
        bottom = least if math.isfinite(least) else min(2 * -abs(top), -1.0)
        middle = bottom + (top - bottom) / 2
        return [low, middle if middle > bottom else top, high]
    return [low, *(b for _, b in _value_pieces(low, high))]


def plan_shards(
    df: DataFrame, day: str, value: str, start: date, end: date, value_end: float, depth: int
) -> DataFrame:
    """Shards of at most ``depth`` rows covering [start, end) and every value.

    Days are counted once and merged upwards; a single day that is still too
    full is split by value: log-spaced ranges up to ``value_end``, an open range
    on either side and one shard for missing values.  A shard whose rows all
    share one value, or lack one, cannot be split further and is returned with
    ``full = true``.

    The driver sees the calendar and, per round of value cuts, whether a range is
    left.  A round cuts every crowded range at once: each row
    compares with the dozen cuts of its own range, equal ranges and pieces are
    counted before they move, and only rows of crowded pieces go on.  The plan
    is a written table, numbered by sampled ranges; no rows, no shards.
    """
    spark = df.sparkSession
    rows = df.select(F.col(day).cast("date").alias("_day"), F.col(value).cast("double").alias("_v")).filter(
        (F.col(day) >= F.lit(start)) & (F.col(day) < F.lit(end))
    )
    counted = _day_counts(rows.select("_day"), start, end).withColumn("_single", F.date_add("_from", 1) == F.col("_to"))
    reached = counted.filter(F.coalesce(F.col("_over") > depth, F.lit(True)))
    none = F.lit(None).cast("double")
    done = [
        reached.filter(F.col("n") <= depth).select(
            "_from", "_to", none.alias("_lo"), none.alias("_hi"), F.lit(False).alias("_missing"), "n", F.lit(False).alias("full")
        )
    ]
    crowded = reached.filter((F.col("n") > depth) & F.col("_single")).select(F.col("_from").alias("_day"))
    rows = cut_lineage(rows.join(crowded, "_day", "left_semi"), "crowded-rows")
    next_day = F.date_add("_day", 1)
    done.append(
        rows.filter("_v IS NULL").groupBy("_day").agg(F.count(F.lit(1)).alias("n")).select(
            F.col("_day").alias("_from"), next_day.alias("_to"), none.alias("_lo"), none.alias("_hi"), F.lit(True).alias("_missing"),
            "n", (F.col("n") > depth).alias("full"),
        )
    )
    first = [-math.inf, *(a for a, _ in _value_pieces(0.0, float(value_end))), float(value_end), math.inf]
    rows = rows.filter("_v IS NOT NULL").withColumn("_cuts", F.array(*[F.lit(c) for c in first]))
    cuts_of = F.udf(lambda *ends: _cuts(*ends), "array<double>")
    while not rows.isEmpty():
        # Values are not below the first cut; NaN lies above every cut and in the last piece.
        place = F.greatest(F.lit(1), F.least(F.size("_cuts") - 1, F.size(F.filter("_cuts", lambda c: c <= F.col("_v")))))
        pieces = rows.withColumn("_at", place).select(
            "_day", "_v", F.element_at("_cuts", F.col("_at")).alias("_lo"), F.element_at("_cuts", F.col("_at") + 1).alias("_hi")
        )
        sums = cut_lineage(
            pieces.groupBy("_day", "_lo", "_hi").agg(
                F.count(F.lit(1)).alias("n"), F.min("_v").alias("_a"), F.max("_v").alias("_b")
            ),
            "value-counts",
        )
        # NaN and infinities have no middle, nor is there one next to the largest number.
        whole = (F.col("_a") == F.col("_b")) | F.isnan("_a") | (F.col("_a") > LARGEST) | (F.col("_b") < -LARGEST)
        closed = (F.col("n") <= depth) | whole
        done.append(
            sums.filter(closed).select(
                F.col("_day").alias("_from"), next_day.alias("_to"), "_lo", "_hi", F.lit(False).alias("_missing"), "n",
                (F.col("n") > depth).alias("full"),
            )
        )
        open_ = sums.filter(~closed).select("_day", "_lo", "_hi", cuts_of("_lo", "_hi", "_a", "_b").alias("_cuts"))
        rows = cut_lineage(pieces.join(open_, ["_day", "_lo", "_hi"]).select("_day", "_v", "_cuts"), "crowded-rows")
    shards = reduce(DataFrame.unionByName, done)
    # Whole days and the missing values of a day come before and after its ranges.
    numbered = numbered_rows(shards, [F.col("_from"), F.col("_missing"), F.col("_lo").asc_nulls_first()], "shard")
    return numbered.select(
        F.col("shard").cast("int").alias("shard"), _predicate(day, value).alias("predicate"), F.col("_from").alias("day_from"),
        F.col("_to").alias("day_to"), F.col("_lo").alias("value_from"), F.col("_hi").alias("value_to"),
        F.col("_missing").alias("value_missing"), F.col("n").alias("expected"), "full",
    )


def _in_range(v: Column, low: Column, high: Column) -> Column:
    """The open upper range also takes NaN, which sorts above all."""
    return (v >= low) & ((v < high) | (high == math.inf))


def _value_pieces(low: float, high: float) -> Iterator[tuple[float, float]]:
    cuts = log_cuts(low, high) if low >= 0 else [low, (low + high) / 2, high]
    if any(b <= a for a, b in zip(cuts, cuts[1:])):
        middle = (low + high) / 2
        cuts = [low, middle, high]
    return zip(cuts, cuts[1:])


def _predicate(day: str, value: str) -> Column:
    """The condition of a shard as text, for a reader outside."""
    first, end = F.col("_from").cast("string"), F.col("_to").cast("string")
    days = F.concat(F.lit(f"{day} >= DATE '"), first, F.lit(f"' AND {day} < DATE '"), end, F.lit("'"))

    def bound(name: str, sign: str) -> Column:
        known = F.col(name).isNotNull() & (F.abs(name) < math.inf)
        return F.when(known, F.concat(F.lit(f" AND {value} {sign} "), F.col(name).cast("string"))).otherwise("")

    rest = F.concat(
        bound("_lo", ">="), bound("_hi", "<"), F.when(F.col("_lo") == -math.inf, f" AND {value} IS NOT NULL").otherwise("")
    )
    return F.concat(days, F.when(F.col("_missing"), f" AND {value} IS NULL").otherwise(rest))


def shard_pages(shards: DataFrame, page: int) -> DataFrame:
    """Pages of a shard: offset and expected rows."""
    offsets = F.explode(F.sequence(F.lit(0).cast("long"), F.col("expected") - 1, F.lit(page).cast("long")))
    return shards.select("shard", "predicate", "expected", offsets.alias("offset")).withColumn(
        "size", F.least(F.lit(page).cast("long"), F.col("expected") - F.col("offset"))
    ).drop("expected")


def with_shard(df: DataFrame, shards: DataFrame, day: str, value: str) -> DataFrame:
    """Rows with the id of the shard they fall in.

    The plan is spread to one row per day and range, so the lookup is an
    equi-join on the day.
    """
    spans = shards.select(
        "shard", "value_from", "value_to", "value_missing",
        F.explode(F.sequence(F.col("day_from"), F.date_sub("day_to", 1))).alias("_day"),
    )
    placed = df.withColumn("_day", F.col(day).cast("date")).join(spans, "_day")
    v = F.col(value).cast("double")
    whole = F.col("value_from").isNull() & ~F.col("value_missing")
    fits = whole | (F.col("value_missing") & v.isNull()) | _in_range(v, F.col("value_from"), F.col("value_to"))
    return placed.filter(fits).drop("_day", "value_from", "value_to", "value_missing")
