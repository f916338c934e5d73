"""Operators over dated observations."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .keys import keep_first, newest


def latest(df: DataFrame, keys: Sequence[str], day: str, ties: Sequence[str] = ()) -> DataFrame:
    """The newest row per key; ``ties`` settle equal days."""
    return keep_first(df, keys, [newest(day), *[newest(t) for t in ties]])


def first_sighting(df: DataFrame, keys: Sequence[str], day: str, ties: Sequence[str] = ()) -> DataFrame:
    return keep_first(df, keys, [F.col(day).asc_nulls_last(), *[F.col(t).asc_nulls_last() for t in ties]])


def best_row(df: DataFrame, keys: Sequence[str], score: Column, day: str, ties: Sequence[str] = ()) -> DataFrame:
    """The most complete row per key, the newest of equally complete ones."""
    scored = df.withColumn("_score", score)
    return keep_first(
        scored, keys, [F.col("_score").desc(), newest(day), *[F.col(t).asc_nulls_last() for t in ties]]
    ).drop("_score")


def as_of(
    df: DataFrame, keys: Sequence[str], day: str, cutoffs: Sequence[date], ties: Sequence[str] = ()
) -> DataFrame:
    """The newest row per key on or before each cutoff day.

    Rows are first reduced to the newest per key and *interval* between two
    cutoffs; only those few rows are carried into the later cutoffs.
    """
    points = sorted(cutoffs)
    day_value = F.col(day).cast("date")
    interval = F.lit(None).cast("int")
    for i in reversed(range(len(points))):
        interval = F.when(day_value <= F.lit(points[i]), F.lit(i)).otherwise(interval)
    placed = df.withColumn("_interval", interval).filter(F.col("_interval").isNotNull())
    reduced = latest(placed, [*keys, "_interval"], day, ties)
    table = F.array(*[F.lit(p) for p in points])
    carried = reduced.withColumn(
        "cutoff", F.explode(F.slice(table, F.col("_interval") + 1, len(points)))
    ).drop("_interval")
    return latest(carried, [*keys, "cutoff"], day, ties)


def unpivot(df: DataFrame, keep: Sequence[str], groups: Sequence[dict[str, str]]) -> DataFrame:
    """Parallel column groups to rows: each dict maps output name to input column."""
    structs = [F.struct(*[F.col(source).alias(name) for name, source in g.items()]) for g in groups]
    return df.select(*keep, F.inline(F.array(*structs)))


def newest_known(
    df: DataFrame, keys: Sequence[str], columns: Sequence[str], day: str, ties: Sequence[str] = ()
) -> DataFrame:
    """Per key and column the newest row in which the column is known, with the other columns emptied.

    These are the rows that ``latest`` keeps of the columns' ``unpivot``, equal
    days settled by ``ties`` and then by the value.  The wide rows are reduced
    as they are, in the tasks that read them, before any of them is multiplied.
    """
    order = [day, *ties]
    # Missing values come first, as in ``newest``.
    rank = [part for i, c in enumerate(order) for part in (F.col(c).isNull().alias(f"_n{i}"), F.col(c).alias(f"_o{i}"))]
    best = df.groupBy(*keys).agg(
        *[F.max(F.when(F.col(c).isNotNull(), F.struct(*rank, F.col(c).alias("_v")))).alias(f"_best{j}") for j, c in enumerate(columns)]
    )

    def row(j: int) -> Column:
        own = F.col(f"_best{j}")
        values = [F.when(F.lit(i == j), F.col(f"_best{i}._v")).alias(c) for i, c in enumerate(columns)]
        return F.when(own.isNotNull(), F.struct(*[own[f"_o{i}"].alias(c) for i, c in enumerate(order)], *values))

    return best.select(*keys, F.inline(F.array_compact(F.array(*[row(j) for j in range(len(columns))]))))


def trailing_rate(
    df: DataFrame,
    keys: Sequence[str],
    stamp: str,
    state: str,
    seconds: int,
    depth: int,
    tie: str,
    slice_factor: int = 16,
) -> DataFrame:
    """Change of ``state`` per second since the oldest sample still kept.

    A sample is kept while it is at most ``seconds`` old and among the last
    ``depth`` samples.  Each key's time line is cut into slices of
    ``seconds * slice_factor``; a row is copied into the next slice only when
    it can still be seen from there, so no window ever spans a whole key.
    """
    micros = F.unix_micros(F.col(stamp).cast("timestamp"))
    reach = seconds * 1_000_000
    width = reach * slice_factor
    own = F.floor(micros / width)
    rows = (
        df.withColumn("_t", micros)
        .withColumn("_own", own)
        .withColumn("_slice", F.explode(F.array_distinct(F.array(own, F.floor((micros + reach) / width)))))
    )
    in_slice = Window.partitionBy(*keys, "_slice")
    ordered = in_slice.orderBy("_t", tie)
    numbered = rows.withColumn("_i", F.row_number().over(ordered)).withColumn(
        "_cum", F.struct(F.col("_i").alias("i"), F.col("_t").alias("t"), F.col(state).cast("double").alias("s"))
    )
    by_age = in_slice.orderBy("_t").rangeBetween(-reach, 0)
    by_depth = ordered.rowsBetween(-(depth - 1), 0)
    aged = numbered.withColumn("_aged", F.min("_cum").over(by_age)).withColumn("_deep", F.first("_cum").over(by_depth))
    kept = aged.filter(F.col("_slice") == F.col("_own")).withColumn(
        "_last", F.when(F.col("_aged.i") >= F.col("_deep.i"), F.col("_aged")).otherwise(F.col("_deep"))
    )
    elapsed = (F.col("_t") - F.col("_last.t")) / F.lit(1_000_000.0)
    rate = F.when(elapsed == 0, F.lit(0.0)).otherwise((F.col(state).cast("double") - F.col("_last.s")) / elapsed)
    window_rows = (F.col("_i") - F.col("_last.i") + 1).alias("window_rows")
    return kept.select(*df.columns, window_rows, rate.alias("rate"))


def page(df: DataFrame, order: Sequence[Column | str], offset: int, limit: int) -> DataFrame:
    """One page of a total order; each task keeps offset + limit rows."""
    return df.orderBy(*order).offset(offset).limit(limit)


def page_after(df: DataFrame, key: str, last_key, limit: int) -> DataFrame:
    """The page following ``last_key``: a pushed-down filter instead of an offset."""
    rest = df if last_key is None else df.filter(F.col(key) > F.lit(last_key))
    return rest.orderBy(key).limit(limit)
