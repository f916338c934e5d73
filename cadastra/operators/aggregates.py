"""Aggregations that survive a hot group."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import cut_lineage
from .joins import null_safe_join

#: Seed of the second key that spreads a frequent value over ranges.
SALT_SEED = 7

def concat_in_order(
    df: DataFrame, keys: Sequence[str], text: str, order: str, out: str, *others: Column
) -> DataFrame:
    """Text fragments of a group joined in ``order``, with further aggregates if given.

    The result cell *is* the group's text, so its size is set by the result
    itself; fragments are pre-collected per task before the shuffle.
    """
    pieces = F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.col(text).alias("t"))))
    joined = F.array_join(F.transform(pieces, lambda p: p["t"]), "")
    return df.groupBy(*keys).agg(joined.alias(out), *others)


def value_runs(df: DataFrame, keys: Sequence[str], value: str, out: str) -> DataFrame:
    """The values of a group as a sorted array of (value, count).

    Values are counted before the shuffle, so a group moves one row per
    distinct value and task, never one per member, and its cell is bounded by
    the number of distinct values.
    """
    counted = df.filter(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_n"))
    run = F.struct(F.col(value).alias("value"), F.col("_n").alias("n"))
    return counted.groupBy(*keys).agg(F.array_sort(F.collect_list(run)).alias(out))


def expand_runs(runs: Column | str) -> Column:
    """Runs written out as one sorted array with repeats; empty for a missing group."""
    runs = F.col(runs) if isinstance(runs, str) else runs
    values = F.flatten(F.transform(runs, lambda r: F.array_repeat(r["value"], r["n"].cast("int"))))
    return F.coalesce(values, F.array())


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    parts = [
        df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("table_name"), "n")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def calendar_counts(df: DataFrame, day: str) -> DataFrame:
    """Rows per year and month."""
    return (
        df.groupBy(F.year(day).alias("year"), F.month(day).alias("month"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


def varying_groups(df: DataFrame, keys: Sequence[str], value: str, out: str = "spread") -> DataFrame:
    """Detail rows of the groups whose values differ, with max - min.

    The spread is aggregated with map-side combine and joined back; a window
    over the group would pull a hot group into one task.
    """
    spread = df.groupBy(*keys).agg((F.max(value) - F.min(value)).alias(out)).filter(F.col(out) > 0)
    return df.join(spread, list(keys), "inner")


def completion(df: DataFrame, keys: Sequence[str], done: Column, total: Column) -> DataFrame:
    agg = df.groupBy(*keys).agg(F.sum(done).alias("done"), F.sum(total).alias("total"))
    ratio = F.when(F.col("total") != 0, F.col("done") / F.col("total"))
    return agg.withColumn("ratio", ratio)


def running_position(hist: DataFrame, keys: Sequence[str], value: str, n: str) -> DataFrame:
    """Rows before each value within its group, from a histogram with one row per value.

    The histogram is written once, range-partitioned by value, each row with
    the number of its slice.  The ordered windows then run over (group, slice),
    so a group holding most of the table is spread over all slices, and slice
    totals (one row per group and slice) give the offset of each slice.
    """
    keys = list(keys)
    spark = hist.sparkSession
    slices = int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    sliced = cut_lineage(
        hist.repartitionByRange(slices, value).withColumn("_slice", F.spark_partition_id()), "histogram"
    )

    within = Window.partitionBy(*keys, "_slice").orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    local = sliced.withColumn("_local", F.coalesce(F.sum(n).over(within), F.lit(0)))

    totals = sliced.groupBy(*keys, "_slice").agg(F.sum(n).alias("_t"))
    across = Window.partitionBy(*(keys or [F.lit(0)]))
    earlier = across.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.withColumn("_offset", F.coalesce(F.sum("_t").over(earlier), F.lit(0))).withColumn(
        "group_rows", F.sum("_t").over(across)
    )
    joined = null_safe_join(local, offsets.drop("_t"), [*keys, "_slice"])
    return joined.withColumn("before", F.col("_local") + F.col("_offset")).drop("_local", "_offset", "_slice")


#: Relative rank error of the quantile sketches that bracket an exact percentile.
BRACKET = 1e-4


def group_percentile(df: DataFrame, keys: Sequence[str], value: str, share: float, out: str) -> DataFrame:
    """Exact interpolated percentile per group; no group is held in one task.

    Mergeable quantile sketches, built on the map side, bracket the wanted
    position of each group from both sides by more than their error.  A second
    pass counts what lies below and keeps only the values inside the bracket,
    summed up by value: a few ten-thousandths of a group.  The brackets, one row
    per group, are written, so that the join is planned on their real size and
    a group's rows need not meet in one task to be sorted for it.
    """
    keys = list(keys)
    rows = df.select(*keys, F.col(value).cast("double").alias("_v")).filter(F.col("_v").isNotNull())
    low, high = max(0.0, share - 3 * BRACKET), min(1.0, share + 3 * BRACKET)
    ends = F.percentile_approx("_v", [low, high], int(1 / BRACKET))
    sketch = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"), F.min("_v").alias("_min"), F.max("_v").alias("_max"), ends.alias("_e"))
    # Where the margin is not even a few positions wide, the bracket is the group.
    narrow = F.col("_rows") * BRACKET < 2
    bracket = sketch.select(
        *keys, "_rows",
        F.when(narrow | F.lit(low == 0), F.col("_min")).otherwise(F.col("_e")[0]).alias("_from"),
        F.when(narrow | F.lit(high == 1), F.col("_max")).otherwise(F.col("_e")[1]).alias("_to"),
    )
    bracket = cut_lineage(bracket, "brackets")
    beside = null_safe_join(rows, bracket, keys) if keys else rows.crossJoin(F.broadcast(bracket))
    place = F.when(F.col("_v") < F.col("_from"), F.lit(None)).otherwise(F.col("_v"))
    near = (
        beside.filter(F.col("_v") <= F.col("_to")).groupBy(*keys, place.alias("_v"))
        .agg(F.count(F.lit(1)).alias("_n"), F.first("_rows").alias("_rows"))
    )
    # The row without value holds all that lies below and comes first.
    in_order = Window.partitionBy(*(keys or [F.lit(0)])).orderBy(F.col("_v").asc_nulls_first())
    placed = near.withColumn("_last", F.sum("_n").over(in_order)).withColumn("_first", F.col("_last") - F.col("_n"))
    at = (F.col("_rows") - 1) * F.lit(float(share))

    def value_at(position: Column) -> Column:
        return F.max(F.when((F.col("_first") <= position) & (position < F.col("_last")), F.col("_v")))

    found = placed.groupBy(*keys).agg(
        value_at(F.floor(at)).alias("_lo"), value_at(F.ceil(at)).alias("_hi"), F.first(at).alias("_at")
    )
    part = F.col("_at") - F.floor("_at")
    return found.select(*keys, (F.col("_lo") + (F.col("_hi") - F.col("_lo")) * part).alias(out))


def _first_places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds to the sorted rows of a task its number and the place of the first row with the same value."""
    task, seen, first, last = TaskContext.get().partitionId(), 0, 0, None
    for batch in batches:
        if not batch.num_rows:
            continue
        values = batch.column("_v")
        before = pa.concat_arrays([last if last is not None else values[:1], values[:-1]])
        new = pc.not_equal(values, before)
        if pa.types.is_floating(values.type):
            new = pc.and_(new, pc.invert(pc.and_(pc.is_nan(values), pc.is_nan(before))))
        at = np.arange(seen, seen + batch.num_rows)
        firsts = np.maximum.accumulate(np.where(new.to_numpy(zero_copy_only=False), at, first))
        seen, first, last = seen + batch.num_rows, int(firsts[-1]), values[-1:]
        numbers = [pa.array(np.full(batch.num_rows, task, "int32")), pa.array(firsts)]
        yield pa.RecordBatch.from_arrays([*batch.columns, *numbers], names=[*batch.schema.names, "_slice", "_first"])


def global_rank(df: DataFrame, value: str, out: str = "rank") -> DataFrame:
    """``RANK() OVER (ORDER BY value NULLS LAST)`` without sorting the table in one task.

    Rows move once, into ranges of the value that are sampled; a random second
    key lets a value that fills several ranges lie in all of them.  A task
    streams through its sorted range and notes where each value starts; totals
    of the ranges (one row each) turn that into a rank.  A value that began in
    an earlier range takes its place from there.  Values keep their own type,
    so neighbours beyond 2^53 stay apart; NaN is one value above all others;
    an empty table gives no rows.
    """
    spark = df.sparkSession
    slices = int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    rows = df.filter(F.col(value).isNotNull()).withColumn("_v", F.col(value))
    ranged = rows.repartitionByRange(slices, F.col("_v"), F.rand(SALT_SEED)).sortWithinPartitions("_v")
    schema = T.StructType([*rows.schema.fields, T.StructField("_slice", T.IntegerType()), T.StructField("_first", T.LongType())])
    placed = cut_lineage(ranged.mapInArrow(_first_places, schema), "ranges")

    totals = placed.groupBy("_slice").agg(
        F.count(F.lit(1)).alias("_n"), F.max("_first").alias("_tail"), F.min("_v").alias("_low"), F.max("_v").alias("_high")
    )
    # One row per range: the only window without a key.
    earlier = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.withColumn("_offset", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
    begun = offsets.groupBy(F.col("_high").alias("_low")).agg(F.min(F.col("_offset") + F.col("_tail")).alias("_begun"))
    heads = offsets.join(begun, "_low", "left").select(
        "_slice", "_offset", F.least("_offset", F.coalesce("_begun", "_offset")).alias("_head")
    )
    smaller = F.when(F.col("_first") == 0, F.col("_head")).otherwise(F.col("_offset") + F.col("_first"))
    known = placed.join(F.broadcast(heads), "_slice").select(*df.columns, (smaller + 1).alias(out))
    valued = df.agg((F.count(value) + 1).alias(out))
    return known.unionByName(df.filter(F.col(value).isNull()).join(F.broadcast(valued)))


def numbered_rows(df: DataFrame, order: Sequence[Column | str], out: str) -> DataFrame:
    """Rows numbered from 0 in an order, by their place in a sampled range and the rows of the ranges before it."""
    slices = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    # The id of a row holds its task above bit 33 and its place in the task below.
    ranged = df.repartitionByRange(slices, *order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id())
    placed = cut_lineage(ranged, "numbered").withColumn("_slice", F.shiftright("_at", 33))
    earlier = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    totals = placed.groupBy("_slice").agg(F.count(F.lit(1)).alias("_n"))
    offsets = totals.select("_slice", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_offset"))
    number = F.col("_at").bitwiseAND(F.lit((1 << 33) - 1)) + F.col("_offset")
    return placed.join(F.broadcast(offsets), "_slice").select(*df.columns, number.alias(out))


def equal_segments(df: DataFrame, day: str, n: int) -> DataFrame:
    """First day, last day and row count of ``n`` equal-count segments (NTILE).

    The histogram of days decides every boundary: the first ``rows % n``
    segments hold one row more, and a segment starts on the day that covers
    its first position.  No row is sorted and none leaves its task.
    """
    days = df.filter(F.col(day).isNotNull()).select(F.unix_date(F.col(day).cast("date")).alias("_d"))
    hist = days.groupBy("_d").agg(F.count(F.lit(1)).alias("_n"))
    placed = running_position(hist, [], "_d", "_n")
    rows = F.col("group_rows")
    small, extra = F.floor(rows / n), rows % n
    wide = extra * (small + 1)

    def segment_at(position: Column) -> Column:
        first = F.floor(position / (small + 1))
        later = extra + F.floor((position - wide) / F.nullif(small, F.lit(0)))
        return F.when(position < wide, first).otherwise(later) + 1

    last = F.col("before") + F.col("_n") - 1
    touching = placed.withColumn(
        "segment", F.explode(F.sequence(segment_at(F.col("before")), segment_at(last)))
    ).withColumn("_rows", small + (F.col("segment") <= extra).cast("long"))
    return touching.groupBy("segment").agg(
        F.date_from_unix_date(F.min("_d")).alias("start_date"),
        F.date_from_unix_date(F.max("_d")).alias("end_date"),
        F.max("_rows").alias("count_in_segment"),
    )
