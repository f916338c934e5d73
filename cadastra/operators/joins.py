"""Joins with the guards the land tables need.

No side is broadcast by hand: adaptive execution measures every shuffle and
turns a join whose side proves small into a broadcast join, and splits a
skewed partition of the larger side.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .keys import keep_first


def unseen(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``left`` whose keys do not occur in ``right``."""
    return left.join(right.select(*keys), list(keys), "left_anti")


def with_seen_flag(left: DataFrame, right: DataFrame, keys: Sequence[str], flag: str) -> DataFrame:
    """``left`` plus a flag telling whether its keys occur in ``right``.

    The right side is reduced to distinct keys first, so a key repeated there
    never multiplies the rows of ``left``.
    """
    present = right.select(*keys).distinct().withColumn("_seen", F.lit(True))
    joined = left.join(present, list(keys), "left")
    return joined.withColumn(flag, F.col("_seen").isNotNull()).drop("_seen")


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi join under which missing keys match; the left copy of the keys is kept."""
    renamed = right
    condition = F.lit(True)
    for key in keys:
        renamed = renamed.withColumnRenamed(key, f"_right_{key}")
    for key in keys:
        condition = condition & F.col(key).eqNullSafe(F.col(f"_right_{key}"))
    return left.join(renamed, condition, how).drop(*[f"_right_{k}" for k in keys])


def first_match(
    left: DataFrame, right: DataFrame, keys: Sequence[str], order: Sequence[Column | str], how: str = "inner"
) -> DataFrame:
    """Each left row with the first right row of its keys (a lateral limit 1)."""
    return left.join(keep_first(right, keys, order), list(keys), how)


def with_dimension(facts: DataFrame, dimension: DataFrame, keys: Sequence[str], row_id: str) -> DataFrame:
    """Left join of facts with a dimension whose keys are unique.

    The dimension is written first: its real size plans the join, so facts need
    not be dealt by a few names to meet a small one.  A fact lacking a key
    matches nothing; such facts are dealt by their ``row_id`` instead of meeting in one task.
    """
    written = cut_lineage(dimension.withColumn("_dealt", F.lit(0).cast("long")), "dimension")
    lacking = F.greatest(*[F.col(k).isNull() for k in keys], F.lit(False))
    dealt = facts.withColumn("_dealt", F.when(lacking, F.xxhash64(row_id)).otherwise(F.lit(0).cast("long")))
    return dealt.join(written, [*keys, "_dealt"], "left").drop("_dealt")


def two_step_lookup(
    facts: DataFrame, outer: DataFrame, inner: DataFrame, outer_key: str, outer_id: str, inner_key: str
) -> DataFrame:
    """Attach an outer dimension by name, then an inner one by name within it.

    ``outer`` has (outer_key, outer_id); ``inner`` has (inner_key, outer_id and
    its own columns).  A fact without a match keeps its row with NULL ids.
    """
    return facts.join(outer, [outer_key], "left").join(inner, [inner_key, outer_id], "left")


def reconcile(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Every key of both listings with its row counts and a status.

    Both sides are reduced to one row per key before the full join, so no key
    can fan out.
    """
    a = left.groupBy(*keys).agg(F.count(F.lit(1)).alias("left_rows"))
    b = right.groupBy(*keys).agg(F.count(F.lit(1)).alias("right_rows"))
    status = (
        F.when(F.col("right_rows").isNull(), "only_left")
        .when(F.col("left_rows").isNull(), "only_right")
        .otherwise("both")
    )
    return (
        a.join(b, list(keys), "full_outer")
        .withColumn("status", status)
        .na.fill(0, ["left_rows", "right_rows"])
    )


def match_report(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Total, matched and failed row counts of a left merge, in one row."""
    flagged = with_seen_flag(left, right, keys, "matched")
    return flagged.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if("matched").alias("matched"),
        F.count_if(~F.col("matched")).alias("failed"),
    )


def null_orphans(
    child: DataFrame, parent: DataFrame, child_key: str, parent_key: str, blank: Sequence[str]
) -> DataFrame:
    """Set the ``blank`` columns to NULL where the parent row does not exist."""
    known = parent.select(F.col(parent_key).alias(child_key)).distinct().withColumn("_known", F.lit(True))
    joined = child.join(known, [child_key], "left")
    for column in blank:
        joined = joined.withColumn(f"_{column}", F.when(F.col("_known"), F.col(column)))
    kept = [
        F.col(f"_{c}").alias(c) if c in blank else F.col(c) for c in child.columns
    ]
    return joined.select(*kept)


def union_parents(children: Sequence[DataFrame]) -> DataFrame:
    """One parent table over child tables with partly different columns."""
    out = children[0]
    for child in children[1:]:
        out = out.unionByName(child, allowMissingColumns=True)
    return out


def distinct_union(columns: Sequence[tuple[DataFrame, str]], name: str) -> DataFrame:
    """Distinct non-null values of one column taken from several tables."""
    out = None
    for df, column in columns:
        part = df.select(F.col(column).alias(name)).filter(F.col(name).isNotNull())
        out = part if out is None else out.unionByName(part)
    return out.distinct()
