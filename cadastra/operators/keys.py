"""Deterministic ids and one-row-per-key reduction."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

OrderKey = Column | str


def stable_id(*parts: Column | str) -> Column:
    """Id that every recomputation gives again: a hash of the natural key."""
    cols = [F.col(p) if isinstance(p, str) else p for p in parts]
    return F.sha2(F.concat_ws("|", *[F.coalesce(c.cast("string"), F.lit("\u0000")) for c in cols]), 256)


def small_id(*parts: Column | str) -> Column:
    """64-bit surrogate key for a dimension row."""
    return F.xxhash64(*parts)


def newest(c: str) -> Column:
    """Descending with missing values first, as the source queries order."""
    return F.col(c).desc_nulls_first()


def oldest(c: str) -> Column:
    """Ascending with missing values last, as the source queries order."""
    return F.col(c).asc_nulls_last()


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[OrderKey]) -> DataFrame:
    """One row per key: the first in ``order``; missing keys count as equal.

    ``order`` must be total within a key, otherwise a rerun may keep another
    row.  The ``row_number() = 1`` filter lets Spark place a group limit before
    the shuffle, so every task sends at most one row per key: a key holding a
    third of the rows costs one row per input partition.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return (
        df.withColumn("_rank", F.row_number().over(window)).filter(F.col("_rank") == 1).drop("_rank")
    )


def keep_top(df: DataFrame, keys: Sequence[str], order: Sequence[OrderKey], n: int) -> DataFrame:
    """The first ``n`` rows per key with their rank."""
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("rank", F.row_number().over(window)).filter(F.col("rank") <= n)
