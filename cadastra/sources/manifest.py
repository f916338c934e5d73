"""File manifests and the choice of publications."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.readers import DATE_FILE_NAME
from .lines import plain_path

CHECKPOINT_SUFFIX = "-checkpoint.DAT"


def list_files(spark: SparkSession, root: str, glob: str = "*.DAT") -> DataFrame:
    """Path and size of every file below ``root``; contents are not read."""
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", glob)
        .option("recursiveFileLookup", "true")
        .load(root)
    )
    return files.select(plain_path("path").alias("file_path"), F.col("length").alias("size"))


def download_date(path: Column | str) -> Column:
    """Date in a name ending ``_ddMMyyyy.DAT``, else NULL."""
    path = F.col(path) if isinstance(path, str) else path
    digits = F.nullif(F.regexp_extract(path, r"_(\d{8})\.DAT$", 1), F.lit(""))
    return F.try_to_date(digits, DATE_FILE_NAME)


def in_bounds(value: Column, low, high) -> Column:
    """Inside optional bounds; an unknown value passes only when no bound is set."""
    if low is None and high is None:
        return F.lit(True)
    ok = value.isNotNull()
    if low is not None:
        ok = ok & (value >= F.lit(low))
    if high is not None:
        ok = ok & (value <= F.lit(high))
    return F.coalesce(ok, F.lit(False))


def select_files(
    files: DataFrame,
    publish_min: int | None = None,
    publish_max: int | None = None,
    download_min: date | None = None,
    download_max: date | None = None,
) -> DataFrame:
    """Manifest (file_path, published_year, download_date, ...) within the bounds, checkpoint copies dropped."""
    dated = files.withColumn("download_date", download_date("file_path"))
    return dated.filter(
        ~F.col("file_path").endswith(CHECKPOINT_SUFFIX)
        & in_bounds(F.col("published_year"), publish_min, publish_max)
        & in_bounds(F.col("download_date"), download_min, download_max)
    )


# Snapshot modes by name.
SNAPSHOT_MODES = {
    "all": {},
    "latest": {"latest": True},
    "each-year": {"every": 1},
    "every-2nd-year": {"every": 2},
    "every-3rd-year": {"every": 3},
    "every-4th-year": {"every": 4},
    "every-5th-year": {"every": 5},
}


def choose_snapshots(
    days: list[date],
    latest: bool = False,
    every: int | None = None,
    include_first: bool = False,
    years: set[int] | None = None,
) -> list[date]:
    """Dates to use among the publication dates; yearly modes keep the newest date's month."""
    ordered = sorted(set(days), reverse=True)
    if not ordered:
        return []
    if latest:
        return ordered[:1]
    same_month = [d for d in ordered if d.month == ordered[0].month]
    if years is not None:
        return [d for d in same_month if d.year in years]
    if every is None:
        return ordered
    chosen = same_month[::every]
    if include_first and chosen[-1] != ordered[-1]:
        chosen.append(ordered[-1])
    return chosen


def select_snapshots(df: DataFrame, day: str, **mode) -> DataFrame:
    """Rows of the chosen publications.  The publication dates, at most one per day, decide on the driver."""
    if not mode:
        return df
    days = [r[0] for r in df.select(F.col(day).cast("date")).distinct().collect() if r[0]]
    return df.filter(F.col(day).cast("date").isin(choose_snapshots(days, **mode)))
