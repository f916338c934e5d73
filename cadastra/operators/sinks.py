"""Table writes: idempotent and strict appends, buckets, rebuilds, job runs."""

from __future__ import annotations

import os
from collections.abc import Callable, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import cut_lineage
from .keys import keep_first
from .quality import ConstraintError, broken_rule, repeated_keys, require_empty

BUCKETS = 8


def new_rows(
    batch: DataFrame, existing: DataFrame | None, keys: Sequence[str], order: Sequence[Column | str] = ()
) -> DataFrame:
    """Rows of ``batch`` to append: first per key, key not in ``existing``.

    Missing keys count as equal, like in ``keep_first``.
    """
    chosen = keep_first(batch, keys, list(order) or [F.struct(*batch.columns)])
    if existing is None:
        return chosen
    renamed = existing.select(*[F.col(k).alias(f"_have_{k}") for k in keys])
    condition = F.lit(True)
    for key in keys:
        condition = condition & F.col(key).eqNullSafe(F.col(f"_have_{key}"))
    return chosen.join(renamed, condition, "left_anti")


def table_exists(spark: SparkSession, path: str) -> bool:
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(jvm_path)


#: Types whose smallest and largest value stored files announce.
_RANGED = (T.NumericType, T.StringType, T.DateType, T.TimestampType, T.TimestampNTZType, T.BooleanType)


def key_range(batch: DataFrame, keys: Sequence[str]) -> Column:
    """Condition on stored rows that can share a key with ``batch``: inside its smallest and largest value of every key.

    Missing keys count as equal, so they are looked for if the batch has some.
    Keys of other types than numbers, texts, dates and times narrow nothing.
    """
    ranged = [k for k in keys if isinstance(batch.schema[k].dataType, _RANGED)]
    if not ranged:
        return F.lit(True)
    found = batch.agg(*[f(k) for k in ranged for f in (F.min, F.max, lambda c: F.count_if(F.col(c).isNull()))]).first()
    condition = F.lit(True)
    for at, key in enumerate(ranged):
        low, high, missing = found[3 * at : 3 * at + 3]
        kind = batch.schema[key].dataType
        inside = F.lit(False) if low is None else F.col(key).between(F.lit(low).cast(kind), F.lit(high).cast(kind))
        condition = condition & (inside | F.col(key).isNull() if missing else inside)
    return condition


def stored_near(batch: DataFrame, path: str, keys: Sequence[str], within: Column | None = None) -> DataFrame | None:
    """Stored rows that can share a key with ``batch``, None without a table.

    ``within`` (a file, a period) or else the batch's range of keys is pushed
    into the scan, which passes over files and row groups that lie outside.
    """
    spark = batch.sparkSession
    if not table_exists(spark, path):
        return None
    return spark.read.schema(batch.schema).parquet(path).filter(key_range(batch, keys) if within is None else within)


def append_new(
    batch: DataFrame,
    path: str,
    keys: Sequence[str],
    order: Sequence[Column | str] = (),
    within: Column | None = None,
) -> None:
    """Idempotent append: running the same batch twice adds nothing.

    ``within`` narrows the stored rows that can share a key with the batch; without it the range of its keys does.
    """
    new_rows(batch, stored_near(batch, path, keys, within), keys, order).write.mode("append").parquet(path)


def append_strict(batch: DataFrame, path: str, keys: Sequence[str], within: Column | None = None) -> None:
    """Append that fails when a key repeats within the batch or with the table.

    Of the stored table only the keys are read, of the rows that can share one with the batch.
    """
    require_empty(repeated_keys(batch, keys), f"repeated key in a batch for {path}")
    stored = stored_near(batch, path, keys, within)
    if stored is not None:
        have = stored.select(*[F.col(k).alias(f"_have_{k}") for k in keys])
        same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_have_{k}")) for k in keys])
        require_empty(batch.select(*keys).join(have, same, "left_semi"), f"repeated key in {path}")
    batch.write.mode("append").parquet(path)


def append_by_kind(
    records: DataFrame, kind: str, targets: dict[str, str], keys: Sequence[str]
) -> None:
    """Write one record stream to a table per kind; kinds without target are dropped.

    The stream is computed once, however many kinds read it.
    """
    records = cut_lineage(records.filter(F.col(kind).isin(list(targets))), "records-by-kind")
    for value, path in targets.items():
        append_new(records.filter(F.col(kind) == value), path, keys)


def rebuild(df: DataFrame, path: str) -> DataFrame:
    """Replace a derived table with fresh content and return it."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def load_checked(df: DataFrame, path: str, rules: dict[str, Column], strict: bool = True) -> dict[str, int]:
    """Replace a table and count, in the pass that writes it, the ``rows`` and what breaks each rule.

    The table is written beside its place and moved there when all rules hold,
    or whatever they say if not ``strict``; otherwise the old one stays.
    """
    spark = df.sparkSession
    seen, beside = Observation(), f"{path.rstrip('/')}-{os.urandom(8).hex()}"
    counts = [broken_rule(rule).alias(f"rule{i}") for i, rule in enumerate(rules.values())]
    df.observe(seen, F.count(F.lit(1)).alias("rows"), *counts).write.parquet(beside)
    found = {name: seen.get[f"rule{i}"] for i, name in enumerate(rules)}
    written, place = (spark._jvm.org.apache.hadoop.fs.Path(p) for p in (beside, path))
    files = written.getFileSystem(spark._jsc.hadoopConfiguration())
    if strict and any(found.values()):
        files.delete(written, True)
        raise ConstraintError(f"{path}: {({k: n for k, n in found.items() if n})}")
    files.delete(place, True)
    if not files.rename(written, place):
        raise OSError(f"{beside} can't be moved to {path}")
    return {"rows": seen.get["rows"], **found}


def save_bucketed(df: DataFrame, table: str, key: str, path: str, buckets: int = BUCKETS) -> DataFrame:
    """Hash-bucketed and sorted table, so joins and windows on ``key`` need no shuffle."""
    (
        df.write.mode("overwrite")
        .bucketBy(buckets, key)
        .sortBy(key)
        .option("path", path)
        .saveAsTable(table)
    )
    return df.sparkSession.table(table)


def drop_tables(spark: SparkSession, tables: Sequence[str]) -> None:
    for table in tables:
        spark.sql(f"DROP TABLE IF EXISTS {table}")


def query_table(spark: SparkSession, sql: str, **args) -> DataFrame:
    """A query over registered tables with bound parameters."""
    return spark.sql(sql, args=args)


Job = Callable[[dict[str, DataFrame]], dict[str, DataFrame]]


def run_jobs(
    jobs: Sequence[tuple[int, str, Job]],
    tables: dict[str, DataFrame],
    run_from: int | None = None,
    run_till: int | None = None,
    save: Callable[[str, DataFrame], DataFrame] | None = None,
) -> dict[str, DataFrame]:
    """Run a numbered slice of derivation jobs; each reads and adds named tables."""
    known = dict(tables)
    for number, _, job in jobs:
        if run_from is not None and number < run_from:
            continue
        if run_till is not None and number > run_till:
            continue
        for name, df in job(known).items():
            known[name] = save(name, df) if save else df
    return known
