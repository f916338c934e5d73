"""Constraint reports and bad-record handling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.readers import unreadable
from ..session import cut_lineage
from .hold import hold


class ConstraintError(ValueError):
    """Raised in strict mode when a constraint does not hold."""


def repeated_keys(df: DataFrame, keys: Sequence[str], where: Column | None = None) -> DataFrame:
    """Keys occurring more than once, optionally among the rows meeting ``where``."""
    rows = df if where is None else df.filter(where)
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


def rule_report(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Violations per rule in one pass; a rule that evaluates to NULL holds."""
    counts = df.agg(
        *[broken_rule(rule).alias(name) for name, rule in rules.items()]
    )
    pairs = F.array(*[F.struct(F.lit(n).alias("rule"), F.col(f"`{n}`").alias("violations")) for n in rules])
    return counts.select(F.inline(pairs))


def broken_rule(rule: Column) -> Column:
    """How many rows break a rule; a rule that evaluates to NULL holds."""
    return F.count_if(~F.coalesce(rule, F.lit(True)))


def orphans(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Non-null child keys without parent, with their row counts."""
    used = child.filter(F.col(child_key).isNotNull()).groupBy(child_key).agg(F.count(F.lit(1)).alias("n"))
    known = parent.select(F.col(parent_key).alias(child_key))
    return used.join(known, [child_key], "left_anti")


def require_empty(violations: DataFrame, what: str, sample: int = 5) -> None:
    """Strict mode: fail with a few offending rows."""
    found = violations.take(sample)
    if found:
        raise ConstraintError(f"{what}: {[r.asDict() for r in found]}")


def split_rejects(
    raw: DataFrame, readings: dict[str, tuple[str, Column]], required: Sequence[str] = (), once: bool = False
) -> tuple[DataFrame, DataFrame]:
    """Typed rows and rejected rows.

    ``readings`` maps output name to (text column, value expression).  A row
    with any unreadable or missing required field goes to the rejects with the
    names of its bad fields.  ``once`` writes the read rows (texts of rejects
    only), so that two results do not read everything twice.
    """
    texts = list(dict.fromkeys(t for t, _ in readings.values()))
    untouched = [c for c in raw.columns if c not in texts]
    read = raw.select(*untouched, *texts, *[hold(value).alias(f"_read_{n}") for n, (_, value) in readings.items()])
    bad = [
        F.when(unreadable(text, F.col(f"_read_{name}"), name in required), F.lit(name))
        for name, (text, _) in readings.items()
    ]
    # Held as well: a filter naming dozens of columns would have the optimiser
    # derive one constraint per combination of their later names.
    checked = read.withColumn("bad_fields", hold(F.array_compact(F.array(*bad))))
    if once:
        of_rejects = {t: F.when(F.size("bad_fields") > 0, F.col(t)) for t in texts}
        checked = cut_lineage(checked.withColumns(of_rejects), "checked")
    good = checked.filter(F.size("bad_fields") == 0).select(
        *untouched, *[F.col(f"_read_{name}").alias(name) for name in readings]
    )
    rejects = checked.filter(F.size("bad_fields") > 0).select(*untouched, *texts, "bad_fields")
    return good, rejects


def reject_counts(rejects: DataFrame) -> DataFrame:
    return (
        rejects.select(F.explode("bad_fields").alias("field"))
        .groupBy("field")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def short_shards(expected: DataFrame, actual: DataFrame, key: str, expected_rows: str) -> DataFrame:
    """Shards for which fewer rows arrived than were announced."""
    arrived = actual.groupBy(key).agg(F.count(F.lit(1)).alias("arrived"))
    return (
        expected.join(arrived, [key], "left")
        .withColumn("arrived", F.coalesce(F.col("arrived"), F.lit(0)))
        .filter(F.col("arrived") < F.col(expected_rows))
    )
