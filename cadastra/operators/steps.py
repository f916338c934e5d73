"""Derivation steps as a graph of tables, with a written manifest to resume from.

A step names the tables it reads and writes.  Its version is a digest of its
own name and revision and of the versions it reads, and its tables lie in a
folder of that version.  A step counts as done when the manifest, a small table
that gets a row after the last of its tables is written, holds its version: a
run that was killed goes on at the first step without one, and a raw table of
a new version makes exactly the steps below it run again.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .sinks import rebuild, table_exists

Tables = dict[str, DataFrame]
MANIFEST = "step string, version string, tables map<string,string>, reads map<string,string>, written timestamp"


@dataclass(frozen=True)
class Step:
    """``optional``: left out where one of the tables it reads is not there."""

    job: int
    name: str
    reads: tuple[str, ...]
    writes: tuple[str, ...]
    run: Callable[[Tables], Tables]
    revision: int = 1
    optional: bool = False


@dataclass(frozen=True)
class Planned:
    step: Step
    version: str
    reads: dict[str, str]


def plan_steps(steps: Sequence[Step], given: Mapping[str, str], wanted: Sequence[str] | None = None) -> list[Planned]:
    """Steps in order with their versions; with ``wanted`` only those that these tables need.

    ``given`` holds the versions of the raw tables.  A step that extends a
    table reads what earlier steps or the raw tables say, later steps read its result.
    """
    at: dict[str, str] = dict(given)
    writer: dict[str, int] = {}
    planned: list[Planned] = []
    sources: list[set[int]] = []
    for step in steps:
        missing = [name for name in step.reads if name not in at]
        if missing and step.optional:
            continue
        if missing:
            raise KeyError(f"{step.name} reads {missing}, which no earlier step writes")
        reads = {name: at[name] for name in step.reads}
        version = hashlib.sha256(json.dumps([step.name, step.revision, reads], sort_keys=True).encode()).hexdigest()[:16]
        sources.append({writer[name] for name in step.reads if name in writer})
        for name in step.writes:
            at[name], writer[name] = version, len(planned)
        planned.append(Planned(step, version, reads))
    if wanted is None:
        return planned
    unknown = [name for name in wanted if name not in writer]
    if unknown:
        raise KeyError(f"no step writes {unknown}")
    needed, open_ = set(), [writer[name] for name in wanted]
    while open_:
        n = open_.pop()
        if n not in needed:
            needed.add(n)
            open_ += sources[n]
    return [p for n, p in enumerate(planned) if n in needed]


def read_manifest(spark: SparkSession, out: str) -> DataFrame:
    path = f"{out.rstrip('/')}/_manifest"
    if not table_exists(spark, path):
        return spark.createDataFrame([], MANIFEST)
    return spark.read.schema(MANIFEST).json(path)


def run_steps(
    steps: Sequence[Step],
    tables: Tables,
    out: str,
    versions: Mapping[str, str] | None = None,
    wanted: Sequence[str] | None = None,
    again: Sequence[str] = (),
) -> Tables:
    """Run the steps whose version is not in the manifest of ``out``; return raw and derived tables.

    ``versions`` names the state of a raw table (a day, a digest of its files);
    a table without one never makes stored results stale.  ``again`` names
    steps that run whatever the manifest says.  The manifest has a row per step
    and version, so reading it on the driver is bounded by the list of steps.
    """
    spark = next(iter(tables.values())).sparkSession
    out = out.rstrip("/")
    given = {name: (versions or {}).get(name, "given") for name in tables}
    plan = plan_steps(steps, given, wanted)
    wanted_versions = [p.version for p in plan]
    done = {r.version: r.tables for r in read_manifest(spark, out).filter(F.col("version").isin(wanted_versions)).collect()}
    known = dict(tables)
    for planned in plan:
        step = planned.step
        if planned.version in done and step.name not in again:
            known |= {name: spark.read.parquet(path) for name, path in done[planned.version].items()}
            continue
        made = step.run(known)
        if set(made) != set(step.writes):
            raise ValueError(f"{step.name} made {sorted(made)}, not {sorted(step.writes)}")
        paths = {name: f"{out}/{step.name.replace(' ', '-')}-{planned.version}/{name}" for name in made}
        known |= {name: rebuild(df, paths[name]) for name, df in made.items()}
        row = spark.createDataFrame([(step.name, planned.version, paths, planned.reads)], MANIFEST.rsplit(",", 1)[0])
        row.withColumn("written", F.current_timestamp()).coalesce(1).write.mode("append").json(f"{out}/_manifest")
    return known
