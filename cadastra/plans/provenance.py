"""Where every fact comes from.

Ids are hashes of (file, position), so they are written into the rows they
describe and no id table ever has to be joined back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.values import first_date
from ..operators.joins import union_parents
from ..operators.keys import stable_id


def with_source(df: DataFrame, path: str = "file_path", position: str = "position") -> DataFrame:
    return df.withColumn("source_id", stable_id(path, position)).withColumn("file_source_id", stable_id(path))


def sourced_land_values(land_value_row: DataFrame) -> DataFrame:
    """Land-value rows with ids and effective date (first base date, else snapshot)."""
    return with_source(land_value_row, "source_file_name", "source_line_number").withColumn(
        "effective_date", first_date("base_date_1", "source_date")
    )


def _file_source(rows: DataFrame, path: str, published: str) -> DataFrame:
    """One row per file; a file's rows are pre-aggregated in every task."""
    return (
        rows.groupBy("file_source_id", F.col(path).alias("file_path"))
        .agg(F.min(F.col(published).cast("date")).alias("date_published"))
        .withColumn("date_recorded", F.current_date())
    )


def land_value_provenance(land_value_row: DataFrame) -> dict[str, DataFrame]:
    rows = sourced_land_values(land_value_row)
    return {
        "land_value_row_complement": rows.select("property_id", "source_date", "effective_date", "source_id"),
        "file_source": _file_source(rows, "source_file_name", "source_date"),
        "source_file_line": rows.select(
            "source_id", "file_source_id", F.col("source_line_number").alias("source_file_line")
        ),
    }


def sale_provenance(kinds: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """``kinds``: the six sale tables by name; headers (``ps_row_a*``) date their file."""
    rows = {name: with_source(df) for name, df in kinds.items()}
    positions = union_parents(
        [r.select("source_id", "file_source_id", F.col("position").alias("source_byte_position")) for r in rows.values()]
    )
    heads = union_parents(
        [r.select("file_source_id", "file_path", "date_provided") for n, r in rows.items() if n.startswith("ps_row_a")]
    )
    return {"file_source": _file_source(heads, "file_path", "date_provided"), "source_byte_position": positions}


def all_sources(source_file_line: DataFrame, source_byte_position: DataFrame) -> dict[str, DataFrame]:
    """The parent tables: every source with its file, by line or by byte."""
    files = union_parents([source_file_line, source_byte_position])
    return {"source_file": files, "source": files.select("source_id")}
