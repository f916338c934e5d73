"""Column names of tables whose columns are not known in advance."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def own(name: str, of: str | None = None) -> Column:
    """The column of exactly this name, whatever signs it holds."""
    quoted = "`" + name.replace("`", "``") + "`"
    return F.col(f"{of}.{quoted}" if of else quoted)


def distinct_names(df: DataFrame) -> list[str]:
    """The column names; fails if two columns can't be told apart."""
    names = df.columns
    if len({n.lower() for n in names}) < len(names):
        raise ValueError("columns of one name can't be told apart")
    return names


def free_name(df: DataFrame, wish: str) -> str:
    """A name no column has."""
    taken = {n.lower() for n in df.columns}
    while wish.lower() in taken:
        wish += "_"
    return wish


def filtered(df: DataFrame, kept: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> DataFrame:
    """The rows that a function over Arrow batches lets pass; columns are handed over by place, whatever their names."""
    names = distinct_names(df)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in kept(batches):
            yield batch.rename_columns(names)

    return df.toDF(*(f"c{i}" for i in range(len(names)))).mapInArrow(rows, df.schema)
