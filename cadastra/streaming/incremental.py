"""New publications arrive as new files; each is taken in exactly once.

The stream's checkpoint remembers which files were read, and the append is
idempotent on the record key, so a micro-batch repeated after a failure, or a
file published twice under another name, adds nothing.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators.sinks import append_new, key_range
from ..session import cut_lineage
from ..sources.lines import in_sequence, plain_lines
from ..sources.manifest import download_date
from ..sources.sale_files import SALE_TABLES, read_records, typed_table, with_layout

Transform = Callable[[DataFrame], DataFrame]


def ingest_parquet(
    spark: SparkSession,
    source: str,
    schema: StructType,
    target: str,
    checkpoint: str,
    keys: Sequence[str],
    order: Sequence[Column | str] = (),
    transform: Transform | None = None,
    files_per_batch: int = 1000,
) -> None:
    """Append the rows of all files not seen yet, then stop."""
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(source)

    def take(batch: DataFrame, _: int) -> None:
        append_new(transform(batch) if transform else batch, target, keys, order)

    query = (
        stream.writeStream.option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(take)
        .start()
    )
    query.awaitTermination()


def ingest_sale_files(
    spark: SparkSession,
    root: str,
    target: str,
    checkpoint: str,
    published_year: Column,
    files_per_batch: int = 10_000,
) -> None:
    """Sale files below ``root`` not seen yet, appended to one table per record kind.

    The stream is one of lines; those of a batch go through the ordinary record
    reader, and files, layouts and what is stored already are tables joined on
    the file.  ``published_year`` is an expression over ``file_path``.
    """
    stream = spark.readStream.option("pathGlobFilter", "*.DAT").option("maxFilesPerTrigger", files_per_batch)
    found = plain_lines(stream, root)

    def take(batch: DataFrame, _: int) -> None:
        files = cut_lineage(batch.select("file_path").distinct(), "new-files")
        manifest = with_layout(
            files.withColumn("published_year", published_year).withColumn("download_date", download_date("file_path"))
        )
        records = cut_lineage(read_records(in_sequence(batch), manifest), "new-records")
        same_files = key_range(files, ["file_path"])
        for table in SALE_TABLES:
            rows, rejects = typed_table(records, table)
            # What cannot be read is kept beside its table: the file counts as taken.
            for kind, found in ((table, rows), (f"{table}_rejects", rejects)):
                append_new(found, f"{target}/{kind}", ["file_path", "position"], within=same_files)

    query = (
        found.writeStream.option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(take)
        .start()
    )
    query.awaitTermination()


def year_in_path(path: str = "file_path") -> Column:
    """Published year from the last four-digit folder of a path."""
    return F.regexp_extract(path, r"/(?:[^/]*_)?(\d{4})[^/]*/[^/]*$", 1).try_cast("int")
