"""A training corpus from raw documents: five stages over whole tables.

Each stage takes the session, the documents its predecessor kept and the folder
of the other tables, and returns a DataFrame; stages are written and read again.
"""

from __future__ import annotations

import gc

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadastra.llm.decontaminate import without_leaks
from cadastra.llm.language import accepted, fit_languages
from cadastra.llm.line_dedup import without_boilerplate
from cadastra.llm.ngram_join import keep_one, link_rows
from cadastra.llm.online_packing import pack_online
from cadastra.llm.queries import prepared
from cadastra.session import Scratch

#: Near copies in the pipeline: five words a shingle, similar from 80 % on.
COPY_SHINGLE, COPY_PERCENT = 5, 80
#: Share of a source's pages above which a line is boilerplate: between ordinary lines and the repeated ones (README).
LINE_RATIO = 0.05


def _begin(spark: SparkSession) -> None:
    """Settings of a stage, and memory that the one before left in the driver."""
    prepared(spark)
    gc.collect()
    pa.default_memory_pool().release_unused()  # what the sample of the language model leaves
    spark.sparkContext._jvm.System.gc()


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised; the model learns from their own labels.

    Null texts and those without letters go; null labels teach nothing; repeated
    rows are judged each; without any label nothing is recognised and all rows go.
    """
    _begin(spark)
    return accepted(docs, fit_languages(docs))


def drop_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines their source repeats; ``n_chars`` follows the text.

    Copies count as one page here: they are dropped later, and one has to keep its text.
    Null texts stay null, a null source is a source of its own, repeated rows are copies.
    """
    _begin(spark)
    return without_boilerplate(docs, ratio=LINE_RATIO, once=True).withColumn("n_chars", F.length("text").cast("long")).select(docs.columns)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of exact and near copies: the one with the smallest id.

    Texts without words and rows without an id stay; one id may have several
    texts, each is judged by itself; a row repeated as a whole stays once.
    """
    _begin(spark)
    return keep_one(docs, link_rows(docs, COPY_SHINGLE, COPY_PERCENT))


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item; null and empty texts contain none."""
    _begin(spark)
    return without_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' ids as pieces of sequences; a null or empty text is its end id alone."""
    _begin(spark)
    return pack_online(docs, keep_ids=False).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"
    )


STAGES = [
    ("language ID", identify_language),
    ("line dedup", drop_boilerplate),
    ("n-gram Jaccard join", drop_copies),
    ("benchmark decontamination", drop_leaks),
    ("packing", pack),
]

#: SQL can express neither the trained model nor the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's own intermediate tables go when its result is written."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES[:-1]:
        with Scratch(spark) as scratch:
            docs = scratch.keep(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
