"""Text files as numbered lines, whatever their size.

Spark splits a large file into blocks read by different tasks.  Line numbers
and byte positions are rebuilt by a two-level prefix sum: running counts inside
a block, plus the totals of the earlier blocks of the file.  No file is ever
held by one task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamReader

from ..operators.hold import hold
from ..session import cut_lineage

BLOCK = ["file_path", "_block"]


def plain_path(path: Column | str) -> Column:
    """One spelling for local paths: readers give both ``file:/x`` and ``file:///x``."""
    path = F.col(path) if isinstance(path, str) else path
    return F.regexp_replace(F.regexp_replace(path, "^file:/+", "file:/"), "^/", "file:/")


def read_lines(spark: SparkSession, paths: str | list[str], glob: str | None = None) -> DataFrame:
    """Raw lines (carriage returns kept) with their file and block."""
    reader = spark.read
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return in_sequence(plain_lines(reader, paths))


def plain_lines(reader: DataFrameReader | DataStreamReader, paths: str | list[str]) -> DataFrame:
    """Lines with file and block from any reader of files, also one of a stream."""
    return reader.option("lineSep", "\n").option("recursiveFileLookup", "true").text(paths).select(
        plain_path("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.col("value"),
    )


def in_sequence(lines: DataFrame) -> DataFrame:
    """Lines numbered in the order in which each block was read."""
    return lines.withColumn("_seq", F.monotonically_increasing_id())


def number_lines(
    lines: DataFrame,
    counters: dict[str, Column] | None = None,
    file_facts: DataFrame | None = None,
    states: tuple[Column, Column] | None = None,
) -> DataFrame:
    """Add line_number (from 0), byte_position and, per counter, the sum over the earlier lines of the file.

    ``states`` tells whether a line ends inside something, if it starts outside
    and if it starts inside; ``inside`` and ``stays`` then tell whether it does
    start and end there.  A line either keeps the state, swaps it, or sets it.
    With swaps counted like any counter, the state is the parity of the count
    plus that of the last set value, which is handed from block to block.

    ``file_facts`` (unique on file_path) is attached to the small per-block
    table instead of to every line.  ``value`` is decoded as UTF-8 where the
    whole file is valid UTF-8, else as ISO-8859-1.
    """
    counters = {
        "line_number": F.lit(1),
        "byte_position": F.octet_length("value") + 1,
        **(counters or {}),
    }
    tallied = lines
    if states:
        tallied = tallied.select("*", *[F.coalesce(hold(c), F.lit(False)).alias(n) for c, n in zip(states, ("_out", "_in"), strict=True)])
        counters["swaps"] = F.col("_out") & ~F.col("_in")
    for name, amount in counters.items():
        tallied = tallied.withColumn(f"_{name}", amount.cast("long"))

    inside = Window.partitionBy(*BLOCK).orderBy("_seq").rowsBetween(Window.unboundedPreceding, -1)
    local = tallied
    for name in counters:
        local = local.withColumn(f"_{name}_local", F.coalesce(F.sum(f"_{name}").over(inside), F.lit(0)))
    marks = []
    if states:
        mark = F.when(F.col("_out") == F.col("_in"), (F.col("_out").cast("long") + F.col("_swaps_local")) % 2)
        local = local.withColumn("_mark", mark)
        marks = [F.max_by("_mark", F.when(F.col("_mark").isNotNull(), F.col("_seq"))).alias("_mark_last")]
    blocks = (local if states else tallied).groupBy(*BLOCK).agg(
        *[F.sum(f"_{name}").alias(f"_{name}_total") for name in counters],
        F.min(F.is_valid_utf8("value").cast("int")).alias("_valid"),
        *marks,
    )
    of_file = Window.partitionBy("file_path")
    earlier = of_file.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = blocks.select(
        *BLOCK,
        *[F.coalesce(F.sum(f"_{name}_total").over(earlier), F.lit(0)).alias(f"_{name}_base") for name in counters],
        F.min("_valid").over(of_file).alias("_valid"),
        *([F.col("_mark_last")] if states else []),
    )
    if states:
        last = F.last(F.col("_mark_last") + F.col("_swaps_base"), ignorenulls=True).over(earlier)
        offsets = offsets.withColumn("_mark_base", F.coalesce(last, F.lit(0))).drop("_mark_last")
    if file_facts is not None:
        offsets = offsets.join(file_facts, "file_path", "left")

    if states:
        local = local.withColumn("_mark_local", F.last("_mark", ignorenulls=True).over(inside))
    joined = local.join(offsets, BLOCK)
    latin = F.decode(F.col("value").cast("binary"), "ISO-8859-1")
    kept = [c for c in joined.columns if not c.startswith("_") and c != "value"]
    state = []
    if states:
        mark = F.coalesce(F.col("_mark_local") + F.col("_swaps_base"), F.col("_mark_base"))
        starts = (mark + F.col("_swaps_local") + F.col("_swaps_base")) % 2 == 1
        state = [starts.alias("inside"), F.when(starts, F.col("_in")).otherwise(F.col("_out")).alias("stays")]
    return joined.select(
        *kept,
        F.when(F.col("_valid") == 1, F.col("value")).otherwise(latin).alias("value"),
        *[(F.col(f"_{name}_local") + F.col(f"_{name}_base")).alias(name) for name in counters if name != "swaps"],
        *state,
    )


def line_groups(lines: DataFrame, starts: Column, file_facts: DataFrame) -> DataFrame:
    """``file_path, group, position, text`` of lines joined from one that starts a group to the next, and the columns of ``file_facts``.

    ``group`` counts the starts of a file and ``position`` is the first line's byte
    position; with ``group`` 0 are the lines before any start.  A block's first
    lines may go on with a group of an earlier block: such a part is a row of
    its own, with ``headed`` false.  Texts are decoded as by ``number_lines``.

    Lines have to come as ``read_lines`` reads them: a block's lines lie in
    one task, in order.  So they are joined where they are read, and texts are
    neither shuffled nor sorted; what earlier blocks hold is a table of one row a
    block, written so that it is joined by its real size.
    """
    marked = lines.withColumn("_starts", F.coalesce(starts, F.lit(False)))
    blocks = marked.groupBy(*BLOCK).agg(
        F.count_if("_starts").alias("_groups"),
        F.sum((F.octet_length("value") + 1).cast("long")).alias("_bytes"),
        F.min(F.is_valid_utf8("value").cast("int")).alias("_valid"),
    )
    of_file = Window.partitionBy("file_path")
    earlier = of_file.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = blocks.select(
        *BLOCK,
        *[F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"{c}_before") for c in ("_groups", "_bytes")],
        (F.min("_valid").over(of_file) == 1).alias("_utf8"),
    ).join(file_facts, "file_path", "left")
    facts = [c for c in file_facts.columns if c != "file_path"]
    schema = "file_path string, _block long, _group long, _at long, _text binary"
    joined = marked.select(*BLOCK, "_seq", "_starts", F.col("value").cast("binary").alias("value")).mapInArrow(_joined_lines, schema)
    # Held, so that a filter on it keeps the join a left one: a block that another split of the files cuts elsewhere must not be lost.
    lost = F.raise_error(F.lit("files were split anew while they were read"))
    group = hold(F.when(F.col("_groups_before").isNull(), lost.cast("long")).otherwise(F.col("_groups_before") + F.col("_group")))
    placed = joined.join(cut_lineage(offsets, "blocks"), BLOCK, "left").withColumn("group", group)
    return placed.select(
        "file_path",
        "group",
        (F.col("_bytes_before") + F.col("_at")).alias("position"),
        F.when(F.col("_utf8"), F.col("_text").cast("string")).otherwise(F.decode("_text", "ISO-8859-1")).alias("text"),
        (F.col("_group") > 0).alias("headed"),
        *facts,
    )


_GROUPS = pa.schema([("file_path", pa.string()), ("_block", pa.int64()), ("_group", pa.int64()), ("_at", pa.int64()), ("_text", pa.binary())])


def _joined_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The groups of each block's lines, with the number of their start and their place in the block; group 0 goes on with an earlier block."""
    block, last, parts, at, group, end = None, -1, [], 0, 0, 0

    def rows(groups: np.ndarray, places: np.ndarray, texts: pa.Array) -> pa.RecordBatch:
        columns = [pa.repeat(pa.scalar(block[0], pa.string()), len(texts)), pa.repeat(pa.scalar(block[1], pa.int64()), len(texts))]
        return pa.RecordBatch.from_arrays([*columns, pa.array(groups, pa.int64()), pa.array(places, pa.int64()), texts], schema=_GROUPS)

    def open_group() -> Iterator[pa.RecordBatch]:
        if parts:
            yield rows(np.array([group]), np.array([at]), pa.array([b"\n".join(parts)], pa.binary()))

    for batch in batches:
        path, blocks, seq, starts, value = batch.columns
        if not len(value):
            continue
        seq, numbers = seq.to_numpy(), blocks.to_numpy()
        if seq[0] <= last or (np.diff(seq) <= 0).any():
            raise ValueError("lines have to come in the order in which they were read")
        last = seq[-1]
        other = (np.diff(numbers) != 0) | pc.not_equal(path[1:], path[:-1]).to_numpy(zero_copy_only=False).astype(bool)
        cuts = np.concatenate([[0], np.flatnonzero(other) + 1, [len(value)]])
        for low, high in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            if block != (here := (path[low].as_py(), int(numbers[low]))):
                yield from open_group()
                block, parts, at, group, end = here, [], 0, 0, 0
            part = value.slice(low, high - low)
            sizes = pc.binary_length(part).to_numpy(zero_copy_only=False).astype(np.int64) + 1
            places = end + np.cumsum(sizes) - sizes
            end += int(sizes.sum())
            heads = np.flatnonzero(starts.slice(low, high - low).to_numpy(zero_copy_only=False))
            bounds = np.concatenate([[0], heads, [len(part)]]).astype(np.int32)
            texts = pc.binary_join(pa.ListArray.from_arrays(pa.array(bounds), part), b"\n")
            if bounds[1]:
                if not parts:
                    at = int(places[0])
                parts.append(texts[0].as_py())
            if len(heads):
                yield from open_group()
                if len(heads) > 1:
                    yield rows(group + np.arange(1, len(heads)), places[heads[:-1]], texts.slice(1, len(heads) - 1))
                group += len(heads)
                at, parts = int(places[heads[-1]]), [texts[len(heads)].as_py()]
    if block:
        yield from open_group()


def header_lines(lines: DataFrame) -> DataFrame:
    """The first line of each file."""
    first = lines.filter(F.col("_block") == 0).groupBy("file_path")
    return first.agg(F.min_by("value", "_seq").alias("header"))


def ends_in_quotes(line: Column, separator: str = ",") -> Column:
    """Whether a quoted field opened in a line is still open at its end.

    A quote opens a field only at its very start; elsewhere outside quotes it is
    text.  Complete fields are taken away, so what stays is an open one.
    """
    sep = f"\\x{ord(separator):02x}"
    field = f'{sep}(?:"[^"]*+(?:""[^"]*+)*+"[^{sep}]*+|(?!")[^{sep}]*+)'
    left = F.regexp_replace(F.concat(F.lit(separator), line), field, "")
    return F.when(F.contains(line, F.lit('"')), left != "").otherwise(False)


def quote_states(value: Column | str = "value", separator: str = ",") -> tuple[Column, Column]:
    """Whether a line ends inside quotes, if it starts outside and if it starts inside them."""
    value = F.col(value) if isinstance(value, str) else value
    start = F.regexp_replace(value, r"^\x{FEFF}", "")
    return ends_in_quotes(start, separator), ends_in_quotes(F.concat(F.lit('"'), value), separator)


#: Lines whose continuation marks are resolved together.
_STRETCH = 4096


def whole_records(numbered: DataFrame) -> DataFrame:
    """Join lines that were broken inside quotes, given whether each starts (``inside``) and ends (``stays``) there.

    Only the lines of broken records move; a record keeps the number and the
    position of its first line.  Which line a continuation belongs to is
    found within stretches of lines and handed from stretch to stretch.
    """
    inside, stays = F.col("inside"), F.col("stays")
    rest = [c for c in numbered.columns if c not in ("line_number", "byte_position", "value", "inside", "stays")]
    broken = numbered.filter(inside | stays).withColumn("_start", F.when(~inside, F.col("line_number"))).withColumn(
        "_stretch", F.floor(F.col("line_number") / _STRETCH)
    )
    within = Window.partitionBy("file_path", "_stretch").orderBy("line_number")
    earlier = Window.partitionBy("file_path").orderBy("_stretch").rowsBetween(Window.unboundedPreceding, -1)
    handed = (
        broken.groupBy("file_path", "_stretch").agg(F.max("_start").alias("_last"))
        .select("file_path", "_stretch", F.max("_last").over(earlier).alias("_handed"))
    )
    placed = broken.withColumn("_local", F.max("_start").over(within)).join(handed, ["file_path", "_stretch"])
    parts = F.array_sort(F.collect_list(F.struct("line_number", "value")))
    joined = placed.groupBy("file_path", F.coalesce("_local", "_handed").alias("line_number")).agg(
        F.min("byte_position").alias("byte_position"),
        F.array_join(F.transform(parts, lambda p: p["value"]), "\n").alias("value"),
        *[F.first(c).alias(c) for c in rest if c != "file_path"],
    )
    columns = [*rest, "line_number", "byte_position", "value"]
    return numbered.filter(~inside & ~stays).select(columns).unionByName(joined.select(columns))


def csv_fields(text: Column, separator: str = ",") -> Column:
    """Fields of a line; quoted ones may hold separators, line breaks and doubled quotes."""
    sep = "".join(f"\\x{ord(c):02x}" for c in separator)
    quoted = r'"[^"]*+(?:""[^"]*+)*+"'
    raw = F.regexp_extract_all(F.concat(F.lit(separator), text), F.lit(f"{sep}({quoted}[^{sep}]*+|[^{sep}]*+)"), F.lit(1))

    def plain(field: Column) -> Column:
        body = F.regexp_extract(field, f"(?s)^({quoted})", 1)
        after = F.substring(field, F.length(body) + 1, F.length(field))
        inner = F.replace(F.substring(body, F.lit(2), F.length(body) - 2), F.lit('""'), F.lit('"'))
        return F.when(body != "", F.concat(inner, after)).otherwise(field)

    return F.transform(raw, plain)
