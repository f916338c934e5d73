"""Test items hidden in documents: size-partitioned MinHash containment search, verified exactly.

Items are partitioned by the power of two their number of shingles lies in.  A
partition keeps, of each item, its least hash values: as many as make a miss
impossible.  A document that contains a share ``t`` of an item's ``n`` shingles
lacks at most ``n - ceil(t n)`` of them, so it holds at least one of any
``n - ceil(t n) + 1``; the largest size of the partition sets that number.
Documents probe the partitions whose smallest item they could contain, with all
their shingles, and every candidate is counted over the item's whole set.

Items of fewer words than a shingle are one n-gram of their own size; they form a
partition a size, probed with the documents' n-grams of that size.

Items reach the tasks as blocks of a bounded number of hashes; a larger
benchmark takes more passes over the documents, not more memory.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .names import distinct_names, filtered
from .ngram_join import chunks
from .text_arrays import shingle_sets, word_hashes

SHINGLE = 5
PERCENT = 80
#: Hashes of items in one block: 16 MB.
BLOCK = 2_000_000

_ITEMS = pa.schema([("item_id", pa.int64()), ("size", pa.int32()), ("n", pa.int32()), ("tokens", pa.list_(pa.int64()))])
Item = tuple[int | None, int, np.ndarray]  # id, words of a shingle, sorted shingle hashes
_LEAKS = pa.schema(
    [("doc_id", pa.int64()), ("item_id", pa.int64()), ("n_shingles", pa.int64()), ("matched", pa.int64())]
)


def needed(n: int, percent: int) -> int:
    return -(-n * percent // 100)


class ItemIndex:
    """The items of one block and the MinHash values they are found by."""

    def __init__(self, items: list[Item], percent: int):
        self.items, self.percent = items, percent
        self.partitions: list[tuple[int, int, np.ndarray, np.ndarray]] = []
        for size, power in sorted({(size, len(t).bit_length()) for _, size, t in items}):
            own = [i for i, (_, s, t) in enumerate(items) if s == size and len(t).bit_length() == power]
            largest = (1 << power) - 1
            values = largest - needed(largest, percent) + 1
            sketch = [(h, i) for i in own for h in items[i][2][:values].tolist()]  # sets are sorted: the least values
            sketch.sort()
            keys = np.array([h for h, _ in sketch], dtype=np.uint64)
            self.partitions.append((size, needed(1 << (power - 1), percent), keys, np.array([i for _, i in sketch])))
        self.sizes = sorted({size for size, *_ in self.partitions})

    def contained(self, texts: list[str | None]) -> Iterator[list[tuple[int, int]]]:
        """Of each text: the numbers and matched shingles of the items it contains."""
        sets = {size: shingle_sets(texts, size, letters=True) for size in self.sizes}
        for i in range(len(texts)):
            yield self.found({size: sets[size][i] for size in self.sizes})

    def found(self, shingles: dict[int, np.ndarray]) -> list[tuple[int, int]]:
        """The items that a document's sorted sets of each shingle size contain."""
        out = []
        for size, least, keys, owner in self.partitions:
            document = shingles[size]
            if len(document) < max(1, least):
                continue
            at = np.minimum(np.searchsorted(document, keys), len(document) - 1)
            for i in np.unique(owner[document[at] == keys]).tolist():
                tokens = self.items[i][2]
                at = np.minimum(np.searchsorted(document, tokens), len(document) - 1)
                matched = int((document[at] == tokens).sum())
                if matched >= needed(len(tokens), self.percent):
                    out.append((i, matched))
        return out


def _blocks(benchmark: DataFrame, shingle: int, percent: int, block: int) -> Iterator[ItemIndex]:
    def item_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in chunks(batches):
            words = np.diff(word_hashes(texts, letters=True)[1]).tolist()
            sizes = [min(max(1, n), shingle) for n in words]
            sets = [shingle_sets([t], size, letters=True)[0] for t, size in zip(texts, sizes, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).cast(pa.int64()),
                    pa.array(sizes, pa.int32()),
                    pa.array([len(s) for s in sets], pa.int32()),
                    pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64())),
                ],
                schema=_ITEMS,
            )

    items = cut_lineage(
        benchmark.select("item_id", "text").mapInArrow(item_rows, "item_id long, size int, n int, tokens array<long>")
        .where("n > 0").distinct(),
        "items",
    )
    total = items.agg(F.sum("n")).first()[0] or 0
    count = max(1, -(-total // block))
    for b in range(count):
        rows = items.where(F.pmod(F.xxhash64("item_id", "tokens"), F.lit(count)) == b).select("item_id", "size", "tokens").toArrow()
        columns = [rows.column(c).combine_chunks() for c in ("item_id", "size")]
        sets = [s.values.to_numpy().view(np.uint64) for s in rows.column("tokens")]
        yield ItemIndex(list(zip(*(c.to_pylist() for c in columns), sets, strict=True)), percent)


def find_leaks(
    docs: DataFrame, benchmark: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT, block: int = BLOCK
) -> DataFrame:
    """``doc_id, item_id, n_shingles, matched`` of every document and item it contains.

    A document contains an item when it holds at least ``percent`` of the
    item's distinct ``shingle``-word shingles, wherever they stand.  Words are
    lower-case runs of letters and digits; an item of fewer words is one
    shingle of all its words, contained where they stand in a row.

    Null, empty or wordless texts contain nothing and are contained in
    nothing.  Equal rows of the benchmark count once; rows of equal ``doc_id``
    each give their own pairs; null ids stay null; other columns are ignored;
    an empty table on either side gives no rows.
    """
    spark = docs.sparkSession
    out = None
    for index in _blocks(benchmark, shingle, percent, block):
        shared = spark.sparkContext.broadcast(index)

        def leaks(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch, texts in chunks(batches):
                rows = []
                ids = batch.column(0).to_pylist()
                for doc, found in zip(ids, shared.value.contained(texts), strict=True):
                    for i, matched in found:
                        item, _, tokens = shared.value.items[i]
                        rows.append((doc, item, len(tokens), matched))
                columns = list(zip(*rows, strict=True)) if rows else [[]] * 4
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], schema=_LEAKS)

        part = docs.select("doc_id", "text").mapInArrow(
            leaks, "doc_id long, item_id long, n_shingles long, matched long"
        )
        out = part if out is None else out.unionByName(part)
    return out


def without_leaks(
    docs: DataFrame, benchmark: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT, block: int = BLOCK
) -> DataFrame:
    """The rows of ``docs``, all columns as they are, that contain no item (see ``find_leaks``).

    Null, empty and wordless texts stay, and so do rows without an id; rows of
    equal id are each judged by their own text; an empty benchmark drops
    nothing; an empty table gives no rows.
    """
    spark = docs.sparkSession
    place = distinct_names(docs).index("text")
    for index in _blocks(benchmark, shingle, percent, block):
        shared = spark.sparkContext.broadcast(index)

        def clean(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch, texts in chunks(batches, column=place):
                keep = [not found for found in shared.value.contained(texts)]
                yield batch.filter(pa.array(keep, pa.bool_()))

        docs = filtered(docs, clean)
    return docs
